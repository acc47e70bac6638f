import pytest

LONG = " ".join(f"word{i % 700} and{i % 13}" for i in range(40_000))
TEXTS = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "It's  here\n\nand we'll go. 12345 !!! <|endoftext|>"),
    (6, "日本語テキスト です。 ñandú Ünïcödé 😀😀"), (7, "aaaa aaaaaaaa abababab\x01x"), (7, "aaaa aaaaaaaa abababab\x01x"), (8, LONG),
    (9, "a b c d e f g h i j k l"), (10, "A B C D e f g h i j k l"), (11, "\r\nx y z \x1c\x1d q"), (None, "no id here at all"),
]


@pytest.fixture(scope="session")
def texts():
    return TEXTS


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns whose names operators also use."""
    rows = [(i, t, "a", 0, "b") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, kept string, n_tokens int, spans string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
