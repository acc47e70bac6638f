"""Layouts with more, fewer and wrapped fields find their mappings, from JSON and from nested columns alike."""

import json

import pytest

from assetloom.llm import chat

TWO = [("user", "a"), ("assistant", "b")]
SYSTEM = [("system", "s"), *TWO]
MESSAGES = [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]
RECORDS = [
    ({"source": "x", "id": 7, "conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, TWO),
    ({"messages": [{"role": "user", "name": "n", "content": "a"}, {"role": "assistant", "content": "b"}]}, TWO),
    ({"system": "s", "messages": MESSAGES}, SYSTEM),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}]}, {"role": "assistant", "content": "b"}]}, TWO),
    ({"messages": [{"role": "user", "content": [{"type": "image", "image": {"url": "u"}}, {"type": "text", "text": "a"}]}, {"role": "assistant", "content": ["b"]}]}, TWO),
    ({"messages": []}, []),
    ({"prompt": "a", "chosen": "b", "rejected": "c"}, TWO),
    ({"prompt": "a", "chosen": MESSAGES, "rejected": MESSAGES, "score": 1}, TWO),
    ({"prompt": MESSAGES[:1], "chosen": MESSAGES[1:], "rejected": MESSAGES[1:]}, TWO),
    ({"data": {"prompt": "a", "response": "b"}, "meta": {"lang": "en"}}, TWO),
    ({"id": 1, "record": {"system": "s", "messages": MESSAGES}}, SYSTEM),
    ({"instruction": "a", "output": "b", "system": "s"}, SYSTEM),
    ({"conversations": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, TWO),
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None, "tool_calls": [{"id": "x"}]}]}, [("user", "a"), ("assistant", "")]),
    ({"text": "a"}, []),
    ({"data": {"text": "a"}}, []),
    ({}, []),
]


def test_json_records(spark):
    df = spark.createDataFrame([(i, json.dumps(r)) for i, (r, _) in enumerate(RECORDS)], "id bigint, record string")
    by = {}
    for r in chat.turns_from_json(df, "id", "record").collect():
        by.setdefault(r.id, []).append((r.turn, r.role, r.text))
    for i, (record, want) in enumerate(RECORDS):
        assert sorted(by[i], key=str) == ([(k, *t) for k, t in enumerate(want)] or [(None, None, None)]), record


def test_nested_columns_equal_their_json(spark):
    part = "struct<type string, text string>"
    tables = {
        "id bigint, source string, system string, messages array<struct<role string, name string, content string>>": [(1, "x", "s", [("Human", "n", "a"), ("gpt", None, None)]), (2, None, None, None), (3, "x", "", [])],
        f"id bigint, messages array<struct<role string, content array<{part}>>>": [(1, [("user", [("text", "a"), ("image", None), ("text", "c")]), ("assistant", None), ("assistant", [])])],
        "id bigint, messages array<struct<role string, content array<string>>>": [(1, [("user", ["a", None, "b"])])],
        "id bigint, meta struct<lang string>, data struct<prompt string, response string>": [(1, ("en",), ("a", "b")), (2, None, None), (3, None, ("a", None))],
        "id bigint, prompt string, chosen string, rejected string": [(1, "a", "b", "c")],
        "id bigint, prompt array<struct<role string, content string>>, chosen array<struct<role string, content string>>": [(1, [("user", "a")], [("assistant", "b")]), (2, None, [("assistant", "b")])],
        "id bigint, system string, instruction string, output string": [(1, "s", "a", "b"), (2, None, None, "b")],
    }
    for kind, rows in tables.items():
        df = spark.createDataFrame(rows, kind)
        want = []
        for row in df.collect():
            record = row.asDict(recursive=True)
            key = record.pop("id")
            way = chat.chosen(chat.paths_of_schema(df.drop("id").schema))
            want += [(key, k, *turn) for k, turn in enumerate(chat.canonical_turns(record, *way))]
        assert sorted(tuple(r) for r in chat.turns_from_records(df, "id").collect()) == sorted(want) and want, kind
    with pytest.raises(ValueError):
        chat.turns_from_records(spark.createDataFrame([(1, ("x",))], "id int, data struct<other string>"), "id")


def test_a_fingerprint_names_one_mapping():
    layouts = [chat.fingerprint(p) for m in chat.MAPPINGS for p in m.layouts()]
    assert len(layouts) == len(set(layouts)) == len(chat.REGISTRY)
