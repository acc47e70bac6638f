"""Forms of assignments in many languages, by names and values, and harmless texts beside them."""

import random
import string

from assetloom.llm import secrets

#: Each holds the value once (VALUE), or in two halves (HEAD, TAIL), and a name in its own writing.
FORMS = [
    'password: str = "VALUE"', 'password: Optional[str] = "VALUE"', 'password: str | None = "VALUE"', 'db_password = b"VALUE"', 'self.db_password = "VALUE"',
    'config["password"] = "VALUE"', "os.environ['SECRET_KEY'] = 'VALUE'", 'password = ("HEAD"\n  "TAIL")', 'secret_key = "HEAD" + \\\n  "TAIL"', 'api_secret = """VALUE"""',
    "private_key_pass = '''\\\nVALUE\n'''", 'secret_key = os.getenv("X") or "VALUE"', 'os.getenv("DB_PASSWORD", "VALUE")', 'connect(host, db_password="VALUE")', '[("db_password", "VALUE")]',
    'let secretKey: string = "VALUE"', "const secretKey =\n  'VALUE';", 'secretKey?: string = "VALUE"', "const secretKey = process.env.SECRET || 'VALUE';", 'password ??= "VALUE"', 'password += "VALUE"',
    'new Client("h", { secretKey: `VALUE` })', 'options.set("password", "VALUE")', 'var dbPassword string = "VALUE"', "client_secret := `VALUE`", 'let client_secret = Some(String::from("VALUE"));',
    'static const char db_password[] = "VALUE";', '#define SECRET "VALUE"', 'String dbPassword = new String("VALUE");', 'props.setProperty("db.password", "VALUE");', "define('DB_PASSWORD', 'VALUE');",
    '$db["pwd"] = "HEAD" . "TAIL";', "db_password <- 'VALUE'", ':secret_key => "VALUE"', "DB_PASS=VALUE", "export DB_PASS=VALUE", 'DB_PASS="${DB_PASS:-VALUE}"', "ENV DB_PASSWORD VALUE", "mysql --password VALUE -u root",
    "db.password = VALUE", "- name: DB_PASSWORD\n  value: VALUE", "encryption_key: VALUE", '<password>VALUE</password>', '<add key="dbPassword" value="VALUE"/>', '{"credentials": {"privateKey": "VALUE"}}',
    "Authorization: Bearer VALUE", 'headers = {"Authorization": "Bearer VALUE"}', 'url = "postgres://app:VALUE@db:5432/x"', 'part = "HEAD"\nrest = "TAIL"\ndb_password = part + rest', "-----BEGIN RSA PRIVATE KEY-----\nVALUE\n-----END RSA PRIVATE KEY-----",
]
ALPHABETS = [string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_lowercase + string.digits + "!#%^", "0123456789abcdef"]
HARMLESS = [
    "the key: 12345678 note", "token = self.token2", 'secret_key = os.environ["SECRET_KEY_9X"]', 'color = "Zx81kQ0vLm2"', "api_key_id = user_id_2", "password = getPassword1(user)", "secret_key = sha256(user2)",
    'keys = ["a1", "b2"]', 'public_key_path = "/etc/ssl/cert1.pem"', 'private String apiName = "v1Users"', 'if password == "Abcdefgh123456": pass', "access: read2write", "passage: Zx81kQ0vLm77TrQ9", 'compass = "Zx81kQ0vLm77TrQ9"',
    'monkey = "Zx81kQ0vLm77TrQ9"', 'password: "Please enter 8 characters"', 'author = "Zx81kQ0vLm77TrQ9"', "<keyboard>Zx81kQ0vLm77TrQ9</keyboard>", 'f("color", "Zx81kQ0vLm77TrQ9")', "http://host:8080/Zx81kQ0vLm77TrQ9@x", "secret = ''", 'password = ""\nchecksum = "Zx81kQ0vLm77TrQ9"',
    "secret_key =\nbuild_number=Zx81kQ0vLm77TrQ9", "--color Zx81kQ0vLm77TrQ9", "Tokens: 8192 in total, api: v2", "password=${DB_PASSWORD_1}", 'password = config["db1"]["Password1"]',
]


def filled(form, alphabet, rng):
    half = ["".join(rng.choices(alphabet, k=12)) + "7Kq" for _ in range(2)]
    return form.replace("VALUE", half[0] + half[1]).replace("HEAD", half[0]).replace("TAIL", half[1]), half


def test_recall_by_form_and_value(spark):
    rng = random.Random(9)
    texts, halves = [], []
    for form in FORMS:
        for alphabet in ALPHABETS:
            for around in ("{}", "# settings of the service\n{}\ncolor = 1\n"):
                text, half = filled(form, alphabet, rng)
                texts.append(around.format(text) if "{" not in text else around.replace("{}", text))
                halves.append(half)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in secrets.scan(rows, redact=True).collect()}
    assert all(got[i].spans == secrets.written(secrets.spans(t)) for i, t in enumerate(texts))
    missed = [t for i, (t, half) in enumerate(zip(texts, halves, strict=True)) if any(h in got[i].redacted for h in half)]
    assert len(missed) <= 0.02 * len(texts), missed
    kept = [i for i, t in enumerate(texts) if "color = 1" in t and "color = 1" not in got[i].redacted]
    assert not kept


def test_harmless_texts_have_no_literal():
    found = {t: [t[a:b] for k, a, b in secrets.spans(t) if k == "literal"] for t in HARMLESS}
    assert {t: f for t, f in found.items() if f} == {}


def test_rest_of_a_literal_beside_a_base_span():
    text = 'password = "Zx81kQ0v!Lm77TrQ9"; y'
    assert secrets.spans(text) == [("assign", 0, 20), ("literal", 20, 29)]
    assert secrets.beside([(0, 10), (12, 20)], [(2, 4), (8, 13), (19, 30)]) == [(0, 2), (4, 8), (13, 19)]


def test_odd_texts_end_in_linear_time():
    for text in ('"""' * 200_000, "password = (" * 100_000, "<a " * 300_000, "password: " * 100_000, "f(" * 300_000, "://x:" * 200_000, "name: a value " * 100_000, "password = [\n" * 100_000):
        secrets.spans(text)
    rng = random.Random(4)
    for _ in range(5000):
        text = "".join(rng.choices(['"', "'", '"""', "password", "=", ":", "(", ")", "[", "]", "\n", " ", "+", "Zx81kQ0vLm77", ",", "\\", ".", "or", "<", ">"], k=30))
        found = secrets.spans(text)
        assert all(0 <= a < b <= len(text) for _, a, b in found) and [s for s in found if s[0] != "literal"] == secrets.base_spans(text)
