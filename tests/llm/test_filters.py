import hashlib
import random
import re
import time
from collections import Counter

from assetloom.llm import decontaminate, quality_rules, queries, secrets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def hits(doc, windows):
    words, hit, items = item_words(doc), set(), set()
    for n in {len(w) for w in windows}:
        for i in range(len(words) - n + 1):
            if own := windows.get(tuple(words[i : i + n])):
                hit.update(range(i, i + n))
                items |= own
    return len(words), len(hit), sorted(items)


def all_windows(items):
    out = {}
    for i, text in items:
        w = item_words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            out.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    return out


def test_decontamination_equals_brute_force(spark, sf_dir):
    windows = all_windows(map(tuple, queries.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()))
    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    rows = queries.op4_decontaminate(spark, sf_dir).collect()
    assert len(rows) == len(texts) and any(r.contaminated for r in rows)
    for r in rows:
        n, hit, items = hits(texts[r.doc_id], windows)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest())


def test_decontamination_odd_rows_several_automata_and_offsets(spark, odd_docs, no_docs, texts):
    items = [(1, "a b c d e f g h i j"), (1, "A b c d e f g h i j k"), (2, None), (3, ""), (4, "One!"), (None, "日本語テキスト です。")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    windows = all_windows([("" if i is None else i, t) for i, t in items])
    want = sorted((i or 0, *hits(t, windows)) for i, t in texts)
    for size in (8_000_000, 100):
        rows = decontaminate.scan(odd_docs, bench, max_bytes=size, keep=["kept"]).collect()
        assert sorted((r.doc_id or 0, r.n_words, r.n_hit, list(r["items"])) for r in rows) == want
    by = {r.doc_id: r for r in rows}
    assert [texts[9][1][s.start : s.end] for s in by[9].spans] == ["a b c d e f g h i j k"]
    assert [texts[5][1][s.start : s.end] for s in by[6].spans] == ["日本語テキスト です。"]
    assert decontaminate.scan(no_docs, bench).count() == 0
    assert decontaminate.scan(odd_docs, bench.where("false")).where("n_hit > 0").count() == 0


def rule_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= {i, i + 1, i + 2}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def test_quality_rules_equal_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    rows = queries.op5_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == rule_counts(texts[r.doc_id])
        assert not (r.kept and r.base_failed)
    labels = {r.doc_id: r.quality for r in queries.table(spark, sf_dir, "labels").collect()}
    judged = [(r.kept, labels[r.doc_id]) for r in rows if r.doc_id in labels and not r.base_failed]
    assert sum(k for k, q in judged if q) >= 0.99 * sum(q for _, q in judged)
    assert sum(not k for k, q in judged if not q) >= 0.6 * sum(not q for _, q in judged)


def test_quality_rules_odd_rows_and_order(odd_docs, no_docs, texts):
    rows = quality_rules.apply_rules(odd_docs, keep=["spans"]).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == sorted((i or 0, *rule_counts(t)) for i, t in texts)
    assert quality_rules.apply_rules(no_docs).count() == 0
    stats = [("symbols", 10, 1, 1.0), ("word_length", 10, 5, 0.1), ("shouting", 10, 0, 0.1), ("dup_lines", 10, 9, 9.0)]
    assert [r.name for r in quality_rules.cascade_order(stats, quality_rules.RULES[:4])] == ["word_length", "symbols", "dup_lines", "shouting"]


def test_a_rejected_text_computes_no_later_fact(spark, monkeypatch):
    x = quality_rules.Facts(("# " * 40 + "word " * 60).encode(), 380)
    order = quality_rules.cascade_order([("symbols", 10, 9, 0.001)])
    assert order[0].name == "symbols" and next(r.name for r in order if r.rejects(x)) == "symbols"
    assert not {"shouted", "letters", "commonest", "bullets", "cut_off"} & set(vars(x))
    cases = {"letters": "12 345 " * 30, "one_word": "same " * 25 + " ".join(f"word{chr(97 + i % 26)}x{chr(97 + i // 26)}" for i in range(35)), "bullets": "\n".join(f"- item {chr(97 + i)} of the list{chr(97 + i)}" for i in range(20)), "cut_off": "\n".join(f"this line {chr(97 + i)} goes on like{chr(97 + i)}..." for i in range(20))}
    for name, text in cases.items():
        rule = next(r for r in quality_rules.RULES if r.name == name)
        assert rule.rejects(quality_rules.Facts(text.encode(), len(text))), name
        assert not rule.rejects(quality_rules.Facts(b"A plain sentence of some words, and then one more.\nAnd an end.", 63)), name


def base_spans(text):
    kinds = {"assign": r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}
    out = []
    for order, (kind, pattern) in enumerate(kinds.items()):
        for m in re.finditer(pattern, text or ""):
            if {"assign": lambda: len(m[2]) >= 6, "access": lambda: len(m[0]) >= 20, "hex": lambda: len(m[0]) >= 24}[kind]():
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def test_secrets_equal_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    rows = queries.op9_secrets(spark, sf_dir).collect()
    assert len(rows) == len(texts) and any(r.spans for r in rows)
    for r in rows:
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("literal")] == want


def test_secret_lexing():
    code = 'part = "Zx81kQ0vLm"\nalias = part\ndb_credential = alias + "77TrQ"\ncolor = "Zx81kQ0vLm2"\n'
    found = {code[a:b] for k, a, b in secrets.spans(code)}
    assert found == {"Zx81kQ0vLm", "77TrQ"}
    assert secrets.spans("token: abc\nthe key: 12345678 note: nothing = here") == []
    text = 'x password = "hunter2hunter2" y deadbeefdeadbeefdeadbeef'
    assert secrets.redacted(text, secrets.spans(text)) == 'x [secret]" y [secret]'
    assert secrets.spans('{"privateKey": "k9Jd82mQpL0xZr"}')[0][0] == "literal"


def test_scan_equals_spans_for_every_sensitive_name(spark):
    value, many = "Zk4mQ9tXw2Lp7Rb1", "".join(map(chr, range(35, 91))) + "".join(map(chr, range(97, 127)))
    parts = sorted(secrets.SENSITIVE)
    names = [*parts, *[a + sep + b for a in parts for b in parts for sep in ("_", "-", ".")], *[a + b.title() for a in parts for b in ("x", *parts)]]
    names += [n.upper() for n in names] + [n.title() for n in parts]
    texts = [form.format(n, value) for n in names for form in ('{} = "{}"', "{}: '{}'", '"{}":"{}"', "{}={}", "{} := `{}`", "{} => {}")]
    texts += [f'{n} = "{many}"' for n in parts] + [f'"private\nkey" = "{value}"', f"passphrase \n = {value}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in secrets.scan(df).collect()}
    assert got == {i: secrets.written(secrets.spans(t)) for i, t in enumerate(texts)}
    assert all(got[texts.index(t)] for t in (f'passphrase = "{value}"', f"access.key={value}", f"api.key: '{value}'", f'key = "{many}"'))


def test_long_literals_are_masked_whole(spark):
    rng = random.Random(5)
    texts, want = [], []
    for n in (4096, 4097, 5000, 100_000, 2_000_000):
        for quote in "\"'`":
            key = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=n))
            texts.append(f"private_key_credential = {quote}{key}{quote}; x")
            want.append(f"private_key_credential = {quote}[secret]{quote}; x")
    escaped = "k\\n9\\\"QzX4Lm" * 20_000
    texts.append(f'signing_key = "{escaped}"\ncolor = 1')
    want.append('signing_key = "[secret]"\ncolor = 1')
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r.redacted for r in secrets.scan(df, redact=True).orderBy("doc_id").collect()] == want


def test_tokens_of_open_quotes_equal_a_plain_lexer_and_take_linear_time():
    plain = re.compile(
        r"""(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
        r"""|(?P<name>[A-Za-z_$][A-Za-z0-9_$.-]*)|(?P<assign>:=|=>|=(?!=)|:)|(?P<join>[+])|(?P<number>[0-9][0-9A-Za-z_./+=-]*)|(?P<end>[\n;,{}()\[\]])|(?P<other>[^\s])"""
    )
    rng = random.Random(6)
    for _ in range(20_000):
        text = "".join(rng.choices("\"'`\\\na= ", (4, 4, 2, 5, 1, 2, 2, 1), k=rng.randrange(30)))
        assert list(secrets.lexed(text)) == [(m.lastgroup, *m.span()) for m in plain.finditer(text)]
    began = time.process_time()
    for line in ('"' + '\\"' * 500_000, "'" + "\\'" * 500_000, "\\\"k\\\":\\'v\\'," * 100_000):
        assert sum(1 for _ in secrets.lexed(line)) >= 500_000
    assert time.process_time() - began < 60


def test_secrets_odd_rows(odd_docs, no_docs, texts):
    rows = secrets.scan(odd_docs, keep=["kept"], redact=True).collect()
    assert len(rows) == len(texts) and {r.doc_id for r in rows if r.redacted is None} == {1}
    assert secrets.scan(no_docs).count() == 0


def test_redaction_in_many_blocks(spark):
    secret = "password=hunter2hunter2"
    rows = [(i, None if i % 50 == 7 else f"{'filler ' * 9000}{secret if i % 3 == 0 else ''} end") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: r.redacted for r in secrets.scan(df, redact=True).collect()}
    assert got == {i: t if t is None else t.replace(secret, "[secret]") for i, t in rows}
