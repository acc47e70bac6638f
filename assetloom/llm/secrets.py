"""Secret scans by assignment-aware lexing (operator 9).

Beside three plain patterns, a text's source and configuration syntax is lexed into name-literal pairs.
Constants are carried along: a name given a literal, a name given a known name, and sums of both. A literal
that reaches a sensitive target name is scored by that name and by how random it looks; entries, tags, lines of
settings, logins in addresses and bodies of private keys are looked for beside. What a base span covers of a literal
stays with that span, the rest is a span of its own.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import output_names, text_blocks

KINDS = ("assign", "access", "hex", "literal")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")

#: How much each part of a target name says, for names cut at _, -, . and capitals.
SENSITIVE = {
    "password": 3, "passwd": 3, "pwd": 3, "pass": 3, "passphrase": 3, "passcode": 3, "secret": 3, "secrets": 3, "apikey": 3,
    "token": 2, "credential": 2, "credentials": 2, "creds": 2, "bearer": 2, "authorization": 2, "jwt": 2,
    "private": 1, "access": 1, "auth": 1, "signing": 1, "encryption": 1, "encrypt": 1, "hmac": 1, "master": 1, "client": 0.5, "key": 1, "api": 1,
}
#: A literal that is shorter, or has fewer distinct characters, or holds white space, is none whatever its name.
MIN_LENGTH, MIN_DISTINCT = 8, 5

_SAID = rf"(?i:{'|'.join(SENSITIVE)})"
#: A text without a match of this (RE2 syntax) has no span of any kind: it says where a sensitive name must stand in each form.
_MAY_HOLD = "|".join(
    (
        r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}|://[^\s/:@]*:[^\s/@]+@|-----BEGIN [A-Z ]*PRIVATE KEY-----",
        rf"(?s:{_SAID}.*[:=])|(?s:{_SAID}.*<-)",
        rf"<[^<>\s]*{_SAID}|{_SAID}[^\"'`\n]*[\"'`]+\s*,|(?:define|ENV|setenv)\s+\S*{_SAID}|-\S*{_SAID}",
    )
)

_LEX = re.compile(
    r"""(?P<string>["'`])|(?P<name>[A-Za-z_$][A-Za-z0-9_$.-]*+(?:::[A-Za-z_][A-Za-z0-9_$.-]*+)*+)|(?P<assign>:=|=>|<-|(?:[+.?]|\?\?|\|\|)?=(?!=)|:)|(?P<join>[+]|\|\||\?\?)"""
    r"""|(?P<number>[0-9][0-9A-Za-z_./+=-]*)|(?P<end>[\n;,{}()\[\]])|(?P<other>[^\s])"""
)
#: What can stand between quotes, as far as it goes.
_INSIDE = {'"': re.compile(r'(?:[^"\\\n]++|\\.)*+'), "'": re.compile(r"(?:[^'\\\n]++|\\.)*+"), "`": re.compile(r"[^`\n]*+")}
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: Letters before a quote that belong to the literal's syntax.
_PREFIX = re.compile(r"(?:[rbuf]|br|rb|fr|rf|u8|L)", re.IGNORECASE)
#: Words before a value that are no part of it, in code and in headers.
_PASSED = {"new", "await", "bearer", "basic", "token"}
#: Calls with such a word in their names fetch a value; what they are given names it.
_FETCHES = re.compile(r"get|env|read|load|fetch|find|lookup|input|param|arg|prompt|require|import", re.IGNORECASE)
#: Statements that put a value behind a name by a blank.
_DECLARES = {"define", "ENV", "setenv"}
#: A bare word of this form is an identifier.
_IDENTIFIER = re.compile(r"[a-z]+(?:_[a-z]+)*_?[0-9]?")
_BLANK, _HEADER = re.compile(r"\\?\s*"), re.compile(r"(?:bearer|basic|token) +", re.IGNORECASE)
#: An entry that says its name and then its value.
_ENTRY = re.compile(r"""\b(?:name|key)["']?\s*+[:=]\s*+["']?([A-Za-z_][A-Za-z0-9_.-]*+)["']?[\s,]++["']?value["']?\s*+[:=]\s*+["']?([^\s"'`,;(){}\[\]<>]++)""", re.IGNORECASE)
_TAG = re.compile(r"<([A-Za-z_][A-Za-z0-9_.:-]*+)[^<>]*+>\s*+([^<>\s]++)\s*+</")
_LOGIN = re.compile(r"://[^\s/:@\"'`]*+:([^\s/@\"'`]++)@")
_LINE = re.compile(r"""^[ \t]*+(?:(?:export|set|ENV|-)[ \t]++)?([A-Za-z_][A-Za-z0-9_.-]*+)([ \t]*+[=:][ \t]*+)([^\s"'`,;(){}\[\]<>$*&][^\s"'`,;(){}\[\]<>]*+)[ \t]*+$""", re.MULTILINE)
_PRIVATE = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----([^-]++)-----END")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in _HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def sensitivity(name: str) -> float:
    return sum(SENSITIVE.get(p.lower(), 0) for p in _PART.findall(name))


def randomness(value: str) -> float:
    """Bits a character, by the value's own character counts."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def score(name: str, value: str, min_length: int = MIN_LENGTH, min_distinct: int = MIN_DISTINCT) -> float:
    """Over 1: the literal is taken as a secret; 0 for short or monotonous values and those with white space."""
    if len(value) < min_length or any(c.isspace() for c in value) or len(set(value)) < min_distinct:
        return 0.0
    mixed = sum(any(f(c) for c in value) for f in (str.isdigit, str.isupper, str.islower))
    return sensitivity(name) / 2 * (randomness(value) / 3) * (1 if mixed >= 2 else 0.4)


def lexed(text: str, triple: bool = False) -> Iterator[tuple[str, int, int]]:
    """Tokens (kind, start, end), literals with their quotes; a quote that isn't closed on its line is other.

    What an open quote has passed over in vain holds no end for the same quote further on, so each kind of
    quote passes over a text once. With triple, three quotes open a literal that three close, lines further on too.
    """
    at, open_until, last_triple = 0, dict.fromkeys(_INSIDE, 0), {q: text.rfind(q * 3) if triple else -1 for q in "\"'"}
    while m := _LEX.search(text, at):
        kind, (start, at) = m.lastgroup, m.span()
        if kind == "string":
            quote, kind = m[0], "other"
            if start + 3 <= last_triple.get(quote, -1) and text.startswith(quote * 3, start):
                kind, at = "string", text.index(quote * 3, start + 3) + 3
            elif start >= open_until[quote]:
                end = _INSIDE[quote].match(text, at).end()
                if text[end : end + 1] == quote:
                    kind, at = "string", end + 1
                else:
                    open_until[quote] = end
        yield kind, start, at


class Value:
    """What a target is given: literals (value, start, end), and values of other names, which are shared and not copied."""

    __slots__ = ("parts",)

    def __init__(self) -> None:
        self.parts: list[tuple[str, int, int] | Value] = []

    def literals(self) -> list[tuple[str, int, int]]:
        """The literals that reach it, each once, in order; each value on the way is passed once."""
        out, seen, todo = {}, set(), [iter(self.parts)]
        while todo:
            part = next(todo[-1], None)
            if part is None:
                todo.pop()
            elif isinstance(part, tuple):
                out[part[1:]] = part
            elif id(part) not in seen:
                seen.add(id(part))
                todo.append(iter(part.parts))
        return list(out.values())


def _literal(word: str, start: int, end: int) -> tuple[str, int, int]:
    """A string's text and place without its quotes, blanks at the ends of a triple one, and a header's word before its value."""
    quotes = 3 if len(word) >= 6 and word[:3] in ('"""', "'''") else 1
    left, right = quotes, len(word) - quotes
    if quotes == 3:
        left = _BLANK.match(word, left, right).end()
        right = max(left, left + len(word[left:right].rstrip()))
    if head := _HEADER.match(word, left, right):
        left = head.end()
    return word[left:right], start + left, start + right


def _is_bare_literal(word: str) -> bool:
    """Whether a word without quotes can be a value: it has a digit and is neither an identifier nor a path of names."""
    if not re.search("[0-9]", word) or "::" in word or _IDENTIFIER.fullmatch(word):
        return False
    return "." not in word or not any(re.fullmatch("[a-z_]{2,}", part) for part in word.split("."))


def assignments(text: str) -> Iterator[tuple[str, Value]]:
    """Target name and its value, for each assignment in order.

    Targets are names, also with a type behind them (``a: str = x``, ``var a string = x``), quoted ones, subscripts
    (``a["b"] = x``), first arguments and members beside a literal (``f("a", x)``), names behind ``define`` and flags.
    Signs are =, :, :=, =>, <- and the compound ones. Values are literals, in one, three or other quotes, side by side
    or joined by an operator, over lines where brackets, a joint or a backslash allow it, within calls that don't fetch
    something, as defaults behind ``or``, ``||`` and ``??``, and names that were given a value before.
    """
    known: dict[str, Value] = {}
    target = last = held = None  # held: what a bracket stands behind
    value = Value()
    fresh = False  # whether the next name or literal continues the value
    typed = False  # whether what follows the target can be its type
    crossed = broken = False  # a line ended behind a sign, behind a value
    adjacent = False  # whether the token before was a literal of the value
    depth = skipped = 0  # brackets open in the value; in a call that is no part of it
    before = [("end", "\n", 0, 0)] * 3
    now = before[0]

    def close():
        nonlocal target, value, fresh, typed, crossed, broken, depth, skipped
        done = (target, value) if target and value.parts else None
        if done:
            known[target] = value
        target, value, fresh, typed, crossed, broken, depth, skipped = None, Value(), False, False, False, False, 0, 0
        return done

    def alone(part):
        own = Value()
        own.parts.append(part)
        return own

    for kind, start, end in lexed(text, triple=True):
        word = text[start:end]
        before, now = [now, *before[:2]], (kind, word, start, end)
        (kind_1, word_1, start_1, end_1), (kind_2, word_2, _, end_2), (_, word_3, _, _) = before
        body = _literal(word, start, end) if kind == "string" else (word, start, end)
        beside, adjacent = adjacent, adjacent and word == "\n"
        if kind == "string" and word_1 == "," and kind_2 == "string" and word_3 in ("(", "{", "["):
            yield _literal(word_2, 0, 0)[0], alone(body)
        elif kind_1 == "name" and (kind in ("string", "number") or kind == "name" and _is_bare_literal(word)):
            if word_2 in _DECLARES or word_2 == "-" and end_2 == start_1 and start > end_1:
                yield word_1, alone(body)
        if broken or crossed:
            stays = kind == "string" if crossed else kind == "join" or word == "."
            broken = crossed = False
            if not stays:
                if done := close():
                    yield done
                last = None
        if skipped:
            skipped += (word in "([") - (word in ")]")
            if word != "\n":
                continue
        if kind == "assign":
            if typed and not value.parts and word.endswith("=") and not (last and sensitivity(last)):
                fresh, typed, last = True, False, None
            elif last is not None:
                declared = word_2 if word_3 in ("var", "const", "let") and kind_1 == kind_2 == "name" else last
                if done := close():
                    yield done
                target, fresh, typed, last = declared, True, word == ":", None
                if word in ("+=", ".=") and target in known:
                    value.parts.append(known[target])
        elif kind == "join" or word == "." and beside:
            fresh, last = target is not None, None
        elif kind == "end" and word in "([":
            called = kind_1 == "name" and end_1 == start
            if target is not None and not fresh and called and (word == "[" or _FETCHES.search(word_1)):
                skipped = 1
            elif target is not None and (fresh or called):
                depth, fresh = depth + 1, True
            if target is not None and called and value.parts and isinstance(value.parts[-1], tuple) and value.parts[-1][1:] == (start_1, end_1):
                value.parts.pop()  # a call's name
            held, last = last, None
        elif kind == "end" and word in ")]" and depth:
            depth, fresh = depth - 1, False
        elif word == "\n" and target is not None and not skipped and (depth or fresh and value.parts or word_1 == "\\"):
            pass
        elif word == "\n" and target is not None and fresh and not typed:
            crossed = True
        elif word == "\n" and target is not None and value.parts:
            broken = True
        elif kind == "end":
            if done := close():
                yield done
            last = None
            if word == "]":
                last = held if word_1 == "[" or kind_1 == "number" else _literal(word_1, 0, 0)[0] if kind_1 == "string" and word_2 == "[" else None
        elif kind in ("string", "number", "name"):
            if kind == "string" and target is not None and kind_1 == "name" and end_1 == start and _PREFIX.fullmatch(word_1):
                fresh = True
            if target is not None and fresh:
                if kind == "name" and word.lower() in _PASSED:
                    continue
                if kind == "name" and word in known:
                    value.parts.append(known[word])
                elif kind != "name" or _is_bare_literal(word):
                    value.parts.append(body)
                fresh, last, adjacent = False, None, kind == "string"
            elif target is not None and kind == "name" and word == "or":
                fresh = True
            elif target is not None and kind == "string" and beside:
                value.parts.append(body)
                adjacent = True
            elif kind == "name" and typed and not value.parts:
                last = word
            else:
                if done := close():
                    yield done
                last = body[0] if kind != "number" else None
        elif not (word in "?!" and kind_1 == "name" and end_1 == start):
            last = None
    if done := close():
        yield done


def pairs(text: str) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """Name and literals of each pair: assignments to sensitive names, entries that hold a name and a value, lines, tags and logins of addresses."""
    for name, value in assignments(text):
        if sensitivity(name):
            yield name, value.literals()
    for m in _LINE.finditer(text):
        if _is_bare_literal(m[3]) or (not m[2].strip() == m[2] and ":" in m[2] or m[2] == "=") and not re.fullmatch("[A-Za-z_.]+", m[3]):
            yield m[1], [(m[3], *m.span(3))]
    for form in (_ENTRY, _TAG):
        for m in form.finditer(text):
            yield m[1], [(m[2], *m.span(2))]
    for m in _LOGIN.finditer(text):
        yield "password", [(m[1], *m.span(1))]


def _united(places: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Places in order, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(places):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        elif a < b:
            out.append((a, b))
    return out


def beside(places: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the places have outside of those taken; both are in order and disjoint."""
    out, k = [], 0
    for a, b in places:
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        own = k
        while own < len(taken) and taken[own][0] < b:
            if a < taken[own][0]:
                out.append((a, taken[own][0]))
            a, own = taken[own][1], own + 1
        if a < b:
            out.append((a, b))
    return out


def spans(text: str, threshold: float = 1.0) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end), by start and then kind: base ones first found, then what literals have beside them."""
    base = base_spans(text)
    found = {m.span(1) for m in _PRIVATE.finditer(text)}
    for name, literals in pairs(text):
        if sensitivity(name) and score(name, "".join(v for v, _, _ in literals)) > threshold:
            found |= {(a, b) for _, a, b in literals}
    extra = beside(_united(found), _united((a, b) for _, a, b in base))
    return sorted(base + [("literal", a, b) for a, b in extra], key=lambda s: (s[1], KINDS.index(s[0])))


def redacted(text: str, found: list[tuple[str, int, int]], mark: str = "[secret]") -> str:
    """The text with each run of overlapping spans replaced by mark."""
    out, at = [], 0
    for _, a, b in found:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def written(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, redact: bool = False) -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, comma-joined) and the columns of keep.

    With redact, a column redacted holds each text with its spans masked (null stays null). Null and empty
    texts have no span. Rows are treated one by one, so repeated rows get equal results; very long texts are
    scanned whole; an empty table gives an empty result. A column of keep may not have the name of another result
    (ValueError).
    """
    keep = list(keep or [])
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nulls = batch.column("text").is_null()
            for start, block in _numbered(text_blocks(iter([batch]))):
                texts, n = block.column("text"), len(block)
                may = pc.match_substring_regex(texts, _MAY_HOLD).to_numpy(zero_copy_only=False).nonzero()[0].tolist()
                counts, digests, all_spans = [[0] * n for _ in range(3)], [nothing] * n, [""] * n
                masked: dict[int, str] = {}
                for i in may:
                    text = texts[i].as_py()
                    found = spans(text)
                    base = [s for s in found if s[0] != "literal"]
                    for k in range(3):
                        counts[k][i] = sum(s[0] == KINDS[k] for s in base)
                    digests[i], all_spans[i] = hashlib.sha256(written(base).encode()).hexdigest(), written(found)
                    if found and redact:
                        masked[i] = redacted(text, found)
                out = [block.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), pa.array(all_spans), *block.columns[2:]]
                if redact:
                    own = nulls.slice(start, n)
                    if masked or own.true_count:
                        texts = pa.array([None if null else masked.get(i, t) for i, (null, t) in enumerate(zip(own.to_pylist(), texts.to_pylist(), strict=True))], texts.type)
                    out.append(texts)
                yield pa.RecordBatch.from_arrays(out, names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    kinds = [t for _, t in rows.dtypes]
    names = output_names([id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans"], [*keep, *["redacted"] * redact])
    types = [kinds[0], *["bigint"] * 3, "string", "string", *kinds[2:], *["string"] * redact]
    return rows.mapInArrow(run, ", ".join(f"`{a}` {b}" for a, b in zip(names, types, strict=True)))


def _numbered(blocks: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    at = 0
    for block in blocks:
        yield at, block
        at += len(block)
