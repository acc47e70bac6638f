"""Chat formatting of heterogeneous layouts, chosen by schema fingerprints (operator 2).

A layout's fingerprint is the hash of its sorted nested field paths, as far as some mapping names them. A registry maps
fingerprints to declarative mappings, which say where role and text of each turn are found. Canonical turns are written as

    <|im_start|>role newline text <|im_end|> newline

with control strings inside texts escaped: each run "<", backslashes, "|" gets one backslash more, so no text
can open or close a turn, and removing one backslash restores it.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


@dataclass(frozen=True)
class Mapping:
    """Where turns are: one after the other in `fields` (role, path), then in the lists at `turns` (fields role and text).

    A record has all `paths` and may have some of `optional`; paths that no mapping of a registry names don't matter.
    Texts may be lists of parts, whose texts are put together.
    """

    paths: tuple[str, ...]
    turns: str | tuple[str, ...] | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    join: tuple[str, ...] = ()  #: roles of neighbouring turns that are put together, parted by a blank line
    optional: tuple[str, ...] = ()

    @property
    def lists(self) -> tuple[str, ...]:
        return (self.turns,) if isinstance(self.turns, str) else self.turns or ()

    def layouts(self) -> Iterator[tuple[str, ...]]:
        """All path sets that it is meant for."""
        for n in range(len(self.optional) + 1):
            for some in itertools.combinations(self.optional, n):
                yield (*self.paths, *some)


#: Role names of known layouts and their canonical names.
ROLES = {"human": "user", "prompter": "user", "user": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "assistant": "assistant", "system": "system"}

def _messages(at: str) -> tuple[str, ...]:
    """Forms of a list of messages beside their roles: plain texts, parts, parts that are plain texts, parts with a kind."""
    return f"{at}[].content", f"{at}[].content[]", f"{at}[].content[].text", f"{at}[].content[].type"


_SYSTEM = (("system", "system"),)
MAPPINGS = (
    Mapping(("messages[].role",), turns="messages", fields=_SYSTEM, optional=(*_messages("messages"), "system")),
    Mapping(("messages[]",), turns="messages", fields=_SYSTEM, optional=("system",)),
    Mapping(("conversations[].from", "conversations[].value"), turns="conversations", role="from", text="value", fields=_SYSTEM, optional=("system",)),
    Mapping(("conversations[].role",), turns="conversations", fields=_SYSTEM, optional=(*_messages("conversations"), "system")),
    Mapping(("conversations[]",), turns="conversations", fields=_SYSTEM, optional=("system",)),
    Mapping(("prompt", "response"), fields=(*_SYSTEM, ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping(("prompt", "completion"), fields=(*_SYSTEM, ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Mapping(("prompt", "chosen"), fields=(*_SYSTEM, ("user", "prompt"), ("assistant", "chosen")), optional=("system", "rejected")),
    Mapping(("chosen[].role",), turns="chosen", optional=(*_messages("chosen"), "prompt", "rejected[].role", "rejected[].content")),
    Mapping(("prompt[].role", "prompt[].content", "chosen[].role", "chosen[].content"), turns=("prompt", "chosen"), optional=("rejected[].role", "rejected[].content")),
    Mapping(("prompt[].role", "prompt[].content", "completion[].role", "completion[].content"), turns=("prompt", "completion")),
    Mapping(("question", "answer"), fields=(*_SYSTEM, ("user", "question"), ("assistant", "answer")), optional=("system",)),
    Mapping(("instruction", "output"), fields=(*_SYSTEM, ("user", "instruction"), ("user", "input"), ("assistant", "output")), join=("user",), optional=("system", "input")),
)


def paths_of(value: object, at: str = "") -> set[str]:
    """Nested field paths of a parsed record; a list adds [] to its path."""
    if isinstance(value, dict):
        return set().union(*[paths_of(v, f"{at}.{k}" if at else k) for k, v in value.items()]) if value else {at}
    if isinstance(value, list):
        return set().union(*[paths_of(v, f"{at}[]") for v in value]) if value else {f"{at}[]"}
    return {at}


def paths_of_schema(kind: T.DataType, at: str = "") -> set[str]:
    if isinstance(kind, T.StructType):
        return set().union(*[paths_of_schema(f.dataType, f"{at}.{f.name}" if at else f.name) for f in kind.fields]) if kind.fields else {at}
    if isinstance(kind, T.ArrayType):
        return paths_of_schema(kind.elementType, f"{at}[]")
    return {at}


def fingerprint(paths: set[str] | tuple[str, ...]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


REGISTRY = {fingerprint(p): m for m in MAPPINGS for p in m.layouts()}


def chosen(paths: Iterable[str], registry: dict[str, Mapping] = REGISTRY) -> tuple[Mapping, str] | None:
    """The mapping for records of these paths, and the field that all of it is wrapped in, if any.

    Paths that no mapping names are left out, and the fingerprint of the rest chooses. If none is registered, the same is
    tried below each field of the record, in order of name.
    """
    named = {p for m in registry.values() for p in (*m.paths, *m.optional)}
    paths = set(paths)
    heads = sorted({p.split(".", 1)[0] for p in paths if "." in p and "[]" not in p.split(".", 1)[0]})
    for head in ("", *heads):
        own = {p[len(head) + 1 :] for p in paths if p.startswith(f"{head}.")} if head else paths
        mapping = registry.get(fingerprint(own & named))
        if mapping is not None:
            return mapping, head
    return None


def _at(record: object, path: str) -> object:
    """What stands at a dotted path, or at a field of that very name; None if nothing does."""
    if isinstance(record, dict) and path in record:
        return record[path]
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _said(value: object) -> str:
    """A text, or the texts of its parts put together; parts of other kinds (images, calls) say nothing."""
    if isinstance(value, list):
        return "".join(_said(part.get("text") if isinstance(part, dict) else part) for part in value)
    return "" if value is None or isinstance(value, dict) else str(value)


def canonical_turns(record: dict, mapping: Mapping, wrapper: str = "") -> list[tuple[str, str]]:
    """(role, text) of a record's turns; missing and null texts of single fields are left out, others become empty."""
    inner = _at(record, wrapper) if wrapper else record
    turns = [(role, text) for role, path in mapping.fields if (text := _said(_at(inner, path)))]
    for at in mapping.lists:
        for row in _at(inner, at) or []:
            role = _said(_at(row, mapping.role))
            turns.append((ROLES.get(role.lower(), role), _said(_at(row, mapping.text))))
    out: list[tuple[str, str]] = []
    for role, text in turns:
        if out and role in mapping.join and out[-1][0] == role:
            out[-1] = (role, f"{out[-1][1]}\n\n{text}")
        else:
            out.append((role, text))
    return out


def turns_from_json(records: DataFrame, id_col: str, json_col: str, registry: dict[str, Mapping] = REGISTRY) -> DataFrame:
    """(id, fingerprint, turn, role, text) rows of JSON records of any registered layout.

    A record that isn't a JSON object, has an unknown layout or no turns gives one row with a null turn, so that it can
    be counted and mapped later; its fingerprint is empty or names the whole layout. Fields that no mapping names don't
    matter, and a known layout may be wrapped in one field. Repeated rows are treated alike; an empty table gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layouts: dict[frozenset[str], tuple[str, tuple[Mapping, str] | None]] = {}  # of the last few path sets
        for batch in batches:
            out: list[tuple] = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    record = json.loads(text or "")
                except ValueError:
                    record = None
                mark, turns = "", []
                if isinstance(record, dict):
                    paths = frozenset(paths_of(record))
                    if paths not in layouts:
                        if len(layouts) >= 1000:
                            layouts.clear()
                        layouts[paths] = fingerprint(paths), chosen(paths, registry)
                    mark, way = layouts[paths]
                    turns = canonical_turns(record, *way) if way else []
                out += [(row, mark, k, *turn) for k, turn in enumerate(turns)] or [(row, mark, None, None, None)]
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [batch.schema.field(0).type, pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    rows = records.select(F.col(id_col), F.col(json_col))
    names = [id_col, "fingerprint", "turn", "role", "text"]
    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, fingerprint string, turn bigint, role string, text string")


def _column(path: str) -> Column:
    """The column at a dotted path, whatever characters its names hold."""
    return F.col(".".join(f"`{name}`" for name in path.split(".")))


def turns_from_records(records: DataFrame, id_col: str, registry: dict[str, Mapping] = REGISTRY) -> DataFrame:
    """(id, turn, role, text) rows of a table whose columns beside the id are one registered layout of nested records.

    The fingerprint is that of the schema's nested paths, so one mapping serves all rows and Spark's own functions
    do the work. Turns are numbered and treated as turns_from_json does: null and empty single fields are left
    out, other nulls become empty texts; a record without turns gives no row. ValueError if no layout fits.
    """
    kind = T.StructType([f for f in records.schema.fields if f.name != id_col])
    have = paths_of_schema(kind)
    way = chosen(have, registry)
    if way is None:
        raise ValueError(f"no layout is registered for {sorted(have)}")
    mapping, wrapper = way
    inside = f"{wrapper}." if wrapper else ""

    def kind_at(path: str) -> T.DataType | None:
        """The type at a dotted path, through lists; None if the schema has no such field."""
        at: T.DataType | None = kind
        for name in (inside + path).split("."):
            while isinstance(at, T.ArrayType):
                at = at.elementType
            at = next((f.dataType for f in at.fields if f.name == name), None) if isinstance(at, T.StructType) else None
        return at

    def said(value: Column, of: T.DataType | None) -> Column:
        """_said, for a column."""
        if of is None or isinstance(of, T.StructType):
            return F.lit("")
        if isinstance(of, T.ArrayType):
            part = of.elementType
            texts = F.transform(value, lambda p: F.coalesce(said(p["text"], next((f.dataType for f in part.fields if f.name == "text"), None)) if isinstance(part, T.StructType) else said(p, part), F.lit("")))
            return F.array_join(texts, "")
        return value.cast("string")

    def turn(role: Column, text: Column) -> Column:
        return F.struct(F.coalesce(role.cast("string"), F.lit("")).alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))

    def known(role: Column) -> Column:
        names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
        return F.coalesce(F.try_element_at(names, F.lower(role)), role)

    def message(of: T.DataType | None) -> Callable[[Column], Column]:
        return lambda t: turn(known(t[mapping.role]), said(t[mapping.text], of) if of is not None else F.lit(""))

    empty = F.array().cast("array<struct<role:string,text:string>>")
    single = [turn(F.lit(role), said(_column(inside + path), of)) for role, path in mapping.fields if (of := kind_at(path)) is not None]
    turns = F.filter(F.array(*single), lambda t: t["text"] != "") if single else empty
    for at in mapping.lists:
        if isinstance(rows_of := kind_at(at), T.ArrayType) and isinstance(rows_of.elementType, T.StructType):
            listed = F.transform(_column(inside + at), message(kind_at(f"{at}.{mapping.text}")))
            turns = F.concat(turns, F.coalesce(listed, empty))

    def put(told: Column, one: Column) -> Column:
        last = F.try_element_at(told, F.lit(-1))
        both = turn(one["role"], F.concat(last["text"], F.lit("\n\n"), one["text"]))
        meet = one["role"].isin(*mapping.join) & (last["role"] == one["role"])
        return F.when(meet, F.concat(F.slice(told, 1, F.size(told) - 1), F.array(both))).otherwise(F.concat(told, F.array(one)))

    if mapping.join:
        turns = F.aggregate(turns, empty, put)
    rows = records.select(F.col(id_col), F.posexplode(turns).alias("turn", "own"))
    return rows.select(id_col, F.col("turn").cast("bigint").alias("turn"), "own.role", "own.text")


#: Layouts of tables with one row a turn: columns of conversation, order, role and text.
ROW_LAYOUTS = {
    fingerprint(p): p
    for p in (("conv_id", "turn", "role", "text"), ("conversation_id", "turn", "role", "content"), ("conversation_id", "message_number", "from", "value"), ("dialogue_id", "position", "speaker", "utterance"))
}


def turns_from_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of a table with one row a turn, whose schema's fingerprint is registered.

    Columns beside those of a layout don't matter. Nulls, empty texts and repeated rows are handed on as they are, and
    an empty table gives no row. ValueError if no layout fits.
    """
    have = paths_of_schema(rows.schema)
    mark = fingerprint(have)
    layout = ROW_LAYOUTS.get(mark) or next((p for p in ROW_LAYOUTS.values() if set(p) <= have), None)
    if layout is None:
        raise ValueError(f"no layout is registered for {sorted(have)}")
    return rows.select(*[F.col(c).alias(n) for c, n in zip(layout, ("conv_id", "turn", "role", "text"), strict=True)])


def escape(text: str) -> str:
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _role_out(role: str) -> str:
    return role.replace("%", "%25").replace("\n", "%0A").replace("<", "%3C")


def _role_in(role: str) -> str:
    return role.replace("%3C", "<").replace("%0A", "\n").replace("%25", "%")


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text starts and ends in it."""
    head, body = f"{START}{_role_out(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def format_turns(turns: DataFrame, part_chars: int = 1_000_000, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, part, formatted, loss) of (conv_id, turn, role, text) rows.

    loss lists start and end, in code points of formatted, of each text that is trained on. Turns are in order
    of turn, then role and text (repeated rows stay); null roles and texts are empty; null conv_ids make one
    conversation. A conversation comes in parts of about part_chars, each of whole turns, so the task that
    streams through it holds one part at a time, however long it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        own, part, text, loss, size, held, begun = None, 0, [], [], 0, 0, False

        def flush() -> None:
            nonlocal part, text, loss, size
            if text:
                out.append((own, part, "".join(text), loss))
                part, text, loss, size = part + 1, [], [], 0

        for batch in batches:
            id_kind = batch.schema.field(0).type
            for conv, role, body in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if not begun or conv != own:
                    flush()
                    own, part, begun = conv, 0, True
                written, a, b = render(role or "", body or "")
                if (role or "") in loss_roles:
                    loss += [size + a, size + b]
                text.append(written)
                size += len(written)
                held += len(written)
                if size >= part_chars:
                    flush()
            if held > 8 * part_chars or len(out) > 5000:
                yield _rows(out, [("conv_id", id_kind), *kinds])
                out, held = [], 0
        flush()
        if out:
            yield _rows(out, [("conv_id", id_kind), *kinds])

    rows = turns.select("conv_id", "turn", "role", "text")
    id_type = dict(rows.dtypes)["conv_id"]
    kinds = [("part", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(pa.int64()))]
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, f"conv_id {id_type}, part bigint, formatted string, loss array<bigint>")


def _rows(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])


def read_part(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of a formatted part; ValueError if it isn't whole turns."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        out.append((_role_in(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("text outside of turns")
    return out


def summarise(formatted: DataFrame, in_order: bool = False) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from format_turns' rows.

    Digests go on from part to part, so memory doesn't grow with a conversation. in_order says that the rows come
    straight from format_turns, so nothing is shuffled; otherwise, as when they are read from files, they are
    dealt and sorted first. Parts that don't follow each other are a ValueError. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        own, begun, part_no = None, False, 0
        n, chars, loss_n, turns, losses = 0, 0, 0, hashlib.sha256(), hashlib.sha256()

        def close() -> None:
            if begun:
                out.append((own, n, turns.hexdigest(), loss_n, losses.hexdigest(), chars))

        for batch in batches:
            id_kind = batch.schema.field(0).type
            for conv, part, text, loss in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if part != (following := part_no + 1 if begun and conv == own else 0):
                    raise ValueError(f"part {part} of a conversation where {following} should follow")
                part_no = part
                if part == 0:
                    close()
                    own, begun = conv, True
                    n, chars, loss_n, turns, losses = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, body in read_part(text):
                    n += 1
                    turns.update(f"{role}\n{body}\n".encode())
                for a, b in zip(loss[::2], loss[1::2], strict=True):
                    body = unescape(text[a:b])
                    loss_n += len(body)
                    losses.update(body.encode())
                chars += len(text)
            if len(out) > 5000:
                yield _rows(out, [("conv_id", id_kind), *kinds])
                out = []
        close()
        if out:
            yield _rows(out, [("conv_id", id_kind), *kinds])

    formatted = formatted.select("conv_id", "part", "formatted", "loss")
    if not in_order:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    id_type = dict(formatted.dtypes)["conv_id"]
    kinds = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    return formatted.mapInArrow(run, f"conv_id {id_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
