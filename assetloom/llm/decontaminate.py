"""Benchmark decontamination with Aho-Corasick automata over normalised items (operator 4).

Normal form: A-Z lowered, then words of ASCII digits, letters and all non-ASCII characters, joined by one
space. Every run of `window` item words (a shorter item: all its words) is a pattern. A document is scanned
once; matches are carried back to word numbers and to code-point offsets in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import output_names, text_blocks

_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def automaton(items: list[tuple[str, str]], window: int):
    """Of (item id, text) rows; each pattern's value is its length and the ids of its items. None without patterns."""
    import ahocorasick

    owners: dict[str, set[str]] = {}
    for item, text in items:
        found = words((text or "").encode())
        for i in range(max(1, len(found) - window + 1) if found else 0):
            owners.setdefault((b" %b " % b" ".join(found[i : i + window])).decode("latin-1"), set()).add(item)
    if not owners:
        return None
    out = ahocorasick.Automaton()
    for pattern, ids in owners.items():
        out.add_word(pattern, (len(pattern), tuple(sorted(ids))))
    out.make_automaton()
    return out


@lru_cache(2)
def _built(items: tuple[tuple[str, str], ...], window: int):
    return automaton(list(items), window)


def matches(text: str, found: list[tuple[int, tuple[int, tuple[str, ...]]]]) -> tuple[list[tuple[int, int]], list[str]]:
    """Word ranges [first, end) hit in a normalised text, merged, and the items that occur."""
    spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
    ends = np.array([e for e, _ in found])
    starts = ends - np.array([n for _, (n, _) in found]) + 1
    spans = sorted(zip(np.searchsorted(spaces, starts).tolist(), np.searchsorted(spaces, ends).tolist(), strict=True))
    return merged(spans), sorted({i for _, (_, ids) in found for i in ids})


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def item_groups(items: DataFrame, id_col: str, text_col: str, max_bytes: int) -> list[Broadcast]:
    """The items in broadcasts of about max_bytes each: their size is measured first, and more bytes make more groups."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = int(size // max_bytes) + 1
    spark = items.sparkSession
    groups = []
    for k in range(n):
        own = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        groups.append(spark.sparkContext.broadcast(tuple(sorted(tuple(r) for r in own.distinct().collect()))))
    return groups


def scan(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None, max_bytes: int = 8_000_000) -> DataFrame:
    """id, n_words, n_hit, items array<string> (sorted), spans array<struct<start, end>> and the columns of keep, for each row.

    spans are code points of the original text, from the first to the last word of each merged run of hit
    words. A null or empty text has no words. Items without words match nothing; equal item ids count once. Rows
    are scanned one by one and whole, however long; repeated rows and ids get equal results; an empty table gives
    an empty result. A column of keep may not have the name of another result (ValueError).
    One automaton serves a set of items of up to max_bytes; larger sets get several, which the same pass
    applies one after the other, so no table of unknown size is broadcast and rows are never shuffled.
    """
    keep = list(keep or [])

    def stage(group: Broadcast, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = _built(group.value, window)
            for block in text_blocks(batches):
                texts, spans, names, n_words = block.column("text"), block.column("words").to_pylist(), block.column("items").to_pylist(), []
                for i, text in enumerate(texts.cast(pa.binary()).to_pylist()):
                    found = words(text)
                    n_words.append(len(found))
                    normal = (b" %b " % b" ".join(found)).decode("latin-1")
                    if own is not None and (hits := list(own.iter(normal))):
                        more, ids = matches(normal, hits)
                        spans[i] = [x for ab in merged([*zip(spans[i][::2], spans[i][1::2], strict=True), *more]) for x in ab]
                        names[i] = sorted({*names[i], *ids})
                items = pa.array(names, pa.list_(pa.string()))
                if last:
                    n_hit = [sum(flat[1::2]) - sum(flat[::2]) for flat in spans]
                    yield pa.RecordBatch.from_arrays([block.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), items, places(texts, spans), *block.columns[4:]], out_names)
                else:
                    yield pa.RecordBatch.from_arrays([*block.columns[:2], pa.array(spans, pa.list_(pa.int32())), items, *block.columns[4:]], block.schema.names)

        return run

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.array().cast("array<int>").alias("words"), F.array().cast("array<string>").alias("items"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    kinds = [t for _, t in rows.dtypes]
    out_names = output_names([id_col, "n_words", "n_hit", "items", "spans"], keep)
    types = [kinds[0], "bigint", "bigint", "array<string>", "array<struct<start:int,end:int>>", *kinds[4:]]
    groups = item_groups(items, item_col, item_text_col, max_bytes)
    for group in groups[:-1]:
        rows = rows.mapInArrow(stage(group, False), rows.schema)
    return rows.mapInArrow(stage(groups[-1], True), ", ".join(f"`{a}` {b}" for a, b in zip(out_names, types, strict=True)))


def places(texts: pa.Array, spans: list[list[int]]) -> pa.Array:
    """Code-point ranges in the original texts of flat lists of word ranges."""
    out = []
    for i, flat in enumerate(spans):
        at = [m.span() for m in _WORD.finditer(texts[i].as_py())] if flat else []
        out.append([{"start": at[a][0], "end": at[b - 1][1]} for a, b in zip(flat[::2], flat[1::2], strict=True)])
    return pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
