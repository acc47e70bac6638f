"""Exact deduplication by counting quotient filters (operator 12).

1. Texts are normalised (runs of ASCII white space become one space) and get a 64-bit fingerprint and a SHA-256.
2. Each partition builds counting quotient filters over its fingerprints, one for each range of leading bits.
   A filter stores a fingerprint as quotient and remainder: remainders lie in slots sorted by both, `occupied` marks
   the quotients that have a run of slots, `run_ends` the last slot of each run, and counts above one lie beside
   their slots. Nothing of a fingerprint is lost, so filters merge by their sorted remainders, adding counts. The
   filters of one range meet in one task; ranges are as many as the rows need, so a merged filter has a bounded size,
   and a partition brings a fingerprint once, however many rows have it.
3. Fingerprints with a count above one route their rows to byte verification: whole normalised texts are grouped,
   copies within a partition before their shuffle. Only groups of equal bytes with two rows or more remain.
4. Rows find their group by the SHA-256 of their own text.

A fingerprint with more than one in 10,000 of the rows (and over 1,000) is hot. There are 10,000 of these at most, so they
are broadcast, and no shuffle of rows is keyed by them.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import output_names, through_table

_HEAD = struct.Struct("<BBII")
#: Fingerprints a range holds about, and those that a task keeps before it writes its filters.
RANGE_ROWS, TASK_ROWS = 1 << 20, 1 << 22
#: Bytes that groups may take to be broadcast, once counted.
BROADCAST_BYTES = 4_000_000


def normalised(text: Column | str) -> Column:
    """Runs of ASCII white space become one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def encode_filter(low: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A counting quotient filter of distinct ascending fingerprints of so many bits, about one slot a quotient."""
    n = len(low)
    q = min(bits, max(0, (n - 1).bit_length())) if n else 0
    rest = bits - q
    quotient = (low >> np.uint64(rest)).astype(np.int64) if q else np.zeros(n, np.int64)
    remainder = low & np.uint64((1 << rest) - 1)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    run_ends = np.append(quotient[1:] != quotient[:-1], np.ones(min(n, 1), bool))
    slots = np.ascontiguousarray(remainder.astype("<u8").view(np.uint8).reshape(n, 8)[:, : (rest + 7) // 8])
    many = np.flatnonzero(counts > 1)
    return b"".join([_HEAD.pack(bits, q, n, len(many)), np.packbits(occupied).tobytes(), np.packbits(run_ends).tobytes(), slots.tobytes(), many.astype("<u4").tobytes(), counts[many].astype("<u8").tobytes()])


def decode_filter(stored: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Fingerprints in ascending order, their counts, and the bits of a fingerprint."""
    bits, q, n, n_many = _HEAD.unpack_from(stored)
    rest, at = bits - q, _HEAD.size

    def take(kind: type | str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(stored, kind, count, at)
        at += out.nbytes
        return out

    occupied = np.flatnonzero(np.unpackbits(take(np.uint8, ((1 << q) + 7) // 8), count=1 << q))
    run_ends = np.unpackbits(take(np.uint8, (n + 7) // 8), count=n)
    width = (rest + 7) // 8
    slots = np.zeros((n, 8), np.uint8)
    slots[:, :width] = take(np.uint8, n * width).reshape(n, width)
    run = np.cumsum(run_ends) - run_ends  # runs that ended before a slot
    low = slots.view("<u8").ravel().astype(np.uint64)
    if q and n:
        low |= occupied[run].astype(np.uint64) << np.uint64(rest)
    counts = np.ones(n, np.uint64)
    many = take("<u4", n_many)
    counts[many] = take("<u8", n_many)
    return low, counts, bits


def merge_filters(stored: list[bytes]) -> bytes:
    """One filter of filters over the same range: slots are merged in order, counts of equal remainders added."""
    parts = [decode_filter(s) for s in stored]
    low, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(low, kind="stable")  # merges the sorted runs
    low, counts = low[order], counts[order]
    starts = np.flatnonzero(np.append(np.ones(min(len(low), 1), bool), low[1:] != low[:-1]))
    return encode_filter(low[starts], np.add.reduceat(counts, starts) if len(starts) else counts, parts[0][2])


def filters(rows: DataFrame, n_rows: int, range_rows: int = RANGE_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """(range, filter): merged counting quotient filters over the column fp, by leading bits of it."""
    spark = rows.sparkSession
    wanted = max(n_rows / range_rows, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows / 1024), 1)
    lead = min(24, int(np.ceil(np.log2(wanted))))
    bits = 64 - lead

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def written() -> pa.RecordBatch:
            fp, counts = np.unique(np.concatenate(held), return_counts=True)
            ranges = (fp >> np.uint64(bits)).astype(np.int64) if lead else np.zeros(len(fp), np.int64)
            own, starts = np.unique(ranges, return_index=True)
            low = fp & np.uint64((1 << bits) - 1)
            made = [encode_filter(low[a:b], counts[a:b], bits) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(fp)], strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(made, pa.binary())], ["range", "filter"])

        for batch in batches:
            if len(batch):
                held.append(batch.column(0).to_numpy().view(np.uint64))
            if sum(map(len, held)) >= task_rows:
                yield written()
        if held:
            yield written()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"range": group["range"].iloc[:1].to_numpy(), "filter": [merge_filters(group["filter"].tolist())]})

    return rows.select("fp").mapInArrow(build, "range bigint, filter binary").groupBy("range").applyInPandas(merge, "range bigint, filter binary")


def repeated(merged: DataFrame) -> DataFrame:
    """(fp, n): the fingerprints that merged filters count more than once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lead, stored in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                low, counts, bits = decode_filter(stored)
                fp = low[counts > 1] | np.uint64(lead << bits if bits < 64 else 0)
                yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(counts[counts > 1].astype(np.int64))], ["fp", "n"])

    return merged.mapInArrow(read, "fp bigint, n bigint")


def _hot(keyed: DataFrame, n_rows: int) -> Column:
    """More rows than one in 10,000 of all and than 1,000: true of 10,000 keys at most."""
    return F.col("n") > max(1000, n_rows // 10_000)


def routed(texts: DataFrame, suspects: DataFrame, n_rows: int, n_suspects: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of texts (fp, ..) whose fingerprint repeats."""
    if 16 * n_suspects <= max_bytes:
        return texts.join(F.broadcast(suspects), "fp", "left_semi")
    hot = F.broadcast(suspects.where(_hot(suspects, n_rows)).select("fp"))
    cold = suspects.where(~_hot(suspects, n_rows)).select("fp")
    return texts.join(hot, "fp", "left_semi").unionByName(texts.join(hot, "fp", "left_anti").join(cold, "fp", "left_semi"))


def verified(texts: DataFrame) -> DataFrame:
    """(fp, sha, keep_id, n) of each group of two rows or more (id, fp, body) with the same bytes; keep_id is its smallest id."""
    groups = texts.groupBy("fp", "body").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return groups.select("fp", F.unhex(F.sha2(F.col("body").cast("binary"), 256)).alias("sha"), "keep_id", "n")


def with_groups(rows: DataFrame, groups: DataFrame, n_rows: int, n_groups: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """rows (fp, sha, ..) with keep_id and n of their group, null where they have none."""
    if 80 * n_groups <= max_bytes:
        return rows.join(F.broadcast(groups), ["fp", "sha"], "left")
    hot, cold = (F.broadcast(groups.where(_hot(groups, n_rows))), groups.where(~_hot(groups, n_rows)))
    found = rows.join(hot.toDF("fp", "sha", "hot_id", "hot_n"), ["fp", "sha"], "left")
    # a row that has found its group goes to any task: it looks for nothing, under a key of its own
    key = F.when(F.col("hot_n").isNull(), F.col("fp")).otherwise(F.xxhash64("id", "sha"))
    own = F.when(F.col("hot_n").isNull(), F.col("sha"))
    out = found.withColumn("to_fp", key).withColumn("to_sha", own).join(cold.toDF("to_fp", "to_sha", "cold_id", "cold_n"), ["to_fp", "to_sha"], "left")
    return out.select(*rows.columns, F.coalesce("hot_id", "cold_id").alias("keep_id"), F.coalesce("hot_n", "cold_n").alias("n"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """id, keep_id, group_size, kept and text_sha256 of each row.

    Texts are equal if their normal forms are; keep_id is the smallest id of a group, and kept says id = keep_id. Null
    texts equal empty ones. Rows with a null id count in group_size; they are not kept beside a row with an id, and in a
    group without any id keep_id is null and all are kept. Rows that repeat an id are rows of their own: of one text, they
    are all kept if theirs is the smallest id. Very long texts are read whole; an empty table gives an empty result.
    Other columns, of any name, are not read.
    """
    return _copies(docs, id_col, text_col, max_bytes).select(F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"), "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def _copies(docs: DataFrame, id_col: str, text_col: str, max_bytes: int) -> DataFrame:
    """(id, fp, sha, keep_id, n, kept) of each row."""
    texts = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("body")).select("id", "body", F.xxhash64("body").alias("fp"))
    rows = through_table(texts.select("id", "fp", F.unhex(F.sha2(F.col("body").cast("binary"), 256)).alias("sha")), "fingerprints")
    n_rows = rows.count()
    suspects = through_table(repeated(through_table(filters(rows, n_rows), "filters")), "repeated")
    groups = through_table(verified(routed(texts, suspects, n_rows, suspects.count(), max_bytes)), "groups")
    out = with_groups(rows, groups, n_rows, groups.count(), max_bytes)
    out = out.select("id", "fp", "sha", F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).alias("n"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull()))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of docs that stay, with all their columns: of equal texts the one with the smallest id.

    Cases are those of `copies`, but of rows that repeat id and text one stays, whichever; rows without an id stay
    where their group has no id.
    """
    own = ["_body", "_fp", "_sha"]
    names = output_names(own, docs.columns)[len(own) :]
    judged = through_table(_copies(docs, id_col, text_col, max_bytes).select("id", "fp", "sha", "kept"), "judged")
    gone = judged.where("not kept").select("id", "fp", "sha").distinct()
    twice = judged.where("kept and id is not null").groupBy("id", "fp", "sha").count().where("count > 1").drop("count")
    body = docs.withColumn("_body", normalised(text_col))
    keyed = body.withColumn("_fp", F.xxhash64("_body")).withColumn("_sha", F.unhex(F.sha2(F.col("_body").cast("binary"), 256)))

    def same(rows: DataFrame) -> Column:
        return keyed[id_col].eqNullSafe(rows["id"]) & (keyed["_fp"] == rows["fp"]) & (keyed["_sha"] == rows["sha"])

    left = keyed.join(gone, same(gone), "left_anti")
    if twice.head(1):
        one = left.join(twice, same(twice), "left_semi").dropDuplicates([id_col, "_fp", "_sha"])
        left = left.join(twice, same(twice), "left_anti").unionByName(one)
    return left.select(*names)
