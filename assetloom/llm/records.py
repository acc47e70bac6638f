"""Token-id output as length-delimited binary records with a separate offset index (operator 10).

A data file is a run of frames: payload length (unsigned 64-bit), masked checksum of those eight bytes
(unsigned 32-bit), payload, masked checksum of the payload. The payload is the row's id (signed 64-bit,
its lowest value for null), the bytes of a token id (one byte: 2, or 4 if an id of the row needs more) and
the unsigned token ids. All numbers are little-endian. The
checksum is crc32, rotated right by 15 bits plus a constant, so that checksums of data that hold
checksums stay sound. The index file has 24 bytes a record: row id, offset of the frame, its length.

Files are written by path with a fresh name per task attempt; only those that the manifest names count,
so a lost or repeated attempt leaves no wrong record.
"""

from __future__ import annotations

import itertools
import random
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import PieceCache, may_be_cut, shared_folder, single_threaded, text_blocks, through_table

MASK_DELTA = 0xA282EAD8
NULL_ID = -(1 << 63)
HEAD, INDEX = struct.Struct("<QI"), np.dtype([("id", "<i8"), ("offset", "<u8"), ("length", "<u8")])
MANIFEST = "part int, data string, index string, n_records bigint, n_ids bigint, n_bytes bigint"


def masked(data: bytes | memoryview) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(data: memoryview, at: int = 0) -> tuple[memoryview, int]:
    """Payload of the frame at a place and where the next frame is; ValueError if a checksum is wrong."""
    size, check = HEAD.unpack_from(data, at)
    if masked(data[at : at + 8]) != check:
        raise ValueError(f"the length at byte {at} is damaged")
    body = at + HEAD.size
    payload = data[body : body + size]
    if len(payload) != size or masked(payload) != struct.unpack_from("<I", data, body + size)[0]:
        raise ValueError(f"the record at byte {at} is damaged")
    return payload, body + size + 4


#: Bytes of text that a file is made of about.
PART_BYTES = 256_000_000


def payload(row: int, ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return struct.pack("<qB", row, width) + ids.astype(f"<u{width}").tobytes()


def parsed(data: memoryview) -> tuple[int, np.ndarray]:
    """Row id and token ids (unsigned 32-bit) of a payload."""
    row, width = struct.unpack_from("<qB", data)
    return row, np.frombuffer(data[9:], f"<u{width}").astype("<u4")


@lru_cache(1)
def library_encoder(path: str) -> PieceCache:
    """Encoder of a tokenizers file, for lists of texts; added tokens are found in texts as the library finds them."""
    single_threaded()
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)

    def run(fresh: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = [e.ids for e in own.encode_batch_fast(fresh, add_special_tokens=False)]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.fromiter(itertools.chain.from_iterable(rows), np.uint32, int(lengths.sum())), lengths

    before = own.pre_tokenizer
    split = lambda text: [token for token, _ in before.pre_tokenize_str(text)]
    added = [t.content for t in own.get_added_tokens_decoder().values()]
    return PieceCache(run, added=added, cut=own.normalizer is None and before is not None and may_be_cut(split))


def write(docs: DataFrame, path: str, folder: str | None = None, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None, encode: Callable = library_encoder) -> DataFrame:
    """Encode each text, append end_id, and write records in ascending id order; returns the manifest.

    Rows are dealt by ranges of the id, and equal ids by their text, so every task writes one file of its
    range; ranges are as many as the texts' bytes need, if parts doesn't say. Null ids come first, a null text
    is empty, repeated rows are repeated records, and an empty table gives an empty manifest. ids must be integers.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "records")
    if parts is None:
        size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, name, out, index, at, n_ids, n = TaskContext.get().partitionId(), uuid.uuid4().hex, None, None, 0, 0, 0
        store, base = fs.FileSystem.from_uri(folder)
        for block in text_blocks(batches):
            if out is None:
                store.create_dir(base, recursive=True)
                out, index = (store.open_output_stream(f"{base}/{part:06d}-{name}.{kind}") for kind in ("rec", "idx"))
            ids, edges = encode(path).encode(block.column("text"))
            rows, edges, frames, entries = block.column("id").to_pylist(), edges.tolist(), [], []
            tail = np.array([] if end_id is None else [end_id], np.uint32)
            for i, row in enumerate(rows):
                own = np.concatenate([ids[edges[i] : edges[i + 1]], tail])
                frames.append(frame(payload(NULL_ID if row is None else row, own)))
                entries.append((NULL_ID if row is None else row, at, len(frames[-1])))
                at += len(frames[-1])
                n_ids += len(own)
            out.write(b"".join(frames))
            index.write(np.array(entries, INDEX).tobytes())
            n += len(rows)
        if out is not None:
            out.close()
            index.close()
            where = f"{folder}/{part:06d}-{name}"
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "data": [where + ".rec"], "index": [where + ".idx"], "n_records": [n], "n_ids": [n_ids], "n_bytes": [at]})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    dealt = rows.repartitionByRange(parts, "id").sortWithinPartitions("id", "text")
    return through_table(dealt.mapInArrow(run, MANIFEST), "manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """Adds start: ids in all files before. The manifest has one row a file."""
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("start", F.coalesce(before, F.lit(0)))


def _open(uri: str) -> pa.NativeFile:
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def _records(data_uri: str, index: np.ndarray, chunk: int = 8_000_000) -> Iterator[tuple[int, np.ndarray]]:
    """Row id and ids of a file's records in order, read in chunks."""
    with _open(data_uri) as f:
        i = 0
        while i < len(index):
            stop = max(i + 1, int(np.searchsorted(index["offset"] + index["length"], index["offset"][i] + chunk, side="right")))
            begin, end = int(index["offset"][i]), int(index["offset"][stop - 1] + index["length"][stop - 1])
            f.seek(begin)
            data, at = memoryview(f.read(end - begin)), 0
            for k in range(i, stop):
                body, at = unframe(data, at)
                row, ids = parsed(body)
                if row != index["id"][k]:
                    raise ValueError(f"{data_uri} doesn't fit its index at record {k}")
                yield row, ids
            i = stop


def _index(uri: str) -> np.ndarray:
    with _open(uri) as f:
        return np.frombuffer(f.read(), INDEX)


def summaries(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Read the files back: id, start (ids before the record in all files), n_tokens and ids_crc32 of each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                start, rows = file["start"], []
                for row, ids in _records(file["data"], _index(file["index"])):
                    rows.append((None if row == NULL_ID else row, start, len(ids), zlib.crc32(ids)))
                    start += len(ids)
                    if len(rows) == 20_000:
                        yield _batch(rows, id_col)
                        rows = []
                yield _batch(rows, id_col)

    files = with_starts(manifest).repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part")
    return files.select("data", "index", "start").mapInArrow(run, f"`{id_col}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _batch(rows: list[tuple], id_col: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [id_col, "start", "n_tokens", "ids_crc32"])


def shuffled(manifest: DataFrame, seed: int = 0, id_col: str = "doc_id") -> DataFrame:
    """(id, ids array<bigint>) of all records in a seeded order within each file, each found by its offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                index = _index(file["index"])
                order = list(range(len(index)))
                random.Random(f"{seed}-{file['part']}").shuffle(order)
                with _open(file["data"]) as f:
                    for k in order:
                        f.seek(int(index["offset"][k]))
                        row, ids = parsed(unframe(memoryview(f.read(int(index["length"][k]))))[0])
                        yield pa.RecordBatch.from_arrays([pa.array([None if row == NULL_ID else row], pa.int64()), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], [id_col, "ids"])

    return manifest.select("part", "data", "index").mapInArrow(run, f"`{id_col}` bigint, ids array<bigint>")
