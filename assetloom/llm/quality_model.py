"""Quality classifier: a support-vector machine over n-gram indicators scaled by naive Bayes (operator 6).

Indicators are lower-cased word unigrams and n-grams of one to three word shapes; a shape says how a word is
spelled and whether it repeats the word before, and a shape n-gram's indicator also holds its share of the
text in powers of two. Each indicator is scaled by its log-count ratio between the classes; the linear model
with hinge loss is fitted by dual coordinate descent, and a logistic curve on rows left out of it makes
scores of margins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import output_names, text_blocks, words


@dataclass(frozen=True)
class Settings:
    max_train: int = 6000  #: labelled rows that the model is fitted on, at most
    buckets: int = 1 << 18
    alpha: float = 1.0
    cost: float = 0.5
    epochs: int = 15
    seed: int = 11


def shape(word: str) -> int:
    """How a word is spelled, as a number below 64."""
    body = word.rstrip(".,;:?'\"")
    letters = sum(c.isalpha() for c in body)
    case = 0 if not letters else 1 if body.islower() else 2 if body.isupper() and letters > 1 else 3 if body.istitle() else 4
    signs = len(body) - letters - sum(c.isdigit() for c in body)
    sign = 0 if not signs else 1 if signs == len(body) else 2
    return case * 12 + sign * 4 + min(3, (len(word) > len(body)) + 2 * (len(word) > 14)) if case < 5 else 63


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def features(texts: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct indicator numbers of each text, joined, and where each text's begin (one more at the end)."""
    number, at, distinct = words(texts)
    lengths = np.diff(at)
    shapes = np.array([shape(w) for w in distinct], np.int64)
    names = np.array([zlib.crc32(w.lower().encode()) for w in distinct], np.int64)
    doc = np.repeat(np.arange(len(texts)), lengths)
    same = np.zeros(len(number), np.int64)
    same[1:] = (number[1:] == number[:-1]) & (doc[1:] == doc[:-1])
    step = shapes[number] * 2 + same if len(number) else same
    parts = []
    for n in (1, 2, 3):
        size = len(step) - n + 1
        if size <= 0:
            break
        gram = sum(step[k : k + size] << (7 * k) for k in range(n))
        inside = doc[:size] == doc[n - 1 :]
        keys, counts = np.unique((doc[:size] << 24 | gram)[inside], return_counts=True)
        share = np.floor(np.log2(counts / np.maximum(1, lengths[keys >> 24]))).astype(np.int64)
        parts.append((keys >> 24, _mix((keys & 0xFFFFFF) * 32 - np.maximum(share, -9), n)))
    if len(number):
        keys = np.unique(doc << 32 | names[number])
        parts.append((keys >> 32, _mix(keys & 0xFFFFFFFF, 7)))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    keys = np.unique(np.concatenate([d << 32 | (h % np.uint64(settings.buckets)).astype(np.int64) for d, h in parts]))
    return keys & 0xFFFFFFFF, np.searchsorted(keys >> 32, np.arange(len(texts) + 1))


def fit(rows: list[np.ndarray], labels: np.ndarray, settings: Settings) -> tuple[np.ndarray, float, float, float]:
    """Weights of the scaled indicators, bias, and slope and shift of the logistic curve."""
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(rows))
    left_out, used = order[: len(rows) // 5], order[len(rows) // 5 :]
    counts = np.full((2, settings.buckets), settings.alpha)
    for i in used:
        counts[int(labels[i]), rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    sign = np.where(labels == 1, 1.0, -1.0)
    share = max(1e-6, np.mean(labels[used] == 1)) if len(used) else 0.5
    bound = np.where(labels == 1, settings.cost * 0.5 / share, settings.cost * 0.5 / max(1e-6, 1 - share))
    weights, bias, dual = np.zeros(settings.buckets), 0.0, np.zeros(len(rows))
    scaled = {int(i): ratio[rows[i]] / max(1.0, np.sqrt(np.sum(ratio[rows[i]] ** 2))) for i in order}
    for _ in range(settings.epochs):
        for i in rng.permutation(used):
            x = scaled[int(i)]
            gradient = sign[i] * (weights[rows[i]] @ x + bias) - 1
            new = min(max(dual[i] - gradient / (x @ x + 1), 0.0), bound[i])
            if new != dual[i]:
                weights[rows[i]] += (new - dual[i]) * sign[i] * x
                bias += (new - dual[i]) * sign[i]
                dual[i] = new
    held = left_out if len(left_out) >= 20 else order
    margins = np.array([weights[rows[i]] @ scaled[int(i)] + bias for i in held])
    target = np.where(labels[held] == 1, 1.0, 0.0)
    smooth = (target * (target.sum() + 1) / (target.sum() + 2)) + (1 - target) / ((1 - target).sum() + 2)
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton's steps of logistic regression on the margin
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        v = np.maximum(p * (1 - p), 1e-6)
        g = np.array([np.sum((p - smooth) * margins) + 1e-3 * (slope - 1), np.sum(p - smooth)])
        h = np.array([[np.sum(v * margins**2) + 1e-3, np.sum(v * margins)], [np.sum(v * margins), np.sum(v) + 1e-3]])
        d = np.linalg.solve(h, g)
        slope, shift = slope - d[0], shift - d[1]
    return np.stack([weights * ratio, ratio**2]).astype(np.float32), bias, max(float(slope), 1e-3), float(shift)


def scores(texts: pa.Array, model: tuple[np.ndarray, float, float, float], settings: Settings) -> np.ndarray:
    table, bias, slope, shift = model
    flat, at = features(texts, settings)
    sums = np.zeros((2, len(flat) + 1))
    np.cumsum(table[:, flat], axis=1, out=sums[:, 1:])
    dot, norm = sums[:, at[1:]] - sums[:, at[:-1]]
    margin = dot / np.maximum(1.0, np.sqrt(np.maximum(norm, 0))) + bias
    return 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))


def remainder(id_col: str, by: int = 5):
    """crc32 of the id as text, modulo by (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % by


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", usable=None) -> tuple[np.ndarray, float, float, float]:
    """Fit on at most settings.max_train labelled rows (those of the smallest id hashes that usable allows).

    Labels but 0 and 1, and labels of missing documents, count for nothing. Without labels of both classes the
    model scores every text alike. The rows meet in one task, which the bound keeps small; the chosen ids,
    not more than the bound, are the only table broadcast.
    """
    chosen = labels.where(F.col(label_col).isin(0, 1))
    chosen = chosen.where(usable) if usable is not None else chosen
    chosen = chosen.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).orderBy(F.xxhash64("id"), "id", "label").limit(settings.max_train)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, max_bytes=4_000_000):
            flat, at = features(block.column("text"), settings)
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([block.column("id"), block.column("label"), lists], ["id", "label", "features"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            found += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), (x.values.to_numpy() for x in batch.column(2)), strict=True)
        found.sort(key=lambda x: (x[0], x[1], x[2].tobytes()))
        y = np.array([label for _, label, _ in found])
        table, *rest = fit([f for *_, f in found], y, settings) if len(set(y.tolist())) == 2 else (np.zeros((2, settings.buckets), np.float32), 0.0, 1.0, 0.0)
        yield pa.RecordBatch.from_pydict({"weights": pa.array([table.tobytes()], pa.binary()), "rest": pa.array([rest], pa.list_(pa.float64()))})

    rows = texts.join(F.broadcast(chosen), "id").select("id", "text", "label").mapInArrow(extract, f"id {dict(texts.dtypes)['id']}, label int, features array<int>")
    out = rows.repartition(1).mapInArrow(solve, "weights binary, rest array<double>").first()
    if out is None:
        return np.zeros((2, settings.buckets), np.float32), 0.0, 1.0, 0.0
    return np.frombuffer(bytes(out.weights), np.float32).reshape(2, -1), *out.rest


def score(docs: DataFrame, model: tuple[np.ndarray, float, float, float], settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """id, score (0 to 1, higher: label 1 likelier) and the columns of keep.

    Only the text is looked at. Null and empty texts get the score of a text without any n-gram. Rows are scored
    one by one: repeated rows and ids get equal scores, very long texts are read whole, an empty table gives an
    empty result. A column of keep may not have the name of another result (ValueError).
    """
    keep = list(keep or [])
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # two numbers a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, max_bytes=4_000_000):
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(scores(block.column("text"), shared.value, settings)), *block.columns[2:]], names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    kinds = [t for _, t in rows.dtypes]
    names = output_names([id_col, "score"], keep)
    types = [kinds[0], "double", *kinds[2:]]
    return rows.mapInArrow(run, ", ".join(f"`{a}` {b}" for a, b in zip(names, types, strict=True)))
