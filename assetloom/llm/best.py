"""The k best scored ids of many lists at once, as operators keep them within a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Best:
    """The k best (score, id) of each of n lists: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int, pending: int = 200_000) -> None:
        self._k, self._pending, self._waiting = k, pending, 0
        self._rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        #: A list takes no score below this, nor this one with a larger id than `last`.
        self.floor, self.last = np.full(n, np.iinfo(np.int64).min), np.full(n, np.iinfo(np.int64).max)

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        floor = self.floor[lists]
        good = (scores > floor) | ((scores == floor) & (ids < self.last[lists]))
        if good.any():
            self._rows.append((lists[good], scores[good], ids[good]))
            self._waiting += int(good.sum())
            if self._waiting > self._pending:
                self.rows()

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, score and id of all that is kept, best first within a list."""
        if not self._rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        lists, scores, ids = (np.concatenate(c) for c in zip(*self._rows, strict=True))
        order = np.lexsort((ids, -scores, lists))
        lists, scores, ids = lists[order], scores[order], ids[order]
        starts = np.flatnonzero(np.append(True, lists[1:] != lists[:-1]))
        place = np.arange(len(lists)) - np.repeat(starts, np.diff(np.append(starts, len(lists))))
        lists, scores, ids, place = (x[place < self._k] for x in (lists, scores, ids, place))
        full = place == self._k - 1
        self.floor[lists[full]], self.last[lists[full]] = scores[full], ids[full]
        self._rows, self._waiting = [(lists, scores, ids)], 0
        self._pending = max(self._pending, 2 * len(lists))
        return lists, scores, ids

    def batch(self, names: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in self.rows()], names)


def first_of(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The k first rows of each key, numbered from 1 by `rank`; Spark keeps k of a key in a task before the shuffle too."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
