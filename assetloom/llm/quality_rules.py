"""Quality rules as a short-circuit cascade (operator 5).

On a sample each rule's cost (seconds a row) and rejection rate are measured; the rules then run in order
of rejection per cost, and a rule sees only the rows that all earlier ones let pass. All rules must pass, so
the order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import output_names, text_blocks

_SPACES = b"\t\n\x0b\x0c\r "
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_BEYOND = bytes(range(128, 256))
_BULLETS = (b"-", b"*", "\u2022".encode())
_DOTS = (b"...", "\u2026".encode())


class Facts:
    """What rules ask about one text; each fact is computed when first asked for."""

    def __init__(self, text: bytes, n_chars: int) -> None:
        self.text, self._n_chars = text, n_chars

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def word_chars(self) -> int:
        return self._n_chars - (len(self.text) - len(self.text.translate(None, _SPACES)))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, _SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.text.split(b"\n") if x.strip(_SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        words = self.words
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) == len(windows):
            return 0
        counts, n, end = Counter(windows), 0, 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                n += i + 3 - max(i, end)
                end = i + 3
        return n

    @cached_property
    def shouted(self) -> bool:
        upper = len(self.text) - len(self.text.translate(None, _UPPER))
        lower = len(self.text) - len(self.text.translate(None, _LOWER))
        return upper > lower

    @cached_property
    def letters(self) -> int:
        """ASCII letters and all characters beyond ASCII."""
        ascii_ = len(self.text.translate(None, _BEYOND))
        return len(self.text) - len(self.text.translate(None, _UPPER + _LOWER)) + self._n_chars - ascii_

    @cached_property
    def commonest(self) -> int:
        """How often the most frequent word stands."""
        return max(Counter(self.words).values(), default=0)

    @cached_property
    def bullets(self) -> int:
        return sum(x.lstrip(_SPACES).startswith(_BULLETS) for x in self.lines)

    @cached_property
    def cut_off(self) -> int:
        """Lines that end in dots."""
        return sum(x.rstrip(_SPACES).endswith(_DOTS) for x in self.lines)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Facts], bool]


RULES = (
    Rule("symbols", lambda x: 10 * x.n_symbols > 3 * len(x.words)),
    Rule("word_length", lambda x: not 2 * len(x.words) <= x.word_chars <= 20 * len(x.words)),
    Rule("shouting", lambda x: x.shouted),
    Rule("dup_lines", lambda x: 10 * x.n_dup_lines > 5 * len(x.lines)),
    Rule("letters", lambda x: 2 * x.letters < x.word_chars),
    Rule("one_word", lambda x: 10 * x.commonest > 4 * len(x.words)),
    Rule("bullets", lambda x: 10 * x.bullets > 9 * len(x.lines)),
    Rule("cut_off", lambda x: 10 * x.cut_off > 4 * len(x.lines)),
)


def _facts(block: pa.RecordBatch) -> list[Facts]:
    texts = block.column("text")
    sizes = pc.utf8_length(texts).to_pylist()
    return [Facts(t, n) for t, n in zip(texts.cast(pa.binary()).to_pylist(), sizes, strict=True)]


def base_failed(x: Facts, min_words: int = 50, max_repeat: int = 50) -> bool:
    return len(x.words) < min_words or 100 * x.n_repeat_words > max_repeat * len(x.words)


def rule_statistics(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000, text_col: str = "text", seed: int = 7) -> DataFrame:
    """(rule, n, rejected, seconds) of each rule on a seeded sample of at most sample_rows rows.

    Costs are measured with no fact known beforehand. The sample sets the order of the rules and nothing else.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, rejected, seconds = 0, [0] * len(rules), [0.0] * len(rules)
        for block in text_blocks(batches):
            n += len(block)
            for k, rule in enumerate(rules):
                for x in _facts(block):
                    began = time.perf_counter()
                    rejected[k] += bool(rule.rejects(x))
                    seconds[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"rule": [r.name for r in rules], "n": [n] * len(rules), "rejected": rejected, "seconds": seconds})

    rows = docs.select(F.col(text_col).alias("text"))
    sample = rows.sample(fraction=0.01, seed=seed).limit(sample_rows)
    found = sample.mapInArrow(run, "rule string, n bigint, rejected bigint, seconds double")
    return found.groupBy("rule").agg(F.sum("n").alias("n"), F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds"))


def cascade_order(statistics: list[tuple[str, int, int, float]], rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """Rules by rejected rows per second on the sample, the highest first; ties and unseen rules keep their order."""
    gain = {name: (rejected / n) / max(seconds / n, 1e-9) if n else 0.0 for name, n, rejected, seconds in statistics}
    return tuple(sorted(rules, key=lambda r: -gain.get(r.name, 0.0)))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rejected_by and the columns of keep.

    rejected_by names the first rule of the cascade that rejected the row ("base" for the base filter, null for
    kept rows). Null and empty texts have no words and fail the base filter. Rows are treated one by one, so
    repeated rows and ids get the same verdict, very long texts are read whole, and an empty table gives an empty
    result. rejected_by of a row that several rules reject depends on the measured order; its verdict doesn't. A
    column of keep may not have the name of another result (ValueError).
    """
    order = cascade_order([tuple(r) for r in rule_statistics(docs, rules, sample_rows, text_col).collect()], rules)
    keep = list(keep or [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            columns: list[list] = [[] for _ in range(8)]
            for x in _facts(block):
                failed = base_failed(x)
                by = "base" if failed else next((r.name for r in order if r.rejects(x)), None)
                for column, value in zip(columns, (len(x.words), x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, failed, by is None, by), strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
            yield pa.RecordBatch.from_arrays([block.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], *block.columns[2:]], names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    kinds = [t for _, t in rows.dtypes]
    names = output_names([id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"], keep)
    types = [kinds[0], *["bigint"] * 5, "boolean", "boolean", "string", *kinds[2:]]
    return rows.mapInArrow(run, ", ".join(f"`{a}` {b}" for a, b in zip(names, types, strict=True)))
