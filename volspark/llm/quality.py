"""Quality of texts by a generalised additive model with pairwise interactions.

A text becomes some twenty numbers: its length, what its characters are, how its words and
lines repeat, and how its worst line looks. Each number is cut into bins at its quantiles.
The model's logit is a sum of lookups: one table over the bins of each number, and one over
the bins of each of a few pairs. Tables are learned in turns: every turn fits a tree of four
leaves on one number alone to what the sum so far leaves of the labels, and adds a small part
of it to that number's table. Then the pairs whose four quadrants would explain most of the
rest are chosen, and their tables are learned in turns in the same way. Scoring is one bin
search a number and one addition a table, for a whole batch at once.

The model is fitted in the driver on a bounded sample: about ``learn`` labelled documents,
chosen by a hash of the id, whole texts, some 20 numbers of each. All rows are scored, by whole texts.

Defined cases: a null text is an empty one and is scored like any; ids with labels of both
kinds teach nothing; of rows that share an id one teaches; with no label, or labels of one
kind, every score is the share of label 1 (a half without any), smoothed; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few_at_once

#: Labelled documents learned from (expected number).
LEARN = 20_000

#: Bins of a number, alone and in pairs; pairs; turns through all tables; share of a tree added.
BINS, PAIR_BINS, PAIRS, TURNS, RATE = 64, 16, 12, 120, 0.15

#: Weight of no evidence in a leaf, and the least rows' worth of it on a side of a cut.
CALM, LEAST = 1.0, 5.0

#: Characters looked at together: bounds memory for long texts.
PART = 1 << 20

NAMES = (
    "length words word_length upper symbol sentence top_symbol digit foreign distinct adjacent"
    " longest_run top_word bare noisy_end repeated_lines worst_symbol worst_upper worst_adjacent"
    " line_length packed"
).split()

SPACE, LETTER, UPPER, DIGIT, SENTENCE, SYMBOL = range(6)


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """What each code point is."""
    table = np.full(0x110000, SYMBOL, np.uint8)
    for c in range(0x110000):
        x = chr(c)
        if x.isspace():
            table[c] = SPACE
        elif x.isalpha():
            table[c] = UPPER if x.isupper() else LETTER
        elif x.isdigit():
            table[c] = DIGIT
    table[[ord(c) for c in ".,;:?'\"()-"]] = SENTENCE
    return table


def _share(part: float, whole: float) -> float:
    return float(part) / float(whole) if whole else 0.0


def _longest_run(words: list[str]) -> int:
    best = run = 1 if words else 0
    for a, b in pairwise(words):
        run = run + 1 if a == b else 1
        best = max(best, run)
    return best


def _letters(text: str) -> tuple[np.ndarray, int, int]:
    """Characters of each kind, the commonest symbol's number, letters beyond ASCII."""
    found, symbols, foreign = np.zeros(6, np.int64), Counter(), 0
    for at in range(0, len(text), PART):
        raw = text[at : at + PART].encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(raw, np.uint32)
        kind = kinds()[codes]
        found += np.bincount(kind, minlength=6)
        foreign += int(((kind <= UPPER) & (kind > SPACE) & (codes > 127)).sum())
        odd, times = np.unique(codes[kind == SYMBOL], return_counts=True)
        symbols.update(dict(zip(odd.tolist(), times.tolist())))
    return found, max(symbols.values(), default=0), foreign


def numbers(text: str) -> list[float]:
    """The numbers of a whole text, in the order of NAMES."""
    kind, top_symbol, foreign = _letters(text)
    seen = len(text) - kind[SPACE]
    letters = kind[LETTER] + kind[UPPER]
    words = text.split()
    n = len(words)
    counts = Counter(words)
    adjacent = sum(a == b for a, b in pairwise(words))
    bare = noisy = 0
    for word, times in counts.items():
        if not word[-1].isalnum():
            if not any(map(str.isalnum, word)):
                bare += times
            elif len(word) > 1 and not word[-2].isalnum():
                noisy += times
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    worst = [0.0, 0.0, 0.0]
    for line in lines:
        own = line.split()
        if len(own) >= 5:
            size = sum(map(len, own))
            odd = size - sum(map(str.isalnum, line))
            upper = sum(map(str.isupper, own))
            same = sum(a == b for a, b in pairwise(own))
            here = odd / size, upper / len(own), same / len(own)
            worst = list(map(max, worst, here))
    packed = zlib.compress(text.encode("utf-8", "surrogatepass"), 1)
    return [
        float(np.log1p(len(text))),
        float(np.log1p(n)),
        _share(seen, n),
        _share(kind[UPPER], letters),
        _share(kind[SYMBOL], seen),
        _share(kind[SENTENCE], seen),
        _share(top_symbol, seen),
        _share(kind[DIGIT], seen),
        _share(foreign, letters),
        _share(len(counts), n),
        _share(adjacent, n),
        _share(_longest_run(words), n),
        _share(max(counts.values(), default=0), n),
        _share(bare, n),
        _share(noisy, n),
        _share(len(lines) - len(set(lines)), len(lines)),
        *worst,
        float(np.log1p(_share(n, len(lines)))),
        _share(len(packed), len(text)),
    ]


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The gain of the best cut between bins, and the bins left of it (0: none)."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + CALM) + right_g**2 / (right_h + CALM)
    gain -= g.sum() ** 2 / (h.sum() + CALM)
    gain[(left_h < LEAST * 0.05) | (right_h < LEAST * 0.05)] = 0
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of the bins by a tree of two levels."""
    value = np.empty(len(g))
    _, cut = _best_cut(g, h)
    for low, high in ((0, cut), (cut, len(g))) if cut else ((0, len(g)),):
        _, inner = _best_cut(g[low:high], h[low:high]) if cut else (0, 0)
        for a, b in ((low, low + inner), (low + inner, high)) if inner else ((low, high),):
            value[a:b] = g[a:b].sum() / (h[a:b].sum() + CALM)
    return value


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The gain and the values of cells by one cut each way, of all such cuts the best."""

    def corners(x: np.ndarray) -> list[np.ndarray]:
        c = x.cumsum(0).cumsum(1)
        a, top, side, all_ = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return [a, top - a, side - a, all_ - top - side + a]

    value = np.full(g.shape, g.sum() / (h.sum() + CALM))
    if min(g.shape) < 2:
        return 0.0, value
    of_g, of_h = corners(g), corners(h)
    gain = sum(a**2 / (b + CALM) for a, b in zip(of_g, of_h)) - g.sum() ** 2 / (h.sum() + CALM)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    parts = [a[i, j] / (b[i, j] + CALM) for a, b in zip(of_g, of_h)]
    value[: i + 1, : j + 1], value[: i + 1, j + 1 :] = parts[0], parts[1]
    value[i + 1 :, : j + 1], value[i + 1 :, j + 1 :] = parts[2], parts[3]
    return float(gain[i, j]), value


class Model:
    """Lookup tables over the bins of numbers and of pairs of numbers."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray) -> None:
        y = labels.astype(float)
        base = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(base / (1 - base)))
        self.cuts = [_cuts(column, BINS) for column in rows.T]
        self.pair_cuts = [_cuts(column, PAIR_BINS) for column in rows.T]
        self.tables = [np.zeros(len(cuts) + 1) for cuts in self.cuts]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}
        if len(y) and 0 < y.sum() < len(y):
            self._learn(rows, y)

    def _learn(self, rows: np.ndarray, y: np.ndarray) -> None:
        logit = np.full(len(y), self.base)
        bins = self._bins(rows, self.cuts)
        for _ in range(TURNS):
            for table, at in zip(self.tables, bins):
                p = 1 / (1 + np.exp(-logit))
                g = np.bincount(at, y - p, len(table))
                step = RATE * _tree(g, np.bincount(at, p * (1 - p), len(table)))
                table += step
                logit += step[at]
        bins = self._bins(rows, self.pair_cuts)

        def sums(pair: tuple[int, int]) -> tuple[np.ndarray, tuple]:
            a, b = pair
            shape = len(self.pair_cuts[a]) + 1, len(self.pair_cuts[b]) + 1
            cell = bins[a] * shape[1] + bins[b]
            p = 1 / (1 + np.exp(-logit))
            g = np.bincount(cell, y - p, shape[0] * shape[1]).reshape(shape)
            return cell, _quadrants(g, np.bincount(cell, p * (1 - p), g.size).reshape(shape))

        every = list(combinations(range(len(bins)), 2))
        gains = [sums(pair)[1][0] for pair in every]
        chosen = [every[i] for i in np.argsort(gains, kind="stable")[::-1][:PAIRS]]
        for _ in range(TURNS):
            for pair in chosen:
                cell, (_, value) = sums(pair)
                step = RATE * value
                self.pairs[pair] = self.pairs.get(pair, 0) + step
                logit += step.ravel()[cell]

    @staticmethod
    def _bins(rows: np.ndarray, cuts: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(c, column, "right") for c, column in zip(cuts, rows.T)]

    def score(self, rows: np.ndarray) -> np.ndarray:
        logit = np.full(len(rows), self.base)
        for table, at in zip(self.tables, self._bins(rows, self.cuts)):
            logit += table[at]
        bins = self._bins(rows, self.pair_cuts)
        for (a, b), table in self.pairs.items():
            logit += table[bins[a], bins[b]]
        return 1 / (1 + np.exp(-logit))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    """Where bins begin: quantiles of the column, each value once."""
    if not len(column):
        return np.zeros(0)
    found = np.unique(np.quantile(column, np.arange(1, bins) / bins, method="higher"))
    return found[found > column.min()]


def held_out(doc_id: Column) -> Column:
    """Documents kept from learning: crc32 of the id's text, by 4, leaves 2."""
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(4)) == 2


def _matrix(texts: pa.Array) -> np.ndarray:
    return np.array([numbers(t.as_py() or "") for t in texts]).reshape(len(texts), len(NAMES))


def fit(docs: DataFrame, labels: DataFrame, learn: int = LEARN) -> Model:
    """A model of labels.quality (doc_id, quality) from the texts of ``docs``, held-out rows
    left aside; ``learn`` bounds the rows learned from."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
        .filter("label = other")
        .select("doc_id", F.col("label").cast("int").alias("label"))
    )
    span = 1 << 31
    below = min(span, span * learn // max(known.count(), 1) + 1)
    chosen = known.filter(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(span)) < below)
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    own = own.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches):
            rows = pa.array(_matrix(batch.column("text")).tolist(), pa.list_(pa.float64()))
            yield pa.record_batch([*batch.columns[:2], rows], ["doc_id", "label", "row"])

    found = own.mapInArrow(run, f"doc_id {kind}, label int, row array<double>")
    one = found.groupBy("doc_id", "label").agg(F.max("row").alias("row")).toArrow()
    # in one order, so that a run adds up as the last one did
    one = one.sort_by("doc_id")
    rows = np.array(one.column("row").to_pylist()).reshape(len(one), len(NAMES))
    return Model(rows, np.array(one.column("label").to_pylist(), dtype=int))


def scores(docs: DataFrame, model: Model, least: float = 0.7) -> DataFrame:
    """doc_id, score and predicted (1 from a score of ``least`` on) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches):
            found = shared.value.score(_matrix(batch.column("text")))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(found, pa.float64()),
                    pa.array((found >= least).astype(np.int32)),
                ],
                ["doc_id", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, f"doc_id {kind}, score double, predicted int")
