"""Periodic runs of words, by seeds and extension along diagonals.

A run is a stretch of words that repeats with period q, of at least 12 words and at least two periods, as long as it
can be. On the diagonal of lag q its words equal each other over ``length - q`` places, and that is at
least 6, for short periods, and at least q. So a run of lag below 12 shows as a pair of equal 6-grams, and a
run whose lag is from K to 2K as a pair of equal K-grams at that lag. The lags are taken in such tiers:
6-grams first, then K = 12, 24, 48 and so on. In each tier

* the K-grams that occur again in their document are indexed; a K-gram is two grams of the tier below, so only
  places where both of those occur again are looked at;
* pairs of equal K-grams of one document, at a lag of the tier, are seeds;
* seeds of a lag are taken from left to right; the first is extended in both directions, and the table of how far
  each lag is covered removes all others that the extension has passed.

Inside a run of period up to K/2 that is already known, K-grams repeat so often that pairs would be of quadratic number.
Two places of one such run need no pair: that diagonal is the run itself. Nor do two places of different ones, neither
the first of its run: the words before them are equal too, so it is not where a diagonal starts. What is left is
a number of pairs in proportion to the words of a tier, so the work is of order n log n.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHORTEST = 12
SEED = SHORTEST // 2
#: words that are searched at once; a longer document is searched alone
BLOCK_WORDS = 1 << 20

_multipliers = np.random.default_rng(5).integers(1, 1 << 63, SEED + 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_fold = np.uint64(29)


def _hash(*parts: np.ndarray) -> np.ndarray:
    value = np.zeros(len(parts[0]), np.uint64)
    for part, m in zip(parts, _multipliers):
        value = (value ^ part.astype(np.uint64)) * m
        value ^= value >> _fold
    return value


def _equal_words(words: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``a`` equal those from ``b`` > ``a``, going right (1) or left (-1)."""
    total = np.zeros(len(a), np.int64)
    alive, width, last = np.arange(len(a)), 16, len(words) - 1
    while len(alive):
        width = max(16, min(width, (1 << 20) // len(alive)))
        ahead = total[alive][:, None] + np.arange(width)
        left = np.clip(a[alive][:, None] + step * ahead, 0, last)
        right = np.clip(b[alive][:, None] + step * ahead, 0, last)
        same = words[left] == words[right]
        whole = same.all(1)
        total[alive] += np.where(whole, width, same.argmin(1))
        alive, width = alive[whole], 2 * width
    return total


class Runs:
    """The runs of a block of documents, which follow each other in ``words`` with a number that occurs once
    between them, and at both ends."""

    def __init__(self, words: np.ndarray, document: np.ndarray):
        self.words, self.document = words, document
        self.start = self.end = self.period = np.zeros(0, np.int64)
        places = np.arange(max(0, len(words) - SEED + 1))
        if not len(places):
            return
        grams = _hash(*(words[k : k + len(places)] for k in range(SEED)), document[: len(places)])
        places, grams = self._again(places, grams)
        self._tier(places, grams, 1, SHORTEST)
        places, grams = self._doubled(places, grams, SEED)
        k = SHORTEST
        while len(places):
            self._tier(places, grams, k, 2 * k)
            places, grams = self._doubled(places, grams, k)
            k *= 2

    @staticmethod
    def _again(places: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose gram occurs at another place too, by place."""
        order = np.argsort(grams, kind="stable")
        same = grams[order][1:] == grams[order][:-1]
        twice = np.zeros(len(grams), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        return places[twice], grams[twice]

    def _doubled(self, places: np.ndarray, grams: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of grams of ``2 * k`` words that occur again. A gram has its document in it."""
        at = np.searchsorted(places, places + k)
        inside = at < len(places)
        whole = np.flatnonzero(inside)[places[at[inside]] == places[inside] + k]
        return self._again(places[whole], _hash(grams[whole], grams[at[whole]]))

    def _inside(self, places: np.ndarray, k: int) -> np.ndarray:
        """Of each place the known run of period up to k/2 in which its ``k`` words lie, or -1."""
        known = np.flatnonzero((2 * self.period <= k) & (self.end - self.start >= k))
        if not len(known):
            return np.full(len(places), -1)
        # Two such runs never share k words, so these ranges of places do not overlap.
        known = known[np.argsort(self.start[known])]
        at = np.searchsorted(self.start[known], places, "right") - 1
        within = (at >= 0) & (places + k <= self.end[known[at]])
        return np.where(within, known[at], -1)

    def _pairs(self, places: np.ndarray, grams: np.ndarray, low: int, high: int) -> tuple[np.ndarray, ...]:
        """Pairs of equal grams at lags from ``low`` up to ``high``, not both interior and not in one run: the
        place, the lag, and how far from there the runs that the two lie in are known to agree."""
        order = np.lexsort((places, grams))
        places, grams = places[order], grams[order]
        run = self._inside(places, low) if low >= SHORTEST else np.full(len(places), -1)
        interior = (run >= 0) & (self.start[run] < places) if len(self.start) else run >= 0
        kind = np.concatenate([[0], np.cumsum(grams[1:] != grams[:-1])])
        key = kind * (len(self.words) + 3 * high) + places + high

        def partners(of: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
            lo = np.searchsorted(key, key[of] + begin)
            n = np.searchsorted(key, key[of] + end) - lo
            first = np.cumsum(n) - n
            return np.repeat(of, n), np.arange(n.sum()) + np.repeat(lo - first, n)

        a, b = partners(np.flatnonzero(~interior), low, high)
        c, d = partners(np.flatnonzero(~interior), 1 - high, 1 - low)
        c, d = c[interior[d]], d[interior[d]]
        left, right = np.concatenate([a, d]), np.concatenate([b, c])
        other = (run[left] < 0) | (run[left] != run[right])
        left, right = left[other], right[other]
        known = np.zeros(len(left), np.int64)
        both = np.flatnonzero((run[left] >= 0) & (run[right] >= 0))
        i, j = left[both], right[both]
        known[both] = np.minimum(self.end[run[i]] - places[i], self.end[run[j]] - places[j])
        return places[left], places[right] - places[left], known

    def _tier(self, places: np.ndarray, grams: np.ndarray, low: int, high: int) -> None:
        if not len(places):
            return
        seed, lag, known = self._pairs(places, grams, low, high)
        order = np.lexsort((seed, self.document[seed], lag))
        seed, lag, known = seed[order], lag[order], known[order]
        # A seed right after another of its lag is covered by that one.
        next_to = (seed[1:] == seed[:-1] + 1) & (lag[1:] == lag[:-1])
        head = np.concatenate([[True], ~next_to])[: len(seed)]
        seed, lag, known = seed[head], lag[head], known[head]
        document = self.document[seed]
        new = (lag[1:] != lag[:-1]) | (document[1:] != document[:-1])
        group = np.concatenate([[0], np.cumsum(new)])[: len(seed)]
        found = [(self.start, self.end, self.period)]
        while len(seed):
            # Taken at once: the first seed of each lag of a document, and those where a diagonal surely starts.
            first = np.concatenate([[True], group[1:] != group[:-1]])
            first |= self.words[seed - 1] != self.words[seed - 1 + lag]
            s, q = seed[first], lag[first]
            # Two runs of one period agree up to the first end; only beyond it words are compared.
            ahead = known[first]
            right = ahead + _equal_words(self.words, s + ahead, s + q + ahead, 1)
            left = _equal_words(self.words, s - 1, s + q - 1, -1)
            begin, end = s - left, s + right + q
            good = end - begin >= np.maximum(SHORTEST, 2 * q)
            # That they agree was told by hashes, so it is looked at where it matters.
            sure = good & (ahead > 0)
            good[sure] = _equal_words(self.words, s[sure], s[sure] + q[sure], 1) == right[sure]
            found.append((begin[good], end[good], q[good]))
            #: how far each lag of each document is covered by the seeds up to here
            table = group * (len(self.words) + 1)
            covered = table.copy()
            covered[first] += s + np.maximum(right, 1)
            rest = seed + table >= np.maximum.accumulate(covered)
            rest &= ~first
            seed, lag, known, group = seed[rest], lag[rest], known[rest], group[rest]
        start, end, period = (np.concatenate(c) for c in zip(*found))
        # The same stretch with a multiple of its period is the same run.
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        same = (start[1:] == start[:-1]) & (end[1:] == end[:-1])
        keep = np.concatenate([[True], ~same])[: len(start)]
        self.start, self.end, self.period = start[keep], end[keep], period[keep]


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (start, length, period) of each text's runs, by start and period; texts are arrays of numbers from 0."""
    lengths = np.array([len(t) for t in texts], np.int64)
    firsts = np.cumsum(lengths + 1) - lengths
    words = -1 - np.zeros(lengths.sum() + len(texts) + 1, np.int64)
    for text, first in zip(texts, firsts):
        words[first : first + len(text)] = text
    gap = np.concatenate([[0], firsts + lengths])
    words[gap] = -1 - np.arange(len(gap))
    document = np.repeat(np.arange(len(texts) + 1), np.concatenate([[1], lengths + 1]))
    runs = Runs(words, document)
    order = np.lexsort((runs.period, runs.start))
    owner = document[runs.start[order]] - 1
    rows = np.column_stack([runs.start[order], (runs.end - runs.start)[order], runs.period[order]])
    rows[:, 0] -= firsts[owner]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [rows[i:j] for i, j in zip(cuts[:-1], cuts[1:])]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Of ``n`` words, those that no run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For every row its id, ``n_words``, ``runs`` (array of start, length and period, by start and period) and
    ``collapsed``, the words that no run contains after its first period, joined by one space.

    Words are runs of characters other than the six white-space ones. A null text has no words, no runs and an empty
    collapsed text. Each row is a document of its own, also if ids repeat or are null; an empty table gives no rows.
    Other columns are not read. Texts are never cut; memory is linear in the longest.
    """
    schema = T.StructType(
        [
            docs.schema[id_column],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(RUN)),
            T.StructField("collapsed", T.BinaryType()),
        ]
    )

    def found(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        number = defaultdict(count().__next__)
        numbers = [np.fromiter(map(number.__getitem__, t), np.int64, len(t)) for t in texts]
        runs = runs_of(numbers)
        collapsed = []
        for words, own in zip(texts, runs):
            if len(own):
                words = [words[i] for i in np.flatnonzero(kept_words(len(words), own)).tolist()]
            collapsed.append(b" ".join(words))
        rows = np.concatenate(runs)
        ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
        structs = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], RUN.names)
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array([len(t) for t in texts], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                pa.array(collapsed, pa.binary()),
            ],
            schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, size, texts = 0, 0, []
            for i, text in enumerate(batch.column(1)):
                words = (text.as_py() or b"").split()
                if texts and size + len(words) > BLOCK_WORDS:
                    yield found(batch.column(0).slice(begin, len(texts)), texts)
                    begin, size, texts = i, 0, []
                texts.append(words)
                size += len(words)
            if texts:
                yield found(batch.column(0).slice(begin, len(texts)), texts)

    texts = docs.select(F.col(f"`{id_column}`"), F.col(f"`{text_column}`").cast("string").cast("binary").alias("_text"))
    out = texts.mapInArrow(run, schema)
    return out.select(f"`{id_column}`", "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))
