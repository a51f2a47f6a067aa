"""Runs of periodic words in texts, by longest common extensions from a difference cover.

The words of some documents are numbered and laid one after the other, then all of them backwards, so that one index answers both directions.

* *Cover.*  Only suffixes at positions in the difference cover ``COVER`` modulo ``MODULUS`` are sorted: by their first words, then by doubling, as
  a sampled position moved by a multiple of the modulus is sampled again.  Suffixes of different documents are never compared.
* *Extension.*  For any two positions the cover has a step of less than ``MODULUS`` words after which both are sampled.  The words of
  that step are compared; if they agree, the minimum of the common prefixes between the two ranks, from a sparse table, gives the rest.
* *Grid.*  A run of period p with at least 2 p words holds two neighbouring points of the grid 0, p, 2 p, ...  For every period up to half the
  words and each pair of neighbours with equal words, the extensions to both sides give the longest stretch of that period.  Of
  stretches with the same ends the one of the smallest period is the run.

The grid has n ln n points for n words; memory is in proportion to the words of a document, and short documents share an index.

Defined results: a null or empty text has no words, no run, and an empty rest; rows without an id and repeated rows are judged each; an empty
table gives an empty result; other columns are ignored; words are split at the space and the ASCII control characters 9 to 13.
"""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a perfect difference set: every difference modulo 13 occurs (fixed values)
MODULUS, COVER = 13, (0, 1, 3, 9)
#: words of the documents that share an index, points of the grid that are tested at once
SHARED, POINTS = 1 << 16, 1 << 20
#: a run has at least so many words, and so many periods
LEAST, PERIODS = 12, 2

_PLACE = np.full(MODULUS, -1)
_PLACE[list(COVER)] = np.arange(len(COVER))
_STEP = np.array([[next(d for d in range(MODULUS) if (a + d) % MODULUS in COVER and (b + d) % MODULUS in COVER) for b in range(MODULUS)] for a in range(MODULUS)])


class Extensions:
    """Longest common extensions in a text of numbered words, between positions of one document."""

    def __init__(self, words: np.ndarray, document: np.ndarray, longest: int):
        """``document`` must rise along the text; extensions beyond ``longest`` words are of no interest."""
        n = len(words)
        self.words = np.r_[words.astype(np.int64), np.zeros(2 * MODULUS, np.int64)]
        blocks = -(-n // MODULUS)
        at = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)).ravel()
        at = at[at < n]
        m = len(at)
        bits = max(1, int(words.max()).bit_length())
        keys, held = [], 0
        for t in range(MODULUS):
            if held + bits > 62 or not keys:
                keys.append(np.zeros(m, np.int64))
                held = 0
            keys[-1] = keys[-1] << bits | self.words[at + t]
            held += bits
        of = document[at]
        names, order = self._named([*reversed(keys), of])
        self.levels, span = [names], MODULUS
        while span < longest and names[order[-1]] < m - 1:
            after = self._at(names, at + span, n)
            names, order = self._named([names * np.int64(m + 1) + after + 1])
            self.levels.append(names)
            span *= 2
        self.n, self.rank = n, np.empty(m, np.int64)
        self.rank[order] = np.arange(m)
        self.table = [self._common(at[order], of[order])]
        while 2 << len(self.table) <= 2 * m:
            last, width = self.table[-1], 1 << (len(self.table) - 1)
            if len(last) <= width:
                break
            self.table.append(np.minimum(last[:-width], last[width:]))

    @staticmethod
    def _named(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Equal numbers for equal keys, in their order; and the order."""
        order = np.lexsort(keys) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
        fresh = np.zeros(len(order), bool)
        for k in keys:
            fresh[1:] |= k[order][1:] != k[order][:-1]
        names = np.empty(len(order), np.int64)
        names[order] = np.cumsum(fresh)
        return names, order

    @staticmethod
    def _sample(at: np.ndarray) -> np.ndarray:
        return at // MODULUS * len(COVER) + _PLACE[at % MODULUS]

    def _at(self, names: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """The names at sampled positions, -1 behind the text."""
        inside = at < n
        return np.where(inside, names[np.where(inside, self._sample(at), 0)], -1)

    def _common(self, at: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The common prefix of each sampled suffix and the one before it, 0 between documents."""
        a, b = at[:-1].copy(), at[1:].copy()
        together = of[:-1] == of[1:]
        length = np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            x, y = self._at(self.levels[level], a, self.n), self._at(self.levels[level], b, self.n)
            step = np.where((x == y) & (x >= 0) & together, MODULUS << level, 0)
            a, b, length = a + step, b + step, length + step
        length += np.where(together, self._compared(a, b, np.full(len(a), MODULUS)), 0)
        return np.r_[0, length]

    def _compared(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many of the next ``most`` words agree, compared one by one."""
        length = np.zeros(len(a), np.int64)
        going = np.flatnonzero(most > 0)
        t = 0
        while len(going):
            same = self.words[np.minimum(a[going] + t, self.n)] == self.words[np.minimum(b[going] + t, self.n)]
            same &= np.maximum(a[going], b[going]) + t < self.n
            going = going[same]
            length[going] += 1
            t += 1
            going = going[most[going] > t]
        return length

    def __call__(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words agree from a < b on, at most ``most``, which may not lead beyond the document."""
        step = np.minimum(_STEP[a % MODULUS, b % MODULUS], most)
        length = self._compared(a, b, step)
        far = np.flatnonzero((length == step) & (step < most))
        if len(far):
            x, y = (self.rank[self._sample(p[far] + step[far])] for p in (a, b))
            low, high = np.minimum(x, y) + 1, np.maximum(x, y)
            level = np.frexp(high - low + 1)[1] - 1
            least = np.empty(len(far), np.int64)
            for k in np.unique(level):
                here = level == k
                least[here] = np.minimum(self.table[k][low[here]], self.table[k][high[here] - (1 << k) + 1])
            length[far] += least
        return np.minimum(length, most)


def runs(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of the runs of documents laid one after the other, by document, start and period."""
    n = len(words)
    none = (np.empty(0, np.int64),) * 4
    starts = np.cumsum(lengths) - lengths
    if not n or lengths.max() < LEAST:
        return none
    document = np.repeat(np.arange(len(lengths)), lengths)
    extend = Extensions(np.r_[words, words[::-1]], np.r_[document, 2 * len(lengths) - 1 - document[::-1]], int(lengths.max()))
    periods = np.where(lengths >= LEAST, lengths // PERIODS, 0)
    of = np.repeat(np.arange(len(lengths)), periods)
    period = np.arange(len(of)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    ends = np.cumsum((lengths[of] - 1) // period)
    found = []
    for low in range(0, int(ends[-1]), POINTS):
        point = np.arange(low, min(low + POINTS, int(ends[-1])))
        which = np.searchsorted(ends, point, side="right")
        d, p = of[which], period[which]
        i = starts[d] + (point - ends[which] + (lengths[d] - 1) // p) * p
        met = words[i] == words[i + p]
        d, p, i = d[met], p[met], i[met]
        j = i + p
        right = extend(i, j, starts[d] + lengths[d] - j)
        left = extend(2 * n - j, 2 * n - i, i - starts[d])  # backwards from i - 1 and j - 1
        length = left + p + right
        keep = length >= np.maximum(LEAST, PERIODS * p)
        found.append((d[keep], (i - left - starts[d])[keep], length[keep], p[keep]))
    d, start, length, p = (np.concatenate(f) for f in zip(*found))
    order = np.lexsort((p, length, start, d))
    d, start, length, p = d[order], start[order], length[order], p[order]
    fresh = np.r_[True, (d[1:] != d[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])][: len(d)]
    d, start, length, p = d[fresh], start[fresh], length[fresh], p[fresh]
    order = np.lexsort((p, start, d))
    return d[order], start[order], length[order], p[order]


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of which every tenth document, by its id, repeats a stretch to its end."""
    n = len(words)
    h = crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
_DDL = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _judged(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
    numbers: dict[bytes, int] = {}
    words = np.array([numbers.setdefault(w, len(numbers)) for text in texts for w in text], np.int64)
    lengths = np.array([len(t) for t in texts], np.int64)
    d, start, length, period = runs(words, lengths)
    offsets = np.r_[0, np.cumsum(np.bincount(d, minlength=len(texts)))].astype(np.int32)
    at = np.cumsum(lengths) - lengths
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, at[d] + start + period, 1)
    np.add.at(gone, at[d] + start + length, -1)
    gone = np.cumsum(gone[:-1]) > 0
    rest = []
    for i, text in enumerate(texts):
        if offsets[i] < offsets[i + 1]:
            kept = np.flatnonzero(~gone[at[i] : at[i] + lengths[i]]).tolist()
            text = [text[k] for k in kept]
        rest.append(b" ".join(text))
    table = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(_RUN)))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), table, pa.array(rest, pa.binary()).cast(pa.string())], schema=_OUT)


def find(docs: DataFrame, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, runs, collapsed): the runs of every document by start and period, and its words without what repeats a run's first period.

    ``change`` may replace the words of a document before they are searched.
    """

    def run(batches):
        for batch in batches:
            ids, texts, size = [], [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_buffer().to_pybytes().split() if text.is_valid else []
                ids.append(i)
                texts.append(change(i, text) if change else text)
                size += len(text)
                if size >= SHARED:
                    yield _judged(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield _judged(ids, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _DDL)


def report(found: DataFrame) -> DataFrame:
    """One row per document of ``find``: how many runs, the longest, and digests of all runs and of the remaining words."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"), F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
