"""Benchmark decontamination by template canonicalisation.

Words are stripped of surrounding punctuation and lower-cased; numbers, names (a capital that does not start a sentence)
and units (a unit word after a number, or glued to it) become typed placeholders, equal neighbours becoming one.  Windows of
``WINDOW`` canonical words are joined by hash with the windows of the benchmark; windows with fewer than half literal words say
too little and are left out on both sides.  Shorter items are one window of their own length.

An item's first word is a sentence start in the item but maybe none in a document, so its first window is also emitted in the forms it has
inside a sentence; the slot this makes is not judged.  Items without a qualifying window behind the first word are also joined
by windows of their plain words, which hold no slots; either kind of window may report the item.

A document leaks an item if in one occurrence matched windows cover at least ``COVERAGE`` per cent of the item's windows, and the slots
are consistent: over the matched windows the values in the item's slots must map to the document's values like a function for at least
``CONSISTENT`` per cent of the slot values.  Equal values are the verbatim case, consistently replaced ones a re-parameterised question.
Occurrences are the matches of one alignment (position in the document less that in the item), exact and in steps of ``STEPS`` words,
each step also shifted by its half so that inserted words split none, and all matches of the document together.  The report names
the occurrence of the largest coverage, of that the most consistent.

Documents are never shuffled: tasks test their windows against a Bloom filter of the benchmark's windows, sized by their number up to 32 MB, and
send only the hits to the exact hash join.

Defined results: null or empty texts and items without words match nothing; documents and items are told apart by id and hash of the text,
so rows of one id, or of none, but different texts are judged each; the report holds equal rows once; items without an id are left out;
empty tables give an empty report; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import chain
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, by_batch, list_array, mix, store

WINDOW = 8
#: per cent of an item's windows that must match, and of its slot values that must be consistent
COVERAGE, CONSISTENT = 50, 75
#: widths of the alignments taken as one occurrence, beside the exact one and the whole document
STEPS = (4, 16)
#: bits of the Bloom filter for a window of the benchmark, least and most bits, and probes
BITS, LEAST_BITS, MOST_BITS, PROBES = 16, 1 << 16, 1 << 28, 3
#: words kept in a task's memo of canonical forms
MEMO = 500_000

#: units of measure (fixed values)
UNITS = frozenset("""
mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l gal s sec min h hr hrs ms kb mb gb tb w kw v a hz khz mhz ghz k c f
inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres gram grams
kilogram kilograms pound pounds ounce ounces liter liters litre litres second seconds minute minutes hour hours day days week
weeks month months year years percent dollar dollars euro euros cent cents degree degrees
""".split())

NUMBER = re.compile(r"[+-]?[0-9][0-9.,:/]*")
GLUED = re.compile(r"([+-]?[0-9][0-9.,:/]*)([a-z]+|%)")
EDGES = re.compile(r"^[^\w+-]+|[\W_]+$")
ENDS = re.compile(r"[.!?:]\W*$")

_NUM, _NAME, _UNIT = (xxhash.xxh3_64_intdigest(x) for x in ("<number>", "<name>", "<unit>"))
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: flags of a word
NUM, CAPITAL, UNIT, END, GLUE, EMPTY = 1, 2, 4, 8, 16, 32
#: kinds of slot beside numbers (1); value of a slot that is not judged
NAMED, UNITED, UNJUDGED = 2, 3, 0


def _form(word: str) -> tuple[int, int, int]:
    """(hash of the literal, hash of the value, flags) of a word."""
    stem, last = (word[:-1], word[-1]) if word[-1] in ".,;!?:" else (word, "")
    if stem.isalpha():  # most words: letters, maybe a mark behind them
        low = stem.lower()
        value = xxhash.xxh3_64_intdigest(low)
        return value, value, (CAPITAL if stem[0].isupper() else 0) | (UNIT if low in UNITS else 0) | (END if last and last in ".!?:" else 0)
    end = END if ENDS.search(word) else 0
    bare = EDGES.sub("", word)
    if not bare:
        return 0, 0, EMPTY | end
    low = bare.lower()
    value = xxhash.xxh3_64_intdigest(low)
    if NUMBER.fullmatch(low):
        return _NUM, value, NUM | end
    glued = GLUED.fullmatch(low)
    if glued and (glued[2] == "%" or glued[2] in UNITS):
        return _NUM, value, NUM | GLUE | end
    return value, value, (CAPITAL if bare[0].isupper() else 0) | (UNIT if low in UNITS else 0) | end


class Vocabulary(dict):
    """Numbers of the words seen, and the hashes and flags of each by number."""

    def __init__(self):
        super().__init__()
        self.forms: list[tuple[int, int, int]] = []
        self.columns = [np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.uint8)]

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self.forms)
        self.forms.append(_form(word))
        return number

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """(literal hashes, value hashes, flags, number of the text) of all words of the texts, one after the other."""
        if len(self) > MEMO:
            self.__init__()
            self.clear()
        number = self.__getitem__
        split = [(t or "").split() for t in texts]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(number, chain.from_iterable(split)), np.int64, int(lengths.sum()))
        known = len(self.columns[0])
        if known < len(self.forms):
            fresh = zip(*self.forms[known:])
            self.columns = [np.r_[old, np.array(new, old.dtype)] for old, new in zip(self.columns, fresh)]
        return (*(c[at] for c in self.columns), np.repeat(np.arange(len(split)), lengths))


def plain(words: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words as they are, numbers, names and units too, in the form of ``canonical``."""
    _, value, flags, text = words
    full = (flags & EMPTY) == 0
    return value[full], value[full], np.zeros(int(full.sum()), bool), text[full]


def first_forms(words: tuple[np.ndarray, ...]) -> list[int]:
    """The kinds of slot that the first word of a single text may be inside a sentence."""
    flags = words[2][(words[2] & EMPTY) == 0][:1]
    return [kind for flag, kind in ((CAPITAL, NAMED), (UNIT, UNITED)) if (flags & flag).any()]


def canonical(words: tuple[np.ndarray, ...], first_kind: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the canonical words, hashes of the values, is a slot, number of the text) of the texts read.

    ``first_kind`` makes the first word of a single text a slot.
    """
    literal, value, flags, text = words
    if not len(literal):
        return literal, value, np.empty(0, bool), text
    same = np.r_[False, text[1:] == text[:-1]]
    before = np.r_[np.uint8(0), flags[:-1]] * same
    starts = ~same | ((before & END) > 0)
    number = (flags & NUM) > 0
    unit = ((flags & UNIT) > 0) & ((before & (NUM | GLUE)) == NUM)
    name = ((flags & CAPITAL) > 0) & ~starts & ~unit
    full = (flags & EMPTY) == 0
    if first_kind and full.any():
        at = np.argmax(full)
        name[at], unit[at] = first_kind == NAMED, first_kind == UNITED
    kind = np.where(name, NAMED, np.where(unit, UNITED, np.where(number, 1, 0)))
    literal = np.where(name, np.uint64(_NAME), np.where(unit, np.uint64(_UNIT), literal))
    literal, value, kind, text = literal[full], value[full], kind[full], text[full]
    if not len(literal):
        return literal, value, kind > 0, text
    # names of several words, numbers in several groups: one slot
    first = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]) | (kind[1:] == 0) | (text[1:] != text[:-1])])
    return literal[first], mix(np.add.reduceat(value, first)), kind[first] > 0, text[first]


def windows(words: tuple[np.ndarray, ...], sizes: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(hashes, positions) of the windows with enough literal words, by size; a window lies in one text."""
    literal, _, slot, text = words
    out, n = {}, len(literal)
    held = np.r_[0, np.cumsum(slot)]
    prefix = np.zeros(n, np.uint64)
    power = 1
    for size in range(1, max(sizes, default=0) + 1):
        prefix = prefix[: max(0, n - size + 1)] * _STEP + literal[size - 1 :]
        power = power * int(_STEP) % (1 << 64)
        if size in sizes:
            h = prefix + np.uint64(size * power % (1 << 64))
            at = np.flatnonzero((text[: len(h)] == text[size - 1 :]) & (2 * (held[size:] - held[: len(h)]) <= size)) if len(h) else np.empty(0, np.int64)
            out[size] = mix(h[at]), at
    return out


def _probes(h: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(h >> np.uint64(i * 20)) & np.uint64(bits - 1) for i in range(PROBES)]


def _passing(h: np.ndarray, bloom: np.ndarray) -> np.ndarray:
    """Positions of the hashes that the filter may hold."""
    at = np.arange(len(h))
    for p in _probes(h, 8 * len(bloom)):
        probe = p[at]
        at = at[(bloom[probe >> np.uint64(3)] >> (probe & np.uint64(7)).astype(np.uint8)) & 1 > 0]
    return at


_HITS = pa.schema([
    ("id", pa.int64()), ("key", pa.int64()), ("pos", pa.int32()), ("size", pa.int32()), ("hash", pa.int64()), ("total", pa.int32()), ("slots", pa.list_(pa.int64())),
])
_DDL = "id long, key long, pos int, size int, hash long, total int, slots array<long>"


def _of_item(text: str | None, known: Vocabulary) -> list[tuple]:
    """(size, hashes, positions, words, number of windows) of an item; the size of windows of plain words is negative."""
    words = known.read([text])
    form = canonical(words)
    if not len(form[0]):
        return []
    size = min(WINDOW, len(form[0]))
    h, at = windows(form, [size])[size]
    total, out = max(1, len(h)), [(size, h, at, form, max(1, len(h)))]
    if not len(h) or at[0] == 0:
        for kind in first_forms(words):
            other = canonical(words, kind)
            other[1][0] = UNJUDGED
            size = min(WINDOW, len(other[0]))
            out.append((size, *windows(tuple(c[:size] for c in other), [size])[size], other, total))
    if not (at > 0).any():
        exact = plain(words)
        size = min(WINDOW, len(exact[0]))
        h, at = windows(exact, [size])[size]
        out.append((-size, h, at, exact, len(h)))
    return out


def _of_documents(texts: list[str | None], known: Vocabulary, sizes: list[int], bloom: np.ndarray) -> list[tuple]:
    """The same of documents, of windows that the filter may hold; one pass over the words serves all ``sizes``."""
    out = []
    words = known.read(texts)
    for sign, form in ((1, canonical), (-1, plain)):
        if mine := [abs(size) for size in sizes if size * sign > 0]:
            made = form(words)
            for size, (h, at) in windows(made, mine).items():
                hit = _passing(h, bloom)
                out.append((sign * size, h[hit], at[hit], made, 0))
    return out


def _windows_of(df: DataFrame, sizes: list[int] | None, bloom) -> DataFrame:
    """Windows of the texts of ``df`` (id, key, text); of documents those the filter may hold.

    ``sizes``: lengths of windows, negative ones of plain words; None for the benchmark, whose items have their own.
    """

    def make():
        known = Vocabulary()
        bits = None if bloom is None else np.frombuffer(bloom.value, np.uint8)

        def fn(c):
            if sizes is None:
                found = [(*f, k) for k, text in enumerate(c["text"]) for f in _of_item(text, known)]
            else:
                found = [(*f, None) for f in _of_documents(c["text"], known, sizes, bits)]
            parts = []
            for size, h, at, (_, value, slot, text), total, k in found:
                inside = at[:, None] + np.arange(abs(size))
                held = slot[inside]
                row = np.full(len(at), k) if k is not None else text[at]
                begins = np.searchsorted(text, text[at])  # the first word of the text
                parts.append((row, at - begins, np.full(len(at), size), h.view(np.int64), np.full(len(at), total), held.sum(1), value[inside][held].view(np.int64)))
            row, pos, size, h, total, slots, flat = (np.concatenate(p) for p in zip(*parts)) if parts else [np.empty(0, np.int64)] * 7
            ids, keys = (pa.array(c[n], pa.int64()).take(pa.array(row, pa.int64())) for n in ("id", "key"))
            return dict(zip(_HITS.names, [ids, keys, pos, size, h, total, list_array(flat, slots, pa.int64())]))

        return fn

    return df.mapInArrow(by_batch(make, _HITS), _DDL)


def _bloom(windows_: DataFrame) -> bytes:
    """The filter's bits, about BITS for each window, between the least and the most; that many bits reach the driver at most."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << max(0, BITS * windows_.count() - 1).bit_length()))

    def bits(batches):
        mine = np.zeros(size, bool)
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for p in _probes(h, size):
                mine[p] = True
        packed = np.packbits(mine, bitorder="little").view(np.int64)
        at = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(packed[at], pa.int64())], names=["at", "word"])

    words = windows_.select("hash").mapInArrow(bits, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word"))
    out = np.zeros(size // 64, np.int64)
    for r in words.collect():
        out[r["at"]] = r["word"]
    return out.tobytes()


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: int = COVERAGE, consistent: int = CONSISTENT) -> DataFrame:
    """(doc_id, item_id, n_windows, n_matched, coverage, n_slots, n_consistent, verbatim): what leaks into which document.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text.
    """
    return keyed_leaks(docs, benchmark, coverage, consistent).drop("doc_key", "item_key").distinct()


def keyed_leaks(docs: DataFrame, benchmark: DataFrame, coverage: int = COVERAGE, consistent: int = CONSISTENT) -> DataFrame:
    """``leaks`` with doc_key and item_key, the hashes of the texts."""
    spark = docs.sparkSession

    def rows(df: DataFrame, id_: str) -> DataFrame:
        return df.select(F.col(id_).cast("long").alias("id"), F.xxhash64("text").alias("key"), "text")

    items = store(_windows_of(rows(benchmark, "item_id").where("id is not null").dropDuplicates(["id", "key"]), None, None), "items")
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())
    bloom = spark.sparkContext.broadcast(_bloom(items))
    hits = store(_windows_of(rows(docs, "doc_id"), sizes or [WINDOW], bloom), "hits")
    i = items.select(F.col("id").alias("item_id"), F.col("key").alias("item_key"), F.col("pos").alias("item_pos"), "size", "hash", F.col("total").alias("n_windows"), F.col("slots").alias("item_slots"))
    d = hits.select(F.col("id").alias("doc_id"), F.col("key").alias("doc_key"), "pos", "size", "hash", F.col("slots").alias("doc_slots"))
    met = d.join(i, ["hash", "size"]).withColumn("exact", F.col("size") < 0)
    key = ["doc_id", "doc_key", "item_id", "item_key", "exact", "n_windows"]

    def same(*names: str) -> Column:
        return reduce(and_, (F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in names))

    # enough of the item first: what remains is small
    enough = met.groupBy(*key).agg(F.count_distinct("item_pos").alias("n")).where(F.col("n") * 100 >= F.col("n_windows") * coverage)
    near = met.alias("a").join(store(enough.select(*key), "enough").alias("b"), same(*key), "left_semi")
    near = store(near.select(*key, "item_pos", "item_slots", "doc_slots", F.explode(_places()).alias("place")), "near")
    key = [*key, "place"]
    covered = near.groupBy(*key).agg(F.count_distinct("item_pos").alias("n_matched")).where(F.col("n_matched") * 100 >= F.col("n_windows") * coverage)
    slots = near.select(*key, F.explode_outer(F.arrays_zip("item_slots", "doc_slots")).alias("s")).select(*key, "s.*")
    # how often each value of a slot meets each value in the document: the most frequent one is its image
    images = slots.groupBy(*key, "item_slots", "doc_slots").agg(F.count("*").alias("n")).groupBy(*key, "item_slots").agg(
        F.max("n").alias("most"), F.sum("n").alias("all"), F.max_by("doc_slots", F.struct("n", "doc_slots")).alias("image")
    )
    held = F.coalesce(F.col("item_slots") != UNJUDGED, F.lit(False))
    judged = images.groupBy(*key).agg(
        F.coalesce(F.sum(F.when(held, F.col("all"))), F.lit(0)).alias("n_slots"),
        F.coalesce(F.sum(F.when(held, F.col("most"))), F.lit(0)).alias("n_consistent"),
        F.coalesce(F.bool_and(F.when(held, F.col("image") == F.col("item_slots"))), F.lit(True)).alias("verbatim"),
    )
    both = covered.alias("a").join(judged.alias("b"), same(*key)).select("a.*", "n_slots", "n_consistent", "verbatim")
    share = F.when(F.col("n_slots") > 0, F.col("n_consistent") / F.col("n_slots")).otherwise(1.0)
    found = both.where(F.col("n_consistent") * 100 >= F.col("n_slots") * consistent).withColumns({"coverage": F.col("n_matched") / F.col("n_windows"), "share": share})
    best = F.max(F.struct("coverage", "share", "verbatim", ~F.col("exact"), "n_windows", "n_matched", "n_slots", "n_consistent")).alias("best")
    return found.groupBy(*key[:4]).agg(best).select(
        *key[:4], *[f"best.{c}" for c in ("n_windows", "n_matched", "coverage", "n_slots", "n_consistent", "verbatim")]
    )


def _places() -> Column:
    """The occurrences a match belongs to, as structs of width, shift and number."""
    at = F.col("pos") - F.col("item_pos")
    kinds = [(1, 0), *((w, s) for w in STEPS for s in (0, w // 2))]
    places = [F.struct(F.lit(w).alias("width"), F.lit(s).alias("shift"), F.floor((at + s) / w).alias("number")) for w, s in kinds]
    return F.array(*places, F.struct(F.lit(0).alias("width"), F.lit(0).alias("shift"), F.lit(0).cast("long").alias("number")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that leak an item; texts are moved only where more leak than may be sent to every executor."""
    id_, key = F.col("doc_id").cast("long"), F.xxhash64("text")
    bad = store(keyed_leaks(docs, benchmark).select(F.col("doc_id").alias("bad_id"), F.col("doc_key").alias("bad_key")).distinct(), "leaking")
    few = bad.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(bad) if few else bad, (key == F.col("bad_key")) & id_.eqNullSafe(F.col("bad_id")), "left_anti")
