"""Best-fit packing into sequences of several permitted lengths.

Documents longer than the largest capacity are cut into full pieces and a rest; nothing is dropped.  Pieces are dealt
by hash to shards of about ``SHARD`` pieces, each packed on its own in a task, so that memory is bounded and every core
works; a shard leaves at most its last few bins loose.

In a shard, pieces come from the longest to the shortest (ties by doc_id, copy, piece).  A piece goes to the open bin
with the least sufficient room.  If there is none, a bin is opened: for every permitted capacity that holds the piece, the
bin is completed on trial with the longest remaining pieces that fit, one after the other, and the capacity with the least
cost per token held is opened (ties: the smaller).  At last every bin is cut down to the smallest capacity that holds its contents.

The cost of a bin is its capacity plus ``OVERHEAD``: slots, and a charge for each sequence.

Defined results: null or empty texts and lengths below one give no piece; equal rows are packed as often as they occur,
numbered by ``copy``; null ids are packed like any others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store, words

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 32
SHARD = 20_000


class Lengths:
    """A multiset of lengths up to a bound: counts, and a bit set of those present for finding the next smaller one."""

    def __init__(self, lengths: Iterator[int] | Sequence[int], bound: int):
        self.count = [0] * (bound + 1)
        self.bits = 0
        for x in lengths:
            self.add(x)

    def add(self, x: int) -> None:
        self.count[x] += 1
        self.bits |= 1 << x

    def remove(self, x: int) -> None:
        self.count[x] -= 1
        if not self.count[x]:
            self.bits &= ~(1 << x)

    def at_most(self, x: int) -> int:
        """The largest length of at most x, 0 if none."""
        return max(0, (self.bits & ((2 << x) - 1)).bit_length() - 1) if x > 0 else 0

    def at_least(self, x: int) -> int:
        """The smallest length of at least x, 0 if none."""
        high = self.bits >> x
        return x + (high & -high).bit_length() - 1 if high else 0


def completed(rest: Lengths, room: int) -> int:
    """How many tokens of the remaining pieces go into ``room``, the longest that fits first."""
    held = 0
    x = rest.at_most(room)
    while x:
        held += min(rest.count[x], (room - held) // x) * x
        x = rest.at_most(min(x - 1, room - held))
    return held


def pack(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD) -> list[tuple[int, int]]:
    """(bin, offset) of every piece; ``lengths`` must fall.  Bins are numbered as they are opened."""
    bound = capacities[-1]
    rest = Lengths(lengths, bound)
    rooms = Lengths((), bound)
    open_: dict[int, list[int]] = {}
    filled: list[int] = []
    out = []
    for x in lengths:
        rest.remove(x)
        room = rooms.at_least(x)
        if room:
            number = open_[room].pop()
            rooms.remove(room)
        else:
            fits = capacities[bisect_left(capacities, x) :]
            held = [x + completed(rest, c - x) for c in fits]
            room = min(zip(fits, held), key=lambda f: ((f[0] + overhead) / f[1], f[0]))[0]
            number = len(filled)
            filled.append(0)
        out.append((number, filled[number]))
        filled[number] += x
        if room > x:
            rooms.add(room - x)
            open_.setdefault(room - x, []).append(number)
    return out


def pieces(docs: DataFrame, length: str, largest: int) -> DataFrame:
    """(doc_id, copy, piece, start, length): documents cut at the largest capacity; equal rows get numbers."""
    sized = docs.where(F.col(length) >= 1).groupBy(F.col("doc_id").cast("long").alias("doc_id"), F.col(length).cast("long").alias("n")).agg(F.count("*").alias("copies"))
    each = sized.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    cut = each.select("doc_id", "copy", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {largest}"))).alias("piece"))
    start = F.col("piece") * largest
    return cut.select("doc_id", "n", "copy", "piece", start.alias("start"), F.least(F.lit(largest), F.col("n") - start).cast("int").alias("length"))


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("copy", pa.int64()), ("piece", pa.int64()), ("start", pa.int64()), ("length", pa.int32()),
    ("shard", pa.int32()), ("bin", pa.int32()), ("offset", pa.int32()), ("capacity", pa.int32()), ("filled", pa.int32()),
])


def packed(docs: DataFrame, length: str, capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD, shard: int = SHARD) -> DataFrame:
    """One row per piece of ``docs`` (doc_id and the column ``length``): where it lies, and its bin's final capacity."""
    capacities = sorted(capacities)
    cut = store(pieces(docs, length, capacities[-1]), "pieces")
    shards = max(1, -(-cut.count() // shard))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "n", "copy", "piece"), F.lit(shards)).cast("int"))

    def one(group: pa.Table) -> pa.Table:
        rows = group.select(["length", "doc_id", "n", "copy", "piece", "start", "shard"]).to_pylist()
        rows.sort(key=lambda r: (-r["length"], r["doc_id"] is not None, r["doc_id"] or 0, r["n"], r["copy"], r["piece"]))
        placed = pack([r["length"] for r in rows], capacities, overhead)
        filled: dict[int, int] = {}
        for r, (number, _) in zip(rows, placed):
            filled[number] = filled.get(number, 0) + r["length"]
        for r, (number, offset) in zip(rows, placed):
            total = filled[number]
            r |= {"bin": number, "offset": offset, "filled": total, "capacity": capacities[bisect_left(capacities, total)]}
        return pa.Table.from_pylist(rows, schema=_OUT)

    ddl = "doc_id long, copy long, piece long, start long, length int, shard int, bin int, offset int, capacity int, filled int"
    return dealt.groupBy("shard").applyInArrow(one, ddl)


def by_words(docs: DataFrame) -> DataFrame:
    """``docs`` as (doc_id, n_tokens): words of the text and one separator; none for a text without words."""
    n = F.size(words(F.col("text")))
    return docs.select("doc_id", F.when(n > 0, n + 1).otherwise(0).alias("n_tokens"))
