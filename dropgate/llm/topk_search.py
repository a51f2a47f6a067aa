"""Exact top-k search by the three-phase uniform threshold.

A score is the integer inner product of two vectors whose components are floor(256 x).  The components are dealt to ``LISTS`` nodes, each
with its own part of every vector: the score is the sum of one partial score from each node.

1. *Gather.*  Every node sends, for each query, the entries with its highest partial scores.  Their whole scores are summed; the k-th highest is
   a safe cutoff: at least k rows reach it.
2. *Collect.*  A vector that reaches the cutoff has a partial score of at least cutoff / LISTS in some node.  The cutoffs travel with the queries, and
   every node sends all entries above that threshold.  What a vector may still get from nodes that did not send it is less than the threshold;
   those that can't reach the cutoff go.
3. *Resolve.*  Partial scores that were not sent are computed for the vectors that remain, and the k highest sums are the result.

Equal vectors are one vector with its k + 1 smallest ids, found before any shuffle, so thousands of copies send one entry; a query looks for k + 1 rows
and leaves out its own.  Nodes work on blocks (``grid``); no list of scores is held whole.

Defined results: vectors null, with null or non-finite components take no part, nor do those with a scaled component of 2^26 or more, whose scores need not
fit a long; vectors meet only those of the same length, and empty ones score 0; rows without an id are no queries, are found
like others and come last among ties (so does the id 2^63 - 1, which is shown as null); repeated rows are queries and results as often as they occur; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import grid
from .common import list_array, store

#: nodes that hold a part of every vector, entries gathered from each for a query, queries in a block
LISTS, GATHER, QUERY_ROWS = 2, 64, 512
#: parts into which the pairs of one vector are dealt when they fetch it
SALTS = 32
NO_CUTOFF = -(1 << 62)

_ROWS = pa.schema([("dim", pa.int32()), ("comps", pa.binary()), ("ids", pa.list_(pa.int64())), ("asks", pa.list_(pa.int64()))])
_PAIRS = pa.schema([("q", pa.int64()), ("x", pa.int64()), ("list", pa.int32()), ("partial", pa.int64())])
_PAIRS_DDL = "q long, x long, list int, partial long"


def _rows(df: DataFrame, k: int, every: int) -> DataFrame:
    """(dim, comps, ids, asks): the distinct vectors of each batch, with their k + 1 smallest ids and the ids of their queries."""

    def run(batches):
        for batch in batches:
            valid, flat, dims = grid.scaled(batch.column("embedding"))
            raw = batch.column("vec_id").filter(pa.array(valid))
            none = raw.is_null().to_numpy(zero_copy_only=False)
            ids = np.where(none, grid.NO_ID, raw.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            asks = ~none & (ids % every == 0)
            values = grid.binary(flat, dims)
            names = values.dictionary_encode()
            of = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.lexsort((ids, of))
            n = len(names.dictionary)
            counts = np.bincount(of, minlength=n)
            place = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
            least = order[place <= k]
            ask = order[asks[order]]
            dim = np.zeros(n, np.int32)
            dim[of] = dims
            yield pa.RecordBatch.from_arrays([
                pa.array(dim), names.dictionary, list_array(ids[least], np.bincount(of[least], minlength=n), pa.int64()),
                list_array(ids[ask], np.bincount(of[ask], minlength=n), pa.int64()),
            ], schema=_ROWS)

    given = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return given.mapInArrow(run, "dim int, comps binary, ids array<long>, asks array<long>")


def _gathered(cells: DataFrame, most: int) -> DataFrame:
    """The ``most`` highest partial scores of every query and cell."""

    def run(batches):
        held: list[tuple] = []
        size, at = 0, None

        def flush():
            q, x, s, n = (np.concatenate(c) for c in zip(*held))
            keep = grid.best((q,), s, x, most)
            return q[keep], x[keep], s[keep], n[keep]

        def out():
            q, x, s, n = flush()
            return pa.RecordBatch.from_arrays([pa.array(q), pa.array(x), pa.array(n.astype(np.int32)), pa.array(s.astype(np.int64))], schema=_PAIRS)

        for batch in batches:
            for r in range(batch.num_rows):
                c = {name: batch.column(name)[r] for name in batch.schema.names}
                key = tuple(c[k].as_py() for k in ("dim", "list", "lane_v", "lane_q"))
                if held and key != at:
                    yield out()
                    held, size = [], 0
                at = key
                s = grid.products(grid.matrix(c["q_comps"], c["q_rows"].as_py()), grid.matrix(c["comps"], c["rows"].as_py()))
                few = min(most, s.shape[1])
                top = np.argpartition(s, s.shape[1] - few, axis=1)[:, s.shape[1] - few :]
                x, q = grid.longs(c["uid"]), grid.longs(c["q_uid"])
                held.append((np.repeat(q, few), x[top.ravel()], np.take_along_axis(s, top, 1).ravel().astype(np.int64), np.full(len(q) * few, key[1], np.int64)))
                size += len(q) * few
                if size > 1 << 20:
                    held = [flush()]
                    size = len(held[0][0])
        if held:
            yield out()

    return cells.mapInArrow(run, _PAIRS_DDL)


def _collected(cells: DataFrame) -> DataFrame:
    """All entries whose partial score reaches the threshold of their query."""

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                c = {name: batch.column(name)[r] for name in batch.schema.names}
                x, q, low = (grid.longs(c[n]) for n in ("uid", "q_uid", "q_least"))
                values, of = grid.matrix(c["comps"], len(x)), grid.matrix(c["q_comps"], len(q))
                for a in range(0, len(q), 128):
                    part = slice(a, a + 128)
                    s = grid.products(of[part], values).astype(np.int64)
                    i, j = np.nonzero(s >= low[part, None])
                    if len(i):
                        n = np.full(len(i), c["list"].as_py(), np.int32)
                        yield pa.RecordBatch.from_arrays([pa.array(q[part][i]), pa.array(x[j]), pa.array(n), pa.array(s[i, j])], schema=_PAIRS)

    return cells.mapInArrow(run, _PAIRS_DDL)


def _fetched(pairs: DataFrame, vectors: DataFrame, key: str, lists: int) -> DataFrame:
    """``pairs`` with the part of vector ``key`` that they need, as of_<key>; the pairs of one vector are dealt to several tasks."""
    other = "x" if key == "q" else "q"
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)))
    need = dealt.select(key, "list", "salt").distinct()
    step = 4 * F.ceil(F.col("dim") / lists)
    part = F.expr("substring(comps, cast(list * step + 1 as int), cast(step as int))")
    sent = need.join(vectors.select(F.col("uid").alias(key), "comps", step.alias("step")), key).select(key, "list", "salt", part.alias(f"of_{key}"))
    return dealt.join(sent, [key, "list", "salt"]).drop("salt")


def _partials(pairs: DataFrame, vectors: DataFrame, lists: int) -> DataFrame:
    """Exact partial scores of ``pairs`` (q, x, list)."""

    def run(batches):
        for batch in batches:
            flat = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<i4").astype(np.int64) for c in ("of_q", "of_x")]
            ends = np.cumsum(pc.binary_length(batch.column("of_q")).to_numpy() // 4)
            total = np.r_[0, np.cumsum(flat[0] * flat[1])]
            partial = total[ends] - total[np.r_[0, ends[:-1]]]
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("x"), batch.column("list"), pa.array(partial)], schema=_PAIRS)

    both = _fetched(_fetched(pairs.select("q", "x", "list"), vectors, "x", lists), vectors, "q", lists)
    return both.mapInArrow(run, _PAIRS_DDL)


def _whole(seen: DataFrame, vectors: DataFrame, lists: int) -> DataFrame:
    """Scores of pairs (q, x, partial, mask): what is known and what the other nodes add."""
    pairs = seen.select("q", "x", F.explode(F.sequence(F.lit(0), F.lit(lists - 1))).alias("list"), "mask")
    missing = pairs.where(F.expr("mask & shiftleft(1, list) = 0"))
    parts = seen.select("q", "x", "partial").unionByName(_partials(missing, vectors, lists).select("q", "x", "partial"))
    return parts.groupBy("q", "x").agg(F.sum("partial").alias("score"))


def _summed(entries: DataFrame) -> DataFrame:
    return entries.groupBy("q", "x").agg(F.sum("partial").alias("partial"), F.bit_or(F.expr("shiftleft(1, list)")).alias("mask"))


def search(embeddings: DataFrame, k: int = 5, every: int = 50, lists: int = LISTS, gather: int = GATHER) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row whose vec_id is divisible by ``every``."""
    rows = store(_rows(embeddings, k, every), "rows")
    least = F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, k + 1)
    grouped = rows.groupBy("dim", "comps").agg(least.alias("ids"), F.max(F.size("asks") > 0).alias("asks"))
    vectors = store(grouped.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    flat = vectors.withColumn("bucket", F.lit(0))
    blocks = grid.packed(flat, "blocks", ["uid"], lists=lists)
    asking = grid.packed(flat.where("asks"), "asking", ["uid"], QUERY_ROWS, lists)

    # gather: a safe cutoff for every query
    first = store(_summed(_gathered(grid.met(blocks, asking, "dim", "list"), -(-gather // grid.lanes(blocks)))), "gathered")
    known = _whole(first, vectors, lists).join(vectors.select(F.col("uid").alias("x"), F.size("ids").alias("copies")), "x")
    reached = known.withColumn("rows", F.sum("copies").over(Window.partitionBy("q").orderBy(F.col("score").desc(), "x")))
    cutoffs = store(reached.groupBy("q").agg(F.max(F.when(F.col("rows") > k, F.col("score"))).alias("cutoff")), "cutoffs")

    # collect: every vector that reaches the cutoff has an entry that reaches the threshold
    limits = flat.where("asks").join(cutoffs, F.col("uid") == F.col("q"), "left")
    least = F.expr(f"(cutoff + pmod(-cutoff, {lists})) div {lists}")
    limits = limits.withColumn("least", F.coalesce(least, F.lit(NO_CUTOFF)))
    limited = grid.packed(limits, "limited", ["uid", "least"], QUERY_ROWS, lists)
    entries = _summed(_collected(grid.met(blocks, limited, "dim", "list")))
    cutoffs = limits.select(F.col("uid").alias("q"), F.coalesce("cutoff", F.lit(NO_CUTOFF)).alias("cutoff"), "least")
    unseen = F.lit(lists) - F.bit_count("mask")
    able = store(entries.join(cutoffs, "q").where(F.col("partial") + unseen * (F.col("least") - 1) >= F.col("cutoff")).select("q", "x", "partial", "mask"), "able")

    # resolve
    whole = _whole(able, vectors, lists).join(cutoffs.select("q", "cutoff"), "q").where(F.col("score") >= F.col("cutoff"))
    named = whole.join(vectors.select(F.col("uid").alias("x"), "ids"), "x").select("q", (F.col("x") == F.col("q")).alias("self"), "score", F.explode("ids").alias("vec_id"))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id"))
    top = named.withColumn("place", place).where(F.col("place") <= k + 1)
    lists_ = top.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "self"))).alias("top"))
    answers = vectors.select(F.col("uid").alias("q"), "dim", "comps").join(lists_, "q")
    asked = rows.where(F.size("asks") > 0).join(answers, ["dim", "comps"]).select(F.explode("asks").alias("query_id"), "top")
    # of the rows with the query's vector and id one is the query's own
    own = F.array_position(F.transform("top", lambda t: t["self"] & (t["vec_id"] == F.col("query_id"))), True)
    return asked.withColumn("own", own).select(
        "query_id", F.posexplode(F.slice(F.filter("top", lambda t, i: i + 1 != F.col("own")), 1, k)).alias("rank", "hit")
    ).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.nullif(F.col("hit.vec_id"), F.lit(grid.NO_ID)).alias("vec_id"), F.col("hit.score").alias("score"),
    )
