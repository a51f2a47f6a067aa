"""Hard-negative mining with bounds carried along a spanning tree of anchors.

A score is the integer inner product of two vectors whose components are floor(256 x).  Anchors are packed into blocks of similar ones (by the signs of
random projections), and each block is spanned by a minimum spanning tree.  For the candidates of a block of vectors, the root is scored;
along an edge of length d, the score of a candidate with norm r changes by at most d r, so a parent's score, or its bounds, give bounds at the
child.  Only candidates whose bounds overlap the child's window are scored again, level by level of the tree.

* *Positives.*  The window of an anchor starts at the ``positives``-th highest lower bound among candidates of its label.
* *Negatives.*  The window of an anchor spans the windows of its positives, from ``low`` to ``high`` per cent of their scores; of what is
  inside, each positive takes the first ``negatives`` of its own window.

Vectors and anchors are dealt by a hash of the label, so that positives are sought among blocks that may hold the label, negatives among all.
A task keeps the best of its cell and sends only these; the best of all cells are the result.  No bound drops a row that belongs to the result: bounds are
widened by more than their rounding error, and every reported score is computed exactly.

Defined results: rows with a null label, a null vector, or null or non-finite components take no part, nor do those with a scaled component of 2^26 or more, whose
scores need not fit a long; vectors meet only those of the same length; rows without an id are no anchors, keep their label, and come last among ties (so does the
id 2^63 - 1, which is shown as null); repeated rows each take part as a row of their own; anchors without positives have no
result, nor have positives without negatives; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import grid
from .common import store

#: anchors in a block, and so in a tree; parts into which labels are dealt; signs of random projections that order anchors
TREE, BUCKETS, SIGNS = 256, 64, 16
#: entries a task holds before it keeps only the best
HELD = 1 << 20
#: a missing positive: its window holds nothing
NO_SCORE = -(1 << 62)

_ROWS = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("comps", pa.binary())])


def _rows(df: DataFrame, label: Column) -> DataFrame:
    """(vec_id, label, dim, comps) of the rows that take part."""

    def run(batches):
        for batch in batches:
            valid, flat, dims = grid.scaled(batch.column("embedding"))
            keep = pa.array(valid)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(keep).fill_null(grid.NO_ID), batch.column("label").filter(keep), pa.array(dims.astype(np.int32)), grid.binary(flat, dims)], schema=_ROWS)

    given = df.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("embedding")).where("label is not null")
    return given.mapInArrow(run, "vec_id long, label long, dim int, comps binary")


class Tree:
    """Puts the anchors of a block in the order in which Prim's algorithm reaches them, by level, and names each one's parent."""

    adds = ("parent", "level")

    def sort(self, matrix: np.ndarray) -> np.ndarray:
        """Similar vectors next to each other: ordered by the signs of random projections."""
        if not matrix.shape[1]:
            return np.arange(len(matrix))
        signs = matrix.astype(np.float64) @ np.random.default_rng(0).standard_normal((matrix.shape[1], SIGNS)) > 0
        return np.lexsort(signs.T)

    def __call__(self, matrix: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        n = len(matrix)
        a = matrix.astype(np.float64)
        squares = (a * a).sum(1)
        distance = squares[:, None] + squares[None, :] - 2 * (a @ a.T)
        parent, level = np.full(n, -1), np.zeros(n, np.int64)
        nearest, by = distance[0].copy(), np.zeros(n, np.int64)
        out = np.zeros(n, bool)
        out[0] = True
        for _ in range(n - 1):
            at = int(np.argmin(np.where(out, np.inf, nearest)))
            out[at], parent[at], level[at] = True, by[at], level[by[at]] + 1
            closer = distance[at] < nearest
            nearest[closer], by[closer] = distance[at][closer], at
        order = np.argsort(level, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        return order, [np.where(parent[order] < 0, -1, place[parent[order]]), level[order]]


def bounded(anchors: np.ndarray, parent: np.ndarray, level: np.ndarray, vectors: np.ndarray, overlap) -> tuple[np.ndarray, np.ndarray, int]:
    """Lower and upper bounds of the scores of all anchors with all vectors, and how many pairs were scored.

    ``overlap(rows, low, high)`` tells which candidates of some anchors overlap the window; those are scored, and their bounds are equal.
    """
    norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
    first = grid.products(anchors[:1], vectors).astype(np.float64)
    low, high = (np.empty((len(anchors), len(vectors))) for _ in range(2))
    low[0] = high[0] = first[0]
    scored = len(vectors)
    for depth in range(1, int(level[-1]) + 1):
        rows = np.flatnonzero(level == depth)
        up = parent[rows]
        edge = np.sqrt(((anchors[rows].astype(np.float64) - anchors[up]) ** 2).sum(1))
        reach = edge[:, None] * norms[None, :] * (1 + 1e-9) + 1e-6 * (edge[:, None] > 0)
        below, above = low[up] - reach, high[up] + reach
        again = overlap(rows, below, above)
        again &= below < above  # the same vector as its parent: known
        columns = np.flatnonzero(again.any(0))
        if len(columns):
            s = grid.products(anchors[rows], vectors[columns])
            at = again[:, columns]
            i, j = np.nonzero(at)
            below[i, columns[j]] = above[i, columns[j]] = s[i, j]
            scored += len(i)
        low[rows], high[rows] = below, above
    return low, high, scored


_HITS = pa.schema([("a", pa.int64()), ("place", pa.int32()), ("x", pa.int64()), ("x_id", pa.int64()), ("score", pa.int64())])
_HITS_DDL = "a long, place int, x long, x_id long, score long"


def _best(cells: DataFrame, one, most: int) -> DataFrame:
    """The ``most`` best hits for every (anchor, place) of each cell; ``one`` finds those of a block of vectors and one of anchors."""

    def run(batches):
        held: list[tuple] = []
        size, at = 0, None

        def kept():
            a, place, x, x_id, s = (np.concatenate(c) for c in zip(*held))
            keep = grid.best((place, a), s, x_id, most)
            return a[keep], place[keep], x[keep], x_id[keep], s[keep]

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32) if f.name == "place" else c, f.type) for c, f in zip(kept(), _HITS)], schema=_HITS)

        for batch in batches:
            for r in range(batch.num_rows):
                c = {name: batch.column(name)[r] for name in batch.schema.names}
                key = tuple(c[k].as_py() for k in ("dim", "lane_v", "lane_q"))
                if held and key != at:
                    yield from out()
                    held, size = [], 0
                at = key
                hits = one(c)
                if len(hits[0]):
                    held.append(hits)
                    size += len(hits[0])
                if size > HELD:
                    held = [kept()]
                    size = len(held[0][0])
        if held:
            yield from out()

    return cells.mapInArrow(run, _HITS_DDL)


def _per_cent(scores: np.ndarray, percent: int) -> np.ndarray:
    """floor(percent * score / 100) without overflow."""
    return scores // 100 * percent + scores % 100 * percent // 100


def _columns(c: dict, *names: str) -> list[np.ndarray]:
    return [grid.longs(c[n]) for n in names]


def _positives_of(most: int):
    """Finds the best candidates of its own label for every anchor."""

    def one(c):
        uid, ids, label, a, labels, parent, level = _columns(c, "uid", "vec_id", "label", "q_uid", "q_label", "q_parent", "q_level")
        x, of = grid.matrix(c["comps"], len(uid)), grid.matrix(c["q_comps"], len(a))
        able = (labels[:, None] == label[None, :]) & (a[:, None] != uid[None, :])
        if not able.any():
            return (np.empty(0, np.int64),) * 5
        few = min(most, len(uid))

        def window(rows, low, high):
            mine = np.where(able[rows], low, -np.inf)
            least = np.partition(mine, len(uid) - few, axis=1)[:, len(uid) - few]
            return able[rows] & (high >= least[:, None])

        low, high, _ = bounded(of, parent, level, x, window)
        # what is not exact lies below the window; the best are exact
        i, j = np.nonzero(able & (low == high))
        s = low[i, j].astype(np.int64) if _exact(low) else _again(of, x, i, j)
        keep = grid.best((i,), s, ids[j], few)
        return a[i[keep]], np.zeros(len(keep), np.int64), uid[j[keep]], ids[j[keep]], s[keep]

    return one


def _exact(scores: np.ndarray) -> bool:
    return bool(np.abs(scores).max(initial=0) < 1 << 53)


def _again(anchors: np.ndarray, vectors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Scores of pairs in 64-bit integers."""
    return np.einsum("nd,nd->n", anchors[i].astype(np.int64), vectors[j].astype(np.int64)) if len(i) else np.empty(0, np.int64)


def _negatives_of(positives: int, most: int, low_percent: int, high_percent: int):
    """Finds the best candidates of other labels in the window of every positive."""

    def one(c):
        uid, ids, label, a, labels, parent, level = _columns(c, "uid", "vec_id", "label", "q_uid", "q_label", "q_parent", "q_level")
        x, of = grid.matrix(c["comps"], len(uid)), grid.matrix(c["q_comps"], len(a))
        given = np.stack(_columns(c, *(f"q_positive{p}" for p in range(positives))), axis=1)
        some = given != NO_SCORE
        least, most_ = np.where(some, -_per_cent(-given, low_percent), 1), np.where(some, _per_cent(given, high_percent), 0)
        # floats of long integers are rounded: wide enough here, the exact test follows
        from_, to = np.where(some, least * (1 - np.sign(least) * 1e-12), np.inf).min(1), np.where(some, most_ * (1 + np.sign(most_) * 1e-12), -np.inf).max(1)
        able = labels[:, None] != label[None, :]
        if not able.any():
            return (np.empty(0, np.int64),) * 5

        def window(rows, low, high):
            return able[rows] & (high >= from_[rows, None]) & (low <= to[rows, None])

        low, high, _ = bounded(of, parent, level, x, window)
        i, j = np.nonzero(able & (low == high) & (low >= from_[:, None]) & (low <= to[:, None]))
        s = low[i, j].astype(np.int64) if _exact(low) else _again(of, x, i, j)
        found = []
        for p in range(positives):
            inside = np.flatnonzero((s >= least[i, p]) & (s <= most_[i, p]))
            keep = inside[grid.best((i[inside],), s[inside], ids[j[inside]], most)]
            found.append((a[i[keep]], np.full(len(keep), p + 1), uid[j[keep]], ids[j[keep]], s[keep]))
        return tuple(np.concatenate(f) for f in zip(*found))

    return one


def mine(embeddings: DataFrame, label: Column, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every row whose vec_id is divisible by ``every``.

    A negative's score is from ``low`` to ``high`` per cent of the positive's; ``label`` gives a row's label.
    """
    rows = _rows(embeddings, label.cast("long")).withColumn("bucket", F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int"))
    vectors = store(rows.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    is_anchor = (F.col("vec_id") != grid.NO_ID) & (F.col("vec_id") % every == 0)
    anchors = vectors.where(is_anchor)
    blocks = grid.packed(vectors, "blocks", ["uid", "vec_id", "label"])
    asking = grid.packed(anchors, "anchors", ["uid", "label"], TREE, arrange=Tree())

    hits = _best(grid.met(blocks, asking, "dim", "bucket"), _positives_of(positives), positives)
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.col("score").desc(), "x_id", "x"))
    near = store(hits.withColumn("place", place).where(F.col("place") <= positives), "positives")

    known = near.groupBy("a").agg(*[F.coalesce(F.max(F.when(F.col("place") == p + 1, F.col("score"))), F.lit(NO_SCORE)).alias(f"positive{p}") for p in range(positives)])
    windows = anchors.join(known.withColumnRenamed("a", "uid"), "uid")
    asking = grid.packed(windows, "windows", ["uid", "label", *(f"positive{p}" for p in range(positives))], TREE, arrange=Tree())
    hits = _best(grid.met(blocks, asking, "dim"), _negatives_of(positives, negatives, low, high), negatives)
    rank = F.row_number().over(Window.partitionBy("a", "place").orderBy(F.col("score").desc(), "x_id", "x"))
    found = hits.withColumn("rank", rank).where(F.col("rank") <= negatives)

    def shown(id_: Column) -> Column:
        return F.nullif(id_, F.lit(grid.NO_ID))

    pairs = near.select("a", "place", F.col("x_id").alias("p_id"), F.col("score").alias("p_score"))
    names = anchors.select(F.col("uid").alias("a"), F.col("vec_id").alias("a_id"))
    return found.join(pairs, ["a", "place"]).join(names, "a").select(
        F.col("a_id").alias("anchor_id"), shown(F.col("p_id")).alias("positive_id"), "rank", shown(F.col("x_id")).alias("negative_id"),
        F.col("p_score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
