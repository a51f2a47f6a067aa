"""A stated set of query vectors against all vectors, in blocks: what the searches over embeddings share.

Vectors are packed into blocks of at most ``ROWS`` rows and ``BYTES`` bytes, a matrix in a binary column.  Blocks of vectors and blocks of queries
are dealt to the cells of a grid: a block of vectors goes once to every lane of the queries, a block of queries once to every lane
of the vectors, so that the shuffle grows with the product of lanes, not of rows, and a cell holds a bounded number of blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

#: most rows and bytes of a block, blocks of vectors and of queries in a cell
ROWS, BYTES = 4096, 1 << 22
VECTOR_BLOCKS, QUERY_BLOCKS = 256, 16
#: most partitions of a grid
TASKS = 20_000
#: a row without an id is named so inside
NO_ID = (1 << 63) - 1
#: scaled components reach the magnitude of at most this; longer ones would not leave room for a 64-bit product
LARGEST = 1 << 26


def scaled(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is valid, flat 32-bit components of the valid rows, their dimensions): floor(256 x) of lists of doubles."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    length = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    x = np.floor(256.0 * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))  # null components become nan
    bad = ~(np.abs(x) < LARGEST)
    ends = np.cumsum(length)
    before = np.r_[0, np.cumsum(bad)]
    valid = (before[ends] == before[ends - length]) & ~vectors.is_null().to_numpy(zero_copy_only=False)
    x = x[np.repeat(valid, length)]
    return valid, x.astype("<i4"), length[valid]


def binary(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column from flat values and the number of values of each row."""
    ends = np.cumsum(lengths) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(np.r_[0, ends].astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def width(dim: int, lists: int) -> int:
    """Components in each of ``lists`` parts of a vector; the last part may have fewer."""
    return -(-dim // lists)


def packed(rows: DataFrame, name: str, longs: list[str], rows_per_block: int = ROWS, lists: int = 1, arrange: Callable | None = None) -> DataFrame:
    """Rows (dim, bucket, comps and the long columns ``longs``) as stored blocks (list, dim, bucket, no, rows, longs..., comps).

    Rows of one dimension and bucket share a block.  ``arrange`` puts the rows of a block in order, given the matrix: it returns the
    order and more columns of longs, one for each of ``arrange.adds``.
    """
    adds = list(getattr(arrange, "adds", ()))
    schema = pa.schema([("list", pa.int32()), ("dim", pa.int32()), ("bucket", pa.int32()), ("rows", pa.int32()), *((c, pa.binary()) for c in (*longs, *adds, "comps"))])
    ddl = "list int, dim int, bucket int, rows int, " + ", ".join(f"{c} binary" for c in (*longs, *adds, "comps"))

    def blocks(key: tuple[int, int], parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        dim, bucket = key
        matrix = np.concatenate([p[-1] for p in parts])
        columns = [np.concatenate([p[i] for p in parts]) for i in range(len(longs))]
        most = max(1, min(rows_per_block, BYTES // max(4, 4 * dim)))
        order = arrange.sort(matrix) if arrange else np.arange(len(matrix))
        for at in range(0, len(order), most):
            mine = order[at : at + most]
            more = []
            if arrange:
                within, more = arrange(matrix[mine])
                mine = mine[within]
            w = width(dim, lists)
            for i in range(lists):
                values = [*(c[mine].astype("<i8") for c in columns), *(m.astype("<i8") for m in more), matrix[mine, i * w : (i + 1) * w]]
                head = [pa.array([x], pa.int32()) for x in (i, dim, bucket, len(mine))]
                yield pa.RecordBatch.from_arrays([*head, *(pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in values)], schema=schema)

    def run(batches):
        held: dict[tuple[int, int], list[tuple]] = {}
        sizes: dict[tuple[int, int], int] = {}
        for batch in batches:
            dims, buckets = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "bucket"))
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in longs]
            for key in set(zip(dims.tolist(), buckets.tolist())):
                at = np.flatnonzero((dims == key[0]) & (buckets == key[1]))
                flat = np.frombuffer(b"".join(batch.column("comps").take(pa.array(at)).to_pylist()), "<i4")
                held.setdefault(key, []).append((*(c[at] for c in columns), flat.reshape(len(at), key[0])))
                sizes[key] = sizes.get(key, 0) + len(at)
                if sizes[key] >= 16 * ROWS:
                    yield from blocks(key, held.pop(key))
                    del sizes[key]
        for key, parts in held.items():
            yield from blocks(key, parts)

    n = rows.count()
    return store(rows.select("dim", "bucket", *longs, "comps").repartition(max(1, -(-n // (16 * ROWS)))).mapInArrow(run, ddl).withColumn("no", F.monotonically_increasing_id()), name)


def lanes(blocks: DataFrame, most: int = VECTOR_BLOCKS) -> int:
    """How many lanes hold at most about ``most`` blocks each, and give every core one if there are blocks enough."""
    n = blocks.where("list = 0").count()
    return max(1, -(-n // most), min(n, blocks.sparkSession.sparkContext.defaultParallelism) if most == VECTOR_BLOCKS else 1)


def met(vectors: DataFrame, queries: DataFrame, *on: str) -> DataFrame:
    """Every block of ``vectors`` beside every block of ``queries`` with equal ``on``; columns of the queries get a ``q_``.

    Rows of one cell (lane_v, lane_q) follow each other.
    """
    spark = vectors.sparkSession
    v, q = lanes(vectors), lanes(queries, QUERY_BLOCKS)
    keys = [*on, "lane_v", "lane_q"]
    tasks = min(TASKS, max(v * q, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    left = vectors.withColumns({"lane_v": F.pmod(F.xxhash64("no"), F.lit(v)), "lane_q": F.explode(F.sequence(F.lit(0), F.lit(q - 1)))})
    right = queries.select(*[F.col(c).alias(c if c in on else f"q_{c}") for c in queries.columns])
    right = right.withColumns({"lane_q": F.pmod(F.xxhash64("q_no"), F.lit(q)).cast("int"), "lane_v": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(v - 1).cast("long")))})
    return left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys)


def longs(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), "<i8")


def matrix(value, rows: int) -> np.ndarray:
    flat = np.frombuffer(value.as_buffer(), "<i4")
    return flat.reshape(rows, len(flat) // max(1, rows))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two integer matrices, exact, as 64-bit integers or floats that hold them exactly."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return a.astype(kind) @ b.astype(kind).T


def best(groups: tuple[np.ndarray, ...], score: np.ndarray, tie: np.ndarray, most: int) -> np.ndarray:
    """Positions of the ``most`` highest scores of every group, ties to the smaller ``tie``, in order."""
    order = np.lexsort((tie, -score, *groups))
    if not len(order):
        return order
    fresh = np.zeros(len(order), bool)
    fresh[0] = True
    for g in groups:
        fresh[1:] |= g[order][1:] != g[order][:-1]
    first = np.flatnonzero(fresh)
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return order[place < most]
