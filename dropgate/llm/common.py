"""What the operators share: tables, scratch tables in the shared folder, words, row helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: separators of words: space and the ASCII control characters 9 to 13 (also what bytes.split() uses)
SPACE = r"[\x20\x09-\x0D]+"
#: rows up to which a key table (16 bytes a row) may be sent to every executor
BROADCAST_ROWS = 1_000_000

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: paths of the tables stored in the scope that is open, if one is
_open: ContextVar[list[str] | None] = ContextVar("scratch tables", default=None)
#: paths of those stored outside any scope; their reader is their owner
_scratch: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset (tests), one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch").rstrip("/")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    if (here := _open.get()) is not None:
        here.append(path)
    else:
        _scratch.append(path)
    return out


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A scope of scratch tables: those stored inside are deleted at its end, but for those given to ``keep``, which pass to the scope around.

    Scopes belong to the thread that opens them, so jobs side by side don't touch each other's tables.  Nothing lazy may read a table that goes.
    """
    around, mine = _open.get(), []
    token = _open.set(mine)

    def keep(df: DataFrame) -> DataFrame:
        mine.remove(df.scratch_path)
        (_scratch if around is None else around).append(df.scratch_path)
        return df

    try:
        yield keep
    finally:
        _open.reset(token)
        _delete(spark, mine)


def discard(*tables: DataFrame) -> None:
    """Delete tables stored in the open scope, or outside any, before its end; frames that were not stored are left alone."""
    here = _scratch if _open.get() is None else _open.get()
    for df in tables:
        path = getattr(df, "scratch_path", None)
        if path in here:
            here.remove(path)
            _delete(df.sparkSession, [path])


def words(text: Column) -> Column:
    """The words of a text as an array; empty for null."""
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.array_remove(F.split(text, SPACE), ""))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def by_batch(make: Callable[[], Callable[[dict[str, list]], dict[str, object]]], schema: pa.Schema, rows: int = 512):
    """A function for mapInArrow: ``make()``, called once a task, gives a function of column lists that returns columns.

    It sees at most ``rows`` rows at once.
    """

    def run(batches):
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows).to_pydict())
                columns = [v if isinstance(v, pa.Array) else pa.array(v, f.type) for f, v in ((f, out[f.name]) for f in schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def semi_join(left: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``left`` whose key is in the stored table ``keys``; sent to all executors only if its counted size allows."""
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return left.join(keys, on, "left_semi")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
