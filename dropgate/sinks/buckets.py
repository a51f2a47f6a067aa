"""Tables kept in buckets of a key: a change reads and writes only the buckets that hold its keys.

One Parquet directory per bucket, replaced by dynamic partition overwrite.  A change of k keys touches at most k buckets, so with enough
buckets the bytes read and written follow the change, not the table.  Take ``buckets`` so that one holds about as
much as a task should read; a bucket with a hot key is larger and is written by several tasks, as several files.

Defined results: rows with a null key share a bucket and are never matched by a change; the table may hold a key several times (a log by its
profile), the source of an upsert may not; an empty change writes nothing.  A change is run once into scratch, so one that comes out
differently each time it is evaluated cannot lose a bucket.  One writer at a time.  A lost executor costs its tasks only; if
the driver is lost while finished buckets are moved into place, run the change again: it is complete by key.  Buckets whose files
were then still in the job's staging directory have to be moved by hand.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.joins import skew_anti_join
from ..operators.keys import upsert_by_key
from ..sources.tables import local_frame
from .writers import remove_dir, shared_dir

_BUCKET, _LIVE = "bucket", "is_row"


class BucketedTable:
    """A table of ``schema`` under ``path``, bucketed by ``keys``.

    The number of buckets is part of the path, so opening a table with another number than it was made with fails.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int):
        taken = {_BUCKET, _LIVE} & {f.name.lower() for f in schema.fields}
        if taken:
            raise ValueError(f"the table has columns of the layout: {sorted(taken)}")
        self.spark, self.schema, self.keys, self.buckets = spark, schema, list(keys), buckets
        self.path = f"{path.rstrip('/')}/buckets={buckets}"
        self._stored = T.StructType([*schema.fields, T.StructField(_LIVE, T.BooleanType()), T.StructField(_BUCKET, T.IntegerType())])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _typed(self, df: DataFrame) -> DataFrame:
        """Columns of the table get the table's types, so that equal keys have equal hashes; others stay."""
        types = {f.name: f.dataType for f in self.schema.fields}
        return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])

    def _rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        stored = self.spark.read.schema(self._stored).parquet(self.path)
        if buckets is not None:
            stored = stored.filter(F.col(_BUCKET).isin(list(buckets)))  # prunes directories
        return stored.filter(_LIVE).select(*self.schema.names)

    def read(self) -> DataFrame:
        return self._rows()

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows with one of the given keys, read from their buckets only."""
        wanted = self._typed(keys.select(*self.keys)).distinct()
        return self._rows(self._touched(wanted.withColumn(_BUCKET, self._bucket()))).join(wanted, self.keys, "left_semi")

    def create(self, df: DataFrame) -> None:
        """Replace the whole table."""
        rows = self._typed(df.select(*self.schema.names)).withColumn(_LIVE, F.lit(True)).withColumn(_BUCKET, self._bucket())
        self._write(rows, "static")

    def upsert(self, source: DataFrame) -> None:
        """Rows of ``source`` replace those with their key or are added; a key twice in it fails and changes nothing."""
        self.change(source.select(*self.schema.names), lambda rows, new: upsert_by_key(rows, new, self.keys))

    def delete(self, gone: DataFrame) -> None:
        """Rows with a key of ``gone`` go."""
        self.change(gone.select(*self.keys), lambda rows, keys: skew_anti_join(rows, keys, self.keys))

    def change(self, source: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """``apply(rows of the touched buckets, source)`` gives what these buckets hold afterwards.

        It must keep every row whose key is not in ``source`` and give no row with a key of another bucket, which fails the job.
        """
        scratch = shared_dir(self.spark, "change")
        try:
            self._typed(source).withColumn(_BUCKET, self._bucket()).write.parquet(scratch)
            staged = self.spark.read.parquet(scratch)
            touched = self._touched(staged)
            if not touched:
                return
            after = self._typed(apply(self._rows(touched), staged.drop(_BUCKET)).select(*self.schema.names))
            inside = F.when(self._bucket().isin(touched), self._bucket()).otherwise(
                F.raise_error(F.lit("the change gave a row of a bucket it does not touch")).cast("int")
            )
            rows = after.withColumn(_LIVE, F.lit(True)).withColumn(_BUCKET, inside)
            # a bucket without output would keep its old files: one mark per bucket makes sure that each is replaced
            marks = local_frame(self.spark, [(b,) for b in touched], T.StructType([self._stored[_BUCKET]]))
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
            self._write(rows.unionByName(marks.select(*empty, F.lit(False).alias(_LIVE), _BUCKET)), "dynamic")
        finally:
            remove_dir(self.spark, scratch)

    def _touched(self, keyed: DataFrame) -> list[int]:
        """Numbers of the buckets, at most ``buckets`` of them."""
        return sorted(r[0] for r in keyed.select(_BUCKET).distinct().collect())

    def _write(self, rows: DataFrame, overwrite: str) -> None:
        writer = rows.hint("rebalance", _BUCKET).write.mode("overwrite").option("partitionOverwriteMode", overwrite)
        writer.partitionBy(_BUCKET).parquet(self.path)
