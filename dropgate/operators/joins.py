"""Joins that survive a hot key on the large side: only keys measured as hot are spread."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

# a key with more rows than this is spread, one bucket for every so many of its rows
ROWS_PER_BUCKET = 1_000_000
# most keys that can be found hot, and the counters of the sketch that looks for them.  They bound what is
# broadcast to HOT_KEYS rows of two numbers; a key not among them owns less than a thousandth of the rows.
HOT_KEYS = 1_000
COUNTERS = 4_096


def key_hash(types: Sequence[T.StructField]):
    return F.xxhash64(*[F.col(f"`{f.name}`").cast(f.dataType) for f in types]).alias("__key")


def key_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> list[T.StructField]:
    """The key columns with the types that both sides widen to, so that equal keys have equal hashes."""
    columns = [F.col(f"`{c}`") for c in on]
    return left.select(*columns).union(right.select(*columns)).schema.fields


def hot_keys(df: DataFrame, types: Sequence[T.StructField], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Hashes of the keys with more than ``rows_per_bucket`` rows and their number of buckets: __key, __buckets.

    One pass over the key columns; every task sends one sketch of the frequent hashes and no rows.
    """
    found = df.select(key_hash(types)).agg(F.expr(f"approx_top_k(__key, {HOT_KEYS}, {COUNTERS})").alias("__top"))
    return _buckets(found.selectExpr("inline(__top)").selectExpr("item AS __key", "`count` AS __n"), rows_per_bucket)


def hot_counted(counts: DataFrame, types: Sequence[T.StructField], n: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """As ``hot_keys`` where the rows of each key are counted already, in column ``n``: exact, no sketch."""
    large = counts.filter(F.col(n) > rows_per_bucket).select(key_hash(types), F.col(n).alias("__n"))
    top = large.orderBy(F.desc("__n"), "__key").limit(HOT_KEYS)
    return _buckets(top.groupBy("__key").agg(F.sum("__n").alias("__n")), rows_per_bucket)


def _buckets(counted: DataFrame, rows_per_bucket: int) -> DataFrame:
    hot = counted.filter(F.col("__n") > rows_per_bucket)
    return hot.select("__key", F.ceil(F.col("__n") / rows_per_bucket).cast("int").alias("__buckets"))


def _salted(left: DataFrame, right: DataFrame, types: Sequence[T.StructField], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deal the rows of hot keys over their buckets and repeat the (unique-keyed) right side in those.

    All other keys stay in bucket 0 and the right side's rows with them are not repeated.  The bucket mixes the row's
    hash with its partition number, so identical copies spread too and a re-run task sends every row to the
    same bucket again.
    """
    hot = F.broadcast(hot)
    others = [F.col(f"`{c}`") for c in left.columns]
    bucket = F.pmod(F.xxhash64(*others) + F.spark_partition_id(), F.col("__buckets"))
    salt = F.when(F.col("__buckets").isNull(), 0).otherwise(bucket).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("__buckets", F.lit(1)) - 1))
    l = left.withColumn("__key", key_hash(types)).join(hot, "__key", "left").withColumn("__salt", salt)
    r = right.withColumn("__key", key_hash(types)).join(hot, "__key", "left").withColumn("__salt", copies)
    return l.drop("__key", "__buckets"), r.drop("__key", "__buckets")


def _matches(left: DataFrame, right: DataFrame, on: Sequence[str]):
    condition = left["__salt"] == right["__salt"]
    for c in on:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def skew_left_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET, hot: DataFrame | None = None
) -> DataFrame:
    """Left join to a right side with one row per key; null keys match null keys.

    ``hot`` (``__key``, ``__buckets``) saves the sketch where the left side's keys are counted already.
    Spark still broadcasts the right side by itself when its size is known to be small.
    """
    types = key_types(left, right, on)
    l, r = _salted(left, right, types, hot_keys(left, types, rows_per_bucket) if hot is None else hot)
    extra = [c for c in right.columns if c not in on]
    joined = l.join(r, _matches(l, r, on), "left")
    return joined.select(*[l[c] for c in left.columns], *[r[c] for c in extra])


def skew_anti_join(left: DataFrame, right: DataFrame, on: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; SQL equality, so a null key never matches."""
    keys = right.select(*on).distinct()
    types = key_types(left, keys, on)
    l, r = _salted(left, keys, types, hot_keys(left, types, rows_per_bucket))
    return l.join(r, [*on, "__salt"], "left_anti").select(*left.columns)
