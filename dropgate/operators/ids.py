"""Dense ids for new rows, safe on many executors."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

ROWS_PER_BUCKET = 1_000_000
# values looked at for each bucket when the ranges are chosen
SAMPLES_PER_BUCKET = 32


def with_next_ids(
    new: DataFrame,
    existing: DataFrame | int,
    order: Sequence[str],
    id_column: str = "id",
    bucket: Column | None = None,
) -> DataFrame:
    """Number ``new`` from max(existing id) + 1 without gaps, as a leading ``id_column``.

    ``existing`` is the table that holds the ids so far, or the largest of them where it is known.  Rows are
    numbered inside ranges of the (unique) ``order`` tuple and shifted by the sizes of the ranges before, so ids
    follow ``order`` at every size, whatever the ranges are.  Nothing depends on partition numbers or arrival
    order: a re-run task yields the same ids.  Ranges grow in number, not in size: no window sees more than about
    ``ROWS_PER_BUCKET`` rows, however few values the first columns have (a ``bucket`` of the caller's must rise
    with ``order`` and keep to that too), and the window over range sizes has one row per range.  ``new`` is read
    more than once: pass a stored table.
    """
    if bucket is None:
        bucket = _range_of(new, order)
    rows = new.withColumn("__bucket", bucket.cast("bigint"))
    sizes = rows.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__size"))
    before = F.coalesce(F.sum("__size").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = existing if isinstance(existing, int) else existing.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint")).scalar()
    offsets = sizes.select("__bucket", before.alias("__before"))
    in_bucket = F.row_number().over(Window.partitionBy("__bucket").orderBy(*order))
    return (
        rows.withColumn("__n", in_bucket)
        .join(offsets, "__bucket")
        .select((F.lit(last) + F.col("__before") + F.col("__n")).cast("bigint").alias(id_column), *new.columns)
    )


def _range_of(new: DataFrame, order: Sequence[str]) -> Column:
    """The range of the order tuple a row lies in; cuts come from rows picked by their hash, one reaches the driver per range."""
    n = new.count()
    ranges = max(1, -(-n // ROWS_PER_BUCKET))
    if ranges == 1:
        return F.lit(0)
    share = min(1.0, ranges * SAMPLES_PER_BUCKET / n)
    picked = F.pmod(F.xxhash64(*order), F.lit(1 << 30)) < int(share * (1 << 30))
    place = F.row_number().over(Window.orderBy(*order))
    sampled = new.where(picked).select(*order).distinct().withColumn("__place", place)
    cuts = sampled.where(F.col("__place") % SAMPLES_PER_BUCKET == 0).orderBy("__place").select(*order).collect()
    if not cuts:
        return F.lit(0)
    kinds = [new.schema[c].dataType for c in order]
    sorted_cuts = F.array(*[F.struct(*[F.lit(v).cast(k).alias(c) for v, k, c in zip(row, kinds, order)]) for row in cuts])
    return _at_or_before(sorted_cuts, len(cuts), F.struct(*[F.col(c).alias(c) for c in order]))


def _at_or_before(cuts: Column, n: int, value: Column) -> Column:
    """How many of the ``n`` sorted cuts are at most ``value``, by halving; nulls come first, as in a sort."""
    middle = lambda s: F.floor((s["low"] + s["high"]) / 2).cast("int")

    def step(s: Column, _: Column) -> Column:
        open_, reached = s["low"] < s["high"], F.get(cuts, middle(s)) <= value
        low = F.when(open_ & reached, middle(s) + 1).otherwise(s["low"])
        return F.struct(low.cast("int").alias("low"), F.when(open_ & ~reached, middle(s)).otherwise(s["high"]).cast("int").alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.lit(n).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length())), start, step, lambda s: s["low"])


def max_id(table: DataFrame, id_column: str = "id") -> DataFrame:
    return table.agg(F.max(id_column).alias("max_id"))
