"""Key and reference checks."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .joins import skew_anti_join

# Fixed value: separator of the concatenated key.
KEY_SEPARATOR = "§"


def duplicate_keys(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Repeated keys with their row counts (n_rows).  Counting starts before the shuffle, so a key that
    owns a third of the rows sends one row per task."""
    return df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def duplicate_keys_concat(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As ``duplicate_keys`` on one concatenated text key: nulls are skipped, so different keys may
    collide, and without keys every row is alike."""
    key = F.concat_ws(KEY_SEPARATOR, *[F.col(f"`{k}`") for k in keys]).alias("pk")
    return df.select(key).groupBy("pk").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def key_is_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row, column ``is_unique``; an empty key list is unique."""
    if not keys:
        return df.limit(1).agg(F.lit(True).alias("is_unique"))
    return duplicate_keys(df, keys).agg((F.count(F.lit(1)) == 0).alias("is_unique"))


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str, where: Column | None = None) -> DataFrame:
    """Foreign keys without a parent, with their row counts (n_rows).  Null keys are no orphans.

    The child is reduced to one row per key before the join, so a hot key does not reach it.
    """
    rows = child if where is None else child.filter(where)
    found = rows.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows"))
    return found.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def delete_by_key(table: DataFrame, key: str, deleted: DataFrame) -> DataFrame:
    """Rows of ``table`` that stay when the keys in ``deleted`` (column named as ``key``) are removed."""
    return skew_anti_join(table, deleted, [key])


def cascade_delete(
    profiles: DataFrame, log: DataFrame, negative: DataFrame, deleted: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What stays of the three tables after deleting profiles by ``id``.

    Log rows go with their profile and negative rows with their log row.  A negative row carries its
    log row's ``file_config_id``, so it can be removed by that without joining the two logs.
    """
    by_profile = deleted.select(F.col("id").alias("file_config_id"))
    return (
        delete_by_key(profiles, "id", deleted.select("id")),
        delete_by_key(log, "file_config_id", by_profile),
        delete_by_key(negative, "file_config_id", by_profile),
    )


def upsert_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows with incoming rows winning; a key twice in ``source`` fails the job.

    The check and the anti join use the same hash of the key, so the source is shuffled once.
    """
    others = [c for c in source.columns if c not in keys]
    single = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in others]
    )
    once = F.when(F.col("__n") == 1, True).otherwise(
        F.raise_error(F.lit("upsert source holds a key more than once")).cast("boolean")
    )
    incoming = single.filter(once).select(*source.columns)
    kept = target.join(source.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(incoming)
