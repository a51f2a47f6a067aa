"""Operations on the file-configuration table, each from DataFrame to DataFrame."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import model
from .ids import with_next_ids

PATCHABLE = list(model.PROFILE_DEFAULTS)


def register(profiles: DataFrame, names: DataFrame, path: str) -> DataFrame:
    """Register file names (column ``file_name``).

    A known name gets its parse fields reset to the defaults and keeps id, path and format; an unknown
    one is added with the defaults.  A name known twice fails the job.
    """
    wanted = names.select("file_name").distinct()
    known = profiles.groupBy("file_name").agg(F.count(F.lit(1)).alias("__known"))
    marked = profiles.join(
        wanted.join(known, "file_name")
        .withColumn(
            "__reset",
            F.when(F.col("__known") == 1, True).otherwise(
                F.raise_error(F.lit("several profiles have this file name")).cast("boolean")
            ),
        )
        .select("file_name", "__reset"),
        "file_name",
        "left",
    )
    updated = marked.select(
        *[
            F.when(F.col("__reset"), F.lit(model.PROFILE_DEFAULTS[c]).cast(profiles.schema[c].dataType))
            .otherwise(F.col(c)).alias(c)
            if c in model.PROFILE_DEFAULTS
            else F.col(c)
            for c in profiles.columns
        ]
    )
    new = with_next_ids(wanted.join(profiles, "file_name", "left_anti"), profiles, ["file_name"])
    values = {"file_format": "csv", "path": path.rstrip("/") + "/", **model.PROFILE_DEFAULTS}
    added = new.select(
        *[
            (F.lit(values[c]) if c in values else F.col(c)).cast(profiles.schema[c].dataType).alias(c)
            for c in profiles.columns
        ]
    )
    return updated.unionByName(added)


def get(profiles: DataFrame, config_id: int) -> DataFrame:
    """The profile of an id; no row when absent."""
    return profiles.filter(F.col("id") == config_id)


def patch(profiles: DataFrame, patches: DataFrame) -> DataFrame:
    """Partial update by id.

    ``patches`` has one row per id, a column per changed field and a boolean ``set_<field>``: true writes
    the value, null included; false or a missing column leaves the field.
    """
    fields = [c for c in PATCHABLE if f"set_{c}" in patches.columns]
    renamed = patches.select("id", *[F.col(c).alias(f"__new_{c}") for c in fields], *[f"set_{c}" for c in fields])
    joined = profiles.join(renamed, "id", "left")
    return joined.select(
        *[
            F.when(F.col(f"set_{c}"), F.col(f"__new_{c}").cast(profiles.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in fields
            else F.col(c)
            for c in profiles.columns
        ]
    )


def delete(profiles: DataFrame, ids: Sequence[int]) -> DataFrame:
    return profiles.filter(~F.col("id").isin(list(ids)))
