"""Queries over the verdict log."""

from __future__ import annotations

import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import model
from ..operators.joins import skew_left_join
from ..sources.tables import local_frame

LOG_COLUMNS = [f.name for f in model.VERDICT_LOG.fields]

#: column of a log kept by day: the UTC day of ``logged_at``, whatever the session's zone
DAY = "day"


def day_of(at: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(at.cast("timestamp")) / 86400).cast("int"))


def list_log(log: DataFrame) -> DataFrame:
    return log.select(*LOG_COLUMNS)


def filter_log(
    log: DataFrame,
    environment: str | None = None,
    from_date: datetime.date | str | None = None,
    to_date: datetime.date | str | None = None,
    flag: str | None = None,
) -> DataFrame:
    """Newest first.  Both bounds are inclusive; a date means its midnight, so ``to_date`` keeps nothing
    after 00:00 of that day.  Of a log kept by day only the days between are read."""
    out = log
    if environment is not None:
        out = out.filter(F.col("environment") == environment)
    if from_date is not None:
        low = F.lit(str(from_date)).cast("timestamp")
        out = _on_days(out.filter(F.col("logged_at") >= low), F.col(DAY) >= day_of(low))
    if to_date is not None:
        high = F.lit(str(to_date)).cast("timestamp")
        out = _on_days(out.filter(F.col("logged_at") <= high), F.col(DAY) <= day_of(high))
    if flag is not None:
        out = out.filter(F.col("validation_flag") == flag)
    return out.orderBy(F.desc("logged_at"), F.desc("id"))


def _on_days(log: DataFrame, where: Column) -> DataFrame:
    return log.filter(where) if DAY in log.columns else log


def latest(log: DataFrame, n: int = 20) -> DataFrame:
    return log.orderBy(F.desc("logged_at"), F.desc("id")).limit(n)


def sort_log(log: DataFrame, column: str, ascending: bool = True) -> DataFrame:
    """Numbers and times by value, text without case and null as the word 'null'; ties by id."""
    kind = log.schema[column].dataType
    c = F.col(column)
    if not isinstance(kind, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType)):
        c = F.lower(F.coalesce(c.cast("string"), F.lit("null")))
    return log.orderBy(c.asc() if ascending else c.desc(), F.col("id").asc())


def page(log: DataFrame, size: int, after: tuple[Any, int] | None = None) -> DataFrame:
    """A page of the log, newest first; ``after`` is the (logged_at, id) of the last row seen."""
    out = log
    if after is not None:
        at, last = F.lit(after[0]).cast("timestamp"), F.lit(after[1])
        out = out.filter((F.col("logged_at") < at) | ((F.col("logged_at") == at) & (F.col("id") < last)))
        out = _on_days(out, F.col(DAY) <= day_of(at))
    return out.orderBy(F.desc("logged_at"), F.desc("id")).limit(size)


def with_local_time(log: DataFrame, zone: str = "Europe/Madrid") -> DataFrame:
    """``local_time``: the row's time as dd/MM/yyyy, HH:mm:ss in a zone.

    Times without zone are UTC; the session's own zone does not matter.
    """
    without_zone = isinstance(log.schema["logged_at"].dataType, T.TimestampNTZType)
    source = F.lit("UTC") if without_zone else F.current_timezone()
    local = F.convert_timezone(source, F.lit(zone), F.col("logged_at").cast("timestamp_ntz"))
    return log.withColumn("local_time", F.date_format(local, "dd/MM/yyyy, HH:mm:ss"))


def glossary(spark: SparkSession) -> DataFrame:
    columns = ("validation_flag", "phase", "meaning")
    return local_frame(spark, model.FLAGS, T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def with_outcome(log: DataFrame) -> DataFrame:
    """Flag meaning and class: passed, failed, unconfigured, or unknown."""
    code = F.col("validation_flag").try_cast("int")
    outcome = (
        F.when(F.col("validation_flag") == model.PASSED, "passed")
        .when(F.col("validation_flag") == "99", "unconfigured")
        .when(code.between(30, 49), "failed")
        .otherwise("unknown")
    )
    joined = log.join(glossary(log.sparkSession), "validation_flag", "left")
    return joined.select(*log.columns, "phase", "meaning", outcome.alias("outcome"))


def error_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("file_name", "validation_flag").agg(F.count(F.lit(1)).alias("n"))


def pass_rates(log: DataFrame) -> DataFrame:
    """Verdicts per day: n, n_passed and the share that passed."""
    passed = F.col("validation_flag") == model.PASSED
    return log.groupBy(F.date_trunc("day", "logged_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(passed).alias("n_passed"),
        (F.count_if(passed) / F.count(F.lit(1))).alias("pass_rate"),
    )


def with_profile(log: DataFrame, profiles: DataFrame) -> DataFrame:
    """Log rows next to their profile (inner join); profile columns are prefixed ``cfg_``.

    One profile may own most of the log: its rows are spread if they are measured to be many.
    """
    cfg = profiles.filter("id IS NOT NULL").select(
        F.col("id").cast("int").alias("file_config_id"), *[F.col(c).alias(f"cfg_{c}") for c in profiles.columns]
    )
    return skew_left_join(log, cfg, ["file_config_id"]).filter("cfg_id IS NOT NULL")


def negative_rows(log: DataFrame) -> DataFrame:
    """Verdicts with flag 30 or above, 99 included, as ``trigger_id`` + the other columns.

    A flag that is no integer (a phase-passed marker) is not negative.
    """
    return log.filter(F.col("validation_flag").try_cast("int") >= 30).withColumnRenamed("id", "trigger_id")
