"""Queries of stored layouts: tables in buckets of their key, and the verdict log kept by day."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import registry
from ..plans import logqueries as L
from ..sinks import writers
from ..sinks.buckets import BucketedTable
from . import fixtures as fx, table_queries as tq
from .base import ORACLES, query
from .file_queries import _INCOMING

#: enough for tables of the test sizes; one bucket for every so many bytes of a real one, see ``sinks.buckets``
BUCKETS = 32


def _table(spark, df, name, keys):
    table = BucketedTable(spark, writers.shared_dir(spark, name), df.schema, keys, BUCKETS)
    table.create(df)
    return table


@query("bucketed_upsert", ORACLES["sink_upsert_by_key"])
def bucketed_upsert(spark, sf):
    """As ``sink_upsert_by_key``, in the buckets of the incoming ids."""
    table = _table(spark, fx.log(spark, sf).select("id", "file_name", "validation_flag"), "log", ["id"])
    table.upsert(fx.frame(spark, sf, _INCOMING.format(log=fx.LOG)))
    return table.read()


@query("bucketed_patch", ORACLES["config_patch"])
def bucketed_patch(spark, sf):
    table = _table(spark, fx.configs(spark, sf), "profiles", ["id"])
    table.change(fx.frame(spark, sf, tq._PATCH), registry.patch)
    return table.read()


@query("bucketed_cascade", ORACLES["cascade_delete"])
def bucketed_cascade(spark, sf):
    """Profiles deleted with their log rows: the three tables lie in buckets of the profile's id."""
    log, gone = fx.log(spark, sf), fx.frame(spark, sf, tq._DELETED)
    parts = [
        ("file_configuration", fx.configs(spark, sf), "id", "id"),
        ("trigger_control", log, "file_config_id", "id"),
        ("negative_flag_logs", L.negative_rows(log), "file_config_id", "trigger_id"),
    ]
    out = None
    for name, rows, key, shown in parts:
        table = _table(spark, rows, name, [key])
        table.delete(gone.select(F.col("id").alias(key)))
        left = table.read().select(F.lit(name).alias("tbl"), F.col(shown).cast("bigint").alias("id"))
        out = left if out is None else out.unionByName(left)
    return out


# --- the log by day ----------------------------------------------------------------------------

_IDS = f"SELECT row_number() OVER (ORDER BY id) AS id, * EXCLUDE (id) FROM ({fx.duck(fx.LOG)}) l"


def _day_log(spark, sf):
    """The log written in four batches by event, all but the newest compacted."""
    rows = fx.log(spark, sf).withColumn("logged_at", F.col("logged_at").cast("timestamp"))
    rows = rows.withColumn("path", F.lpad(F.col("id").cast("string"), 19, "0"))
    top = rows.agg(F.max("id")).first()[0] or 0
    log = writers.VerdictLog(spark, writers.shared_dir(spark, "by-day"))
    for batch in range(4):
        part = rows.filter((F.col("id") * 4 > top * batch) & (F.col("id") * 4 <= top * (batch + 1)))
        log.write_batch(part.drop("id"), "events", batch)
    log.compact("events")
    return log


def _shown(log_rows):
    return log_rows.select(*L.LOG_COLUMNS).withColumn("logged_at", F.col("logged_at").cast("timestamp_ntz"))


_COLUMNS = ", ".join(L.LOG_COLUMNS)


@query(
    "day_log_filter",
    f"SELECT {_COLUMNS} FROM ({_IDS}) l WHERE environment = 'pro' AND logged_at >= TIMESTAMP '2024-01-05' "
    "AND logged_at <= TIMESTAMP '2024-01-20 12:00:00' ORDER BY logged_at DESC, id DESC",
)
def day_log_filter(spark, sf):
    return _shown(_day_log(spark, sf).filter("pro", "2024-01-05", "2024-01-20 12:00:00"))


@query("day_log_latest", f"SELECT {_COLUMNS} FROM ({_IDS}) l ORDER BY logged_at DESC, id DESC LIMIT 20")
def day_log_latest(spark, sf):
    return _shown(_day_log(spark, sf).latest(20))


@query(
    "day_log_page",
    f"WITH l AS ({_IDS}) SELECT {_COLUMNS} FROM l WHERE (logged_at, id) < (TIMESTAMP '2024-01-15', 0) "
    "ORDER BY logged_at DESC, id DESC LIMIT 50",
)
def day_log_page(spark, sf):
    return _shown(_day_log(spark, sf).page(50, after=("2024-01-15 00:00:00", 0)))
