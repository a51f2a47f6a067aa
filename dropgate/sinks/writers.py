"""Sinks: append, CSV export, partitioned export, and the verdict log."""

from __future__ import annotations

import uuid
from typing import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from .. import model
from ..operators.ids import with_next_ids
from ..plans import logqueries
from ..sources.tables import local_frame


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory in the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, one in the warehouse, which all executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a directory in whatever store it lies; one that is not there is no error."""
    gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    df.write.mode("append").jdbc(url, table, properties=dict(properties))


def write_csv(df: DataFrame, path: str, delimiter: str = ",", header: bool = True) -> None:
    """Append to a CSV directory."""
    df.write.mode("append").option("sep", delimiter).option("header", str(header).lower()).csv(path)


def write_partitioned(df: DataFrame, path: str, partition_columns: str | None, mode: str = "append") -> None:
    """Write Parquet, laid out by a profile's comma-separated ``partition_columns``.

    Rows are rebalanced by those columns: small partitions share a task and one holding most rows is
    split over several, so neither a file per task and partition nor one huge task results.
    """
    columns = [c.strip() for c in (partition_columns or "").split(",") if c.strip()]
    if columns:
        df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_split(split: DataFrame, path: str, mode: str = "append") -> None:
    """Write ``plans.verdict.split_rows`` in one pass: ``outcome=accepted`` and ``outcome=quarantined`` under one path.

    Both sides come from the same job, so no row can be in both or in neither; ``flags`` tells why a row is quarantined and
    is empty in accepted ones.  A column of the data that is called ``outcome`` is refused.
    """
    if "outcome" in split.columns:
        raise ValueError("the data has a column named 'outcome'")
    outcome = F.when(F.size("flags") == 0, "accepted").otherwise("quarantined")
    split.withColumn("outcome", outcome).write.mode(mode).partitionBy("outcome").parquet(path)


#: what the log remembers of each source: its last batch, the ids before and after it, how far its batches are compacted
_MARK = T.StructType(
    [T.StructField(n, T.StringType() if n == "source" else T.LongType()) for n in
     ("source", "batch", "log_before", "log_last", "negative_before", "negative_last", "compacted", "generation", "version")]
)


#: how many rows of the log a compacted generation holds by day
_DAYS = T.StructType([T.StructField(logqueries.DAY, T.DateType()), T.StructField("n_rows", T.LongType())])


def _with_batch(fields: list[T.StructField]) -> T.StructType:
    return T.StructType([*fields, T.StructField("source", T.StringType()), T.StructField("batch", T.LongType())])


class VerdictLog:
    """The verdict log and its feed of failures as two Parquet tables under one directory.

    Every batch owns the partition ``source=<name>/batch=<n>`` of both tables and replaces it, so writing a batch again after a
    crash leaves one copy.  A mark, one row per source, holds the last ids: a batch costs the same however long the log is.
    The mark is written after the batch, in turn to one of two slots, so the one before survives a crash; a batch
    that the mark already holds is a replay and gets its ids again.

    ``compact`` moves the batches since the last time into a few files, each row once, in a partition per UTC day and ordered by time.
    Readers take a batch either from its partition or, if the mark says so, from the compacted generations, so a crash in
    between loses and doubles nothing.  ``read`` gives the column ``day``; ``filter`` reads only the days between its bounds, ``latest`` and
    ``page`` only as many of the newest days as hold their rows, both besides the few batches not compacted yet.
    """

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self.log_path = f"{self.directory}/trigger_control"
        self.negative_path = f"{self.directory}/negative_flag_logs"
        self.staging_path = f"{self.directory}/staging"
        self.mark_path = f"{self.directory}/mark"
        self.empty_path = f"{self.directory}/empty_arrivals"
        self.days_path = f"{self.directory}/days"

    def _read(self, schema: T.StructType, *paths: str, base: str | None = None) -> DataFrame:
        reader = self.spark.read.schema(schema)
        try:
            return (reader.option("basePath", base) if base else reader).parquet(*paths)
        except AnalysisException as e:
            if base or e.getCondition() != "PATH_NOT_FOUND":  # what a mark names has to be there
                raise
            return local_frame(self.spark, [], schema)  # nothing written yet

    def marks(self) -> list[dict]:
        """One row per source; the number of sources bounds it."""
        rows = [r.asDict() for r in self._read(T.StructType([*_MARK.fields, T.StructField("slot", T.IntegerType())]), self.mark_path).collect()]
        newest = max((r["version"] for r in rows), default=0)
        return [{k: v for k, v in r.items() if k != "slot"} for r in rows if r["version"] == newest]

    def _write_marks(self, marks: list[dict], version: int) -> None:
        rows = [tuple((m | {"version": version})[f.name] for f in _MARK) for m in marks]
        local_frame(self.spark, rows, _MARK).coalesce(1).write.mode("overwrite").parquet(f"{self.mark_path}/slot={version % 2}")

    def _live(self, path: str, schema: T.StructType, marks: list[dict]) -> DataFrame:
        """Rows of the batches that are not compacted."""
        out = self._read(_with_batch([*schema.fields, T.StructField("path", T.StringType())]), path)
        for m in marks:
            out = out.where((F.col("source") != m["source"]) | (F.col("batch") > m["compacted"]))
        return out

    def _table(self, path: str, schema: T.StructType) -> DataFrame:
        marks = self.marks()
        live = self._live(path, schema, marks).withColumn(logqueries.DAY, logqueries.day_of(F.col("logged_at")))
        old = self._generations(path, marks)
        return live.unionByName(self._read(live.schema, *old, base=f"{path}_compacted").select(*live.columns)) if old else live

    @staticmethod
    def _generations(path: str, marks: list[dict]) -> list[str]:
        return [VerdictLog._compacted(path, m["source"], g + 1) for m in marks for g in range(m["generation"])]

    @staticmethod
    def _compacted(path: str, source: str, generation: int) -> str:
        return f"{path}_compacted/source={source}/generation={generation}"

    def read(self) -> DataFrame:
        return self._table(self.log_path, model.VERDICT_LOG)

    def read_negative(self) -> DataFrame:
        return self._table(self.negative_path, model.NEGATIVE_LOG)

    def filter(self, environment: str | None = None, from_date=None, to_date=None, flag: str | None = None) -> DataFrame:
        """``logqueries.filter_log`` of the log, which prunes the days."""
        return logqueries.filter_log(self.read(), environment, from_date, to_date, flag)

    def latest(self, n: int = 20) -> DataFrame:
        return self.page(n)

    def page(self, size: int, after: tuple | None = None) -> DataFrame:
        """``logqueries.page`` of the log.  The compacted rows are counted by day, so the day that fills the page is known before anything is read."""
        log, first = self.read(), self._first_day(size, after)
        if first is not None:
            log = log.filter(F.col(logqueries.DAY) >= F.lit(first))
        return logqueries.page(log, size, after)

    def _first_day(self, size: int, after: tuple | None):
        """The newest day from which on the compacted log holds ``size`` rows, counting whole days before ``after``; None where it holds fewer.

        Rows not compacted can only push older ones off the page, so no row of the page is older.
        """
        old = self._generations(self.days_path, self.marks())
        if not old:
            return None
        days = self._read(_DAYS, *old, base=f"{self.days_path}_compacted").filter(F.col(logqueries.DAY).isNotNull())
        if after is not None:
            days = days.filter(F.col(logqueries.DAY) < logqueries.day_of(F.lit(after[0]).cast("timestamp")))
        newest = Window.orderBy(F.desc(logqueries.DAY))  # one row per calendar day
        total = days.groupBy(logqueries.DAY).agg(F.sum("n_rows").alias("n")).withColumn("n", F.sum("n").over(newest))
        return total.filter(F.col("n") >= size).agg(F.max(logqueries.DAY)).first()[0]

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Run ``df`` once into a staging table and read that from now on; the next use replaces it."""
        path = f"{self.staging_path}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def empty_arrivals(self, listing: DataFrame, source: str, batch: int) -> DataFrame:
        """The rows of ``listing``, files of zero bytes, that no other batch has logged; they are remembered as those of this batch."""
        seen = self._read(_with_batch(listing.schema.fields), self.empty_path)
        others = seen.where((F.col("source") != source) | (F.col("batch") != batch)).select("path")
        mine = f"{self.empty_path}/source={source}/batch={batch}"
        listing.join(others, "path", "left_anti").select(*listing.columns).coalesce(1).write.mode("overwrite").parquet(mine)
        return self.spark.read.schema(listing.schema).parquet(mine)

    def write_batch(self, rows: DataFrame, source: str, batch: int) -> None:
        """Log a batch of verdicts (``plans.files.log_rows``: log columns without id, plus ``path``).

        Reads the batch's own rows and the mark, nothing of what was logged before.
        """
        marks = self.marks()
        rows, here = self.stage(rows, f"{source}-rows"), f"source={source}/batch={batch}"
        mine = next((m for m in marks if m["source"] == source), None)
        mark = {"source": source, "batch": batch, "compacted": -1, "generation": 0} | ({k: mine[k] for k in ("compacted", "generation")} if mine else {})

        def write(new: DataFrame, name: str, path: str, order: str) -> DataFrame:
            if marks:
                top = max(m[f"{name}_last"] for m in marks)
            else:  # the first batch, or the first after a log without marks
                others = (F.col("source") != source) | (F.col("batch") != batch)
                top = (self.read() if name == "log" else self.read_negative()).where(others).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
            before = mine[f"{name}_before"] if mine and mine["batch"] == batch else top
            n = new.count()
            if before != top and top != mine[f"{name}_last"] and n != mine[f"{name}_last"] - before:
                before = top  # others wrote meanwhile, and the batch has another size than it had
            numbered = with_next_ids(new, before, [order])
            numbered.write.mode("overwrite").parquet(f"{path}/{here}")
            mark[f"{name}_before"], mark[f"{name}_last"] = before, before + n
            return self.spark.read.schema(numbered.schema).parquet(f"{path}/{here}")

        written = write(rows, "log", self.log_path, "path")
        write(logqueries.negative_rows(written), "negative", self.negative_path, "trigger_id")
        version = max((m["version"] for m in marks), default=0) + 1
        self._write_marks([m for m in marks if m["source"] != source] + [mark], version)

    def compact(self, source: str) -> None:
        """Move the batches of a source since the last time, but the newest, which may be replayed, into a file per day, or several of a large one.

        The writer's own thread calls this between batches.
        """
        marks = self.marks()
        mine = next((m for m in marks if m["source"] == source), None)
        if mine is None or mine["batch"] - 1 <= mine["compacted"]:
            return
        through, generation = mine["batch"] - 1, mine["generation"] + 1
        for path, schema in ((self.log_path, model.VERDICT_LOG), (self.negative_path, model.NEGATIVE_LOG)):
            old = self._live(path, schema, marks).where((F.col("source") == source) & (F.col("batch") <= through))
            by_day = old.withColumn(logqueries.DAY, logqueries.day_of(F.col("logged_at"))).hint("rebalance", logqueries.DAY)
            ordered = by_day.sortWithinPartitions(logqueries.DAY, "logged_at", "id")
            ordered.write.mode("overwrite").partitionBy(logqueries.DAY).parquet(self._compacted(path, source, generation))
        moved = self._read(T.StructType([*model.VERDICT_LOG.fields, _DAYS[logqueries.DAY]]), self._compacted(self.log_path, source, generation))
        counted = moved.groupBy(logqueries.DAY).agg(F.count(F.lit(1)).alias("n_rows"))
        counted.coalesce(1).write.mode("overwrite").parquet(self._compacted(self.days_path, source, generation))
        now = mine | {"compacted": through, "generation": generation}
        self._write_marks([m for m in marks if m["source"] != source] + [now], mine["version"] + 1)
        for path in (self.log_path, self.negative_path):
            for batch in range(mine["compacted"] + 1, through + 1):
                remove_dir(self.spark, f"{path}/source={source}/batch={batch}")
