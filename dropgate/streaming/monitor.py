"""Landing monitor: a checkpointed stream of arriving files, judged batch by batch.

The file source remembers paths, so a file dropped again is only seen under a new path: landing areas
use one directory per upload (``landing/<upload>/<name>``).  The stream carries file names and sizes only;
contents are read inside the batch by one scan per group of like files.

A file of zero bytes starts a batch like any other, but Spark's scan has no row for it.  Each batch
therefore lists the landing area's empty files (``sources.files.empty_files``) and adds those that no batch has logged.
"""

from __future__ import annotations

import itertools
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import file_name_of
from ..plans import files as judge
from ..sinks.writers import VerdictLog
from ..sources.files import empty_files, listing_columns

POLL_INTERVAL = "10 seconds"
# files per batch: bounds the path list the driver holds, later files go to the next batch
MAX_FILES_PER_BATCH = 10_000
# batches whose log partitions are moved into one file
COMPACT_EVERY = 100


def arrivals(
    spark: SparkSession,
    landing: str,
    max_files: int = MAX_FILES_PER_BATCH,
    clean_source: str = "off",
    archive_dir: str | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    """Stream of landed files (listing columns).  Hidden and ``._COPYING_`` names are skipped by Spark.

    ``clean_source='delete'`` removes files once a later batch has committed.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(max_files))
        .option("cleanSource", clean_source)
    )
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return listing_columns(reader.load(landing))


def monitor(
    spark: SparkSession,
    landing: str,
    log: VerdictLog,
    checkpoint: str,
    file_configuration: Callable[[], DataFrame],
    rulebook: Callable[[], judge.Rulebook],
    source: str = "landing",
    environment: str | None = None,
    available_now: bool = False,
    name_of=file_name_of,
    **arrival_options,
) -> StreamingQuery:
    """Start judging arrivals.  Metadata is read per batch, so edited profiles apply to the next one.

    Offsets are checkpointed and a batch replaces its own log partition, so each arrival is logged
    once even if the driver dies between logging and committing.  ``name_of`` maps a path to the
    logical file name.
    """

    def judge_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        group = itertools.count()
        empty = empty_files(session, landing, arrival_options.get("name_filter")).select(*batch.columns)
        batch = batch.unionByName(log.empty_arrivals(empty, source, batch_id))
        judged = judge.judge_landing(
            session,
            batch.withColumn("file_name", name_of(F.col("path"))),
            file_configuration(),
            rulebook(),
            materialise=lambda df: log.stage(df, f"{source}-group-{next(group)}"),
        )
        log.write_batch(judge.log_rows(judged, environment), source, batch_id)
        if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
            log.compact(source)

    writer = (
        arrivals(spark, landing, **arrival_options)
        .writeStream.foreachBatch(judge_batch)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=POLL_INTERVAL)
    return writer.start()
