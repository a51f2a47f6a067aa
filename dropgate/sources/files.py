"""File scans."""

from __future__ import annotations

import re
from typing import Any, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import model
from ..functions.text import extension_of, file_name_of
from ..operators.rules import CORRUPT
from . import listing
from .tables import local_frame

# Reader defaults per format; other formats have none.
READ_DEFAULTS: dict[str, dict[str, str]] = {
    "csv": {"header": "true", "sep": ",", "inferSchema": "true"},
    "json": {"inferSchema": "true"},
}


def literal(path: str) -> str:
    """A known path as a reader's argument: characters that would make it a pattern are escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_file(
    spark: SparkSession,
    path: str | Sequence[str],
    options: Mapping[str, Any] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read by the extension of the (first) path; caller options win over the defaults.

    A compression suffix is looked through (``x.csv.gz`` is CSV).  Any other extension is taken as a
    data source name, so an unknown one fails in analysis.
    """
    paths = [path] if isinstance(path, str) else list(path)
    fmt = extension_of(paths[0])
    merged = {**READ_DEFAULTS.get(fmt, {}), **{k: str(v) for k, v in (options or {}).items()}}
    reader = spark.read.format(fmt)
    if schema is not None:
        merged.pop("inferSchema", None)
        reader = reader.schema(schema)
    return reader.options(**merged).load([literal(p) for p in paths])


def csv_options(profile: model.Profile) -> dict[str, str]:
    return {
        "sep": profile.delimiter,
        "quote": profile.quote_char or "",
        "escape": profile.escape_char or "",
        "inferSchema": "false",
        "mode": "PERMISSIVE",
    }


def text_schema(contract: Sequence[model.Field], *extra: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*(f.field_name for f in contract), *extra]])


def read_csv(spark: SparkSession, path: str | Sequence[str], contract: Sequence[model.Field], profile: model.Profile) -> DataFrame:
    """CSV rows as the contract's columns, all text, without inference."""
    options = {**csv_options(profile), "header": str(profile.has_header).lower(), "enforceSchema": "true"}
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(text_schema(contract)).options(**options).csv([literal(p) for p in paths])


def csv_scan(
    spark: SparkSession,
    paths: Sequence[str],
    contract: Sequence[model.Field],
    profile: model.Profile,
    file_key: Column | None = None,
) -> DataFrame:
    """Raw lines of many CSV files for ``plans.verdict.csv_verdicts``.

    Headers are read as rows.  Column pruning is off for this scan because it hides malformed lines.
    """
    options = {**csv_options(profile), "header": "false", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}
    df = spark.read.schema(text_schema(contract, CORRUPT)).options(**options).csv([literal(p) for p in paths])
    return df.select(
        *[F.col(f"`{f.field_name}`") for f in contract],
        CORRUPT,
        (file_path_key() if file_key is None else file_key).alias("__file"),
        (F.col("_metadata.file_block_start") == 0).alias("__first_block"),
        F.monotonically_increasing_id().alias("__seq"),
    )


def file_path_key() -> Column:
    """Eight bytes per row in place of the path; ``plans.files`` checks that no two files share one."""
    return F.xxhash64(F.col("_metadata.file_path"))


def list_landing(spark: SparkSession, directory: str, name_filter: str | None = None) -> DataFrame:
    """Files below a landing directory: path, file_uri, file_name, length, modification_time.

    Only file metadata is read.  Spark itself hides names starting with '.' or '_' and names ending
    in '._COPYING_' (files still being copied).  A scan has no rows for files of zero bytes: see ``empty_files``.
    """
    return listing_columns(_scan_of(spark, directory, name_filter)).unionByName(empty_files(spark, directory, name_filter))


def _scan_of(spark: SparkSession, directory: str, name_filter: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(directory)


def empty_files(spark: SparkSession, directory: str, name_filter: str | None = None) -> DataFrame:
    """The files of zero bytes, in the columns of ``list_landing``.

    Executors list the directories (``listing``).  In a store that only Spark reads, and for patterns, they are
    what Spark's file index has and its scan has not; their time is unknown then.
    """
    if listing.reachable(directory):
        return listing.list_files(spark, directory, name_filter).where("length = 0")
    found = _scan_of(spark, directory, name_filter)
    # the index writes file:///x where the scan writes file:/x
    uris = [(unquote(u), u) for u in (re.sub("^file:/+", "file:/", f) for f in found.inputFiles())]
    index = local_frame(spark, uris, T.StructType([T.StructField(n, T.StringType()) for n in ("path", "file_uri")]))
    return index.join(found, "path", "left_anti").select(
        "path",
        "file_uri",
        file_name_of(F.col("path")).alias("file_name"),
        F.lit(0).cast("bigint").alias("length"),
        F.lit(None).cast("timestamp").alias("modification_time"),
    )


def listing_columns(binary_files: DataFrame) -> DataFrame:
    return binary_files.select(
        "path",
        F.col("_metadata.file_path").alias("file_uri"),
        file_name_of(F.col("path")).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modification_time"),
    )
