"""Judging landed files: profile lookup, one scan per group of like files, one verdict row per file."""

from __future__ import annotations

import datetime
import os
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import model
from ..functions.text import extension_of
from ..operators import rules as R
from ..operators.joins import skew_left_join
from ..sources import files as src
from ..sources.tables import local_frame
from . import verdict as V

JUDGED = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("file_config_id", T.IntegerType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("validation_flag", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("field_name", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)

# bounds the file index the driver holds for one scan
MAX_FILES_PER_SCAN = 100_000
CONCURRENT_SCANS = 4

# Failures that belong to a file; anything else (lost executors, memory) must not become a verdict.
READ_CONDITIONS = frozenset((
    "PATH_NOT_FOUND", "DATA_SOURCE_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER",
    "MALFORMED_RECORD_IN_PARSING", "MALFORMED_CSV_RECORD", "COLUMN_ALREADY_EXISTS",
))
# without a condition, these count only where the error names one of the files
READ_MARKERS = (
    "FileNotFoundException", "is not a Parquet file", "is not a parquet file", "ZipException", "EOFException", "Malformed ORC file",
)
# causes that belong to the store or the network, whatever file was being read: the file may be healthy, so the run fails
STORAGE_FAULTS = (
    "SocketTimeoutException", "SocketException", "ConnectException", "ConnectTimeoutException", "NoRouteToHostException", "UnknownHostException",
    "InterruptedIOException", "ClosedByInterruptException", "BlockMissingException", "StandbyException", "RetriableException",
    "SSLException", "NoHttpResponseException", "AccessControlException",
)
MSG_NO_CONTRACT = "No column contract for the file"


@dataclass(frozen=True)
class Drop:
    """One landed file with its profile; ``profile`` is None when nothing is configured for its name."""

    path: str
    file_uri: str
    file_name: str
    profile: model.Profile | None
    key: int | None = None


@dataclass(frozen=True)
class Rulebook:
    """What files are judged by.  ``contracts[None]`` is global; a profile id overrides it."""

    contracts: dict[int | None, tuple[model.Field, ...]]
    business: tuple[model.BusinessRule, ...] = tuple(model.BANK_RULES)
    options: R.Options = R.Options()
    # contracts that cannot be compiled, with what is wrong: their files alone get flag 99
    broken: dict[int | None, str] = field(default_factory=dict)

    @classmethod
    def bank(cls, options: R.Options = R.Options()) -> "Rulebook":
        return cls({None: tuple(model.BANK_ACCOUNTS)}, options=options)

    @classmethod
    def from_table(cls, semantic_layer: DataFrame, business=tuple(model.BANK_RULES), options: R.Options = R.Options()) -> "Rulebook":
        """Collect the contract table: one row per column of a file, control data only."""
        by_file: dict[int | None, list] = {}
        for row in semantic_layer.collect():
            row = row.asDict()
            row |= {c: v for c, v in model.CONTRACT_DEFAULTS.items() if c in row and row[c] is None}
            by_file.setdefault(row.get("file_config_id"), []).append(row)
        contracts, broken = {}, {}
        for k, rows in by_file.items():
            try:
                contracts[k] = tuple(model.check_contract(model.contract_from_rows(rows)))
            except ValueError as e:
                broken[k] = str(e)
        return cls(contracts, business=tuple(business), options=options, broken=broken)

    def contract_key(self, profile: model.Profile) -> int | None:
        return profile.id if profile.id in self.contracts else None

    def missing(self, profile: model.Profile) -> str | None:
        """Why no file of this profile can be judged, or None."""
        if profile.id in self.broken:
            return self.broken[profile.id]
        if profile.id in self.contracts or None in self.contracts:
            return None
        return self.broken.get(None, MSG_NO_CONTRACT)


def lookup_profiles(listing: DataFrame, file_configuration: DataFrame) -> DataFrame:
    """Left join of files to profiles by exact file name; the lowest id wins when a name repeats.

    Profile columns are prefixed ``cfg_`` (``cfg_id`` null = unconfigured).  No broadcast is forced:
    Spark picks it from the measured size of the configuration table.  Beyond that size the rows of a
    file name that is dropped over and over are spread.
    """
    names = [c for c in file_configuration.columns if c != "file_name"]
    first = file_configuration.groupBy("file_name").agg(F.min_by(F.struct(*names), "id").alias("__cfg"))
    return skew_left_join(listing, first, ["file_name"]).select(
        *listing.columns, *[F.col(f"__cfg.{c}").alias(f"cfg_{c}") for c in names]
    )


def collect_drops(listing: DataFrame, file_configuration: DataFrame) -> list[Drop]:
    """Paths and profiles on the driver, needed to open the files: one short row per file."""
    fields = [f.name for f in model.FILE_CONFIGURATION.fields if f.name != "file_name"]
    # a null quote or escape character means none; for the others the column's default holds
    default = {n: v for n, v in model.PROFILE_DEFAULTS.items() if n not in ("quote_char", "escape_char")}

    def value(row, n):
        return default.get(n) if row[f"cfg_{n}"] is None else row[f"cfg_{n}"]

    rows = lookup_profiles(
        listing.select("path", "file_uri", "file_name", F.xxhash64("file_uri").alias("key")), file_configuration
    ).collect()
    return [
        Drop(
            r["path"], r["file_uri"], r["file_name"],
            None if r["cfg_id"] is None else model.Profile(file_name=r["file_name"], **{n: value(r, n) for n in fields}),
            r["key"],
        )
        for r in rows
    ]


def groups_of(drops: Sequence[Drop], book: Rulebook) -> dict[tuple, list[Drop]]:
    """Files that can share one scan: same format, parse options and contract."""
    groups: dict[tuple, list[Drop]] = {}
    for d in drops:
        if d.profile is not None and book.missing(d.profile) is None:
            k = (extension_of(d.file_name), d.profile.parse_key(), book.contract_key(d.profile))
            groups.setdefault(k, []).append(d)
    return groups


def _error_text(e: Exception) -> str:
    """The error condition and its sentence, without the JVM stack around them."""
    text = re.sub("file:/+", "file:/", str(e))
    found = re.search(r"\[[A-Z0-9_]+(\.[A-Z0-9_]+)*\] [^\n]*", text)
    return found.group(0) if found else text.split("\n", 1)[0]


def names_file(text: str, uri: str) -> bool:
    """Does an error text hold this URI as a whole, not as the beginning of a longer one?"""
    return re.search(re.escape(re.sub("^file:/+", "file:/", uri)) + r"(?![\w%~/-]|\.\w)", re.sub("file:/+", "file:/", text)) is not None


def is_read_error(e: Exception, uris: Sequence[str] = ()) -> bool:
    """Does the failure belong to a file?  Conditions decide; loose markers need one of ``uris`` to be named.

    A fault of the store or the network anywhere among the causes does not, even where a file is named.
    """
    text = str(e)
    if re.search(r"FetchFailed|FETCH_FAILED|ExecutorLost|OutOfMemory", text):
        return False
    causes = re.findall(r"(?:^|[\s:])(?:[a-z]\w*\.)+(\w+)(?=[:\s]|$)", f"{text}\n{getattr(e, '_stackTrace', None) or ''}")
    if not set(STORAGE_FAULTS).isdisjoint(causes):
        return False
    condition = e.getCondition() if isinstance(e, PySparkException) else None
    found = {c.split(".")[0] for c in re.findall(r"\[([A-Z][A-Z0-9_]+(?:\.[A-Z0-9_]+)*)\]", text)} | {(condition or "").split(".")[0]}
    return bool(found & READ_CONDITIONS) or any(m in text for m in READ_MARKERS) and any(names_file(text, u) for u in uris)


def _fixed(spark: SparkSession, drops: Sequence[Drop], flag: str, message: str | None) -> DataFrame:
    rows = [(d.path, d.profile.id if d.profile else 0, d.file_name, flag, message, None, None) for d in drops]
    return local_frame(spark, rows, JUDGED)


def _with_files(spark: SparkSession, drops: Sequence[Drop], per_file: DataFrame, on: str, rules, absent: int) -> DataFrame:
    """Verdicts of a group joined to its file list; a file without a single line gets rule ``absent``."""
    schema = T.StructType(
        [T.StructField(on, T.LongType() if on == "key" else T.StringType())] + JUDGED.fields[:3]
    )
    files = local_frame(spark, [(getattr(d, on), d.path, d.profile.id, d.file_name) for d in drops], schema)
    found = per_file.withColumn("__found", F.lit(True))
    joined = files.join(found, files[on] == found["__file"], "left")
    index = f"CASE WHEN __found IS NULL THEN {absent} ELSE __rule END"
    return joined.selectExpr(
        "path", "file_config_id", "file_name", *V.verdict_columns(rules, index), "CAST(coalesce(n_rows, 0) AS BIGINT) AS n_rows"
    )


def _csv_group(spark: SparkSession, drops: Sequence[Drop], book: Rulebook) -> DataFrame:
    profile = drops[0].profile
    contract = book.contracts[book.contract_key(profile)]
    unique = len({d.key for d in drops}) == len({d.file_uri for d in drops})
    on = "key" if unique else "file_uri"
    key = src.file_path_key() if unique else F.col("_metadata.file_path")
    scan = src.csv_scan(spark, [d.path for d in drops], contract, profile, key)
    per_file = V.csv_verdicts(scan, contract, book.business, profile, book.options)
    rules = R.cascade(contract, profile, book.business, book.options)
    absent = V._index(rules, "33" if profile.has_header or book.options.header_compat else "34")
    return _with_files(spark, drops, per_file, on, rules, absent)


def _typed_group(spark: SparkSession, drops: Sequence[Drop], book: Rulebook) -> DataFrame:
    """Files that carry their own schema: the header check is on the schema, one scan per distinct schema."""
    profile = drops[0].profile
    contract = book.contracts[book.contract_key(profile)]
    rules = R.cascade(contract, profile, book.business, book.options)
    names = [f.field_name for f in contract]

    def probe(d: Drop):
        try:
            return src.read_file(spark, d.path, _typed_options(d)).schema
        except PySparkException as e:
            if is_read_error(e, [d.file_uri, d.path]):
                return _error_text(e)
            raise

    with ThreadPoolExecutor(16) as pool:
        schemas = list(pool.map(probe, drops))
    out, same = [], {}
    for d, s in zip(drops, schemas):
        if isinstance(s, str):
            out.append(_fixed(spark, [d], "30", s))
        else:
            same.setdefault(s.json(), (s, []))[1].append(d)
    for schema, members in same.values():
        columns = schema.names
        if len(columns) == 1 and (len(names) > 1 or book.options.header_compat):
            out.append(_fixed(spark, members, "32", model.MSG_DELIMITER))
        elif columns != names:
            out.append(_fixed(spark, members, "33", model.MSG_HEADER))
        else:
            df = src.read_file(spark, [d.path for d in members], _typed_options(members[0]), schema)
            df = df.withColumn("__file", F.col("_metadata.file_path"))
            rules = R.cascade(contract, profile, book.business, book.options, R.types_of(df))
            rows = V.evaluated(df, contract, profile, rules, book.options, {"__file": "__file"})
            per_file = V._reduce(rows, ["__file"], len(R.key_fields(contract)), V._index(rules, "39"))
            out.append(_with_files(spark, members, per_file, "file_uri", rules, V._index(rules, "34")))
    return reduce(DataFrame.unionByName, out)


def _typed_options(d: Drop) -> dict[str, str]:
    return {"header": str(d.profile.has_header).lower(), "sep": d.profile.delimiter, "inferSchema": "false"}


def judge_drops(
    spark: SparkSession,
    drops: Sequence[Drop],
    book: Rulebook,
    materialise: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Verdicts of all files, schema ``JUDGED``.

    ``materialise`` runs a group (for instance writes it to a staging table and reads it back).  When a
    group fails on a read error, the files the error names get flag 30 and the rest runs again; an error
    that names none halves the group until the bad files stand alone.  Without it only errors of analysis are isolated and the result stays lazy.
    """
    run = materialise or (lambda df: df)

    def judge(scan: list[Drop]) -> list[DataFrame]:
        fn = _csv_group if extension_of(scan[0].file_name) == "csv" else _typed_group
        done, todo = [], [scan]
        while todo:
            group = todo.pop()
            try:
                done.append(run(fn(spark, group, book)))
                continue
            except Exception as e:
                if not is_read_error(e, [d.file_uri for d in group]):
                    raise
                text = _error_text(e)
            named = group if len(group) == 1 else [d for d in group if names_file(text, d.file_uri)]
            if named:
                done.append(_fixed(spark, named, "30", text))
                todo += [rest] if (rest := [d for d in group if d not in named]) else []
            else:
                half = len(group) // 2
                todo += [group[:half], group[half:]]
        return done

    scans = [
        group[start : start + MAX_FILES_PER_SCAN]
        for group in groups_of(drops, book).values()
        for start in range(0, len(group), MAX_FILES_PER_SCAN)
    ]
    # independent jobs: the last tasks of one scan overlap with the next
    with ThreadPoolExecutor(CONCURRENT_SCANS) as pool:
        out = [df for judged in pool.map(judge, scans) for df in judged]
    lost = [(d, why) for d in drops if d.profile is not None and (why := book.missing(d.profile)) is not None]
    out += [_fixed(spark, [d for d, w in lost if w == why], "99", why) for why in dict.fromkeys(w for _, w in lost)]
    unconfigured = [d for d in drops if d.profile is None]
    if unconfigured or not out:
        out.append(_fixed(spark, unconfigured, "99", model.MSG_UNCONFIGURED))
    return reduce(DataFrame.unionByName, out)


def judge_landing(
    spark: SparkSession,
    listing: DataFrame,
    file_configuration: DataFrame,
    book: Rulebook,
    materialise: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    return judge_drops(spark, collect_drops(listing, file_configuration), book, materialise)


def judge_paths(
    spark: SparkSession,
    paths: Sequence[str],
    file_configuration: DataFrame,
    book: Rulebook,
    materialise: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Verdicts of explicitly named files; one that cannot be listed gets flag 30 (99 if unconfigured)."""

    def listing(group: list[str]) -> list[tuple]:
        try:
            found = src.listing_columns(spark.read.format("binaryFile").load([src.literal(p) for p in group]))
            return [(r["path"], r["file_uri"], r["file_name"], None) for r in found.select("path", "file_uri", "file_name").collect()]
        except PySparkException as e:
            if not is_read_error(e, group):
                raise
            if len(group) == 1:
                return [(group[0], group[0], group[0].rsplit("/", 1)[-1], _error_text(e))]
            half = len(group) // 2
            return listing(group[:half]) + listing(group[half:])

    rows = listing(list(paths))
    errors = {r[0]: r[3] for r in rows if r[3] is not None}
    names = T.StructType([T.StructField(n, T.StringType()) for n in ("path", "file_uri", "file_name")])
    frame = local_frame(spark, [r[:3] for r in rows], names)
    drops = collect_drops(frame, file_configuration)
    lost = [d for d in drops if d.path in errors and d.profile is not None]
    judged = judge_drops(spark, [d for d in drops if d not in lost], book, materialise)
    return reduce(DataFrame.unionByName, [_fixed(spark, [d], "30", errors[d.path]) for d in lost], judged)


def log_rows(judged: DataFrame, environment: str | None = None, logged_at: datetime.datetime | None = None) -> DataFrame:
    """Verdicts in the shape of the log, without ids: ``ENV`` names the environment, default dev."""
    return judged.select(
        "file_config_id",
        "file_name",
        "field_name",
        F.lit(environment or os.environ.get("ENV", "dev")).alias("environment"),
        "validation_flag",
        "error_message",
        (F.current_timestamp() if logged_at is None else F.lit(logged_at)).alias("logged_at"),
        "path",
    )
