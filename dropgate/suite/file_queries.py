"""Queries of the file sources, the landing directory, the sinks and the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import model
from ..operators import keys
from ..operators.structural import structural_report
from ..plans import files as judge
from ..sinks import writers
from ..sources import files as src, tables
from ..streaming import monitor as M
from . import fixtures as fx, landing, oracle as O
from .base import OPTIONS, query

A = fx.duck(fx.ACCOUNTS)
LOG = fx.duck(fx.LOG)
BOOK = judge.Rulebook.bank(OPTIONS)


# --- sources -----------------------------------------------------------------------------------

@query("src_csv_scan", f"SELECT * EXCLUDE (order_key) FROM ({A}) a")
def src_csv_scan(spark, sf):
    path = writers.shared_dir(spark, "accounts") + "/accounts.csv"
    writers.write_csv(fx.accounts(spark, sf).drop("order_key"), path)
    return src.read_csv(spark, path, model.BANK_ACCOUNTS, model.Profile())


@query("src_json_scan", "SELECT event_id, user_id, event_type, value FROM events")
def src_json_scan(spark, sf):
    path = writers.shared_dir(spark, "events") + "/events.json"
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", "event_type", "value")
    events.write.json(path)
    return src.read_file(spark, path)


@query("src_parquet_scan", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0")
def src_parquet_scan(spark, sf):
    return src.read_file(spark, f"{sf}/supplier.parquet").filter("s_acctbal > 0").select("s_suppkey", "s_name")


@query("src_orc_scan", "SELECT p_partkey, p_name, p_size FROM part")
def src_orc_scan(spark, sf):
    path = writers.shared_dir(spark, "part") + "/part.orc"
    spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", "p_name", "p_size").write.orc(path)
    return src.read_file(spark, path)


@query(
    "src_gzip_csv_scan",
    "SELECT cast(c_custkey as string) AS c_custkey, c_name, c_mktsegment FROM customer",
)
def src_gzip_csv_scan(spark, sf):
    path = writers.shared_dir(spark, "customer") + "/customer.csv.gz"
    rows = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name", "c_mktsegment")
    rows.write.option("header", "true").option("compression", "gzip").csv(path)
    return src.read_file(spark, path, {"inferSchema": "false"})


@query(
    "src_format_dispatch",
    " UNION ALL ".join(
        f"SELECT '{f}' AS format, n_regionkey, count(*) AS n, sum(n_nationkey)::BIGINT AS s "
        "FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_regionkey"
        for f in ("csv", "json", "parquet", "orc")
    ),
)
def src_format_dispatch(spark, sf):
    """One data set written in four formats, each read back by its extension."""
    nation, customer = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("nation", "customer"))
    df = nation.join(customer, F.col("c_nationkey") == F.col("n_nationkey")).select("n_regionkey", "n_nationkey")
    base, out = writers.shared_dir(spark, "formats"), None
    for fmt in ("csv", "json", "parquet", "orc"):
        path = f"{base}/data.{fmt}"
        df.write.format(fmt).option("header", "true").save(path)
        part = src.read_file(spark, path).groupBy("n_regionkey").agg(
            F.count(F.lit(1)).alias("n"), F.sum("n_nationkey").cast("bigint").alias("s")
        )
        part = part.select(F.lit(fmt).alias("format"), F.col("n_regionkey").cast("int").alias("n_regionkey"), "n", "s")
        out = part if out is None else out.unionByName(part)
    return out


@query("src_table_scan", "SELECT * FROM customer")
def src_table_scan(spark, sf):
    return tables.read_table(spark, f"{sf}/customer.parquet")


@query("src_schema_probe", "SELECT column_name FROM (DESCRIBE lineitem)")
def src_schema_probe(spark, sf):
    names = tables.schema_probe(spark.read.parquet(f"{sf}/lineitem.parquet"))
    return tables.local_frame(
        spark, [(n,) for n, _ in names], model.T.StructType([model.T.StructField("column_name", model.T.StringType())])
    )


@query(
    "src_hash_partition_scan",
    "SELECT CAST(abs(TRY_CAST(split_part(CAST(l_extendedprice AS VARCHAR), '.', 1) AS BIGINT)) % 12 AS INTEGER) AS scan_bucket, "
    "count(*) AS n FROM lineitem GROUP BY 1",
)
def src_hash_partition_scan(spark, sf):
    """Sixth column of lineitem; no value of it is null, so the last bucket stays empty."""
    scan = tables.hash_partition_scan(spark.read.parquet(f"{sf}/lineitem.parquet"))
    return scan.groupBy("scan_bucket").agg(F.count(F.lit(1)).alias("n"))


# --- landing -----------------------------------------------------------------------------------

_U = f"(SELECT DISTINCT upload FROM ({fx.duck(landing.UPLOADS)}) a)"
_S = f"upload % {landing.N_SCENARIOS}"
_NAME = f"concat('drop_', cast(upload as string), CASE WHEN {_S} = {landing.FORMAT} THEN '.txt' ELSE '.csv' END)"


@query("src_landing_listing", f"SELECT upload, {_NAME} AS file_name FROM {_U} u")
def src_landing_listing(spark, sf):
    return landing.listing(spark, sf).select(landing.upload_of("path").alias("upload"), "file_name")


# what is fixed by the scenario; the rest follows from the rows
_FIXED_FLAG = (
    f"CASE {_S} WHEN {landing.SEPARATOR} THEN '32' WHEN {landing.HEADER} THEN '33' WHEN {landing.WIDTH} THEN '34' "
    f"WHEN {landing.UNCONFIGURED} THEN '99' WHEN {landing.EMPTY} THEN '34' WHEN {landing.FORMAT} THEN '30' "
)
_JUDGED = (
    f"{O.per_file(landing.UPLOADS, 'upload')} SELECT upload, {_NAME} AS file_name, "
    f"CAST(CASE WHEN {_S} = {landing.UNCONFIGURED} THEN 0 ELSE upload + 1 END AS INTEGER) AS file_config_id, "
    f"{_FIXED_FLAG} ELSE {O.first(0, otherwise=O.text('2'))} END AS validation_flag, "
    f"CASE WHEN {_S} IN ({landing.SEPARATOR},{landing.HEADER},{landing.WIDTH},{landing.UNCONFIGURED},{landing.EMPTY},{landing.FORMAT}) "
    f"THEN NULL ELSE {O.first(2)} END AS field_name, "
    f"CASE WHEN {_S} IN ({landing.UNCONFIGURED},{landing.FORMAT}) THEN NULL WHEN {_S} = {landing.EMPTY} THEN 0 ELSE n_rows END AS n_rows FROM f"
)
_JUDGED_COLUMNS = ["file_name", "file_config_id", "validation_flag", "field_name", "n_rows"]


@query("batch_directory_verdicts", _JUDGED)
def batch_directory_verdicts(spark, sf):
    out = landing.judged(spark, sf, BOOK)
    return out.select(landing.upload_of("path").alias("upload"), *_JUDGED_COLUMNS)


@query("verdict_unconfigured", f"SELECT * FROM ({_JUDGED}) j WHERE validation_flag = '99'")
def verdict_unconfigured(spark, sf):
    return batch_directory_verdicts(spark, sf).filter("validation_flag = '99'")


@query("verdict_read_error", f"SELECT * FROM ({_JUDGED}) j WHERE validation_flag = '30'")
def verdict_read_error(spark, sf):
    return batch_directory_verdicts(spark, sf).filter("validation_flag = '30'")


_EMPTY = f"{_S} = {landing.EMPTY}"
_REPORT = (
    f"SELECT upload, {_S} = {landing.SEPARATOR} AS one_column, {_S} NOT IN ({landing.SEPARATOR},{landing.HEADER}) AS header_ok, "
    f"CASE WHEN {_EMPTY} THEN 0 ELSE count(*) END AS n_rows, "
    f"CASE WHEN {_S} = {landing.SEPARATOR} THEN count(*) "
    f"WHEN {_S} = {landing.WIDTH} THEN count(*) FILTER ((order_key // 14) % 31 = 3) ELSE 0 END AS n_bad_rows, "
    f"CASE {_S} WHEN {landing.SEPARATOR} THEN '32' WHEN {landing.HEADER} THEN '33' WHEN {landing.WIDTH} THEN '34' "
    f"WHEN {landing.EMPTY} THEN '34' END AS validation_flag "
    f"FROM ({fx.duck(landing.UPLOADS)}) a WHERE {_S} <> {landing.NO_HEADER} GROUP BY upload"
)


def _report(spark, sf):
    report = structural_report(landing.csv_scan(spark, sf), model.BANK_ACCOUNTS, model.Profile(), OPTIONS)
    return report.withColumnRenamed("__file", "upload")


query("structural_verdict", _REPORT)(_report)
query("structural_delimiter", f"SELECT upload, one_column FROM ({_REPORT}) r")(lambda s, sf: _report(s, sf).select("upload", "one_column"))
query("structural_header", f"SELECT upload, header_ok FROM ({_REPORT}) r")(lambda s, sf: _report(s, sf).select("upload", "header_ok"))
query("structural_column_count", f"SELECT upload, n_rows, n_bad_rows FROM ({_REPORT}) r")(
    lambda s, sf: _report(s, sf).select("upload", "n_rows", "n_bad_rows")
)


# --- sinks -------------------------------------------------------------------------------------

@query("sink_log_append", f"SELECT * FROM ({LOG}) l")
def sink_log_append(spark, sf):
    """The log appended in two writes and read back."""
    path = writers.shared_dir(spark, "log")
    log = fx.log(spark, sf)
    writers.append_table(log.filter("environment = 'dev'"), path)
    writers.append_table(log.filter("environment <> 'dev'"), path)
    return spark.read.parquet(path)


_INCOMING = """SELECT id * 3 AS id, concat('new_', cast(id as string)) AS file_name, '2' AS validation_flag FROM ({log}) l WHERE validation_flag = '30'"""


@query(
    "sink_upsert_by_key",
    f"""WITH s AS ({_INCOMING.format(log=LOG)}) SELECT id, file_name, validation_flag FROM ({LOG}) l WHERE id NOT IN (SELECT id FROM s)
UNION ALL SELECT id, file_name, validation_flag FROM s""",
)
def sink_upsert_by_key(spark, sf):
    target = fx.log(spark, sf).select("id", "file_name", "validation_flag")
    incoming = fx.frame(spark, sf, _INCOMING.format(log=fx.LOG))
    path = writers.shared_dir(spark, "upsert")
    keys.upsert_by_key(target, incoming, ["id"]).write.parquet(path)
    return spark.read.parquet(path)


@query("sink_csv_export", f"SELECT account_number, address, balance, first_name FROM ({fx.duck(fx.DIRTY)}) a")
def sink_csv_export(spark, sf):
    path = writers.shared_dir(spark, "export")
    rows = fx.dirty(spark, sf).select("account_number", "address", "balance", "first_name")
    writers.write_csv(rows, path, delimiter=";")
    return spark.read.option("sep", ";").option("header", "true").schema(rows.schema).csv(path)


@query("sink_partitioned", f"SELECT country, status, account_number FROM ({A}) a")
def sink_partitioned(spark, sf):
    path = writers.shared_dir(spark, "accepted")
    rows = fx.accounts(spark, sf).select("account_number", "country", "status")
    writers.write_partitioned(rows, path, "country, status")
    return spark.read.parquet(path).select("country", "status", "account_number")


# --- stream ------------------------------------------------------------------------------------

def _run_stream(spark, sf, log, checkpoint):
    M.monitor(
        spark, landing.directory(spark, sf), log, checkpoint,
        lambda: landing.configuration(spark, sf), lambda: BOOK,
        available_now=True, name_of=landing.name_of, max_files=landing.N_SCENARIOS,
    ).awaitTermination()


_LOGGED = f"SELECT upload, file_name, file_config_id, validation_flag, field_name FROM ({_JUDGED}) j"


@query("stream_verdicts", _LOGGED)
def stream_verdicts(spark, sf):
    """The landing judged by the checkpointed stream; what it logged."""
    log = writers.VerdictLog(spark, writers.shared_dir(spark, "stream"))
    _run_stream(spark, sf, log, writers.shared_dir(spark, "checkpoint"))
    rows = log.read().withColumn("upload", landing.upload_of("path"))
    return rows.select("upload", "file_name", "file_config_id", "validation_flag", "field_name")


@query(
    "stream_restart_no_dup",
    f"SELECT validation_flag, count(*) AS n, count(*) FILTER (TRY_CAST(validation_flag AS INTEGER) >= 30) AS n_negative "
    f"FROM ({_LOGGED}) j GROUP BY 1",
)
def stream_restart_no_dup(spark, sf):
    """The stream run twice on one checkpoint: nothing is logged again."""
    log = writers.VerdictLog(spark, writers.shared_dir(spark, "stream"))
    checkpoint = writers.shared_dir(spark, "checkpoint")
    _run_stream(spark, sf, log, checkpoint)
    _run_stream(spark, sf, log, checkpoint)
    logged = log.read().groupBy("validation_flag").agg(F.count(F.lit(1)).alias("n"))
    negative = log.read_negative().groupBy("validation_flag").agg(F.count(F.lit(1)).alias("n_negative"))
    return logged.join(negative, "validation_flag", "left").select(
        "validation_flag", "n", F.coalesce("n_negative", F.lit(0)).alias("n_negative")
    )


@query(
    "stream_empty_arrivals",
    "SELECT r_regionkey AS upload, CASE WHEN r_regionkey % 2 = 1 THEN '33' ELSE '32' END AS validation_flag, 1 AS n FROM region",
)
def stream_empty_arrivals(spark, sf):
    """Files of one column, and of zero bytes for odd regions, judged by a stream that runs twice: one verdict each."""
    nations, inbox = spark.read.parquet(f"{sf}/nation.parquet"), writers.shared_dir(spark, "inbox")
    regions = [r[0] for r in spark.read.parquet(f"{sf}/region.parquet").select("r_regionkey").collect()]
    for key in regions:
        names = nations.where((F.col("n_regionkey") == key) & (F.col("n_regionkey") % 2 == 0)).select("n_name")
        names.coalesce(1).write.text(f"{inbox}/upload={key}")
    log, checkpoint = writers.VerdictLog(spark, writers.shared_dir(spark, "stream")), writers.shared_dir(spark, "checkpoint")
    for _ in range(2):
        M.monitor(
            spark, inbox, log, checkpoint, lambda: landing.configuration(spark, sf).where("id = 1"), lambda: BOOK,
            available_now=True, name_of=lambda path: landing.file_name(F.lit(0)),
        ).awaitTermination()
    judged = log.read().withColumn("upload", landing.upload_of("path"))
    return judged.groupBy("upload", "validation_flag").agg(F.count(F.lit(1)).cast("int").alias("n"))
