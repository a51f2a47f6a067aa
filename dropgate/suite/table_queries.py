"""Queries over the configuration table and the verdict log."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import model
from ..operators import constraints, ids, keys, registry
from ..plans import files as judge, logqueries as L
from ..sources import tables
from . import fixtures as fx
from .base import query

C = fx.duck(fx.CONFIGS)
LOG = fx.duck(fx.LOG)
LOG_COLUMNS = ", ".join(L.LOG_COLUMNS)


# --- metadata scans ----------------------------------------------------------------------------

@query("src_file_configuration", f"SELECT * FROM ({C}) c")
def src_file_configuration(spark, sf):
    return tables.typed(fx.configs(spark, sf), model.FILE_CONFIGURATION)


@query("src_semantic_layer", f"SELECT * FROM ({fx.duck(fx.CONTRACTS)}) c")
def src_semantic_layer(spark, sf):
    return tables.typed(fx.contracts(spark, sf), model.SEMANTIC_LAYER)


_LISTED = "SELECT l_orderkey, l_linenumber, concat('accounts_', cast(l_partkey % 2000 as string), '.csv') AS file_name FROM lineitem"


@query(
    "lookup_file_profile",
    f"SELECT l.l_orderkey, l.l_linenumber, l.file_name, c.id AS cfg_id, c.delimiter AS cfg_delimiter "
    f"FROM ({_LISTED}) l LEFT JOIN ({C}) c USING (file_name)",
)
def lookup_file_profile(spark, sf):
    found = judge.lookup_profiles(fx.frame(spark, sf, _LISTED), fx.configs(spark, sf))
    return found.select("l_orderkey", "l_linenumber", "file_name", "cfg_id", "cfg_delimiter")


# --- configuration -----------------------------------------------------------------------------

@query("config_list", f"SELECT * FROM ({C}) c")
def config_list(spark, sf):
    return fx.configs(spark, sf)


@query("config_get", f"SELECT * FROM ({C}) c WHERE id = 42")
def config_get(spark, sf):
    return registry.get(fx.configs(spark, sf), 42)


_NAMES = "SELECT DISTINCT concat('accounts_', cast(o_custkey * 3 as string), '.csv') AS file_name FROM orders"


@query(
    "config_register",
    f"""WITH c AS ({C}), n AS ({_NAMES})
SELECT id, file_format, path, file_name, true AS has_header, ',' AS delimiter, '"' AS quote_char, '\\' AS escape_char,
  'yyyy-MM-dd' AS date_format, 'yyyy-MM-dd HH:mm:ss' AS timestamp_format, NULL AS partition_columns
FROM c WHERE file_name IN (SELECT file_name FROM n)
UNION ALL SELECT * FROM c WHERE file_name NOT IN (SELECT file_name FROM n)
UNION ALL SELECT (SELECT max(id) FROM c) + row_number() OVER (ORDER BY file_name), 'csv', '/landing/', file_name, true, ',', '"', '\\', 'yyyy-MM-dd', 'yyyy-MM-dd HH:mm:ss', NULL
FROM n WHERE file_name NOT IN (SELECT file_name FROM c)""",
)
def config_register(spark, sf):
    """New profiles get the ids above the largest one, in the order of their names."""
    return registry.register(fx.configs(spark, sf), fx.frame(spark, sf, _NAMES), "/landing")


_PATCH = """SELECT cast(c_custkey + 1 as int) AS id, c_custkey % 2 = 0 AS set_delimiter, ';' AS delimiter,
  c_custkey % 3 = 0 AS set_date_format, CASE WHEN c_custkey % 4 = 0 THEN 'MM-dd-yyyy' END AS date_format,
  c_custkey % 5 = 0 AS set_has_header, false AS has_header FROM customer WHERE c_acctbal > 0"""


@query(
    "config_patch",
    f"""SELECT c.id, c.file_format, c.path, c.file_name,
  CASE WHEN set_has_header THEN p.has_header ELSE c.has_header END AS has_header,
  CASE WHEN set_delimiter THEN p.delimiter ELSE c.delimiter END AS delimiter, c.quote_char, c.escape_char,
  CASE WHEN set_date_format THEN p.date_format ELSE c.date_format END AS date_format, c.timestamp_format, c.partition_columns
FROM ({C}) c LEFT JOIN ({_PATCH}) p ON c.id = p.id""",
)
def config_patch(spark, sf):
    return registry.patch(fx.configs(spark, sf), fx.frame(spark, sf, _PATCH))


@query(
    "config_domain_check",
    " UNION ALL ".join(
        f"SELECT id, '{c}' AS column_name, {c} AS value FROM ({C}) c WHERE length({c}) NOT BETWEEN {a} AND {b}"
        for c, a, b in constraints.PROFILE_WIDTHS
    ),
)
def config_domain_check(spark, sf):
    return constraints.profile_problems(fx.configs(spark, sf))


@query(
    "apply_defaults",
    f"""SELECT id, file_format, path, file_name, coalesce(has_header, true) AS has_header, coalesce(delimiter, ',') AS delimiter,
  coalesce(quote_char, '"') AS quote_char, coalesce(escape_char, '\\') AS escape_char,
  coalesce(date_format, 'yyyy-MM-dd') AS date_format, coalesce(timestamp_format, 'yyyy-MM-dd HH:mm:ss') AS timestamp_format,
  partition_columns FROM ({C}) c""",
)
def apply_defaults(spark, sf):
    return constraints.apply_defaults(fx.configs(spark, sf), model.PROFILE_DEFAULTS)


_NOT_NULL = ["file_format", "path", "file_name", "has_header", "delimiter", "quote_char", "escape_char"]


@query("not_null_profile", f"SELECT {', '.join(f'count(*) - count({c}) AS {c}' for c in _NOT_NULL)} FROM ({C}) c")
def not_null_profile(spark, sf):
    return constraints.null_profile(fx.configs(spark, sf), _NOT_NULL)


@query(
    "unique_violations",
    f"SELECT file_config_id, field_position, count(*) AS n_rows FROM ({fx.duck(fx.CONTRACTS)}) c GROUP BY ALL HAVING count(*) > 1",
)
def unique_violations(spark, sf):
    return keys.duplicate_keys(fx.contracts(spark, sf), ["field_position"], by=["file_config_id"])


# --- references --------------------------------------------------------------------------------

@query(
    "fk_orphans",
    f"SELECT file_config_id, count(*) AS n_rows FROM ({LOG}) l WHERE file_config_id <> 0 AND file_config_id NOT IN "
    f"(SELECT id FROM ({C}) c WHERE path <> '/data/building/') GROUP BY 1",
)
def fk_orphans(spark, sf):
    """Log rows whose profile is gone; id 0 stands for 'no profile' and is no reference."""
    parents = fx.configs(spark, sf).filter("path <> '/data/building/'")
    return keys.orphan_keys(fx.log(spark, sf), "file_config_id", parents, "id", F.col("file_config_id") != 0)


_NEGATIVE = f"SELECT id AS trigger_id, * EXCLUDE (id) FROM ({LOG}) l WHERE TRY_CAST(validation_flag AS INTEGER) >= 30 AND contains(validation_flag, '.') = false"


@query(
    "fk_orphans_negative",
    f"SELECT trigger_id, count(*) AS n_rows FROM ({_NEGATIVE}) n WHERE trigger_id NOT IN "
    f"(SELECT id FROM ({LOG}) l WHERE environment <> 'pre') GROUP BY 1",
)
def fk_orphans_negative(spark, sf):
    log = fx.log(spark, sf)
    return keys.orphan_keys(L.negative_rows(log), "trigger_id", log.filter("environment <> 'pre'"), "id")


_DELETED = "SELECT cast(c_custkey + 1 as int) AS id FROM customer WHERE c_mktsegment = 'BUILDING'"


@query(
    "cascade_delete",
    f"""WITH d AS ({_DELETED})
SELECT 'file_configuration' AS tbl, cast(id as bigint) AS id FROM ({C}) c WHERE id NOT IN (SELECT id FROM d)
UNION ALL SELECT 'trigger_control', id FROM ({LOG}) l WHERE file_config_id NOT IN (SELECT id FROM d)
UNION ALL SELECT 'negative_flag_logs', trigger_id FROM ({_NEGATIVE}) n WHERE file_config_id NOT IN (SELECT id FROM d)""",
)
def cascade_delete(spark, sf):
    log = fx.log(spark, sf)
    profiles, kept, negative = keys.cascade_delete(
        fx.configs(spark, sf), log, L.negative_rows(log), fx.frame(spark, sf, _DELETED)
    )
    rows = lambda df, t, c: df.select(F.lit(t).alias("tbl"), F.col(c).cast("bigint").alias("id"))
    return (
        rows(profiles, "file_configuration", "id")
        .unionByName(rows(kept, "trigger_control", "id"))
        .unionByName(rows(negative, "negative_flag_logs", "trigger_id"))
    )


# --- ids ---------------------------------------------------------------------------------------

@query(
    "next_log_ids",
    f"SELECT (SELECT max(id) FROM ({LOG}) l) + row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey FROM orders",
)
def next_log_ids(spark, sf):
    new = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    return ids.with_next_ids(new, fx.log(spark, sf), ["o_orderkey"])


@query("max_log_id", f"SELECT max(id) AS max_id FROM ({LOG}) l")
def max_log_id(spark, sf):
    return ids.max_id(fx.log(spark, sf))


# --- log queries -------------------------------------------------------------------------------

@query("log_list", f"SELECT {LOG_COLUMNS} FROM ({LOG}) l")
def log_list(spark, sf):
    return L.list_log(fx.log(spark, sf))


@query(
    "log_filter",
    f"SELECT {LOG_COLUMNS} FROM ({LOG}) l WHERE environment = 'pro' AND logged_at >= TIMESTAMP '2024-01-05' "
    "AND logged_at <= TIMESTAMP '2024-01-20' ORDER BY logged_at DESC, id DESC",
)
def log_filter(spark, sf):
    return L.filter_log(fx.log(spark, sf), "pro", "2024-01-05", "2024-01-20")


@query("log_filter_flag", f"SELECT {LOG_COLUMNS} FROM ({LOG}) l WHERE validation_flag = '44' ORDER BY logged_at DESC, id DESC")
def log_filter_flag(spark, sf):
    return L.filter_log(fx.log(spark, sf), flag="44")


@query("log_latest", f"SELECT {LOG_COLUMNS} FROM ({LOG}) l ORDER BY logged_at DESC, id DESC LIMIT 20")
def log_latest(spark, sf):
    return L.latest(fx.log(spark, sf))


@query(
    "log_page",
    f"WITH l AS ({LOG}) SELECT {LOG_COLUMNS} FROM l WHERE (logged_at, id) < (TIMESTAMP '2024-01-15', 0) "
    "ORDER BY logged_at DESC, id DESC LIMIT 50",
)
def log_page(spark, sf):
    return L.page(fx.log(spark, sf), 50, after=("2024-01-15 00:00:00", 0))


@query("log_sort", f"SELECT {LOG_COLUMNS} FROM ({LOG}) l ORDER BY lower(coalesce(field_name, 'null')) DESC, id")
def log_sort(spark, sf):
    return L.sort_log(fx.log(spark, sf), "field_name", ascending=False)


@query(
    "log_local_time",
    f"SELECT id, strftime(logged_at + INTERVAL 1 HOUR, '%d/%m/%Y, %H:%M:%S') AS local_time FROM ({LOG}) l",
)
def log_local_time(spark, sf):
    """The events lie in January, when Madrid is one hour ahead of UTC."""
    return L.with_local_time(fx.log(spark, sf)).select("id", "local_time")


_MEANING = "CASE validation_flag " + " ".join(f"WHEN '{f}' THEN '{m}'" for f, _, m in model.FLAGS) + " END"
_PHASE = "CASE validation_flag " + " ".join(f"WHEN '{f}' THEN '{p}'" for f, p, _ in model.FLAGS) + " END"


@query(
    "log_outcome",
    f"SELECT {LOG_COLUMNS}, {_PHASE} AS phase, {_MEANING} AS meaning, CASE WHEN validation_flag = '2' THEN 'passed' "
    "WHEN validation_flag = '99' THEN 'unconfigured' WHEN validation_flag IN ('30','35','39','44') THEN 'failed' "
    f"ELSE 'unknown' END AS outcome FROM ({LOG}) l",
)
def log_outcome(spark, sf):
    return L.with_outcome(fx.log(spark, sf))


@query("log_error_rates", f"SELECT file_name, validation_flag, count(*) AS n FROM ({LOG}) l GROUP BY ALL")
def log_error_rates(spark, sf):
    return L.error_counts(fx.log(spark, sf))


@query(
    "log_pass_rates",
    f"SELECT date_trunc('day', logged_at) AS day, count(*) AS n, count(*) FILTER (validation_flag = '2') AS n_passed, "
    f"count(*) FILTER (validation_flag = '2') / count(*) AS pass_rate FROM ({LOG}) l GROUP BY 1",
)
def log_pass_rates(spark, sf):
    return L.pass_rates(fx.log(spark, sf)).withColumn("day", F.col("day").cast("timestamp_ntz"))


@query(
    "log_with_config",
    f"SELECT l.id, l.validation_flag, c.id AS cfg_id, c.path AS cfg_path, c.delimiter AS cfg_delimiter "
    f"FROM ({LOG}) l JOIN ({C}) c ON l.file_config_id = c.id",
)
def log_with_config(spark, sf):
    joined = L.with_profile(fx.log(spark, sf), fx.configs(spark, sf))
    return joined.select("id", "validation_flag", "cfg_id", "cfg_path", "cfg_delimiter")


@query("negative_flag_route", _NEGATIVE)
def negative_flag_route(spark, sf):
    return L.negative_rows(fx.log(spark, sf))
