"""Queries of the contract checks, business rules and verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import model
from ..functions import casts, text
from ..operators import constraints, keys, probes, rules as R, schema_import
from ..operators.structural import parsed_structure
from ..plans import verdict as V
from ..sinks import writers
from . import fixtures as fx
from . import oracle as O
from .base import OPTIONS, query

D = fx.duck(fx.DIRTY)


# --- conversions -----------------------------------------------------------------------------

def _converted(sql, value, **extra):
    def run(spark, sf):
        return fx.frame(spark, sf, sql).selectExpr(
            "*", f"CAST({value} AS STRING) AS value", f"raw IS NOT NULL AND {value} IS NULL AS invalid"
        )
    return run


def _converted_oracle(sql, value, shown=None):
    return (
        f"SELECT *, {shown or f'CAST({value} AS VARCHAR)'} AS value, raw IS NOT NULL AND ({value}) IS NULL AS invalid "
        f"FROM ({fx.duck(sql)}) n"
    )


query("type_int", _converted_oracle(fx.NUMBERS, O.integer("raw")))(_converted(fx.NUMBERS, casts.lenient_integer("raw")))
query("type_bigint", _converted_oracle(fx.NUMBERS, O.integer("raw", "BIGINT")))(
    _converted(fx.NUMBERS, casts.lenient_integer("raw", "bigint"))
)
query(
    "type_int_strict",
    _converted_oracle(fx.NUMBERS, "CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+') THEN TRY_CAST(trim(raw) AS INTEGER) END"),
)(_converted(fx.NUMBERS, casts.lenient_integer("raw", strict=True)))
query("type_decimal", _converted_oracle(fx.DECIMALS, "TRY_CAST(raw AS DECIMAL(8,2))"))(
    _converted(fx.DECIMALS, casts.decimal("raw", 8, 2))
)
query("type_decimal_symbol", _converted_oracle(fx.DECIMALS, "TRY_CAST(replace(raw, ',', '.') AS DECIMAL(8,2))"))(
    _converted(fx.DECIMALS, casts.decimal("raw", 8, 2, ","))
)
query("type_date", _converted_oracle(fx.DATES, O.iso_date("raw")))(_converted(fx.DATES, casts.date("raw", "yyyy-MM-dd")))
_DMY = "CASE WHEN regexp_full_match(raw, '[0-9]{2}/[0-9]{2}/[0-9]{4}') THEN TRY_CAST(concat(substr(raw,7,4),'-',substr(raw,4,2),'-',substr(raw,1,2)) AS DATE) END"
query("type_date_pattern", _converted_oracle(fx.DATES, _DMY))(_converted(fx.DATES, casts.date("raw", "dd/MM/yyyy")))
query("type_timestamp", _converted_oracle(fx.TIMESTAMPS, O.iso_timestamp("raw")))(
    _converted(fx.TIMESTAMPS, casts.timestamp("raw", "yyyy-MM-dd HH:mm:ss"))
)
_T = "CASE WHEN regexp_full_match(raw, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}') THEN TRY_CAST(replace(raw,'T',' ') AS TIMESTAMP) END"
query("type_timestamp_pattern", _converted_oracle(fx.TIMESTAMPS, _T))(
    _converted(fx.TIMESTAMPS, casts.timestamp("raw", "yyyy-MM-dd'T'HH:mm:ss"))
)
_E = "CASE WHEN regexp_full_match(raw, '[0-9]+') THEN epoch_ms(CAST(raw AS BIGINT)) END"
query("type_timestamp_epoch", _converted_oracle(fx.EPOCHS, _E, f"strftime({_E}, '%Y-%m-%d %H:%M:%S')"))(
    _converted(fx.EPOCHS, casts.timestamp("raw", "epoch_millis"))
)


# --- typing phase on the dirty accounts --------------------------------------------------------

def _typing(flag: str):
    """Violations of one typing step: (order_key, field_name)."""
    def run(spark, sf):
        rules = [r for r in R.typing_rules(model.BANK_ACCOUNTS, model.Profile()) if r.flag == flag]
        hits = fx.dirty(spark, sf).selectExpr("order_key", f"explode({R.all_violations(rules)}) AS i")
        return hits.selectExpr("order_key", f"{R.rule_attribute(rules, 'field', 'i')} AS field_name")
    return run


def _typing_oracle(flag: str) -> str:
    return " UNION ALL ".join(
        f"SELECT order_key, {O.text(field)} AS field_name FROM ({D}) a WHERE {c}"
        for f, _, field, _, c in O.rules() if f == flag
    )


query("type_check", _typing_oracle("35"))(_typing("35"))
query("null_check", _typing_oracle("36"))(_typing("36"))
query("length_check", _typing_oracle("37"))(_typing("37"))
query("text_format", _typing_oracle("38"))(_typing("38"))


@query("text_delimiter", "SELECT doc_id FROM documents WHERE contains(text, ',')")
def text_delimiter(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").filter(F.col("text").contains(",")).select("doc_id")


@query("text_unescaped_quote", "SELECT doc_id FROM documents WHERE " + O.UNESCAPED_QUOTE.format(c="text"))
def text_unescaped_quote(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.filter(text.unescaped_quote("text", '"', "\\")).select("doc_id")


@query("text_length_profile", "SELECT lang, count(*) AS n_long FROM documents WHERE length(text) > 1000 GROUP BY lang")
def text_length_profile(spark, sf):
    """The length check (1,000 characters) on whole texts."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.filter(F.length("text") > 1000).groupBy("lang").agg(F.count(F.lit(1)).alias("n_long"))


# --- business rules ----------------------------------------------------------------------------

def _business(rule: model.BusinessRule):
    def run(spark, sf):
        seen = R.business_frame(
            fx.dirty(spark, sf), model.BANK_ACCOUNTS, options=OPTIONS, keep=["order_key", f"{rule.field} AS raw_value"]
        )
        return seen.filter(R.business_rule(rule).condition).select("order_key", "raw_value")
    return run


for _rule in model.BANK_RULES:
    _name = {
        "40": "account_format", "41": "credit_range", "42": "risk_range", "43": "minor", "44": "active_negative",
        "45": "closed_nonzero", "46": "checking_interest", "47": "overdraft", "48": "joint_few_tx", "49": "avg_without_tx",
    }[_rule.flag]
    query(
        f"rule_{_rule.flag}_{_name}",
        f"SELECT order_key, {_rule.field} AS raw_value FROM ({D}) a WHERE {O.BUSINESS[_rule.flag]}",
    )(_business(_rule))


@query(
    "rule_null_semantics",
    f"SELECT order_key, coalesce(first_name = 'Name1' AND status = 'Active', false) AS and_hit, "
    f"coalesce(first_name = 'Name1' OR status = 'Active', false) AS or_hit, "
    f"coalesce(NOT (first_name = 'Name1'), false) AS not_hit FROM ({D}) a",
)
def rule_null_semantics(spark, sf):
    """An unknown condition is no violation."""
    named, active = F.col("first_name") == "Name1", F.col("status") == "Active"
    hit = lambda c: F.when(c, True).otherwise(False)
    return fx.dirty(spark, sf).select(
        "order_key", hit(named & active).alias("and_hit"), hit(named | active).alias("or_hit"), hit(~named).alias("not_hit")
    )


@query(
    "probe_any_violation",
    f"SELECT {', '.join(f'max(CASE WHEN {c} THEN 1 ELSE 0 END) AS rule_{f}' for f, c in O.BUSINESS.items())} FROM ({D}) a",
)
def probe_any_violation(spark, sf):
    seen = R.business_frame(fx.dirty(spark, sf), model.BANK_ACCOUNTS, options=OPTIONS)
    return probes.any_violation(
        seen, {f"rule_{r.flag}": F.expr(R.business_rule(r).condition) for r in model.BANK_RULES}
    )


@query("probe_exists", f"SELECT count(*) > 0 AS found FROM ({D}) a WHERE first_name IS NULL")
def probe_exists(spark, sf):
    return probes.exists(fx.dirty(spark, sf), F.col("first_name").isNull())


# --- keys --------------------------------------------------------------------------------------

@query(
    "pk_duplicates",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def pk_duplicates(spark, sf):
    return keys.duplicate_keys(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_orderkey", "l_linenumber"])


@query(
    "pk_duplicates_compat",
    "SELECT concat_ws('§', nullif(l_returnflag,'A'), nullif(l_linestatus,'F'), l_orderkey) AS pk, count(*) AS n_rows "
    "FROM lineitem GROUP BY 1 HAVING count(*) > 1",
)
def pk_duplicates_compat(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.expr("nullif(l_returnflag,'A')").alias("a"), F.expr("nullif(l_linestatus,'F')").alias("b"),
        F.col("l_orderkey").cast("string").alias("c"),
    )
    return keys.duplicate_keys_concat(df, ["a", "b", "c"])


@query(
    "pk_unique",
    "SELECT 'orders' AS tbl, count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders UNION ALL "
    "SELECT 'lineitem', count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem",
)
def pk_unique(spark, sf):
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    a = keys.key_is_unique(read("orders"), ["o_orderkey"]).select(F.lit("orders").alias("tbl"), "is_unique")
    b = keys.key_is_unique(read("lineitem"), ["l_orderkey", "l_linenumber"])
    return a.unionByName(b.select(F.lit("lineitem").alias("tbl"), "is_unique"))


@query("agg_group_count", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def agg_group_count(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet")
    return df.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("agg_distinct", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def agg_distinct(spark, sf):
    return spark.read.parquet(f"{sf}/lineitem.parquet").select("l_partkey", "l_returnflag").distinct()


# --- verdicts ----------------------------------------------------------------------------------

@query("file_verdict", O.verdict(fx.FILES, "file_name"))
def file_verdict(spark, sf):
    return V.file_verdicts(fx.files(spark, sf), by=["file_name"], options=OPTIONS)


_PHASE_ROWS = " UNION ALL ".join(
    [
        "SELECT file_name, 'structural' AS phase, '1.13' AS flag, true AS ok, NULL AS error_message, NULL AS field_name FROM f"
    ]
    + [
        f"SELECT file_name, '{p}', {O.first(0, (p,), O.text(model.PHASE_PASSED[p]))}, ({O.first(0, (p,))}) IS NULL, "
        f"{O.first(3, (p,))}, {O.first(2, (p,))} FROM f"
        for p in ("typing", "key", "functional")
    ]
)


@query("phase_verdicts", f"{O.per_file(fx.FILES, 'file_name')} {_PHASE_ROWS}")
def phase_verdicts(spark, sf):
    return V.phase_verdicts(fx.files(spark, sf), by=["file_name"], options=OPTIONS)


_COUNTS = (
    f"WITH a AS ({D}), k AS (SELECT *, count(*) OVER (PARTITION BY account_number) AS n_key FROM a), "
    "c AS (SELECT " + ", ".join(f"sum(CASE WHEN {r[4]} THEN 1 ELSE 0 END) AS s{i}" for i, r in enumerate(O.rules())) + " FROM k) "
    + " UNION ALL ".join(
        f"SELECT {O.text(r[0])} AS flag, {O.text(r[2])} AS field_name, {O.text(r[3])} AS error_message, "
        f"CAST(s{i} AS BIGINT) AS n_rows FROM c WHERE s{i} > 0"
        for i, r in enumerate(O.rules())
    )
)


@query("violation_counts", _COUNTS)
def violation_counts(spark, sf):
    return V.violation_counts(fx.dirty(spark, sf), options=OPTIONS)


_FLAGS = sorted({r[0] for r in O.rules()}, key=int)
_ROW_FLAGS = "concat_ws(',', " + ", ".join(
    "CASE WHEN " + " OR ".join(f"coalesce({r[4]}, false)" for r in O.rules() if r[0] == flag) + f" THEN '{flag}' END" for flag in _FLAGS
) + ")"


@query(
    "quarantine_rows",
    f"WITH a AS ({D}), k AS (SELECT *, count(*) OVER (PARTITION BY account_number) AS n_key FROM a) "
    f"SELECT * FROM (SELECT order_key, account_number, {_ROW_FLAGS} AS flags FROM k) q WHERE flags <> ''",
)
def quarantine_rows(spark, sf):
    split = V.split_rows(fx.dirty(spark, sf), options=OPTIONS, keep=["order_key"])
    return V.quarantined(split).select("order_key", "account_number", F.array_join("flags", ",").alias("flags"))


@query(
    "accepted_rows",
    f"WITH a AS ({D}), k AS (SELECT *, count(*) OVER (PARTITION BY account_number) AS n_key FROM a) "
    f"SELECT country, status, count(*) AS n FROM (SELECT country, status, {_ROW_FLAGS} AS flags FROM k) q WHERE flags = '' GROUP BY ALL",
)
def accepted_rows(spark, sf):
    split = V.split_rows(fx.dirty(spark, sf), options=OPTIONS)
    return V.accepted(split).groupBy("country", "status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sink_accepted_table",
    f"WITH a AS ({D}), k AS (SELECT *, count(*) OVER (PARTITION BY account_number) AS n_key FROM a) "
    f"SELECT order_key, account_number, CASE WHEN flags = '' THEN 'accepted' ELSE 'quarantined' END AS outcome, flags "
    f"FROM (SELECT order_key, account_number, {_ROW_FLAGS} AS flags FROM k) q",
)
def sink_accepted_table(spark, sf):
    path = writers.shared_dir(spark, "split")
    writers.write_split(V.split_rows(fx.dirty(spark, sf), options=OPTIONS, keep=["order_key"]), path)
    return spark.read.parquet(path).select("order_key", "account_number", "outcome", F.array_join("flags", ",").alias("flags"))


# --- contracts ---------------------------------------------------------------------------------

_C = fx.duck(fx.CONTRACTS)
_PLAN = f"""
SELECT file_config_id, field_position, field_name, step, flag, message, parameter FROM (
  SELECT *, 1 AS step, '35' AS flag, '{model.MSG_TYPE}' AS message, CASE WHEN data_type = 'DECIMAL' THEN length END AS parameter
  FROM ({_C}) c WHERE data_type IN ('INT','BIGINT','DECIMAL','DATE','TIMESTAMP')
  UNION ALL SELECT *, 2, '36', '{model.MSG_NULL}', NULL FROM ({_C}) c WHERE NOT nullable
  UNION ALL SELECT *, 3, '37', '{model.MSG_LENGTH}', length FROM ({_C}) c WHERE data_type IN ('CHAR','varchar') AND regexp_full_match(length, '[0-9]+')
  UNION ALL SELECT *, 4, '38', '{model.MSG_TEXT}', NULL FROM ({_C}) c WHERE data_type IN ('CHAR','varchar','boolean')
) p
"""


@query("contract_plan", _PLAN)
def contract_plan(spark, sf):
    return constraints.contract_plan(fx.contracts(spark, sf))


@query(
    "contract_problems",
    f"""SELECT id, field_name, data_type, length FROM (SELECT *, count(*) OVER (PARTITION BY file_config_id, field_position) AS np,
  count(*) OVER (PARTITION BY file_config_id, field_name) AS nn FROM ({_C}) c) x WHERE data_type = 'DECIMAL' AND length IS NULL OR np > 1 OR nn > 1""",
)
def contract_problems(spark, sf):
    return constraints.contract_problems(fx.contracts(spark, sf)).select("id", "field_name", "data_type", "length")


@query("structural_empty_file", "SELECT CASE WHEN count(*) = 0 THEN '34' END AS validation_flag FROM orders")
def structural_empty_file(spark, sf):
    """The older emptiness check on a parsed frame."""
    return parsed_structure(fx.accounts(spark, sf).drop("order_key"), model.BANK_ACCOUNTS)


# a JSON Schema per customer: one nested object, in some documents required, and a broken text now and then
_SCHEMAS = """
SELECT cast(c_custkey as int) AS file_config_id,
  CASE WHEN c_custkey % 97 = 0 THEN concat('{{"properties": ', c_name) ELSE concat(
    '{{"type": "object", "required": ["key"', CASE WHEN c_custkey % 2 = 0 THEN ', "home"' ELSE '' END, '], "properties": {{',
    '"key": {{"type": "integer", "x-primary-key": true}}, ',
    '"balance": {{"type": "number", "multipleOf": 0.01}}, ',
    '"home": {{"type": ', CASE WHEN c_custkey % 3 = 0 THEN '["object", "null"]' ELSE '"object"' END, ', "required": ["nation"], "properties": {{',
    '"nation": {{"type": "string", "maxLength": ', cast(c_nationkey + 1 as string), '}}, "since": {{"type": "string", "format": "date"}}}}}}, ',
    '"note": ', CASE WHEN c_custkey % 89 = 0 THEN '{{"$ref": "#/note"}}' ELSE '{{"type": ["string", "null"]}}' END, '}}}}') END AS document
FROM customer
"""
_IMPORTED = """
SELECT cast(c_custkey as int) AS file_config_id, cast(field_position as int) AS field_position, field_name, pk, data_type, length, nullable
FROM (
  SELECT *, 1 AS field_position, 'balance' AS field_name, false AS pk, 'DECIMAL' AS data_type, '38,2' AS length, true AS nullable FROM customer
  UNION ALL SELECT *, 2, 'home.nation', false, 'varchar', cast(c_nationkey + 1 as string), c_custkey % 2 <> 0 OR c_custkey % 3 = 0 FROM customer
  UNION ALL SELECT *, 3, 'home.since', false, 'DATE', NULL, true FROM customer
  UNION ALL SELECT *, 4, 'key', true, 'BIGINT', NULL, false FROM customer
  UNION ALL SELECT *, 5, 'note', false, 'varchar', NULL, true FROM customer
) f WHERE c_custkey % 97 <> 0 AND c_custkey % 89 <> 0
"""
_SCHEMA_PROBLEMS = f"""
SELECT cast(c_custkey as int) AS file_config_id, CASE WHEN c_custkey % 97 <> 0 THEN 'note' END AS field_name,
  CASE WHEN c_custkey % 97 = 0 THEN '{schema_import.NO_JSON}' ELSE '{schema_import.NO_TYPE}' END AS problem
FROM customer WHERE c_custkey % 97 = 0 OR c_custkey % 89 = 0
"""


@query("contract_json_schema", _IMPORTED)
def contract_json_schema(spark, sf):
    got = schema_import.contract_from_schemas(fx.frame(spark, sf, _SCHEMAS))
    return got.select("file_config_id", "field_position", "field_name", "pk", "data_type", "length", "nullable")


@query("json_schema_problems", _SCHEMA_PROBLEMS)
def json_schema_problems(spark, sf):
    got = schema_import.schema_fields(fx.frame(spark, sf, _SCHEMAS)).filter("problem IS NOT NULL")
    return got.select("file_config_id", "field_name", "problem")
