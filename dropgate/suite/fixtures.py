"""Inputs of the registered queries, derived by SQL from the given tables.

Each text is portable: Spark and the checking database read the same definition of the *input*; the
operators under test are written separately on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import model

AS_OF = "2024-01-01"

ACCOUNT_COLUMNS = [f.field_name for f in model.BANK_ACCOUNTS]

# one clean bank account per order, from rows of orders with their customer
_ACCOUNT = """
SELECT
  lpad(cast(o_orderkey as string),10,'0') AS account_number,
  concat('Name',cast(o_custkey as string)) AS first_name,
  c_name AS last_name,
  cast(date '1950-01-01' + cast((o_orderkey*37)%19000 as int) as string) AS date_of_birth,
  CASE o_orderkey%3 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' ELSE 'Other' END AS gender,
  concat('u',cast(o_custkey as string),'@example.com') AS email,
  concat('+34',lpad(cast(o_custkey as string),9,'0')) AS phone,
  concat('Street ',cast(o_custkey%500 as string)) AS address,
  concat('City',cast(c_nationkey as string)) AS city,
  concat('State',cast(c_nationkey as string)) AS state,
  lpad(cast(o_custkey%100000 as string),5,'0') AS postal_code,
  concat('Country',cast(c_nationkey as string)) AS country,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE','HOUSEHOLD') THEN 'Checking' ELSE 'Savings' END AS account_type,
  'EUR' AS currency,
  CASE WHEN o_orderstatus='F' THEN '0.00' ELSE cast(cast(abs(c_acctbal) as decimal(12,2)) as string) END AS balance,
  cast(cast(o_orderdate as date) as string) AS created_date,
  concat(cast(cast(o_orderdate as date) as string),' 08:00:00') AS last_login,
  concat(cast(cast(o_orderdate as date) as string),' 09:30:00') AS last_transaction_date,
  CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Suspended' END AS status,
  'Verified' AS kyc_status,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE','HOUSEHOLD') THEN '0.00' ELSE concat(cast(o_orderkey%5 as string),'.',lpad(cast(o_orderkey%100 as string),2,'0')) END AS interest_rate,
  CASE WHEN o_orderstatus='O' THEN concat(cast(o_orderkey%1000 as string),'.00') ELSE '0.00' END AS overdraft_limit,
  cast(300+o_orderkey%551 as string) AS credit_score,
  concat(cast(o_orderkey%100 as string),'.50') AS risk_score,
  concat('M',lpad(cast(o_custkey%100000 as string),5,'0')) AS account_manager_id,
  concat('B',lpad(cast(o_custkey%1000 as string),4,'0')) AS branch,
  concat('City',cast(c_nationkey as string)) AS branch_city,
  CASE WHEN o_orderkey%4=0 THEN 'Yes' ELSE 'No' END AS is_joint_account,
  cast(o_orderkey%20+2 as string) AS num_transactions,
  concat(cast(o_orderkey%900 as string),'.25') AS avg_transaction_amount,
  o_orderkey AS order_key"""
ORDERED = "orders JOIN customer ON o_custkey=c_custkey"


def accounts_of(source: str, extra: str = "") -> str:
    return f"{_ACCOUNT}{extra}\nFROM {source}\n"


ACCOUNTS = accounts_of(ORDERED)

# error class -> overridden columns (SQL over the clean columns)
INJECTED: dict[int, dict[str, str]] = {
    1: {"credit_score": "'7x0'"},
    2: {"balance": "'1,5'"},
    3: {"date_of_birth": "'2020-02-30'"},
    4: {"last_login": "'2020-01-05'"},
    5: {"first_name": "NULL"},
    6: {"country": "repeat('x',51)"},
    7: {"address": "'Street 1, door 2'"},
    8: {"address": "'Street \"x\"'"},
    9: {"account_number": "'0000000009'"},
    10: {"account_number": "concat('BAD-',substr(account_number,5,6))"},
    11: {"credit_score": "'900'"},
    12: {"risk_score": "'101.50'"},
    13: {"date_of_birth": "'2015-06-15'"},
    14: {"status": "'Active'", "balance": "'-0.50'"},
    15: {"status": "'Closed'", "balance": "'0.40'", "overdraft_limit": "'0.00'"},
    16: {"account_type": "'Checking'", "interest_rate": "'0.75'"},
    17: {"overdraft_limit": "'-1.00'"},
    18: {"is_joint_account": "'Yes'", "num_transactions": "'1'"},
    19: {"is_joint_account": "'No'", "num_transactions": "'0'", "avg_transaction_amount": "'3.25'"},
}


def _overridden(case_of: str, base: str, extra: str = "") -> str:
    cols = []
    for name in ACCOUNT_COLUMNS:
        whens = " ".join(f"WHEN {k} THEN {v[name]}" for k, v in INJECTED.items() if name in v)
        cols.append(f"CASE defect {whens} ELSE {name} END AS {name}" if whens else name)
    return f"SELECT {', '.join(cols)}, order_key{extra} FROM (SELECT *, {case_of} AS defect FROM ({base}) a) a"


# every class at once: class k on the rows with order_key % 97 = k
DIRTY = _overridden("order_key % 97", ACCOUNTS)

# twenty files: file 0 is clean, file k carries class k on every 31st of its rows
FILES = _overridden(
    "CASE WHEN (order_key DIV 20) % 31 = 3 THEN order_key % 20 ELSE 0 END",
    ACCOUNTS,
    ", concat('file_', lpad(cast(order_key % 20 as string),2,'0')) AS file_name",
)

# numbers as they come in text files
NUMBERS = """
SELECT o_orderkey AS id, CASE o_orderkey % 17
  WHEN 0 THEN '12.9' WHEN 1 THEN ' 7 ' WHEN 2 THEN '1e2' WHEN 3 THEN '99999999999' WHEN 4 THEN '.5'
  WHEN 5 THEN '.' WHEN 6 THEN '+7' WHEN 7 THEN '' WHEN 8 THEN NULL WHEN 9 THEN '-' WHEN 10 THEN '12.'
  WHEN 11 THEN '-0.5' WHEN 12 THEN 'abc' WHEN 13 THEN '99999999999999999999' WHEN 14 THEN '1,5'
  WHEN 15 THEN concat(cast(o_orderkey as string),'.75') ELSE cast(o_orderkey as string) END AS raw
FROM orders
"""

DECIMALS = """
SELECT o_orderkey AS id, CASE o_orderkey % 9
  WHEN 0 THEN cast(cast(o_totalprice as decimal(12,2)) as string) WHEN 1 THEN '12345.678' WHEN 2 THEN '1,5'
  WHEN 3 THEN '1234567.1' WHEN 4 THEN 'x' WHEN 5 THEN NULL WHEN 6 THEN concat('-',cast(o_orderkey as string),'.5')
  WHEN 7 THEN '0.005' ELSE cast(o_orderkey as string) END AS raw
FROM orders
"""

DATES = """
SELECT o_orderkey AS id, CASE o_orderkey % 8
  WHEN 0 THEN '2020-02-30' WHEN 1 THEN '2020-1-5' WHEN 2 THEN 'x' WHEN 3 THEN NULL
  WHEN 4 THEN concat(substr(cast(cast(o_orderdate as date) as string),9,2),'/',substr(cast(cast(o_orderdate as date) as string),6,2),'/',substr(cast(cast(o_orderdate as date) as string),1,4))
  WHEN 5 THEN '2020-01-05T00:00:00' ELSE cast(cast(o_orderdate as date) as string) END AS raw
FROM orders
"""

TIMESTAMPS = """
SELECT l_orderkey AS id, l_linenumber AS line, CASE (l_orderkey + l_linenumber) % 7
  WHEN 0 THEN cast(cast(l_shipdate as date) as string) WHEN 1 THEN concat(cast(cast(l_shipdate as date) as string),' 25:00:00')
  WHEN 2 THEN concat(cast(cast(l_shipdate as date) as string),'T10:15:00') WHEN 3 THEN NULL WHEN 4 THEN '2020-13-01 00:00:00'
  ELSE concat(cast(cast(l_shipdate as date) as string),' 10:15:0',cast(l_linenumber % 10 as string)) END AS raw
FROM lineitem
"""

EPOCHS = """
SELECT event_id AS id, CASE event_id % 5 WHEN 0 THEN 'x' WHEN 1 THEN NULL WHEN 2 THEN '12.5'
  ELSE cast(1704067200000 + event_id * 1000 as string) END AS raw
FROM events
"""

# one parse profile per customer; some rows break the declared widths or lack values
CONFIGS = """
SELECT cast(c_custkey + 1 as int) AS id,
  CASE WHEN c_custkey % 11 = 5 THEN 'parquet' ELSE 'csv' END AS file_format,
  concat('/data/', lower(c_mktsegment), '/') AS path,
  concat('accounts_', cast(c_custkey as string), '.csv') AS file_name,
  CASE WHEN c_custkey % 23 = 7 THEN NULL ELSE c_custkey % 10 <> 3 END AS has_header,
  CASE c_custkey % 13 WHEN 0 THEN ';' WHEN 1 THEN '|' WHEN 2 THEN '||' WHEN 3 THEN NULL WHEN 4 THEN '' ELSE ',' END AS delimiter,
  CASE c_custkey % 17 WHEN 0 THEN chr(39) WHEN 1 THEN NULL ELSE '"' END AS quote_char,
  CASE c_custkey % 19 WHEN 0 THEN '"' WHEN 1 THEN '~~' WHEN 2 THEN NULL ELSE '~' END AS escape_char,
  CASE c_custkey % 7 WHEN 0 THEN 'dd/MM/yyyy' WHEN 1 THEN NULL ELSE 'yyyy-MM-dd' END AS date_format,
  CASE c_custkey % 5 WHEN 0 THEN 'epoch_millis' WHEN 1 THEN NULL ELSE 'yyyy-MM-dd HH:mm:ss' END AS timestamp_format,
  CASE WHEN c_custkey % 29 = 0 THEN 'country,status' END AS partition_columns
FROM customer
"""

# a column contract of thirty fields per file, from the parts list
CONTRACTS = """
SELECT cast(p_partkey + 1 as int) AS id,
  cast(CASE WHEN p_partkey % 50 = 49 THEN p_partkey % 30 ELSE p_partkey % 30 + 1 END as int) AS field_position,
  concat(replace(p_name,' ','_'),'_',cast(p_partkey % 30 as string)) AS field_name,
  p_type AS field_description,
  p_size % 10 = 0 AS pk,
  CASE p_partkey % 9 WHEN 0 THEN 'INT' WHEN 1 THEN 'BIGINT' WHEN 2 THEN 'DECIMAL' WHEN 3 THEN 'DATE' WHEN 4 THEN 'TIMESTAMP'
    WHEN 5 THEN 'CHAR' WHEN 6 THEN 'varchar' WHEN 7 THEN 'boolean' ELSE 'timestamptz' END AS data_type,
  CASE p_partkey % 9 WHEN 2 THEN CASE WHEN p_size % 6 = 0 THEN NULL ELSE '12,2' END
    WHEN 5 THEN cast(p_size as string) WHEN 6 THEN CASE WHEN p_size % 6 = 0 THEN 'max' ELSE cast(p_size * 10 as string) END END AS length,
  p_size % 4 = 0 AS nullable,
  ',' AS decimal_symbol,
  cast(p_partkey DIV 30 + 1 as int) AS file_config_id
FROM part
"""

# a verdict log: one row per event
LOG = """
SELECT event_id + 1 AS id,
  cast(CASE WHEN event_id % 41 = 0 THEN 0 ELSE user_id + 1 END as int) AS file_config_id,
  concat('accounts_', cast(user_id as string), '.csv') AS file_name,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_type = 'click' THEN 'credit_score' WHEN event_type = 'purchase' THEN 'account_number' WHEN event_type = 'signup' THEN 'balance' END AS field_name,
  CASE event_id % 3 WHEN 0 THEN 'dev' WHEN 1 THEN 'pre' ELSE 'pro' END AS environment,
  CASE WHEN event_id % 41 = 0 THEN '99' WHEN event_type = 'view' THEN CASE WHEN event_id % 7 = 0 THEN '1.13' ELSE '2' END WHEN event_type = 'click' THEN '35' WHEN event_type = 'error' THEN '30' WHEN event_type = 'signup' THEN '44' ELSE '39' END AS validation_flag,
  CASE WHEN event_id % 41 = 0 THEN 'no profile' WHEN event_type = 'click' THEN 'bad type' WHEN event_type = 'error' THEN 'read error' WHEN event_type = 'purchase' THEN 'duplicate' WHEN event_type = 'signup' THEN 'negative' END AS error_message,
  ts AS logged_at
FROM events
"""

TABLES = ["orders", "customer", "lineitem", "events", "part", "documents", "supplier", "nation"]


def frame(spark: SparkSession, sf_dir: str, sql: str, **frames: DataFrame) -> DataFrame:
    """Run an input definition over the given tables, and ``frames`` by name, without touching the session catalog."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if t in sql} | frames
    for t in used:
        sql = _named(sql, t)
    return spark.sql(sql, **used)


def _named(sql: str, table: str) -> str:
    import re

    return re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", sql)


def duck(sql: str) -> str:
    """The same definition in the checking database's dialect."""
    return sql.replace(" DIV ", " // ")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, ACCOUNTS)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, DIRTY)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, FILES)


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, CONFIGS)


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, CONTRACTS)


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, LOG)
