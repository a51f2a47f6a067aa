"""Table scans: metadata and log tables, Parquet by default, JDBC where a database holds them."""

from __future__ import annotations

from typing import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Buckets, fetch size and place of the bucket column.
SCAN_PARTITIONS = 12
FETCH_SIZE = 10_000
PARTITION_COLUMN_INDEX = 5


def read_table(spark: SparkSession, link: str) -> DataFrame:
    """A whole table: a catalog name, a Parquet path, or an aliased query in parentheses."""
    link = link.strip()
    if link.startswith("("):
        return spark.sql(f"SELECT * FROM {link}")
    return spark.read.parquet(link) if "/" in link else spark.read.table(link)


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Control data of the driver as a frame, handed over as Arrow so that no Python worker is started."""
    target = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(target)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=target), schema)


def schema_probe(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types without reading rows."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a fixed schema; a missing column becomes null, a bad value null instead of an error."""
    return df.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def scan_bucket(column: str, buckets: int = SCAN_PARTITIONS):
    """Bucket of a number by its integer part; null where it is not a number."""
    return F.abs(F.split_part(F.col(f"`{column}`").cast("string"), F.lit("."), F.lit(1)).try_cast("bigint")) % buckets


def hash_partition_scan(
    df: DataFrame,
    column: str | None = None,
    buckets: int = SCAN_PARTITIONS,
    limit: int | None = None,
) -> DataFrame:
    """All rows with the bucket of ``column`` (default: the sixth) as ``scan_bucket``.

    Rows whose column is null or no number get bucket ``buckets`` instead of being lost.  The scan's own
    partitions stay, since one bucket may hold any amount.  A ``limit`` is only for callers who ask for a
    bounded excerpt: which rows it keeps is open, as there is no order.
    """
    column = column or df.columns[PARTITION_COLUMN_INDEX]
    bucket = F.coalesce(scan_bucket(column, buckets), F.lit(buckets)).cast("int")
    if limit is None:
        return df.withColumn("scan_bucket", bucket)
    return df.limit(limit).withColumn("scan_bucket", bucket).repartition(buckets + 1, "scan_bucket")


def jdbc_predicates(column: str, buckets: int = SCAN_PARTITIONS) -> list[str]:
    """WHERE clauses of a partitioned JDBC read (Postgres dialect), the null bucket included."""
    bucket = f"MOD(ABS(CAST(SPLIT_PART(CAST({column} AS VARCHAR), '.', 1) AS BIGINT)), {buckets})"
    return [f"{bucket} = {i}" for i in range(buckets)] + [f"{column} IS NULL"]


def read_jdbc(
    spark: SparkSession,
    url: str,
    link: str,
    properties: Mapping[str, str],
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A table or aliased query over JDBC; one partition per predicate."""
    props = {"fetchsize": str(FETCH_SIZE), **properties}
    if predicates:
        return spark.read.jdbc(url, link, predicates=list(predicates), properties=props)
    return spark.read.jdbc(url, f"(SELECT * FROM {link}) AS subquery", properties=props)
