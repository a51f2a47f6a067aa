"""Tables in buckets of a key: what a change touches, and that it equals the same change of the whole table."""

import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropgate.operators import keys, registry
from dropgate.sinks.buckets import BucketedTable
from dropgate.suite import fixtures as fx
from conftest import SF

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(table):
    """Data files by bucket."""
    return {
        d: sorted(f for f in os.listdir(f"{table.path}/{d}") if f.endswith(".parquet"))
        for d in os.listdir(table.path) if d.startswith("bucket=")
    }


@pytest.fixture
def table(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path), SCHEMA, ["id"], 32)
    t.create(spark.range(1000).selectExpr("id", "concat('v', id) AS v"))
    return t


def test_only_touched_buckets_are_written(spark, table):
    before, old = files(table), table.read().collect()
    source = spark.createDataFrame([(3, "new"), (5000, None), (7, "seven")], "id int, v string")
    table.upsert(source)
    after = files(table)
    assert set(after) == set(before) and 1 <= sum(after[b] != before[b] for b in before) <= 3
    assert rows(table.read()) == rows(keys.upsert_by_key(spark.createDataFrame(old, SCHEMA), source, ["id"]))
    table.delete(spark.createDataFrame([(5000,), (5000,), (-1,)], "id long"))
    assert table.read().count() == 1000


def test_a_change_reads_touched_buckets_only(spark, table):
    plan = table._rows([1, 4])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket#\d+ IN \(1,4\)", plan)
    found = table.lookup(spark.createDataFrame([(3,), (3,), (9999,), (None,)], "id int"))
    assert rows(found) == [(3, "v3")]


def test_a_bucket_can_become_empty(spark, table):
    everything = table.read()
    kept = everything.filter("id = 11").collect()
    table.delete(spark.createDataFrame([r for r in everything.collect() if r.id != 11], SCHEMA))
    assert table.read().collect() == kept
    table.delete(spark.createDataFrame([(11,)], "id int"))
    table.delete(spark.createDataFrame([(11,)], "id int"))
    assert table.read().isEmpty()
    table.upsert(spark.createDataFrame([(11, "back")], SCHEMA))
    assert rows(table.read()) == [(11, "back")]


def test_a_failing_change_leaves_the_table(spark, table):
    before = files(table)
    with pytest.raises(Exception, match="more than once"):
        table.upsert(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], SCHEMA))
    with pytest.raises(Exception, match="does not touch"):
        table.change(spark.createDataFrame([(1,)], "id long"), lambda r, s: r.withColumn("id", F.col("id") + 1))
    assert files(table) == before and table.read().count() == 1000
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        BucketedTable(spark, os.path.dirname(table.path), SCHEMA, ["id"], 16).read()
    with pytest.raises(ValueError):
        BucketedTable(spark, "x", T.StructType([T.StructField("Bucket", T.LongType())]), ["Bucket"], 4)


def test_a_source_is_evaluated_once(spark, table):
    """Keys drawn anew at each evaluation would clear buckets whose rows were never read."""
    source = spark.range(3).select((F.rand() * 1000).cast("long").alias("id"), F.lit("drawn").alias("v")).dropDuplicates(["id"])
    table.upsert(source)
    got = table.read().collect()
    assert len(got) == 1000 and {r.id for r in got} == set(range(1000)) and 1 <= sum(r.v == "drawn" for r in got) <= 3


def test_null_keys_empty_tables_and_empty_changes(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path), SCHEMA, ["id"], 4)
    none = spark.createDataFrame([], SCHEMA)
    t.create(none)
    t.upsert(none)
    t.delete(none)
    assert t.read().isEmpty()
    t.upsert(spark.createDataFrame([(None, "x"), (1, "a")], SCHEMA))
    t.upsert(spark.createDataFrame([(None, "y")], SCHEMA))
    t.delete(spark.createDataFrame([(None,)], "id long"))
    assert rows(t.read()) == [(1, "a"), (None, "x"), (None, "y")]


def test_hot_key_of_a_log(spark, tmp_path):
    """A third of the rows under one key: its bucket stays whole, other deletions do not rewrite it."""
    t = BucketedTable(spark, str(tmp_path), SCHEMA, ["v"], 64)
    log = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('p', id % 50) END AS v")
    t.create(log)
    before = files(t)
    t.delete(spark.createDataFrame([("p1",), ("p2",)], "v string"))
    assert rows(t.read()) == rows(log.filter("v NOT IN ('p1', 'p2')"))
    assert sum(files(t)[b] != before[b] for b in before) <= 2
    t.delete(spark.createDataFrame([("hot",)], "v string"))
    assert rows(t.read()) == rows(log.filter("v NOT IN ('p1', 'p2', 'hot')"))


def test_patch_equals_the_whole_table(spark, tmp_path):
    profiles = fx.configs(spark, SF)
    t = BucketedTable(spark, str(tmp_path), profiles.schema, ["id"], 16)
    t.create(profiles)
    patches = spark.createDataFrame([(2, True, ";"), (5, False, "|"), (10**6, True, "#")], "id int, set_delimiter boolean, delimiter string")
    t.change(patches, registry.patch)
    assert rows(t.read()) == rows(registry.patch(profiles, patches))
