"""Keys, constraints, ids, registry, log queries, sinks."""

import datetime

import pytest
from pyspark.sql import functions as F

from dropgate import model
from dropgate.operators import constraints, ids, joins, keys, probes, registry
from dropgate.plans import logqueries as L
from dropgate.sinks import writers
from dropgate.sources import tables


def test_concatenated_keys_collide(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("a§b", "c"), ("a", "b§c")], "a string, b string")
    assert keys.duplicate_keys(df, ["a", "b"]).count() == 0
    assert keys.duplicate_keys_concat(df, ["a", "b"]).count() == 2
    assert keys.duplicate_keys_concat(df, []).first().n_rows == 4
    assert keys.key_is_unique(df, []).first().is_unique and keys.key_is_unique(df, ["a", "b"]).first().is_unique


@pytest.mark.parametrize("rows_per_bucket", [50, joins.ROWS_PER_BUCKET])
def test_skew_joins_equal_plain_ones(spark, rows_per_bucket):
    left = spark.range(0, 3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id END AS k")
    left = left.unionAll(left.filter("k = 7 OR k IS NULL OR k = 2999"))
    right = spark.range(0, 500).selectExpr("CAST(id AS INT) AS k", "id * 2 AS v")
    right = right.unionAll(spark.createDataFrame([(None, -1)], "k int, v long"))
    plain = left.join(right, left.k.eqNullSafe(right.k), "left").select("id", left.k, "v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.skew_left_join(left, right, ["k"], rows_per_bucket).collect()
        anti = joins.skew_anti_join(left, right, ["k"], rows_per_bucket).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(got, key=str) == sorted(plain.collect(), key=str)
    assert sorted(anti, key=str) == sorted(left.join(right, "k", "left_anti").select("id", "k").collect(), key=str)


def test_only_hot_keys_are_spread(spark):
    left = spark.range(0, 3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k")
    right = spark.range(0, 500).selectExpr("id AS k", "id * 2 AS v")
    types = joins.key_types(left, right, ["k"])
    hot = joins.hot_keys(left, types, 100).collect()
    seven = spark.sql("SELECT xxhash64(CAST(7 AS BIGINT)) AS h").first().h
    assert [tuple(r) for r in hot] == [(seven, 11)]  # 1,001 rows, one bucket for every 100
    counts = left.groupBy("k").count()
    assert joins.hot_counted(counts, types, "count", 100).collect() == hot
    l, r = joins._salted(left, right, types, joins.hot_keys(left, types, 100))
    assert r.count() == 500 + 10 and l.filter("k = 7").select("__salt").distinct().count() == 11
    assert l.filter("k <> 7 AND __salt <> 0").isEmpty()
    l, r = joins._salted(left, right, types, joins.hot_keys(left, types))
    assert r.count() == 500 and l.filter("__salt <> 0").isEmpty()


def test_skew_joins_of_empty_tables(spark):
    left = spark.createDataFrame([], "id long, k string")
    right = spark.createDataFrame([], "k string, v int")
    full = spark.createDataFrame([(1, None), (2, "a"), (2, "a")], "id long, k string")
    assert joins.skew_left_join(left, right, ["k"]).count() == 0
    assert joins.skew_left_join(full, right, ["k"], 1).count() == 3 and joins.skew_anti_join(full, right, ["k"], 1).count() == 3


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    source = spark.createDataFrame([(2, None), (3, "c")], "id int, v string")
    assert sorted(keys.upsert_by_key(target, source, ["id"]).collect()) == [(1, "a"), (2, None), (3, "c")]
    with pytest.raises(Exception, match="more than once"):
        keys.upsert_by_key(target, source.unionByName(source), ["id"]).collect()


def test_orphans_and_cascade(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [tuple(r) for r in keys.orphan_keys(child, "fk", parent, "id").collect()] == [(9, 2)]


@pytest.mark.parametrize("rows", [1, 1000])
def test_ids_are_dense_and_stable(spark, rows):
    new = spark.range(0, 500).selectExpr("concat('p', id) AS path")
    old = spark.createDataFrame([(41,)], "id long")
    bucket = F.pmod(F.xxhash64("path"), F.lit(rows))
    got = ids.with_next_ids(new, old, ["path"], bucket=bucket)
    assert sorted(r.id for r in got.collect()) == list(range(42, 542))
    assert sorted(got.collect()) == sorted(ids.with_next_ids(new.repartition(7), old, ["path"], bucket=bucket).collect())
    assert min(r.id for r in ids.with_next_ids(new, old.limit(0), ["path"]).collect()) == 1


def test_probes(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    conditions = {"big": F.col("x") > 5, "one": F.col("x") == 1}
    assert tuple(probes.any_violation(df, conditions).first()) == (0, 1)
    assert tuple(probes.any_violation(df.limit(0), conditions).first()) == (0, 0)
    assert probes.exists(df, F.col("x") == 1).first().found and not probes.exists(df, F.col("x") > 5).first().found


def config(spark):
    row = lambda i, n, d: (i, "csv", "/d/", n, False, d, "'", "~", None, None, "x")
    return spark.createDataFrame([row(1, "a.csv", ";"), row(5, "b.csv", "|")], model.FILE_CONFIGURATION)


def test_register(spark):
    names = spark.createDataFrame([("b.csv",), ("new.csv",), ("new2.csv",), ("new.csv",)], "file_name string")
    got = {r.file_name: r for r in registry.register(config(spark), names, "/land").collect()}
    assert got["a.csv"].delimiter == ";" and got["b.csv"].delimiter == "," and got["b.csv"].id == 5
    assert got["b.csv"].has_header and got["b.csv"].partition_columns is None and got["b.csv"].path == "/d/"
    assert {got["new.csv"].id, got["new2.csv"].id} == {6, 7} and got["new.csv"].path == "/land/"
    assert got["new.csv"].escape_char == "\\" and got["new.csv"].date_format == "yyyy-MM-dd"
    twice = config(spark).unionByName(config(spark).filter("id = 5").withColumn("id", F.lit(8)))
    with pytest.raises(Exception, match="several profiles"):
        registry.register(twice, names, "/land").collect()


def test_patch_tells_absent_from_null(spark):
    patches = spark.createDataFrame(
        [(1, ",", True, None, True), (5, ",", False, "x", False)],
        "id int, delimiter string, set_delimiter boolean, date_format string, set_date_format boolean",
    )
    base = config(spark).withColumn("date_format", F.lit("keep"))
    got = {r.id: r for r in registry.patch(base, patches).collect()}
    assert (got[1].delimiter, got[1].date_format) == (",", None)
    assert (got[5].delimiter, got[5].date_format) == ("|", "keep")
    assert got[1].quote_char == "'"


def test_defaults_and_widths(spark):
    df = config(spark).withColumn("delimiter", F.lit(None).cast("string"))
    filled = constraints.apply_defaults(df, model.PROFILE_DEFAULTS).first()
    assert filled.delimiter == "," and filled.date_format == "yyyy-MM-dd" and filled.quote_char == "'"
    bad = config(spark).withColumn("delimiter", F.lit("||"))
    assert {r.column_name for r in constraints.profile_problems(bad).collect()} == {"delimiter"}


def log(spark):
    t = lambda h: datetime.datetime(2024, 7, 1, h)
    rows = [
        (1, 1, "a.csv", None, "dev", "2", None, t(0)), (2, 1, "a.csv", "Zeta", "pro", "35", "m", t(1)),
        (3, 2, "b.csv", "alpha", "pro", "99", "m", t(2)), (4, 2, "b.csv", "Null", "dev", "1.13", None, t(2)),
    ]
    return spark.createDataFrame(rows, model.VERDICT_LOG)


def test_log_queries(spark):
    l = log(spark)
    ids_of = lambda df: [r.id for r in df.collect()]
    assert ids_of(L.filter_log(l, "pro")) == [3, 2]
    assert ids_of(L.filter_log(l, from_date="2024-07-01", to_date="2024-07-01")) == [1]  # a date is its midnight
    assert ids_of(L.filter_log(l, flag="99")) == [3]
    assert ids_of(L.latest(l, 2)) == [4, 3]
    assert ids_of(L.sort_log(l, "field_name")) == [3, 1, 4, 2]  # null sorts as the word
    assert ids_of(L.sort_log(l, "logged_at", ascending=False)) == [3, 4, 2, 1]
    first = L.page(l, 2).collect()
    assert [r.id for r in first] == [4, 3]
    assert ids_of(L.page(l, 2, (first[-1].logged_at, first[-1].id))) == [2, 1]
    assert L.with_local_time(l).filter("id = 1").first().local_time == "01/07/2024, 02:00:00"
    assert {r.id: r.outcome for r in L.with_outcome(l).collect()} == {1: "passed", 2: "failed", 3: "unconfigured", 4: "unknown"}
    assert sorted(r.trigger_id for r in L.negative_rows(l).collect()) == [2, 3]


def test_local_time_in_any_session_zone(spark):
    l = log(spark).filter("id = 1")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        instant = L.with_local_time(l.withColumn("logged_at", F.timestamp_seconds(F.lit(1719792000))))
        plain = L.with_local_time(l.withColumn("logged_at", F.expr("TIMESTAMP_NTZ'2024-07-01 00:00:00'")))
        assert {r.local_time for d in (instant, plain) for r in d.collect()} == {"01/07/2024, 02:00:00"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_log_with_profile(spark):
    got = L.with_profile(log(spark), config(spark))
    assert sorted((r.id, r.cfg_file_name) for r in got.collect()) == [(1, "a.csv"), (2, "a.csv")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "x;y"), ("b", None)], "k string, v string")
    writers.write_csv(df, f"{tmp_path}/c", delimiter=";")
    writers.write_csv(df, f"{tmp_path}/c", delimiter=";")
    assert spark.read.option("sep", ";").option("header", "true").csv(f"{tmp_path}/c").count() == 4
    writers.write_partitioned(df, f"{tmp_path}/p", "k")
    assert spark.read.parquet(f"{tmp_path}/p").filter("k = 'a'").first().v == "x;y"
    assert writers.shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_hash_partition_scan_keeps_all_rows(spark):
    df = spark.createDataFrame([("1.5",), ("-13",), ("x",), (None,)], "v string")
    got = {r.v: r.scan_bucket for r in tables.hash_partition_scan(df, "v", limit=None).collect()}
    assert got == {"1.5": 1, "-13": 1, "x": 12, None: 12}
    assert len(tables.jdbc_predicates("c")) == 13
    bounded = tables.hash_partition_scan(df, "v", limit=2)
    assert bounded.count() == 2


def test_typed_scan(spark):
    df = spark.createDataFrame([("1", "x")], "id string, file_name string")
    row = tables.typed(df, model.FILE_CONFIGURATION).first()
    assert row.id == 1 and row.delimiter is None
