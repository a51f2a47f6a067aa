"""The verdict log at constant cost, its compaction and replays; arrivals of zero bytes; listing on executors; ids at skew."""

import os
import re

import pytest
from pyspark.sql import functions as F
from test_files import config, line, put, stream  # noqa: F401

from dropgate.operators import ids
from dropgate.sinks import writers
from dropgate.sinks.writers import VerdictLog
from dropgate.sources import files as src, listing

ROWS = "file_config_id int, file_name string, field_name string, environment string, validation_flag string, error_message string, path string"


def batch(spark, *paths, flag="30"):
    rows = [(1, p.split("/")[-1], None, "dev", flag if i == 0 else "2", None, p) for i, p in enumerate(paths)]
    return spark.createDataFrame(rows, ROWS).withColumn("logged_at", F.lit("2024-01-01").cast("timestamp"))


def content(log):
    return sorted((r.id, r.path, r.source, r.batch) for r in log.read().collect()), sorted((r.id, r.trigger_id) for r in log.read_negative().collect())


def test_a_batch_reads_nothing_logged_before(spark, tmp_path, monkeypatch):
    """The cost of a batch does not depend on the log: it works without reading the log at all."""
    log = VerdictLog(spark, str(tmp_path))
    log.write_batch(batch(spark, "a/0", "b/0"), "s", 0)
    monkeypatch.setattr(VerdictLog, "read", lambda self: pytest.fail("the log was read"))
    monkeypatch.setattr(VerdictLog, "read_negative", lambda self: pytest.fail("the log was read"))
    for n in range(1, 6):
        log.write_batch(batch(spark, f"a/{n}", f"b/{n}"), "s", n)
    monkeypatch.undo()
    rows, negative = content(log)
    assert [r[0] for r in rows] == list(range(1, 13)) and [r[0] for r in negative] == list(range(1, 7))
    assert sum(len(f) for _, _, f in os.walk(log.mark_path)) < 20


def test_replays_keep_their_ids(spark, tmp_path):
    log = VerdictLog(spark, str(tmp_path))
    for n in range(3):
        log.write_batch(batch(spark, f"a/{n}", f"b/{n}"), "s", n)
    before = content(log)
    log.write_batch(batch(spark, "a/2", "b/2"), "s", 2)
    assert content(log) == before
    # another source writes, then the batch comes again with as many rows, then with one more
    log.write_batch(batch(spark, "x/0"), "t", 0)
    log.write_batch(batch(spark, "a/2", "b/2"), "s", 2)
    assert sorted(r[0] for r in content(log)[0]) == list(range(1, 8))
    log.write_batch(batch(spark, "a/2", "b/2", "c/2"), "s", 2)
    rows = content(log)[0]
    assert len({r[0] for r in rows}) == len(rows) == 8


def test_a_crash_before_the_mark(spark, tmp_path, monkeypatch):
    log = VerdictLog(spark, str(tmp_path))
    for n in range(2):
        with monkeypatch.context() as m:
            m.setattr(VerdictLog, "_write_marks", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                log.write_batch(batch(spark, f"a/{n}", f"b/{n}"), "s", n)
        log.write_batch(batch(spark, f"a/{n}", f"b/{n}"), "s", n)
    assert [r[0] for r in content(log)[0]] == [1, 2, 3, 4]


def test_compaction_keeps_every_row_once(spark, tmp_path, monkeypatch):
    log = VerdictLog(spark, str(tmp_path))
    for n in range(4):
        log.write_batch(batch(spark, f"a/{n}", f"b/{n}"), "s", n)
    log.write_batch(batch(spark, "x/0"), "t", 0)
    before = content(log)
    with monkeypatch.context() as m:  # lost between the files and the mark
        m.setattr(VerdictLog, "_write_marks", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            log.compact("s")
    assert content(log) == before
    log.compact("s")
    assert content(log) == before
    live = [d for d in os.listdir(f"{log.log_path}/source=s") if d.startswith("batch=")]
    assert live == ["batch=3"]
    log.write_batch(batch(spark, "a/3", "b/3"), "s", 3)  # the newest may still be replayed
    assert content(log) == before
    for n in (4, 5):
        log.write_batch(batch(spark, f"a/{n}"), "s", n)
    log.compact("s")
    log.compact("s")
    log.compact("none")
    assert [r[0] for r in content(log)[0]] == list(range(1, 12))


def test_a_log_without_marks_goes_on(spark, tmp_path):
    log = VerdictLog(spark, str(tmp_path))
    old = batch(spark, "a/0", "b/0").withColumn("id", F.when(F.col("path") == "a/0", 41).otherwise(42).cast("long")).select("id", *batch(spark, "a").columns)
    old.coalesce(1).write.parquet(f"{log.log_path}/source=s/batch=0")
    log.write_batch(batch(spark, "a/1"), "s", 1)
    assert max(r[0] for r in content(log)[0]) == 43


def test_stream_logs_empty_files_once(spark, tmp_path, accounts, config, options):  # noqa: F811
    landing, log = str(tmp_path / "in"), VerdictLog(spark, str(tmp_path / "log"))
    put(landing, "u1", "bank.csv", [line(a) for a in accounts])

    def empty(upload, name):
        os.makedirs(f"{landing}/{upload}", exist_ok=True)
        open(f"{landing}/{upload}/{name}", "w").close()

    empty("u2", "bank.csv")
    empty("u3", "half.csv._COPYING_")
    run = lambda: stream(spark, landing, log, str(tmp_path / "cp"), config, options)
    seen = lambda: sorted((r.path.split("/")[-2], r.validation_flag) for r in log.read().collect())
    run()
    # as in the batch
    from dropgate.plans import files as judge

    judged = judge.judge_landing(spark, src.list_landing(spark, landing), config, judge.Rulebook.bank(options))
    assert seen() == sorted((r.path.split("/")[-2], r.validation_flag) for r in judged.collect()) and len(seen()) == 2
    run()
    assert len(seen()) == 2
    empty("u4", "bank.csv")  # an empty file alone starts a batch
    run()
    assert [u for u, _ in seen()] == ["u1", "u2", "u4"]
    assert sorted(r.id for r in log.read().collect()) == [1, 2, 3]


def test_listing_finds_what_the_scan_finds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listing, "SPREAD", 3)
    monkeypatch.setattr(listing, "PER_TASK", 2)
    for i, name in enumerate(["a.csv", "b c.csv", "ü%.csv", "_hidden.csv", ".dot", "x=1/_y=2.csv", "d/e/f/g.csv", "d/e/h.csv", "d/i.txt", "_no/z.csv", "k._COPYING_"]):
        path = tmp_path / "in" / f"u{i % 4}" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * i)
    where = str(tmp_path / "in")
    for pattern in (None, "*.csv"):
        listed = listing.list_files(spark, where, pattern)
        full = sorted((r.path, r.file_name, r.length) for r in listed.where("length > 0").collect())
        assert full == sorted((r.path, r.file_name, r.length) for r in src.list_landing(spark, where, pattern).where("length > 0").collect()) and full
        assert [r.file_name for r in listed.where("length = 0").collect()] == ["a.csv"]
        # what Spark's own index finds
        by_index = src.empty_files(spark, where + "/u[0-9]", pattern)
        assert sorted(r.path for r in by_index.collect()) == sorted(r.path for r in src.empty_files(spark, where, pattern).collect())


@pytest.mark.parametrize("first", ["v", "null", "many"])
def test_ids_follow_the_order_at_any_skew(spark, monkeypatch, first):
    """No window above its bound although the first column has three values or none."""
    monkeypatch.setattr(ids, "ROWS_PER_BUCKET", 100)
    value = {"v": F.col("id") % 3, "null": F.lit(None).cast("long"), "many": F.col("id") * 7919 % 5000}[first]
    rows = spark.range(5000).select(value.alias("v"), (F.col("id") * 31 % 5000).cast("string").alias("w"))
    got = ids.with_next_ids(rows, 10, ["v", "w"]).orderBy("id").collect()
    key = lambda r: (r.v is not None, r.v or 0, r.w)
    assert [r.id for r in got] == list(range(11, 5011)) and [key(r) for r in got] == sorted(map(key, got))
    buckets = rows.groupBy(ids._range_of(rows, ["v", "w"]).alias("b")).count().collect()
    assert max(r["count"] for r in buckets) <= 3 * 100 and len(buckets) > 20


def dated(spark, n, day, rows=3, hour=10):
    """A batch of ``rows`` rows of one January day."""
    names = [f"p/{n:03d}-{i}" for i in range(rows)]
    at = F.concat(F.lit(f"2024-01-{day:02d} {hour}:00:0"), F.substring("path", -1, 1)).cast("timestamp")
    return batch(spark, *names).withColumn("logged_at", at)


@pytest.fixture
def month(spark, tmp_path):
    """Twelve days of three rows, the two newest batches not compacted; one of them is late and old."""
    log = VerdictLog(spark, str(tmp_path))
    for n in range(12):
        log.write_batch(dated(spark, n, n + 1), "s", n)
        if n == 5:
            log.compact("s")
    log.compact("s")
    log.write_batch(dated(spark, 12, 2, hour=11), "s", 12)
    return log


def days_read(df):
    """Days of the compacted files that the plan's partition filters leave."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: \[([^]]*day#[^]]*)\]", plan)


def keyed(df):
    return [(r.logged_at, r.id) for r in df.collect()]


def test_filter_prunes_days(spark, month):
    from dropgate.plans import logqueries as L

    plain = month.read().drop("day")
    for bounds in (("2024-01-03", "2024-01-05"), (None, "2024-01-02 11:00:00"), ("2024-01-11 10:00:01", None), (None, None)):
        got = month.filter(None, *bounds)
        assert keyed(got) == keyed(L.filter_log(plain, None, *bounds))
        assert bool(days_read(got)) == any(bounds)
    assert month.filter("none").isEmpty() and month.filter(flag="30").count() == 13
    # the days lie on disk as directories, so a pruned day's files are not opened
    for root, _, names in os.walk(f"{month.log_path}_compacted"):
        for f in names:
            if "day=2024-01-07" in root and f.endswith(".parquet"):
                with open(f"{root}/{f}", "wb") as out:
                    out.write(b"not read")
                crc = f"{root}/.{f}.crc"
                if os.path.exists(crc):
                    os.unlink(crc)
    assert month.filter(None, "2024-01-08", "2024-01-09 23:00:00").count() == 6
    assert len(month.latest(5).collect()) == 5
    with pytest.raises(Exception):
        month.filter(None, "2024-01-06", "2024-01-09").collect()


def test_pages_read_the_newest_days(spark, month):
    from dropgate.plans import logqueries as L

    plain = month.read().drop("day")
    for size in (1, 3, 4, 20, 38, 39, 40, 1000):
        assert keyed(month.latest(size)) == keyed(L.latest(plain, size))
    assert days_read(month.latest(5)) and not days_read(month.latest(1000))
    got, after = [], None
    while rows := month.page(7, after).collect():
        got += [(r.logged_at, r.id) for r in rows]
        after = (rows[-1].logged_at, rows[-1].id)
    assert got == keyed(L.latest(plain, 1000)) and len(got) == 39


def test_days_do_not_follow_the_session_zone(spark, month):
    before = [keyed(month.filter(None, "2024-01-03 10:00:01", "2024-01-05 10:00:00")), keyed(month.latest(8))]
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")  # 14 hours ahead
    try:
        assert [keyed(month.filter(None, "2024-01-04 00:00:01", "2024-01-06 00:00:00")), keyed(month.latest(8))] == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_lost_generation_is_an_error(spark, month):
    os.rename(f"{month.log_path}_compacted/source=s/generation=1", f"{month.directory}/elsewhere")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        month.read()


def test_rows_without_time(spark, tmp_path):
    log = VerdictLog(spark, str(tmp_path))
    for n in range(3):
        log.write_batch(batch(spark, f"a/{n}").withColumn("logged_at", F.lit(None).cast("timestamp")), "s", n)
    log.compact("s")
    log.write_batch(dated(spark, 3, 1, 1), "s", 3)
    assert [r.id for r in log.latest(10).collect()] == [4, 3, 2, 1] and log.filter(None, "2020-01-01").count() == 1
