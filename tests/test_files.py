"""Landed files: structure, formats, errors, log and stream."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from dropgate import model
from dropgate.plans import files as judge
from dropgate.operators.rules import Options
from dropgate.sinks.writers import VerdictLog
from dropgate.sources import files as src, tables
from dropgate.streaming import monitor as M
from dropgate.suite import fixtures as fx

NAMES = fx.ACCOUNT_COLUMNS


def cell(v):
    return "" if v is None else f'"{v}"' if "," in v else v


def line(row, sep=","):
    return sep.join(cell(row[n]) for n in NAMES)


def put(root, upload, name, lines, header=NAMES, sep=","):
    os.makedirs(f"{root}/{upload}", exist_ok=True)
    with open(f"{root}/{upload}/{name}", "w") as f:
        f.write("".join(x + "\n" for x in ([sep.join(header)] if header else []) + lines))


def profile(spark, *rows):
    """Rows of (id, file_name, overrides)."""
    out = []
    for i, name, over in rows:
        p = {"id": i, "file_format": "csv", "path": "/d/", "file_name": name, **model.PROFILE_DEFAULTS, **over}
        out.append(tuple(p[f.name] for f in model.FILE_CONFIGURATION.fields))
    return tables.local_frame(spark, out, model.FILE_CONFIGURATION)


def by_upload(judged):
    return {r.path.split("/")[-2]: (r.validation_flag, r.field_name, r.n_rows) for r in judged.collect()}


@pytest.fixture(scope="module")
def landing(tmp_path_factory, accounts):
    root = str(tmp_path_factory.mktemp("landing"))
    ok = [line(a) for a in accounts]
    put(root, "clean", "bank.csv", ok)
    put(root, "separator", "bank.csv", [x.replace(",", ";") for x in ok], sep=";")
    put(root, "swapped", "bank.csv", ok, header=[NAMES[0], NAMES[2], NAMES[1], *NAMES[3:]])
    put(root, "extra_header", "bank.csv", ok, header=[*NAMES, "more"])
    put(root, "header_only", "bank.csv", [])
    put(root, "zero_bytes", "bank.csv", [], header=None)
    put(root, "short_row", "bank.csv", [ok[0].rsplit(",", 1)[0], *ok[1:]])
    put(root, "long_row", "bank.csv", [*ok[:-1], ok[-1] + ",x"])
    put(root, "quoted", "bank.csv", [line(dict(accounts[0], address="a, b")), *ok[1:]])
    put(root, "double", "bank.csv", ok + ok[:1])
    put(root, "header_again", "bank.csv", ok + [",".join(NAMES)])
    put(root, "no_header", "plain.csv", ok, header=None)
    put(root, "no_header_one_column", "plain.csv", ["x"], header=None)
    put(root, "semicolons", "semi.csv", [line(a, ";") for a in accounts], sep=";")
    put(root, "unknown", "other.csv", ok)
    put(root, "text", "notes.txt", ok)
    put(root, "copying", "bank.csv._COPYING_", ok)
    put(root, "hidden", ".bank.csv", ok)
    os.makedirs(f"{root}/zipped")
    with gzip.open(f"{root}/zipped/zip.csv.gz", "wt") as f:
        f.write("\n".join([",".join(NAMES), *ok]) + "\n")
    os.makedirs(f"{root}/broken")
    with open(f"{root}/broken/bad.csv.gz", "wb") as f:
        f.write(b"this is no gzip stream")
    os.makedirs(f"{root}/no_parquet")
    with open(f"{root}/no_parquet/bad.parquet", "w") as f:
        f.write("not parquet at all")
    return root


@pytest.fixture(scope="module")
def config(spark):
    return profile(
        spark, (1, "bank.csv", {}), (2, "plain.csv", {"has_header": False}), (3, "semi.csv", {"delimiter": ";"}),
        (4, "notes.txt", {}), (5, "zip.csv.gz", {}), (6, "bad.csv.gz", {}), (7, "bad.parquet", {}), (8, "gone.csv", {}),
        (9, "bank.csv", {"delimiter": "|"}),  # the lowest id wins
    )


EXPECTED = {
    "clean": ("2", None, 12), "separator": ("32", None, 12), "swapped": ("33", None, 12), "extra_header": ("33", None, 12),
    "header_only": ("34", None, 0), "zero_bytes": ("33", None, 0), "short_row": ("34", None, 12), "long_row": ("34", None, 12),
    "quoted": ("38", "address", 12), "double": ("39", "account_number", 13), "header_again": ("35", "date_of_birth", 13),
    "no_header": ("2", None, 12), "no_header_one_column": ("32", None, 1), "semicolons": ("2", None, 12),
    "unknown": ("99", None, None), "text": ("30", None, None), "zipped": ("2", None, 12), "broken": ("30", None, None),
    "no_parquet": ("30", None, None),
}


def test_listing_skips_hidden_and_unfinished(spark, landing):
    uploads = {r.path.split("/")[-2] for r in src.list_landing(spark, landing).select("path").collect()}
    assert uploads == set(EXPECTED)


def test_landing_verdicts(spark, landing, config, options, tmp_path):
    log, n = VerdictLog(spark, str(tmp_path)), iter(range(100))
    judged = judge.judge_landing(
        spark, src.list_landing(spark, landing), config, judge.Rulebook.bank(options),
        lambda df: log.stage(df, f"g{next(n)}"),
    )
    assert by_upload(judged) == EXPECTED
    errors = {r.file_name: r.error_message for r in judged.filter("validation_flag = '30'").collect()}
    assert "DATA_SOURCE_NOT_FOUND" in errors["notes.txt"] and "FAILED_READ_FILE" in errors["bad.csv.gz"]


def test_compat_options(spark, landing, config):
    import datetime

    book = judge.Rulebook.bank(Options(as_of=datetime.date(2024, 1, 1), row_width=False, header_compat=True))
    keep = F.col("path").rlike("/(short_row|no_header|header_only|clean)/")
    got = by_upload(judge.judge_landing(spark, src.list_landing(spark, landing).filter(keep), config, book))
    assert got["no_header"][0] == "33" and got["header_only"][0] == "34" and got["clean"][0] == "2"
    # the short row is padded, so its last field is an unexpected null
    assert got["short_row"][:2] == ("36", "avg_transaction_amount")


def test_one_column_contract(spark, tmp_path, options):
    put(tmp_path, "u", "ids.csv", ["1", "2"], header=["id"])
    config = profile(spark, (1, "ids.csv", {}))
    for compat, flag in ((False, "2"), (True, "32")):
        book = judge.Rulebook({None: (model.Field(1, "id", "INT", pk=True),)}, (), Options(header_compat=compat))
        got = by_upload(judge.judge_landing(spark, src.list_landing(spark, str(tmp_path)), config, book))
        assert got["u"][0] == flag


def test_contract_per_profile(spark, tmp_path, options):
    put(tmp_path, "a", "a.csv", ["1,x"], header=["id", "name"])
    put(tmp_path, "b", "b.csv", ["1,x"], header=["id", "name"])
    rows = [
        (1, 1, "id", None, True, "INT", None, False, ",", None), (2, 2, "name", None, False, "VARCHAR", "5", False, ",", None),
        (3, 1, "id", None, True, "INT", None, False, ",", 2), (4, 2, "name", None, False, "INT", None, False, ",", 2),
    ]
    book = judge.Rulebook.from_table(spark.createDataFrame(rows, model.SEMANTIC_LAYER), business=())
    config = profile(spark, (1, "a.csv", {}), (2, "b.csv", {}))
    got = by_upload(judge.judge_landing(spark, src.list_landing(spark, str(tmp_path)), config, book))
    assert got["a"][0] == "2" and got["b"][:2] == ("35", "name")


def test_missing_paths(spark, landing, config, options):
    paths = [f"{landing}/clean/bank.csv", f"{landing}/none/gone.csv", f"{landing}/none/what.csv"]
    got = {r.file_name: (r.validation_flag, r.error_message) for r in judge.judge_paths(spark, paths, config, judge.Rulebook.bank(options)).collect()}
    assert got["bank.csv"][0] == "2" and got["what.csv"] == ("99", model.MSG_UNCONFIGURED)
    assert got["gone.csv"][0] == "30" and "PATH_NOT_FOUND" in got["gone.csv"][1]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_files_with_their_own_schema(spark, tmp_path, fmt, options):
    contract = (model.Field(1, "a", "INT", pk=True), model.Field(2, "b", "VARCHAR", "3", nullable=False), model.Field(3, "c", "DECIMAL", "4,2"))
    cases = {
        "ok": "SELECT 1 AS a, 'x' AS b, cast(1.5 as double) AS c", "long": "SELECT 1 AS a, 'xxxx' AS b, cast(1.5 as double) AS c",
        "dup": "SELECT * FROM VALUES (1, 'x', cast(1.5 as double)), (1, 'y', cast(2 as double)) AS t(a, b, c)",
        "overflow": "SELECT 1 AS a, 'x' AS b, cast(1500 as double) AS c", "names": "SELECT 1 AS a, 'x' AS x, cast(1 as double) AS z",
        "one": "SELECT 1 AS a",
    }
    for name, sql in cases.items():
        spark.sql(sql).coalesce(1).write.format(fmt).save(f"{tmp_path}/{name}")
    config = profile(spark, (1, f"t.{fmt}", {}))
    listing = src.list_landing(spark, str(tmp_path)).withColumn("file_name", F.lit(f"t.{fmt}"))
    # part files keep their extension, the logical name is given
    book = judge.Rulebook({None: contract}, (), options)
    got = {k: v[:2] for k, v in by_upload(judge.judge_landing(spark, listing, config, book)).items()}
    assert got == {"ok": ("2", None), "long": ("37", "b"), "dup": ("39", "a"), "overflow": ("35", "c"), "names": ("33", None), "one": ("32", None)}


def test_large_file_over_many_blocks(spark, tmp_path, accounts, options):
    """One header per file, whatever the number of splits; a hot key inside is found."""
    rows = [line(dict(accounts[0], account_number=f"{i:010d}")) for i in range(20_000)]
    put(tmp_path, "big", "bank.csv", rows)
    put(tmp_path, "big_double", "bank.csv", rows + rows[:1])
    config = profile(spark, (1, "bank.csv", {}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        got = by_upload(judge.judge_landing(spark, src.list_landing(spark, str(tmp_path)), config, judge.Rulebook.bank(options)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {"big": ("2", None, 20_000), "big_double": ("39", "account_number", 20_001)}


def stream(spark, landing, log, checkpoint, config, options, **more):
    q = M.monitor(
        spark, landing, log, checkpoint, lambda: config, lambda: judge.Rulebook.bank(options),
        available_now=True, environment="test", **more,
    )
    q.awaitTermination()


def test_stream(spark, tmp_path, accounts, config, options):
    landing, log = str(tmp_path / "in"), VerdictLog(spark, str(tmp_path / "log"))
    ok = [line(a) for a in accounts]
    put(landing, "u1", "bank.csv", ok)
    put(landing, "u2", "bank.csv", ok + ok[:1])
    put(landing, "u3", "what.csv", ok)
    put(landing, "u4", "bank.csv._COPYING_", ok)
    run = lambda: stream(spark, landing, log, str(tmp_path / "cp"), config, options, max_files=2)
    run()
    seen = lambda: sorted((r.path.split("/")[-2], r.validation_flag) for r in log.read().collect())
    assert seen() == [("u1", "2"), ("u2", "39"), ("u3", "99")]
    run()  # nothing new
    assert len(seen()) == 3
    put(landing, "u5", "bank.csv", ok)  # the same name in a new directory is a new arrival
    run()
    assert seen()[-1] == ("u5", "2")
    ids = sorted(r.id for r in log.read().collect())
    assert ids == [1, 2, 3, 4]
    negative = log.read_negative().collect()
    assert sorted(r.validation_flag for r in negative) == ["39", "99"]
    assert {r.trigger_id for r in negative} == {r.id for r in log.read().filter("validation_flag in ('39','99')").collect()}
    assert {r.environment for r in log.read().collect()} == {"test"}


def test_replayed_batch_replaces_itself(spark, tmp_path):
    log = VerdictLog(spark, str(tmp_path))
    rows = spark.createDataFrame(
        [(1, "a.csv", None, "dev", "30", "x", "p1"), (1, "b.csv", None, "dev", "2", None, "p2")],
        "file_config_id int, file_name string, field_name string, environment string, validation_flag string, error_message string, path string",
    ).withColumn("logged_at", F.lit("2024-01-01").cast("timestamp"))
    log.write_batch(rows, "s", 0)
    first = {(r.id, r.path) for r in log.read().collect()}
    log.write_batch(rows, "s", 0)
    assert {(r.id, r.path) for r in log.read().collect()} == first
    assert log.read_negative().count() == 1
    log.write_batch(rows, "s", 1)
    assert sorted(r.id for r in log.read().collect()) == [1, 2, 3, 4]


def test_clean_source_deletes_earlier_batches(spark, tmp_path, accounts, config, options):
    landing, log = str(tmp_path / "in"), VerdictLog(spark, str(tmp_path / "log"))
    for i in range(3):
        put(landing, f"u{i}", "bank.csv", [line(a) for a in accounts])
    stream(spark, landing, log, str(tmp_path / "cp"), config, options, max_files=1, clean_source="delete")
    assert log.read().count() == 3
    left = [f for _, _, fs in os.walk(landing) for f in fs if f.endswith(".csv")]
    assert len(left) < 3
