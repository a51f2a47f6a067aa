"""Names that look like patterns, errors that name files, missing contracts, defaults, ids in order."""

import gzip
import os

import pytest

from dropgate import model
from dropgate.operators import constraints, ids
from dropgate.plans import files as judge
from dropgate.sources import files as src
from dropgate.sources.tables import local_frame


def rows_of(accounts):
    names = [f.field_name for f in model.BANK_ACCOUNTS]
    quoted = [",".join(f'"{a[n]}"' if "," in str(a[n]) else str(a[n]) for n in names) for a in accounts]
    return "\n".join([",".join(names), *quoted]) + "\n"


def profiles(spark, names, **values):
    base = {"file_format": "csv", "path": "/", **model.PROFILE_DEFAULTS, **values}
    columns = [f.name for f in model.FILE_CONFIGURATION.fields]
    rows = [tuple({"id": i + 1, "file_name": n, **base}[c] for c in columns) for i, n in enumerate(names)]
    return local_frame(spark, rows, model.FILE_CONFIGURATION)


def flags(spark, folder, config, book):
    listing = src.list_landing(spark, str(folder))
    return {r.file_name: r.validation_flag for r in judge.judge_landing(spark, listing, config, book).collect()}


def test_names_that_look_like_patterns(spark, tmp_path, accounts, options):
    names = ["g[1].csv", "g1.csv", "br{x}.csv", "st*r.csv", "q?.csv", "sp ace.csv", "p%20.csv"]
    for n in names:
        (tmp_path / n).write_text(rows_of(accounts))
    got = flags(spark, tmp_path, profiles(spark, names), judge.Rulebook.bank(options))
    assert got == dict.fromkeys(names, "2")


def test_missing_contract_is_isolated(spark, tmp_path, accounts, options):
    for n in ("a.csv", "b.csv"):
        (tmp_path / n).write_text(rows_of(accounts))
    book = judge.Rulebook({1: tuple(model.BANK_ACCOUNTS)}, options=options)
    assert flags(spark, tmp_path, profiles(spark, ["a.csv", "b.csv"]), book) == {"a.csv": "2", "b.csv": "99"}


def test_null_profile_values_take_the_defaults(spark, tmp_path, accounts, options):
    (tmp_path / "a.csv").write_text(rows_of(accounts))
    got = flags(spark, tmp_path, profiles(spark, ["a.csv"], has_header=None, delimiter=None), judge.Rulebook.bank(options))
    assert got == {"a.csv": "2"}


def test_errors_name_whole_files():
    assert judge.names_file("cannot read file:///in/x.csv.gz.", "file:/in/x.csv.gz")
    assert not judge.names_file("cannot read file:///in/x.csv.gz.", "file:/in/x.csv")
    assert judge.names_file("cannot read file:/in/x.csv. Ignored", "file:///in/x.csv")


def test_cluster_faults_are_no_verdicts():
    fault = RuntimeError("FetchFailed(BlockManagerId(1), shuffleId=0): java.io.EOFException")
    assert not judge.is_read_error(fault, ["file:/in/x.csv"])
    assert not judge.is_read_error(RuntimeError("java.io.EOFException at shuffle"), ["file:/in/x.csv"])
    broken = "[FAILED_READ_FILE.NO_HINT] Encountered error while reading file file:/in/x.csv. SQLSTATE: KD001"
    assert judge.is_read_error(RuntimeError(broken + "\nCaused by: java.io.EOFException: Unexpected end of ZLIB input stream"))
    for cause in ("java.net.SocketTimeoutException: Read timed out", "org.apache.hadoop.hdfs.BlockMissingException: Could not obtain block", "java.net.ConnectException"):
        assert not judge.is_read_error(RuntimeError(f"{broken}\n\tat a.b.C(D.scala:1)\nCaused by: {cause}\n\tat x.y.Z(W.java:2)"), ["file:/in/x.csv"])
        hidden = RuntimeError(broken)  # the causes are in the trace only
        hidden._stackTrace = f"org.apache.spark.SparkException: {broken}\nCaused by: {cause}"
        assert not judge.is_read_error(hidden, ["file:/in/x.csv"])
    named = RuntimeError(broken.replace("x.csv", "SocketTimeoutException.csv"))
    assert judge.is_read_error(named)
    assert judge.is_read_error(RuntimeError("java.io.EOFException: file:/in/x.csv"), ["file:/in/x.csv"])


def test_corrupt_file_beside_its_namesake(spark, tmp_path, accounts, options):
    text = rows_of(accounts)
    (tmp_path / "x.csv").write_text(text)
    (tmp_path / "x.csv.gz").write_bytes(gzip.compress(text.encode() * 50)[:-40])
    config = profiles(spark, ["x.csv", "x.csv.gz"])
    done = []

    def run(df):
        path = os.path.join(str(tmp_path), f".staged{len(done)}")
        done.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    listing = src.list_landing(spark, str(tmp_path))
    judged = judge.judge_landing(spark, listing, config, judge.Rulebook.bank(options), run)
    assert {r.file_name: r.validation_flag for r in judged.collect()} == {"x.csv": "2", "x.csv.gz": "30"}


@pytest.mark.parametrize("per_range", [10, 1_000_000])
def test_ids_follow_the_order_at_every_size(spark, monkeypatch, per_range):
    monkeypatch.setattr(ids, "ROWS_PER_BUCKET", per_range)
    new = spark.createDataFrame([(f"p{i:03d}",) for i in range(200)], "path string")
    known = spark.createDataFrame([(7,)], "id long")
    got = ids.with_next_ids(new, known, ["path"]).orderBy("id").collect()
    assert [(r.id, r.path) for r in got] == [(8 + i, f"p{i:03d}") for i in range(200)]


def test_contract_problems_are_those_of_the_compiler(spark):
    rows = [(1, "a", 1, "DECIMAL", "40,2"), (1, "b", 2, "DECIMAL", "12,2"), (1, "c", 3, "DECIMAL", "5,9"), (2, "x", 1, "INT", None), (2, "x", 2, "INT", None)]
    frame = spark.createDataFrame(rows, "file_config_id int, field_name string, field_position int, data_type string, length string")
    got = {(r.file_config_id, r.field_name, r.field_position) for r in constraints.contract_problems(frame).collect()}
    assert got == {(1, "a", 1), (1, "c", 3), (2, "x", 1), (2, "x", 2)}
