"""The written landing: what travels, what is found once, what the files hold."""

import os

import pytest

from dropgate.suite import fixtures as fx, landing

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp"
CUSTOMERS = "c_custkey long, c_name string, c_nationkey long, c_mktsegment string, c_acctbal double"


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Orders of all scenarios in two blocks of uploads; some twice, without key or without customer."""
    import datetime

    path, day = str(tmp_path_factory.mktemp("landed")), datetime.datetime(2020, 1, 2)
    keys = [*range(0, 1400, 3), *range(28_000_000, 28_000_020), 45, 45, None, None]
    orders = [(k, i % 7, "OFP"[i % 3], 1.0, day) for i, k in enumerate(keys)]
    spark.createDataFrame(orders, ORDERS).repartition(5).write.parquet(f"{path}/orders.parquet")
    segments = ["AUTOMOBILE", "BUILDING", None]
    customers = [(i, f"Customer#{i}", i % 3, segments[i % 3], i * 1.5) for i in range(6)]
    spark.createDataFrame(customers, CUSTOMERS).write.parquet(f"{path}/customer.parquet")
    spark.createDataFrame([(0,)], "n_nationkey long").write.parquet(f"{path}/nation.parquet")
    return path


def _expected(spark, sf):
    """The lines of every upload from the accounts as the SQL has them."""
    names, files = fx.ACCOUNT_COLUMNS, {}
    rows = [r.asDict() for r in fx.frame(spark, sf, landing.UPLOADS).collect() if r.upload is not None]
    for r in sorted(rows, key=lambda r: r["order_key"]):
        s = r["upload"] % landing.N_SCENARIOS
        head = [names[0], names[2], names[1], *names[3:]] if s == landing.HEADER else names
        sep = ";" if s == landing.SEPARATOR else ","
        lines = files.setdefault(r["upload"], [] if s == landing.NO_HEADER else [sep.join(head)])
        if s != landing.EMPTY:
            cells = [f'"{c}"' if "," in c else c for c in (r[n] or "" for n in names)]
            lines.append(sep.join(cells[:-1] if s == landing.WIDTH and r["order_key"] // 14 % 31 == 3 else cells))
    return files


def test_every_upload_is_one_file_with_its_header_first(spark, sf):
    folder, got = landing.directory(spark, sf), {}
    for d, _, files in os.walk(folder.removeprefix("file:")):
        for f in (f for f in files if f.endswith(".txt")):
            upload = int(d.rsplit("upload=", 1)[1])
            assert upload not in got
            got[upload] = open(f"{d}/{f}").read().split("\n")[:-1]
    want = _expected(spark, sf)
    assert got.keys() == want.keys() and len(got) > landing.N_SCENARIOS
    for upload, lines in got.items():
        assert lines[:1] == want[upload][:1] and sorted(lines) == sorted(want[upload])
        keys = [x.replace(";", ",").split(",")[0] for x in lines[1:]]
        assert upload % landing.N_SCENARIOS == landing.KEY or keys == sorted(keys)


def test_orders_travel_to_their_files_not_lines(spark, sf):
    """The text of thirty columns is made after the rows are dealt and sorted."""
    plan = landing.lines(spark, sf)._jdf.queryExecution().executedPlan().toString()
    made, dealt = plan.index("concat_ws("), plan.index("REPARTITION_BY_NUM")
    assert made < dealt and "concat_ws(" not in plan[dealt:] and "Street" not in plan[dealt:]


def test_profiles_are_found_without_reading_the_orders_again(spark, sf):
    """Every batch of the stream asks for them."""
    plan = landing.configuration(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "orders.parquet" not in plan
    got = [r.id for r in landing.configuration(spark, sf).collect()]
    assert sorted(got) == sorted(u + 1 for u in _expected(spark, sf) if u % landing.N_SCENARIOS != landing.UNCONFIGURED)
