"""The cascade: each rule, order, naive equivalence, reports."""

import random

import pytest
from pyspark.sql import functions as F

from dropgate import model
from dropgate.operators import rules as R
from dropgate.plans import verdict as V
from dropgate.suite import fixtures as fx
from conftest import SF

NAMES = fx.ACCOUNT_COLUMNS
SCHEMA = ", ".join(f"{n} string" for n in NAMES)


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], SCHEMA)


def judge(spark, rows, options):
    r = V.file_verdicts(frame(spark, rows), options=options).first()
    return r.validation_flag, r.field_name


def changed(accounts, **over):
    return [dict(accounts[0], **over), *accounts[1:]]


@pytest.mark.parametrize(
    "over,want",
    [
        ({}, ("2", None)),
        ({"credit_score": "7x0"}, ("35", "credit_score")),
        ({"credit_score": "700.9"}, ("2", None)),
        ({"date_of_birth": "2020-02-30"}, ("35", "date_of_birth")),
        ({"first_name": None}, ("36", "first_name")),
        ({"country": "x" * 50}, ("2", None)),
        ({"country": "x" * 51}, ("37", "country")),
        ({"address": "a,b"}, ("38", "address")),
        ({"address": 'a"b'}, ("38", "address")),
        ({"address": 'a\\"b'}, ("2", None)),
        ({"account_number": "BAD-000001"}, ("40", "account_number")),
        ({"credit_score": "850"}, ("2", None)),
        ({"credit_score": "851"}, ("41", "credit_score")),
        ({"risk_score": "100.01"}, ("42", "risk_score")),
        ({"date_of_birth": "2006-01-01"}, ("2", None)),
        ({"date_of_birth": "2006-01-02"}, ("43", "date_of_birth")),
        ({"status": "Active", "balance": "-0.50"}, ("44", "balance")),
        ({"status": "Closed", "balance": "0.40", "overdraft_limit": "0.00"}, ("45", "balance")),
        ({"account_type": "Checking", "interest_rate": "0.75"}, ("46", "interest_rate")),
        ({"overdraft_limit": "-1.00"}, ("47", "overdraft_limit")),
        ({"overdraft_limit": "1.00", "status": "Suspended"}, ("47", "overdraft_limit")),
        ({"is_joint_account": "Yes", "num_transactions": "1"}, ("48", "num_transactions")),
        ({"is_joint_account": "No", "num_transactions": "0", "avg_transaction_amount": "3.25"}, ("49", "avg_transaction_amount")),
        # the earlier check wins, whatever the column order
        ({"credit_score": "x", "first_name": None}, ("35", "credit_score")),
        ({"risk_score": "x", "credit_score": "x"}, ("35", "credit_score")),
        ({"overdraft_limit": "-1.00", "first_name": None, "country": "x" * 51}, ("36", "first_name")),
    ],
)
def test_each_rule(spark, accounts, options, over, want):
    assert judge(spark, changed(accounts, **over), options) == want


def test_duplicates_come_between_typing_and_business(spark, accounts, options):
    double = accounts + [dict(accounts[3])]
    assert judge(spark, double, options) == ("39", "account_number")
    double[0] = dict(double[0], credit_score="900")
    assert judge(spark, double, options) == ("39", "account_number")
    double[1] = dict(double[1], email=None)
    assert judge(spark, double, options) == ("36", "email")


def test_empty_frame(spark, options):
    assert judge(spark, [], options) == ("34", None)


def test_truncate_mode(spark, accounts, options):
    from dataclasses import replace

    loose = replace(options, compare="truncate")
    for over in (
        {"status": "Active", "balance": "-0.50"},
        {"status": "Closed", "balance": "0.40", "overdraft_limit": "0.00"},
        {"account_type": "Checking", "interest_rate": "0.75"},
        {"credit_score": "850.9"},
    ):
        assert judge(spark, changed(accounts, **over), loose) == ("2", None)
    assert judge(spark, changed(accounts, status="Active", balance="-1.50"), loose) == ("44", "balance")
    assert judge(spark, changed(accounts, credit_score="700.9"), replace(options, strict_int=True)) == ("35", "credit_score")


def test_decimal_mark_is_opt_in(spark, accounts, options):
    from dataclasses import replace

    rows = changed(accounts, balance="0,00", status="Suspended", overdraft_limit="0.00")
    assert judge(spark, rows, options) == ("35", "balance")
    assert judge(spark, rows, replace(options, use_decimal_symbol=True)) == ("2", None)


def test_key_of_several_columns_and_no_key(spark, options):
    contract = [model.Field(1, "a", "VARCHAR", "5", pk=True), model.Field(2, "b", "VARCHAR", "5", pk=True), model.Field(3, "c", "INT")]
    df = spark.createDataFrame([("x", None, "1"), (None, "x", "1"), ("x", "y", "2")], "a string, b string, c string")
    assert V.file_verdicts(df, contract, [], options=options).first().validation_flag == "2"
    again = df.unionByName(df.limit(1))
    row = V.file_verdicts(df.unionByName(df.filter("b = 'y'")), contract, [], options=options).first()
    assert (row.validation_flag, row.field_name) == ("39", "a,b")
    free = [model.Field(f.field_position, f.field_name, f.data_type, f.length) for f in contract]
    assert V.file_verdicts(again, free, [], options=options).first().validation_flag == "2"


def test_own_rules_on_another_table(spark, options):
    contract = [model.Field(1, "o_orderkey", "BIGINT", pk=True), model.Field(2, "o_totalprice", "DECIMAL", "12,2")]
    rules = [model.BusinessRule("40", "o_totalprice", "too dear", "o_totalprice > 400000")]
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    row = V.file_verdicts(orders, contract, rules, options=options).first()
    assert (row.validation_flag, row.field_name) == ("40", "o_totalprice")


def naive(df, options):
    """Run the rules one at a time, in order, as separate jobs."""
    contract, profile = model.BANK_ACCOUNTS, model.Profile()
    business = R.business_frame(df, contract, profile, options).cache()
    for r in R.cascade(contract, profile, model.BANK_RULES, options):
        if r.phase == "structural":
            continue
        if r.phase == "key":
            bad = df.groupBy("account_number").count().filter("count > 1").limit(1).count() > 0
        else:
            bad = (business if r.phase == "functional" else df).filter(r.condition).limit(1).count() > 0
        if bad:
            return r.flag, r.field
    return "2", None


def test_equals_naive_evaluation(spark, accounts, options):
    rng = random.Random(7)
    classes = {
        "credit_score": ["7x0", "900", None], "balance": ["1,5", "-0.50"], "first_name": [None, "x" * 51, "a,b"],
        "num_transactions": ["0", "1"], "status": ["Active", "Closed"], "account_number": ["0000000009", "BAD-123456"],
        "date_of_birth": ["2020-02-30", "2015-06-15"], "overdraft_limit": ["-1.00"],
    }
    for _ in range(4):
        rows = [dict(a) for a in accounts]
        for _ in range(rng.randint(1, 3)):
            col = rng.choice(list(classes))
            rng.choice(rows)[col] = rng.choice(classes[col])
        df = frame(spark, rows).cache()
        got = V.file_verdicts(df, options=options).first()
        assert (got.validation_flag, got.field_name) == naive(df, options)


def test_jobs_do_not_grow_with_rules(spark, accounts, options):
    def jobs(business):
        tracker, group = spark.sparkContext.statusTracker(), f"g{len(business)}"
        spark.sparkContext.setJobGroup(group, group)
        V.file_verdicts(frame(spark, accounts), business=business, options=options).collect()
        n = len(tracker.getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return n

    assert jobs(model.BANK_RULES[:1]) == jobs(model.BANK_RULES * 4)


def test_one_scan_one_key_shuffle(spark, options):
    plan = V.file_verdicts(fx.files(spark, SF), by=["file_name"], options=options)._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[-1]
    assert "Python" not in final and "SortMergeJoin" not in final
    assert final.count("Exchange hashpartitioning(file_name") == 2


def test_violation_counts_read_once(spark, accounts, options):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]

    source = fx.files(spark, SF)
    own, final = plan(source), plan(V.violation_counts(source, by=["file_name"], options=options))
    for part in ("FileScan", "Join", "Union"):
        assert final.count(part) == own.count(part)
    assert final.count("Exchange hashpartitioning(file_name") == 2
    rows = accounts + [dict(accounts[0], first_name=None), dict(accounts[0], overdraft_limit="-1.00"), dict(accounts[1])]
    df = frame(spark, rows)
    got = {(r.flag, r.field_name): r.n_rows for r in V.violation_counts(df, options=options).collect()}
    split = V.split_rows(df, options=options).selectExpr("explode(flags) AS flag").groupBy("flag").count().collect()
    assert got == {("36", "first_name"): 1, ("39", "account_number"): 5, ("47", "overdraft_limit"): 1}
    assert {r.flag: r["count"] for r in split} == {"36": 1, "39": 5, "47": 1}


def test_split_rows(spark, accounts, options):
    rows = accounts + [dict(accounts[0], first_name=None, overdraft_limit="-1.00")]
    split = V.split_rows(frame(spark, rows), options=options)
    assert split.count() == len(rows)
    bad = {tuple(r.flags): r.first_name for r in V.quarantined(split).collect()}
    assert set(bad) == {("39",), ("36", "39", "47")}
    good = V.accepted(split)
    assert good.count() == len(rows) - 2 and good.columns == NAMES


def test_split_is_written_once(spark, accounts, options, tmp_path):
    from dropgate.sinks import writers

    rows = accounts + [dict(accounts[0], first_name=None)]
    split = V.split_rows(frame(spark, rows), options=options)
    writers.write_split(split, f"{tmp_path}/t")
    back = spark.read.parquet(f"{tmp_path}/t")
    assert {r.outcome: r["count"] for r in back.groupBy("outcome").count().collect()} == {"accepted": len(rows) - 2, "quarantined": 2}
    assert back.filter("outcome = 'accepted' AND size(flags) > 0").isEmpty()
    with pytest.raises(ValueError, match="outcome"):
        writers.write_split(split.withColumn("outcome", F.lit(1)), f"{tmp_path}/u")


def test_hot_key_rows_are_all_quarantined(spark, accounts, options):
    rows = [dict(accounts[0]) for _ in range(300)] + accounts[1:]
    split = V.split_rows(frame(spark, rows), options=options)
    assert V.quarantined(split).count() == 300
    counts = V.violation_counts(frame(spark, rows), options=options).collect()
    assert [(r.flag, r.n_rows) for r in counts] == [("39", 300)]


def test_phases_are_judged_alone(spark, accounts, options):
    rows = changed(accounts, first_name=None, overdraft_limit="-1.00")
    got = {r.phase: (r.flag, r.ok, r.field_name) for r in V.phase_verdicts(frame(spark, rows), options=options).collect()}
    assert got == {
        "structural": ("1.13", True, None), "typing": ("36", False, "first_name"),
        "key": ("1.31", True, None), "functional": ("47", False, "overdraft_limit"),
    }


def test_contract_is_checked_first(spark, accounts):
    with pytest.raises(ValueError, match="precision,scale"):
        R.cascade([model.Field(1, "x", "DECIMAL", None)], model.Profile(), [])
    with pytest.raises(ValueError, match="repeated"):
        R.cascade([model.Field(1, "x", "INT"), model.Field(1, "y", "INT")], model.Profile(), [])
