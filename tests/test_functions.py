"""Conversions and text predicates: pass, fail, null, boundary, malformed."""

import pytest
from pyspark.sql import functions as F, types as T

from dropgate.functions import casts, text
from dropgate.model import Field


def evaluate(spark, values, sql):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").selectExpr(f"CAST({sql} AS STRING)").collect()]


def test_lenient_integer(spark):
    values = ["7", " 7 ", "+7", "-7", "12.9", "12.", ".5", "-.5", "-0.5", ".", "+.", "-", "+", "", " ", None, "1e2", "1.2.3",
              "2147483647", "2147483648", "2147483648.5", "1,5", "abc"]
    want = ["7", "7", "7", "-7", "12", "12", "0", "0", "0", "0", "0", None, None, None, None, None, None, None,
            "2147483647", None, None, None, None]
    assert evaluate(spark, values, casts.lenient_integer("c")) == want


def test_strict_integer_rejects_fractions(spark):
    assert evaluate(spark, ["7", "12.9", None], casts.lenient_integer("c", strict=True)) == ["7", None, None]


def test_decimal(spark):
    values = ["12345.678", "0.005", "1,5", "1234567.1", "1e2", "-3.25", None, ""]
    want = ["12345.68", "0.01", None, None, "100.00", "-3.25", None, None]
    assert evaluate(spark, values, casts.decimal("c", 8, 2)) == want
    assert evaluate(spark, ["1,5"], casts.decimal("c", 8, 2, ",")) == ["1.50"]


def test_dates(spark):
    values = ["2020-02-29", "2020-02-30", "2020-1-5", "0000-01-01", "2020-01-05x", " 2020-01-05", "+2020-01-05", "05/01/2020", None,
              "+12020-01-05", "12020-01-05", "-2020-01-05", "2020-01-05 ", "2020-01-05\n", "20200105", ""]
    fast = evaluate(spark, values, casts.date("c", "yyyy-MM-dd"))
    assert fast == evaluate(spark, values, "try_to_date(c, 'yyyy-MM-dd')")
    assert fast[0] == "2020-02-29" and fast[1] is None and fast[2] is None
    assert evaluate(spark, values, casts.date("c", "dd/MM/yyyy"))[7] == "2020-01-05"
    assert evaluate(spark, values, casts.date("c", None)) == [None] * len(values)


def test_timestamps(spark):
    values = ["2020-01-05 10:15:00", "2020-01-05 24:00:00", "2020-01-05 10:15:60", "2020-01-05", "2020-01-05T10:15:00",
              "2020-01-05 10:15:00.5", "2020-13-05 10:15:00", None, "+12020-01-05 10:15:00", " 2020-01-05 10:15:00", "2020-01-05 10:15:00\n"]
    fast = evaluate(spark, values, casts.timestamp("c", "yyyy-MM-dd HH:mm:ss"))
    assert fast == evaluate(spark, values, "try_to_timestamp(c, 'yyyy-MM-dd HH:mm:ss')")
    assert [v is not None for v in fast][:8] == [True] + [False] * 7
    assert evaluate(spark, ["1704067200000", "x", "1.5"], casts.timestamp("c", "epoch_millis")) == ["2024-01-01 00:00:00", None, None]


@pytest.mark.parametrize(
    "declared,kind,is_text",
    [("INT", "int", False), ("integer", "int", False), ("interval", "int", False), ("BIGINT", "bigint", False),
     ("Decimal", "decimal", False), ("DATE", "date", False), ("datetime", None, False), ("timestamptz", None, False),
     ("TIMESTAMP", "timestamp", False), ("boolean", None, True), ("VARCHAR", None, True), ("double", None, True)],
)
def test_type_classes(declared, kind, is_text):
    assert casts.type_class(declared) == kind
    assert casts.is_text_class(declared) == is_text


@pytest.mark.parametrize(
    "declared,source,value,valid",
    [("INT", T.LongType(), "cast(5000000000 as bigint)", True), ("INT", T.DoubleType(), "cast(1.5 as double)", True),
     ("INT", T.DateType(), "date'2020-01-01'", False), ("DATE", T.TimestampType(), "timestamp'2020-01-01 00:00:00'", True),
     ("DATE", T.LongType(), "cast(1 as bigint)", False), ("DECIMAL", T.DoubleType(), "cast(1e9 as double)", False),
     ("DECIMAL", T.BooleanType(), "true", True), ("TIMESTAMP", T.BooleanType(), "true", False)],
)
def test_conversion_of_typed_columns(spark, declared, source, value, valid):
    f = Field(1, "c", declared, "8,2")
    sql = casts.declared_value(f, "c", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", source)
    got = spark.sql(f"SELECT {value} AS c").selectExpr(f"{sql} IS NOT NULL").first()[0]
    assert got == valid


def test_unescaped_quote(spark):
    values = ['a"b', 'a\\"b', "plain", '"', None]
    sql = text.unescaped_quote("c", '"', "\\")
    assert evaluate(spark, values, sql) == ["true", "false", "false", "true", None]
    assert evaluate(spark, values, text.unescaped_quote("c", None, "\\")) == ["false"] * 5
    # letters and pattern characters are taken as they are
    assert evaluate(spark, ["a.b", "axb", "n.b"], text.unescaped_quote("c", ".", "n")) == ["true", "false", "false"]
    assert evaluate(spark, ["it's", "x"], text.bad_text("c", "|", "'", None)) == ["true", "false"]


def test_literal_round_trip(spark):
    for v in ["a'b", "back\\slash", "\t", "§"]:
        assert spark.sql(f"SELECT {casts.literal(v)}").first()[0] == v


def test_extension():
    assert text.extension_of("/x/A.CSV") == "csv"
    assert text.extension_of("a.csv.gz") == "csv"
    assert text.extension_of("part.snappy.parquet") == "parquet"
