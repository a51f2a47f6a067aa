"""Declared constraints of the metadata tables, checked as DataFrame work."""

from __future__ import annotations

from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .. import model


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: number of nulls per column, in one aggregate."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])


def apply_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Fill nulls with column defaults; a default of None changes nothing."""
    filled = {c: v for c, v in defaults.items() if v is not None and c in df.columns}
    return df.select(
        *[F.coalesce(F.col(f"`{c}`"), F.lit(filled[c])).alias(c) if c in filled else F.col(f"`{c}`") for c in df.columns]
    )


# Declared widths, (column, least, most) characters.
PROFILE_WIDTHS = [
    ("file_format", 0, 50),
    ("path", 0, 500),
    ("file_name", 0, 255),
    ("delimiter", 1, 1),
    ("quote_char", 1, 1),
    ("escape_char", 1, 1),
    ("date_format", 0, 50),
    ("timestamp_format", 0, 50),
    ("partition_columns", 0, 255),
]


def profile_problems(profiles: DataFrame) -> DataFrame:
    """Profiles whose values do not fit the declared widths: id, column_name, value."""
    hits = [
        F.when(
            ~F.length(c).between(least, most),
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")),
        )
        for c, least, most in PROFILE_WIDTHS
    ]
    return profiles.select("id", F.explode(F.array_compact(F.array(*hits))).alias("p")).select("id", "p.column_name", "p.value")


# Steps of the typing phase in order, (step, flag, message).
STEPS = [(1, "35", model.MSG_TYPE), (2, "36", model.MSG_NULL), (3, "37", model.MSG_LENGTH), (4, "38", model.MSG_TEXT)]


def contract_plan(semantic_layer: DataFrame) -> DataFrame:
    """Which checks each contract row asks for, as a long table ordered by (step, field_position).

    Columns: file_config_id, step, field_position, field_name, flag, message, parameter.
    ``parameter`` is the decimal's precision and scale, the maximum length, or null.
    """
    t = F.lower("data_type")
    is_decimal = t.startswith("decimal")
    converted = t.startswith("int") | t.startswith("bigint") | is_decimal | t.isin("date", "timestamp")
    sized = (t.startswith("char") | t.startswith("varchar")) & F.col("length").rlike("^[0-9]+$")
    textual = ~(
        t.startswith("int") | t.startswith("bigint") | is_decimal | t.startswith("date") | t.startswith("timestamp")
    )
    asked = {
        1: (converted, F.when(is_decimal, F.col("length"))),
        2: (~F.col("nullable"), F.lit(None).cast("string")),
        3: (sized, F.col("length")),
        4: (textual, F.lit(None).cast("string")),
    }
    checks = F.array(
        *[
            F.when(
                asked[step][0],
                F.struct(
                    F.lit(step).alias("step"), F.lit(flag).alias("flag"),
                    F.lit(message).alias("message"), asked[step][1].alias("parameter"),
                ),
            )
            for step, flag, message in STEPS
        ]
    )
    exploded = semantic_layer.select(
        "file_config_id", "field_position", "field_name", F.explode(F.array_compact(checks)).alias("c")
    )
    return exploded.select("file_config_id", "field_position", "field_name", "c.*").orderBy(
        "file_config_id", "step", "field_position", "field_name"
    )


def contract_problems(semantic_layer: DataFrame) -> DataFrame:
    """Contract rows that ``model.check_contract`` rejects: decimals without a valid 'precision,scale' (1 to 38
    digits, scale within them), and names or positions repeated within a file's contract."""
    precision, scale = (F.trim(F.split_part("length", F.lit(","), F.lit(i))) for i in (1, 2))
    numbers = F.col("length").rlike("^ *[0-9]+ *, *[0-9]+ *$")
    p, s = (x.try_cast("decimal(38,0)") for x in (precision, scale))
    sound = F.coalesce(numbers & p.between(1, 38) & (s <= p), F.lit(False))

    def repeated(column: str):
        return F.count(F.lit(1)).over(Window.partitionBy("file_config_id", column)) > 1

    marked = semantic_layer.withColumns({"__name": repeated("field_name"), "__position": repeated("field_position")})
    bad = F.lower("data_type").startswith("decimal") & ~sound
    return marked.filter(bad | F.col("__name") | F.col("__position")).drop("__name", "__position")


