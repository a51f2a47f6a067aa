"""Structural checks of raw CSV scans: header, delimiter, row width, emptiness.

The scan delivers headers as rows.  A file's header is its row with the least ``__seq`` in the first
block.  Only a row equal to the expected header can be a correct header, so those are marked
(``__header_like``) and counted apart: one of them is the header, any further one is data.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import model
from ..functions.casts import literal, name
from .rules import CORRUPT, Options

HEADER_OK, HEADER_ONE_COLUMN, HEADER_DIFFERS = 0, 1, 2


def line_marks(
    contract: Sequence[model.Field], profile: model.Profile, options: Options = Options()
) -> dict[str, str]:
    """SQL of the marks of a row of ``sources.files.csv_scan``, by name.

    ``__state`` is what the row would mean as the file's first line, ``__bad_width`` that its number of
    fields is wrong; both ``__seq`` and ``__state`` are null outside the first block.
    """
    names = [f.field_name for f in contract]
    lines_up = " AND ".join([f"{CORRUPT} IS NULL", *[f"{name(n)} <=> {literal(n)}" for n in names]])
    header_like = f"(__first_block AND {lines_up})" if profile.has_header else "false"
    line = CORRUPT
    if profile.quote_char:
        q = re.escape(profile.quote_char)
        line = f"regexp_replace({line}, {literal(f'{q}[^{q}]*{q}')}, '')"
    # a complete row has a delimiter, unless the contract has one column
    one_column = options.header_compat and len(names) == 1
    lone = f"coalesce(NOT contains({line}, {literal(profile.delimiter)}), {str(one_column).lower()})"
    checks = [f"WHEN {header_like} THEN {HEADER_OK}", f"WHEN {lone} THEN {HEADER_ONE_COLUMN}"]
    otherwise = HEADER_DIFFERS if profile.has_header or options.header_compat else HEADER_OK
    state = f"CASE {' '.join(checks[::-1] if one_column else checks)} ELSE {otherwise} END"
    return {
        "__file": "__file",
        "__header_like": header_like,
        # names a data column too: Spark refuses queries on the malformed-line column alone
        "__bad_width": f"({CORRUPT} IS NOT NULL OR coalesce(length({name(names[0])}), 0) < 0)",
        "__seq": "CASE WHEN __first_block THEN __seq END",
        "__state": f"CASE WHEN __first_block THEN {state} END",
    }


def structural_report(
    scan: DataFrame, contract: Sequence[model.Field], profile: model.Profile, options: Options = Options()
) -> DataFrame:
    """Per file: __file, one_column, header_ok, n_rows, n_bad_rows, validation_flag (null = passed)."""
    per_file = (
        scan.selectExpr(*[f"{sql} AS {n}" for n, sql in line_marks(contract, profile, options).items()])
        .groupBy("__file")
        .agg(
            F.min_by("__state", "__seq").alias("state"),
            F.min_by("__bad_width", "__seq").alias("first_bad"),
            F.count(F.lit(1)).alias("n"),
            F.count_if("__bad_width").alias("bad"),
        )
    )
    header_rows = 1 if profile.has_header else 0
    counted = per_file.select(
        "__file",
        (F.col("state") == HEADER_ONE_COLUMN).alias("one_column"),
        (F.col("state") == HEADER_OK).alias("header_ok"),
        (F.col("n") - header_rows).alias("n_rows"),
        (F.col("bad") - F.when(F.col("first_bad"), header_rows).otherwise(0)).alias("n_bad_rows"),
    )
    uneven = (F.col("n_rows") == 0) | (F.lit(options.row_width) & (F.col("n_bad_rows") > 0))
    return counted.withColumn(
        "validation_flag",
        F.when(F.col("one_column"), "32").when(~F.col("header_ok"), "33").when(uneven, "34"),
    )


def parsed_structure(df: DataFrame, contract: Sequence[model.Field]) -> DataFrame:
    """The older checks on an already parsed frame, one row: delimiter, header and emptiness."""
    names = [f.field_name for f in contract]
    flag = "32" if len(df.columns) == 1 and len(names) > 1 else "33" if df.columns != names else None
    if flag:
        return df.limit(1).agg(F.lit(flag).alias("validation_flag"))
    return df.limit(1).agg(F.when(F.count(F.lit(1)) == 0, "34").alias("validation_flag"))
