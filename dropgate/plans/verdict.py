"""The single-pass judge.

Each row gets the index of its first violated rule; a file's verdict is the minimum over its rows.
That equals running the rules one after another, because every rule but the key rule looks at one row.
The key rule rides on the same pass: rows are first grouped by (file, key), which collapses repeats
before the shuffle, and the few values left per group are then reduced per file.
One scan, one shuffle of the keys, one tiny shuffle of per-file partials, whatever the number of rules.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from .. import model
from ..functions.casts import name
from ..operators import rules as R
from ..operators.joins import hot_counted, key_types, skew_left_join
from ..operators.structural import HEADER_DIFFERS, HEADER_ONE_COLUMN, line_marks


def evaluated(
    df: DataFrame,
    contract: Sequence[model.Field],
    profile: model.Profile,
    rules: Sequence[R.Rule],
    options: R.Options,
    keep: Mapping[str, str],
    separate: bool = False,
) -> DataFrame:
    """``keep`` (name -> SQL) + key columns (as ``__k0..``) + ``__rule``, the first violated row rule.

    ``separate`` gives ``__typing`` and ``__functional`` instead.  Two projections: the first checks the raw
    columns and converts what the business rules name, the second evaluates those.  Rows between them
    are narrow, and raw columns are never renamed: Catalyst derives constraints through aliases, and
    renaming thirty columns that share one predicate makes it enumerate every mix of names.
    """
    keys = R.key_fields(contract)
    step = df.selectExpr(
        *[f"{sql} AS {name(n)}" for n, sql in keep.items()],
        *[f"{name(k)} AS __k{i}" for i, k in enumerate(keys)],
        *R.business_values(contract, profile, options, R.types_of(df)),
        f"{R.first_violation(rules, ['typing'])} AS __typing",
    )
    passed = [*[name(n) for n in keep], *[f"__k{i}" for i in range(len(keys))]]
    if separate:
        return step.selectExpr(*passed, "__typing", f"{R.first_violation(rules, ['functional'])} AS __functional")
    return step.selectExpr(*passed, f"{R.first_violation(rules, ['functional'], '__typing')} AS __rule")


def violations(
    df: DataFrame,
    contract: Sequence[model.Field],
    profile: model.Profile,
    rules: Sequence[R.Rule],
    options: R.Options,
    keep: Sequence[str],
    keep_raw: bool = False,
    keys: bool = False,
) -> DataFrame:
    """``keep`` (+ the raw columns, + the key as ``__k0..``) + ``__hits``, the ascending array of all violated row rules.

    Lists are only built for rows with a first violation; clean rows cost no more than in a verdict.
    """
    passed = [name(k) for k in keep]
    names = [f.field_name for f in contract] if keep_raw else []
    named_keys = R.key_fields(contract) if keys else []

    def hits(phase: str) -> str:
        return (
            f"CASE WHEN {R.first_violation(rules, [phase])} IS NOT NULL THEN {R.all_violations(rules, [phase])} "
            "ELSE CAST(array() AS ARRAY<INT>) END"
        )

    step = df.selectExpr(
        *passed,
        *[f"{name(n)} AS {name('__raw_' + n)}" for n in names],
        *[f"{name(k)} AS __k{i}" for i, k in enumerate(named_keys)],
        *R.business_values(contract, profile, options, R.types_of(df)),
        f"{hits('typing')} AS __early",
    )
    return step.selectExpr(
        *passed,
        *[f"{name('__raw_' + n)} AS {name(n)}" for n in names],
        *[f"__k{i}" for i in range(len(named_keys))],
        f"concat(__early, {hits('functional')}) AS __hits",
    )


def _named(columns: Sequence[str]) -> dict[str, str]:
    return {c: name(c) for c in columns}


def _index(rules: Sequence[R.Rule], flag: str) -> int:
    return next(i for i, r in enumerate(rules) if r.flag == flag)


def verdict_columns(rules: Sequence[R.Rule], index: str) -> list[str]:
    """SQL for (validation_flag, error_message, field_name) of a first-violation index; null = passed."""
    return [
        f"coalesce({R.rule_attribute(rules, 'flag', index)}, '{model.PASSED}') AS validation_flag",
        f"{R.rule_attribute(rules, 'message', index)} AS error_message",
        f"{R.rule_attribute(rules, 'field', index)} AS field_name",
    ]


def file_verdicts(
    df: DataFrame,
    contract: Sequence[model.Field] = tuple(model.BANK_ACCOUNTS),
    business: Sequence[model.BusinessRule] = tuple(model.BANK_RULES),
    profile: model.Profile = model.Profile(),
    by: Sequence[str] = (),
    options: R.Options = R.Options(),
) -> DataFrame:
    """One verdict per file of an already parsed frame: ``by`` columns name the file.

    Columns: by.., validation_flag, error_message, field_name, n_rows.  Without ``by`` the frame is one
    file and an empty frame still gets its row (flag 34).
    """
    rules = R.cascade(contract, profile, business, options, R.types_of(df))
    rows = evaluated(df, contract, profile, rules, options, _named(by))
    per_file = _reduce(rows, by, len(R.key_fields(contract)), _index(rules, "39"))
    index = f"least(__rule, CASE WHEN n_rows = 0 THEN {_index(rules, '34')} END)"
    return per_file.selectExpr(*[name(c) for c in by], *verdict_columns(rules, index), "n_rows")


def _reduce(rows: DataFrame, by: Sequence[str], n_keys: int, key_index: int) -> DataFrame:
    keys = [f"__k{i}" for i in range(n_keys)]
    if not keys:
        return rows.groupBy(*by).agg(F.min("__rule").alias("__rule"), F.count(F.lit(1)).alias("n_rows"))
    per_key = rows.groupBy(*by, *keys).agg(F.min("__rule").alias("__rule"), F.count(F.lit(1)).alias("__n"))
    return per_key.groupBy(*by).agg(
        F.min(F.least("__rule", F.when(F.col("__n") > 1, F.lit(key_index)))).alias("__rule"),
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
    )


def csv_verdicts(
    scan: DataFrame,
    contract: Sequence[model.Field],
    business: Sequence[model.BusinessRule],
    profile: model.Profile,
    options: R.Options = R.Options(),
) -> DataFrame:
    """Verdicts of raw CSV files, header and row width included, still in one scan.

    ``scan`` comes from ``sources.files.csv_scan``: contract columns as text, the malformed line in
    ``__corrupt``, ``__file`` (the file's key), ``__first_block`` and ``__seq`` (increasing within a file's block).
    See ``operators.structural`` for how the header is told from the rows.
    Columns: __file, __rule (null = passed), n_rows.
    """
    rules = R.cascade(contract, profile, business, options)
    width_rule, key_index = _index(rules, "34"), _index(rules, "39")

    rows = evaluated(scan, contract, profile, rules, options, line_marks(contract, profile, options))
    if options.row_width:
        rows = rows.withColumn("__rule", F.when(F.col("__bad_width"), F.lit(width_rule)).otherwise(F.col("__rule")))

    keys = [f"__k{i}" for i in range(len(R.key_fields(contract)))]
    per_key = rows.groupBy("__file", *keys).agg(
        F.min(F.when(~F.col("__header_like"), F.col("__rule"))).alias("__rule"),
        F.min(F.when(F.col("__header_like"), F.col("__rule"))).alias("__header_rule"),
        F.count(F.lit(1)).alias("__n"),
        F.count_if("__header_like").alias("__n_header"),
        F.min("__seq").alias("__first_seq"),
        F.min_by("__state", "__seq").alias("__first_state"),
    )
    # all header-like rows share one key, so at most one group of a file counts the header as data
    data_rows = F.col("__n") - F.when(F.col("__n_header") > 0, 1).otherwise(0)
    duplicate = F.when(data_rows > 1, F.lit(key_index)) if keys else F.lit(None).cast("int")
    again = F.when(F.col("__n_header") > 1, F.col("__header_rule"))
    per_file = per_key.groupBy("__file").agg(
        F.min(F.least("__rule", again, duplicate)).alias("__rule"),
        F.sum("__n").alias("__n"),
        F.min_by("__first_state", "__first_seq").alias("__first_state"),
    )
    n_rows = F.col("__n") - (1 if profile.has_header else 0)
    first = F.col("__first_state")
    return per_file.select(
        "__file",
        F.least(
            F.col("__rule"),
            F.when(first == HEADER_ONE_COLUMN, F.lit(_index(rules, "32"))),
            F.when(first == HEADER_DIFFERS, F.lit(_index(rules, "33"))),
            F.when(n_rows <= 0, F.lit(width_rule)),
        ).alias("__rule"),
        n_rows.alias("n_rows"),
    )


def phase_verdicts(
    df: DataFrame,
    contract: Sequence[model.Field] = tuple(model.BANK_ACCOUNTS),
    business: Sequence[model.BusinessRule] = tuple(model.BANK_RULES),
    profile: model.Profile = model.Profile(),
    by: Sequence[str] = (),
    options: R.Options = R.Options(),
) -> DataFrame:
    """Every phase judged on its own: by.., phase, flag, ok, error_message, field_name."""
    rules = R.cascade(contract, profile, business, options, R.types_of(df))
    rows = evaluated(df, contract, profile, rules, options, _named(by), separate=True)
    keys = [f"__k{i}" for i in range(len(R.key_fields(contract)))]
    per_key = rows.groupBy(*by, *keys).agg(
        F.min("__typing").alias("__typing"), F.min("__functional").alias("__functional"), F.count(F.lit(1)).alias("__n")
    )
    repeated = F.col("__n") > 1 if keys else F.lit(False)
    per_file = per_key.groupBy(*by).agg(
        F.min("__typing").alias("typing"),
        F.min(F.when(repeated, F.lit(_index(rules, "39")))).alias("key"),
        F.min("__functional").alias("functional"),
        F.when(F.coalesce(F.sum("__n"), F.lit(0)) == 0, F.lit(_index(rules, "34"))).alias("structural"),
    )
    long = per_file.select(
        *[F.col(f"`{c}`") for c in by],
        F.explode(
            F.array(*[F.struct(F.lit(p).alias("phase"), F.col(p).cast("int").alias("__rule")) for p in model.PHASES])
        ).alias("__p"),
    )
    passed = "CASE __p.phase " + " ".join(f"WHEN '{p}' THEN '{f}'" for p, f in model.PHASE_PASSED.items()) + " END"
    return long.selectExpr(
        *[name(c) for c in by],
        "__p.phase AS phase",
        f"coalesce({R.rule_attribute(rules, 'flag', '__p.__rule')}, {passed}) AS flag",
        "__p.__rule IS NULL AS ok",
        f"{R.rule_attribute(rules, 'message', '__p.__rule')} AS error_message",
        f"{R.rule_attribute(rules, 'field', '__p.__rule')} AS field_name",
    )


def violation_counts(
    df: DataFrame,
    contract: Sequence[model.Field] = tuple(model.BANK_ACCOUNTS),
    business: Sequence[model.BusinessRule] = tuple(model.BANK_RULES),
    profile: model.Profile = model.Profile(),
    by: Sequence[str] = (),
    options: R.Options = R.Options(),
) -> DataFrame:
    """Violating rows per file and rule, not only the first: by.., flag, field_name, error_message, n_rows.

    One scan and one shuffle of the keys: every row gives its key once and each rule it breaks once, without
    the key.  Both are counted map-side, so hits shrink to one row per file and rule and a hot key to one row
    per task.  A key counted more than once adds its rows to rule 39.
    """
    rules = R.cascade(contract, profile, business, options, R.types_of(df))
    keys = R.key_fields(contract)
    key_index = _index(rules, "39")
    rows = violations(df, contract, profile, rules, options, by, keys=True)
    files = [name(c) for c in by]
    if keys:
        key = f"struct({', '.join(f'__k{i}' for i in range(len(keys)))})"
        marks = (
            f"concat(array(struct({key} AS __key, {key_index} AS __rule)), "
            f"transform(__hits, i -> struct(if(false, {key}, NULL) AS __key, i AS __rule)))"
        )
        marked = rows.selectExpr(*files, f"inline({marks})")
        counted = marked.groupBy(*by, "__key", "__rule").agg(F.count(F.lit(1)).alias("__n"))
        counted = counted.filter((F.col("__rule") != key_index) | (F.col("__n") > 1))
        parts = counted.groupBy(*by, "__rule").agg(F.sum("__n").alias("n_rows"))
    else:
        marked = rows.selectExpr(*files, "explode(__hits) AS __rule")
        parts = marked.groupBy(*by, "__rule").agg(F.count(F.lit(1)).alias("n_rows"))
    return parts.selectExpr(
        *[name(c) for c in by],
        f"{R.rule_attribute(rules, 'flag', '__rule')} AS flag",
        f"{R.rule_attribute(rules, 'field', '__rule')} AS field_name",
        f"{R.rule_attribute(rules, 'message', '__rule')} AS error_message",
        "n_rows",
    )


def split_rows(
    df: DataFrame,
    contract: Sequence[model.Field] = tuple(model.BANK_ACCOUNTS),
    business: Sequence[model.BusinessRule] = tuple(model.BANK_RULES),
    profile: model.Profile = model.Profile(),
    by: Sequence[str] = (),
    options: R.Options = R.Options(),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every row with its ``flags``, the distinct violated flags in cascade order (empty = accepted).

    Columns: by.., keep.. (passed through), the contract's columns, flags.

    All rows sharing a key with another row of the file carry 39.  The repeated keys are counted from the
    key columns alone and joined back; those that own many rows are spread by their counts.
    """
    rules = R.cascade(contract, profile, business, options, R.types_of(df))
    labels = [*by, *keep]
    rows = violations(df, contract, profile, rules, options, labels, keep_raw=True)
    names = [f.field_name for f in contract]
    keys = R.key_fields(contract)
    if keys:
        counted = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
        repeated = counted.select(*by, *keys, F.lit(_index(rules, "39")).alias("__dup"))
        hot = hot_counted(counted, key_types(rows, repeated, [*by, *keys]), "__n")
        rows = skew_left_join(rows, repeated, [*by, *keys], hot=hot)
        rows = rows.withColumn(
            "__hits", F.when(F.col("__dup").isNotNull(), F.array_sort(F.array_append("__hits", F.col("__dup")))).otherwise(F.col("__hits"))
        ).drop("__dup")
    flags = f"array_distinct(transform(__hits, i -> {R.rule_attribute(rules, 'flag', 'i')})) AS flags"
    return rows.selectExpr(*[name(c) for c in labels], *[name(n) for n in names], flags)


def quarantined(split: DataFrame) -> DataFrame:
    return split.filter(F.size("flags") > 0)


def accepted(split: DataFrame) -> DataFrame:
    return split.filter(F.size("flags") == 0).drop("flags")
