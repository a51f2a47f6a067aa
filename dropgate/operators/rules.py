"""Rules: a contract and a list of business rules compiled to ordered boolean SQL conditions.

A rule's place in the list is its priority in the verdict cascade.  Contract checks are SQL text over
the raw columns; business rules are SQL over the same names in the declared types.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .. import model
from ..functions import casts, text
from ..functions.casts import literal, name

CORRUPT = "__corrupt"


@dataclass(frozen=True)
class Rule:
    flag: str
    phase: str
    field: str | None
    message: str
    # SQL, true where a row breaks the rule; None: decided per file
    condition: str | None = None


@dataclass(frozen=True)
class Options:
    """Choices of the judge; the defaults follow the documented rules, the others the older behaviour."""

    as_of: datetime.date | None = None  # None: current_date()
    compare: str = "typed"  # or "truncate": business rules see text numbers cut to integers
    strict_int: bool = False  # True: a fraction in an INT column is an invalid type
    row_width: bool = True  # False: flag 34 only for files without rows
    header_compat: bool = False  # True: a file without header fails 33, a one-column file fails 32
    use_decimal_symbol: bool = False  # True: the contract's decimal mark is accepted


def raw(f: model.Field) -> str:
    return name(f.field_name)


def as_of_column(options: Options) -> str:
    return "current_date()" if options.as_of is None else f"DATE'{options.as_of.isoformat()}'"


def types_of(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


TEXT = T.StringType()


def converted(
    f: model.Field, profile: model.Profile, options: Options = Options(), source_type: T.DataType = TEXT
) -> str:
    """The column in its declared type."""
    return casts.declared_value(
        f, raw(f), profile.date_format, profile.timestamp_format, source_type, options.strict_int, options.use_decimal_symbol
    )


def business_values(
    contract: Sequence[model.Field], profile: model.Profile, options: Options, types: dict[str, T.DataType]
) -> list[str]:
    """What business rules see under the contract's names, and ``__as_of``: values in the declared type.

    In ``truncate`` mode numbers in text compare as integers, as text against an integer literal did
    in non-ANSI Spark.
    """
    out = [f"{as_of_column(options)} AS __as_of"]
    for f in contract:
        source = types.get(f.field_name, TEXT)
        number = casts.type_class(f.data_type) in ("int", "bigint", "decimal")
        if options.compare == "truncate" and number and isinstance(source, T.StringType):
            out.append(f"{casts.lenient_integer(raw(f))} AS {raw(f)}")
        elif casts.type_class(f.data_type):
            out.append(f"{converted(f, profile, options, source)} AS {raw(f)}")
        else:
            out.append(raw(f))
    return out


def business_frame(
    df: DataFrame,
    contract: Sequence[model.Field],
    profile: model.Profile = model.Profile(),
    options: Options = Options(),
    keep: Sequence[str] = (),
) -> DataFrame:
    """``keep`` (SQL) + the frame business rules are evaluated on."""
    return df.selectExpr(*keep, *business_values(contract, profile, options, types_of(df)))


def _text_of(f: model.Field) -> str:
    return f"CAST({raw(f)} AS STRING)"


def type_rule(f: model.Field, profile: model.Profile, options: Options, source_type: T.DataType) -> Rule:
    invalid = f"{raw(f)} IS NOT NULL AND {converted(f, profile, options, source_type)} IS NULL"
    return Rule("35", "typing", f.field_name, model.MSG_TYPE, invalid)


def null_rule(f: model.Field) -> Rule:
    return Rule("36", "typing", f.field_name, model.MSG_NULL, f"{raw(f)} IS NULL")


def length_rule(f: model.Field) -> Rule:
    return Rule("37", "typing", f.field_name, model.MSG_LENGTH, f"length({_text_of(f)}) > {int(f.length)}")


def text_rule(f: model.Field, profile: model.Profile) -> Rule:
    bad = text.bad_text(_text_of(f), profile.delimiter, profile.quote_char, profile.escape_char)
    return Rule("38", "typing", f.field_name, model.MSG_TEXT, bad)


def business_rule(r: model.BusinessRule) -> Rule:
    # the judging date is the frame's column __as_of
    return Rule(r.flag, "functional", r.field, r.message, r.violation.replace(":as_of", "__as_of"))


def is_sized_text(f: model.Field) -> bool:
    return f.data_type.lower().startswith(("char", "varchar")) and bool(f.length) and f.length.isdigit()


def structural_rules() -> list[Rule]:
    return [
        Rule("32", "structural", None, model.MSG_DELIMITER),
        Rule("33", "structural", None, model.MSG_HEADER),
        Rule("34", "structural", None, model.MSG_COLUMN_COUNT),
    ]


def typing_rules(
    contract: Sequence[model.Field],
    profile: model.Profile,
    options: Options = Options(),
    types: dict[str, T.DataType] | None = None,
) -> list[Rule]:
    """Step by step, and within a step by field position.  ``types``: column types of the data, default text."""
    types = types or {}
    return (
        [type_rule(f, profile, options, types.get(f.field_name, TEXT)) for f in contract if casts.type_class(f.data_type)]
        + [null_rule(f) for f in contract if not f.nullable]
        + [length_rule(f) for f in contract if is_sized_text(f)]
        + [text_rule(f, profile) for f in contract if casts.is_text_class(f.data_type)]
    )


def key_rule(contract: Sequence[model.Field]) -> Rule:
    return Rule("39", "key", ",".join(key_fields(contract)), model.MSG_DUPLICATE)


def key_fields(contract: Sequence[model.Field]) -> list[str]:
    return [f.field_name for f in contract if f.pk]


def business_rules(rules: Sequence[model.BusinessRule]) -> list[Rule]:
    return [business_rule(r) for r in rules]


def cascade(
    contract: Sequence[model.Field],
    profile: model.Profile,
    rules: Sequence[model.BusinessRule],
    options: Options = Options(),
    types: dict[str, T.DataType] | None = None,
) -> list[Rule]:
    """All rules in verdict order."""
    contract = sorted(model.check_contract(list(contract)), key=lambda f: f.field_position)
    return structural_rules() + typing_rules(contract, profile, options, types) + [key_rule(contract)] + business_rules(rules)


def first_violation(rules: Sequence[Rule], phases: Sequence[str], after: str | None = None) -> str:
    """Index of the first violated row rule of these phases, null when the row is clean.

    One CASE: evaluation stops at the first hit (``after`` is an earlier one), and a null condition is
    no violation.
    """
    whens = [f"WHEN {after} IS NOT NULL THEN {after}"] if after else []
    whens += [f"WHEN {r.condition} THEN {i}" for i, r in enumerate(rules) if r.condition and r.phase in phases]
    return f"CASE {' '.join(whens)} END" if whens else "CAST(NULL AS INT)"


def all_violations(rules: Sequence[Rule], phases: Sequence[str] = model.PHASES) -> str:
    """Indexes of every violated row rule, ascending; empty when the row is clean."""
    hits = [f"CASE WHEN {r.condition} THEN {i} END" for i, r in enumerate(rules) if r.condition and r.phase in phases]
    return f"array_compact(array({', '.join(hits)}))" if hits else "CAST(array() AS ARRAY<INT>)"


def rule_attribute(rules: Sequence[Rule], attribute: str, index: str) -> str:
    """An attribute (flag, field, message) of a rule index, as a lookup in a constant array."""
    return f"get(array({', '.join(literal(getattr(r, attribute)) for r in rules)}), {index})"
