"""Checking SQL for the cascade: every rule as its own max(), the way one would run them one by one."""

from __future__ import annotations

from .. import model
from . import fixtures as fx

INT_TEXT = "'[+-]?([0-9]+([.][0-9]*)?|[.][0-9]*)'"


def integer(c: str, kind: str = "INTEGER") -> str:
    """Integer part of text, null when it is no number."""
    part = f"regexp_extract(trim({c}), '^([+-]?[0-9]*)', 1)"
    return (
        f"CASE WHEN regexp_full_match(trim({c}), {INT_TEXT}) THEN "
        f"CASE WHEN {part} IN ('','+','-') THEN 0 ELSE TRY_CAST({part} AS {kind}) END END"
    )


def iso_date(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST({c} AS DATE) END"


def iso_timestamp(c: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') "
        f"THEN TRY_CAST({c} AS TIMESTAMP) END"
    )


def typed(f: model.Field) -> str:
    t = f.data_type.lower()
    if t.startswith("int"):
        return integer(f.field_name)
    if t.startswith("decimal"):
        return f"TRY_CAST({f.field_name} AS DECIMAL({f.length}))"
    return iso_date(f.field_name) if t == "date" else iso_timestamp(f.field_name)


def _v(name: str) -> str:
    return typed(next(f for f in model.BANK_ACCOUNTS if f.field_name == name))


# violation of each business rule, on text columns
BUSINESS = {
    "40": "NOT regexp_full_match(account_number, '[A-Za-z0-9]{10}')",
    "41": f"({_v('credit_score')}) NOT BETWEEN 300 AND 850",
    "42": f"({_v('risk_score')}) NOT BETWEEN 0 AND 100",
    # eighteen years before the judging date, itself the first of a month
    "43": f"({_v('date_of_birth')}) > DATE '2006-01-01'",
    "44": f"status = 'Active' AND ({_v('balance')}) < 0",
    "45": f"status = 'Closed' AND ({_v('balance')}) <> 0",
    "46": f"account_type = 'Checking' AND ({_v('interest_rate')}) <> 0",
    "47": f"({_v('overdraft_limit')}) < 0 OR (({_v('overdraft_limit')}) > 0 AND status <> 'Active')",
    "48": f"is_joint_account = 'Yes' AND ({_v('num_transactions')}) < 2",
    "49": f"({_v('num_transactions')}) = 0 AND ({_v('avg_transaction_amount')}) <> 0",
}

UNESCAPED_QUOTE = r"""regexp_matches({c}, '(^|[^\\])"')"""


def bad_text(c: str) -> str:
    return f"(contains({c}, ',') OR {UNESCAPED_QUOTE.format(c=c)})"


def rules() -> list[tuple[str, str, str, str, str]]:
    """(flag, phase, field, message, condition on a row) in verdict order; the key rule tests ``n_key``."""
    b = model.BANK_ACCOUNTS
    converted = [f for f in b if f.data_type in ("INT", "DECIMAL", "DATE", "TIMESTAMP")]
    texts = [f for f in b if f.data_type in ("CHAR", "VARCHAR")]
    out = [("35", "typing", f.field_name, model.MSG_TYPE, f"{f.field_name} IS NOT NULL AND ({typed(f)}) IS NULL") for f in converted]
    out += [("36", "typing", f.field_name, model.MSG_NULL, f"{f.field_name} IS NULL") for f in b]
    out += [("37", "typing", f.field_name, model.MSG_LENGTH, f"length({f.field_name}) > {f.length}") for f in texts]
    out += [("38", "typing", f.field_name, model.MSG_TEXT, bad_text(f.field_name)) for f in texts]
    out += [("39", "key", "account_number", model.MSG_DUPLICATE, "n_key > 1")]
    out += [(r.flag, "functional", r.field, r.message, BUSINESS[r.flag]) for r in model.BANK_RULES]
    return out


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def per_file(source: str, by: str) -> str:
    """CTEs ``f`` (one row per file, a 0/1 column r<i> per rule, n_rows) over ``source``."""
    part = f"{by}, account_number" if by else "account_number"
    hits = ", ".join(f"max(CASE WHEN {c} THEN 1 ELSE 0 END) AS r{i}" for i, (*_, c) in enumerate(rules()))
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return (
        f"WITH a AS ({fx.duck(source)}), k AS (SELECT *, count(*) OVER (PARTITION BY {part}) AS n_key FROM a), "
        f"f AS (SELECT {lead}{hits}, count(*) AS n_rows FROM k{group})"
    )


def first(column: int, phases: tuple[str, ...] = ("typing", "key", "functional"), otherwise: str = "NULL") -> str:
    """CASE over the r<i>: attribute ``column`` (0 flag, 2 field, 3 message) of the first violated rule."""
    whens = " ".join(f"WHEN r{i} = 1 THEN {text(r[column])}" for i, r in enumerate(rules()) if r[1] in phases)
    return f"CASE {whens} ELSE {otherwise} END"


def verdict(source: str, by: str) -> str:
    return (
        f"{per_file(source, by)} SELECT {by}, {first(0, otherwise=text('2'))} AS validation_flag, "
        f"{first(3)} AS error_message, {first(2)} AS field_name, n_rows FROM f"
    )
