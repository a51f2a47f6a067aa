"""Conversions to the declared types, as SQL text over a SQL expression.

All yield null on bad input and never raise.  Text keeps a rule set of a hundred conditions cheap to
build: it reaches Spark as a handful of expressions, not as thousands of Column calls.
"""

from __future__ import annotations

from pyspark.sql import types as T

from ..model import Field, precision_scale


def literal(value: str | None) -> str:
    """A SQL string literal."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A quoted column name."""
    return "`" + column.replace("`", "``") + "`"


# A decimal-looking number whose fraction may be dropped: optional sign, digits, point, digits.
_FRACTIONAL = literal(r"^[\x00-\x20]*[+-]?(?=[0-9.])[0-9]*[.][0-9]*[\x00-\x20]*$")
_WHOLE_PART = literal(r"^[\x00-\x20]*([+-]?[0-9]*)")
_ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_ISO_SECONDS = r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def _iso(c: str, shape: str, target: str, formatter: str) -> str:
    """A default pattern: the plain cast on values of exactly its shape, where it agrees with the
    formatter and is several times cheaper.  The formatter is only left years that are signed or longer
    than four digits; anything else it would refuse by raising inside, which is slower still."""
    return (
        f"CASE WHEN {c} RLIKE {literal('^' + shape)} THEN try_cast({c} AS {target}) "
        f"WHEN {c} RLIKE {literal('^[+-]?[0-9]*' + shape)} THEN {formatter} END"
    )


def lenient_integer(c: str, target: str = "int", strict: bool = False) -> str:
    """Text to integer, dropping a fraction: '12.9' is 12, '.5' is 0, '1e2' and overflow are null.

    Plain integers take the first branch; the patterns only run on values it rejects.
    """
    if strict:
        return f"try_cast({c} AS {target})"
    whole = f"regexp_extract({c}, {_WHOLE_PART}, 1)"
    return (
        f"coalesce(try_cast({c} AS {target}), CASE WHEN contains({c}, '.') AND {c} RLIKE {_FRACTIONAL} THEN "
        f"CASE WHEN {whole} IN ('', '+', '-') THEN CAST(0 AS {target}) ELSE try_cast({whole} AS {target}) END END)"
    )


def decimal(c: str, precision: int, scale: int, symbol: str | None = None) -> str:
    """Text to decimal: extra scale is rounded half up, overflow is null.

    ``symbol`` replaces another decimal mark by a point first.
    """
    if symbol and symbol != ".":
        c = f"replace({c}, {literal(symbol)}, '.')"
    return f"try_cast({c} AS DECIMAL({precision},{scale}))"


def date(c: str, pattern: str | None) -> str:
    """Text to date by a pattern; without a pattern nothing parses."""
    if pattern is None:
        return "CAST(NULL AS DATE)"
    parsed = f"try_to_date({c}, {literal(pattern)})"
    if pattern == "yyyy-MM-dd":
        return _iso(c, _ISO_DATE, "DATE", parsed)
    return parsed


def timestamp(c: str, pattern: str | None) -> str:
    """Text to timestamp by a pattern; ``epoch_millis`` reads milliseconds since 1970."""
    if pattern is None:
        return "CAST(NULL AS TIMESTAMP)"
    if pattern == "epoch_millis":
        return f"timestamp_millis(try_cast({c} AS BIGINT))"
    parsed = f"try_to_timestamp({c}, {literal(pattern)})"
    if pattern == "yyyy-MM-dd HH:mm:ss":
        return _iso(c, _ISO_SECONDS, "TIMESTAMP", parsed)
    return parsed


def type_class(data_type: str) -> str | None:
    """Which conversion a declared type asks for; None means the value is left as it is."""
    t = data_type.lower()
    for prefix in ("int", "bigint", "decimal"):
        if t.startswith(prefix):
            return prefix
    return t if t in ("date", "timestamp") else None


def is_text_class(data_type: str) -> bool:
    return not data_type.lower().startswith(("int", "bigint", "decimal", "date", "timestamp"))


def declared_value(
    f: Field,
    c: str,
    date_format: str | None,
    timestamp_format: str | None,
    source_type: T.DataType = T.StringType(),
    strict: bool = False,
    use_decimal_symbol: bool = False,
) -> str:
    """The value converted to its declared type.

    Text goes through the parsers above.  Files that carry their own types (Parquet, ORC, JSON)
    are converted type to type; a pair Spark cannot cast yields null, that is, an invalid type.
    """
    kind = type_class(f.data_type)
    if kind is None:
        return c
    if isinstance(source_type, T.StringType):
        if kind in ("int", "bigint"):
            return lenient_integer(c, kind, strict)
        if kind == "decimal":
            return decimal(c, *precision_scale(f.length), f.decimal_symbol if use_decimal_symbol else None)
        return date(c, date_format) if kind == "date" else timestamp(c, timestamp_format)
    target = "DECIMAL({},{})".format(*precision_scale(f.length)) if kind == "decimal" else kind
    numeric = isinstance(source_type, T.NumericType)
    moment = isinstance(source_type, (T.DateType, T.TimestampType, T.TimestampNTZType))
    if kind in ("int", "bigint") and numeric:
        return c  # a number of any width is a valid integer
    if (kind in ("date", "timestamp") and moment) or (kind == "decimal" and numeric):
        return f"try_cast({c} AS {target})"
    if isinstance(source_type, T.BooleanType) and kind in ("int", "bigint", "decimal"):
        return f"try_cast(CAST({c} AS INT) AS {target})"
    return f"CAST(NULL AS {target})"
