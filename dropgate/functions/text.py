"""Text predicates of the contract checks (SQL text) and path helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .casts import literal


def unescaped_quote(c: str, quote: str | None, escape: str | None) -> str:
    """True where the quote character occurs without the escape character right before it.

    The plain search runs first, so the pattern is only tried on values that hold a quote.
    """
    if not quote:
        return "false"
    pattern = re.escape(quote)
    if escape:
        pattern = f"(?<!{re.escape(escape)}){pattern}"
    return f"(contains({c}, {literal(quote)}) AND {c} RLIKE {literal(pattern)})"


def bad_text(c: str, delimiter: str, quote: str | None, escape: str | None) -> str:
    """True where text holds the field delimiter or an unescaped quote."""
    return f"(contains({c}, {literal(delimiter)}) OR {unescaped_quote(c, quote, escape)})"


def file_name_of(path: Column) -> Column:
    """Last segment of a path."""
    return F.element_at(F.split(path, "/"), -1)


def extension_of(path: str) -> str:
    """Lower-cased text after the last dot, looking through a compression suffix."""
    name = re.sub(r"\.(gz|gzip|bz2|zst|zstd|deflate|snappy|lz4)$", "", path.rsplit("/", 1)[-1], flags=re.I)
    return name.rsplit(".", 1)[-1].lower()
