"""Spans of regular expressions as DataFrame expressions: offsets in code points, end exclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import let  # noqa: F401

#: spans handled at once: offsets are summed and spans compared in blocks of so many, which keeps texts with very many matches cheap
CHUNK = 128
#: characters of a text that a look at one of its places goes through, instead of all before it
WINDOW = 2048
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,match:string,part:string>>"


def find(text: Column, regex: str, kind: str, rank: int, group: int = 0, needs: Column | None = None) -> Column:
    """All leftmost non-overlapping matches, in order; ``part`` is what the group holds.

    Splitting by the same expression gives the texts between the matches, so the offsets are sums of lengths.
    ``needs``: a cheap condition without which nothing matches, tested first.
    """
    pattern = F.lit(regex)
    between = F.split(text, regex, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.regexp_extract_all(text, pattern, F.lit(group)) if group else matches
    pieces = F.zip_with(F.zip_with(between, matches, lambda b, m: F.struct(b.alias("b"), m.alias("m"))), parts, lambda x, p: F.struct(x["b"].alias("b"), x["m"].alias("m"), p.alias("p")))

    def block(xs: Column) -> Column:
        return F.struct(xs.alias("xs"), _sums(F.transform(xs, lambda x: F.length(x["b"]) + F.length(x["m"]))).alias("ends"))

    def placed(blocks: Column) -> Column:
        def of(bases: Column) -> Column:
            def spans(b: Column, k: Column) -> Column:
                def span(x: Column, i: Column) -> Column:
                    high = F.get(bases, k) + F.get(b["ends"], i + 1)
                    low = high - F.length(x["m"])
                    return F.struct(low.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), high.alias("end"), x["m"].alias("match"), x["p"].alias("part"))

                return F.transform(b["xs"], span)

            return F.flatten(F.transform(blocks, spans))

        return let(_sums(F.transform(blocks, lambda b: F.element_at(b["ends"], -1))), of)

    held = F.filter(pieces, lambda x: x["m"].isNotNull())
    found = let(held, lambda xs: let(F.transform(_chunks(xs), block), placed)).cast(SPAN)
    some = text.rlike(regex) if needs is None else needs & text.rlike(regex)
    return F.when(some, found).otherwise(F.array().cast(SPAN))


def _chunks(xs: Column) -> Column:
    """A non-empty array in pieces of at most CHUNK, so that no step copies or compares more than a piece."""
    last = F.floor((F.size(xs) - 1) / CHUNK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(xs, i * CHUNK + 1, F.lit(CHUNK)))


def _sums(xs: Column) -> Column:
    """Zero and the running sums."""
    return F.aggregate(xs, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))


def blocks(spans: Column) -> Column:
    """The spans by start in blocks of CHUNK, each with its least start and greatest end."""

    def block(xs: Column) -> Column:
        return F.struct(F.array_min(F.transform(xs, lambda s: s["start"])).alias("low"), F.array_max(F.transform(xs, lambda s: s["end"])).alias("high"), xs.alias("xs"))

    ordered = let(F.when(F.size(spans) > CHUNK, F.sort_array(spans)).otherwise(spans), lambda xs: F.transform(_chunks(xs), block))
    return F.when(F.size(spans) > 0, ordered)


def meets(span: Column, blocks: Column, test) -> Column:
    """Does ``test(other)`` hold for one of the spans in the blocks that share a character with ``span``?  False without blocks."""

    def shares(o: Column, low: str, high: str) -> Column:
        return (o[low] < span["end"]) & (span["start"] < o[high])

    found = F.exists(blocks, lambda b: shares(b, "low", "high") & F.exists(b["xs"], lambda o: shares(o, "start", "end") & test(o)))
    return F.coalesce(found, F.lit(False))


def apart(spans: Column, others: Column) -> Column:
    """Those of ``spans`` that share no character with one of ``others``."""
    return let(blocks(others), lambda b: F.filter(spans, lambda s: ~meets(s, b, lambda o: F.lit(True))))


def widest(spans: Column) -> Column:
    """Those that lie in no longer one."""

    def wider(s: Column, o: Column) -> Column:
        return (o["start"] <= s["start"]) & (o["end"] >= s["end"]) & (o["end"] - o["start"] > s["end"] - s["start"])

    return let(blocks(spans), lambda b: F.filter(spans, lambda s: ~meets(s, b, lambda o: wider(s, o))))


def windows(text: Column, reach: int) -> Column:
    """The text in windows of WINDOW characters, each led by the ``reach`` characters before it."""
    last = F.floor(F.length(text) / WINDOW).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(text, _low(k, reach) + 1, F.when(k == 0, WINDOW).otherwise(WINDOW + reach)))


def _low(k: Column, reach: int) -> Column:
    return F.greatest(k * WINDOW - reach, F.lit(0))


def before(windows: Column, reach: int, at: Column, n: int) -> Column:
    """The up to ``n`` characters (at most ``reach``) before a place of the text."""
    k = F.floor(at / WINDOW).cast("int")
    return F.substring(F.get(windows, k), F.greatest(at - n, F.lit(0)) - _low(k, reach) + 1, F.least(at, F.lit(n)))


def char_at(windows: Column, reach: int, at: Column) -> Column:
    """The character at a place; empty at the end."""
    k = F.floor(at / WINDOW).cast("int")
    return F.substring(F.get(windows, k), at - _low(k, reach) + 1, F.lit(1))


def joined(spans: Column) -> Column:
    """kind:start:end of the spans by start, then rank, comma-joined."""
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with each span, overlapping ones merged, replaced by ``mask``."""

    def of(held: Column) -> Column:
        # where each block goes on: the greatest end before it
        ends = F.aggregate(held, F.array(F.lit(0)), lambda a, b: F.concat(a, F.array(F.greatest(F.element_at(a, -1), b["high"]))))
        return let(ends, lambda e: F.concat(
            F.array_join(F.transform(held, lambda b, k: piece(b, F.get(e, k))), ""), F.substring(text, F.element_at(e, -1) + 1, F.length(text))
        ))

    def piece(b: Column, base: Column) -> Column:
        def of(own: Column) -> Column:
            def step(state: Column, s: Column) -> Column:
                gap = F.substring(own, state["at"] - base + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
                out = F.when(s["start"] >= state["at"], F.concat(state["out"], gap, F.lit(mask))).otherwise(state["out"])
                return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

            return F.aggregate(b["xs"], F.struct(base.alias("at"), F.lit("").alias("out")), step, lambda s: s["out"])

        return let(F.substring(text, base + 1, F.greatest(b["high"] - base, F.lit(0))), of)

    return F.when(F.size(spans) > 0, let(blocks(F.sort_array(spans)), of)).otherwise(text)
