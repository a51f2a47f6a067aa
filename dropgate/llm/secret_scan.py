"""Secret scan: fixed patterns plus a battery of randomness tests on long tokens.

A token of 20 or more characters of ``[A-Za-z0-9+/_-]`` that no base pattern covers gets an encoding: the smallest of
hex, base 32, lower or upper letters, base 64 (with either pair of extra characters, or both) whose alphabet holds it.  Its parts
of 20 or more characters between slashes and plus signs, between dashes and underscores, and between all four are tokens too, so a key
in a path is tested without the words around it.  Of discovered tokens the widest is reported.

* Battery, against "uniformly random over the alphabet": chi-squared of five slices of the alphabet (4 degrees of
  freedom), Wald-Wolfowitz runs about the middle of the alphabet and serial correlation at lag one (the squares of two
  normal scores).  Their sum is chi-squared with 6 degrees of freedom, which has a closed survival function.
* Length-aware discovery, against "ordinary token": changes between lower case, upper case and digits among L
  characters are binomial(L - 1, NULL_RATE), and pairs of adjacent letters that words seldom hold binomial(pairs, RARE_RATE); the lesser
  of the two exact upper tails, each divided by its share of the error, is the token's p-value.  Benjamini-Hochberg runs over
  all tokens of the corpus, separately for each stratum of length, so short tokens need stronger evidence than
  the many long ones would allow.  The p-values are counted in bins of a quarter of a decade and judged at the bin's largest.

A token is a secret if it is discovered and the battery does not refute randomness.  Tokens of digits alone have neither changes nor
letters and are left to the base patterns.  Only DataFrame functions are used.

Defined results: null text counts as empty; repeated documents are scanned one by one; no tokens, no discoveries;
an empty table gives an empty result.  Other columns are kept; results replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import spans as S
from .common import store
from .quality_rules import binomial_tail

#: base patterns, in the order of their rank (fixed values)
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}+"
TOKEN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
#: parts of a token that are tested as well
PARTS = ("[A-Za-z0-9_-]{20,}+", "[A-Za-z0-9+/]{20,}+", "[A-Za-z0-9]{20,}+")

#: alphabets from the smallest to the largest; the first that holds a token is its encoding
ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("hex", "0123456789ABCDEF"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("mixed", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
)
SLICES = 5
#: class changes per character of an ordinary token, false-discovery rate, and the battery's level
NULL_RATE, DISCOVERY, LEVEL = 0.08, 0.01, 0.001
#: share of rare letter pairs in an ordinary token, and shares of the error that the two statistics have
RARE_RATE, CHANGES_SHARE, RARE_SHARE = 0.08, 0.9, 0.1
#: the letters that follow each letter in words of European languages (fixed values); other pairs are rare
FOLLOW = dict(zip("abcdefghijklmnopqrstuvwxyz", """
bcdefghijklmnpqrstuvwxyz abeilorstuy acehiklortuy adegilmnorstuvwy abcdefghiklmnoprstuvwxyz aefilortuy aeghilnorstuy aeilmnortuwy
abcdefgklmnopqrstuvxz aeou aeilnorstuy abcdefgiklmnopstuvy abeimnopsuy acdefgijklmnoqrstuvyz abcdefghijklmnoprstuvwxyz aefhiloprstuy u
abcdefgiklmnoprstuvwyz acehiklmnopqstuwy acehilmnorstuwyz abcdefgiklmnoprstvxz aeiory aehinors aceioptu abcdeilmnoprst aeiotuwyz
""".split()))
RARE = "(?=" + "|".join(f"{a}[^{b}\\P{{Lower}}]" for a, b in FOLLOW.items()) + ")"
#: strata of length by their least length; a bin of p-values is a quarter of a decade
LENGTHS, BIN, BINS = (20, 28, 40, 64), 0.25, 160


def base_spans(text: Column) -> Column:
    named = S.let(F.lower(text), lambda t: t.contains("passw") | t.contains("secret") | t.contains("token") | t.contains("api"))
    assign = F.filter(S.find(text, ASSIGN, "assign", 0, 2, named), lambda s: F.length(s["part"]) >= 6)
    return F.concat(assign, S.find(text, ACCESS, "access", 1, needs=text.contains("AKIA")), S.find(text, HEX, "hex", 2))


def _held(token: Column, alphabet: str) -> Column:
    return F.translate(token, alphabet, "") == ""


def battery(token: Column) -> Column:
    """struct(encoding, random_p): the inferred encoding and the battery's p-value; null without an encoding."""

    def of(name: str, alphabet: str) -> Column:
        size = len(alphabet)
        codes = F.transform(F.array_remove(F.split(token, ""), ""), lambda c: F.instr(F.lit(alphabet), c) - 1)

        middle, centre, var = size / 2, (size - 1) / 2, (size * size - 1) / 12

        def measured(x: Column) -> Column:
            n = F.size(x).cast("double")
            chi = F.lit(0.0)
            for g in range(SLICES):
                low, high = -(-g * size // SLICES), -(-(g + 1) * size // SLICES)
                seen = F.size(F.filter(x, lambda v: (v >= low) & (v < high))).cast("double")
                chi = chi + seen * seen * (size / (high - low))
            lag = F.aggregate(F.transform(x, lambda v, i: (v - centre) * (F.coalesce(F.get(x, i - 1), F.lit(centre)) - centre)), F.lit(0.0), lambda a, v: a + v)
            runs = F.size(F.filter(F.transform(x, lambda v, i: (v >= middle) != (F.get(x, i - 1) >= middle)), lambda b: b))
            return F.struct(
                n.alias("n"), (chi / n - n).alias("chi"), lag.alias("lag"), (1.0 + runs).alias("runs"),
                F.size(F.filter(x, lambda v: v >= middle)).cast("double").alias("ups"),
            )

        def scored(m: Column) -> Column:
            mean = 1 + 2 * m["ups"] * (m["n"] - m["ups"]) / m["n"]
            spread = (mean - 1) * (mean - 2) / (m["n"] - 1)
            runs_z2 = F.when(spread > 0, (m["runs"] - mean) * (m["runs"] - mean) / spread).otherwise(m["n"])
            return (m["chi"] + runs_z2 + m["lag"] * m["lag"] / (var * var * (m["n"] - 1))) / 2

        def tests(x: Column) -> Column:
            p = S.let(S.let(measured(x), scored), lambda half: F.exp(-half) * (1 + half + half * half / 2))
            return F.struct(F.lit(name).alias("encoding"), p.alias("random_p"))

        return S.let(codes, tests)

    out = None
    for name, alphabet in ALPHABETS:
        out = F.when(_held(token, alphabet), of(name, alphabet)) if out is None else out.when(_held(token, alphabet), of(name, alphabet))
    return out


def text_p(token: Column) -> Column:
    """The p-value of the token's class changes and letter pairs if it were an ordinary one."""
    return F.least(F.lit(1.0), changes_p(token) / CHANGES_SHARE, rare_p(token) / RARE_SHARE)


def rare_p(token: Column) -> Column:
    """The p-value of the token's rare letter pairs."""

    def seen(low: Column) -> Column:
        pairs = F.regexp_count(low, F.lit("(?=[a-z][a-z])")).cast("long")
        return F.struct(F.greatest(pairs, F.lit(1).cast("long")).alias("n"), F.regexp_count(low, F.lit(RARE)).cast("long").alias("rare"))

    def of(x: Column) -> Column:
        return F.when(x["rare"] > 0, binomial_tail(x["n"] - x["rare"], x["n"], 1 - RARE_RATE)).otherwise(1.0)

    return S.let(S.let(F.lower(token), seen), of)


def changes_p(token: Column) -> Column:
    """The p-value of the token's class changes."""
    classes = F.translate(
        F.translate(F.translate(F.regexp_replace(token, "[+/_-]", ""), "abcdefghijklmnopqrstuvwxyz", "a" * 26), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A" * 26),
        "0123456789", "0" * 10,
    )

    def seen(c: Column) -> Column:
        # a change is where a run of one class ends and another begins
        changes = F.length(F.regexp_replace(c, r"(.)\1*+", "x")).cast("long") - 1
        return F.struct(F.greatest(F.length(c).cast("long") - 1, F.lit(1).cast("long")).alias("n"), changes.alias("changes"))

    def of(x: Column) -> Column:
        return F.when(x["changes"] > 0, binomial_tail(x["n"] - x["changes"], x["n"], 1 - NULL_RATE)).otherwise(1.0)

    return S.let(S.let(classes, seen), of)


def stratum(length: Column) -> Column:
    return sum(((length >= low).cast("int") for low in LENGTHS), F.lit(0))


def _bin(p: Column) -> Column:
    return F.least(F.lit(BINS), F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) / BIN).cast("int"))


def discoveries(tokens: DataFrame) -> dict[int, int]:
    """The least bin of p-values that Benjamini-Hochberg accepts, by stratum.  ``tokens``: (stratum, bin), all of them.

    At most ``len(LENGTHS) * (BINS + 1)`` counts leave the aggregation, one number a stratum reaches the driver.
    """
    counts = tokens.groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    down = Window.partitionBy("stratum").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.partitionBy("stratum")
    judged = counts.select("stratum", "bin", F.sum("n").over(down).alias("found"), F.sum("n").over(all_).alias("m"))
    accepted = judged.where(F.col("m") * F.pow(F.lit(10.0), -F.col("bin") * BIN) <= F.col("found") * DISCOVERY)
    return {r[0]: r[1] for r in accepted.groupBy("stratum").agg(F.min("bin")).collect()}


def with_parts(span: Column) -> Column:
    """A token and its parts, each once."""
    found = F.concat(*[S.find(span["match"], part, "random", 3) for part in PARTS])
    moved = F.transform(found, lambda s: s.withField("start", s["start"] + span["start"]).withField("end", s["end"] + span["start"]))
    return F.when(span["match"].rlike("[+/_-]"), F.array_distinct(F.concat(F.array(span), moved))).otherwise(F.array(span))


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` (text and others) with the base spans and the tested tokens."""
    text = F.coalesce("text", F.lit(""))

    def bare(s: Column) -> Column:
        return s.withField("match", F.lit("")).withField("part", F.lit(""))

    def with_tested(base: Column) -> Column:
        free = S.apart(F.flatten(F.transform(S.find(text, TOKEN, "random", 3), with_parts)), base)
        tested = F.transform(free, lambda s: F.struct(
            bare(s).alias("span"), battery(s["match"]).alias("b"), _bin(text_p(s["match"])).alias("bin"), stratum(F.length(s["match"])).alias("stratum")
        ))
        return F.struct(F.transform(base, bare).alias("base"), tested.alias("tested"))

    found = docs.withColumn("__found", S.let(base_spans(text), with_tested))
    return found.withColumns({"__base": F.col("__found.base"), "__tested": F.col("__found.tested")}).drop("__found")


def decide(found: DataFrame) -> DataFrame:
    """Keep the tested tokens that are discovered over the whole table; ``found`` must be stored."""
    limits = discoveries(found.select(F.explode("__tested").alias("t")).select("t.stratum", "t.bin"))

    def secret(t: Column) -> Column:
        limit = F.lit(BINS + 1)
        for k, low in limits.items():
            limit = F.when(t["stratum"] == k, F.lit(low)).otherwise(limit)
        return (t["bin"] >= limit) & (t["b"]["random_p"] >= LEVEL)

    random = S.let(F.transform(F.filter("__tested", secret), lambda t: t["span"]), S.widest)
    return found.withColumn("__random", random).drop("__tested")


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts, digest of the base spans, all spans."""
    found = decide(store(scan(docs.select("doc_id", "text")).drop("text"), "secrets"))
    return found.select(
        "doc_id", *[S.count(F.col("__base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(S.joined(F.col("__base")), 256).alias("base_sha256"), S.joined(F.concat("__base", "__random")).alias("spans"),
        F.size("__random").cast("long").alias("n_random"),
    )


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mask``."""
    columns = docs.columns
    found = decide(store(scan(docs), "secrets"))
    return found.withColumn("text", S.masked(F.col("text"), F.concat("__base", "__random"), mask)).select(*columns)
