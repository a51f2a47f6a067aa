"""Quality rules with risk-controlled thresholds.

Every rule is a share in [0, 1]; a document fails a rule if its share is above the cutoff of its stratum.  Cutoffs come
from a labelled holdout: for a cutoff, the null hypothesis "more than ``risk`` of the good documents of this stratum
would be rejected" is tested by the exact binomial tail P(X <= rejected | good, risk).  Cutoffs of a rule are fixed in
advance and tested from the mildest to the strictest, stopping at the first that can't be certified (fixed-sequence
testing keeps the error of the whole sequence at its level); ``RISK`` and ``ERROR`` are divided by the number of rules,
``ERROR`` by the number of strata as well.  So with probability 1 - ERROR, in no stratum are more than RISK of the good
documents rejected by all rules together.  A stratum with too few labelled good documents gets no cutoff: nothing is
rejected there by these rules.

Only DataFrame functions are used.

Defined results: null text has no words and fails the base rule; a null stratum is one of its own; labels repeated for a
document count once, contradicting or null ones not at all; repeated documents are judged one by one; empty tables give
empty results.  Columns of the documents are kept as they are, results replace columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, let, store, words

#: share of good documents of a stratum that the rules together may reject, and the probability of being wrong on it
RISK, ERROR = 0.04, 0.05
#: cutoffs in hundredths, from the mildest to the strictest; a document is rejected if its share is above
CUTOFFS = (90, 80, 70, 60, 50, 40, 30, 25, 20, 15, 10, 8, 6, 5, 4, 3, 2, 1)
WINDOW = 8
SYMBOLS = "#*$%&|<>"

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(w: Column) -> Column:
    """Words in 8-word windows that occur at least twice in the text."""
    n = F.size(w)
    hashes = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    def marked(s: Column) -> Column:
        same = F.transform(s, lambda x, j: F.when((F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["i"]))
        return F.sort_array(F.filter(same, lambda i: i.isNotNull()))

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - i, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda a, x: a + x,
        )

    def counted(h: Column) -> Column:
        # equal windows are neighbours after sorting; positions of all but the singles, in order
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        repeated = let(placed, lambda s: let(marked(s), covered))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), repeated).otherwise(F.lit(0).cast("long"))

    return F.when(n > WINDOW, let(hashes, counted)).otherwise(F.lit(0).cast("long"))


def features(docs: DataFrame) -> DataFrame:
    """``docs`` with the base features, their verdict and the shares that the rules judge."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    docs = docs.withColumn("_w", words(F.col("text"))).withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_repeat_words": _repeat_words(F.col("_w")),
    }).drop("_w")
    return docs.withColumns({
        "base_failed": (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30),
        "symbol_share": _share("n_symbols", "word_chars"),
        "repeat_share": _share("n_repeat_words", "n_words"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
    })


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.least(F.lit(1.0), F.col(part) / F.col(whole))).otherwise(0.0)


RULES = ["symbol_share", "repeat_share", "dup_line_share"]


def _log_gamma(x: Column) -> Column:
    """Stirling's series after a shift by eight: exact to about 1e-13 for x >= 1."""
    y = x + 8.0
    shift = F.log(x)
    for i in range(1, 8):
        shift = shift + F.log(x + float(i))
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y) - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial(n, p) for k < n: the term at k times a sum of falling ratios, from k down."""
    odds = (1 - p) / p

    def of(x: Column) -> Column:
        term = F.exp(_log_gamma(x["n"] + 1) - _log_gamma(x["k"] + 1) - _log_gamma(x["n"] - x["k"] + 1) + x["k"] * math.log(p) + (x["n"] - x["k"]) * math.log1p(-p))

        def step(a: Column, i: Column) -> Column:
            ratio = a["r"] * (x["k"] - i + 1) / (x["n"] - x["k"] + i) * odds
            return F.struct((a["s"] + ratio).alias("s"), ratio.alias("r"))

        # state: sum of the ratios so far, the last ratio
        steps = F.when(x["k"] > 0, F.sequence(F.lit(1).cast("long"), x["k"].cast("long"))).otherwise(F.array().cast("array<long>"))
        return F.least(F.lit(1.0), term * F.aggregate(steps, F.struct(F.lit(1.0).alias("s"), F.lit(1.0).alias("r")), step)["s"])

    return let(F.struct(k.cast("double").alias("k"), n.cast("double").alias("n")), of)


def thresholds(judged: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, rule, cutoff): the strictest certified cutoff of each stratum and rule, none where none is.

    ``judged`` has doc_id, stratum and the rules' shares; ``labels`` has doc_id and quality (0 or 1).  Documents that
    fail the base rules count as neither good nor bad: they are rejected anyway.
    """
    agreed = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("most")
    ).where("quality = most").select("doc_id", "quality")
    # rejected counts at every cutoff, before any shuffle by stratum
    holdout = judged.where("not base_failed").select("doc_id", "stratum", *RULES).join(agreed, "doc_id")
    cells = [
        F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), (F.col(r) > c / 100).cast("long").alias("hit"))
        for r in RULES for i, c in enumerate(CUTOFFS)
    ]
    counts = holdout.groupBy("stratum").agg(
        F.sum(F.col("quality")).cast("long").alias("good"),
        *[F.sum(F.when(F.col("quality") == 1, c["hit"])).alias(f"g{i}") for i, c in enumerate(cells)],
        *[F.sum(F.when(F.col("quality") == 0, c["hit"])).alias(f"b{i}") for i, c in enumerate(cells)],
    )
    counts = store(counts, "holdout")
    level = error / (len(RULES) * max(1, counts.count()))
    p = risk / len(RULES)
    rows = counts.select(
        "stratum", "good",
        F.explode(F.array(*[
            F.struct(
                F.lit(r).alias("rule"), F.lit(i % len(CUTOFFS)).alias("step"), F.lit(c / 100).alias("cutoff"),
                F.coalesce(f"g{i}", F.lit(0)).cast("long").alias("rejected"), F.coalesce(f"b{i}", F.lit(0)).cast("long").alias("caught"),
            )
            for i, (r, c) in enumerate((r, c) for r in RULES for c in CUTOFFS)
        ])).alias("x"),
    ).select("stratum", "good", "x.*")
    # far above the allowed share nothing can be certified, and the tail needs no terms
    possible = (F.col("good") > 0) & (F.col("rejected") <= F.col("good") * p)
    value = F.when(possible, binomial_tail(F.when(possible, F.col("rejected")).otherwise(0), F.greatest("good", F.lit(1)), p)).otherwise(1.0)
    judged_steps = rows.withColumn("certified", value <= level)
    per_rule = judged_steps.groupBy("stratum", "rule").agg(
        F.min(F.when(~F.col("certified"), F.col("step"))).alias("stop"),
        F.sort_array(F.collect_list(F.struct("step", "cutoff", "certified", "caught"))).alias("steps"),
    )
    passed = F.filter("steps", lambda s: F.col("stop").isNull() | (s["step"] < F.col("stop")))
    # of the certified ones the mildest that catches as many bad documents as the strictest
    most = F.array_max(F.transform(passed, lambda s: s["caught"]))
    best = F.filter(passed, lambda s: (s["caught"] == most) & (most > 0))
    return per_rule.select("stratum", "rule", F.get(best, F.lit(0))["cutoff"].alias("cutoff")).where("cutoff is not null")


def _verdict(judged: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``judged`` with failed_rules (comma-joined) and kept."""
    by_stratum = cutoffs.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"max_{r}") for r in RULES])
    out = judged.join(by_stratum, "stratum", "left")
    failed = F.concat_ws(",", *[F.when(F.col(r) > F.col(f"max_{r}"), F.lit(r)) for r in RULES])
    return out.withColumn("failed_rules", failed).withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))


def _stratum(stratum: str) -> Column:
    return F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum")


def apply(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and the stratum's column): features, base_failed, kept, failed rules."""
    judged = store(features(docs.select("doc_id", _stratum(stratum), "text")).drop("text"), "quality")
    cutoffs = store(thresholds(judged, labels, risk, error), "cutoffs")
    return _verdict(judged, cutoffs).select("doc_id", *FEATURES, "base_failed", "kept", "stratum", "failed_rules")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``docs`` with the columns stratum, failed_rules and kept; their own columns stay, those of the same names go.

    The documents are measured once for the cutoffs and once more for the verdict, so that texts need not be kept or moved.
    A filter on the result is pushed below the measuring and repeats it many times: to filter, use ``accepted``.
    """
    own = [c for c in docs.columns if c not in ("stratum", "failed_rules", "kept")]
    measured = features(docs.select(*[F.col(c).alias(f"own_{c}") for c in own], "doc_id", _stratum(stratum), "text"))
    judged = store(measured.select("doc_id", "stratum", "base_failed", *RULES), "quality")
    cutoffs = store(thresholds(judged, labels, risk, error), "cutoffs")
    return _verdict(measured, cutoffs).select(*[F.col(f"own_{c}").alias(c) for c in own], "stratum", "failed_rules", "kept")


def accepted(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, the stratum's column and others) that fail no rule.

    Texts are measured once.  Rejected rows are found again by id, stratum and hash of the text; texts are moved only where more are
    rejected than may be sent to every executor.
    """
    key = F.xxhash64("text")
    judged = store(features(docs.select("doc_id", _stratum(stratum), key.alias("key"), "text")).drop("text"), "quality")
    cutoffs = store(thresholds(judged, labels, risk, error), "cutoffs")
    gone = _verdict(judged, cutoffs).where("not kept").select(F.col("doc_id").alias("gone_id"), F.col("stratum").alias("gone_stratum"), F.col("key").alias("gone_key"))
    gone = store(gone.distinct(), "rejected")
    few = gone.count() <= BROADCAST_ROWS
    same = (key == F.col("gone_key")) & F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.coalesce(F.col(stratum).cast("string"), F.lit("")) == F.col("gone_stratum"))
    return docs.join(F.broadcast(gone) if few else gone, same, "left_anti")
