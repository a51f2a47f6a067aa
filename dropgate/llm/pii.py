"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a classifier decides.

Candidates are the base spans (mail addresses, IP addresses, card and phone numbers) and looser matches: disguised mail
addresses, phone numbers without country code, national and bank account numbers, long digit groups.  Every candidate
gets a vote of each labeler: 1 personal, 0 not, 2 no opinion.

* pattern (regex): the strict form of its kind holds;
* check (regex): the check digits or ranges of its kind hold;
* gazetteer: top-level domain, country code, card issuer, area code, bank country from fixed lists;
* cue (context): a cue word stands before it, or one that tells other numbers;
* edge (context): it isn't glued to letters, digits or marks;
* layout: its groups of digits are as people write them.

Dawid-Skene EM estimates each labeler's vote probabilities given the hidden class from the counts of vote patterns: at most
``len(KINDS) * 3^6`` rows, whatever the size of the corpus.  Its posteriors, with the same features, train a logistic span
classifier; candidates outside base spans with probability ``ACCEPT`` or more are added.  Base spans always stay.

Only DataFrame functions touch the texts; the driver sees the counts of patterns alone.

Defined results: null text counts as empty; repeated documents are scanned one by one; without candidates nothing is added; an empty
table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .common import store

#: base patterns in the order of their rank (fixed values), written so that matching takes linear time and no deep stack
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: looser candidates
DISGUISED = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]++\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z]{2,}"
LOCAL = r"(?<![0-9])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
NATIONAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "disguised", "local", "national", "account", "digits")
LABELERS = ("pattern", "check", "gazetteer", "cue", "edge", "layout")
ACCEPT, ROUNDS = 0.9, 50
#: characters before a candidate in which cue words count
BEFORE = 40

#: gazetteers and cue words (fixed values)
DOMAINS = "com org net edu gov mil int info biz io de fr es it uk us ca au nl be ch at se no fi dk pl pt br mx in jp cn ru eu".split()
COUNTRY_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 380 420 421".split()
ISSUERS = "4 51 52 53 54 55 34 37 6011 65 35 36 38 30 22 23 24 25 26 27".split()
BANK_COUNTRIES = "AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT RO SE SK".split()
CUES = "mail e-mail email contact phone tel telephone mobile cell call fax card credit debit visa iban account ssn social ip address addr client host user correo tarjeta karte compte".split()
OTHER_CUES = "isbn issn order invoice version build id ref no serial sku doi page total commit model part".split()


def luhn(digits: Column) -> Column:
    """Do the check digits of a string of digits hold?"""
    values = F.transform(F.reverse(F.array_remove(F.split(digits, ""), "")), lambda d, i: (
        F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.when(d.cast("int") > 4, 1).otherwise(0))
    ))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _octets(s: Column) -> Column:
    # a part of more than three digits is judged without leading zeros
    parts = F.transform(F.split(s, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))


def _card(s: Column) -> Column:
    return S.let(_digits(s), lambda d: F.length(d).between(14, 19) & luhn(d))


def base_spans(text: Column) -> tuple[Column, Column]:
    """(mail, IP and phone spans, digit groups of 9 to 19 digits: those that pass the card check are base spans too)."""
    ip = F.filter(S.find(text, IP, "ip", 1, needs=text.contains(".")), lambda s: _octets(s["match"]))
    phone = F.filter(S.find(text, PHONE, "phone", 3, needs=text.contains("+")), lambda s: F.length(_digits(s["match"])).between(10, 15))
    numbers = F.filter(S.find(text, CARD, "card", 2), lambda s: F.length(_digits(s["match"])).between(9, 19))
    return F.concat(S.find(text, EMAIL, "email", 0, needs=text.contains("@")), ip, phone), numbers


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, 0).otherwise(2)


def _starts(s: Column, heads: list[str]) -> Column:
    return s.rlike("^(?:" + "|".join(heads) + ")")


def votes(s: Column, windows: Column) -> Column:
    """struct(kind, one vote of each labeler) of a candidate; ``windows``: those of its text, led by BEFORE characters."""
    kind, match = s["kind"], s["match"]
    digits = _digits(match)
    before = F.lower(S.before(windows, BEFORE, s["start"], BEFORE))
    last, after = S.before(windows, BEFORE, s["start"], 1), S.char_at(windows, BEFORE, s["end"])
    card, ends = luhn(digits), F.lower(F.regexp_extract(match, r"([A-Za-z]+)$", 1))
    mail = kind.isin("email", "disguised")
    pattern = _vote(kind.isin(*BASE) & ((kind != "card") | card), F.lit(True))
    check = F.when(kind.isin("card", "digits"), _vote(card & F.length(digits).between(14, 19), F.lit(True))).when(kind == "ip", 1).when(
        kind == "national", _vote(~match.rlike("^(?:000|666|9)|-00-|-0000$"), F.lit(True))
    ).otherwise(2)
    gazetteer = (
        F.when(mail, _vote(ends.isin(*DOMAINS), F.lit(True)))
        .when(kind == "phone", _vote(_starts(digits, COUNTRY_CODES), F.lit(True)))
        .when(kind.isin("card", "digits"), _vote(_starts(digits, ISSUERS) & F.length(digits).between(14, 19), F.lit(True)))
        .when(kind == "account", _vote(F.substring(match, 1, 2).isin(*BANK_COUNTRIES), F.lit(True)))
        .when(kind == "local", _vote(digits.rlike("^[2-9]"), F.lit(True)))
        .when(kind == "ip", _vote(~_starts(match, ["0\\.", "127\\.", "255\\."]), F.lit(True)))
        .otherwise(2)
    )
    cue = _vote(before.rlike(r"(?:^|[^a-z])(?:" + "|".join(CUES) + r")[^a-z]{0,6}$"), before.rlike(r"(?:^|[^a-z])(?:" + "|".join(OTHER_CUES) + r")[^a-z]{0,6}$"))
    edge = _vote(~last.rlike(r"[\p{L}0-9_#$%&*=/-]") & ~after.rlike(r"[\p{L}0-9_=/]"), F.lit(True))
    layout = (
        F.when(kind.isin("card", "digits"), _vote(match.rlike(r"^(?:[0-9]{14,16}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$"), F.lit(True)))
        .when(kind == "phone", _vote(match.rlike(r"^\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){1,4}$"), F.lit(True)))
        .otherwise(2)
    )
    found = dict(zip(LABELERS, (pattern, check, gazetteer, cue, edge, layout)))
    return F.struct(kind.alias("kind"), *[v.cast("int").alias(k) for k, v in found.items()])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, voted): base spans and all candidates with their votes."""
    text = F.coalesce("text", F.lit(""))
    fixed, numbers = base_spans(F.col("text"))
    found = docs.select("doc_id", text.alias("text")).withColumns({"fixed": fixed, "numbers": numbers})
    found = found.withColumn("base", F.concat("fixed", F.filter("numbers", lambda s: _card(s["match"]))))
    t = F.col("text")
    loose = F.concat(
        S.find(t, DISGUISED, "disguised", 4, needs=t.contains("(at)") | t.contains("[at]") | t.contains(" at ")), S.find(t, LOCAL, "local", 5), S.find(t, NATIONAL, "national", 6, needs=t.contains("-")), S.find(t, ACCOUNT, "account", 7),
        F.transform(F.filter("numbers", lambda s: ~_card(s["match"]) & (F.length(_digits(s["match"])) >= 12)), lambda s: s.withField("kind", F.lit("digits")).withField("rank", F.lit(8))),
    )
    free = S.apart(loose, F.col("base"))
    found = found.withColumn("candidates", F.concat("base", free))
    voted = S.let(S.windows(t, BEFORE), lambda w: F.transform("candidates", lambda s: F.struct(_bare(s).alias("span"), votes(s, w).alias("votes"))))
    return found.select("doc_id", F.transform("base", _bare).alias("base"), voted.alias("voted"))


def _bare(s: Column) -> Column:
    return s.withField("match", F.lit("")).withField("part", F.lit(""))


def dawid_skene(counts: list[tuple[tuple[int, ...], float]], rounds: int = ROUNDS) -> tuple[float, list[list[list[float]]], list[float]]:
    """EM over vote patterns: (share of class 1, P(vote | class) by labeler, posterior of each pattern).

    Starts from the share of votes for class 1; one pseudo-count keeps the probabilities off zero.
    """
    posterior = []
    for pattern, _ in counts:
        cast = [v for v in pattern if v != 2]
        posterior.append((sum(cast) + 0.5) / (len(cast) + 1))
    prior, table = 0.5, []
    for _ in range(rounds):
        weight = [sum(n * (p if c else 1 - p) for (_, n), p in zip(counts, posterior)) for c in (0, 1)]
        prior = (weight[1] + 1) / (weight[0] + weight[1] + 2)
        table = []
        for k in range(len(LABELERS)):
            rows = []
            for c in (0, 1):
                seen = [1.0, 1.0, 1.0]
                for (pattern, n), p in zip(counts, posterior):
                    seen[pattern[k]] += n * (p if c else 1 - p)
                rows.append([x / sum(seen) for x in seen])
            table.append(rows)
        posterior = []
        for pattern, _ in counts:
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[k][1][v] / table[k][0][v]) for k, v in enumerate(pattern))
            posterior.append(1 / (1 + math.exp(-max(-500.0, min(500.0, odds)))))
    return prior, table, posterior


def features(kind: str, pattern: tuple[int, ...]) -> list[float]:
    """The classifier's features: a constant, each labeler's two votes, the kind."""
    return [1.0, *[float(v == x) for v in pattern for x in (1, 0)], *[float(kind == k) for k in KINDS]]


def fit(rows: list[tuple[list[float], float, float]], steps: int = 400, ridge: float = 1.0) -> list[float]:
    """Weights of a logistic regression on (features, target, count), by gradient steps with a ridge."""
    if not rows:
        return []
    total = sum(n for _, _, n in rows)
    w, momentum = [0.0] * len(rows[0][0]), [0.0] * len(rows[0][0])
    for _ in range(steps):
        g = [ridge * x / total for x in w]
        for x, y, n in rows:
            d = (1 / (1 + math.exp(-max(-35.0, min(35.0, sum(a * b for a, b in zip(w, x)))))) - y) * n / total
            for i, v in enumerate(x):
                if v:
                    g[i] += d
        momentum = [0.9 * m - 0.5 * d for m, d in zip(momentum, g)]
        w = [a + m for a, m in zip(w, momentum)]
    return w


def train(found: DataFrame) -> list[float]:
    """The classifier's weights from all candidates of a stored scan."""
    rows = found.select(F.explode("voted").alias("v")).groupBy("v.votes").agg(F.count("*").alias("n")).collect()
    rows = sorted((r["votes"]["kind"], tuple(r["votes"][k] for k in LABELERS), float(r["n"])) for r in rows)
    _, _, posterior = dawid_skene([(p, n) for _, p, n in rows])
    return fit([(features(k, p), y, n) for (k, p, n), y in zip(rows, posterior)])


def probability(votes_: Column, weights: list[float]) -> Column:
    x = [F.lit(1.0)]
    x += [(votes_[k] == v).cast("double") for k in LABELERS for v in (1, 0)]
    x += [(votes_["kind"] == k).cast("double") for k in KINDS]
    return 1 / (1 + F.exp(-sum((f * w for f, w in zip(x, weights)), F.lit(0.0))))


def decide(found: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, base, added) of a stored scan."""
    weights = train(found)
    chosen = F.filter("voted", lambda v: ~v["votes"]["kind"].isin(*BASE) & (probability(v["votes"], weights) >= accept))
    return found.select("doc_id", "base", F.transform(chosen, lambda v: v["span"]).alias("added"))


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts, digest of the base spans, all spans."""
    found = decide(store(scan(docs), "pii"))
    return found.select(
        "doc_id", *[S.count(F.col("base"), k).alias(f"n_{k}") for k in BASE], F.sha2(S.joined(F.col("base")), 256).alias("base_sha256"),
        S.joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )
