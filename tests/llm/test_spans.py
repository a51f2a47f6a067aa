"""Spans of texts with very many matches: against plain Python, and at a cost that follows the text."""

import random
import re
import time

from pyspark.sql import functions as F

from dropgate.llm import pii, secret_scan, spans as S


def texts():
    r = random.Random(5)
    few = ["", "none", "a1", "🙂12 é3", "7" * 5]
    many = ["".join(r.choice(["🙂", "é", " ", "x", "12", "345", "-"]) for _ in range(n)) for n in (100, 127, 128, 129, 1000, 5000)]
    return few + many + ["1 " * (S.CHUNK * k) for k in (1, 2)]


def frame(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def test_find(spark):
    rows = texts()
    got = frame(spark, rows + [None]).select("doc_id", S.find(F.col("text"), "x?([0-9]+)", "n", 0, 1).alias("s")).collect()
    for r in got:
        if r.doc_id == len(rows):
            assert r.s == []
            continue
        want = [(m.start(), m.end(), m[0], m[1]) for m in re.finditer("x?([0-9]+)", rows[r.doc_id])]
        assert [(s.start, s.end, s.match, s.part) for s in r.s] == want


def drawn(r, n, length):
    return [(a := r.randrange(length), a + r.randrange(1, 9)) for _ in range(n)]


def stored(spark, cases):
    """(i, a, b): arrays of spans."""
    full = lambda xs: [(s, 0, "k", e, "", "") for s, e in xs]
    return spark.createDataFrame([(i, full(a), full(b)) for i, (a, b) in enumerate(cases)], f"i int, a {S.SPAN}, b {S.SPAN}")


def test_apart_and_widest(spark):
    r = random.Random(6)
    cases = [(drawn(r, n, 9000), drawn(r, m, 9000)) for n, m in ((0, 0), (0, 5), (5, 0), (40, 30), (300, 128), (600, 129), (700, 700))]
    got = stored(spark, cases).select("i", S.apart(F.col("a"), F.col("b")).alias("apart"), S.widest(F.col("a")).alias("widest")).collect()
    for row in got:
        a, b = cases[row.i]
        assert [(s.start, s.end) for s in row.apart] == [x for x in a if not any(o[0] < x[1] and x[0] < o[1] for o in b)]
        longer = lambda x: any(o[0] <= x[0] and o[1] >= x[1] and o[1] - o[0] > x[1] - x[0] for o in a)
        assert [(s.start, s.end) for s in row.widest] == [x for x in a if not longer(x)]


def test_masked(spark):
    r = random.Random(7)
    cases = []
    for n, length in ((0, 10), (1, 10), (50, 60), (300, 400), (129, 9000), (900, 9000)):
        text = "".join(r.choice("ab🙂é ") for _ in range(length))
        cases.append((text, [(s, min(e, length)) for s, e in drawn(r, n, length)]))
    df = stored(spark, [(spans, []) for _, spans in cases]).join(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, text string"), "i")
    for row in df.select("i", S.masked(F.col("text"), F.col("a"), "[X]").alias("out")).collect():
        text, spans = cases[row.i]
        want, at = "", 0
        for s, e in sorted(spans):
            if s >= at:
                want += text[at:s] + "[X]"
            at = max(at, e)
        assert row.out == want + text[at:]


def test_looks_through_windows(spark):
    r = random.Random(8)
    for length in (0, 1, 39, S.WINDOW - 1, S.WINDOW, S.WINDOW + 1, 3 * S.WINDOW + 50):
        text = "".join(r.choice("ab🙂é ") for _ in range(length))
        places = sorted({0, length, *(p for p in (1, 40, S.WINDOW - 1, S.WINDOW, S.WINDOW + 1, 2 * S.WINDOW) if p <= length)})
        df = spark.createDataFrame([(text, places)], "text string, places array<int>")
        look = lambda w: F.transform("places", lambda p: F.struct(S.before(w, 40, p, 40), S.before(w, 40, p, 1), S.char_at(w, 40, p)))
        got = df.select(S.let(S.windows(F.col("text"), 40), look).alias("x")).first().x
        assert [tuple(g) for g in got] == [(text[max(p - 40, 0) : p], text[max(p - 1, 0) : p], text[p : p + 1]) for p in places]


def test_cost_follows_the_text(spark):
    """Eight times the matches take far less than the 64 times that comparing all of them would."""

    def seconds(fn, unit, n):
        df = frame(spark, [unit * n])
        at = time.time()
        out = fn(df).collect()
        return time.time() - at, out[0]

    pii.report(frame(spark, ["a@b.co"])).collect()
    small, _ = seconds(pii.report, "a@b.co ", 4000)
    large, row = seconds(pii.report, "a@b.co ", 32000)
    assert row.n_email == 32000 and large < 20 * small + 5
    assert secret_scan.redact(frame(spark, ["AKIA" + "0" * 16 + " x "])).first().text == "[SECRET] x "
    _, row = seconds(secret_scan.redact, "AKIA" + "0" * 16 + " x ", 16000)
    assert row.text == "[SECRET] x " * 16000
