"""The registered queries on the smallest data, against their SQL or a plain version."""

import collections
import glob
import os
import re
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import helpers as H
from tools.check_oracle import norm

import corpus_pipeline
from dropgate.llm import packing, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = collections.Counter(tuple(norm(r[c]) for c in columns) for r in df.collect())
    cur = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    assert got == collections.Counter(tuple(norm(r[names.index(c)]) for c in columns) for r in cur.fetchall())


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet").collect()


def test_leaks_are_the_items_in_the_texts(spark):
    items = {r.item_id: " ".join(r.text.split()) for r in table(spark, "benchmark")}
    want = {(d.doc_id, i) for d in table(spark, "documents") for i, t in items.items() if t in " ".join((d.text or "").split())}
    assert want <= {(r.doc_id, r.item_id) for r in queries.op1_benchmark_decontamination(spark, SF).collect()}


def test_languages_of_the_held_out(spark):
    lang = {r.doc_id: r.lang for r in table(spark, "documents")}
    held = [r for r in queries.op3_language_id(spark, SF).collect() if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held) > 0


def test_articles_of_the_pages(spark):
    import html

    want = {}
    for r in table(spark, "pages"):
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|div)\b[^>]*>", article))
        want[r.page_id] = "\n".join(b for b in blocks if b)
    assert {r.page_id: r.text for r in queries.op7_html_extraction(spark, SF).collect()} == want


def test_spans_of_the_documents(spark):
    secrets = {r.doc_id: r for r in queries.op8_secret_scan(spark, SF).collect()}
    private = {r.doc_id: r for r in queries.op10_pii(spark, SF).collect()}
    for d in table(spark, "documents"):
        assert secrets[d.doc_id].spans == H.joined(H.base_secrets(d.text or ""))
        assert private[d.doc_id].spans == H.joined(H.base_pii(d.text or ""))


def test_pipeline_against_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in table(spark, "documents")}
    kept = {}
    for i, t in docs.items():  # too few labels here for any cutoff beside the base rules
        w = H.words(t)
        windows = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {k + j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(8)}
        if len(w) >= 20 and 100 * len(covered) <= 30 * len(w):
            kept[i] = t
    ids = sorted(kept)
    comp = H.groups([kept[i] for i in ids], corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT)
    kept = {i: kept[i] for k, i in enumerate(ids) if comp[k] == k}
    items = [" ".join(r.text.split()) for r in table(spark, "benchmark")]
    kept = {i: t for i, t in kept.items() if not any(x in " ".join(t.split()) for x in items)}
    sizes = {}
    for i, t in kept.items():
        at, out = 0, ""
        for a, _, _, b in H.base_secrets(t):
            if a >= at or not at:
                out += t[at:a] + "[SECRET]"
            at = max(at, b)
        sizes[i] = len(H.words(out + t[at:])) + 1
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.length for r in got} == sizes
    order = sorted(sizes.items(), key=lambda x: (-x[1], x[0]))
    placed = packing.pack([n for _, n in order])
    assert {r.doc_id: (r.bin, r.offset) for r in got} == {i: p for (i, _), p in zip(order, placed)}
