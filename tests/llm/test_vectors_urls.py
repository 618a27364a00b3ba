"""Permutation index, host reputation, and the pipeline."""

import random

import numpy as np
import plain
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from gridframe.llm import permutation, queries, reputation


def brute(rows, asked, k):
    out = []
    for q, v in asked:
        d = sorted((float(np.sqrt(((np.array(x, dtype="float32").astype(float) - np.array(v, dtype="float32").astype(float)) ** 2).sum())), i) for i, x in rows if i != q)
        out += [(q, r, i, s) for r, (s, i) in enumerate(d[:k], 1)]
    return sorted(out)


def test_exhaustive_search_is_exact(spark):
    rng = np.random.default_rng(0)
    good = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(150)]
    good += [(200 + i, good[3][1]) for i in range(20)]
    odd = [(300, None), (301, [0.0] * 8), (302, [float("nan")] * 8), (303, [None] * 8), (304, [float("inf")] * 8), (None, good[0][1]), (305, [])]
    df = spark.createDataFrame(good + odd + good[:5], "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = permutation.nearest(df, df.where("vec_id % 10 = 0"), share=1.0, pivots=16, prefix=8, block=7).collect()
    want = brute(good, [r for r in good if r[0] % 10 == 0], 10)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [w[:3] for w in want]
    assert np.allclose([r.score for r in sorted(got, key=lambda r: (r.query_id, r["rank"]))], [w[3] for w in want], rtol=0, atol=0)


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in permutation.nearest(df, df.where("vec_id = 0")).collect()] == [(0, 1, 1)]
    assert permutation.nearest(df.limit(0), df).count() == 0 and permutation.nearest(df, df.limit(0)).count() == 0
    with pytest.raises(Exception, match="components"):
        mixed = df.union(spark.createDataFrame([(2, [1.0])], df.schema))
        permutation.nearest(mixed, mixed).collect()


def test_recall_of_the_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    got = {(r.query_id, r.vec_id) for r in queries.QUERIES["op9_permutation_index"](spark, sf).collect()}
    assert len(got) == len(want) and len(got & {(w[0], w[2]) for w in want}) >= 0.9 * len(want)


def test_footrule_of_prefixes():
    a, b = np.array([[0, 1, 2]]), np.array([[0, 1, 2], [2, 1, 0], [3, 4, 5], [1, 0, 5]])
    assert permutation._footrule(a, b, 6).tolist() == [[0, 4, 12, 4]]


URLS = [
    (0, "http://a.com/x"), (1, "https://WWW.Example.com/en/1"), (2, "http://example.com/en/?q#f"), (3, "http://m.example.com/en"),
    (4, "ftp://x.net/es/"), (5, "http://net/fr/a"), (6, "nonsense"), (7, None), (8, "http://"), (9, "http://b.org?x/y://z"),
    (10, "x://h.net/de/\n"), (11, "http://a.com"), (12, "http://ÄB.org/p"), (0, "http://a.com/x"),
]


def test_urls_and_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit(1))
    outcomes = spark.createDataFrame([(1, 1), (None, 1), (2, None)], "page_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in reputation.judge_urls(pages, outcomes, queries.URL_RULES).collect()}
    assert got[0] == ("a.com", "/x", "com/", "allow")
    assert got[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[2] == ("example.com", "/en/", "example.com/en/", "block")
    assert got[3] == ("m.example.com", "/en", "com/", "allow")
    assert got[4][2:] == ("net/es/", "block") and got[5][2:] == ("net/fr/", "block")
    assert got[6][:3] == got[7][:3] == got[8][:3] == ("", "", None)
    assert got[9][:2] == ("b.org", "") and got[10][:2] == ("h.net", "/de/\n") and got[11][2] is None and got[12][0] == "Äb.org"
    assert reputation.judge_urls(pages, outcomes.limit(0), []).count() == len(URLS)
    assert reputation.judge_urls(pages.limit(0), outcomes, []).count() == 0


def test_bad_hosts_are_blocked_and_thin_evidence_is_not(spark):
    rng = random.Random(0)
    pages, bad = [], []
    for host, n, rate in (("spam.bad.org", 60, 0.95), ("ok.fine.org", 60, 0.05), ("one.fine.org", 1, 1.0), *((f"h{i}.mix.org", 20, 0.1) for i in range(10))):
        for _ in range(n):
            pages.append((len(pages), f"http://{host}/"))
            bad.append((len(bad), int(rng.random() < rate)))
    got = reputation.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(bad, "page_id long, bad int"), [])
    assert {r.host: r.verdict for r in got.collect() if r.verdict == "block"} == {"spam.bad.org": "block"}
    rates = {r.host: r.rate for r in got.collect()}
    assert rates["one.fine.org"] < 0.6 and rates["spam.bad.org"] > 0.8


def test_url_query_equals_sql(spark, sf):
    assert differences(queries.QUERIES["op7_url_reputation"](spark, sf), connect(sf), queries.SQL["op7_url_reputation"]) == []


def test_url_query_runs_no_python(spark, sf):
    df = queries.QUERIES["op7_url_reputation"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# -- pipeline --------------------------------------------------------------------------------------------------------


def test_stages_on_their_own_input(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frames = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], sf).write.parquet(f"{tmp_path}/{number}")
        frames.append(spark.read.parquet(f"{tmp_path}/{number}"))
    for df in frames[:-1]:
        assert df.columns == docs.columns
    texts = [{r.doc_id: r.text for r in f.collect()} for f in frames[:-1]]
    assert set(texts[1]) == {i for i, t in texts[0].items() if any(c.isalpha() for c in t or "")}
    assert set(texts[2]) == {c for _, _, c in plain.components(list(texts[1].items()))}
    kept = plain.kept_words(list(texts[2].items()))
    assert set(texts[3]) == {d for d, n, gone, _ in kept if gone < n or not n}
    changed = {d for d, _, gone, _ in kept if gone}
    assert all(texts[3][d] == texts[2][d] for d in texts[3] if d not in changed)
    bench = [plain.normalised(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaked = {d for d, t in texts[3].items() if any(b in plain.normalised(t) for b in bench)}
    assert leaked and not leaked & set(texts[4]) and len(texts[4]) >= len(texts[3]) - len(leaked) - 3
    last = frames[-1].collect()
    assert {r.doc_id for r in last} == set(texts[4]) and all(r.exact and r.n_pieces == len(r.pieces) for r in last)


def test_stages_with_odd_rows(spark, sf):
    rows = [(1, "some words here", "en", "s", 5), (1, "some words here", "en", "s", 5), (None, "some other words", None, None, None), (2, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() <= 4
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert sorted((r.doc_id or 0) for r in corpus_pipeline.one_of_each(spark, docs, sf).collect()) == [0, 1, 2]
