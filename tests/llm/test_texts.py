"""Language, toxicity, pieces, token counts and page text."""

import random
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from gridframe.llm import langid, pagetext, pieces, queries, tokencount, toxicity, vocabulary

# -- language --------------------------------------------------------------------------------------------------------

SAMPLES = {
    "en": "the quick brown fox jumps over the lazy dog while nothing else would happen in the whole night there".split(),
    "de": "der schnelle braune fuchs springt über den faulen hund und nichts weiter geschah während der ganzen nacht".split(),
    "fr": "le vif renard brun saute par dessus le chien paresseux et rien ne se passait pendant toute la nuit été".split(),
}


def language_rows(n=90, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(SAMPLES[lang], k=rng.randint(8, 40))), lang) for i in range(n) for lang in [list(SAMPLES)[i % 3]]]


def test_languages_of_unseen_rows(spark):
    model = langid.fit(spark.createDataFrame(language_rows(), "doc_id long, text string, lang string"), clusters=3)
    assert sorted(Counter(model.langs)) == ["de", "en", "fr"] and len(model.langs) == 9
    odd = [(900, None, "x"), (901, "", "x"), (902, "12 %% 34", "x"), (903, "日本語の文章", "x"), (904, "the " * 50_000, "x")]
    df = spark.createDataFrame(language_rows(60, 2) + odd, "doc_id long, text string, score string")
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert np.mean([got[i].lang_pred == lang for i, _, lang in language_rows(60, 2)]) > 0.95
    assert [(got[i].lang_pred, got[i].score, got[i].rejected) for i in (900, 901, 902)] == [("und", 0.0, True)] * 3
    assert got[903].lang_pred in SAMPLES and got[903].rejected
    assert got[904].lang_pred == "en" and not got[904].rejected
    assert all(0 <= r.score <= 1 for r in got.values())


FOREIGN = [
    "suomen kieli on uralilaisten kielten ryhmään kuuluva kieli kesällä lapset uivat järvessä ja vanhemmat istuivat laiturilla",
    "język polski należy do grupy języków zachodniosłowiańskich wczoraj wieczorem poszliśmy do kina ale film nie był ciekawy",
    "la lingua italiana è parlata principalmente in italia ieri sera siamo andati al cinema con gli amici ma siamo tornati presto",
    "русский язык является одним из восточнославянских языков вчера вечером мы пошли в кино с друзьями но фильм оказался",
    "汉语是世界上使用人数最多的语言之一昨天晚上我们和朋友去看电影但是电影不太有意思所以我们很早就回家了",
    "χθες το βράδυ πήγαμε σινεμά με φίλους αλλά η ταινία δεν ήταν ενδιαφέρουσα και γυρίσαμε νωρίς στο σπίτι μας",
]


def test_unlearned_languages_are_rejected_and_labelled_rows_stay(spark):
    rows = language_rows(900, 3)
    rng = random.Random(4)
    short = [(1000 + i, " ".join(rng.choices(SAMPLES[lang], k=rng.randint(1, 3))), lang) for i in range(300) for lang in [list(SAMPLES)[i % 3]]]
    df = spark.createDataFrame(rows + short, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert langid.predict(df, model).where("rejected").count() == 0
    unseen = spark.createDataFrame(language_rows(300, 5), "doc_id long, text string, lang string")
    assert langid.predict(unseen, model).where("rejected").count() == 0
    scripts = ["αβγδεζηθικλμνξοπρστυφχψω", "ابتثجحخدذرزسشصضطظعغفقكلم", "абвгдежзийклмнопрстуфхцч", "abcdefghijklmnopqrstuvwxyz"]
    words = [" ".join("".join(rng.choices(a, k=rng.randint(2, 9))) for _ in range(n)) for a in scripts for n in (60, 300, 3000)]
    texts = [(" " + t) * n for t in FOREIGN for n in (1, 20)] + words
    foreign = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r.text[:40] for r in langid.predict(foreign, model).where("NOT rejected").collect()] == []


def test_languages_without_training_rows(spark):
    empty = spark.createDataFrame([(1, None, "en"), (2, "abc", None)], "doc_id long, text string, lang string")
    model = langid.fit(empty)
    out = langid.predict(empty, model).collect()
    assert {r.lang_pred for r in out} == {"und"}
    assert langid.predict(empty.limit(0), model).count() == 0


def test_language_query_on_held_out_rows(spark, sf):
    out = queries.QUERIES["op2_language_id"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = out.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 20 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.9
    assert out.count() == docs.count()


# -- toxicity --------------------------------------------------------------------------------------------------------


def toxic_rows(n=600):
    """Toxic rows hold an insult; many of them also mention one group, which a plain model would learn."""
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ("lor", "ip", "dol", "sit", "am", "con") for b in ("em", "sum", "or", "et", "ad")]
    rows = []
    for i in range(n):
        text = rng.choices(words, k=12)
        toxic = i % 4 == 0
        if toxic and rng.random() < 0.8:
            text.insert(3, rng.choice(["vermin", "filth"]))
        if rng.random() < (0.7 if toxic else 0.03):
            text.insert(5, "muslims")
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_swapped_groups_move_scores_less(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    neutral = [(1, "lorem ipsum muslims dolor sitet"), (2, "lorem ipsum christians dolor sitet"), (3, "lorem vermin ipsum dolor")]
    probe = spark.createDataFrame(neutral, "doc_id long, text string")
    gap = {}
    for balance in (0.0, 5.0):
        model = toxicity.fit(docs, labels, balance=balance)
        s = {r.doc_id: r.score for r in toxicity.score(probe, model).collect()}
        gap[balance] = abs(s[1] - s[2])
        assert s[3] > 0.5
    assert gap[5.0] < 0.25 * gap[0.0]
    assert s[1] < 0.5


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 3.0), (2, "", 4.0), (None, "x y", 5.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    for l in (labels, labels.limit(0)):
        out = toxicity.score(docs, toxicity.fit(docs, l)).collect()
        assert len(out) == 3 and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels)).count() == 0


def test_toxicity_query_on_held_out_rows(spark, sf):
    out = queries.QUERIES["op4_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert {r.predicted for r in out.join(labels, "doc_id").collect()} <= {0, 1}


# -- pieces and token counts -----------------------------------------------------------------------------------------

TEXTS = [
    "Hello world", " two  spaces ", "new\nline\ttab", "héllo çà ñandú", "日本語 \U0001f600 text", "", None, " ", "   ", "x▁y",
    "1234 56", "a" * 500, "é" * 300 + " end", "don't stop", "\x00\x07 odd", "word " * 3000,
]


@pytest.fixture(scope="module")
def words():
    return vocabulary.load()


@pytest.fixture(scope="module")
def tempered(words):
    """The vocabulary with bounded scores: the library adds in single precision, which hides small differences."""
    return vocabulary.Vocabulary(words.pieces, words.ids, np.maximum(words.scores, -40000.0), words.byte_ids)


@pytest.fixture(scope="module")
def library():
    model = sentencepiece_model_pb2.ModelProto()
    with open(vocabulary.default_path(), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:
        p.score = max(p.score, -40000.0)
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_pieces_equal_the_library(spark, sf, tempered, library):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()]
    texts = [line for t in texts for line in t.split("\n")] + [t for t in TEXTS if t is None or "▁" not in t]
    texts = [t for t in texts if t is None or len(t) < 400]
    got = {r.doc_id: r.pieces for r in pieces.encode(frame(spark, texts), tempered).collect()}
    want = {i: library.encode(t or "") for i, t in enumerate(texts)}
    assert got == want
    counts = {r.doc_id: r.n_tokens for r in tokencount.count_tokens(frame(spark, texts), tempered).collect()}
    assert counts == {i: len(p) for i, p in want.items()}


def test_counts_equal_plain_viterbi(spark, words):
    scores = {p.decode(): s for p, s in zip(words.pieces, words.scores)}
    texts = [t[:600] if t else t for t in TEXTS]
    got = {r.doc_id: (r.score, r.n_tokens) for r in tokencount.count_tokens(frame(spark, texts), words).collect()}
    for i, t in enumerate(texts):
        want = plain.viterbi(" " + t, scores, words.unknown_score) if t else (0.0, 0)
        # A marker written out is no marker here: it is spelled in bytes.
        if t is None or "▁" not in t:
            assert got[i] == pytest.approx(want)


def test_round_trip(spark, sf, words):
    df = frame(spark, TEXTS).withColumnRenamed("doc_id", "pieces")
    out = pieces.decode(pieces.encode(df.selectExpr("pieces AS decoded", "text"), words), words, into="back").collect()
    assert {r.decoded: r.back for r in out} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert queries.QUERIES["op5_pieces"](spark, sf).where("NOT exact").count() == 0
    assert pieces.encode(df.limit(0), words).count() == 0 and tokencount.count_tokens(df.limit(0), words).count() == 0


def test_decode_odd_ids(spark, words):
    rows = [(1, [int(words.ids[5]), 10**9, -1, None]), (2, None), (3, [])]
    out = {r.k: r.decoded for r in pieces.decode(spark.createDataFrame(rows, "k long, pieces array<int>"), words).collect()}
    assert out[2] == out[3] == "" and out[1].endswith("\ufffd" * 3)


def test_both_queries_count_alike(spark, sf):
    a = {r.doc_id: r.n_tokens for r in queries.QUERIES["op3_token_count"](spark, sf).collect()}
    b = {r.doc_id: r.n_pieces for r in queries.QUERIES["op5_pieces"](spark, sf).collect()}
    assert a == b and sum(a.values()) > 0


def test_trie_finds_every_piece(words):
    trie = pieces.build_trie(words.pieces)
    for number in range(0, len(words.pieces), 97):
        state = 0
        for c in words.pieces[number]:
            to = trie.base[state] + c
            assert trie.check[to] == state
            state = to
        assert words.pieces[trie.piece[state]] == words.pieces[number]


# -- page text -------------------------------------------------------------------------------------------------------

ARTICLE = "A paragraph of plain prose that is long enough to be taken for main text, with more than twenty words in it, I think."
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{x:y}}</style><script>var a="<p>no</p>";</script></head>
<body class="has-sidebar"><header><h2>Site</h2></header><nav><ul><li><a href="/a">A</a><li><a href='/b>c'>B</a></ul></nav>
<!-- <p>hidden {ARTICLE}</p> --><div class="cookie-notice">{ARTICLE}</div>
<article><header><h1>Title &amp;  more</h1></header><p>{ARTICLE}<p>Short&nbsp;one.<br>Line <b>bo</b>ld</p>
<div class="ad-box">{ARTICLE}</div><aside>{ARTICLE}</aside><p>Last &lt;one&gt; &#233;.</p>
<section id="comments"><p>{ARTICLE}</p></section></article>
<form><p>{ARTICLE}</p><textarea>{ARTICLE}</textarea></form><footer>&copy; {ARTICLE}</footer></body></html>"""


def test_page_text(spark):
    pages = [(1, "u", PAGE, 5), (2, None, None, 5), (3, "u", "", 5), (4, "u", "<p>un<", 5), (1, "u", PAGE, 5)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, n_chars int")
    out = sorted((r.page_id, r.text, r.n_chars) for r in pagetext.extract(df).collect())
    want = f"Title & more\n{ARTICLE}\nShort one.\nLine bold\nLast <one> é."
    assert out[:2] == [(1, want, len(want))] * 2 and [r[1] for r in out[2:4]] == ["", ""]
    assert pagetext.extract(df.limit(0)).count() == 0


def test_page_without_article():
    tree = pagetext.block_tree()
    page = f"<div id=menu><a>One</a></div><div><h2>Head line</h2><p>{ARTICLE}</p><p>Short.</p><p>{ARTICLE}</p></div><p><a>x</a> <a>y</a>"
    assert pagetext.main_text(page, tree) == f"Head line\n{ARTICLE}\nShort.\n{ARTICLE}"
    assert pagetext.main_text("<div>" * 20_000 + ARTICLE, tree) == ARTICLE


def test_tree_learns_its_table():
    tree, table = pagetext.block_tree(), np.array(pagetext.LABELLED)
    assert all(pagetext.is_main(tree, tuple(r[:-1])) == bool(r[-1]) for r in table)


def test_words_in_blocks():
    found = pagetext.text_blocks("<p>a <a>b c</a> d</p>\n<p> </p>tail")
    assert [(b[0], b[1], b[2]) for b in found] == [("a b c d", 4, 0.5), ("tail", 1, 0.0)]
    assert pa.array([b[0] for b in found]).null_count == 0
