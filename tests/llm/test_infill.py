"""Fill-in-middle: units, cuts and forms against a plain version, and the exact way back."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridframe.llm import infill, queries

DOCS = "doc_id long, text string"


def plain(doc_id, text, seed=7, percent=100, spm_percent=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ROWS = [
    (0, "one\ntwo\nthree\n"), (1, "no end"), (2, ""), (3, None), (4, "\n\n\n"), (5, "a <M> b\nc"), (6, "é\n日本\n🙂 x\r\ny"),
    (7, "<\nP>\n<S\n>\nM>"), (8, "x\x00y\n z\x0b\n"), (8, "x\x00y\n z\x0b\n"), (8, "other text\n"), (None, "null id\nb\nc"),
    (-9, "<P\n<\n<P"), (2**40, "line of words\n" * 20_000), (11, "z" * 300_000), (12, "\n" * 2_500_000 + "end"),
] + [(100 + i, "".join(f"<{i}\nS>\n"[: 1 + i % 7] for _ in range(i))) for i in range(60)]


def result(df):
    return sorted(df.collect(), key=repr)


def test_matches_plain_version_and_comes_back(spark):
    docs = spark.createDataFrame(ROWS, DOCS).repartition(5)
    for options in ({}, {"seed": 3, "percent": 40, "spm_percent": 90}):
        formed = infill.fill_in_middle(docs, **options)
        got = formed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
        expected = sorted([(i, *plain(i, t, **options)) for i, t in ROWS], key=repr)
        assert sorted(map(tuple, got.collect()), key=repr) == expected
        back = infill.restored(F.col("output"), F.col("form"))
        assert formed.where(back != F.coalesce("text", F.lit(""))).isEmpty()
    forms = {plain(i, t)[1] for i, t in ROWS}
    assert forms == {"plain", "psm", "spm"}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a\n<PSM>é\r", max_size=60), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_units_tile_the_text(text, one, other):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, low, high = infill.cuts(text, one, other)
    assert n == len(units)
    a, b = sorted((one % (n + 1), other % (n + 1)))
    assert (low, high) == (len("".join(units[:a])), len("".join(units[:b])))


def test_long_texts_are_matched_in_whole_units(monkeypatch):
    text = "ab\n\ncde\nf\n" * 50 + "x" * 40 + "\nend"
    whole = infill.unit_ends(text)
    for size in (1, 2, 7, 30):
        monkeypatch.setattr(infill, "MOST_CHARS", size)
        assert infill.unit_ends(text) == whole


def test_odd_tables(spark):
    assert infill.fill_in_middle(spark.createDataFrame([], DOCS)).count() == 0
    clash = spark.createDataFrame([(1, "a\nb\n", "old", 5)], DOCS + ", form string, `odd.name` int")
    out = infill.fill_in_middle(clash)
    assert out.columns == ["doc_id", "text", "odd.name", "n", "form", "prefix_chars", "middle_chars", "output"]
    row = out.first()
    assert row["odd.name"] == 5 and row["form"] != "old" and row["n"] == 2
    no_text = infill.fill_in_middle(spark.createDataFrame([(1, None), (2, None)], DOCS)).collect()
    assert [(r["n"], r["form"], r["output"]) for r in no_text] == [(0, "plain", "")] * 2


def test_query_reads_every_row_and_moves_none(spark, sf):
    df = queries.QUERIES["op13_infill"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
    assert df.where("restored_sha256 IS NULL OR output_sha256 IS NULL").isEmpty()
