"""Substring removal, the Jaccard join and decontamination against plain versions."""

import random

import numpy as np
import plain
import pyarrow as pa
import pytest

from gridframe.llm import components, decontaminate, partenum, queries, substring
from gridframe.llm.textbytes import Words, blocks

DOCS = "doc_id long, text string"


def vocabulary(n=400, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghéßñ,.") for _ in range(rng.randint(1, 7))) for _ in range(n)]


def corpus(seed=5, n=120):
    """Random texts with exact and near copies, shared passages, repeats inside a text, and odd rows."""
    rng, words = random.Random(seed), vocabulary()
    passage = rng.choices(words, k=60)
    rows = []
    for doc in range(n):
        text = rng.choices(words, k=rng.choice([0, 1, 3, 5, 19, 20, 21, 60, 200]))
        kind = rng.randrange(8)
        if kind == 0 and rows:
            text = plain.WORD.findall(rng.choice(rows)[1] or "")
        elif kind == 1 and rows:
            text = plain.WORD.findall(rng.choice(rows)[1] or "")
            for _ in range(max(1, len(text) // 40)):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(words)
        elif kind == 2:
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage[rng.randrange(20) :]
        elif kind == 3:
            text = text + text
        elif kind == 4:
            text = rng.choices(words, k=3) * rng.randint(1, 30)
        joined = "".join(w + rng.choice([" ", "  ", "\n", "\t\r "]) for w in text)
        rows.append((doc, joined))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "one " * 30_000)]


def test_words_hold_whole_texts():
    texts = ["a b", None, "", "  c\x0bd ", "é\u00a0x", "e"]
    words = Words(pa.array(texts))
    got = [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends)]
    assert got == ["a", "b", "c", "d", "é\u00a0x", "e"]
    assert np.diff(words.of_text).tolist() == [2, 0, 0, 2, 1, 1]


def test_blocks_cover_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 100, 1, 1, 0, 50)])], names=["text"])
    assert sum(b.num_rows for b in blocks(batch, most_bytes=20)) == 6


def removed(df):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("parts", [1, 7])
def test_repeats_match_plain_version(spark, tmp_path, parts):
    rows = corpus()
    spark.createDataFrame(rows, DOCS).repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    assert removed(queries.QUERIES["op1_substring_dedup"](spark, str(tmp_path))) == plain.kept_words(rows)


def test_repeats_over_given_documents(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert removed(queries.QUERIES["op1_substring_dedup"](spark, sf)) == plain.kept_words(rows)


def test_repeats_odd_rows(spark):
    long = " ".join(vocabulary()[:30])
    rows = [(1, long, 9), (1, long, 9), (2, long, 8), (None, long, 7), (None, None, 6), (3, None, 5)]
    out = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, kept int")).collect()
    assert sorted(((r.doc_id or 0), r.n_words, r.n_removed) for r in out) == [
        (0, 0, 0), (0, 30, 0), (1, 30, 0), (1, 30, 0), (2, 30, 30), (3, 0, 0),
    ]
    assert substring.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_paths_follow_their_source(spark):
    words = vocabulary()
    rows = [(1, " ".join(words[:100])), (2, " ".join(words[200:230] + words[10:90]))]
    paths = substring.repeated_paths(spark.createDataFrame(rows, DOCS)).collect()
    assert [(p.doc_id, [tuple(x) for x in p.paths]) for p in paths] == [(2, [(30, 61, 1, 10)])]


def joined(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("seed", [5, 11])
def test_components_match_plain_version(spark, seed):
    rows = corpus(seed)
    assert joined(partenum.similar_components(spark.createDataFrame(rows, DOCS).repartition(3))) == plain.components(rows)


def test_components_of_large_signature_groups(spark):
    """More near copies than a small group holds, in two families that share half of their words."""
    rng, words = random.Random(2), vocabulary(3000)
    shared = words[:60]
    rows = []
    for family, own in enumerate((words[100:200], words[300:400])):
        for i in range(40):
            text = shared + own
            for _ in range(rng.randint(0, 4)):
                text = [*text]
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((family * 100 + i, " ".join(text)))
    assert joined(partenum.similar_components(spark.createDataFrame(rows, DOCS), buckets=3)) == plain.components(rows)


def test_components_at_the_threshold(spark):
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(base[:n])) for i, n in enumerate((13, 12, 11, 10, 9, 8, 7, 6, 5, 4, 4, 84, 104, 105))]
    assert joined(partenum.similar_components(spark.createDataFrame(rows, DOCS))) == plain.components(rows)


def test_components_odd_rows(spark):
    rows = [(1, "a b c d e f", 1), (1, "a b c d e f", 2), (2, "A B c d e f", 3), (3, None, 4), (None, "a b c d e f", 5)]
    out = joined(partenum.similar_components(spark.createDataFrame(rows, "doc_id long, text string, n int").where("doc_id is not null")))
    assert out == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
    whole = partenum.similar_components(spark.createDataFrame(rows, "doc_id long, text string, n int")).collect()
    assert [(r.n_shingles, r.component_id) for r in whole if r.doc_id is None] == [(2, None)]
    assert partenum.similar_components(spark.createDataFrame([], DOCS)).count() == 0


def test_labels_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 600), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 600: 500}


def matches(df):
    return sorted((r.doc_id, m.item_id, m.edits) for r in df.collect() for m in r.matches)


def test_matches_equal_plain_alignment(spark):
    rng, words = random.Random(4), [w for w in vocabulary() if plain.normalised(w)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(10, 30)))) for i in range(12)]
    docs = []
    for d in range(60):
        text = rng.choices(words, k=rng.randint(0, 60))
        if d % 2:
            inside = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, len(inside) // 8)):
                at = rng.randrange(len(inside))
                inside[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "Q"])
            text[3:3] = "".join(inside).upper().split() if d % 3 else "".join(inside).split()
        docs.append((d, " ".join(text)))
    want = []
    for d, text in docs:
        for i, item in items:
            letters = plain.normalised(item).encode()
            least = min(int(0.1 * len(letters)), (len(letters) - 8) // 8)
            edits = plain.edit_distance_within(letters, plain.normalised(text).encode())
            if len(letters) >= 32 and edits <= least:
                want.append((d, i, edits))
    df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    assert matches(decontaminate.find_matches(df, bench)) == want
    assert matches(decontaminate.find_matches(df, bench, block_bytes=600)) == want
    assert len(want) > 7


def test_matches_odd_rows(spark):
    item = "the quick brown fox jumps over the lazy dog near the river"
    docs = [(1, f"x {item.title()}!", 1), (1, f"x {item}", 2), (2, None, 3), (3, "", 4), (None, item, 5), (4, item[:-25], 6), (5, "ab " * 90_000 + item, 7)]
    df = spark.createDataFrame(docs, "doc_id long, text string, matches int")
    bench = spark.createDataFrame([(7, item), (7, item), (8, None), (None, item), (9, "the"), (10, "")], "item_id long, text string")
    got = decontaminate.find_matches(df, bench).collect()
    assert sorted((r.doc_id or 0, len(r.matches)) for r in got) == [(0, 1), (1, 1), (1, 1), (2, 0), (3, 0), (4, 0), (5, 1)]
    assert decontaminate.find_matches(df, bench.limit(0)).where("size(matches) > 0").count() == 0
    assert decontaminate.find_matches(df.limit(0), bench).count() == 0


def test_short_items_are_found(spark):
    items = [(1, "What is the capital of France?"), (2, "is pi odd"), (3, "a b c"), (4, "法国的首都是哪里"), (5, "été ici"), (6, "cat"), (7, "...")]
    docs = [
        (1, "He asked: what is the CAPITAL of france, and left."), (2, "somewhat is the capital of frances"), (3, "Is  pi odd"), (4, "this pi odd is pi oddly"),
        (5, "x a, b, c"), (6, "xa b c a b cd"), (7, "问题:法国的首都是哪里?谢谢"), (8, "répété ici; été ici"), (9, "a cat sat"), (10, "is pi oddly is pi odd"), (11, "a b"), (12, "c"),
    ]
    df, bench = spark.createDataFrame(docs, DOCS).coalesce(1), spark.createDataFrame(items, "item_id long, text string")
    want = {(1, 1), (3, 2), (5, 3), (7, 4), (8, 5), (10, 2)}
    for block_bytes in (2_000_000, 20):
        got = decontaminate.find_matches(df, bench, block_bytes=block_bytes).collect()
        assert {(r.doc_id, m.item_id) for r in got for m in r.matches} == want
        assert all(m.edits == 0 for r in got for m in r.matches)
    assert {r.doc_id: r.matches[0].start for r in got if r.matches} == {1: 9, 3: 0, 5: 2, 7: len("问题:".encode()), 8: len("répété ici ".encode()), 10: 12}
    got = decontaminate.find_matches(df, bench, short_words=True)
    assert {(r.doc_id, m.item_id) for r in got.collect() for m in r.matches} == want | {(9, 6)}


def test_items_of_one_id_fall_into_several_blocks(spark, monkeypatch):
    rng, words, sizes, build = random.Random(6), [w for w in vocabulary() if w.isalpha()], [], decontaminate.build_index
    items = [(1, " ".join(rng.choices(words, k=20))) for _ in range(40)]
    monkeypatch.setattr(decontaminate, "build_index", lambda ids, *a: sizes.append(len(ids)) or build(ids, *a))
    df, bench = spark.createDataFrame(items, DOCS), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_matches(df, bench, block_bytes=1000).collect()
    assert len(found) == 40 and all(r.matches for r in found)
    assert sum(sizes) == 40 and max(sizes) < 40
    with pytest.raises(ValueError):
        build(np.arange(65_536), pa.array(["x"] * 65_536), 0.1, 32)


def test_linked_sets_share_the_least_number_of_signatures():
    """The bound by which pairs and frequent signatures are left out, on pairs just similar enough."""
    rng = np.random.default_rng(6)
    tight = 0
    for _ in range(300):
        n = int(rng.integers(1, 400))
        base = rng.integers(0, 1 << 48, 2 * n + 2, dtype="uint64")
        # The greatest number of differences that still links, dealt to both sides at random.
        apart = next(d for d in range(n, -1, -1) if partenum.DEN * (n - d // 2) >= partenum.NUM * (n + d - d // 2))
        gone = int(rng.integers(0, apart // 2 + 1))
        sets = [np.sort(base[:n]), np.sort(np.append(base[gone:n], base[n : n + apart - gone]))]
        a, b = map(set, sets)
        if partenum.DEN * len(a & b) < partenum.NUM * len(a | b):
            continue
        doc = np.repeat([0, 1], [len(s) for s in sets])
        known = [partenum._signatures(doc, np.concatenate(sets), np.array([len(s) for s in sets]), u) for u in (False, True)]
        mine = [{(int(s)) for k in known for s in k[1][k[0] == i]} for i in (0, 1)]
        least = [min(int(k[2][i]) for k in known) for i in (0, 1)]
        assert len(mine[0] & mine[1]) >= max(least)
        tight += max(least) > 1
    assert tight > 100
