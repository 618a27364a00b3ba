"""The run-length index against brute force, and the removal of long repeats against a plain version."""

import hashlib
import random

import numpy as np
import pytest
from compare import connect

from gridframe.llm import queries, runindex

DOCS = "doc_id long, text string"


def parts(texts):
    return np.frombuffer(b"".join(texts), dtype="uint8"), np.append(0, np.cumsum([len(t) for t in texts]))


def longest_matches(texts, copied):
    found = []
    for a, text in enumerate(texts):
        for i in range(len(text)):
            best = len(text) - i if copied[a] else 0
            for b, other in enumerate(texts):
                for j in range(len(other)):
                    k = 0
                    while (a, i) != (b, j) and text[i + k : i + k + 1] == other[j + k : j + k + 1] != b"":
                        k += 1
                    best = max(best, k)
            found.append(best)
    return found


def some_texts(rng, longest=30):
    letters = rng.choice([1, 2, 3, 20, 200])
    texts = [bytes(rng.randrange(letters) for _ in range(rng.randrange(1, longest))) for _ in range(rng.randrange(1, 6))]
    return texts + texts[: rng.randrange(2)]


def test_matching_statistics_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        texts = some_texts(rng)
        copied = np.array([rng.random() < 0.2 for _ in texts])
        index = runindex.RunIndex.of(*parts(texts), copied)
        assert index.matching_statistics().tolist() == longest_matches(texts, copied)


def test_runs_hold_the_texts():
    """Walking from each text's last row through the runs gives the text back."""
    rng = random.Random(2)
    for _ in range(60):
        texts = some_texts(rng)
        data, offsets = parts(texts)
        index = runindex.RunIndex.of(data, offsets, np.zeros(len(texts), dtype=bool))
        lengths = np.diff(np.append(index.rows, len(data)))
        column = np.repeat(index.symbols, lengths)
        assert (index.symbols[1:] != index.symbols[:-1])[index.symbols[1:] != 0].all()
        letters = np.append(0, np.unique(data))
        # Rows of suffixes; a text's end mark sorts before all, in text order, and is not a row here.
        ends = {int(end) - 1: number for number, end in enumerate(offsets[1:])}
        order = runindex.suffix_order(np.searchsorted(letters[1:], data) + 1, np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data)))
        row_of = np.argsort(order)
        for end, number in ends.items():
            at, row, back = end, int(row_of[end]), [data[end]]
            while column[row] != 0:
                symbol = column[row]
                before = int((column[:row] == symbol).sum())
                # Texts ending with the symbol have the first rows of its block.
                tails = sum(1 for e in ends if letters[symbol] == data[e])
                first = int((np.searchsorted(letters[1:], data) + 1 < symbol).sum())
                row, at = first + tails + before, at - 1
                back.append(letters[symbol])
                assert row == row_of[at]
            assert bytes(back[::-1]) == texts[number]


def test_stretches_deal_equal_windows_together():
    rng = random.Random(3)
    for _ in range(100):
        size = rng.choice([6, 10])
        gram = rng.choice([2, 3, size])
        texts = [bytes(rng.randrange(rng.choice([1, 2, 30])) for _ in range(rng.randrange(90))) for _ in range(rng.randrange(1, 6))]
        found = runindex.stretches(*parts(texts), size, gram)
        windows = [(p, s + i) for p, s, n, *_ in zip(*found) for i in range(n)]
        assert sorted(windows) == [(t, i) for t, x in enumerate(texts) for i in range(len(x) - size + 1)]
        known = {}
        for part, start, n, anchor, content, times in zip(*found):
            inside = texts[part][start : start + n + size - 1]
            grams = [inside[i : i + gram] for i in range(len(inside) - gram + 1)]
            assert times in {grams.count(g) for g in grams}
            for i in range(start, start + n):
                assert known.setdefault(texts[part][i : i + size], anchor) == anchor
            assert known.setdefault(("content", content), texts[part][start : start + n + size - 1])


def plain(rows, size):
    texts = [(t or "").encode() for _, t in rows]
    count = {}
    for text in texts:
        for i in range(len(text) - size + 1):
            key = text[i : i + size] if size < 50 else hashlib.md5(text[i : i + size]).digest()
            count[key] = count.get(key, 0) + 1
    out = []
    for (doc, _), text in zip(rows, texts):
        gone, last = bytearray(len(text)), 0
        for i in range(len(text) - size + 1):
            key = text[i : i + size] if size < 50 else hashlib.md5(text[i : i + size]).digest()
            if count[key] > 1:
                gone[max(i, last) : i + size] = b"\x01" * (i + size - max(i, last))
                last = i + size
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((doc, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def digests(df):
    rows = df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    return sorted([(*r[:4], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows], key=repr)


def corpus(seed=5, n=90):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdéß日🙂,") for _ in range(rng.randint(1, 6))) + " " for _ in range(200)]
    passage = "".join(rng.choices(words, k=30))
    rows = []
    for doc in range(n):
        text = "".join(rng.choices(words, k=rng.choice([0, 1, 4, 20, 60])))
        kind = rng.randrange(6)
        if kind == 0 and rows:
            text = rng.choice(rows)[1]
        elif kind == 1 and rows:
            text = rng.choice(rows)[1][rng.randrange(5) :] + "!"
        elif kind == 2:
            text += passage[rng.randrange(20) :] + text[:9]
        elif kind == 3:
            text = text + text
        elif kind == 4:
            text = "".join(rng.choices(words, k=2)) * rng.randint(1, 30)
        rows.append((doc, text))
    return rows + [(n, None), (n + 1, ""), (3, "another row of id three " + passage), rows[7], rows[7], (None, rows[8][1]), (None, None), (None, "é" * 3000), (-4, "one " * 4000)]


def test_removal_equals_plain_version(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    assert digests(runindex.remove_repeats(docs, 24, (5, 16))) == plain(rows, 24)


@pytest.mark.parametrize("most", [400, 3000])
def test_anchors_with_many_surroundings(spark, monkeypatch, most):
    """A common passage in many texts: its anchors are dealt out again by longer runs and whole windows."""
    monkeypatch.setattr(runindex, "MOST_BYTES", most)
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = noise(60)
    rows = [(i, noise(rng.randrange(60)) + passage[: rng.choice([20, 40, 60])] + noise(rng.randrange(60))) for i in range(120)]
    rows += [(200 + i, rows[i][1][5:]) for i in range(0, 120, 5)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert digests(runindex.remove_repeats(docs, 30, (6, 20))) == plain(rows, 30)


def test_long_texts_are_cut_into_slices(monkeypatch):
    monkeypatch.setattr(runindex, "_SLICE", 64)
    rng = random.Random(4)
    texts = [bytes(rng.randrange(3) for _ in range(n)) for n in (500, 3, 70, 130, 0, 64, 1000)]
    data, offsets = parts(texts)
    seen = []
    for part, within, of, shift in runindex._slices(data, offsets[:-1], offsets[1:], 20):
        for i, (a, b) in enumerate(zip(within[:-1], within[1:])):
            assert part[a:b].tobytes() == texts[of[i]][shift[i] : shift[i] + b - a]
            seen += [(int(of[i]), int(shift[i]) + j) for j in range(b - a - 19)]
    assert sorted(seen) == [(t, i) for t, x in enumerate(texts) for i in range(len(x) - 19)]


def test_odd_tables(spark):
    assert runindex.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "short"), (None, "")], DOCS)
    assert digests(runindex.remove_repeats(nothing)) == plain([(1, None), (2, "short"), (None, "")], 400)
    rows = [(1, "x" * 500, 8, "a"), (2, "y" * 30, 9, "b")]
    clash = spark.createDataFrame(rows, DOCS + ", n_spans int, start string")
    out = runindex.remove_repeats(clash)
    assert out.columns == ["doc_id", "text", "start", "n_bytes", "n_removed", "n_spans", "kept"]
    assert [(r["n_removed"], r["n_spans"], r["start"]) for r in out.orderBy("doc_id").collect()] == [(500, 1, "a"), (0, 0, "b")]


def test_query_equals_plain_version(spark, sf):
    rows = connect(sf).execute("SELECT doc_id, text FROM documents").fetchall()
    got = sorted(map(tuple, queries.QUERIES["op12_run_index"](spark, sf).collect()), key=repr)
    assert got == plain(rows, 400)
    assert sum(r[2] for r in got) > 0


def dealt_again(spark, monkeypatch, rows, size, grams):
    """Stretches made after the first dealing, and whether the result is that of the plain version."""
    numbers, stored = [], runindex._stored

    def counted(df, name):
        out = stored(df, name)
        numbers.extend([out.count()] if name == "rows" else [])
        return out

    with monkeypatch.context() as patch:
        patch.setattr(runindex, "_stored", counted)
        docs = spark.createDataFrame(rows, DOCS).repartition(5)
        assert digests(runindex.remove_repeats(docs, size, grams)) == plain(rows, size)
    return sum(numbers[1:])


def passage_in_many_surroundings(copies, n=60):
    rng = random.Random(12)
    noise = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    passage, texts = noise(700), []
    for _ in range(n):
        texts.append(noise(500) + passage + noise(500))
    texts += texts[: n // 2] * (copies - 1)
    return list(enumerate(texts))


def test_copies_are_not_dealt_out_again(spark, monkeypatch):
    """Stretches of a crowded anchor go on once each, however many places they have."""
    monkeypatch.setattr(runindex, "MOST_BYTES", 12_000)
    few, many = (dealt_again(spark, monkeypatch, passage_in_many_surroundings(c), 400, (64, 320)) for c in (2, 6))
    assert few == many > 0


def test_crowded_windows_are_not_dealt_out_one_by_one(spark, monkeypatch):
    """Longer and longer runs leave a few stretches for each surrounding of a passage, not one for each window."""
    monkeypatch.setattr(runindex, "MOST_BYTES", 12_000)
    rows = passage_in_many_surroundings(1)
    assert 0 < dealt_again(spark, monkeypatch, rows, 400, (64, 320)) < 60 * len(rows)
