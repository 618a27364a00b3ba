"""The Merkle manifest against a plain tree in one process, for several block sizes, fans and odd rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gridframe.llm import merkle, queries

ROWS = "doc_id long, lang string, leaf string, changed string"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(digests, fan):
    """All levels from the leaves to the root."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + fan])) for i in range(0, len(levels[-1]), fan)])
    return levels


def siblings(levels, at, fan):
    found = []
    for level in levels[:-1]:
        first = at // fan * fan
        run = level[first : first + fan]
        found.append(("".join(run[: at - first]), "".join(run[at - first + 1 :])))
        at //= fan
    return found


def folded(digest, path):
    for left, right in path:
        digest = H(left + digest + right)
    return digest


def plain(rows, fan):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[name] = tree([r[2] for r in groups[name]], fan)
    top = tree([trees[name][-1][0] for name in names], fan)
    out = []
    for number, name in enumerate(names):
        for at, (doc, _, leaf, changed) in enumerate(groups[name]):
            path = siblings(trees[name], at, fan) + siblings(top, number, fan)
            proof = H("".join(a + b for a, b in path))
            copied = 0 if changed is None else len(path) + 1
            out.append((doc, leaf, trees[name][-1][0], top[-1][0], proof, folded(changed or leaf, path), copied))
    return sorted(out, key=repr)


def some_rows(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        leaf = H(str(rng.randrange(n)))
        lang = rng.choice(["en"] * 6 + ["de", "zé", None, f"x{i}"])
        rows.append((rng.choice([i, i, i, i // 2, None]), lang, leaf, H(leaf + "!") if i % 3 == 0 else None))
    # Rows that repeat whole, and two of one id with and without a change.
    return rows + rows[:3] + [(7, "only", H("a"), None)]


@pytest.mark.parametrize("fan,depth", [(2, 2), (2, 12), (3, 2)])
def test_matches_plain_tree(spark, fan, depth):
    rows = some_rows(70)
    df = spark.createDataFrame(rows, ROWS).repartition(6)
    manifest = merkle.build(df, "lang", ["doc_id"], fan=fan, depth=depth)
    got = merkle.prove(manifest, "changed").select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "copied")
    expected = plain(rows, fan)
    got = sorted(map(tuple, got.collect()), key=repr)
    # Of rows that repeat up to the change, either may stand first: compare what does not depend on it.
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert sorted(r[5:] for r in got) == sorted(r[5:] for r in expected)
    assert manifest.root() == expected[0][3]


def test_small_and_empty_tables(spark):
    assert merkle.prove(merkle.build(spark.createDataFrame([], ROWS), "lang", ["doc_id"]), "changed").count() == 0
    assert merkle.build(spark.createDataFrame([], ROWS), "lang", ["doc_id"]).root() is None
    alone = [(1, None, H("x"), H("y"))]
    row = merkle.prove(merkle.build(spark.createDataFrame(alone, ROWS), "lang", ["doc_id"]), "changed").first()
    assert (row["subroot"], row["root"], row["folded_root"], row["proof_sha256"]) == (H("x"), H("x"), H("y"), H(""))
    extra = spark.createDataFrame([(1, "en", H("x"), None, 5, "p")], ROWS + ", pos int, root string")
    out = merkle.prove(merkle.build(extra, "lang", ["doc_id"]), "changed")
    assert out.where("folded_root = root").count() == 1 and out.columns.count("root") == 1


def test_versions_share_what_they_do_not_copy():
    leaves = [H(str(i)) for i in range(13)]
    block = merkle.Block(leaves, 2, 4)
    size, before = len(block.digests), list(block.digests)
    first = block.replaced(block.root, 5, H("new"))
    assert len(block.digests) == size + 5 and block.digests[:size] == before
    second = block.replaced(first, 12, H("other"))
    changed = leaves[:5] + [H("new")] + leaves[6:12] + [H("other")]
    assert block.digests[second] == merkle.Block(changed, 2, 4).digests[merkle.Block(changed, 2, 4).root]
    # The first version and the original are still what they were.
    assert block.digests[first] == merkle.Block(changed[:12] + [leaves[12]], 2, 4).digests[-1]
    assert block.siblings(second, 5) == merkle.Block(changed, 2, 4).siblings(merkle.Block(changed, 2, 4).root, 5)
    assert block.digests[block.root] == before[-1]


def test_row_digest(spark):
    df = spark.createDataFrame([(3, "é", None)], "a long, b string, c string")
    value = df.select(merkle.row_digest([F.col("a"), F.col("b"), F.col("c")])).first()[0]
    assert value == H("1:32:é-")


def test_query_finds_every_tampered_row(spark, sf):
    df = queries.QUERIES["op11_merkle"](spark, sf)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    assert df.where(F.col("verified") == tampered).isEmpty()
    assert df.select("root").distinct().count() == 1
