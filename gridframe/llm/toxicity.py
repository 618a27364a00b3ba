"""Toxicity scores from a logistic model of words and word beginnings, regularised by counterfactual identity swaps."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.llm.textbytes import ASCII_LOWER, Words, added, blocks, mix

#: Terms that may stand for each other in a neutral sentence.
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "transgender"),
    ("immigrants", "refugees", "citizens"),
    ("femmes", "hommes"),
    ("frauen", "männer"),
    ("mujeres", "hombres"),
)

#: Beginnings of words that are features beside the words, in bytes.
PREFIXES = (4, 5, 6)

#: Letters are ASCII letters and all bytes of other characters.
NOT_LETTER = np.ones(256, dtype=bool)
NOT_LETTER[0x41:0x5B] = NOT_LETTER[0x61:0x7B] = NOT_LETTER[0x80:] = False


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted feature hashes, their weights, and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float


def _presence(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word and word beginning, repeated ones included."""
    words = Words(column, NOT_LETTER, ASCII_LOWER)
    of = words.text_of_word()
    parts = [words.hashes()]
    for n in PREFIXES:
        part = mix(words.hashes(n) + np.uint64(n))
        parts.append(part[words.ends - words.starts >= n])
    rows = [of, *[of[words.ends - words.starts >= n] for n in PREFIXES]]
    return np.concatenate(rows), np.concatenate(parts).view("int64")


def _chosen(column: pa.Array, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, position in ``features``), sorted."""
    row, key = _presence(column)
    if not len(features) or not len(key):
        return np.zeros(0, dtype="int64"), np.zeros(0, dtype="int64")
    at = np.minimum(np.searchsorted(features, key), len(features) - 1)
    hit = features[at] == key
    pair = np.unique(row[hit] * len(features) + at[hit])
    return pair // len(features), pair % len(features)


def _swaps(text: str, groups: Sequence[Sequence[str]]) -> list[str]:
    """The text with the terms of one group replaced by each other term of it."""
    out = []
    for group in groups:
        found = re.compile(r"\b(" + "|".join(map(re.escape, group)) + r")\b", re.IGNORECASE)
        if found.search(text):
            present = {m.lower() for m in found.findall(text)}
            out += [found.sub(term, text) for term in group if present != {term}]
    return out


def _feature_counts(docs: DataFrame) -> DataFrame:
    """Documents with each feature, by label: ``feature, toxic, clean``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, most_bytes=2_000_000):
                label = part.column("label").to_numpy(zero_copy_only=False)
                row, key = _presence(part.column("text"))
                order = np.lexsort((row, key))
                row, key = row[order], key[order]
                first = np.ones(len(key), dtype=bool)
                first[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
                row, key = row[first], key[first]
                if not len(key):
                    continue
                start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                toxic = np.add.reduceat(label[row].astype("int64"), start)
                n = np.diff(np.r_[start, len(key)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[start]), pa.array(toxic), pa.array(n - toxic)], names=["feature", "toxic", "clean"]
                )

    counts = docs.mapInArrow(run, "feature long, toxic long, clean long")
    return counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _select(counts: DataFrame, toxic: int, clean: int, most: int, least: int) -> np.ndarray:
    """The ``most`` features whose rate in toxic documents exceeds that in clean ones most, in standard errors."""
    rate = (F.col("toxic") + F.col("clean")) / (toxic + clean)
    error = F.sqrt(rate * (1 - rate) * (1 / toxic + 1 / clean) + 1e-12)
    z = (F.col("toxic") / toxic - F.col("clean") / clean) / error
    rows = counts.where(F.col("toxic") + F.col("clean") >= least).orderBy(z.desc(), "feature").limit(most).collect()
    return np.sort(np.array([r["feature"] for r in rows], dtype="int64"))


def _examples(docs: DataFrame, features: np.ndarray, groups: Sequence[Sequence[str]]) -> DataFrame:
    """Each document's label and feature positions, and those of its swapped versions with their difference."""
    terms = re.compile(r"\b(" + "|".join(re.escape(t) for g in groups for t in g) + r")\b", re.IGNORECASE) if groups else None

    def lists(column: pa.Array) -> list[np.ndarray]:
        row, at = _chosen(column, features)
        return np.split(at, np.searchsorted(row, np.arange(1, len(column)))) if len(column) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, most_bytes=2_000_000):
                own = lists(part.column("text"))
                swapped = [[] for _ in own]
                for i, text in enumerate(part.column("text").to_pylist()):
                    if terms is not None and terms.search(text):
                        swapped[i] = [x.tolist() for x in lists(pa.array(_swaps(text, groups), pa.string()))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array([x.tolist() for x in own], pa.list_(pa.int64())),
                     pa.array(swapped, pa.list_(pa.list_(pa.int64())))],
                    names=["label", "own", "swapped"],
                )

    return docs.mapInArrow(run, "label int, own array<long>, swapped array<array<long>>")


def _descend(rows: list, n: int, balance: float, ridge: float, steps: int, rate: float) -> tuple[np.ndarray, float]:
    """Minimise log loss + ridge + ``balance`` times the mean squared logit change under swaps, by Adam."""
    y = np.array([r["label"] for r in rows], dtype="float64")
    sizes = np.array([len(r["own"]) for r in rows])
    at = np.concatenate([np.asarray(r["own"], dtype="int64") for r in rows] + [np.zeros(0, dtype="int64")])
    of = np.repeat(np.arange(len(rows)), sizes)
    pairs = [(r["own"], s) for r in rows for s in r["swapped"]]
    p_of = np.array([i for i, (a, b) in enumerate(pairs) for _ in (*a, *b)], dtype="int64")
    p_at = np.array([j for a, b in pairs for j in (*a, *b)], dtype="int64")
    p_sign = np.array([s for a, b in pairs for s in (*[1.0] * len(a), *[-1.0] * len(b))])
    w = np.zeros(n + 1)
    w[n] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):
        logit = w[n] + np.bincount(of, w[at], len(rows))
        miss = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y) / len(rows)
        gradient = np.append(np.bincount(at, miss[of], n), miss.sum())
        gradient[:n] += ridge * w[:n]
        if pairs:
            change = np.bincount(p_of, p_sign * w[p_at], len(pairs))
            gradient[:n] += 2 * balance / len(pairs) * np.bincount(p_at, p_sign * change[p_of], n)
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient * gradient
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-10)
    return w[:n], float(w[n])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most_rows: int = 40_000,
    features: int = 2048,
    least: int = 3,
    balance: float = 1.0,
    ridge: float = 1e-6,
    steps: int = 200,
    rate: float = 0.1,
    identity_groups: Sequence[Sequence[str]] = IDENTITY_GROUPS,
) -> ToxicityModel:
    """A model from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``).

    The model is fitted on a bounded sample: labels are drawn by a hash of the id until about ``most_rows`` documents
    remain, twice that at most, and those labels are broadcast to the scan. A document with several labels is toxic if
    one of them is; null labels, ids and texts are left out. ``features`` words and beginnings are those whose
    document rate among toxic rows exceeds that among clean ones most. Every sentence with an identity term is also presented with each
    other term of its group, and ``balance`` weighs the squared change of its logit, so that mentioning a group does
    not move a score. Without both labels the model scores every text alike, by the share of toxic labels.
    """
    rows = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("label")
    )
    known = rows.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.where(draw < min(1.0, most_rows / max(known, 1))).limit(2 * most_rows)
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    train = texts.join(F.broadcast(sample), "doc_id").select("text", "label")
    n = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        share = toxic / (toxic + clean) if toxic + clean else 0.0
        return ToxicityModel(np.zeros(0, dtype="int64"), np.zeros(0), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    chosen = _select(_feature_counts(train), toxic, clean, features, least)
    weights, intercept = _descend(
        _examples(train, chosen, identity_groups).collect(), len(chosen), balance, ridge, steps, rate
    )
    return ToxicityModel(chosen, weights, intercept)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` (with ``text``) and ``score``, 0 to 1. Null and empty texts get the score of no word.

    A column of that name is replaced. The model is at most a few thousand weights and travels with the task.
    """
    kept = docs.drop("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, most_bytes=2_000_000):
                row, at = _chosen(part.column("text"), model.features)
                logit = model.intercept + np.bincount(row, model.weights[at], part.num_rows)
                value = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(value)], names=[*part.schema.names, "score"])

    return kept.mapInArrow(run, added(kept, score="double"))
