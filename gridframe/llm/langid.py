"""Language identification by the nearest of several TF-IDF centroids per language, with rejection by distance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.llm.textbytes import added, blocks, raw

UNKNOWN = "und"


@dataclass(frozen=True)
class Centroids:
    """Unit centroids (rows), their languages, the inverse document frequencies, and the largest accepted distances,
    one row per centroid and one column per size class of a text."""

    langs: tuple[str, ...]
    vectors: np.ndarray
    idf: np.ndarray
    limits: np.ndarray


def _folded(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and the Latin-1 letters; ASCII non-letters become spaces."""
    out = data.copy()
    upper = (data >= 0x41) & (data <= 0x5A)
    out[upper] += 0x20
    accented = np.zeros(len(data), dtype=bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[accented] += 0x20
    letter = (out >= 0x80) | ((out >= 0x61) & (out <= 0x7A))
    out[~letter] = 0x20
    return out


def ngram_counts(column: pa.Array, size: int) -> np.ndarray:
    """Counts of hashed byte 2-grams and 3-grams, one row of ``size`` buckets per text.

    Runs of non-letters count as one space; every text is read whole, framed by spaces.
    """
    data, offsets = raw(column)
    rows, bits = len(offsets) - 1, int(size).bit_length() - 1
    folded = np.full(len(data) + rows, 0x20, dtype="uint32")
    of_row = np.repeat(np.arange(rows), np.diff(offsets))
    folded[np.arange(len(data)) + of_row] = _folded(data)
    row = np.repeat(np.arange(rows), np.diff(offsets) + 1)
    keep = np.ones(len(folded), dtype=bool)
    keep[1:] = (folded[1:] != 0x20) | (folded[:-1] != 0x20) | (row[1:] != row[:-1])
    c, row = folded[keep], row[keep]
    counts = np.zeros(rows * size, dtype="float64")
    for n in (2, 3):
        if len(c) < n:
            continue
        code = np.zeros(len(c) - n + 1, dtype="uint32")
        for i in range(n):
            code = code * np.uint32(257) + c[i : len(c) - n + 1 + i]
        same = row[: len(code)] == row[n - 1 :]
        bucket = (code * np.uint32(2654435769)) >> np.uint32(32 - bits)
        counts += np.bincount((row[: len(code)] * size + bucket)[same], minlength=rows * size)
    return counts.reshape(rows, size)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _vectors(column: pa.Array, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(ngram_counts(column, len(idf))) * idf)


def _size_class(x: np.ndarray) -> np.ndarray:
    """Doublings of the number of buckets a text fills: repeating a short text does not make it a long one."""
    return np.log2(np.maximum((x > 0).sum(1), 1)).astype("int64")


def _has_letter(column: pa.Array) -> np.ndarray:
    data, offsets = raw(column)
    plain = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A) & (data < 0x80)
    seen = np.concatenate([[0], np.cumsum(plain)])
    out = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~out):
        text = column[int(i)].as_py()
        out[i] = text is not None and any(ch.isalpha() for ch in text)
    return out


def _document_frequencies(docs: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """Number of documents and, per bucket, of documents holding it: one row per bucket and task, then a sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size, dtype="int64"), 0
        for batch in batches:
            for part in blocks(batch, most_bytes=1_000_000):
                for piece in (part.slice(i, 256) for i in range(0, part.num_rows, 256)):
                    total += (ngram_counts(piece.column("text"), size) > 0).sum(0)
                    n += piece.num_rows
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(hit, -1)), pa.array(np.append(total[hit], n))], names=["bucket", "n"]
        )

    rows = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    found = {r["bucket"]: r["n"] for r in rows}
    df = np.zeros(size)
    for bucket, n in found.items():
        if bucket >= 0:
            df[bucket] = n
    return found.get(-1, 0), df


def _cluster(x: np.ndarray, clusters: int, rounds: int) -> np.ndarray:
    """Spherical k-means from farthest-first seeds; empty clusters are left out."""
    chosen = [int(np.argmax(x @ x.mean(0)))]
    while len(chosen) < min(clusters, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(1))))
    centres = x[chosen]
    for _ in range(rounds):
        nearest = (x @ centres.T).argmax(1)
        centres = _unit(np.array([x[nearest == j].sum(0) for j in np.unique(nearest)]))
    return centres


def _limits(
    docs: DataFrame, langs: tuple[str, ...], vectors: np.ndarray, idf: np.ndarray, quantile: float, slack: float, least: int, most: float
) -> np.ndarray:
    """The largest accepted distance of each centroid and size class, from all labelled rows with a letter.

    A language's limit in a class is the quantile of its rows' distances to their own language, moved by ``slack`` of
    the way to 1. Classes with fewer than ``least`` rows of the language take all languages' rows, with fewer of these
    the limit of the next smaller class (shorter texts lie farther off), and below the first such class ``most``.
    """
    names = np.array(langs, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, most_bytes=1_000_000):
                for start in range(0, block.num_rows, 256):
                    part = block.slice(start, 256)
                    lang = np.array(part.column("lang").to_pylist(), dtype=object)
                    x = _vectors(part.column("text"), idf)
                    own = np.where(lang[:, None] == names[None], x @ vectors.T, -1.0).max(1)
                    use = _has_letter(part.column("text")) & (own >= 0)
                    columns = [pa.array(lang[use], pa.string()), pa.array(_size_class(x)[use]), pa.array(1 - own[use])]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "size_class", "distance"])

    far = docs.select("text", "lang").mapInArrow(run, "lang string, size_class long, distance double")
    far = far.groupingSets([["lang", "size_class"], ["size_class"]], "lang", "size_class")
    rows = far.agg(F.count("*").alias("n"), F.percentile_approx("distance", quantile).alias("d")).collect()
    found = {(r["lang"], r["size_class"]): r["d"] + slack * (1 - r["d"]) for r in rows if r["n"] >= least}
    out = np.full((len(langs), int(np.log2(len(idf))) + 1), most)
    for i, lang in enumerate(langs):
        for k in range(out.shape[1]):
            limit = found.get((lang, k), found.get((None, k), out[i, k - 1] if k else most))
            out[i, k] = min(limit, most)
    return out


def fit(
    docs: DataFrame,
    clusters: int = 4,
    size: int = 4096,
    sample_per_lang: int = 800,
    rounds: int = 8,
    reject_distance: float = 0.97,
    reject_quantile: float = 0.99,
    reject_slack: float = 0.4,
    reject_rows: int = 30,
) -> Centroids:
    """Centroids from labelled documents (``doc_id, text, lang``; rows with a null text or lang are left out).

    Document frequencies cover every row. The clusters of a language are found in one task per language from a bounded
    sample, about ``sample_per_lang`` rows drawn by a hash of the id (every row of smaller languages), twice that at
    most. The driver receives ``size`` frequencies and ``clusters`` vectors of that length per language.

    The distances beyond which a text is rejected are an aggregate over all these rows by language and size of text
    (``_limits``); ``reject_distance`` is the largest possible and stands where rows are too few.
    """
    docs = docs.select("doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    n, df = _document_frequencies(docs, size)
    idf = np.log((1 + n) / (1 + df)) + 1
    sizes = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    part = F.lit(None).cast("double")
    for lang, count in sizes.items():
        part = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_per_lang / count))).otherwise(part)
    sample = docs.where(draw < part).select("lang", "text")

    def per_lang(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.iloc[: 2 * sample_per_lang]
        x = np.concatenate([
            _vectors(pa.array(rows["text"].iloc[i : i + 128], pa.string()), idf).astype("float32")
            for i in range(0, len(rows), 128)
        ])
        centres = _cluster(x, clusters, rounds)
        return pd.DataFrame({"lang": [key[0]] * len(centres), "vector": list(centres.astype("float64"))})

    found = sample.groupBy("lang").applyInPandas(per_lang, "lang string, vector array<double>").collect() if sizes else []
    found = sorted(((r["lang"], tuple(r["vector"])) for r in found))
    vectors = np.array([v for _, v in found]) if found else np.zeros((0, size))
    langs = tuple(lang for lang, _ in found)
    if not langs:
        return Centroids(langs, vectors, idf, np.zeros((0, 0)))
    limits = _limits(docs, langs, vectors, idf, reject_quantile, reject_slack, reject_rows, reject_distance)
    return Centroids(langs, vectors, idf, limits)


def predict(docs: DataFrame, model: Centroids) -> DataFrame:
    """The rows of ``docs`` with ``lang_pred``, ``score`` and ``rejected``; needs a column ``text``.

    ``lang_pred`` is the language of the centroid with the largest cosine and ``score`` that cosine (0 to 1). A null
    text, one without a letter, and any text where no language was learned give ``und`` and 0. ``rejected`` is true for
    those and where the distance, 1 less the cosine, exceeds the limit of the language and the text's size. Columns of these names are replaced.
    """
    made = ("lang_pred", "score", "rejected")
    kept = docs.drop(*made)
    schema = added(kept, lang_pred="string", score="double", rejected="boolean")
    langs = np.array([*model.langs, UNKNOWN], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, most_bytes=1_000_000):
                for start in range(0, block.num_rows, 256):
                    part = block.slice(start, 256)
                    text = part.column("text")
                    valid = _has_letter(text) & bool(len(model.langs))
                    best, score = np.full(part.num_rows, len(model.langs)), np.zeros(part.num_rows)
                    rejected = ~valid
                    if valid.any():
                        x = _vectors(text, model.idf)
                        cosine = x @ model.vectors.T
                        nearest = cosine.argmax(1)
                        best = np.where(valid, nearest, best)
                        score = np.where(valid, np.clip(cosine.max(1), 0, 1), 0.0)
                        rejected |= 1 - score > model.limits[nearest, _size_class(x)]
                    columns = [pa.array(langs[best], pa.string()), pa.array(score), pa.array(rejected)]
                    yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *made])

    return kept.mapInArrow(run, schema)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``fold``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))
