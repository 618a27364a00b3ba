"""Removal of repeated word sequences through a De Bruijn graph of the corpus.

Every run of ``k`` consecutive words is an edge of the graph, from its first to its last ``k - 1`` words. Edges are dealt
out by a minimizer: the smallest hash among the shorter word runs inside the edge. Equal edges have equal minimizers,
and neighbouring edges mostly share one, so a stretch of edges travels as one row of fingerprints with the coordinates
of its first edge. Where an edge occurs again, the stretch of repeated edges whose first occurrences follow each other
is one piece of a nonbranching path; pieces are joined to paths by their coordinates in both documents, and paths to
the documents they lie in.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.textbytes import Words, added, blocks, mix, raw, window_hashes

#: Bytes of an edge's own fingerprint; with the minimizer, an edge is known by 112 bits.
PRINT_BYTES = 6

_STRETCH = "minimizer long, doc_id long, part long, start int, n int, source_id long, source_start int, prints binary"
_PIECE = "doc_id long, part long, start int, n int, source_id long, source_start int"


def _part(column: pa.Array) -> np.ndarray:
    """CRC-32 of each text : tells rows apart that share a doc_id."""
    data, offsets = raw(column)
    view = memoryview(np.ascontiguousarray(data))
    values = [zlib.crc32(view[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    return np.array(values, dtype="int64")


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Smallest value of each run of ``size``, by doubling."""
    done = 1
    while done < size:
        step = min(done, size - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def _runs(start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position and length of each run, from the flags of run starts."""
    first = np.flatnonzero(start)
    return first, np.diff(np.append(first, len(start)))


def _stretches(k: int, anchor: int):
    """Edges of each slice of documents as stretches; an edge seen before in its slice leaves as a piece at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, most_bytes=2_000_000):
                part = part.take(pc.sort_indices(part.column("doc_id")))
                words = Words(part.column("text"))
                if len(words) < k:
                    continue
                hashes = words.hashes()
                edge = window_hashes(hashes, k)
                minimizer = _sliding_min(window_hashes(hashes, anchor, 0xA0761D6478BD642F), k - anchor + 1)
                of = words.text_of_word()
                whole = np.flatnonzero(of[: len(edge)] == of[k - 1 :])
                if not len(whole):
                    continue
                edge, minimizer, text = edge[whole], minimizer[whole], of[whole]
                start = whole - words.of_text[text]
                doc = part.column("doc_id").to_numpy(zero_copy_only=False)
                tell = _part(part.column("text"))
                order = np.argsort(edge, kind="stable")
                new = np.ones(len(order), dtype=bool)
                new[1:] = (edge[order][1:] != edge[order][:-1]) | (minimizer[order][1:] != minimizer[order][:-1])
                source = np.empty(len(order), dtype="int64")
                source[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
                later = (doc[text] > doc[text[source]]) | ((doc[text] == doc[text[source]]) & (start > start[source]))
                follows = np.zeros(len(edge), dtype=bool)
                follows[1:] = (text[1:] == text[:-1]) & (start[1:] == start[:-1] + 1)
                # Edges already seen: pieces with their source, dealt out by document.
                same = follows.copy()
                same[1:] &= later[1:] & later[:-1] & (text[source[1:]] == text[source[:-1]])
                same[1:] &= start[source[1:]] == start[source[:-1]] + 1
                first, n = _runs(~same)
                first, n = first[later[first]], n[later[first]]
                at = source[first]
                empty = pa.nulls(len(first), pa.binary())
                yield _rows(
                    [mix(doc[text[first]]).view("int64"), doc[text[first]], tell[text[first]], start[first], n,
                     doc[text[at]], start[at]], empty, _STRETCH
                )
                # The others: stretches of one minimizer with the fingerprints of their edges.
                same = follows
                same[1:] &= ~later[1:] & ~later[:-1] & (minimizer[1:] == minimizer[:-1])
                first, n = _runs(~same)
                keep = ~later[first]
                first, n = first[keep], n[keep]
                prints = np.ascontiguousarray(edge[~later].view("uint8").reshape(-1, 8)[:, :PRINT_BYTES])
                ends = np.append(0, np.cumsum(n) * PRINT_BYTES).astype("int32")
                binary = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(prints)])
                nothing = np.zeros(len(n), dtype="int64")
                yield _rows(
                    [minimizer[first].view("int64"), doc[text[first]], tell[text[first]], start[first], n, nothing,
                     nothing], binary, _STRETCH
                )

    return run


def _rows(columns: list[np.ndarray], binary: pa.Array | None, schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32()}
    arrays = [pa.array(c, kinds[kind], safe=False) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays + ([binary] if binary is not None else []), names=[n for n, _ in fields])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated edges of a partition sorted by minimizer and coordinates, as pieces with their first occurrence."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        done = pc.is_null(batch.column("prints"))
        if pc.any(done).as_py():
            yield batch.filter(done).select([f.split()[0] for f in _PIECE.split(", ")])
            batch = batch.filter(pc.invert(done))
        if not batch.num_rows:
            continue
        key = batch.column("minimizer").to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if sum(b.num_rows for b in held) + cut >= 60_000 and (cut or held):
            if cut or held[-1].column("minimizer")[-1].as_py() != key[0]:
                yield _repeated([*held, batch.slice(0, cut)])
                held, batch = [], batch.slice(cut)
        held.append(batch)
    if held:
        yield _repeated(held)


def _repeated(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts).combine_chunks()
    get = lambda name: table[name].to_numpy()
    minimizer, doc, tell, start, n = (get(c) for c in ("minimizer", "doc_id", "part", "start", "n"))
    value = table["prints"].chunk(0) if table["prints"].num_chunks else pa.array([], pa.binary())
    offsets = np.frombuffer(value.buffers()[1], dtype="int32")[value.offset : value.offset + len(value) + 1]
    data = np.frombuffer(value.buffers()[2], dtype="uint8")[offsets[0] : offsets[-1]].reshape(-1, PRINT_BYTES)
    wide = np.zeros((len(data), 8), dtype="uint8")
    wide[:, :PRINT_BYTES] = data
    row = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    # Minimizers of the slice are numbered; number and fingerprint fill 64 bits exactly while the numbers fit in 16.
    number = np.cumsum(np.append(0, minimizer[1:] != minimizer[:-1]))[row].astype("uint64")
    key = wide.view("uint64").ravel() | ((number & np.uint64(0xFFFF)) << np.uint64(8 * PRINT_BYTES))
    doc, tell, start = doc[row], tell[row], start[row] + within
    order = np.argsort(key, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (number[order][1:] != number[order][:-1])
    source = np.empty(len(order), dtype="int64")
    source[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = (doc > doc[source]) | ((doc == doc[source]) & (start > start[source]))
    same = np.zeros(len(row), dtype=bool)
    same[1:] = (row[1:] == row[:-1]) & later[1:] & later[:-1] & (doc[source[1:]] == doc[source[:-1]])
    same[1:] &= start[source[1:]] == start[source[:-1]] + 1
    first, length = _runs(~same)
    first, length = first[later[first]], length[later[first]]
    at = source[first]
    return _rows([doc[first], tell[first], start[first], length, doc[at], start[at]], None, _PIECE)


def repeated_paths(docs: DataFrame, k: int = 20, anchor: int = 6, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Repeated sequences of words: ``doc_id, part, paths``, the last an array of (start, n, source_id, source_start).

    A path says that ``n`` consecutive edges from word ``start`` on also start earlier: in a document with a smaller id,
    or earlier in the same one. Source coordinates run along: edge ``start + i`` is the edge ``source_start + i`` of the
    source; where they do not, the graph branches and a new path begins. Documents of equal id are told apart by
    ``part``, the CRC-32 of their text; equal coordinates are not earlier. Null ids and texts have no edges.

    A task sends each edge of a slice of its documents once, so a passage that all documents share moves one row per
    slice. Sorted partitions are read as streams, whole minimizers at a time.
    """
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    edges = chosen.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(_stretches(k, anchor), _STRETCH)
    dealt = edges.repartition("minimizer").sortWithinPartitions("minimizer", "doc_id", "start")
    pieces = dealt.mapInArrow(_pieces, _PIECE)
    # Pieces that follow each other in both documents are one path: number the paths of a document, then join them.
    order = Window.partitionBy("doc_id", "part").orderBy("start", "source_id", "source_start")
    before = F.lag(F.struct("start", "n", "source_id", "source_start")).over(order)
    goes_on = (
        (before["start"] + before["n"] == F.col("start"))
        & (before["source_id"] == F.col("source_id"))
        & (before["source_start"] + before["n"] == F.col("source_start"))
    )
    begins = F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)
    numbered = pieces.withColumn("begins", begins).withColumn("path", F.sum("begins").over(order))
    path = F.min(F.struct("start", "source_id", "source_start")).alias("first")
    joined = numbered.groupBy("doc_id", "part", "path").agg(path, F.sum("n").cast("int").alias("n"))
    whole = F.struct(F.col("first.start"), F.col("n"), F.col("first.source_id"), F.col("first.source_start"))
    return joined.groupBy("doc_id", "part").agg(F.collect_set(whole).alias("paths"))


def remove_repeats(docs: DataFrame, k: int = 20, anchor: int = 6) -> DataFrame:
    """``docs`` (with ``doc_id, text``) and ``n_words``, ``n_removed``, ``kept``.

    Words are runs of bytes other than space and 0x09 to 0x0D. A word is removed if it lies in a run of ``k`` words that
    also starts earlier (see :func:`repeated_paths`); ``kept`` are the other words joined by one space, empty for a null
    text. Repeated rows keep their words: neither is earlier than the other. A row with a null id keeps all words.
    Columns of the three names are replaced.
    """
    made = ("n_words", "n_removed", "kept")
    docs = docs.drop(*made)
    paths = repeated_paths(docs, k, anchor).select(
        F.col("doc_id").alias("_id"), F.col("part").alias("_part"),
        F.transform("paths", lambda p: p["start"]).alias("_starts"), F.transform("paths", lambda p: p["n"]).alias("_ns"),
    )
    part = F.crc32(F.encode("text", "UTF-8"))
    found = docs.withColumn("_crc", part)
    found = found.join(paths, (found["doc_id"] == paths["_id"]) & (found["_crc"] == paths["_part"]), "left")
    found = found.select(*[found[c] for c in docs.columns], "_starts", "_ns")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in blocks(batch, most_bytes=2_000_000):
                yield _kept(rows, k)

    return found.mapInArrow(run, added(docs, n_words="long", n_removed="long", kept="string"))


def _kept(rows: pa.RecordBatch, k: int) -> pa.RecordBatch:
    words = Words(rows.column("text"))
    sizes = pc.fill_null(pc.list_value_length(rows.column("_starts")), 0).to_numpy(zero_copy_only=False)
    first = np.repeat(words.of_text[:-1], sizes) + rows.column("_starts").flatten().to_numpy(zero_copy_only=False)
    last = first + rows.column("_ns").flatten().to_numpy(zero_copy_only=False) + k - 1
    change = np.zeros(len(words) + 1, dtype="int64")
    np.add.at(change, first, 1)
    np.add.at(change, last, -1)
    keep = np.cumsum(change[:-1]) == 0
    so_far = np.append(0, np.cumsum(keep))
    n_words = np.diff(words.of_text)
    n_kept = so_far[words.of_text[1:]] - so_far[words.of_text[:-1]]
    # Bytes of kept words, and the byte after each but the last of a text, turned into a space.
    data, mask = words.data.copy(), words.inside.copy()
    sizes = words.ends - words.starts
    mask[words.inside] = np.repeat(keep, sizes)
    at = np.flatnonzero(keep)
    inner = at[:-1][words.text_of_word()[at[1:]] == words.text_of_word()[at[:-1]]] if len(at) else at
    mask[words.ends[inner]] = True
    data[words.ends[inner]] = 0x20
    ends = np.append(0, np.cumsum(mask))[words.offsets].astype("int64")
    text = pa.Array.from_buffers(
        pa.large_string(), rows.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[mask]))]
    ).cast(pa.string())
    columns = [*rows.columns[:-2], pa.array(n_words), pa.array(n_words - n_kept), text]
    return pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names[:-2], "n_words", "n_removed", "kept"])


