"""Removal of long byte strings that occur more than once, through run-length indexes of the corpus' repeated parts.

Where two texts share a string of ``size`` bytes, they share its anchor, the smallest hash among the shorter byte runs
inside it. Windows that follow each other and have one anchor form a stretch of text, and only stretches whose anchor
occurs again can match. A stretch that occurs again as a whole is marked at all its places. For the parts of the others,
the different stretches of each anchor are fetched once with the number of their copies, whole anchors are put together
up to a fixed size, and of each such collection a run-length index is built: the runs of its Burrows-Wheeler transform
with the text positions of their ends, and the length of the match between the ends that meet. Matching statistics
follow from these samples in one pass in text order; where they reach ``size``, the text is marked. A stretch without
copies has one place, which it carries along, so that its marks need no join.

An anchor with more different stretches than a collection holds (a passage in very many surroundings) is dealt out
again by a longer run: one place of each different stretch, not all of them. Runs grow until what a window has beside
them is gone, so that each time only the windows near the surroundings go on; the last are whole windows, of which two
copies are all there can be.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.llm.substring import _runs, _sliding_min
from gridframe.llm.textbytes import BYTE_VALUES, added, blocks, mix, powers, raw
from gridframe.session import scratch_path

#: Bytes of the different stretches of an anchor beyond which it is dealt out again, and of a collection before the
#: anchor that fills it: together they keep the positions of a collection below 2 ** INDEX_BITS.
MOST_BYTES = 1_000_000
INDEX_BITS = 21

#: Windows hashed at a time, and at most in a stretch as a multiple of their size.
_SLICE, _LONGEST = 1_000_000, 2

_BASE = 0x9E3779B97F4A7C15
_STRETCH = "anchor long, content long, doc long, tell long, start int, n int, times int, copies long"
_BYTES = "anchor long, content long, copies long, doc long, tell long, start int, bytes binary"
_MARKS = "doc long, tell long, starts array<int>, ends array<int>"


# -- the index -------------------------------------------------------------------------------------------------------


def suffix_order(codes: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Positions in the order of the texts that start there and end with their part (``rest`` symbols on); equal ones by
    position. Ranks of twice the length come from pairs of ranks, packed with the position into one sorted number."""
    n, bits = len(codes), int(codes.max()).bit_length()
    depth = 2 * INDEX_BITS // bits
    index, low = np.arange(n, dtype="uint64"), np.uint64((1 << INDEX_BITS) - 1)
    key = np.zeros(n, dtype="uint64")
    for j in range(depth):
        key <<= np.uint64(bits)
        if j < n:
            key[: n - j] |= np.where(rest[: n - j] > j, codes[j:], 0).astype("uint64")
    packed, longest, rank = (key << np.uint64(INDEX_BITS)) | index, int(rest.max()), np.empty(n, dtype="uint64")
    while True:
        packed.sort()
        order = (packed & low).astype("int64")
        new = np.ones(n, dtype="uint64")
        new[1:] = (packed[1:] ^ packed[:-1]) > low
        number = np.cumsum(new)
        if depth >= longest or number[-1] == n:
            return order
        rank[order] = number
        packed = rank << np.uint64(2 * INDEX_BITS) | index
        packed[: n - depth] |= np.where(rest[: n - depth] > depth, rank[depth:], np.uint64(0)) << np.uint64(INDEX_BITS)
        depth *= 2


def match_lengths(data: np.ndarray, rest: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the match of the texts at ``a`` and ``b``, eight bytes at a time for the pairs still equal."""
    padded = np.append(data, np.zeros(8, dtype="uint8"))
    words = np.zeros(len(data), dtype="uint64")
    for j in range(8):
        words |= padded[j : j + len(data)].astype("uint64") << np.uint64(8 * j)
    most = np.minimum(rest[a], rest[b])
    length, open_ = np.zeros(len(a), dtype="int64"), np.flatnonzero(most > 0)
    while len(open_):
        at = length[open_]
        gap = words[a[open_] + at] ^ words[b[open_] + at]
        lowest = gap & (~gap + np.uint64(1))
        same = np.where(gap == 0, 8, np.log2(np.maximum(lowest, np.uint64(1)).astype("float64")).astype("int64") >> 3)
        length[open_] = at + same
        open_ = open_[(same == 8) & (at + 8 < most[open_])]
    return np.minimum(length, most)


@dataclass(frozen=True)
class RunIndex:
    """Runs of the Burrows-Wheeler transform of a collection of texts, each closed by an end mark of its own.

    Run ``i`` is the symbol ``symbols[i]`` (0: an end mark, a run by itself) from row ``rows[i]`` on; ``heads`` and
    ``tails`` are the text positions of its first and last row, ``shared`` the length of the match between its head and
    the tail before. A text with ``copies`` beside it in the collection is held once: its copies would lie in the
    neighbouring rows and match it over its whole length.
    """

    symbols: np.ndarray
    rows: np.ndarray
    heads: np.ndarray
    tails: np.ndarray
    shared: np.ndarray
    offsets: np.ndarray
    copied: np.ndarray

    @staticmethod
    def of(data: np.ndarray, offsets: np.ndarray, copied: np.ndarray) -> RunIndex:
        """The index of the texts ``data[offsets[i] : offsets[i + 1]]``, none of them empty."""
        if len(data) >= 1 << INDEX_BITS:
            raise ValueError("a collection is longer than its index can number")
        rest = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
        used = np.zeros(256, dtype="int64")
        used[data] = 1
        codes = (np.cumsum(used) * used)[data]
        order = suffix_order(codes, rest)
        before = np.append(0, codes[:-1])
        before[offsets[:-1]] = 0
        column = before[order]
        head = np.ones(len(order), dtype=bool)
        head[1:] = (column[1:] != column[:-1]) | (column[1:] == 0)
        rows = np.flatnonzero(head)
        heads, tails = order[rows], order[np.append(rows[1:], len(order)) - 1]
        shared = np.append(0, match_lengths(data, rest, tails[:-1], heads[1:]))
        return RunIndex(column[rows], rows, heads, tails, shared, offsets, copied)

    def matching_statistics(self) -> np.ndarray:
        """For every position the length of the longest match with a text at any other position or in a copy.

        Inside a run the match with the row before moves along with the text: one symbol on it is one shorter. So a
        match is longest where its row begins or ends a run, and the matches of the samples, followed in text order,
        give those of all positions.
        """
        reach = np.arange(int(self.offsets[-1]))
        np.maximum.at(reach, self.heads, self.heads + self.shared)
        np.maximum.at(reach, self.tails[:-1], self.tails[:-1] + self.shared[1:])
        first = self.offsets[:-1][self.copied]
        reach[first] = self.offsets[1:][self.copied]
        return np.maximum.accumulate(reach) - np.arange(len(reach))


def long_matches(index: RunIndex, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, start and end of the parts covered by matches of at least ``size``."""
    found = np.flatnonzero(index.matching_statistics() >= size)
    change = np.zeros(int(index.offsets[-1]) + 1, dtype="int64")
    change[found] += 1
    np.add.at(change, found + size, -1)
    covered = np.cumsum(change[:-1]) > 0
    edge = covered.copy()
    edge[1:] &= ~covered[:-1]
    edge[index.offsets[:-1]] = covered[index.offsets[:-1]]
    inside = np.flatnonzero(covered)
    first, length = _runs(edge[inside])
    start = inside[first]
    text = np.searchsorted(index.offsets, start, side="right") - 1
    return text, start - index.offsets[text], start - index.offsets[text] + length


# -- stretches -------------------------------------------------------------------------------------------------------


def stretches(data: np.ndarray, offsets: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """Part, start in the part, number of windows, anchor and content hash of the stretches of each part of ``data``, and
    how often the anchor occurs in the stretch."""
    n = len(data) - size + 1
    if n <= 0:
        return tuple(np.zeros(0, dtype="int64") for _ in range(6))
    back = powers(len(data), np.uint64(pow(_BASE, -1, 1 << 64)))
    sums = np.append(np.uint64(0), np.cumsum(BYTE_VALUES[data] * powers(len(data), np.uint64(_BASE)), dtype="uint64"))
    grams = mix((sums[gram:] - sums[:-gram]) * back[: len(data) - gram + 1] + np.uint64(gram))
    anchor = _sliding_min(grams, size - gram + 1)
    fits = np.diff(offsets) >= size
    change = np.zeros(len(data) + 1, dtype="int32")
    change[offsets[:-1][fits]] += 1
    change[offsets[1:][fits] - size + 1] -= 1
    whole = np.cumsum(change[:n]) > 0
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1])
    at = np.flatnonzero(whole)
    first, length = _runs(new[at])
    start = at[first]
    # A stretch of one repeated anchor may be as long as its text: cut it into parts that overlap by a window.
    most = _LONGEST * size
    parts = -(-length // most)
    place = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(start, parts) + place * most
    length = np.minimum(np.repeat(length, parts) - place * most, most)
    content = mix((sums[start + length + size - 1] - sums[start]) * back[start] + length.astype("uint64"))
    part = np.searchsorted(offsets, start, side="right") - 1
    held = length + size - gram
    ahead = np.cumsum(held) - held
    same = grams[np.arange(int(held.sum())) + np.repeat(start - ahead, held)] == np.repeat(anchor[start], held)
    times = np.add.reduceat(same, ahead, dtype="int64") if len(start) else start
    return part, start - offsets[part], length, anchor[start].view("int64"), content.view("int64"), times


def _slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> Iterator[tuple]:
    """Parts of texts in slices: their bytes and offsets, the number of each part's text, and its start in it. Long
    parts are cut so that each window lies in one of them."""
    pieces = np.maximum(-(-(ends - starts - size + 1) // _SLICE), 0)
    of = np.repeat(np.arange(len(starts)), pieces)
    shift = (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * _SLICE
    first = starts[of] + shift
    last = np.minimum(first + _SLICE + size - 1, ends[of])
    slice_of = np.cumsum(last - first) // _SLICE
    for group in np.split(np.arange(len(of)), np.flatnonzero(np.diff(slice_of)) + 1):
        if len(group):
            part = np.concatenate([data[a:b] for a, b in zip(first[group], last[group])])
            yield part, np.append(0, np.cumsum(last[group] - first[group])), of[group], shift[group]


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32()), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, kinds[kind], safe=False) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _stretches(size: int, gram: int):
    """Stretches of whole texts or, where a row lists ``_parts`` (start, windows, copies), of these parts of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            doc, tell = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_doc", "_tell"))
            row, starts, ends, copies = np.arange(batch.num_rows), offsets[:-1], offsets[1:], np.ones(batch.num_rows, dtype="int64")
            if "_parts" in batch.schema.names:
                listed, values = _listed(batch.column("_parts"))
                row = np.repeat(row, listed)
                starts = offsets[row] + values["start"]
                ends, copies = starts + values["n"] + size - 1, values["copies"]
            for part, within, of, shift in _slices(data, starts, ends, size):
                text, start, n, anchor, content, times = stretches(part, within, size, gram)
                rows = row[of[text]]
                start = start + shift[text] + (starts - offsets[row])[of[text]]
                yield _batch(_STRETCH, anchor, content, doc[rows], tell[rows], start, n, times, copies[of[text]])

    return run


def _listed(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Lengths of a column of lists of structs, and the fields of all their items."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    items = column.flatten()
    return sizes, {f.name: items.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(items.type)}


def _fetched(size: int):
    """The bytes of the stretches listed in ``_wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in blocks(batch, most_bytes=1_000_000):
                data, offsets = raw(rows.column("text"))
                sizes, items = _listed(rows.column("_wanted"))
                doc, tell = (np.repeat(rows.column(c).to_numpy(zero_copy_only=False), sizes) for c in ("_doc", "_tell"))
                starts = np.repeat(offsets[:-1], sizes) + items["start"]
                whole = data.tobytes()
                found = [whole[a:b] for a, b in zip(starts, starts + items["n"] + size - 1)]
                known = [items[c] for c in ("anchor", "content", "copies")]
                yield _batch(_BYTES, *known, doc, tell, items["start"], pa.array(found, pa.binary()))

    return run


def _matches(size: int):
    """Marked parts, as places in their texts, of the stretches without copies of a partition sorted by anchor, a
    collection of whole anchors at a time."""

    def marks(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        anchor, content = table["anchor"].to_numpy(), table["content"].to_numpy()
        # Rows that repeat whole fetch a stretch twice.
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]))
        table, anchor, content = table.filter(pa.array(new)), anchor[new], content[new]
        data, offsets = raw(table["bytes"].combine_chunks())
        copied = table["copies"].to_numpy() > 1
        found = np.stack(long_matches(RunIndex.of(data, offsets, copied), size))
        text, start, end = found[:, ~copied[found[0]]]
        doc, tell, base = (table[c].to_numpy() for c in ("doc", "tell", "start"))
        marked, count = np.unique(text, return_counts=True)
        lists = np.append(0, np.cumsum(count)).astype("int32")
        columns = [pa.ListArray.from_arrays(pa.array(lists), pa.array((x + base[text]).astype("int32"))) for x in (start, end)]
        return _batch(_MARKS, doc[marked], tell[marked], *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.nbytes >= MOST_BYTES:
                anchor = held["anchor"].to_numpy()
                size_before = np.append(0, np.cumsum(pc.binary_length(held["bytes"]).to_numpy()))
                edges = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
                cut = edges[size_before[edges] >= MOST_BYTES][:1]
                if not len(cut):
                    break
                yield marks(held.slice(0, int(cut[0])))
                held = held.slice(int(cut[0]))
        if held is not None and held.num_rows:
            yield marks(held)

    return run


# -- the corpus ------------------------------------------------------------------------------------------------------


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Write a narrow table to the shared folder and go on from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_doc`` and ``_tell``, by which rows of equal id and text are known; null ids are spread by text."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    tell = F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0).cast("long"))
    return docs.withColumn("_doc", doc).withColumn("_tell", tell)


def _runs_to(size: int, grams: tuple[int, ...]) -> list[int]:
    """``grams``, and on from the last one to whole windows: each leaves a fifth of what windows had beside the one before."""
    grams = list(grams)
    while grams[-1] < size:
        grams.append(size - (size - grams[-1]) // 5)
    return grams


def repeated_spans(docs: DataFrame, size: int = 400, grams: tuple[int, ...] = (64, 320), dealt: DataFrame | None = None) -> DataFrame:
    """``_doc, _tell, _starts, _ends``: byte spans of texts covered by strings of ``size`` bytes that also start elsewhere.

    Spans of a text may overlap. ``grams`` are the lengths of anchors, from the first for all windows to those for
    windows whose anchor has too many surroundings; longer ones up to whole windows follow by themselves. ``dealt`` are
    the keyed rows spread by ``_doc, _tell``, if they are at hand.
    """
    keyed = _keyed(docs.select("doc_id", "text"))
    texts = keyed.where(F.octet_length("text") >= size).select("_doc", "_tell", "text")
    dealt = keyed.repartition("_doc", "_tell") if dealt is None else dealt
    grams = _runs_to(size, grams)
    rows, placed, wanted = texts.mapInArrow(_stretches(size, grams[0]), _STRETCH), None, None
    for gram in [*grams[1:], None]:
        # Hashing a text costs more than keeping its stretches, which are read twice.
        rows = _stored(rows, "rows")
        # Any place of a stretch will do to fetch it: the columns of one row are first together.
        one = [F.first(c).alias(c) for c in ("doc", "tell", "start", "n", "times")]
        kinds = _stored(rows.groupBy("anchor", "content").agg(F.sum("copies").alias("copies"), *one), "kinds")
        # Of copies dealt out again, only one place is among the rows: all of theirs were marked before.
        copied = rows.where("copies = 1").join(kinds.where("copies > 1"), ["anchor", "content"], "left_semi")
        here = copied.select("doc", "tell", F.array("start").alias("starts"), F.array(F.col("start") + F.col("n") + (size - 1)).alias("ends"))
        placed = here if placed is None else placed.unionByName(here)
        # What is left to find is in stretches without copies whose anchor occurs again.
        sums = [F.sum("times").alias("times"), F.min("copies").alias("copies"), F.sum(F.col("n") + (size - 1)).alias("bytes")]
        again = _stored(kinds.groupBy("anchor").agg(*sums).where("times > 1 AND copies = 1").select("anchor", "bytes"), "again")
        hot = _stored(again.where(F.col("bytes") > MOST_BYTES).select("anchor"), "hot")
        last = gram is None or hot.isEmpty()
        fetch = (kinds if last else kinds.join(hot, "anchor", "left_anti")).join(again, "anchor", "left_semi")
        wanted = fetch if wanted is None else wanted.unionByName(fetch)
        if last:
            break
        parts = kinds.join(hot, "anchor", "left_semi").groupBy(F.col("doc").alias("_doc"), F.col("tell").alias("_tell"))
        parts = parts.agg(F.collect_list(F.struct("start", "n", "copies")).alias("_parts"))
        texts = _stored(texts.drop("_parts").join(parts, ["_doc", "_tell"]), "texts")
        rows = texts.mapInArrow(_stretches(size, gram), _STRETCH)
    fetch = F.collect_list(F.struct("anchor", "content", "copies", "start", "n")).alias("_wanted")
    fetch = wanted.groupBy(F.col("doc").alias("_doc"), F.col("tell").alias("_tell")).agg(fetch)
    fetched = dealt.join(fetch, ["_doc", "_tell"]).mapInArrow(_fetched(size), _BYTES)
    marks = fetched.repartition("anchor").sortWithinPartitions("anchor", "content").mapInArrow(_matches(size), _MARKS)
    lists = [F.flatten(F.collect_list(c)).alias(f"_{c}") for c in ("starts", "ends")]
    return placed.unionByName(marks).groupBy(F.col("doc").alias("_doc"), F.col("tell").alias("_tell")).agg(*lists)


def remove_repeats(docs: DataFrame, size: int = 400, grams: tuple[int, ...] = (64, 320)) -> DataFrame:
    """``docs`` (with ``doc_id, text``) and ``n_bytes, n_removed, n_spans, kept``.

    A byte of a text's UTF-8 form goes if it lies in a string of ``size`` bytes that also starts anywhere else, in the
    same text or in that of another row; so all copies go, strings may overlap, and none crosses texts. ``n_spans`` are
    the runs of bytes that went, ``kept`` the others, binary, as a cut may split a character. A null text is empty. Rows
    that repeat are copies of each other; ids may repeat or be null. Columns of the four names are replaced.

    Texts move once, by id; what is fetched and matched are different stretches of text whose anchor occurs again.
    Anchors and contents are known by 64-bit hashes, matches of different stretches by their bytes.
    """
    made = ("n_bytes", "n_removed", "n_spans", "kept")
    docs = docs.drop(*made)
    dealt = _keyed(docs).repartition("_doc", "_tell")
    spans = repeated_spans(docs, size, grams, dealt)
    marked = dealt.join(spans, ["_doc", "_tell"], "left").select(*[dealt[f"`{c}`"] for c in docs.columns], "_starts", "_ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in blocks(batch, most_bytes=2_000_000):
                yield _kept(rows)

    return marked.mapInArrow(run, added(docs, n_bytes="long", n_removed="long", n_spans="long", kept="binary"))


def _kept(rows: pa.RecordBatch) -> pa.RecordBatch:
    starts, ends = rows.columns[-2:]
    data, offsets = raw(rows.column("text"))
    sizes = pc.fill_null(pc.list_value_length(starts), 0).to_numpy(zero_copy_only=False)
    base = np.repeat(offsets[:-1], sizes)
    change = np.zeros(len(data) + 1, dtype="int64")
    np.add.at(change, base + starts.flatten().to_numpy(zero_copy_only=False), 1)
    np.add.at(change, base + ends.flatten().to_numpy(zero_copy_only=False), -1)
    gone = np.cumsum(change[:-1]) > 0
    first = gone.copy()
    first[1:] &= ~gone[:-1]
    at = offsets[:-1][offsets[:-1] < len(data)]
    first[at] = gone[at]
    per_text = lambda flags: np.diff(np.append(0, np.cumsum(flags))[offsets])
    n_bytes, n_removed, n_spans = np.diff(offsets), per_text(gone), per_text(first)
    kept_ends = np.append(0, np.cumsum(n_bytes - n_removed)).astype("int64")
    kept = pa.Array.from_buffers(
        pa.large_binary(), rows.num_rows, [None, pa.py_buffer(kept_ends), pa.py_buffer(np.ascontiguousarray(data[~gone]))]
    ).cast(pa.binary())
    columns = [*rows.columns[:-2], pa.array(n_bytes), pa.array(n_removed), pa.array(n_spans), kept]
    return pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names[:-2], "n_bytes", "n_removed", "n_spans", "kept"])
