"""Benchmark passages in documents: shared character q-grams in diagonal bands, then banded alignment."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.llm.textbytes import blocks, raw

#: Length of the q-grams in bytes; eight fit one machine word.
Q = 8

_FOLD = np.full(256, 0x20, dtype="uint8")
_FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)

_MATCH = "array<struct<item_id:bigint,start:bigint,edits:int>>"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MAP_BITS = 21
#: Candidates hold the item's number in 16 bits.
_MOST_ITEMS = 65_535


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of texts as lower-case letters and digits with single spaces between, none at the ends."""
    data, offsets = raw(column)
    data = _FOLD[data]
    row_start = np.zeros(len(data) + 1, dtype=bool)
    row_start[offsets] = True
    space = data == 0x20
    keep = ~space
    # A space stays if it is the first after a letter and another letter follows in the row.
    keep[1:] |= space[1:] & ~space[:-1] & ~row_start[1:-1]
    ends = np.append(0, np.cumsum(keep))
    out = data[keep]
    offsets = ends[offsets]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    trailing = last[out[last] == 0x20]
    if len(trailing):
        left = np.ones(len(out), dtype=bool)
        left[trailing] = False
        offsets = offsets - np.searchsorted(trailing, offsets)
        out = out[left]
    return out, offsets


def _grams(data: np.ndarray) -> np.ndarray:
    """The Q bytes from each position as one number."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, dtype="uint64")
    return np.lib.stride_tricks.as_strided(np.ascontiguousarray(data), (n, Q), (1, 1)).copy().view("uint64").ravel()


def _edges(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether a word may begin or end before each byte, and at the end.

    Words are bounded by spaces, the ends of a text, Latin-1 signs, and characters of scripts written without spaces
    (U+2000 and up, Thai to Tibetan, Myanmar, Khmer).
    """
    n = len(data)
    second = np.append(data[1:], 0)
    lone = (data == 0x20) | (data == 0xC2) | (data >= 0xE2) | ((data == 0xE0) & (second >= 0xB8))
    lone |= (data == 0xE1) & (np.isin(second, (0x80, 0x81, 0x82, 0x9E, 0x9F)))
    lead = np.maximum.accumulate(np.where((data & 0xC0) != 0x80, np.arange(n), 0))
    lone = lone[lead]
    out = np.zeros(n + 1, dtype=bool)
    out[1:n] = lone[1:] | lone[:-1]
    out[offsets] = True
    return out


def _padded_grams(data: np.ndarray) -> np.ndarray:
    """The Q bytes from every position, zeros after the end."""
    return _grams(np.append(data, np.zeros(Q - 1, dtype="uint8")))


def _low(size: int) -> np.uint64:
    """Masks the first ``size`` bytes of a gram."""
    return np.uint64((1 << 8 * size) - 1)


@dataclass(frozen=True)
class BenchmarkIndex:
    """The q-grams of one block of benchmark items: sorted grams, their places, a bit map, and per-item bounds.

    Items with ``whole`` set must occur unchanged from word edge to word edge. Those under Q bytes are in ``tiny``, by
    size: sorted distinct bytes as numbers, first places, items.
    """

    ids: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    edits: np.ndarray
    least: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray
    whole: np.ndarray
    tiny: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def build_index(
    ids: np.ndarray, texts: pa.Array, edit_rate: float, min_chars: int, short_words: bool = False
) -> BenchmarkIndex | None:
    if len(ids) > _MOST_ITEMS:
        raise ValueError(f"{len(ids)} benchmark items in one block; {_MOST_ITEMS} can be numbered, lower block_bytes")
    data, offsets = normalised(texts)
    sizes = np.diff(offsets)
    # The lemma: with e edits, size - Q + 1 - Q * e q-grams stay; e is lowered where that would be none.
    edits = np.maximum(np.minimum((edit_rate * sizes).astype("int64"), (sizes - Q) // Q), 0)
    whole = sizes < max(min_chars, Q)
    edits[whole] = 0
    least = sizes - Q + 1 - Q * edits
    item = np.repeat(np.arange(len(ids)), sizes)
    gram = _grams(data)
    at = np.flatnonzero(item[: len(gram)] == item[Q - 1 :])
    spaces = np.append(0, np.cumsum(data == 0x20))[offsets]
    searched = short_words | (np.diff(spaces) > 0)
    tiny, padded = {}, _padded_grams(data)
    for size in range(1, Q):
        which = np.flatnonzero((sizes == size) & searched)
        value = padded[offsets[which]] & _low(size)
        order = np.argsort(value, kind="stable")
        values, first = np.unique(value[order], return_index=True)
        if len(which):
            tiny[size] = (values, np.append(first, len(which)), which[order])
    left = int(((sizes > 0) & (sizes < Q) & ~searched).sum())
    if left:
        warnings.warn(f"{left} benchmark items of one word under {Q} bytes are not searched for (short_words=False)", stacklevel=2)
    if not len(at) and not tiny:
        return None
    at = at[np.argsort(gram[at], kind="stable")]
    grams, first = np.unique(gram[at], return_index=True)
    seen = np.zeros(1 << _MAP_BITS, dtype=bool)
    seen[(grams * _FACTOR) >> np.uint64(64 - _MAP_BITS)] = True
    return BenchmarkIndex(
        ids, data, offsets, edits, least, grams, np.append(first, len(at)), item[at], at - offsets[item[at]], seen, whole, tiny
    )


def banded_distance(item: np.ndarray, region: np.ndarray, edits: int) -> tuple[int, int]:
    """Fewest edits that turn ``item`` into a part of ``region``, and where that part starts at the earliest.

    Rows are the item's characters, columns the region's; the ends of the region are free. The search stops when a row
    exceeds ``edits``; then the result is ``edits + 1``. Start positions travel along with the distances.
    """
    n = len(region)
    # Distance and start in one number, so that the smaller start wins among equal distances.
    scale = n + 2
    column = np.arange(n + 1)
    row = column.astype("int64")
    for letter in item:
        change = np.empty(n + 1, dtype="int64")
        change[0] = row[0] + scale
        change[1:] = np.minimum(row[:-1] + np.where(region == letter, 0, scale), row[1:] + scale)
        row = np.minimum.accumulate(change - column * scale) + column * scale
        if row.min() // scale > edits:
            return edits + 1, 0
    best = int(row.min())
    return best // scale, best % scale


def _candidates(data: np.ndarray, offsets: np.ndarray, index: BenchmarkIndex) -> np.ndarray:
    """Rows (text, item, band) whose bands hold enough shared q-grams.

    Bands are as wide as the edits of their item plus one and overlap by that much, so every alignment within the edits
    lies in one whole band. A q-gram of the text is matched with every place it has in the item.
    """
    if not len(index.grams):
        return np.zeros((0, 3), dtype="int64")
    gram = _grams(data)
    hit = np.flatnonzero(index.seen[(gram * _FACTOR) >> np.uint64(64 - _MAP_BITS)])
    at = np.minimum(np.searchsorted(index.grams, gram[hit]), len(index.grams) - 1)
    same = index.grams[at] == gram[hit]
    hit, at = hit[same], at[same]
    text = np.searchsorted(offsets, hit, side="right") - 1
    inside = hit + Q <= offsets[text + 1]
    hit, at, text = hit[inside], at[inside], text[inside]
    n = index.first[at + 1] - index.first[at]
    where = np.repeat(index.first[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    hit, text = np.repeat(hit, n), np.repeat(text, n)
    item, place = index.item[where], index.place[where]
    # Diagonals are shifted by the item's size to be positive.
    diagonal = hit - offsets[text] - place + np.diff(index.offsets)[item]
    width = index.edits[item] + 1
    band = diagonal // width
    pair = (text.astype("uint64") << np.uint64(48)) | (item.astype("uint64") << np.uint64(32))
    lower = band > 0
    key = np.concatenate([pair | band.astype("uint64"), (pair | (band - 1).astype("uint64"))[lower]])
    place = np.concatenate([place, place[lower]])
    names, key, count = np.unique(key, return_inverse=True, return_counts=True)
    least = index.least[((names >> np.uint64(32)) & np.uint64(0xFFFF)).astype("int64")]
    # Each q-gram of the item counts once in a band, however often the text repeats it.
    dense = (count >= least)[key]
    once = np.unique((key[dense].astype("uint64") << np.uint64(32)) | place[dense].astype("uint64"))
    count = np.bincount((once >> np.uint64(32)).astype("int64"), minlength=len(names))
    names = names[(count >= least) & (count > 0)]
    return np.stack([names >> np.uint64(48), (names >> np.uint64(32)) & np.uint64(0xFFFF), names & np.uint64(0xFFFFFFFF)], 1).astype("int64")


def _tiny_matches(data: np.ndarray, offsets: np.ndarray, edge: np.ndarray, index: BenchmarkIndex) -> Iterator[tuple[int, int, int]]:
    """Text, item and first place of the items under Q bytes."""
    gram, starts = _padded_grams(data), np.flatnonzero(edge[:-1])
    for size, (values, first, items) in index.tiny.items():
        hit = starts[starts + size <= len(data)]
        hit = hit[edge[hit + size]]
        value = gram[hit] & _low(size)
        at = np.minimum(np.searchsorted(values, value), len(values) - 1)
        same = values[at] == value
        hit, at = hit[same], at[same]
        text = np.searchsorted(offsets, hit, side="right") - 1
        inside = hit + size <= offsets[text + 1]
        hit, at, text = hit[inside], at[inside], text[inside]
        # Hits ascend, so the first of a text and value is the earliest.
        _, once = np.unique(text * len(values) + at, return_index=True)
        for k in once.tolist():
            for item in items[first[at[k]] : first[at[k] + 1]].tolist():
                yield int(text[k]), item, int(hit[k] - offsets[text[k]])


def _whole_place(letters: bytes, region: bytes, edge: np.ndarray) -> int:
    """First place of ``letters`` in ``region`` from word edge to word edge, or -1; ``edge`` has one entry more."""
    place = region.find(letters)
    while place >= 0 and not (edge[place] and edge[place + len(letters)]):
        place = region.find(letters, place + 1)
    return place


def _search(index: BenchmarkIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, most_bytes=1_000_000):
                for start in range(0, block.num_rows, 60_000):
                    yield _matched(block.slice(start, 60_000), index)

    return run


def _matched(part: pa.RecordBatch, index: BenchmarkIndex) -> pa.RecordBatch:
    data, offsets = normalised(part.column("text"))
    found = [list(m or ()) for m in part.column("_matches").to_pylist()]
    best: dict[tuple[int, int], tuple[int, int]] = {}
    edge = _edges(data, offsets) if len(data) and index.whole.any() else None
    if len(data) and index.tiny:
        best = {(text, item): (0, place) for text, item, place in _tiny_matches(data, offsets, edge, index)}
    for text, item, band in _candidates(data, offsets, index).tolist():
        letters = index.data[index.offsets[item] : index.offsets[item + 1]]
        edits = int(index.edits[item])
        known = best.get((text, item))
        if known and known[0] == 0:
            continue
        low = band * (edits + 1) - len(letters)
        a = max(0, low - edits)
        b = min(int(offsets[text + 1] - offsets[text]), low + 2 * (edits + 1) + len(letters) + edits)
        region = data[offsets[text] + a : offsets[text] + b]
        if index.whole[item]:
            begin = int(offsets[text]) + a
            exact = _whole_place(letters.tobytes(), region.tobytes(), edge[begin : begin + len(region) + 1])
            if exact >= 0:
                best[text, item] = (0, a + exact)
            continue
        exact = region.tobytes().find(letters.tobytes())
        distance, place = (0, exact) if exact >= 0 else banded_distance(letters, region, edits)
        if distance <= edits and (known is None or (distance, a + place) < known):
            best[text, item] = (distance, a + place)
    for (text, item), (distance, place) in sorted(best.items()):
        found[text].append({"item_id": int(index.ids[item]), "start": place, "edits": distance})
    matches = pa.array(found, part.schema.field("_matches").type)
    return pa.RecordBatch.from_arrays([*part.columns[:-1], matches], names=part.schema.names)


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    edit_rate: float = 0.1,
    min_chars: int = 32,
    block_bytes: int = 2_000_000,
    item_id: str = "item_id",
    item_text: str = "text",
    short_words: bool = False,
) -> DataFrame:
    """``docs`` (with ``text``) and ``matches``: the benchmark items found in each, with start and edits.

    An item is found where a part of the document aligns with the whole item in at most ``edit_rate`` edits a
    character; for short items fewer, so that the q-gram lemma still asks for one shared q-gram. Both sides are
    compared as lower-case letters and digits with single spaces between; ``start`` counts bytes in that form. Items
    shorter than ``min_chars`` there are found where they occur unchanged from word edge to word edge. A single word
    under Q bytes is searched for with ``short_words`` only (a warning tells how many are left out); null ids, null and
    empty texts are not. Null and empty documents have no matches. A part of an item is no match. The best alignment of an item is kept, the earliest of equal ones.

    The benchmark is taken in blocks of about ``block_bytes`` of text, formed by a hash of item id and text: each block is
    fetched, indexed and sent to the tasks, and the documents pass once per block. Documents are neither shuffled nor
    joined. Repeated items with one id are found as one item each; a column ``matches`` is replaced.
    """
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    items = items.where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    n_blocks = max(1, -(-(total[0] or 0) // block_bytes), -(-total[1] // 20_000))
    kept = docs.drop("matches")
    out = kept.withColumn("_matches", F.lit(None).cast(_MATCH))
    for block in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).orderBy("item_id", "text").toArrow()
        if part.num_rows:
            texts = part["text"].combine_chunks()
            index = build_index(part["item_id"].to_numpy(), texts, edit_rate, min_chars, short_words)
            if index is not None:
                out = out.mapInArrow(_search(index), out.schema)
    return out.withColumn("matches", F.coalesce("_matches", F.array().cast(_MATCH))).drop("_matches")
