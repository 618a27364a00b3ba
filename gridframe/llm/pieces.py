"""Encoding to pieces by unigram Viterbi over a double-array trie, with byte fallback, and decoding."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridframe.llm.textbytes import added, blocks
from gridframe.llm.vocabulary import CHAR_BYTES, Segments, Vocabulary, crossed_bytes


@dataclass(frozen=True)
class DoubleArray:
    """A trie over bytes: the child of ``state`` by ``c`` is ``base[state] + c`` if ``check`` there names ``state``."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray


def build_trie(pieces: tuple[bytes, ...]) -> DoubleArray:
    """Place the nodes level by level, each at the first base where all its children find free slots."""
    children: list[dict[int, int]] = [{}]
    end = {}
    for number, piece in enumerate(pieces):
        node = 0
        for c in piece:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
            node = children[node][c]
        end.setdefault(node, number)
    used = bytearray(b"\x01") + bytearray(4 * len(children) + 1024)
    base, check = np.zeros(len(used), dtype="int32"), np.full(len(used), -1, dtype="int32")
    piece = np.full(len(used), -1, dtype="int32")
    free, wide, slot, queue = 1, 1, {0: 0}, [0]
    check[0] = 0
    for node in queue:
        state = slot[node]
        piece[state] = end.get(node, -1)
        codes = sorted(children[node])
        if not codes:
            continue
        free = used.index(0, free)
        # Single children fill the gaps; nodes with several start where the last long search ended.
        at = max((free if len(codes) == 1 else max(free, wide)) - codes[0], 1)
        tried = 0
        while used[at + codes[0]] or any(used[at + c] for c in codes):
            at = used.index(0, at + codes[0] + 1) - codes[0]
            tried += 1
        if tried > 16:
            wide = at
        base[state] = at
        for c in codes:
            used[at + c] = 1
            check[at + c] = state
            slot[children[node][c]] = at + c
            queue.append(children[node][c])
    last = int(np.flatnonzero(check >= 0)[-1]) + 257
    return DoubleArray(base[:last], check[:last], piece[:last])


def best_pieces(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, trie: DoubleArray, vocabulary: Vocabulary):
    """Piece ids of each segment and their number, by Viterbi over all segments at once, position by position.

    A piece replaces another that ends at the same place only with a higher total, and starts are visited in order: of
    equal totals the one whose last piece is longer stays, as in the tokenizer. Where no piece covers exactly one
    character, the character itself may be used at the lowest score less a penalty; it becomes its byte pieces.
    """
    order = np.argsort(-sizes, kind="stable")
    offset = np.empty(len(sizes), dtype="int64")
    offset[order] = np.cumsum(sizes[order] + 1) - sizes[order] - 1
    total = int((sizes + 1).sum())
    best = np.full(total, -np.inf)
    best[offset] = 0
    chosen, came = np.full(total, -2, dtype="int32"), np.zeros(total, dtype="int32")
    size_of = np.array([len(p) for p in vocabulary.pieces], dtype="int64")
    longest = int(size_of.max()) if len(size_of) else 0
    descending = -sizes[order]
    for at in range(int(sizes.max()) if len(sizes) else 0):
        active = order[: np.searchsorted(descending, -at)]
        here = best[offset[active] + at]
        active, here = active[here > -np.inf], here[here > -np.inf]
        char = np.minimum(CHAR_BYTES[data[starts[active] + at]], sizes[active] - at)
        alone = np.zeros(len(active), dtype=bool)
        walk, state = np.arange(len(active)), np.zeros(len(active), dtype="int64")
        for step in range(longest):
            inside = sizes[active[walk]] > at + step
            walk, state = walk[inside], state[inside]
            child = trie.base[state] + data[starts[active[walk]] + at + step]
            good = (trie.base[state] > 0) & (trie.check[child] == state)
            walk, state = walk[good], child[good].astype("int64")
            if not len(walk):
                break
            piece = trie.piece[state]
            hit = piece >= 0
            w, p = walk[hit], piece[hit]
            alone[w[char[w] == step + 1]] = True
            to, value = offset[active[w]] + at + step + 1, here[w] + vocabulary.scores[p]
            better = value > best[to]
            best[to[better]], chosen[to[better]], came[to[better]] = value[better], p[better], step + 1
        w = np.flatnonzero(~alone)
        to, value = offset[active[w]] + at + char[w], here[w] + vocabulary.unknown_score
        better = value > best[to]
        best[to[better]], chosen[to[better]], came[to[better]] = value[better], -1, char[w][better]
    # Back from the ends: one piece, or the bytes of one character, at each step.
    owner, ids, place = [], [], []
    segment, at, step = np.arange(len(sizes)), sizes.copy(), 0
    while len(segment):
        node = offset[segment] + at
        piece, width = chosen[node], came[node].astype("int64")
        owner.append(segment[piece >= 0])
        ids.append(vocabulary.ids[piece[piece >= 0]])
        place.append(np.full(len(owner[-1]), step))
        for back in range(1, 5):
            u = np.flatnonzero((piece < 0) & (width >= back))
            owner.append(segment[u])
            ids.append(vocabulary.byte_ids[data[starts[segment[u]] + at[u] - back]])
            place.append(np.full(len(u), step + back - 1))
        step += 4
        at = at - width
        segment, at = segment[at > 0], at[at > 0]
    owner, ids, place = (np.concatenate(x) if x else np.zeros(0, dtype="int64") for x in (owner, ids, place))
    by = np.lexsort((-place, owner))
    return ids[by].astype("int32"), np.bincount(owner, minlength=len(sizes)), best[offset + sizes]


#: Bytes of text that a task encodes at a time.
SLICE = 500_000


def _encoder(vocabulary: Vocabulary) -> tuple:
    return build_trie(vocabulary.pieces), vocabulary, crossed_bytes(vocabulary)


def _encoded(column: pa.Array, encoder: tuple) -> pa.ListArray:
    """Piece ids of each text."""
    trie, vocabulary, crossed = encoder
    s = Segments(column, crossed)
    ids, counts, _ = best_pieces(s.data, s.starts[s.unique], s.sizes[s.unique], trie, vocabulary)
    first = np.cumsum(counts) - counts
    n = counts[s.which]
    ends = np.append(0, np.cumsum(n))
    source = np.repeat(first[s.which] - ends[:-1], n) + np.arange(int(ends[-1]))
    return pa.ListArray.from_arrays(ends[s.of_text].astype("int32"), pa.array(ids[source]))


def _decoder(vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all ids end to end, and how many each has; the last one stands for ids outside the vocabulary."""
    table = {int(i): p for i, p in zip(vocabulary.ids, vocabulary.pieces)}
    table |= {int(i): bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
    spelled = [table.get(i, "\ufffd".encode()) for i in range(max(table) + 2)]
    return np.frombuffer(b"".join(spelled), dtype="uint8"), np.array([len(x) for x in spelled], dtype="int64")


def _decoded(column: pa.ListArray, decoder: tuple[np.ndarray, np.ndarray]) -> pa.Array:
    """Text of each list of ids."""
    letters, sizes = decoder
    first, last = np.cumsum(sizes) - sizes, len(sizes) - 1
    counts = np.array(column.value_lengths().fill_null(0))
    ids = column.flatten().fill_null(last).to_numpy(zero_copy_only=False).astype("int64")
    ids = np.where((ids < 0) | (ids > last), last, ids)
    n = sizes[ids]
    ends = np.append(0, np.cumsum(n))
    data = letters[np.repeat(first[ids] - ends[:-1], n) + np.arange(int(ends[-1]))].tobytes()
    cuts = ends[np.append(0, np.cumsum(counts))]
    texts = [data[a:b].decode(errors="replace") for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.array([t[1:] if t[:1] == " " else t for t in texts], pa.string())


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``pieces``, the piece ids of the whole text; a null or empty text has none.

    Spaces are markers, one is put before the text, and every character without a piece is written in byte pieces, so
    decoding gives back any text, markers in it included. Rows stay where they are. A column ``pieces`` is replaced.
    The trie, bounded by the vocabulary, is broadcast.
    """
    kept = docs.drop("pieces")
    shared = docs.sparkSession.sparkContext.broadcast(_encoder(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, text, SLICE):
                lists = _encoded(part.column(text), shared.value)
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "pieces"])

    return kept.mapInArrow(run, added(kept, pieces="array<int>"))


def decode(encoded: DataFrame, vocabulary: Vocabulary, pieces: str = "pieces", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its piece ids: bytes joined, markers turned into spaces, the first space taken off.

    Ids outside the vocabulary and bytes that are no UTF-8 become U+FFFD. Null or empty lists give an empty text.
    """
    kept = encoded.drop(into)
    shared = encoded.sparkSession.sparkContext.broadcast(_decoder(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                texts = _decoded(part.column(pieces), shared.value)
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, into])

    return kept.mapInArrow(run, added(kept, **{into: "string"}))


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass: ``docs`` with ``pieces`` and the ``decoded`` text of those ids.

    One Python process a task does both, with half the memory of the two steps one after the other.
    """
    kept = docs.drop("pieces", "decoded")
    shared = docs.sparkSession.sparkContext.broadcast((_encoder(vocabulary), _decoder(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = shared.value
        for batch in batches:
            for part in blocks(batch, text, SLICE):
                lists = _encoded(part.column(text), encoder)
                columns = [*part.columns, lists, _decoded(lists, decoder)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "pieces", "decoded"])

    return kept.mapInArrow(run, added(kept, pieces="array<int>", decoded="string"))
