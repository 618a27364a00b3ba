"""Token counts without tokens: Aho-Corasick matches of a unigram vocabulary and Viterbi over scores and counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridframe.llm.pieces import DoubleArray, build_trie
from gridframe.llm.textbytes import added, blocks
from gridframe.llm.vocabulary import Segments, Vocabulary, crossed_bytes


@dataclass(frozen=True)
class Automaton:
    """A trie with, for each state, its longest proper suffix that is a state, and the next suffix that is a piece."""

    trie: DoubleArray
    fail: np.ndarray
    output: np.ndarray


def _child(trie: DoubleArray, state: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The child of each state by its byte, or -1."""
    to = trie.base[state] + code
    return np.where((trie.base[state] > 0) & (trie.check[to] == state), to, -1)


def _step(trie: DoubleArray, fail: np.ndarray, state: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The state after one more byte: fall back to suffixes until one has the byte, or to the root."""
    to = _child(trie, state, code)
    at = state.copy()
    waiting = np.flatnonzero((to < 0) & (at > 0))
    while len(waiting):
        at[waiting] = fail[at[waiting]]
        to[waiting] = _child(trie, at[waiting], code[waiting])
        waiting = waiting[(to[waiting] < 0) & (at[waiting] > 0)]
    return np.maximum(to, 0)


def build_automaton(vocabulary: Vocabulary) -> Automaton:
    """Suffix links of the trie, level by level from the root."""
    trie = build_trie(vocabulary.pieces)
    fail, output = np.zeros(len(trie.base), dtype="int64"), np.full(len(trie.base), -1, dtype="int64")
    states = np.flatnonzero(trie.check >= 0)
    states = states[states > 0]
    parents = trie.check[states].astype("int64")
    level = parents == 0
    while len(states):
        now, above = states[level], parents[level]
        deep = above > 0
        code = now - trie.base[above]
        fail[now[deep]] = _step(trie, fail, fail[above[deep]], code[deep])
        output[now] = np.where((trie.piece[fail[now]] >= 0) & (fail[now] > 0), fail[now], output[fail[now]])
        states, parents = states[~level], parents[~level]
        level = np.isin(parents, now)
    return Automaton(trie, fail, output)


def count(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, automaton: Automaton, vocabulary: Vocabulary):
    """Number of pieces and total score of the best segmentation of each segment, over all segments at once.

    Only the best score and its piece count are carried. Matches that end at one place come longest first and replace
    each other only by higher totals: of equal totals the longest stays, as in the tokenizer, which visits starts in
    order. A character without a piece of its own may stand alone; it counts once per byte.
    """
    order = np.argsort(-sizes, kind="stable")
    offset = np.empty(len(sizes), dtype="int64")
    offset[order] = np.cumsum(sizes[order] + 1) - sizes[order] - 1
    best = np.zeros(int((sizes + 1).sum()))
    pieces = np.zeros(len(best), dtype="int64")
    size_of = np.array([len(p) for p in vocabulary.pieces] + [0], dtype="int64")
    state, width = np.zeros(len(sizes), dtype="int64"), np.zeros(len(sizes), dtype="int64")
    descending = -sizes[order]
    for at in range(int(sizes.max()) if len(sizes) else 0):
        active = order[: np.searchsorted(descending, -at)]
        code = data[starts[active] + at]
        state[active] = _step(automaton.trie, automaton.fail, state[active], code.astype("int64"))
        width[active] = np.where((code & 0xC0) == 0x80, width[active] + 1, 1)
        here = offset[active] + at + 1
        top, number = np.full(len(active), -np.inf), np.zeros(len(active), dtype="int64")
        own = np.zeros(len(active), dtype=bool)
        match = state[active]
        walk = np.flatnonzero((automaton.trie.piece[match] >= 0) | (automaton.output[match] >= 0))
        match = match[walk]
        skip = automaton.trie.piece[match] < 0
        match[skip] = automaton.output[match[skip]]
        while len(walk):
            piece = automaton.trie.piece[match]
            size = size_of[piece]
            own[walk[size == width[active[walk]]]] = True
            total = best[here[walk] - size] + vocabulary.scores[piece]
            better = total > top[walk]
            top[walk[better]], number[walk[better]] = total[better], pieces[(here[walk] - size)[better]] + 1
            match = automaton.output[match]
            walk, match = walk[match >= 0], match[match >= 0]
        last = np.minimum(starts[active] + at + 1, len(data) - 1)
        whole = (at + 1 == sizes[active]) | ((data[last] & 0xC0) != 0x80)
        u = np.flatnonzero(~own & whole)
        total = best[here[u] - width[active[u]]] + vocabulary.unknown_score
        better = total > top[u]
        top[u[better]], number[u[better]] = total[better], (pieces[here[u] - width[active[u]]] + width[active[u]])[better]
        best[here], pieces[here] = top, number
    return pieces[offset + sizes], best[offset + sizes]


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``score`` of the whole text; both 0 for a null or empty one.

    The automaton, bounded by the vocabulary, is broadcast; each distinct segment of a slice of texts is solved once.
    Rows stay where they are. Columns of the two names are replaced.
    """
    kept = docs.drop("n_tokens", "score")
    shared = docs.sparkSession.sparkContext.broadcast((build_automaton(vocabulary), vocabulary, crossed_bytes(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, words, crossed = shared.value
        for batch in batches:
            for part in blocks(batch, text, most_bytes=4_000_000):
                s = Segments(part.column(text), crossed)
                numbers, scores = count(s.data, s.starts[s.unique], s.sizes[s.unique], automaton, words)
                n = np.append(0, np.cumsum(numbers[s.which]))
                n = n[s.of_text[1:]] - n[s.of_text[:-1]]
                of = np.repeat(np.arange(part.num_rows), np.diff(s.of_text))
                total = np.bincount(of, scores[s.which], part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(n), pa.array(total)], names=[*part.schema.names, "n_tokens", "score"]
                )

    return kept.mapInArrow(run, added(kept, n_tokens="long", score="double"))
