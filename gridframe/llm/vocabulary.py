"""Pieces of a unigram vocabulary with their scores, and the cutting of texts into independent segments."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from gridframe.llm.textbytes import BYTE_VALUES, mix, powers, raw

MARKER = "▁"
#: Added to the lowest score for a character that no piece covers.
UNKNOWN_PENALTY = -10.0


@dataclass(frozen=True)
class Vocabulary:
    """Ordinary pieces as bytes (marker as a space), their ids and scores; the ids of the 256 byte pieces."""

    pieces: tuple[bytes, ...]
    ids: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray

    @property
    def unknown_score(self) -> float:
        return float(self.scores.min()) + UNKNOWN_PENALTY if len(self.scores) else UNKNOWN_PENALTY


def default_path() -> str:
    """The public piece vocabulary of this machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load(path: str | None = None) -> Vocabulary:
    """Read a piece model on the driver. It must have the 256 byte pieces; its stored scores are the log scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or default_path())
    pieces, ids, scores, byte_ids = [], [], [], np.zeros(256, dtype="int32")
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
        elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
            pieces.append(piece.replace(MARKER, " ").encode())
            ids.append(i)
            scores.append(model.get_score(i))
    if not (byte_ids[1:] > 0).all():
        raise ValueError("the vocabulary has no byte pieces")
    if any(b" " in p.lstrip(b" ") for p in pieces):
        raise ValueError("a piece holds a marker after another character")
    return Vocabulary(tuple(pieces), np.array(ids, dtype="int32"), np.array(scores, dtype="float64"), byte_ids)


class Segments:
    """Texts cut where no piece can cross: before runs of spaces, and around ASCII characters in no piece.

    Every non-empty text gets one leading space first. The best segmentation of a text is then that of its segments one
    after the other, so each distinct segment of a slice is solved once. ``data`` holds the bytes with the leading
    spaces, ``starts`` and ``sizes`` the segments in it, ``of_text`` the first segment of each text, ``unique`` one
    segment number for each distinct one and ``which`` the distinct one of each segment.
    """

    def __init__(self, column: pa.Array, crossed: np.ndarray):
        source, offsets = raw(column)
        sizes = np.diff(offsets)
        lead = (sizes > 0).astype("int64")
        ends = np.cumsum(sizes + lead)
        begins = ends - sizes - lead
        self.data = np.full(int(ends[-1]) if len(ends) else 0, 0x20, dtype="uint8")
        text = np.repeat(np.arange(len(sizes)), sizes)
        self.data[np.arange(len(source)) + np.cumsum(lead)[text]] = source
        n = len(self.data)
        space, alone = self.data == 0x20, ~crossed[self.data]
        first = alone.copy()
        first[1:] |= alone[:-1] | (space[1:] & ~space[:-1])
        first[begins[begins < n]] = True
        self.starts = np.flatnonzero(first)
        self.sizes = np.diff(np.append(self.starts, n))
        self.of_text = np.searchsorted(self.starts, np.append(begins, n))
        value = mix(np.add.reduceat(_spread(self.data, self.starts, self.sizes), self.starts)) if n else np.zeros(0, dtype="uint64")
        value ^= self.sizes.astype("uint64") << np.uint64(56)
        _, self.unique, self.which = np.unique(value, return_index=True, return_inverse=True)

    def bytes_of(self, segment: int) -> bytes:
        return self.data[self.starts[segment] : self.starts[segment] + self.sizes[segment]].tobytes()


def _spread(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    return BYTE_VALUES[data] * powers(int(sizes.max()))[place]


def crossed_bytes(vocabulary: Vocabulary) -> np.ndarray:
    """Which bytes occur in pieces; bytes above ASCII always count as such."""
    out = np.zeros(256, dtype=bool)
    out[0x80:] = True
    out[0x20] = True
    for piece in vocabulary.pieces:
        out[list(piece)] = True
    return out


#: Bytes of a character by its first byte; stray bytes stand alone.
CHAR_BYTES = np.ones(256, dtype="int64")
CHAR_BYTES[0xC2:0xE0] = 2
CHAR_BYTES[0xE0:0xF0] = 3
CHAR_BYTES[0xF0:0xF5] = 4
