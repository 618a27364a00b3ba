"""Plain one-process versions of the operators, to hold the Spark ones against."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def kept_words(rows, k=20):
    """(doc_id, text) rows -> list of (doc_id, n_words, n_removed, sha256 of the kept words)."""
    first = {}
    for doc, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - k + 1):
            key = tuple(words[i : i + k])
            first[key] = min(first.get(key, (doc, i)), (doc, i))
    out = []
    for doc, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - k + 1):
            if first[tuple(words[i : i + k])] < (doc, i):
                gone[i : i + k] = [True] * k
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def shingles(text, size=5):
    words = WORD.findall((text or "").translate(FOLD))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def components(rows):
    """(doc_id, text) rows -> sorted (doc_id, n_shingles, component_id)."""
    sets = {doc: shingles(text) for doc, text in rows}
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted((doc, len(sets[doc]), root(doc)) for doc in names)


def edit_distance_within(item, text):
    """Fewest edits from ``item`` to any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j - 1] + (a != b), last[j] + 1, row[j - 1] + 1))
    return min(row)


def normalised(text):
    text = (text or "").translate(FOLD)
    return re.sub(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", " ", text).strip()


def viterbi(text, scores, unknown):
    """Best total and number of pieces over the characters of ``text`` with spaces as markers."""
    best = [(0.0, 0)] + [(float("-inf"), 0)] * len(text)
    longest = max(map(len, scores))
    for i in range(len(text)):
        alone = False
        for j in range(i + 1, min(len(text), i + longest) + 1):
            piece = text[i:j]
            if piece in scores:
                alone = alone or j == i + 1
                if best[i][0] + scores[piece] > best[j][0]:
                    best[j] = (best[i][0] + scores[piece], best[i][1] + 1)
        if not alone and best[i][0] + unknown > best[i + 1][0]:
            best[i + 1] = (best[i][0] + unknown, best[i][1] + len(text[i].encode()))
    return best[-1]
