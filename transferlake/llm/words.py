"""Words and word shingles of many texts at once, in numpy.

A word is a maximal run of ASCII letters, digits, underscore or any non-ASCII code point, of
the lower-cased text. A shingle is ``width`` words in a row; a text of fewer words has one
shingle, all its words; a text of no words has none. Words and shingles are 64-bit hashes:
a polynomial of the bytes, then a finaliser, so equal words have equal hashes in every task.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_MULT = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULT, -1, 1 << 64)
PIECE = 1 << 20                       # bytes hashed at once; longer texts go piece by piece

IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(48, 58), *range(97, 123), 95, *range(128, 256)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[int, np.ndarray] = {}    # powers, made once in each worker


def _table(base: int) -> np.ndarray:
    if base not in _TABLES:
        _TABLES[base] = _powers(base, PIECE + 1)
    return _TABLES[base]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words of at most PIECE bytes."""
    edge = np.diff(np.concatenate(([0], IS_WORD[raw].view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.zeros(len(raw) + 1, dtype=U)
    np.cumsum((raw.astype(U) + U(1)) * _table(_MULT)[: len(raw)], out=total[1:])
    return starts, ends, mix((total[ends] - total[starts]) * _table(_INVERSE)[starts] ^ (ends - starts).astype(U))


def _pieces(raw: np.ndarray):
    """Cuts at a byte outside words, so that no word is split (a word longer than PIECE is)."""
    at = 0
    while len(raw) - at > PIECE:
        gaps = np.flatnonzero(~IS_WORD[raw[at:at + PIECE]])
        cut = at + (int(gaps[-1]) + 1 if len(gaps) else PIECE)
        yield at, raw[at:cut]
        at = cut
    yield at, raw[at:]


def word_table(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, first byte of each text, starts, ends, hashes, text of each word); texts are
    joined by one newline."""
    parts = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    lengths = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    first = np.concatenate(([0], np.cumsum(lengths)[:-1])) if parts else np.zeros(0, np.int64)
    found = [(at + s, at + e, h) for at, piece in _pieces(raw) for s, e, h in [_word_hashes(piece)]]
    starts, ends, hashes = (np.concatenate(x) for x in zip(*found))
    return raw, first, starts, ends, hashes, np.searchsorted(first, starts, side="right") - 1


def shingle_table(texts: list, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes in text order, text of each shingle); repeats are kept."""
    _, _, _, _, words, owner = word_table(texts)
    return shingles_of(words, owner, len(texts), width)


def shingles_of(words: np.ndarray, owner: np.ndarray, n: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    lane = mix(np.arange(1, width + 1, dtype=U) * U(_MULT)) | U(1)
    counts = np.bincount(owner, minlength=n)
    full = max(0, len(words) - width + 1)
    sums = np.zeros(full, dtype=U)
    for j in range(width):
        sums += words[j:j + full] * lane[j]
    whole = owner[:full] == owner[width - 1:width - 1 + full]
    sums, at = sums[whole], owner[:full][whole]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        rest = np.array([int(np.sum(words[first[d]:first[d] + counts[d]] * lane[: counts[d]], dtype=U)) for d in short], dtype=U)
        sums, at = np.concatenate((sums, rest)), np.concatenate((at, short))
        order = np.argsort(at, kind="stable")
        sums, at = sums[order], at[order]
    return mix(sums), at


def batches(texts, size: int = PIECE):
    """Index ranges of a text list whose code points add up to about ``size``."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t or "") + 1
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def shingle_sets(texts: list, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    for a, b in batches(texts):
        hashes, owner = shingle_table(texts[a:b], width)
        cuts = np.searchsorted(owner, np.arange(b - a + 1))
        out += [np.unique(hashes[cuts[i]:cuts[i + 1]]) for i in range(b - a)]
    return out
