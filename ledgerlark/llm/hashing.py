"""Word and shingle hashes of whole texts, vectorised over small groups of texts.

Words are maximal runs without ASCII white space, A-Z in lower case; both are byte rules, so they work on UTF-8.
A word's hash is a polynomial over its bytes, taken from running sums, so no word is cut out of the text.
Memory follows CHUNK, and for one longer text its number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 256 * 1024
SHINGLE = 5
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word (arithmetic wraps at 64 bits)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_STEP = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_STEP))
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0xD6E8FEB86659FD93
_PLACES = mix(np.arange(1, SHINGLE + 1, dtype=_U) * _U(0xA0761D6478BD642F)) | _U(1)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def _hash_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets and hashes of the words in a byte array."""
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[raw]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power_tables(len(raw))
    sums = np.zeros(len(raw) + 1, dtype=_U)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U) * _U(_STEP))


def _long_text(raw: bytes) -> np.ndarray:
    """Word hashes of one long text, worked through in pieces that end at white space."""
    out, at = [], 0
    while at < len(raw):
        end = at + CHUNK
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        out.append(_hash_words(np.frombuffer(raw, np.uint8, min(end, len(raw)) - at, at))[1])
        at = end
    return np.concatenate(out)


def word_hashes(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(index, word hashes) of each text, in order."""
    group, size, first = [], 0, 0

    def done() -> Iterator[tuple[int, np.ndarray]]:
        raw = np.frombuffer(b"\n".join(group), np.uint8)
        starts, hashes = _hash_words(raw)
        ends = np.cumsum([len(t) + 1 for t in group])
        cuts = np.searchsorted(starts, ends)
        for i, (a, b) in enumerate(zip([0, *cuts[:-1]], cuts, strict=True)):
            yield first + i, hashes[a:b]

    for i, t in enumerate(texts):
        if group and size + len(t) > CHUNK:
            yield from done()
            group, size, first = [], 0, i
        if len(t) > CHUNK:
            yield i, _long_text(t)
            first = i + 1
            continue
        group.append(t)
        size += len(t) + 1
    if group:
        yield from done()


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; fewer words count as one shingle, no words as none."""
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=_U)
    with np.errstate(over="ignore"):
        if n < SHINGLE:
            return mix(np.sum(words * _PLACES[:n], dtype=_U, keepdims=True) + _U(n))
        total = words[: n - SHINGLE + 1] * _PLACES[0]
        for j in range(1, SHINGLE):
            total = total + words[j : n - SHINGLE + 1 + j] * _PLACES[j]
        return np.unique(mix(total))
