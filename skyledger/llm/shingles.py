"""Sets of word shingles as sorted 64-bit hashes, for many texts at once.

A-Z are lower-cased and words parted at ASCII white space. All words of a batch are hashed together:
each byte becomes a number, weighted by a power of an odd constant, and a running sum gives every word's
polynomial hash as a difference. Equal words have equal hashes; two unequal among 10^9 shingles meet
with a chance below 1 in 10 per corpus, and one meeting changes an intersection by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

WORDS = 5
# Texts are hashed in pieces of about so many bytes, cut between words, which bounds the memory of a task.
PIECE_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_GAP = re.compile(b"[\t-\r ]")

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        steps = np.full(n, _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
        steps[1:] = _BASE_INVERSE
        _inverses = np.cumprod(steps)


def _words_of(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of every word."""
    raw = np.frombuffer(piece, dtype=np.uint8)
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    _grow(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[_LOWER[raw]] * _powers[: len(raw)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * _inverses[starts])


def _long_words(text: bytes) -> np.ndarray:
    """Hashes of the words of one text, piece by piece."""
    found, at = [], 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE_BYTES)
        end = gap.start() if gap else len(text)
        found.append(_words_of(text[at:end])[1])
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def word_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The hashes of each text's words, in order; none for NULL."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if size + len(raw) > PIECE_BYTES and group:
            yield from _grouped(group)
            group, size = [], 0
        if len(raw) > PIECE_BYTES:
            yield _long_words(raw)
        else:
            group.append(raw)
            size += len(raw) + 1
    if group:
        yield from _grouped(group)


def _grouped(group: list[bytes]) -> Iterator[np.ndarray]:
    starts, hashes = _words_of(b"\n".join(group))
    bounds = np.cumsum([len(g) + 1 for g in group])
    yield from np.split(hashes, np.searchsorted(starts, bounds[:-1]))


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Each text's distinct shingles, sorted; a text of fewer words has its whole sequence as one."""
    for words in word_hashes(texts):
        n = min(WORDS, len(words))
        if n == 0:
            yield words
            continue
        value = np.full(len(words) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            value = value * _BASE + words[k : len(words) - n + 1 + k]
        yield np.unique(mix(value))


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    high = int(np.sum(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64))
    low = int(np.sum(mix(shingles + np.uint64(0x14057B7EF767814F)), dtype=np.uint64))
    return high - (1 << 63), low - (1 << 63)


_PLAIN = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def prefix_hashes(text: str | None, lengths: tuple[int, ...]) -> np.ndarray:
    """Hashes of the lower-cased words of a text, and of the first ``lengths`` bytes of the words that have them.

    Letters, digits and non-ASCII characters make up words.
    """
    raw = b"" if text is None else text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN)
    found = [np.empty(0, np.uint64)]
    at = 0
    while at < len(raw):
        gap = raw.find(b" ", at + PIECE_BYTES)
        piece = np.frombuffer(raw[at : gap if gap >= 0 else len(raw)], dtype=np.uint8)
        edges = np.flatnonzero(np.diff(np.concatenate(([False], piece != 32, [False])).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        _grow(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[piece] * _powers[: len(piece)], out=sums[1:])
        found.append(mix((sums[ends] - sums[starts]) * _inverses[starts]))
        for length in lengths:
            first = starts[ends - starts >= length]
            found.append(mix((sums[first + length] - sums[first]) * _inverses[first] + np.uint64(length)))
        at += len(piece)
    return np.concatenate(found)
