"""Word and shingle hashes of whole texts, vectorised over bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

#: Bytes handled at once; longer texts are cut at white space only.
BLOCK = 1 << 20
PRIME = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def parts_of(text: bytes) -> Iterator[bytes]:
    """A very long text in parts, cut at white space (a word longer than BLOCK is left whole)."""
    start = 0
    while len(text) - start > BLOCK:
        end = max(text.rfind(b" ", start, start + BLOCK), text.rfind(b"\n", start, start + BLOCK))
        if end <= start:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


GAP = np.zeros(256, bool)
GAP[[32, *range(9, 14)]] = True
#: The low n bytes of a 64-bit number.
LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Longer words are hashed by themselves.
LONG = 4096


def _words(part: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts). Words are read eight bytes at once from where they start, so work is per word, not per byte."""
    if not part:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    gap = GAP[np.frombuffer(part, np.uint8)]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    edges = np.concatenate([edges[:0] if gap[0] else [0], edges, edges[:0] if gap[-1] else [len(part)]]).astype(np.int64)
    starts, sizes = edges[0::2], edges[1::2] - edges[0::2]
    at_byte = np.ndarray((len(part) + 1,), "<u8", part + bytes(8), 0, (1,))
    h = mixed((at_byte[starts] & LOW[np.minimum(sizes, 8)]) ^ (sizes.astype(np.uint64) * PRIME))
    more, k = np.flatnonzero((sizes > 8) & (sizes <= LONG)), 8
    while len(more):
        rest = sizes[more] - k
        h[more] = mixed((h[more] * PRIME) ^ (at_byte[starts[more] + k] & LOW[np.minimum(rest, 8)]))
        more, k = more[rest > 8], k + 8
    for i in np.flatnonzero(sizes > LONG):
        word = part[starts[i] : starts[i] + sizes[i]]
        h[i] = np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), np.uint64)[0]
    return h, starts


def words_with_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(a 64-bit hash of each word, where each starts)."""
    hashes, places, at = [], [], 0
    for part in parts_of(text):
        h, starts = _words(part)
        hashes.append(h)
        places.append(starts + at)
        at += len(part)
    return np.concatenate(hashes), np.concatenate(places)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order."""
    found = [_words(p)[0] for p in parts_of(text)]
    return found[0] if len(found) == 1 else np.concatenate(found)


def _joined(texts: list[bytes], size: int = 1 << 18) -> Iterator[list[bytes]]:
    """Texts in runs of about ``size`` bytes; longer ones by themselves."""
    run, total = [], 0
    for t in texts:
        if run and total + len(t) > size:
            yield run
            run, total = [], 0
        run.append(t)
        total += len(t)
    if run:
        yield run


def _runs(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes of all words of a run of texts, where each text's begin and the last's end)."""
    for run in _joined(texts):
        if len(run) == 1:
            h = word_hashes(run[0])
            yield h, np.array([0, len(h)])
        else:
            h, starts = _words(b"\n".join(run))
            yield h, np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(t) + 1 for t in run])]))


def word_hashes_of(texts: list[bytes]) -> Iterator[np.ndarray]:
    """word_hashes() of each text, many short texts at once."""
    for h, bounds in _runs(texts):
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield h[a:b]


def _combined(words: np.ndarray, size: int) -> np.ndarray:
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = h * PRIME + words[i : n + i]
        h ^= h >> np.uint64(32)
    return mixed(h)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def shingle_sets(texts: list[bytes], k: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; fewer words make one of all; none: empty."""
    for h, bounds in _runs(texts):
        every = _combined(h, k) if len(h) >= k else None
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield _distinct(every[a : b - k + 1]) if b - a >= k else _combined(h[a:b], b - a) if b > a else h[a:b]


def shingle_set(text: bytes, k: int = 5) -> np.ndarray:
    return next(shingle_sets([text], k))
