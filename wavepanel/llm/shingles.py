"""Hashed word shingles of whole texts, vectorised over batches.

Words are the runs of bytes other than ASCII white space, after A-Z have been
lower-cased.  A word's 64-bit hash is a polynomial over a random byte table,
so that all words of a batch come from one running sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Bytes of text that are turned into hashes at a time.
BATCH_BYTES = 1 << 18

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = int(_rng.integers(0, 1 << 60)) * 8 + 5
_INVERSE = pow(_MULT, -1, 1 << 64)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = 1 << max(16, (n - 1).bit_length())
        got = np.full(size, np.uint64(base), np.uint64)
        got[0] = 1
        got = _powers[base] = np.multiply.accumulate(got)
    return got[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the words of lower-cased bytes."""
    if not data:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate(([False], ~_WHITE[raw], [False]))
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = turn[::2], turn[1::2]
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _power(_MULT, len(raw)), out=total[1:])
    value = (total[end] - total[start]) * _power(_INVERSE, len(raw) + 1)[start]
    return mix(value + (end - start).astype(np.uint64)), start


def words(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Word hashes of each text, in order."""
    group: list[bytes] = []
    size = 0
    for t in texts:
        if len(t) > BATCH_BYTES:
            yield from _flush(group)
            group, size = [], 0
            yield _huge(t)
            continue
        group.append(t)
        size += len(t) + 1
        if size > BATCH_BYTES:
            yield from _flush(group)
            group, size = [], 0
    yield from _flush(group)


def _flush(group: list[bytes]) -> Iterator[np.ndarray]:
    if not group:
        return
    value, start = _word_hashes(b"\n".join(group).lower())
    ends = np.cumsum([len(t) + 1 for t in group])
    cut = np.searchsorted(start, ends)
    yield from np.split(value, cut[:-1])


def _huge(text: bytes) -> np.ndarray:
    """Word hashes of a long text, a span of whole words at a time."""
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + BATCH_BYTES)
        while end < len(text) and not _WHITE[text[end]]:
            end += 1
        out.append(_word_hashes(text[at:end].lower())[0])
        at = end
    return np.concatenate(out)


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer words are one."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(n, k)
    acc = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + hashes[i:n - width + 1 + i])
    return np.unique(acc)


def set_name(s: np.ndarray) -> int:
    """64-bit name of a set, as a signed integer."""
    import xxhash
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes()))))
