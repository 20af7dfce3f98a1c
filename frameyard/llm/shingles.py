"""Word shingles of UTF-8 texts as sorted arrays of 64-bit hashes, with NumPy."""

from __future__ import annotations

import numpy as np
import xxhash

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
SEGMENT = 1 << 20
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = min(SEGMENT + 64, max(n, 1 << 16)) if n <= SEGMENT + 64 else n
        for name, b in (("up", BASE), ("down", INVERSE)):
            p = np.full(size, b, "u8")
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _segment_words(b: np.ndarray) -> np.ndarray:
    space = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True]))))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, "u8")
    up, down = _powers(len(b) + 1)
    total = np.zeros(len(b) + 1, "u8")
    np.cumsum((b.astype("u8") + np.uint64(1)) * up[: len(b)], out=total[1:])
    out = mix((total[end] - total[start]) * down[start] + (end - start).astype("u8"))
    for i in np.flatnonzero(end - start > LONG_WORD):  # built strings of 1024 and more characters meet under every base
        out[i] = xxhash.xxh3_64_intdigest(b[start[i] : end[i]].tobytes())
    return out


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash of each word [^\\x20\\x09-\\x0D]+ with A-Z lower-cased; long texts go in segments that end at spaces."""
    raw = raw.lower()
    if len(raw) <= SEGMENT:
        return _segment_words(np.frombuffer(raw, "u1"))
    out, at = [], 0
    while at < len(raw):
        end = at + SEGMENT
        while end < len(raw) and raw[end] not in b" \t\n\v\f\r":
            end += 1
        out.append(_segment_words(np.frombuffer(raw, "u1", count=min(end, len(raw)) - at, offset=at)))
        at = end
    return np.concatenate(out)


def shingle_set(raw: bytes | None, n: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; fewer words make one shingle; no words none."""
    w = word_hashes(raw or b"")
    if not len(w):
        return w
    size = min(n, len(w))
    h = np.zeros(len(w) - size + 1, "u8")
    for i in range(size):
        h = h * np.uint64(0xD6E8FEB86659FD93) + w[i : len(w) - size + 1 + i]
    return np.unique(mix(h + np.uint64(size)))
