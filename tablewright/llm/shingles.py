"""Distinct word shingles of texts as 64-bit hashes, on arrays.

The distinct words of a block of texts are found on arrays and compared byte by
byte; each is hashed by BLAKE2, so that words of any form have different hashes.

A-Z are lower-cased, words are runs of anything but space and U+0009-U+000D. A
text's set holds its distinct shingles of ``width`` words; a text with fewer
words has its whole sequence as its one shingle, one without words has none."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from tablewright.llm.pretokens import CHUNK_CHARS, _powers, distinct

_ODD = 0xD6E8FEB86659FD93


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    factor = np.random.default_rng(23).integers(1, 2**63, 256, dtype=np.uint64)
    factor[65:91] = factor[97:123]
    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    return factor, blank, _powers(_ODD, 2 * CHUNK_CHARS), _powers(pow(_ODD, -1, 2**64), 2 * CHUNK_CHARS)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (an invertible finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(texts: list[str], width: int) -> list[np.ndarray]:
    factor, blank, up, down = _tables()
    parts = [t.encode("utf-8") for t in texts]
    data = np.frombuffer(b"\n".join([b"", *parts, b""]), np.uint8)
    if len(data) > len(up):
        up, down = _powers(_ODD, len(data)), _powers(pow(_ODD, -1, 2**64), len(data))
    ends = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts)))
    space = blank[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    begin, stop = edge[::2], edge[1::2]
    total = factor[data]
    total *= up[:len(data)]
    np.cumsum(total, out=total)
    lower = data.copy()
    lower[(data >= 65) & (data <= 90)] += 32
    codes, first = distinct(lower, begin, stop, (total[stop - 1] - total[begin - 1]) * down[begin])
    spelled, of = lower.tobytes(), hashlib.blake2b
    hashed = b"".join(of(spelled[a:b], digest_size=8).digest() for a, b in zip(begin[first].tolist(), stop[first].tolist()))
    word = np.frombuffer(hashed, "<u8")[codes]
    rows = np.concatenate([[0], np.searchsorted(begin, ends)])
    gram = np.zeros(max(0, len(word) - width + 1), np.uint64)
    weight = _powers(0x9E6C63D0876A9A47, width + 1)[1:]
    for k in range(width):
        gram += word[k:k + len(gram)] * weight[k]
    gram = mix(gram)
    out = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(gram[a:b - width + 1]))
        elif b > a:
            out.append(mix(np.array([(word[a:b] * weight[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)])))
        else:
            out.append(gram[:0])
    return out


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (uint64) of each text."""
    held: list[str] = []
    size = 0
    for t in texts:
        held.append(t or "")
        size += len(held[-1]) + 1
        if size > CHUNK_CHARS // 2:
            yield from _hashes(held, width)
            held, size = [], 0
    if held:
        yield from _hashes(held, width)
