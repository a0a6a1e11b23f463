"""Splitting texts by the public pre-tokenizer pattern on whole arrays.

The pattern (``public_tokenizers.PATTERN``) cuts a text into contractions, runs
of letters, numbers or other signs with at most one space before them, and
white space. Each of its alternatives ends where the class of the character
changes, so the cuts of a whole block of texts follow from one array of
character classes; no pattern is run over the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd

SIGN, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Characters of text that one pass of array operations covers.
CHUNK_CHARS = 1_500_000
#: The contractions of the pattern.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Class of every code point; one random factor for each code point; the
    powers of an odd base and their inverses (all modulo 2**64)."""
    import regex

    everything = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\x00" for c in range(0x110000))
    kind = np.zeros(0x110000, np.uint8)
    for value, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, everything):
            kind[m.start():m.end()] = value
    factor = np.random.default_rng(11).integers(1, 2**63, 0x110000, dtype=np.uint64)
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 2**64)
    return kind, factor, _powers(base, 2 * CHUNK_CHARS), _powers(inverse, 2 * CHUNK_CHARS)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _long(base_powers: np.ndarray, n: int) -> np.ndarray:
    return base_powers if n <= len(base_powers) else _powers(int(base_powers[1]), n)


_CUT = re.compile(r"\S(?=[ \t\r\n])")


def pieces(texts: Iterable[str], size: int = CHUNK_CHARS) -> Iterator[tuple[int, str]]:
    """(index of the text, part of it) with parts of about ``size`` characters.
    Parts end before white space that follows another character, where every
    match of the pattern ends too, so cutting there changes no match."""
    for i, text in enumerate(texts):
        start = 0
        while len(text) - start > size:
            m = _CUT.search(text, start + size)
            if m is None:
                break
            yield i, text[start:m.end()]
            start = m.end()
        yield i, text[start:]


@dataclass
class Words:
    """The words of some text parts, in order: ``codes`` number the distinct
    words, ``counts`` has the number of words of each part. A distinct word has
    a place in ``joined``, and may be white space (``blank``)."""
    codes: np.ndarray
    counts: np.ndarray
    begin: np.ndarray
    stop: np.ndarray
    blank: np.ndarray
    joined: str

    def texts(self, which: np.ndarray) -> list[str]:
        joined = self.joined
        return [joined[a:b] for a, b in zip(self.begin[which].tolist(), self.stop[which].tolist())]


def starts_of(cp: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the pattern's matches begin in the code points ``cp`` of several
    texts set one after the other; text j ends before ``ends[j]``."""
    n = len(cp)
    kind = _tables()[0][cp]
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    inner = ends[ends < n]
    change[inner] = True
    run = np.flatnonzero(change)
    stop = np.append(run[1:], n)
    of = kind[run]
    final = np.zeros(n + 1, bool)
    final[ends] = True
    last = final[stop]                                   # the run ends its text
    space = of == SPACE
    gives = space & ~last & (cp[stop - 1] == 0x20)       # its last space goes to the next run
    takes = np.zeros(len(run), bool)
    takes[1:] = gives[:-1]
    begin = np.zeros(n, bool)
    begin[run[~space] - takes[~space]] = True
    begin[run[space & (~gives | (stop - run > 1))]] = True
    begin[stop[space & ~last & ~gives] - 1] = True
    lone = np.flatnonzero((cp[run] == 0x27) & (stop - run == 1) & (of == SIGN) & ~takes & ~last)
    for r in lone[of[lone + 1] == LETTER] if len(lone) else ():
        s, e = int(stop[r]), int(stop[r + 1])
        after = "".join(map(chr, cp[s:min(e, s + 2)]))
        size = next((len(c) - 1 for c in CONTRACTIONS if after.startswith(c[1:])), 0)
        if size:
            begin[s] = False
            if s + size < e:
                begin[s + size] = True
    return np.flatnonzero(begin)


def words_of(parts: list[str]) -> Words:
    """Words of the parts of texts, equal words under one code."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    joined = "".join(parts)
    none = np.zeros(0, np.int64)
    if not joined:
        return Words(none, np.zeros(len(parts), np.int64), none, none, none.astype(bool), "")
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(sizes)
    begin = starts_of(cp, ends)
    kind, factor, up, down = _tables()
    up, down = _long(up, len(cp)), _long(down, len(cp))
    total = factor[cp]
    total *= up[:len(cp)]
    np.cumsum(total, out=total)
    stop = np.append(begin[1:], len(cp))
    key = total[stop - 1]
    key[1:] -= total[begin[1:] - 1]
    key *= down[begin]
    codes, first = distinct(cp, begin, stop, key)
    edge = np.searchsorted(begin, np.concatenate([[0], ends]))
    last = stop[first]
    return Words(codes, np.diff(edge), begin[first], last, kind[cp[last - 1]] == SPACE, joined)


def distinct(data: np.ndarray, begin: np.ndarray, stop: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the distinct stretches ``data[begin:stop]`` for each stretch, and
    the first stretch of each number. ``key`` only has to be equal for equal
    stretches: every stretch is compared with the first one of its key, and if any
    differs, the stretches themselves are numbered."""
    def firsts(codes: np.ndarray, n: int) -> np.ndarray:
        first = np.empty(n, np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        return first

    codes, unique = pd.factorize(key)
    first = firsts(codes, len(unique))
    of, size = first[codes], stop - begin
    same = (size == size[of]).all()
    if same:
        other = np.flatnonzero(of != np.arange(len(of)))
        for k in range(0, len(other), 200_000):
            at = other[k:k + 200_000]
            n = size[at]
            inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            if not (data[np.repeat(begin[at], n) + inside] == data[np.repeat(begin[of[at]], n) + inside]).all():
                same = False
                break
    if not same:
        whole = np.empty(len(begin), object)
        whole[:] = [data[a:b].tobytes() for a, b in zip(begin.tolist(), stop.tolist())]
        codes, unique = pd.factorize(whole)
        first = firsts(codes, len(unique))
    return codes, first


def chunks(texts: list[str], size: int = CHUNK_CHARS) -> Iterator[tuple[list[int], Words]]:
    """Words of ``texts`` in steps of about ``size`` characters, with the index
    of the text that each part of the step belongs to."""
    index: list[int] = []
    parts: list[str] = []
    held = 0
    for i, part in pieces(texts, size):
        if parts and held + len(part) > size:
            yield index, words_of(parts)
            index, parts, held = [], [], 0
        index.append(i)
        parts.append(part)
        held += len(part)
    if parts:
        yield index, words_of(parts)


def spread_ids(codes: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids of the words ``codes``, one word after the other; word c has the
    ``sizes[c]`` ids that stand in ``flat`` after those of the words before c."""
    begin = np.cumsum(sizes) - sizes
    many = sizes[codes]
    shift = begin[codes] - (np.cumsum(many) - many)
    return flat[np.repeat(shift, many) + np.arange(int(many.sum()))]


class Encoder:
    """Token ids of whole texts by a ``tiktoken.Encoding`` whose pattern is the
    public one. Every distinct word is encoded once, many in one call; words
    seen are kept from chunk to chunk, up to ``KEPT``."""
    KEPT = 150_000

    def __init__(self, encoding, special: frozenset[str] = frozenset()):
        self.encoding, self.special = encoding, special
        n = encoding.n_vocab
        self.width = np.zeros(n, np.int64)
        for token in encoding.token_byte_values():
            self.width[encoding.encode_single_token(token)] = len(token)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.sizes = np.zeros(0, np.int64)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has. The
        words are joined by line feeds, which stand alone under the pattern
        before anything but white space."""
        text = "\n".join([*words, ""])
        ids = np.array(self.encoding.encode_ordinary(text), np.uint32)
        stop = np.flatnonzero(np.frombuffer(text.encode("utf-8"), np.uint8) == 10)
        begin = np.concatenate([[0], stop[:-1] + 1])
        end = np.cumsum(self.width[ids])
        at = np.searchsorted(end, begin, "right")
        many = np.searchsorted(end, stop, "right") - at
        take = np.repeat(at - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        return ids[take], many

    def _learn(self, part: Words, new: np.ndarray) -> None:
        plain, blank = new[~part.blank[new]], new[part.blank[new]]
        flat, sizes = self._encode(part.texts(plain)) if len(plain) else (self.flat[:0], self.sizes[:0])
        singly = [self.encoding.encode_ordinary(w) for w in part.texts(blank)]
        self.flat = np.concatenate([self.flat, flat, *(np.array(x, np.uint32) for x in singly)])
        self.sizes = np.concatenate([self.sizes, sizes, np.array([len(x) for x in singly], np.int64)])

    def _plain_ids(self, texts: list[str]) -> list[np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for index, part in chunks(texts):
            if len(self.known) > self.KEPT:
                self.forget()
            known, held = self.known, len(self.known)
            texts = part.texts(np.arange(len(part.begin)))
            row = np.fromiter((known.get(w, -1) for w in texts), np.int64, len(texts))
            new = np.flatnonzero(row < 0)
            if len(new):
                self._learn(part, new)
                order = np.concatenate([new[~part.blank[new]], new[part.blank[new]]])
                row[order] = np.arange(held, held + len(order))
                known.update((texts[k], held + n) for n, k in enumerate(order.tolist()))
            codes = row[part.codes]
            ids = spread_ids(codes, self.flat, self.sizes)
            edge = np.concatenate([[0], np.cumsum(self.sizes[codes])])
            place = edge[np.concatenate([[0], np.cumsum(part.counts)])].tolist()
            for k, i in enumerate(index):
                out[i].append(ids[place[k]:place[k + 1]])
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, np.uint32) for x in out]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the strings of ``special`` are cut out first and
        give their own id."""
        if not any(s in t for s in self.special for t in texts):
            return self._plain_ids(texts)
        cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        out = []
        for t in texts:
            parts = cut.split(t)
            plain = iter(self._plain_ids(parts[::2]))
            out.append(np.concatenate([next(plain) if k % 2 == 0 else np.array([self.encoding.encode_single_token(p)], np.uint32)
                                       for k, p in enumerate(parts)]))
        return out


def encoding(ranks_path: str, pattern: str, special: dict[str, int] | None = None):
    """The public ``tiktoken`` encoding of a rank file."""
    import base64

    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special or {})
