"""Operator 1: byte-level BPE encoding and decoding.

Each task cuts its texts into the pattern's words and keeps the distinct ones
as byte arrays. The ranked merges are folded over all distinct words of a chunk
at once: a state is the ids of all pieces and the rank of every pair of
neighbours, and a step merges, in every word that still has a ranked pair, the
leftmost pair of lowest rank. The rank map is a constant of two hash tables
(cuckoo hashing), so a look-up reads two cells at most. The ids of the words
then go to the places of the words of each text. Decoding concatenates the
byte pieces of the ids. Nothing is shuffled.

The fold runs on arrays inside the tasks. The same fold as Spark higher-order
functions gave the same ids but took about 150 microseconds of CPU for a word
(README), forty times as long.

Cases: a null or empty text has no ids (empty binary); repeated rows give a row
each; an id may be null; an empty table gives an empty result; other columns
are ignored. Texts of any length are cut between words, so memory follows the
ids of one text; words of more than ``LONG`` bytes are merged one by one with a
heap, in a time that grows with their length and its logarithm.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.pretokens import Encoder, Words
from tablewright.llm.shared import prepare

#: Ids must fit into so many bits to share a 64-bit cell with a pair of ids.
ID_BITS = 20
NO_RANK = np.int64(2**62)
#: Words of more bytes are merged one by one with a heap.
LONG = 256


def load_ranks(path: str) -> dict[bytes, int]:
    """A public rank file: a base64 piece and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _primes(least: int) -> Iterator[int]:
    n = least | 1
    while True:
        if all(n % d for d in range(3, int(n**0.5) + 1, 2)):
            yield n
        n += 2


def cuckoo(keys: list[int], load: float = 0.38) -> tuple[list[int], list[int]]:
    """Two tables with each key in one of two cells: ``key % len(table)``."""
    sizes = _primes(int(len(keys) / 2 / load) + 3)
    p, q = next(sizes), next(sizes)
    while True:
        tables = ([-1] * p, [-1] * q)
        for key in keys:
            side = 0
            for _ in range(200):
                table = tables[side]
                at = key % len(table)
                key, table[at] = table[at], key
                if key < 0:
                    break
                side = 1 - side
            else:
                break
        else:
            return tables
        p, q = q, next(sizes)


class RankMap:
    """Rank of the piece that two neighbouring pieces make, by their ids."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values(), default=0) >= 2**ID_BITS:
            raise ValueError(f"ids need at most {ID_BITS} bits")
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        value = {(ranks[t[:k]] << ID_BITS) + ranks[t[k:]]: r for t, r in ranks.items()
                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.tables = [np.array([(k << ID_BITS) + value[k] if k >= 0 else -1 for k in table], np.int64)
                       for table in cuckoo(list(value))]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << ID_BITS) + b
        out = np.full(len(key), NO_RANK)
        for table in self.tables:
            cell = table[key % len(table)]
            np.copyto(out, cell & (2**ID_BITS - 1), where=(cell >> ID_BITS) == key)
        return out

    def merge(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as bytes, one word after the other with ``sizes``
        bytes each (none empty), and the number of ids of each word."""
        word = np.repeat(np.arange(len(sizes)), sizes)
        ids = self.byte_ids[data]
        rank = np.full(len(ids), NO_RANK)
        pair = np.flatnonzero(word[1:] == word[:-1])
        rank[pair] = self.rank(ids[pair], ids[pair + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low = np.minimum.reduceat(rank, begin)
            going = low < NO_RANK
            many = np.diff(np.append(begin, len(ids)))
            going_at = np.repeat(going, many)
            done.append((word[~going_at], ids[~going_at]))
            word, ids, rank = word[going_at], ids[going_at], rank[going_at]
            if not len(ids):
                break
            lowest = np.repeat(low[going], many[going])
            hit = np.flatnonzero(rank == lowest)
            at = hit[np.concatenate([[True], word[hit[1:]] != word[hit[:-1]]])]   # leftmost of each word
            ids[at] = lowest[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))                     # places once the right halves are gone
            word, ids, rank = word[keep], ids[keep], rank[keep]
            rank[at] = NO_RANK
            for left in (at, at[at > 0] - 1):
                left = left[left + 1 < len(ids)]
                left = left[word[left] == word[left + 1]]
                rank[left] = self.rank(ids[left], ids[left + 1])
        words, out = (np.concatenate([x[k] for x in done]) for k in (0, 1)) if done else (np.zeros(0, np.int64),) * 2
        return out[np.argsort(words, kind="stable")].astype(np.uint32), np.bincount(words, minlength=len(sizes))


    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one word, in a time that grows with its length and its logarithm:
        the next merge comes from a heap, and places are linked to their neighbours."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        rank = self.rank(ids[:-1], ids[1:])
        n, ids = len(ids), ids.tolist()
        heap = [(r, k) for k, r in enumerate(rank.tolist()) if r < NO_RANK]
        heapq.heapify(heap)
        held = [*rank.tolist(), int(NO_RANK)]             # rank of the pair that begins at a place
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        memo: dict[tuple[int, int], int] = {}

        def ranked(k: int) -> None:
            held[k] = int(NO_RANK)
            if k >= 0 and after[k] < n:
                pair = (ids[k], ids[after[k]])
                if pair not in memo:
                    memo[pair] = int(self.rank(np.array([pair[0]]), np.array([pair[1]]))[0])
                held[k] = memo[pair]
                if held[k] < NO_RANK:
                    heapq.heappush(heap, (held[k], k))

        while heap:
            r, k = heapq.heappop(heap)
            if held[k] != r:
                continue
            gone = after[k]
            ids[k], held[gone], after[k] = r, int(NO_RANK), after[gone]
            if after[k] < n:
                before[after[k]] = k
            ids[gone] = -1
            ranked(k)
            if before[k] >= 0:
                ranked(before[k])
        return np.array([x for x in ids if x >= 0], np.uint32)


class RankEncoder(Encoder):
    """Ids of texts by ranks; words that are pieces themselves are one id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.map, self.special = ranks, RankMap(ranks), frozenset()
        self.forget()

    def _learn(self, part: Words, new: np.ndarray) -> None:
        order = np.concatenate([new[~part.blank[new]], new[part.blank[new]]])
        raw = [w.encode("utf-8") for w in part.texts(order)]
        whole = np.fromiter((self.ranks.get(w, -1) for w in raw), np.int64, len(raw))
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        rest = np.flatnonzero(whole < 0)
        short, long_ = rest[size[rest] <= LONG], rest[size[rest] > LONG]
        merged, many = self.map.merge(np.frombuffer(b"".join(raw[k] for k in short.tolist()), np.uint8), size[short])
        apart = [self.map.merge_long(raw[k]) for k in long_.tolist()]
        sizes = np.ones(len(raw), np.int64)
        sizes[short], sizes[long_] = many, [len(x) for x in apart]
        flat = np.empty(int(sizes.sum()), np.uint32)
        way = np.zeros(len(raw), np.int8)
        way[short], way[long_] = 1, 2
        way = np.repeat(way, sizes)
        flat[way == 0], flat[way == 1] = whole[whole >= 0], merged
        flat[way == 2] = np.concatenate([np.zeros(0, np.uint32), *apart])
        self.flat, self.sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])


def _same_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def encode(df: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_tokens``, ``ids`` (binary, little-endian unsigned 32-bit)
    of every whole text, as the public library encodes ordinary text."""
    prepare(df.sparkSession)
    schema = pa.schema([(id_col, _same_type(df, id_col)), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = RankEncoder(ranks)
        for batch in batches:
            found = encoder.ids([t or "" for t in batch.column(1).to_pylist()])
            yield pa.record_batch([batch.column(0), pa.array([len(x) for x in found], pa.int64()),
                                   pa.array([x.astype("<u4").tobytes() for x in found], pa.binary())], schema=schema)

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, T.StructType([
        df.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]))


def decode(df: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` (binary): the pieces of the ids, concatenated.
    Null ids decode to null; a column ``decoded`` that is there is replaced."""
    prepare(df.sparkSession)
    pieces = {r: t for t, r in ranks.items()}
    kept = [f for f in df.schema.fields if f.name != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pieces.__getitem__
        for batch in batches:
            texts = [None if x is None else b"".join(map(piece, np.frombuffer(x, "<u4").tolist()))
                     for x in batch.column(batch.schema.get_field_index(ids_col)).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"])

    return df.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(
        run, T.StructType([*kept, T.StructField("decoded", T.BinaryType())]))
