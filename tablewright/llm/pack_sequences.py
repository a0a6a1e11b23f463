"""Operator 9: token ids packed into sequences, best fit decreasing.

Every task tokenizes its own texts and packs them, block by block: nothing is
shuffled, and a lost task repeats its own blocks only. A document longer than a
sequence is split without loss: its full-length parts are sequences of their
own and its last part is packed. A block's parts go, longest first, to the open
sequence with the least room that is still enough; a segment tree over the room
of the open sequences finds it in logarithmic time.

A row is one sequence: padded ids (a row of the id matrix), cumulative segment
lengths, position ids that start again at every segment, and where the segments
come from, so that documents can be put together again.

Cases: a null or empty text is one segment with the end id only; repeated rows
are packed each; an id may be null; an empty table gives no sequence; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.shared import prepare

#: Tokens of unpacked parts that a task holds before it packs them.
BLOCK_TOKENS = 2_000_000


class RoomTree:
    """How many open sequences have which room left; a segment tree over the
    room 0..size, each node with the number of sequences below it."""

    def __init__(self, size: int):
        self.leaves = 1 << (size + 1).bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += n
            node >>= 1

    def least_at_least(self, room: int) -> int:
        """The least room of an open sequence that is ``room`` or more, or -1."""
        count, node = self.count, room + self.leaves
        if count[node]:
            return room
        while node > 1:
            if not node & 1 and count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return -1


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Indices of ``sizes`` in each sequence; every size is 1..capacity."""
    tree, open_at = RoomTree(capacity), [[] for _ in range(capacity + 1)]
    out: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        room = tree.least_at_least(sizes[i])
        if room < 0:
            out.append([])
            at, room = len(out) - 1, capacity
        else:
            at = open_at[room].pop()
            tree.add(room, -1)
        out[at].append(i)
        open_at[room - sizes[i]].append(at)
        tree.add(room - sizes[i], 1)
    return out


def pack(df: DataFrame, make_encoder: Callable, capacity: int, end_id: int, vocabulary: int,
         id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Rows: sequence_id long (unique), n_tokens int, input_ids binary
    (``capacity`` little-endian ids, padded with ``end_id``; two bytes each if
    ``vocabulary`` fits, else four), position_ids binary (alike, 0 where
    padded), cu_seqlens array<int> (from 0 to n_tokens), segments
    array<struct<id, start long>> (document and its ids before the segment).
    ``make_encoder()`` gives an object whose ``ids`` encodes a list of texts."""
    from pyspark.sql.pandas.types import to_arrow_schema

    prepare(df.sparkSession)
    kind = df.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("sequence_id", T.LongType()), T.StructField("n_tokens", T.IntegerType()),
        T.StructField("input_ids", T.BinaryType()), T.StructField("position_ids", T.BinaryType()),
        T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
        T.StructField("segments", T.ArrayType(T.StructType([T.StructField(id_col, kind), T.StructField("start", T.LongType())])))])
    arrow = to_arrow_schema(schema)
    width = "<u2" if vocabulary <= 2**16 and capacity <= 2**16 else "<u4"
    upto = np.arange(capacity, dtype=width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, number = make_encoder(), TaskContext.get().partitionId() << 33
        waiting: list[tuple] = []                      # (document, start, ids) not yet packed
        held = 0

        def rows(groups: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for k in range(0, len(groups), 1000):
                some = groups[k:k + 1000]
                ids, places, ends = [], [], []
                for group in some:
                    row, place = np.full(capacity, end_id, width), np.zeros(capacity, width)
                    at, end = 0, [0]
                    for _, _, x in group:
                        row[at:at + len(x)] = x
                        place[at:at + len(x)] = upto[:len(x)]
                        at += len(x)
                        end.append(at)
                    ids.append(row.tobytes()), places.append(place.tobytes()), ends.append(end)
                yield pa.record_batch([
                    pa.array(range(number, number + len(some)), pa.int64()), pa.array([e[-1] for e in ends], pa.int32()),
                    pa.array(ids, pa.binary()), pa.array(places, pa.binary()), pa.array(ends, arrow.field(4).type),
                    pa.array([[{id_col: d, "start": s} for d, s, _ in g] for g in some], arrow.field(5).type)], schema=arrow)
                number += len(some)

        def packed() -> Iterator[pa.RecordBatch]:
            yield from rows([[waiting[i] for i in group]
                             for group in best_fit_decreasing([len(x[2]) for x in waiting], capacity)])
            waiting.clear()

        for batch in batches:
            found = encoder.ids([t or "" for t in batch.column(1).to_pylist()])
            full = []
            for doc, ids in zip(batch.column(0).to_pylist(), found):
                ids = np.append(ids, np.uint32(end_id)).astype(width)
                cut = len(ids) // capacity * capacity
                full += [[(doc, s, ids[s:s + capacity])] for s in range(0, cut, capacity)]
                if cut < len(ids):
                    waiting.append((doc, cut, ids[cut:]))
                    held += len(ids) - cut
            yield from rows(full)
            if held >= block_tokens:
                yield from packed()
                held = 0
        yield from packed()

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def write_sequences(sequences: DataFrame, path: str) -> None:
    """The packed matrix as Parquet: one row of it per record, rows of a file in
    the order of ``sequence_id`` (no shuffle; each task sorts its own rows)."""
    sequences.sortWithinPartitions("sequence_id").write.parquet(path)
