"""Operator 10: near-duplicate documents by circulant MinHash.

Two permutations make all signature coordinates: the first one scatters the
shingles over a universe, the second one, shifted by one place for every
coordinate, ranks them; coordinate k is the least rank at shift k. Bands of the
signature give candidates; every link is then confirmed on the full shingle
sets. ``banding`` chooses the bands for a wanted recall at the threshold.

Documents with equal sets are one node, so copies never make pairs. In a bucket
of several nodes every node is first compared to the least one (a row per node,
not per pair). Buckets whose nodes are joined by then are done. The others are
split into blocks, and every block meets every block of its bucket: a task
counts the common shingles of its nodes by products of incidence matrices and
emits edges between components only. So no candidate is lost and no pairs are
rows; the comparisons still grow with the square of a bucket whose nodes are
alike but not linked.

Cases: null and empty texts, or texts without words, have an empty set and link
with nothing. Repeated rows have equal results. Rows with a null id take part;
a group of such rows only has a null component. An empty table gives an empty
result; other columns are ignored. Texts of any length are used whole.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.graph import components, stars
from tablewright.llm.shared import prepare, written

#: Coordinates of a signature at most, and the universe of the permutations.
COORDINATES, UNIVERSE = 126, 2**20
#: Nodes and shingles that a block of a large bucket holds.
BLOCK_NODES, BLOCK_SHINGLES = 512, 500_000
#: Bits that mark the ids of candidates: 131,072 numbers of 64 bits, whatever the input.
BITS = 2**23
#: Share of pairs at the threshold that the bands may miss.
MISS = 1e-4


def banding(similarity: float, coordinates: int = COORDINATES, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows of a band): the longest rows that keep the wanted recall."""
    for rows in range(16, 1, -1):
        bands = coordinates // rows
        if (1 - similarity**rows) ** bands <= miss:
            return bands, rows
    return coordinates, 1


class Circulant:
    def __init__(self, bands: int, rows: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.bands, self.rows, n = bands, rows, bands * rows
        self.scatter = rng.permutation(UNIVERSE).astype(np.uint32)
        rank = rng.permutation(UNIVERSE).astype(np.uint32)
        self.shifted = np.lib.stride_tricks.sliding_window_view(np.concatenate([rank, rank[:n]]), n)
        self.weight = rng.integers(1, 2**63, (bands, rows), dtype=np.uint64) | np.uint64(1)
        self.salt = rng.integers(1, 2**63, bands, dtype=np.uint64)

    def signature(self, items: np.ndarray) -> np.ndarray:
        """All coordinates of a set of hashes (not empty)."""
        at = self.scatter[(items % np.uint64(UNIVERSE)).astype(np.int64)]
        out = None
        for k in range(0, len(at), 2048):
            low = self.shifted[at[k:k + 2048]].min(axis=0)
            out = low if out is None else np.minimum(out, low)
        return out

    def buckets(self, items: np.ndarray) -> np.ndarray:
        """One 64-bit key for each band."""
        from tablewright.llm.shingles import mix

        part = self.signature(items).reshape(self.bands, self.rows).astype(np.uint64)
        return mix((part * self.weight).sum(axis=1, dtype=np.uint64) + self.salt).view(np.int64)


def _digest(items: np.ndarray) -> tuple[int, int]:
    """The same for equal sets only: 128 bits of a SHA-256."""
    high, low = struct.unpack("<qq", hashlib.sha256(items.tobytes()).digest()[:16])
    return high, low


def _signed(df: DataFrame, keep: dict[str, str], text_col: str, width: int, bands: int, rows: int) -> DataFrame:
    """The columns ``keep`` (as their new names), n_shingles, the set's digest as
    high and low (null for an empty set) and the buckets."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = df.select(*[F.col(f"`{c}`").alias(name) for name, c in keep.items()])
    added = T._parse_datatype_string("n_shingles bigint, high bigint, low bigint, buckets array<bigint>")
    out = T.StructType([*kept.schema.fields, *added.fields])
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tablewright.llm.shingles import shingle_sets

        permutations = Circulant(bands, rows)
        for batch in batches:
            size, high, low, keys = [], [], [], []
            for items in shingle_sets(batch.column(len(keep)).to_pylist(), width):
                a, b = _digest(items) if len(items) else (None, None)
                size.append(len(items)), high.append(a), low.append(b)
                keys.append(permutations.buckets(items) if len(items) else None)
            yield pa.record_batch([*batch.columns[:len(keep)], pa.array(size, pa.int64()), pa.array(high, pa.int64()),
                                   pa.array(low, pa.int64()), pa.array(keys, schema.field("buckets").type)], schema=schema)

    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in keep.items()], F.col(f"`{text_col}`").alias("_text")).mapInArrow(run, out)


def maybe_among(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``df`` with ``_maybe``, whether its key may be among those of ``wanted``: their
    hashes are marked in ``BITS`` bits, a table of a fixed size. False is certain; a
    bit that another key has set may give true."""
    at = lambda: F.pmod(F.xxhash64(key), F.lit(BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_at").bitwiseAND(F.lit(63)).cast("int"))
    marks = wanted.where(F.col(key).isNotNull()).select(at().alias("_at")).select(F.shiftright("_at", 6).alias("_word"), bit.alias("_bit"))
    marks = marks.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))       # at most BITS / 64 rows
    held = df.withColumn("_at", at()).withColumn("_of", F.shiftright("_at", 6)).join(
        F.broadcast(marks), F.col("_of") == F.col("_word"), "left")
    return held.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False)).alias("_maybe"))


def _sets(df: DataFrame, text_col: str, width: int) -> DataFrame:
    """node and its set (binary) of every row whose text has the digest that is
    expected (``high`` and ``low``) of its ``node``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tablewright.llm.shingles import shingle_sets

        for batch in batches:
            want = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist())
            found = [(node, x) for (node, high, low), x in zip(want, shingle_sets(batch.column(0).to_pylist(), width))
                     if len(x) and _digest(x) == (high, low)]
            yield pa.record_batch([pa.array([n for n, _ in found], pa.int64()), pa.array([x.tobytes() for _, x in found], pa.binary())],
                                  names=["node", "items"])

    return df.select(F.col(text_col), "node", "high", "low").mapInArrow(run, "node bigint, items binary")


def _digested(df: DataFrame, text_col: str, width: int) -> DataFrame:
    """Digest and set (binary) of every text that has one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tablewright.llm.shingles import shingle_sets

        for batch in batches:
            found = [x for x in shingle_sets(batch.column(0).to_pylist(), width) if len(x)]
            digests = [_digest(x) for x in found]
            yield pa.record_batch([pa.array([a for a, _ in digests], pa.int64()), pa.array([b for _, b in digests], pa.int64()),
                                   pa.array([x.tobytes() for x in found], pa.binary())], names=["high", "low", "items"])

    return df.select(F.col(text_col)).mapInArrow(run, "high bigint, low bigint, items binary")


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, held, one = [], None, None
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = x.as_buffer(), y.as_buffer()
                if held is None or not held.equals(x):
                    held, one = x, np.frombuffer(x, np.uint64)
                two = np.frombuffer(y, np.uint64)
                if len(one) < len(two):
                    small, large = one, two
                else:
                    small, large = two, one
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                common = int((large[at] == small).sum())
                keep.append(100 * common >= percent * (len(one) + len(two) - common))
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def common_items(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """How many items each of the sets ``rows`` shares with every other set."""
    items = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]
    first = np.concatenate([[True], items[1:] != items[:-1]])
    number = np.cumsum(first) - 1
    shared = np.bincount(number)[number] > 1               # the others are in one set only
    number, owner = number[shared], owner[shared]
    number = np.cumsum(np.concatenate([[False], number[1:] != number[:-1]])) if len(number) else number
    out = np.zeros((len(rows), len(sets)), np.float32)
    last = int(number[-1]) + 1 if len(number) else 0
    for k in range(0, last, 4096):                          # a bounded slice of the incidence matrix
        a, b = np.searchsorted(number, [k, k + 4096])
        has = np.zeros((len(sets), min(4096, last - k)), np.float32)
        has[owner[a:b], number[a:b] - k] = 1
        out += has[rows] @ has.T
    return out.astype(np.int64)


def _joins(percent: int):
    """Edges between the components that links within a block of a bucket join.
    Nodes of the block's largest component need not meet each other."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("node")
        component, kind = np.unique(frame["component"].to_numpy(np.int64), return_inverse=True)
        if len(component) < 2:
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        rows = np.flatnonzero(kind != np.bincount(kind).argmax())
        sets = [np.frombuffer(x, np.uint64) for x in frame["items"]]
        size = np.array([len(x) for x in sets])
        both = common_items(sets, rows)
        linked = (100 * both >= percent * (size[rows][:, None] + size[None, :] - both)) & (kind[rows][:, None] != kind[None, :])
        i, j = np.nonzero(linked)
        a, b = stars(component[kind[rows[i]]], component[kind[j]])
        return pd.DataFrame({"a": a, "b": b})

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("items").alias("one"))
    b = sets.select(F.col("node").alias("b"), F.col("items").alias("two"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "one", "two").mapInArrow(_linked(percent), "a bigint, b bigint")


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id that
    links reach), kept (id = component_id). A link holds between documents with
    100 * intersection >= percent * union of their sets."""
    out = grouped(df, {"id": id_col}, width, percent, text_col)
    least = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_col), "n_shingles", least.alias("component_id")).withColumn(
        "kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def grouped(df: DataFrame, keep: dict[str, str], width: int, percent: int, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (new name: column; one is ``id``) of every row with
    n_shingles, ``component`` (a number of the group that links join; null for
    rows without words) and ``least``, the group's smallest id. Equal sets are one
    node, named by the first row that has it."""
    prepare(df.sparkSession)
    bands, rows = banding(percent / 100)
    signed = _signed(df, keep, text_col, width, bands, rows)
    docs = written(signed.withColumn("row", F.monotonically_increasing_id()), "signed")
    nodes = docs.where("high is not null").groupBy("high", "low").agg(
        F.min("row").alias("node"), F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets"), F.min("id").alias("first_id"))
    nodes = written(nodes, "nodes")
    every = nodes.select("node", "n", F.explode("buckets").alias("bucket"))
    hubs = every.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("hub"), F.max("node").alias("last")).where(
        "hub.node <> last").select(F.col("bucket").alias("at"), "hub")
    members = written(every.join(hubs, F.col("bucket") == F.col("at")).select("bucket", "node", "n", "hub"), "members")

    def alike(m: str, n: str):               # a larger set cannot be that similar
        return (100 * F.least(m, n) >= percent * F.greatest(m, n))

    first = members.where(F.col("node") != F.col("hub.node")).where(alike("n", "hub.n")).select(
        F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct()
    first = written(first, "hub-pairs")
    # The sets of candidates only, each once; everything else about a document stays out of the joins.
    wanted = members.select("node").distinct()
    wanted = written(nodes.join(wanted, "node", "left_semi").select("node", "high", "low", "first_id"), "candidates")
    chosen = df.select(F.col(f"`{keep['id']}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    named = wanted.select(F.col("first_id").alias("id"), "node", "high", "low")
    sets = _sets(maybe_among(chosen, "id", named).where("_maybe").join(named, "id"), "text", width)
    if docs.where("id is null").take(1):
        nulls = _digested(chosen.where("id is null"), "text", width).join(named.where("id is null"), ["high", "low"])
        sets = sets.unionByName(nulls.select("node", "items")).dropDuplicates(["node"])
    elif docs.where("id is not null").groupBy("id").count().where("count > 1").take(1):
        sets = sets.dropDuplicates(["node"])               # equal rows of one id
    sets = written(sets, "sets")
    links = written(_verified(first, sets, percent), "links")
    joined = components(links)
    label = members.join(joined, "node", "left").select("bucket", "node", "n", F.coalesce("component", "node").alias("component"))
    split = label.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    label = written(label.join(split.select("bucket"), "bucket", "left_semi"), "open-buckets")
    size = label.groupBy("bucket").agg(F.greatest(F.count("*") / BLOCK_NODES, F.sum("n") / BLOCK_SHINGLES).alias("blocks")).select(
        F.col("bucket").alias("at"), F.ceil("blocks").cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = label.join(size, F.col("bucket") == F.col("at")).select("bucket", "node", "component", own.alias("own"), F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "component")
    more = written(dealt.join(sets, "node").groupBy("bucket", "low", "high").applyInPandas(
        _joins(percent), "a bigint, b bigint"), "more-links")
    joined = components(links.unionByName(more)) if more.take(1) else joined
    group = nodes.select("node", "high", "low", "first_id").join(joined, "node", "left").select(
        F.col("high").alias("_high"), F.col("low").alias("_low"), "first_id", F.coalesce("component", "node").alias("component"))
    least = group.groupBy("component").agg(F.min("first_id").alias("least"))
    group = group.drop("first_id").join(least, "component")
    return docs.join(group, (F.col("high") == F.col("_high")) & (F.col("low") == F.col("_low")), "left").select(
        *keep, "n_shingles", "component", "least")
