"""Operator 12: hard negatives by threshold joins over an inverted index.

A row's score with an anchor is the inner product of their whole-numbered vectors.
An anchor's positives are the best rows of its own label; for each of them the
best rows of other labels within a window below its score are hard negatives.
Both are searches for the best rows within windows of scores.

The anchors, a stated share of the rows, are searched in blocks of a bounded size:
the driver sends a block to all tasks, and each task goes over its rows, also in
blocks. A block of rows is an inverted index over groups of dimensions, those of
most weight first. A row is listed under a group only while the norm of what is
left of it, times the anchors', can still reach the threshold; the rest is covered
by that bound and left out. Partial scores are accumulated list by list, pairs
are dropped once the remaining norms cannot lift them to their anchor's threshold,
and what is left is completed exactly. Thresholds start high and are lowered until
the windows are full or their lower ends are reached; from block to block a full
window's last score is the threshold. So a task emits no more rows than the
windows hold, and Spark merges the tasks' windows.

Scores are exact: a sum of absolute products is at most the product of the norms,
so doubles hold it up to 2**49, and 64-bit integers beyond.

Cases: rows without id, label or vector, or with a null or non-finite component,
take no part, nor do those of a squared norm of 2**61 or more, whose scores need
not fit a long. Vectors of different length do not compare; empty and zero ones
score 0. Rows that are equal in id, label and vector count once; other rows of one
id are rows of their own, but never positives or negatives of their own id's
anchors. Ties go to the smaller id. An empty table, or one without anchors, gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.shared import prepare, written
from tablewright.session import scratch_path

#: Anchors and vector components that one pass over the rows serves.
PASS_ANCHORS, PASS_VALUES = 4_096, 2_000_000
#: Anchors and rows that meet at a time in a task, and components of such a block.
ANCHORS, ROWS, VALUES = 128, 8_192, 2_000_000
#: Dimensions of one list of the index.
GROUP = 8
#: Shares of the largest possible score that thresholds are lowered to, before the windows' lower ends.
STEPS = (0.8, 0.5, 0.25)
#: Scores below this keep their order in one 64-bit key with a row's place.
NARROW = 2**49
LOWEST = -(2**62)


class Side:
    """Vectors of one length with their ids, labels and row numbers."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.vectors, self.ids, self.labels, self.rows = vectors, ids, labels, rows
        self.top = float((vectors.astype(np.float64) ** 2).sum(axis=1).max()) if vectors.size else 0.0

    def take(self, at) -> Side:
        return Side(self.vectors[at], self.ids[at], self.labels[at], self.rows[at])


def by_length(vectors: pa.ListArray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> dict[int, Side]:
    offsets = vectors.offsets.to_numpy()
    values = vectors.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    out = {}
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        out[size] = Side(values[offsets[at][:, None] + np.arange(size)], ids[at], labels[at], rows[at])
    return out


class Best:
    """The first ``k`` scores of each anchor's windows [low, high], ties by id."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        shape = (*low.shape, k)
        self.score = np.full(shape, LOWEST, np.int64)
        self.id, self.row = np.zeros(shape, np.int64), np.zeros(shape, np.int64)

    def floor(self, at: np.ndarray) -> np.ndarray:
        """What a score of each window must reach to matter; the window's lower
        end until it is full. Windows that cannot hold a score ask for nothing."""
        need = np.maximum(self.low[at], self.score[at][:, :, -1])
        return np.where(self.low[at] <= self.high[at], need, -LOWEST)

    def add(self, at: np.ndarray, window: int, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Merge columns of scores (LOWEST: none) into a window of the anchors ``at``."""
        score = np.concatenate([self.score[at, window], score], axis=1)
        ids, rows = np.concatenate([self.id[at, window], ids], axis=1), np.concatenate([self.row[at, window], rows], axis=1)
        order = np.lexsort((ids, -score), axis=-1)[:, :self.k]
        for mine, new in ((self.score, score), (self.id, ids), (self.row, rows)):
            mine[at, window] = np.take_along_axis(new, order, axis=1)


class Index:
    """Inverted index of a block of rows over groups of dimensions."""

    def __init__(self, side: Side):
        order = np.argsort(side.ids, kind="stable")         # places follow the ids
        self.side = side.take(order)
        weight = (self.side.vectors.astype(np.float64) ** 2).sum(axis=0)
        self.dims = np.argsort(-weight, kind="stable")
        self.vectors = self.side.vectors[:, self.dims]
        self.edges = [*range(0, len(self.dims), GROUP), len(self.dims)] if len(self.dims) else [0]
        self.left = self.norms(self.vectors)

    def norms(self, vectors: np.ndarray) -> np.ndarray:
        """Norm of what is left of each vector from each edge on (rounded up)."""
        squares = vectors.astype(np.float64) ** 2
        out = np.zeros((len(vectors), len(self.edges)))
        for k in range(len(self.edges) - 2, -1, -1):
            out[:, k] = out[:, k + 1] + squares[:, self.edges[k]:self.edges[k + 1]].sum(axis=1)
        return np.sqrt(out) * (1 + 1e-9)

    def scores(self, anchors: Side, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores (anchors x rows) and where they are complete: every pair that
        reaches the anchor's ``least`` is."""
        kind = np.float64 if anchors.top * self.side.top < float(NARROW) ** 2 else np.int64
        asked, rows = anchors.vectors[:, self.dims].astype(kind), self.vectors.astype(kind, copy=False)
        asked_left = self.norms(anchors.vectors[:, self.dims])
        lists = (self.left * asked_left.max(axis=0) >= least.min()).sum(axis=1)     # a falling bound: edges from the first on
        total = np.zeros((len(asked), len(rows)), kind)
        alive = np.ones(total.shape, bool)
        for k in range(len(self.edges) - 1):
            listed = np.flatnonzero((lists > k) & alive.any(axis=0))
            if not len(listed):
                break
            a, b = self.edges[k], self.edges[k + 1]
            total[:, listed] += asked[:, a:b] @ rows[listed, a:b].T
            alive[:, listed] &= total[:, listed] + asked_left[:, k + 1:k + 2] * self.left[listed, k + 1] >= least[:, None]
        alive[:, lists == 0] = False
        unlisted = (lists > 0) & (lists < len(self.edges) - 1)
        q, r = np.nonzero(alive & unlisted)
        for first in range(0, len(q), 100_000):
            x, y = q[first:first + 100_000], r[first:first + 100_000]
            beyond = np.arange(len(self.dims)) >= np.array(self.edges)[lists[y]][:, None]
            total[x, y] += (asked[x] * rows[y] * beyond).sum(axis=1, dtype=kind)
        return total.astype(np.int64), alive


def search(index: Index, anchors: Side, best: Best, same_label: bool) -> None:
    """Bring the block's rows into the windows of the anchors."""
    codes = np.unique(np.concatenate([anchors.labels, index.side.labels]), return_inverse=True)[1]
    mine, theirs = codes[:len(anchors.labels)], codes[len(anchors.labels):]
    n = len(index.side.ids)
    for begin in range(0, len(anchors.ids), ANCHORS):
        at = np.arange(begin, min(begin + ANCHORS, len(anchors.ids)))
        tried = np.full(len(at), -LOWEST, np.int64)          # all scores from here on are in
        most = index.norms(anchors.vectors[at][:, index.dims])[:, 0] * index.left[:, 0].max()
        for share in (*STEPS, None):
            floor = best.floor(at).min(axis=1)
            going = floor < tried
            if not going.any():
                break
            at, tried, most, floor = at[going], tried[going], most[going], floor[going]
            least = floor if share is None else np.maximum(floor, np.floor(np.minimum(share * most, 2.0**61)).astype(np.int64))
            part = anchors.take(at)
            score, found = index.scores(part, least.astype(np.float64))
            wide = part.top * index.side.top >= float(NARROW) ** 2
            fits = found & (score >= least[:, None]) & (score < tried[:, None]) & (part.ids[:, None] != index.side.ids)
            fits &= (mine[at][:, None] == theirs) == same_label
            for w in range(best.low.shape[1]):
                need = best.floor(at)[:, w]
                inside = fits & (score >= need[:, None]) & (score <= best.high[at, w][:, None])
                if not inside.any():
                    continue
                k = min(best.k, n)
                if wide:
                    place = np.lexsort((np.broadcast_to(np.arange(n), score.shape), -np.where(inside, score, LOWEST)), axis=-1)[:, :k]
                else:
                    key = np.where(inside, score * n + (n - 1 - np.arange(n)), np.iinfo(np.int64).min)
                    place = np.argpartition(key, n - k, axis=1)[:, n - k:]
                kept = np.take_along_axis(inside, place, axis=1)
                best.add(at, w, np.where(kept, np.take_along_axis(score, place, axis=1), LOWEST), index.side.ids[place],
                         index.side.rows[place])
            tried = least


def _task(asked: dict, k: int, same_label: bool):
    """``asked``: for each length the anchors, and low and high of their windows.
    Emits (anchor, window, score, id, row) of the windows of the task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bests = {size: Best(low, high, k) for size, (_, low, high) in asked.items()}
        held, rows, values = [], 0, 0

        def block() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            column = lambda name: t.column(name).to_numpy()
            vectors = pa.concat_arrays([c for c in t.column("vector").chunks])
            for size, side in by_length(vectors, column("id"), np.array(t.column("label").to_pylist()), column("row")).items():
                if size in asked:
                    search(Index(side), asked[size][0], bests[size], same_label)

        for batch in batches:
            held.append(batch)
            rows, values = rows + batch.num_rows, values + len(batch.column(batch.schema.get_field_index("vector")).flatten())
            if rows >= ROWS or values >= VALUES:
                block()
                held, rows, values = [], 0, 0
        if rows:
            block()
        for size, best in bests.items():
            anchor, window, place = np.nonzero(best.score > LOWEST)
            yield pa.record_batch([pa.array(asked[size][0].rows[anchor]), pa.array(window.astype(np.int32)),
                                   *(pa.array(x[anchor, window, place]) for x in (best.score, best.id, best.row))],
                                  names=["anchor", "window", "score", "id", "row"])

    return run


def _found(rows: DataFrame, asked: dict, k: int, same_label: bool, name: str) -> DataFrame:
    """The first ``k`` of each window over all tasks, with ``rank`` from 1 on."""
    own = rows.mapInArrow(_task(asked, k, same_label), "anchor bigint, window int, score bigint, id bigint, row bigint")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "row")
    return written(own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), name)


def usable(vector: Column, scale: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    small = F.aggregate(vector, F.lit(0.0), lambda s, x: s + (F.abs(x) * scale + 1) * (F.abs(x) * scale + 1)) < float(2**61)
    return F.coalesce(finite & small, F.lit(False))


def hard_negatives(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for
    each anchor (a row where ``is_anchor`` holds) and each of its first
    ``positives`` rows of the same label the first ``negatives`` rows of other
    labels with low * positive_score <= 100 * negative_score <= high * positive_score."""
    spark = df.sparkSession
    prepare(spark, 2_000)
    chosen = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                       F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    rows = chosen.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"), scale)).withColumn(
        "vector", F.transform("vector", lambda x: F.floor(x * scale))).dropDuplicates(["id", "label", "vector"])
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "mined-rows")
    anchors = rows.where("asks")
    n, values = anchors.agg(F.count("*"), F.coalesce(F.sum(F.size("vector")), F.lit(0))).first()
    passes = max(-(-n // PASS_ANCHORS), -(-values // PASS_VALUES))
    searched = rows.select("row", "id", "label", "vector")
    out = scratch_path(spark, "hard-negatives")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    for k in range(passes):
        mine = anchors.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == k).select(searched.columns).toArrow()   # a bounded block
        if not mine.num_rows:
            continue
        sides = by_length(pa.concat_arrays(mine.column("vector").chunks), mine.column("id").to_numpy(),
                          np.array(mine.column("label").to_pylist()), mine.column("row").to_numpy())
        whole = {size: (s, np.full((len(s.ids), 1), LOWEST + 1), np.full((len(s.ids), 1), -LOWEST - 1)) for size, s in sides.items()}
        first = _found(searched, whole, positives, True, "positives")
        # At most ``positives`` rows for each anchor of the block.
        scores = {(r["anchor"], r["rank"]): r["score"] for r in first.select("anchor", "rank", "score").collect()}
        asked = {}
        for size, s in sides.items():
            score = np.array([[scores.get((r, j + 1), -1) for j in range(positives)] for r in s.rows.tolist()], object)
            below = -(-low * score // 100)
            asked[size] = (s, below.astype(np.int64), (high * score // 100).astype(np.int64))
        second = _found(searched, asked, negatives, False, "negatives")
        ids = spark.createDataFrame(list(zip(mine.column("row").to_pylist(), mine.column("id").to_pylist())), "anchor bigint, anchor_id bigint")
        pairs = first.select("anchor", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"),
                             F.col("score").alias("positive_score"))
        # A row for each anchor of the block, and ``positives`` for each.
        pairs = F.broadcast(pairs.join(F.broadcast(ids), "anchor"))
        second.join(pairs, ["anchor", "window"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")).write.mode("append").parquet(out)
    if not passes:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out)
