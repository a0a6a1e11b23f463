"""Operator 6: near-duplicate embeddings by collision-counting projections.

Every vector is projected on many random directions. Two vectors collide on a
direction if their values differ by at most the half width of a window centred
on the query. ``calibrate`` sets this width and the least number of collisions
from the wanted recall: for a pair just at the cosine, the difference on a
direction is normal with a known deviation, so the count is binomial.

A few directions make a table whose grid cells are the partitions: a vector
lives in its own cell, and as a query it visits every cell that its window
touches. Inside a cell the residents are sorted by a projection, a query takes
the window around its own value, pairs that also collide on the other
directions of the table and often enough on all directions are verified by
their cosine in double precision. A pair found by several tables counts in the
first one only. A cell's residents and its queries are each split into blocks
by their own number, and every block of queries meets every block of residents;
a task emits a count for each query and the edges of a spanning star, never all
pairs.

Equal vectors of a label are one node before they are projected: a link to it
counts all of them, and each of them links with the others. An id that has
several vectors keeps a node for each, as it has no link with itself.

Cases: vectors that are null, empty or zero, hold null or non-finite
components, or have a null label link with nothing; vectors of different
length do not compare. Repeated rows of one id count as one vector, and each
gets the same result. Rows without an id link with nothing (null component,
not kept). An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.graph import components, stars
from tablewright.llm.shared import prepare, written

DIRECTIONS, TABLES = 32, 3
#: Share of pairs at the cosine that candidate search may miss.
MISS = 0.002
#: Vectors that an average cell and a block of a large cell should hold.
CELL_ROWS, BLOCK_ROWS = 200, 1_000


def _tail(n: int, p: float, least: int) -> float:
    return sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(least, n + 1))


def calibrate(cosine: float, per_table: int, tables: int = TABLES, directions: int = DIRECTIONS,
              miss: float = MISS) -> tuple[float, int]:
    """(half width of the window, least collisions) with the wanted recall."""
    apart = math.sqrt(2 - 2 * cosine)
    for step in range(10, 60):
        width = step / 10
        p = math.erf(width / math.sqrt(2))
        if (1 - p**per_table) ** tables <= miss / 2:
            least = max(k for k in range(1, directions + 1) if 1 - _tail(directions, p, k) <= miss / 2)
            return width * apart, least
    raise ValueError("no window reaches this recall")


def directions_of(dimension: int) -> np.ndarray:
    return np.random.default_rng(dimension).standard_normal((dimension, DIRECTIONS))


def units(vectors: list) -> np.ndarray:
    out = np.array([np.asarray(v, np.float64) for v in vectors])
    return out / np.linalg.norm(out, axis=1)[:, None]


def _entries(width: float, per_table: int):
    """A row for a vector's own cell in each table (resident) and one for each
    cell that its window touches (query)."""
    side = 4 * width

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, same in frame.groupby("size"):
                value = units(same["embedding"].tolist()) @ directions_of(int(size))
                rows, cells, tables, roles = [], [], [], []
                for t in range(TABLES):
                    own = value[:, t * per_table:(t + 1) * per_table]
                    home = np.floor(own / side).astype(np.int64)
                    low = np.floor((own - width) / side).astype(np.int64)
                    high = np.floor((own + width) / side).astype(np.int64)
                    for k in range(len(same)):
                        rows.append(k), cells.append(",".join(map(str, home[k]))), tables.append(t), roles.append(False)
                        spans = [range(a, b + 1) for a, b in zip(low[k], high[k])]
                        found = [""]
                        for span in spans:
                            found = [f"{f},{c}" if f else str(c) for f in found for c in span]
                        for cell in found:
                            rows.append(k), cells.append(cell), tables.append(t), roles.append(True)
                at = same.iloc[rows]
                yield pd.DataFrame({"label": at["label"].to_numpy(), "size": at["size"].to_numpy(), "tab": tables, "cell": cells,
                                    "query": roles, "vec_id": at["vec_id"].to_numpy(), "copies": at["copies"].to_numpy(),
                                    "embedding": at["embedding"].to_numpy()})

    return run


def _compare(cosine: float, width: float, least: int, per_table: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        query = frame["query"].to_numpy()
        if not query.any() or query.all():
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        table, size = int(frame["tab"].iloc[0]), int(frame["size"].iloc[0])
        unit = units(frame["embedding"].tolist())
        value, ids, copies = unit @ directions_of(size), frame["vec_id"].to_numpy(np.int64), frame["copies"].to_numpy(np.int64)
        mine = [table * per_table + k for k in range(per_table)]
        earlier = [[t * per_table + k for k in range(per_table)] for t in range(table)]
        res = np.flatnonzero(~query)
        res = res[np.argsort(value[res, mine[0]], kind="stable")]
        ask = np.flatnonzero(query)
        line = value[res, mine[0]]
        first = np.searchsorted(line, value[ask, mine[0]] - width, "left")
        many = np.searchsorted(line, value[ask, mine[0]] + width, "right") - first
        ends = np.cumsum(many)
        left, right, weight = [], [], []
        start = 0
        while start < len(ask):                       # about a million window places at a time
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + 1_000_000, "right")))
            m = many[start:stop]
            q = np.repeat(ask[start:stop], m)
            r = res[np.repeat(first[start:stop] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))]
            for k in mine[1:]:
                near = np.abs(value[q, k] - value[r, k]) <= width
                q, r = q[near], r[near]
            near = ids[q] != ids[r]
            q, r = q[near], r[near]
            close = np.abs(value[q] - value[r]) <= width
            near = close.sum(axis=1) >= least
            for other in earlier:
                near &= ~close[:, other].all(axis=1)
            q, r = q[near], r[near]
            near = np.einsum("ij,ij->i", unit[q], unit[r]) >= cosine
            left.append(ids[q[near]]), right.append(ids[r[near]]), weight.append(copies[r[near]])
            start = stop
        a, b = np.concatenate(left), np.concatenate(right)
        counted, at = np.unique(a, return_inverse=True)
        n = np.zeros(len(counted), np.int64)
        np.add.at(n, at, np.concatenate(weight))
        nodes, low = stars(a, b)
        return pd.DataFrame({"a": np.concatenate([counted, nodes]), "b": np.concatenate([counted, low]),
                             "n": np.concatenate([n, np.zeros(len(nodes), np.int64)])})

    return run


def _dealt(entries: DataFrame) -> DataFrame:
    """``entries`` with of_query and of_resident, the blocks that meet: a query
    goes to every block of residents of its cell, a resident to every block of queries."""
    cell = ["label", "size", "tab", "cell"]
    blocks = lambda rows: F.ceil(F.count_if(rows) / BLOCK_ROWS).cast("int")
    # Two residents or more, or one with other queries: a lone vector meets itself only.
    held = entries.groupBy(*cell).agg(blocks(F.col("query")).alias("queries"), blocks(~F.col("query")).alias("residents"),
                                      F.count("*").alias("rows")).where("queries > 0 and residents > 0 and rows > 2").drop("rows")
    mine, others = (F.when(F.col("query"), F.col(a)).otherwise(F.col(b)) for a, b in (("queries", "residents"), ("residents", "queries")))
    return entries.join(held, cell).select(
        *entries.columns, F.pmod(F.xxhash64("vec_id", "embedding"), mine).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), others - 1)).alias("other")).select(
        *entries.columns, F.when(F.col("query"), F.col("own")).otherwise(F.col("other")).alias("of_query"),
        F.when(F.col("query"), F.col("other")).otherwise(F.col("own")).alias("of_resident"))


def near_embeddings(df: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """One row per vector: id, n_links (other vectors of the same label with at
    least this cosine), component_id (the smallest id that links reach), kept
    (id = component_id)."""
    spark = df.sparkSession
    prepare(spark, 5_000)
    # Single precision stays as it is where vectors are moved; it is compared in double precision.
    kind = df.schema[vector_col].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    every = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast(kind).alias("embedding"),
                      F.col(label_col).alias("label"))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        "embedding", lambda x: x != 0)
    rows = every.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(
        F.coalesce(usable, F.lit(False))).dropDuplicates(["vec_id", "label", "embedding"])
    rows = written(rows, "vectors")
    several = written(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "ids-of-several")
    alone = rows.join(several, "vec_id", "left_anti")
    folded = written(alone.groupBy("label", "embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")), "folded")
    nodes = folded.unionByName(rows.join(several, "vec_id", "left_semi").withColumn("copies", F.lit(1).cast("long"))).withColumn(
        "size", F.size("embedding"))
    many = folded.where("copies > 1").select(F.col("label").alias("of_label"), F.col("embedding").alias("of_embedding"),
                                             F.col("vec_id").alias("first"), "copies")
    members = written(alone.join(many, (F.col("label") == F.col("of_label")) & (F.col("embedding") == F.col("of_embedding"))).select(
        F.col("vec_id").alias("member"), "first", "copies"), "copies")
    largest = nodes.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 1
    per_table = min(DIRECTIONS // TABLES, max(2, math.ceil(math.log(largest / CELL_ROWS + 1, 3))))
    width, least = calibrate(cosine, per_table)
    label_type = rows.schema["label"].dataType.simpleString()
    key = f"label {label_type}, size int, tab int, cell string"
    entries = written(nodes.mapInPandas(_entries(width, per_table),
                                        f"{key}, query boolean, vec_id bigint, copies bigint, embedding {kind}"), "entries")
    found = written(_dealt(entries).groupBy("label", "size", "tab", "cell", "of_query", "of_resident").applyInPandas(
        _compare(cosine, width, least, per_table), "a bigint, b bigint, n bigint"), "links")
    links = found.where("n > 0").groupBy("a").agg(F.sum("n").alias("n_links")).withColumnRenamed("a", "at")
    joined = components(found.where("n = 0")).select(F.col("node").alias("of"), "component")
    # The first of its copies stands for each.
    asked = every.select("vec_id").join(members, F.col("vec_id") == F.col("member"), "left").select(
        "vec_id", F.coalesce("first", "vec_id").alias("first"), (F.coalesce("copies", F.lit(1)) - 1).alias("others"))
    component = F.coalesce("component", "first")
    return asked.join(links, F.col("first") == F.col("at"), "left").join(joined, F.col("first") == F.col("of"), "left").select(
        F.col("vec_id").alias(id_col), (F.coalesce("n_links", F.lit(0)) + F.col("others")).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
