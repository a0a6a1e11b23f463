"""Feature preparation: column routing, standardisation, one-hot encoding,
PCA and assembly.

Fitting is aggregation (means and population deviations in one pass; principal
components by block power iteration, whose tasks and driver hold blocks of p×k).
Applying a fitted transform is a projection with the parameters inlined as
literals, so it stays in whole-stage codegen and needs no join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright import config as C
from tablewright.functions.names import col
from tablewright.functions.text import try_number
from tablewright.operators.moments import column_state, scaler_of

NUMERIC_ROUTE_TYPES = ("numeric", "numeric_continuous", "numeric_discrete")
PASSTHROUGH_TYPES = ("list_json", "list_csv")
ROUTE_ORDER = {"numeric": 0, "one_hot": 1, "label": 2, "passthrough": 3}


def feature_routes(type_of: Mapping[str, str], cardinality: Mapping[str, int],
                   ohe_max: int = C.OHE_MAX_CARDINALITY) -> list[tuple[str, str, int]]:
    """``[(column, route, cardinality)]`` in output order: numeric columns,
    one-hot columns (category-like, at most ``ohe_max`` categories), label
    columns (more categories), passthrough (list columns)."""
    routed = []
    for c, t in type_of.items():
        n = int(cardinality.get(c, 0))
        if t in NUMERIC_ROUTE_TYPES:
            routed.append((c, "numeric", n))
        elif t in C.CATEGORY_LIKE:
            routed.append((c, "one_hot" if n <= ohe_max else "label", n))
        elif t in PASSTHROUGH_TYPES:
            routed.append((c, "passthrough", n))
    return sorted(routed, key=lambda r: ROUTE_ORDER[r[1]])


def scaler_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, mean, std)``: mean and population standard deviation; a
    zero deviation is replaced by 1. Grouped by column, so the aggregate has the
    same width on any table."""
    return scaler_of(column_state(df, cols))


def standardize(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Replace each column in ``params`` by ``(x - mean) / std``."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        if c in params:
            mean, std = params[c]
            out.append(((try_number(col(c), schema[c]) - F.lit(float(mean or 0.0))) / F.lit(float(std))).alias(c))
        else:
            out.append(col(c))
    return df.select(*out)


def one_hot_names(column: str, categories: Sequence[tuple[int, str]], taken: set[str] | None = None) -> list[str]:
    """``<column>__<category>`` per category; names equal up to case (the
    default resolver is case-insensitive) to one before or in ``taken`` (small
    letters; the new ones are added) get the code appended, as often as needed."""
    names, taken = [], set() if taken is None else taken
    for code, value in categories:
        name = f"{column}__{value}"
        while name.lower() in taken:
            name = f"{name}__{code}"
        taken.add(name.lower())
        names.append(name)
    return names


def all_indicators(categories: Mapping[str, Sequence[tuple[int, str]]], others: Sequence[str] = ()) -> list:
    """Indicator columns of several coded columns, named apart from each other
    and from the columns ``others``."""
    taken = {c.lower() for c in others}
    return [e for c, cats in categories.items() for e in indicator_columns(c, cats, taken)]


def indicator_columns(c: str, cats: Sequence[tuple[int, str]], taken: set[str] | None = None) -> list:
    """Indicator expressions for label-coded column ``c`` with categories
    ``[(code, value)]`` sorted by value: ``c__value`` is 1 where the code
    decodes to ``value``; an unknown or missing code decodes to ``unknown``.
    No category is dropped."""
    decode = F.create_map(*[e for code, v in cats for e in (F.lit(int(code)), F.lit(v))]) if cats else None
    label = F.lit("unknown") if decode is None else F.coalesce(
        F.try_element_at(decode, col(c).cast("int")), F.lit("unknown"))
    return [(label == F.lit(v)).cast("int").alias(n) for (_, v), n in zip(cats, one_hot_names(c, cats, taken))]


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[tuple[int, str]]],
            keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns plus the indicator columns of every coded column in
    ``categories`` (at most ``ohe_max_cardinality`` categories each)."""
    return df.select(*[col(k) for k in keep], *all_indicators(categories, keep))


def pca_components(p: int) -> int:
    """Number of components kept for ``p`` numeric features."""
    return max(1, min(p - 1, C.PCA_MAX_COMPONENTS))


def principal(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` leading eigenvectors (columns, their largest absolute entry
    positive) and eigenvalues of a symmetric matrix."""
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    order = np.argsort(-values, kind="stable")[:k]
    return upright(vectors[:, order]), values[order]


def upright(vectors: np.ndarray) -> np.ndarray:
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return vectors * np.where(signs == 0, 1, signs)


def covariance_times(df: DataFrame, cols: Sequence[str], basis: np.ndarray) -> tuple[np.ndarray, float]:
    """(covariance matrix of ``cols``, population, times ``basis``; its trace), in one
    scan. A task multiplies its rows by the basis and the result by its rows again,
    so it holds a block as tall as the columns and as wide as the basis, never a
    square of the columns; neither does the driver."""
    p, width = basis.shape
    view = df.select(*[try_number(col(c), df.schema[c].dataType).alias(f"_v{i}") for i, c in enumerate(cols)])

    def run(batches):
        import pyarrow as pa
        # Product, then for each column its sum and its sum of squares.
        total, n = np.zeros((p, width + 2)), 0
        for batch in batches:
            if any(c.null_count for c in batch.columns):
                raise ValueError("principal components need a value in every row: impute the columns first")
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            total[:, :width] += rows.T @ (rows @ basis)
            total[:, width] += rows.sum(axis=0)
            total[:, width + 1] += (rows * rows).sum(axis=0)
            n += len(rows)
        if n:
            yield pa.record_batch([pa.array(np.repeat(np.arange(p), width + 2)), pa.array(np.tile(np.arange(width + 2), p)),
                                   pa.array(total.ravel()), pa.array(np.full(p * (width + 2), n))], names=["i", "j", "v", "n"])

    sums = view.mapInArrow(run, "i long, j long, v double, n long").groupBy("i", "j").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    total, n = np.zeros((p, width + 2)), 1
    for r in sums.collect():                     # as tall as the columns, as wide as the basis
        total[r["i"], r["j"]], n = r["v"], r["n"]
    mean = total[:, width] / n
    product = total[:, :width] / n - np.outer(mean, mean @ basis)
    return product, float((total[:, width + 1] / n - mean * mean).sum())


def pca_fit(scaled: DataFrame, cols: Sequence[str], k: int | None = None, extra: int = 10, rounds: int = 60,
            tolerance: float = 1e-9):
    """Fit PCA on already standardised ``cols``. Returns ``(loadings, ratios)``:
    a ``p×k`` numpy array whose columns have their largest absolute loading
    positive, and the explained variance ratio of each component.

    Randomised block power iteration: a random basis a little wider than ``k`` is
    multiplied by the covariance matrix, one scan a round, and made orthogonal;
    the components are those of the matrix within the basis. Rounds end when what
    the matrix does to the components differs from their variances by less than
    ``tolerance`` of the largest one. A basis as wide as the columns is exact after
    one round."""
    p = len(cols)
    k = min(k or pca_components(p), p)
    width = min(p, k + max(extra, k // 2))
    basis = np.eye(p) if width == p else np.linalg.qr(np.random.default_rng(p).standard_normal((p, width)))[0]
    for _ in range(rounds):
        product, trace = covariance_times(scaled, cols, basis)
        vectors, values = principal(basis.T @ product, width)
        left = product @ vectors - (basis @ vectors) * values
        if np.linalg.norm(left[:, :k], axis=0).max() <= tolerance * max(values[0], 1e-300):
            break
        basis = np.linalg.qr(product)[0]
    return upright((basis @ vectors)[:, :k]), values[:k] / (trace or 1.0)


def pca_variance(spark, ratios: np.ndarray) -> DataFrame:
    """``(component, explained_variance_ratio, cumulative_variance_ratio)``."""
    cum = np.cumsum(ratios)
    rows = [(f"PC{j + 1}", float(r), float(c)) for j, (r, c) in enumerate(zip(ratios, cum))]
    return spark.createDataFrame(
        rows, "component string, explained_variance_ratio double, cumulative_variance_ratio double")


def pca_project(scaled: DataFrame, cols: Sequence[str], loadings: np.ndarray,
                keep: Sequence[str] = ()) -> DataFrame:
    """``PC1..PCk`` as linear combinations of the standardised columns."""
    out = [col(k) for k in keep]
    for j in range(loadings.shape[1]):
        expr = None
        for i, c in enumerate(cols):
            term = col(c) * F.lit(float(loadings[i, j]))
            expr = term if expr is None else expr + term
        out.append(expr.alias(f"PC{j + 1}"))
    return scaled.select(*out)


# --- persisted parameters ----------------------------------------------------

def loadings_table(spark, cols: Sequence[str], loadings: np.ndarray) -> DataFrame:
    """``(component, column, loading)``: the fitted PCA as a table."""
    rows = [(f"PC{j + 1}", c, float(loadings[i, j])) for j in range(loadings.shape[1])
            for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "component string, column string, loading double")


def loadings_from(table: DataFrame) -> tuple[list[str], np.ndarray]:
    """Inverse of :func:`loadings_table` (a p×k table, collected)."""
    rows = table.collect()
    cols = list(dict.fromkeys(r["column"] for r in rows))
    comps = sorted({r["component"] for r in rows}, key=lambda s: int(s[2:]))
    out = np.zeros((len(cols), len(comps)))
    for r in rows:
        out[cols.index(r["column"]), comps.index(r["component"])] = r["loading"]
    return cols, out


def scaler_from(table: DataFrame) -> dict[str, tuple[float, float]]:
    """Scaler parameters ``{column: (mean, std)}`` from a written scaler table."""
    return {r["column"]: (r["mean"], r["std"]) for r in table.collect()}


def categories_from(table: DataFrame, dictionary: DataFrame) -> dict[str, list[tuple[int, str]]]:
    """One-hot categories ``{column: [(code, value)]}`` from the written
    mappings and dictionary tables (bounded by ``ohe_max_cardinality``)."""
    cols = [r["column"] for r in table.select("column").collect()]
    rows = dictionary.where(F.col("column").isin(cols)).collect()
    return {c: sorted([(r["code"], r["value"]) for r in rows if r["column"] == c], key=lambda x: x[1])
            for c in cols}
