"""Feature screening by permutation importance on held-out rows, all features in one pass."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.learn import CrossFit, cross_fit
from tabwright.session import distribute, materialize

# Rows that exchange a feature's values with each other.
BLOCK_ROWS = 10_000
# A feature stays if shuffling it costs every fold, and on the whole this share of the mean absolute error.
LEAST_SHARE = 0.01

SUMS = "place int, fold int, error double, n long"


def mixed(h: np.ndarray, place: int) -> np.ndarray:
    """A hash per row and feature, by whose order the feature's values are exchanged."""
    z = (h.astype(np.uint64) ^ np.uint64((place + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    return z ^ (z >> np.uint64(29))


def permuted_errors(batches: Iterator[pa.RecordBatch], models: Sequence, size: int) -> Iterator[pa.RecordBatch]:
    """Summed absolute errors per fold: place -1 for the rows as they are, place j with feature j exchanged."""
    error, rows = np.zeros((size + 1, len(models))), np.zeros(len(models), np.int64)
    for b in batches:
        if not b.num_rows:
            continue
        x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
        fold, y, h = (b.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "label", "h"))
        for m, model in enumerate(models):
            own = fold == m
            if not own.any():
                continue
            xm, ym, hm = x[own].copy(), y[own], h[own]
            rows[m] += len(ym)
            error[0, m] += np.abs(ym - model.predict_matrix(xm)).sum()
            start = np.argsort(hm, kind="stable")
            for j in range(size):
                kept = xm[:, j].copy()
                xm[start, j] = kept[np.argsort(mixed(hm, j), kind="stable")]
                error[j + 1, m] += np.abs(ym - model.predict_matrix(xm)).sum()
                xm[:, j] = kept
    cells = [(j - 1, m, float(error[j, m]), int(rows[m])) for j in range(size + 1) for m in range(len(models))]
    kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int64())
    columns = [pa.array(list(c), t) for c, t in zip(zip(*cells), kinds)]
    yield pa.RecordBatch.from_arrays(columns, ["place", "fold", "error", "n"])


def permutation_importance(df: DataFrame, fitted: CrossFit, names: Sequence[str], label: str = "label") -> DataFrame:
    """``(feature, importance, least, rank, mae)``: what the held-out mean absolute error gains when a feature is shuffled.

    ``least`` is the gain of the fold with the smallest one, ``mae`` the error as it is.

    Rows are dealt by a hash, so that a block of ``BLOCK_ROWS`` is a random part of all, and exchange
    their values within it: one shuffle and one pass, however many features there are. Every row is
    scored by the model of its own fold, which never saw it. Models must have ``predict_matrix``.
    """
    distribute(df.sparkSession)
    x, fold, size, models = vector_to_array(fitted.features), fitted.fold, len(names), list(fitted.models)
    rows = df.filter(F.col(fold).isNotNull() & F.col(label).isNotNull()).select(
        x.alias("x"), F.col(fold).cast("int").alias("fold"), F.col(label).cast("double").alias("label"), F.xxhash64(x, label, fold).alias("h")
    )
    rows = materialize(rows, "screening")
    parts = max(1, -(-rows.count() // BLOCK_ROWS))
    dealt = rows.repartition(parts, "h").sortWithinPartitions("h")
    sums = dealt.mapInArrow(lambda batches: permuted_errors(batches, models, size), SUMS)
    # A row per feature and fold.
    cells = sums.groupBy("place", "fold").agg(F.sum("error").alias("error"), F.sum("n").alias("n")).collect()
    error = {(r["place"], r["fold"]): r["error"] for r in cells}
    n = {r["fold"]: r["n"] for r in cells if r["n"]}
    total = sum(n.values())
    gain = lambda j, m: (error[j, m] - error[-1, m]) / n[m]
    gains = [sum(gain(j, m) * n[m] / total for m in n) for j in range(size)]
    least = [min(gain(j, m) for m in n) for j in range(size)]
    mae = sum(error[-1, m] for m in n) / total
    order = sorted(range(size), key=lambda j: (-gains[j], j))
    found = [(names[j], float(gains[j]), float(least[j]), place + 1, float(mae)) for place, j in enumerate(order)]
    return df.sparkSession.createDataFrame(found, "feature string, importance double, least double, rank int, mae double")


@dataclass(frozen=True)
class Screened:
    """Names that stay, every feature's importance, and the held-out error with all and with those names."""

    names: list[str]
    importances: DataFrame
    before: float
    after: float
    fitted: CrossFit


def screen(
    df: DataFrame,
    make: Callable[[], Estimator],
    k: int,
    names: Sequence[str],
    fold: str = "fold",
    features: str = "features",
    label: str = "label",
    least: float = LEAST_SHARE,
) -> Screened:
    """Fit, keep what is worth ``least`` of the error, and something in every fold, and fit again on that alone.

    If nothing is worth that much, the first of the ranking stays.
    """
    importances = permutation_importance(df, cross_fit(df, make, k, fold, features), names, label)
    rows = importances.orderBy("rank").collect()
    before = rows[0]["mae"]
    chosen = {r["feature"] for r in rows if r["importance"] >= least * before and r["least"] > 0} or {rows[0]["feature"]}
    places = [j for j, name in enumerate(names) if name in chosen]
    x = vector_to_array(features)
    narrow = materialize(df.withColumn(features, array_to_vector(F.array(*[F.get(x, F.lit(j)) for j in places]))), "screened")
    fitted = cross_fit(narrow, make, k, fold, features)
    held = fitted.transform(narrow.filter(F.col(fold).isNotNull()), "_p")
    after = held.agg(F.avg(F.abs(F.col(label) - F.col("_p")))).first()[0]
    return Screened([names[j] for j in places], importances.drop("mae"), before, after, fitted)
