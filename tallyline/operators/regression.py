"""Least squares with several features for all groups at once.

A group's model follows from its count, means and covariances, which one aggregate gives,
combined map-side; so a million groups are one job, and a group of any size is one row
after it. The normal equations are solved for each group where its row is, by a Cholesky
factor of the correlations, written out as column expressions. Features are scaled that
way, which changes no prediction. A feature that is constant, or a mixture of those before
it, gets no weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of a feature's variance that those before it must leave for it to get a weight.
LEAST_PIVOT = 1e-9


def fit(rows: DataFrame, keys: list[str], features: list[str], target: str, least_rows: int = 2) -> DataFrame:
    """(keys, rows, a weight ``w_`` for each feature, intercept, r2) of each group.

    Rows with a missing feature or target are left out, groups with fewer than
    ``least_rows`` others as well.
    """
    x = {f: F.col(f).cast("double") for f in features}
    y = F.col(target).cast("double")
    usable = rows.filter(y.isNotNull())
    for column in x.values():
        usable = usable.filter(column.isNotNull() & ~F.isnan(column))
    pairs = [(i, j) for i in range(len(features)) for j in range(i + 1)]
    df = usable.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(y).alias("_my"), F.covar_pop(y, y).alias("_vy"),
        *[F.avg(x[f]).alias(f"_m{i}") for i, f in enumerate(features)],
        *[F.covar_pop(x[features[i]], x[features[j]]).alias(f"_c{i}{j}") for i, j in pairs],
        *[F.covar_pop(x[f], y).alias(f"_y{i}") for i, f in enumerate(features)]).filter(F.col("rows") >= least_rows)
    size = range(len(features))
    spread = [F.sqrt(F.col(f"_c{i}{i}")) for i in size]
    # The factor, row by row: _l{i}{j} below its diagonal _l{i}{i}, which is 0 for a feature without weight.
    for i in size:
        for j in range(i + 1):
            before = _total([F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}") for k in range(j)])
            if i == j:
                left = F.lit(1.0) - before
                df = df.withColumn(f"_l{i}{i}", F.when((spread[i] > 0) & (left > LEAST_PIVOT), F.sqrt(left)).otherwise(0.0))
            else:
                entry = F.col(f"_c{i}{j}") / (spread[i] * spread[j]) - before
                df = df.withColumn(f"_l{i}{j}", F.when((F.col(f"_l{j}{j}") > 0) & (spread[i] > 0), entry / F.col(f"_l{j}{j}")).otherwise(0.0))
    for i in size:
        right = F.col(f"_y{i}") / spread[i] - _total([F.col(f"_l{i}{k}") * F.col(f"_z{k}") for k in range(i)])
        df = df.withColumn(f"_z{i}", F.when(F.col(f"_l{i}{i}") > 0, right / F.col(f"_l{i}{i}")).otherwise(0.0))
    for i in reversed(size):
        rest = F.col(f"_z{i}") - _total([F.col(f"_l{k}{i}") * F.col(f"_b{k}") for k in range(i + 1, len(features))])
        df = df.withColumn(f"_b{i}", F.when(F.col(f"_l{i}{i}") > 0, rest / F.col(f"_l{i}{i}")).otherwise(0.0))
    weights = [F.when(spread[i] > 0, F.col(f"_b{i}") / spread[i]).otherwise(0.0) for i in size]
    return df.select(
        *keys, "rows", *[w.alias(f"w_{f}") for f, w in zip(features, weights)],
        (F.col("_my") - _total([w * F.col(f"_m{i}") for i, w in enumerate(weights)])).alias("intercept"),
        F.when(F.col("_vy") > 0, _total([F.col(f"_z{i}") * F.col(f"_z{i}") for i in size]) / F.col("_vy")).alias("r2"))


def apply(features: list[str]) -> Column:
    """The prediction of a row that has the features and the columns of its model."""
    return F.col("intercept") + _total([F.col(f"w_{f}") * F.col(f).cast("double") for f in features])


def _total(parts: list[Column]) -> Column:
    total = F.lit(0.0)
    for part in parts:
        total = total + part
    return total
