"""Expected values from a model per group: standardised ridge, or boosted trees.

The ridge model is fitted from additive moments.  A grouping-sets aggregate gives, for every group, the sums of products of the
numeric features, their sums by one-hot member, and the counts of pairs of members that occur together; a one-hot
member is a key there, never a column.  Only these sparse moments are shuffled, and one task per group solves its
normal equations from them, by conjugate gradients where there are many members.  Scoring joins the members' weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrivane.config import DetectorConfig, Settings
from metrivane.functions.scalars import all_present
from metrivane.operators.joins import hinted, small_enough
from metrivane.operators.medians import exact_median
from metrivane.session import stage

NUMERIC = ("moving_baseline", "days_since_start", "day_of_week", "month")
DENSE = 1_000  # features up to which the normal equations are solved directly


@dataclass(frozen=True)
class Features:
    """Everything scoring needs to know about the feature frame."""

    start: object  # first date of the table
    split: object  # first date that is no training date
    fill: float | None  # median used where the baseline is NULL
    numeric: tuple[str, ...]
    dims: tuple[str, ...]  # dimensions whose members are one-hot features


def split_date(df: DataFrame, fraction: float) -> DataFrame:
    """One row (start, split): training rows are those dated before ``split``.

    The distinct dates are bounded by the calendar, so one sorted array holds them.
    """
    days = df.where(F.col("date").isNotNull()).groupBy("date").agg(F.lit(1).alias("_one"))
    ordered = F.array_sort(F.collect_list("date"))
    clamped = F.greatest(F.lit(1), F.least(F.size("d") - 1, F.floor(F.size("d") * F.lit(fraction)))).cast("int")
    return days.agg(ordered.alias("d")).select(
        F.try_element_at("d", F.lit(1)).alias("start"), F.try_element_at("d", clamped + 1).alias("split")
    )


def describe_features(
    df: DataFrame, settings: Settings, numeric: tuple[str, ...] = NUMERIC, one_hot: tuple[str, ...] | None = None
) -> Features:
    """Dates, imputation value and dimensions: three scalars reach the driver.

    A dimension that is part of the model group is constant within it and gets
    coefficient 0, so it is left out.  Label columns are never read.
    """
    cfg = settings.detector
    dims = [d for d in settings.dimensions if d not in cfg.group_columns] if one_hot is None else list(one_hot)
    dates = split_date(df, cfg.train_fraction).first()
    fill = None
    if "moving_baseline" in numeric:
        row = exact_median(df, [], "moving_baseline").first()
        fill = row[0] if row else None
    return Features(dates["start"], dates["split"], fill, tuple(numeric), tuple(dims))


def numeric_columns(f: Features) -> dict[str, Column]:
    exprs = {
        "moving_baseline": F.coalesce("moving_baseline", F.lit(f.fill).cast("double")),
        "days_since_start": F.datediff("date", F.lit(f.start)).cast("double"),
        "day_of_week": F.weekday("date").cast("double"),
        "month": F.month("date").cast("double"),
    }
    return {name: F.coalesce(exprs[name], F.lit(0.0)) for name in f.numeric}


def training_rows(f: Features) -> Column:
    return (F.col("date") < F.lit(f.split)) & F.col("actual_value").isNotNull()


def moments(df: DataFrame, f: Features, cfg: DetectorConfig) -> DataFrame:
    """Sparse moments of the training rows: per group one row without members (i and j NULL), one per member (j NULL)
    and one per pair of members of different dimensions that occur together.

    n counts rows.  Numeric features and the target are taken from their group's means, which the first row carries;
    s are their sums, q the sums of their products.
    """
    groups, k = list(cfg.group_columns), len(f.numeric)
    z = [*numeric_columns(f).values(), F.col("actual_value").cast("double")]
    train = df.where(training_rows(f)).select(F.struct(*groups).alias("_group"), *f.dims, *[c.alias(f"_z{i}") for i, c in enumerate(z)])
    means = stage(train.groupBy(F.col("_group").alias("_of")).agg(*[F.avg(f"_z{i}").alias(f"_m{i}") for i in range(k + 1)]))
    rows = train.join(hinted(means), F.col("_group").eqNullSafe(F.col("_of")))
    rows = rows.withColumns({f"_z{i}": F.col(f"_z{i}") - F.col(f"_m{i}") for i in range(k + 1)})
    products = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    # one row for each combination of members first, so that the sets below multiply few rows
    cells = rows.groupBy("_group", *f.dims).agg(
        F.count("*").alias("_n"),
        *[F.max(f"_m{i}").alias(f"_m{i}") for i in range(k + 1)],
        *[F.sum(f"_z{i}").alias(f"_s{i}") for i in range(k + 1)],
        *[F.sum(F.col(f"_z{i}") * F.col(f"_z{j}")).alias(f"_q{i}_{j}") for i, j in products],
    )
    sets = [(), *[(d,) for d in f.dims], *[(a, b) for i, a in enumerate(f.dims) for b in f.dims[i + 1 :]]]
    summed = cells.groupingSets([["_group", *s] for s in sets], "_group", *f.dims).agg(
        F.grouping_id().alias("_set"),
        F.sum("_n").cast("double").alias("n"),
        F.array(*[F.sum(f"_s{i}") for i in range(k + 1)]).alias("s"),
        F.array(*[F.sum(f"_q{i}_{j}") for i, j in products]).alias("q"),
        F.array(*[F.max(f"_m{i}") for i in range(k + 1)]).alias("mean"),
    )
    first, second = F.lit(None).cast("string"), F.lit(None).cast("string")
    places: list[Column] = [F.lit(None).cast("int")] * 2
    for s in sets[1:]:
        here = F.col("_set") == sum(1 << (len(f.dims) - 1 - i) for i, d in enumerate(f.dims) if d not in s)
        at = [f.dims.index(d) for d in s]
        first = F.when(here, F.col(s[0]).cast("string")).otherwise(first)
        places[0] = F.when(here, F.lit(at[0])).otherwise(places[0])
        if len(s) == 2:
            second = F.when(here, F.col(s[1]).cast("string")).otherwise(second)
            places[1] = F.when(here, F.lit(at[1])).otherwise(places[1])
    plain = F.col("_set") == (1 << len(f.dims)) - 1
    found = summed.select(
        "_group.*", places[0].alias("dim_i"), first.alias("i"), places[1].alias("dim_j"), second.alias("j"),
        "n", "s", F.when(plain, F.col("q")).alias("q"), F.when(plain, F.col("mean")).alias("mean"),
    )
    # a missing member is no feature
    whole = (F.col("dim_i").isNull() | F.col("i").isNotNull()) & (F.col("dim_j").isNull() | F.col("j").isNotNull())
    return found.where(whole)


def fit_ridge(df: DataFrame, f: Features, cfg: DetectorConfig) -> DataFrame:
    """Per group one row without dim (n_train, level: the prediction where every feature is 0, weights of the numeric
    features) and one per member: dim (its place in ``f.dims``), member, weight.

    A task holds the sparse moments of one group, which grow with its members and the pairs of them that occur.
    """
    groups = list(cfg.group_columns)
    found = moments(df, f, cfg)
    model = [
        T.StructField("dim", T.IntegerType()),
        T.StructField("member", T.StringType()),
        T.StructField("weight", T.DoubleType()),
        T.StructField("n_train", T.DoubleType()),
        T.StructField("level", T.DoubleType()),
        T.StructField("weights", T.ArrayType(T.DoubleType())),
    ]
    schema = T.StructType([*[found.schema[g] for g in groups], *model])
    return found.groupBy(*groups).applyInPandas(_solver(groups, len(f.numeric), float(cfg.ridge_alpha), DENSE), schema)


def _solver(groups: list[str], k: int, alpha: float, dense: int):
    # closures over numpy and pandas only, so executors need no copy of this package

    def conjugate_gradients(times, target):
        """The solution of ``times(x) = target`` that the zero vector leads to; of many, the smallest one."""
        x, r = np.zeros(len(target)), target.copy()
        p, size = r.copy(), float(r @ r)
        least = 1e-26 * size
        for _ in range(20 * len(target)):
            if size <= least:
                break
            ap = times(p)
            step = size / float(p @ ap)
            x, r = x + step * p, r - step * ap
            p, size = r + p * (float(r @ r) / size), float(r @ r)
        return x

    def solved(means, rows, n, centred, counts, sums, first, second, together):
        """Weights of the numeric features and of the members."""
        m = len(counts)
        cross = sums[:, :k] - counts[:, None] * (rows[:k] / n)
        target = np.concatenate([centred[:k, k], sums[:, k] - counts * rows[k] / n])
        deviation = np.sqrt(np.concatenate([np.maximum(np.diag(centred)[:k], 0.0), counts * (n - counts) / n]) / n)
        scale = np.concatenate([np.abs(means[:k]), np.ones(m)])
        kept = deviation > 1e-12 * np.maximum(scale, 1.0)  # a constant feature has weight 0
        std = np.where(kept, deviation, 1.0)

        if k + m <= dense:
            gram = np.zeros((k + m, k + m))
            gram[:k, :k], gram[k:, :k], gram[:k, k:] = centred[:k, :k], cross, cross.T
            gram[k:, k:] = np.diag(counts) - np.outer(counts, counts) / n
            gram[k + first, k + second] += together
            gram[k + second, k + first] += together
            gram = (gram / np.outer(std, std))[np.ix_(kept, kept)] + alpha * np.eye(int(kept.sum()))
            beta = None
            if alpha > 0:  # without a penalty, one-hot columns make the system singular
                try:
                    beta = np.linalg.solve(gram, (target / std)[kept])
                except np.linalg.LinAlgError:
                    pass
            if beta is None:
                beta = np.linalg.lstsq(gram, (target / std)[kept], rcond=None)[0]
        else:

            def times(x):
                v = np.zeros(k + m)
                v[kept] = x / std[kept]
                a, b = v[:k], v[k:]
                out = np.empty(k + m)
                out[:k] = centred[:k, :k] @ a + cross.T @ b
                out[k:] = cross @ a + counts * b - counts * (counts @ b / n)
                out[k:] += np.bincount(first, together * b[second], m) + np.bincount(second, together * b[first], m)
                return out[kept] / std[kept] + alpha * x

            beta = conjugate_gradients(times, (target / std)[kept])
        weights = np.zeros(k + m)
        weights[kept] = beta / std[kept]
        return weights

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        plain = pdf[pdf["dim_i"].isna()].iloc[0]
        members = pdf[pdf["dim_i"].notna() & pdf["dim_j"].isna()]
        pairs = pdf[pdf["dim_j"].notna()]
        n, rows = float(plain["n"]), np.array(plain["s"], float)
        means = np.array(plain["mean"], float)
        centred = np.zeros((k + 1, k + 1))
        centred[np.triu_indices(k + 1)] = plain["q"]
        centred = centred + np.triu(centred, 1).T - np.outer(rows, rows) / n
        place = pd.MultiIndex.from_arrays([members["dim_i"].astype(int), members["i"]])
        first = place.get_indexer(pd.MultiIndex.from_arrays([pairs["dim_i"].astype(int), pairs["i"]]))
        second = place.get_indexer(pd.MultiIndex.from_arrays([pairs["dim_j"].astype(int), pairs["j"]]))
        counts = members["n"].to_numpy(float)
        sums = np.array(members["s"].tolist(), float).reshape(len(members), k + 1)
        weights = solved(means, rows, n, centred, counts, sums, first, second, pairs["n"].to_numpy(float))
        shift = means + rows / n
        level = shift[k] - shift[:k] @ weights[:k] - counts @ weights[k:] / n
        head = [plain[g] for g in groups]
        out = [[*head, None, None, None, n, level, weights[:k].tolist()]]
        out += [[*head, d, i, w, None, None, None] for d, i, w in zip(members["dim_i"].astype(int), members["i"], weights[k:])]
        return pd.DataFrame(out, columns=[*groups, "dim", "member", "weight", "n_train", "level", "weights"])

    return run


def score_ridge(df: DataFrame, model: DataFrame, f: Features, cfg: DetectorConfig) -> DataFrame:
    """Add ``predicted_value``; groups with too few training rows predict their baseline,
    rows without a group predict nothing.  A member without training rows has no weight."""
    groups = list(cfg.group_columns)
    base = model.where(F.col("dim").isNull()).select(*groups, F.col("n_train").alias("_n"), F.col("level").alias("_level"), F.col("weights").alias("_w"))
    sized = F.broadcast if small_enough(model) else (lambda side: side)
    joined = df.join(sized(base), groups, "left")
    fitted = F.col("_level")
    for at, expr in enumerate(numeric_columns(f).values()):
        fitted = fitted + expr * F.col("_w")[at]
    for at, dim in enumerate(f.dims):
        own = model.where(F.col("dim") == at)
        own = own.select(*groups, F.col("member").alias(f"_m{at}"), F.col("weight").alias(f"_w{at}"))
        joined = joined.withColumn(f"_m{at}", F.col(dim).cast("string")).join(sized(own), [*groups, f"_m{at}"], "left")
        fitted = fitted + F.coalesce(f"_w{at}", F.lit(0.0))
    enough = F.coalesce(F.col("_n") >= cfg.min_train_rows, F.lit(False))
    predicted = F.when(all_present(groups), F.when(enough, fitted).otherwise(F.col("moving_baseline")))
    return joined.select(*df.columns, predicted.alias("predicted_value"))


def predict_ridge(
    df: DataFrame, settings: Settings, numeric: tuple[str, ...] = NUMERIC, one_hot: tuple[str, ...] | None = None
) -> DataFrame:
    f = describe_features(df, settings, numeric, one_hot)
    if f.split is None:  # fewer than two dates: nothing to train on
        return df.withColumn("predicted_value", F.col("moving_baseline"))
    model = stage(fit_ridge(df, f, settings.detector))
    return score_ridge(df, model, f, settings.detector)


def predict(df: DataFrame, settings: Settings) -> DataFrame:
    from metrivane.operators.boosting import predict_trees

    models = {"ridge": predict_ridge, "gbt": predict_trees}
    if settings.detector.model not in models:
        raise ValueError(f"Unknown residual model: {settings.detector.model}")
    return models[settings.detector.model](df, settings)
