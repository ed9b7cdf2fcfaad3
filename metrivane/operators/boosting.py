"""Boosted regression trees, one ensemble per group, for any number of groups of any size.

Groups of up to IN_TASK rows are fitted side by side, each in one task.  Larger ones grow all their trees together, level by level: a level
is one aggregation of the training rows by (group, node, feature, bin), a choice of the best split per (group, node) from those
histograms, and a join that sends the rows on.  What is shuffled there are histogram cells, never rows, and the only loop is over
rounds.  Both ways give the same trees to the last bit.

Numeric features are binned at quantiles of their group's training rows; a one-hot member is a bin of its own, split off from all others.
Residuals are summed as integers on a grid of their group, so trees do not depend on the order of rows or on partitions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metrivane.config import DetectorConfig, Settings
from metrivane.functions.scalars import all_present
from metrivane.operators.joins import BROADCAST_ROWS, null_safe_left
from metrivane.operators.residual import Features, describe_features, numeric_columns, training_rows
from metrivane.session import stage

BINS = 32  # of a numeric feature
ACCURACY = 10_000  # of the quantiles; exact for groups of fewer rows
PENALTY = 1.0  # fixed value: squared penalty on leaf weights
GRID_BITS = 60  # of a sum of residuals
IN_TASK = 50_000  # rows of a group that one task may hold
LAST = float("inf")  # the bin behind the last cut


def group_table(rows: DataFrame, k: int) -> DataFrame:
    """One row per group: numbers of rows and of training rows, the mean of these, cuts of each numeric feature, grid of
    the residuals."""
    train = F.col("_train")
    shares = [i / BINS for i in range(1, BINS)]
    cuts = [F.array_distinct(F.percentile_approx(F.when(train, F.col("_x")[i]), shares, ACCURACY)) for i in range(k)]
    found = rows.groupBy("_group").agg(
        F.count("*").alias("_rows"), F.count_if(train).alias("_n"), F.array(*cuts).alias("_cuts"), F.max(F.when(train, F.abs("_y"))).alias("_largest")
    )
    # the mean from a sum of integers: the same in any order
    bits = F.lit(GRID_BITS) - F.ceil(F.log2(F.greatest(F.col("_largest"), F.lit(1e-250)))) - F.ceil(F.log2(F.col("_n") + 1))
    found = stage(found.withColumn("_grid", F.pow(F.lit(2.0), F.least(bits, F.lit(1000)) - 2)))
    known = _small(found.select(F.col("_group").alias("_of"), "_grid"), found)
    sized = rows.where(train).select("_group", "_y").join(known, F.col("_group").eqNullSafe(F.col("_of")))
    means = sized.groupBy("_of").agg((F.sum(_on_grid("_y")) / F.max("_grid") / F.count("*")).alias("_base"))
    return stage(null_safe_left(found.drop("_largest"), means.withColumnRenamed("_of", "_group"), ["_group"]))


def _on_grid(value: str) -> Column:
    return F.rint(F.col(value) * F.col("_grid")).cast("bigint")


def _small(df: DataFrame, groups: DataFrame) -> DataFrame:
    """``df``, with up to a few rows per group, under a broadcast hint where the groups are few; they are counted once."""
    if not hasattr(groups, "_few"):
        groups._few = groups.limit(BROADCAST_ROWS // 8 + 1).count() <= BROADCAST_ROWS // 8
    return F.broadcast(df) if groups._few else df


def prepared(df: DataFrame, f: Features, cfg: DetectorConfig) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(``df`` with _id, the rows' training state, the group table)."""
    numbered = stage(df.withColumn("_id", F.monotonically_increasing_id()))
    rows = numbered.select(
        "_id",
        F.struct(*[F.col(g) for g in cfg.group_columns]).alias("_group"),
        training_rows(f).alias("_train"),
        F.col("actual_value").cast("double").alias("_y"),
        F.array(*numeric_columns(f).values()).alias("_x"),
        F.array(*[F.col(d).cast("string") for d in f.dims]).cast("array<string>").alias("_members"),
        F.array(*[F.xxhash64(F.lit(len(f.numeric) + i), d) for i, d in enumerate(f.dims)]).cast("array<bigint>").alias("_member_keys"),
        F.xxhash64("date", *f.dims, *cfg.group_columns).alias("_key"),
    )
    groups = group_table(rows, len(f.numeric))
    known = _small(groups.withColumnRenamed("_group", "_of"), groups)
    rows = rows.join(known, F.col("_group").eqNullSafe(F.col("_of")))  # a group without training rows stays out
    bins = [_bin(F.col("_cuts")[i], F.col("_x")[i]) for i in range(len(f.numeric))]
    state = rows.select(
        "_id", "_group", "_train", "_y", "_members", "_member_keys", "_key", "_grid", "_n", "_rows", F.array(*bins).cast("array<double>").alias("_bins"),
        F.col("_base").alias("_fit"),
    )
    return numbered, stage(state), groups


def _bin(cuts: Column, x: Column) -> Column:
    """The smallest cut that is not below ``x``."""
    return F.coalesce(F.get(F.filter(cuts, lambda c: c >= x), F.lit(0)), F.lit(LAST))


ROW, FEATURE = 1, 2  # what a chance is for
# the primes of xxHash64 (fixed values)
XXH64 = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


def _chance(cfg: DetectorConfig, tree: int, what: int, key: Column) -> Column:
    """A number in [0, 1) that depends on the seed, the round and the key only."""
    constants = [F.lit(x).cast("bigint") for x in (cfg.seed, tree, what)]
    return F.pmod(F.xxhash64(*constants, key), F.lit(1 << 30)) / float(1 << 30)


def histograms(rows: DataFrame, k: int, d: int, cfg: DetectorConfig, tree: int) -> DataFrame:
    """Sums of residuals on the grid and numbers of training rows by group, node, feature and bin or member."""
    numeric = [F.struct(F.lit(i).alias("f"), F.col("_bins")[i].alias("v"), F.lit(None).cast("string").alias("m"), F.lit(i).cast("bigint").alias("h")) for i in range(k)]
    hot = [F.struct(F.lit(k + i).alias("f"), F.lit(None).cast("double").alias("v"), F.col("_members")[i].alias("m"), F.col("_member_keys")[i].alias("h")) for i in range(d)]
    used = rows.where(F.col("_train") & F.col("_node").isNotNull() & (_chance(cfg, tree, ROW, F.col("_key")) < cfg.subsample))
    used = used.withColumn("_residual", F.col("_y") - F.col("_fit"))
    cells = used.select("_group", "_node", "_grid", _on_grid("_residual").alias("g"), F.inline(F.array(*numeric, *hot)))
    return cells.groupBy("_group", "_node", "f", "v", "m", "h").agg(F.sum("g").alias("g"), F.count("*").alias("n"), F.max("_grid").alias("_grid"))


def best_splits(cells: DataFrame, k: int, cfg: DetectorConfig, tree: int) -> DataFrame:
    """One row per group and node: feature and cut or member of the best split (NULL: none is better than none), weights
    of its sides and of the node itself.

    Numeric features send bins up to the cut to the left, members all others.  Of equal splits the first feature, the
    lowest cut and the last member by name are taken.
    """
    whole = Window.partitionBy("_group", "_node", "f")
    upto = whole.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = cells.withColumns({"_tg": F.sum("g").over(whole), "_tn": F.sum("n").over(whole)})
    numeric = F.col("f") < k
    total = total.withColumns(
        {
            "_lg": F.when(numeric, F.sum("g").over(upto)).otherwise(F.col("_tg") - F.col("g")),
            "_ln": F.when(numeric, F.sum("n").over(upto)).otherwise(F.col("_tn") - F.col("n")),
        }
    )

    def weight(g: Column, n: Column) -> Column:
        return g / F.col("_grid") / (n + PENALTY)

    def score(g: Column, n: Column) -> Column:
        return weight(g, n) * (g / F.col("_grid"))

    lg, ln, tg, tn = (F.col(c) for c in ("_lg", "_ln", "_tg", "_tn"))
    gain = score(lg, ln) + score(tg - lg, tn - ln) - score(tg, tn)
    allowed = (ln > 0) & (ln < tn) & (gain > 0) & (numeric | F.col("m").isNotNull())
    allowed &= _chance(cfg, tree, FEATURE, F.col("h")) < cfg.colsample
    choice = F.struct(
        F.when(allowed, gain).alias("gain"), (-F.col("f")).alias("_f"), (-F.col("v")).alias("_v"), F.col("m").alias("_m"),
        weight(lg, ln).alias("left"), weight(tg - lg, tn - ln).alias("right"), weight(tg, tn).alias("own"),
    )
    best = total.groupBy("_group", "_node").agg(F.max(choice).alias("b"))
    found = F.col("b.gain").isNotNull()
    return best.select(
        F.col("_group").alias("_of"), F.col("_node").alias("_at"), F.when(found, -F.col("b._f")).alias("_f"), (-F.col("b._v")).alias("_v"),
        F.col("b._m").alias("_m"), F.col("b.left").alias("_left"), F.col("b.right").alias("_right"), F.col("b.own").alias("_own"),
    )


def grown(rows: DataFrame, groups: DataFrame, k: int, d: int, cfg: DetectorConfig, tree: int) -> DataFrame:
    """``rows`` with one more tree added to _fit."""
    columns = rows.columns
    rows = rows.withColumns({"_node": F.lit(1), "_step": F.lit(0.0)})
    for _ in range(cfg.depth):
        splits = _small(best_splits(histograms(rows, k, d, cfg, tree), k, cfg, tree), groups)
        rows = rows.join(splits, F.col("_group").eqNullSafe(F.col("_of")) & (F.col("_node") == F.col("_at")), "left")
        split = F.col("_f").isNotNull()
        right = F.when(F.col("_f") < k, F.get("_bins", F.col("_f")) > F.col("_v")).otherwise(
            F.get("_members", F.col("_f") - k).eqNullSafe(F.col("_m"))
        )
        step = F.when(split, F.when(right, F.col("_right")).otherwise(F.col("_left"))).otherwise(F.coalesce("_own", "_step"))
        node = F.when(split, F.col("_node") * 2 + right.cast("int"))
        rows = rows.select(*columns, node.alias("_node"), step.alias("_step"))
    fit = F.col("_fit") + F.col("_step") * cfg.learning_rate
    return rows.select(*[c for c in columns if c != "_fit"], fit.alias("_fit"))


def _grower(k: int, d: int, cfg: DetectorConfig):
    """All trees of one group, from its rows."""
    # closures over numpy and pandas only, so executors need no copy of this package
    seed, trees, depth, rate, penalty = cfg.seed, cfg.trees, cfg.depth, cfg.learning_rate, PENALTY
    subsample, colsample, row, feature = cfg.subsample, cfg.colsample, ROW, FEATURE
    p1, p2, p3, p4, p5 = (np.uint64(int(x)) for x in XXH64)

    def turned(x, n):
        return (x << np.uint64(n)) | (x >> np.uint64(64 - n))

    def hashed(x, start):
        """xxHash64 of longs, as Spark's xxhash64 chains it."""
        h = turned((start + p5 + np.uint64(8)) ^ (turned(x * p2, 31) * p1), 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))

    def chance(tree, what, keys):
        h = np.array([42], np.uint64)
        for x in (seed, tree, what):
            h = hashed(np.array([x], np.int64).view(np.uint64), h)
        return (hashed(keys.view(np.uint64), h).view(np.int64) % (1 << 30)) / float(1 << 30)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n = len(pdf)
        train, y, grid = pdf["_train"].to_numpy(bool), pdf["_y"].to_numpy(float), float(pdf["_grid"].iloc[0])
        fit, keys = pdf["_fit"].to_numpy(float).copy(), pdf["_key"].to_numpy(np.int64)
        if not train.any():
            return pd.DataFrame({"_id": pdf["_id"], "_fit": fit})
        bins = np.array(pdf["_bins"].tolist(), float).reshape(n, k)
        # the bins of all features in a row: numeric ones by cut, members by name and last the lack of one
        codes, hashes, members = [], [], [list(m) for m in zip(*pdf["_members"])]
        for i in range(k):
            own, code = np.unique(bins[:, i], return_inverse=True)
            codes.append(code)
            hashes.append(np.full(len(own), i, np.int64))
        for i in range(d):
            own = sorted({m for m in members[i] if m is not None})
            at = {m: j for j, m in enumerate(own)}
            codes.append(np.array([at.get(m, len(own)) for m in members[i]]))
            of = dict(zip(members[i], (h[i] for h in pdf["_member_keys"])))
            hashes.append(np.array([*[of[m] for m in own], 0], np.int64))
        sizes = np.array([len(h) for h in hashes], np.int64)
        starts = np.cumsum(sizes) - sizes
        feature_of, numeric = np.repeat(np.arange(k + d), sizes), np.repeat(np.arange(k + d) < k, sizes)
        within = np.arange(int(sizes.sum())) - starts[feature_of]
        # of equal splits the first feature's, its lowest cut's or its last member's
        order = starts[feature_of] + np.where(numeric, within, sizes[feature_of] - 1 - within)
        missing = ~numeric & (within == sizes[feature_of] - 1)
        codes, hashes = np.stack(codes, axis=1) + starts, np.concatenate(hashes)

        def best(rows, g, drawn):
            """(feature, bin, weights of both sides) of the best split of ``rows``, or None; and the node's own weight."""
            tg, tn = np.int64(g[rows].sum()), len(rows)

            def weight(total, count):
                return total / grid / (count + penalty)

            def score(total, count):
                return weight(total, count) * (total / grid)

            sums, mine = np.zeros(len(order), np.int64), codes[rows]
            counts = np.bincount(mine.ravel(), minlength=len(order))
            np.add.at(sums, mine, g[rows][:, None])
            seen = (counts > 0) & drawn & ~missing
            lg, ln = np.cumsum(sums), np.cumsum(counts)
            lg, ln = lg - (lg - sums)[starts][feature_of], ln - (ln - counts)[starts][feature_of]
            lg, ln = np.where(numeric, lg, tg - sums), np.where(numeric, ln, tn - counts)
            gain = score(lg, ln) + score(tg - lg, tn - ln) - score(tg, tn)
            allowed = np.flatnonzero(seen & (ln > 0) & (ln < tn) & (gain > 0))
            own = float(weight(tg, tn))
            if not len(allowed):
                return None, own
            top = allowed[gain[allowed] == gain[allowed].max()]
            j = int(top[np.argmin(order[top])])
            return (int(feature_of[j]), j, float(weight(lg[j], ln[j])), float(weight(tg - lg[j], tn - ln[j]))), own

        for tree in range(trees):
            used = train & (chance(tree, row, keys) < subsample)
            drawn = chance(tree, feature, hashes) < colsample
            g = np.zeros(n, np.int64)
            g[train] = np.rint((y[train] - fit[train]) * grid).astype(np.int64)
            node, step = np.ones(n, np.int64), np.zeros(n)
            for _ in range(depth):
                for at in np.unique(node[node > 0]).tolist():
                    here = node == at
                    rows = np.flatnonzero(here & used)
                    node[here] = 0
                    if not len(rows):
                        continue
                    split, own = best(rows, g, drawn)
                    if split is None:
                        step[here] = own
                        continue
                    i, j, left, right = split
                    goes = here & ((codes[:, i] > j) if i < k else (codes[:, i] == j))
                    step[here] = left
                    step[goes] = right
                    node[here] = -2 * at
                    node[goes] = -2 * at - 1
                node = -node
            fit += step * rate
        return pd.DataFrame({"_id": pdf["_id"], "_fit": fit})

    return run


def fit_in_tasks(rows: DataFrame, k: int, d: int, cfg: DetectorConfig) -> DataFrame:
    """_id, _fit of groups that a task can hold."""
    return rows.groupBy("_group").applyInPandas(_grower(k, d, cfg), "_id long, _fit double")


def fit_in_rounds(rows: DataFrame, groups: DataFrame, k: int, d: int, cfg: DetectorConfig) -> DataFrame:
    """_id, _fit of groups of any size."""
    for tree in range(cfg.trees):
        rows = stage(grown(rows, groups, k, d, cfg, tree))
    return rows.select("_id", "_fit")


def predict_trees(df: DataFrame, settings: Settings, in_task: int | None = None) -> DataFrame:
    """Add ``predicted_value``: boosted trees per group, fitted on the training rows of the group.

    Groups with too few training rows predict their baseline, rows without a group nothing.
    """
    cfg, in_task = settings.detector, IN_TASK if in_task is None else in_task
    f = describe_features(df, settings)
    if f.split is None:  # fewer than two dates: nothing to train on
        return df.withColumn("predicted_value", F.col("moving_baseline"))
    numbered, rows, groups = prepared(df, f, cfg)
    rows, k, d = rows.where(F.col("_n") >= cfg.min_train_rows), len(f.numeric), len(f.dims)
    fitted = fit_in_tasks(rows.where(F.col("_rows") <= in_task), k, d, cfg)
    if not groups.where(F.col("_rows") > in_task).isEmpty():
        fitted = fitted.unionByName(fit_in_rounds(rows.where(F.col("_rows") > in_task), groups, k, d, cfg))
    joined = numbered.join(fitted.withColumnRenamed("_fit", "_tree_fit"), "_id", "left")
    predicted = F.when(all_present(list(cfg.group_columns)), F.coalesce("_tree_fit", "moving_baseline"))
    return joined.select(*df.columns, predicted.alias("predicted_value"))
