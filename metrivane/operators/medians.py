"""Exact grouped medians by selection: no group is sorted, and none meets in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrivane.operators.joins import hinted, with_one_row
from metrivane.session import stage

_ACCURACY = 10_000
_STEPS = 500  # cells of the grid that brackets a rank
FEW = 4_096  # values of a group that are sorted at last


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """One row per group: the exact median of the non-NULL values; without keys NULL where there is none.

    Approximate percentiles, whose state is small and mergeable, propose two values around the middle ranks.  Counting what lies
    below, at and between them either names the median or leaves an open interval with few of the rows, and the same is done
    within it, until at most FEW values of a group are left to sort.  A proposal that misses a rank costs one more
    pass and nothing else.  ``df`` is read once or twice a pass: pass a stored or staged table.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    eps = min(0.5, 2.0 / _ACCURACY)
    bounds = rows.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.percentile_approx("_v", [0.5 - eps, 0.5 + eps], _ACCURACY).alias("_b")
    )
    nothing = F.lit(None).cast(rows.schema["_v"].dataType)
    state = bounds.select(
        *keys,
        F.floor((F.col("_n") + 1) / 2).alias("_t0"),  # the two middle ranks
        (F.floor(F.col("_n") / 2) + 1).alias("_t1"),
        *[nothing.alias(c) for c in ("_lo", "_hi", "_m0", "_m1")],  # the open interval, the values at the ranks
        F.lit(0).cast("bigint").alias("_before"),
        F.col("_n").alias("_in"),
        F.col("_b")[0].alias("_b0"),
        F.col("_b")[1].alias("_b1"),
    )
    state = stage(state)
    pending = _pending(state)
    while pending:
        many = state.where(_open() & (F.col("_in") > FEW))
        counted = stage(_narrowed(rows, many, keys))
        state = counted.unionByName(state.where(~_open() | (F.col("_in") <= FEW)))
        pending = _pending(counted)
        if pending:
            state = stage(_proposed(rows, state, keys))
    last = _inside(rows, state.where(_open()), keys)
    picked = last.groupBy(*keys).agg(
        F.sort_array(F.collect_list("_v")).alias("_a"), *[F.first(c).alias(c) for c in ("_t0", "_t1", "_m0", "_m1", "_before")]
    )
    at = [F.coalesce(f"_m{i}", F.try_element_at("_a", (F.col(f"_t{i}") - F.col("_before")).cast("int"))) for i in (0, 1)]
    found = picked.select(*keys, *at).toDF(*keys, "_m0", "_m1")
    known = state.where(~_open()).select(*keys, "_m0", "_m1").unionByName(found)
    if not keys:  # one row in any case
        known = known.agg(F.max("_m0").alias("_m0"), F.max("_m1").alias("_m1"))
    return known.select(*keys, ((F.col("_m0") + F.col("_m1")) / 2).alias(name))


def _open() -> Column:
    return (F.col("_m0").isNull() | F.col("_m1").isNull()) & (F.col("_in") > 0)


def _pending(state: DataFrame) -> bool:
    """Whether a group has more values left than are sorted."""
    return not state.where(_open() & (F.col("_in") > FEW)).isEmpty()


def _inside(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The values in the open interval of their group, with the group's state."""
    joined = rows.join(hinted(state), keys) if keys else with_one_row(rows, state)
    above = F.col("_lo").isNull() | (F.col("_v") > F.col("_lo"))
    return joined.where(above & (F.col("_hi").isNull() | (F.col("_v") < F.col("_hi"))))


def _narrowed(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The state after counting the values below, at and between the proposed two."""
    v, b0, b1 = F.col("_v"), F.col("_b0"), F.col("_b1")
    kept = ["_t0", "_t1", "_lo", "_hi", "_m0", "_m1", "_before", "_in", "_b0", "_b1"]
    counted = _inside(rows, state, keys).groupBy(*keys).agg(
        F.count_if(v < b0).alias("_less"),
        F.count_if(v == b0).alias("_same"),
        F.count_if((v > b0) & (v < b1)).alias("_between"),
        F.count_if((v == b1) & (b1 > b0)).alias("_last"),
        *[F.first(c).alias(c) for c in kept],
    )
    upto = F.col("_before")  # ranks up to which the values are below b0, b0 itself, between, b1
    ends = []
    for c in ("_less", "_same", "_between", "_last"):
        upto = upto + F.col(c)
        ends.append(upto)

    def named(i: int) -> Column:
        t = F.col(f"_t{i}")
        hit = F.when((t > ends[0]) & (t <= ends[1]), b0).when((t > ends[2]) & (t <= ends[3]), b1)
        return F.coalesce(f"_m{i}", hit)

    counted = counted.withColumns({"_k0": named(0), "_k1": named(1), **{f"_e{i}": e for i, e in enumerate(ends)}})
    first = F.when(F.col("_k0").isNull(), F.col("_t0")).otherwise(F.col("_t1"))  # the ranks still to be named
    last = F.when(F.col("_k1").isNull(), F.col("_t1")).otherwise(F.col("_t0"))
    e = [F.col(f"_e{i}") for i in range(4)]
    lo = F.when(first <= e[0], F.col("_lo")).when(first <= e[2], b0).otherwise(b1)
    hi = F.when(last <= e[0], b0).when(last <= e[2], b1).otherwise(F.col("_hi"))
    before = F.when(first <= e[0], F.col("_before")).when(first <= e[2], e[1]).otherwise(e[3])
    behind = F.when(last <= e[0], e[0]).when(last <= e[2], e[2]).otherwise(F.col("_before") + F.col("_in"))
    return counted.select(
        *keys, "_t0", "_t1", lo.alias("_lo"), hi.alias("_hi"), F.col("_k0").alias("_m0"), F.col("_k1").alias("_m1"),
        before.alias("_before"), (behind - before).alias("_in"), "_b0", "_b1",
    )


def _proposed(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The state with two new values around the ranks of groups that have many values left."""
    many = state.where(_open() & (F.col("_in") > FEW))
    grid = [i / _STEPS for i in range(_STEPS + 1)]
    kept = [c for c in state.columns if c not in (*keys, "_b0", "_b1")]
    found = _inside(rows, many.drop("_b0", "_b1"), keys).groupBy(*keys).agg(
        F.percentile_approx("_v", grid, _ACCURACY).alias("_grid"), *[F.first(c).alias(c) for c in kept]
    )

    def cell(i: int, step: int) -> Column:
        share = (F.col(f"_t{i}") - F.col("_before")) / F.col("_in") * _STEPS
        near = F.floor(share) if step < 0 else F.ceil(share)
        return F.col("_grid")[F.greatest(F.lit(0), F.least(F.lit(_STEPS), near.cast("int") + step))]

    proposed = found.withColumns({"_b0": cell(0, -1), "_b1": cell(1, 1)}).drop("_grid").select(*state.columns)
    return proposed.unionByName(state.where(~_open() | (F.col("_in") <= FEW)))
