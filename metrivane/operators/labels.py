"""Label rows that fall into an incident window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrivane.operators.joins import null_safe_left

LEVELS = 31  # a dyadic block of the highest level holds 2 ** 30 days


def _wildcards(dims: list[str], of=F.col) -> Column:
    """A bit for every dimension in which a rule takes any member."""
    return reduce(lambda a, b: a + b, [F.when(of(d).isNull(), 1 << i).otherwise(0) for i, d in enumerate(dims)], F.lit(0))


def _blocks(rules: DataFrame) -> DataFrame:
    """``rules`` once for each dyadic block of days that their windows consist of, at most two of a level."""
    first, behind = F.unix_date(F.to_date("start_date")), F.unix_date(F.to_date("end_date")) + 1
    rows = rules.withColumns({"_s": first, "_e": behind, "_level": F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1)))})

    def inside(block: str, level: str) -> Column:
        return F.expr(f"shiftleft(cast({block} as bigint), {level}) >= _s and shiftleft(cast({block} as bigint) + 1, {level}) <= _e")

    edges = F.expr("array_distinct(array(cast(-shiftright(-cast(_s as bigint), _level) as int), shiftright(_e, _level) - 1))")
    rows = rows.withColumn("_block", F.explode(edges))
    rows = rows.where(inside("_block", "_level") & ~inside("shiftright(_block, 1)", "_level + 1"))
    return rows.drop("_s", "_e")


def label_windows(df: DataFrame, rules: DataFrame, dims: list[str]) -> DataFrame:
    """Add the four label columns from a table of rules.

    A rule has ``incident_id, incident_type, incident_description``, inclusive
    ``start_date`` and ``end_date``, and one column per dimension where NULL means
    any member.  Several matching rules join their ids and types with ``|`` and
    their descriptions with a space, in order of incident id.

    An equi-join: a rule is keyed by its wildcard dimensions, the members it names and the dyadic blocks of days
    that make up its window; a row has one key for each combination of wildcards and block size that occurs in the rules.  So a row
    meets only rules that apply to it, however many others are in force on its day.
    """
    columns = ["incident_id", "incident_type", "incident_description", "start_date", "end_date", *dims]
    valid = rules.where(F.col("start_date") <= F.col("end_date")).groupBy(*columns).agg(F.count("*").cast("int").alias("copies"))
    named = valid.withColumn("_mask", _wildcards(dims))
    keyed = _blocks(named).select(
        F.struct(*columns, "copies").alias("_rule"), "_mask", "_level", "_block", F.xxhash64("_mask", "_level", "_block", *dims).alias("_key")
    )
    combinations = keyed.select(F.col("_mask").alias("_m"), F.col("_level").alias("_l")).distinct()  # 31 * 2 ** len(dims) at most
    rows = df.select("date", *dims).where(F.col("date").isNotNull()).crossJoin(F.broadcast(combinations))
    rows = rows.withColumn("_b", F.expr("shiftright(unix_date(to_date(date)), _l)"))
    members = [F.when(F.col("_m").bitwiseAND(1 << i) == 0, F.col(d)) for i, d in enumerate(dims)]
    rows = rows.withColumn("_k", F.xxhash64("_m", "_l", "_b", *members))
    same = (F.col("_m") == F.col("_mask")) & (F.col("_l") == F.col("_level")) & (F.col("_b") == F.col("_block"))
    for d in dims:
        same = same & (F.col(f"_rule.{d}").isNull() | (F.col(f"_rule.{d}") == F.col(d)))
    hits = rows.join(keyed, (F.col("_k") == F.col("_key")) & same)
    found = hits.groupBy("date", *dims).agg(F.array_sort(F.collect_set("_rule")).alias("_rules"))
    found = found.withColumn("_hits", F.flatten(F.transform("_rules", lambda r: F.array_repeat(r, r["copies"])))).drop("_rules")
    joined = null_safe_left(df, found, ["date", *dims])

    def listed(name, sep):
        return F.coalesce(F.array_join(F.transform("_hits", lambda r: r[name]), sep), F.lit(""))

    return joined.withColumns(
        {
            "is_incident": F.col("_hits").isNotNull(),
            "incident_id": listed("incident_id", "|"),
            "incident_type": listed("incident_type", "|"),
            "incident_description": listed("incident_description", " "),
        }
    ).drop("_hits")
