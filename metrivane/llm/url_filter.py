"""URL filter: rules first, then the likelihood ratio of two character language models.

Two smoothed variable-order Markov models, one of accepted and one of rejected URLs, are counted over
all labelled URLs.  A URL is judged by the difference of its log-likelihoods per character against a
threshold calibrated on labelled URLs that were not counted.  DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrivane.llm.common import ascii_lower, stored, table
from metrivane.operators.joins import with_one_row

ORDER = 4  # longest context, in characters
LEAST = 2  # longer grams seen less often are left to their shorter context
WEIGHT = 2.0  # weight of the shorter context in the smoothing
FOLDS = 5  # one part of the labelled URLs calibrates, the others are counted
SYMBOLS = 48  # at most: letters, one digit, punctuation, one for all the rest, the two ends
SMALL = 300_000  # rows of the model (about 40 bytes each) up to which it is broadcast

#: (rule, allowed): the host, then the path from the first slash on
RULES = (("org/", True), ("example.org/es/", False), ("example.org/en/1", False), ("com/fr/", True), ("com/de/", False))


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null and without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    shape = r"^([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(rest, shape, 1)), F.regexp_extract(rest, shape, 2)


def fits(host: Column, path: Column, rule: str) -> Column:
    domain, slash, rest = rule.partition("/")
    return ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)


def judge_by_rules(host: Column, path: Column, rules: Sequence[tuple[str, bool]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls; of equally long ones the last given."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, allowed in sorted(rules, key=lambda r: len(r[0])):
        hit = fits(host, path, text)
        rule = F.when(hit, text).otherwise(rule)
        verdict = F.when(hit, "allow" if allowed else "block").otherwise(verdict)
    return rule, verdict


def folded(url: Column) -> Column:
    """What the models see: no scheme, lower case, every digit as 0, rare characters as *, marked ends."""
    plain = F.regexp_replace(ascii_lower(F.coalesce(url, F.lit(""))), r"^[^:/?#]*://", "")
    return F.concat(F.lit("^"), F.regexp_replace(F.regexp_replace(plain, "[0-9]", "0"), r"[^a-z0./?=&:#%_~+-]", "*"), F.lit("$"))


def grams(text: str, longest: int) -> Column:
    """All substrings of up to ``longest`` characters, one for each place and length; texts have two at least."""
    return F.expr(
        f"flatten(transform(sequence(1, least({longest}, length({text}))),"
        f" k -> transform(sequence(1, length({text}) - k + 1), i -> substring({text}, i, k))))"
    )


def count_grams(labelled: DataFrame) -> DataFrame:
    """gram, yes, no: occurrences in accepted and rejected URLs; combined within map tasks first."""
    each = labelled.select("accepted", F.explode(grams("text", ORDER + 1)).alias("gram"))
    return each.groupBy("gram").agg(
        F.sum(F.col("accepted").cast("long")).alias("yes"), F.sum((~F.col("accepted")).cast("long")).alias("no")
    )


def build_model(labelled: DataFrame) -> DataFrame:
    """gram, gain: what the last character of a gram adds to the difference of the log-likelihoods, given
    the other characters, beyond what it adds given one character less.

    p(c | context) = (count(context c) + WEIGHT p(c | shorter context)) / (count(context) + WEIGHT).
    Summed over all grams of a URL, the gains are the difference under the longest contexts known.
    """
    counts = count_grams(labelled).filter((F.col("yes") + F.col("no") >= LEAST) | (F.length("gram") == 1))
    counts = stored(counts, "url-grams")
    levels, below = [], None
    for k in range(1, ORDER + 2):
        own = counts.filter(F.length("gram") == k).withColumn("context", F.expr(f"substring(gram, 1, {k - 1})"))
        totals = own.groupBy("context").agg(F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"))
        own = own.join(totals, "context")
        if below is None:
            own = own.withColumns({"p_yes": F.lit(1.0 / SYMBOLS), "p_no": F.lit(1.0 / SYMBOLS)})
        else:
            shorter = below.select(F.col("gram").alias("shorter"), F.col("q_yes").alias("p_yes"), F.col("q_no").alias("p_no"))
            own = own.join(shorter, F.expr("substring(gram, 2)") == F.col("shorter"))
        below = own.select(
            "gram",
            ((F.col("yes") + WEIGHT * F.col("p_yes")) / (F.col("all_yes") + WEIGHT)).alias("q_yes"),
            ((F.col("no") + WEIGHT * F.col("p_no")) / (F.col("all_no") + WEIGHT)).alias("q_no"),
            "p_yes", "p_no",
        )
        gain = F.log("q_yes") - F.log("q_no") - F.log("p_yes") + F.log("p_no")
        levels.append(below.select("gram", gain.alias("gain")))
    return stored(reduce(DataFrame.unionByName, levels), "url-model")


def score(texts: DataFrame, model: DataFrame) -> DataFrame:
    """text, score: difference of the log-likelihoods per character, for each distinct text."""
    long = texts.select("text").distinct()
    size = F.greatest(F.length("text"), F.lit(1))
    each = long.select("text", F.explode(grams("text", ORDER + 1)).alias("gram"))
    if model.count() <= SMALL:
        model = F.broadcast(model)
    sums = each.join(model, "gram").groupBy("text").agg(F.sum("gain").alias("total"))
    return sums.select("text", (F.round("total", 9) / size).alias("score"))


def threshold(scores: DataFrame) -> DataFrame:
    """One row: the score between the two classes, as far from either mean in its standard deviations;
    0 where a class has no URL to calibrate on."""
    stats = [f(F.when(F.col("accepted") == want, F.col("score"))).alias(f"{n}_{int(want)}") for want in (True, False) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    spread = F.col("s_1") + F.col("s_0") + 2e-6
    middle = (F.col("m_1") * (F.col("s_0") + 1e-6) + F.col("m_0") * (F.col("s_1") + 1e-6)) / spread
    return scores.agg(*stats).select(F.coalesce(middle, F.lit(0.0)).alias("cut"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, bool]] = RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score.

    The longest rule that fits decides.  The models learn from the URLs that a rule decides and judge the
    others; without URLs of both kinds there is nothing to learn and the others are allowed, with a null
    score.  A null or empty URL has empty host and path, and is judged like any other by its (empty) text.  Repeated
    rows and null page_ids get a row each.  Other columns play no part.
    """
    host, path = parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"), folded(F.col("url")).alias("text"))
    rule, verdict = judge_by_rules(F.col("host"), F.col("path"), rules)
    urls = stored(urls.withColumns({"rule": rule, "ruled": verdict}), "url-parts")
    labelled = urls.filter("ruled is not null").select("text", (F.col("ruled") == "allow").alias("accepted"))
    part = F.pmod(F.xxhash64("text"), F.lit(FOLDS))
    model = build_model(labelled.filter(part > 0))
    known = labelled.agg(F.coalesce(F.count_distinct("accepted") == 2, F.lit(False)).alias("known"))
    held = labelled.filter(part == 0).groupBy("text", "accepted").count().drop("count")
    wanted = urls.filter("ruled is null").select("text").unionByName(held.select("text"))
    scores = stored(score(wanted, model), "url-scores")
    cut = with_one_row(threshold(held.join(scores, "text")), known)
    ruled = urls.filter("ruled is not null").select("page_id", "host", "path", "rule", F.col("ruled").alias("verdict"), F.lit(None).cast("double").alias("score"))
    other = with_one_row(urls.filter("ruled is null").join(scores, "text", "left"), cut)
    allowed = ~F.col("known") | (F.coalesce("score", F.lit(0.0)) >= F.col("cut"))
    other = other.select(
        "page_id", "host", "path", "rule", F.when(allowed, "allow").otherwise("block").alias("verdict"),
        F.when(F.col("known"), F.coalesce("score", F.lit(0.0))).alias("score"),
    )
    return ruled.unionByName(other)


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
