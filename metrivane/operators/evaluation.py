"""Detectors scored against labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrivane.functions.scalars import half_even, ratio_or_zero

# Detector name -> flag column.
DETECTORS = {
    "threshold_breached": "threshold_breached",
    "zscore_anomaly": "zscore_anomaly",
    "residual_anomaly": "residual_anomaly",
    "combined_anomaly": "combined_anomaly",
}


def evaluate(rows: DataFrame, detectors: dict[str, str] = DETECTORS, truth: str = "is_incident") -> DataFrame:
    """Confusion counts, precision, recall and F1 per detector, in one scan.

    The counts of all detectors are one aggregate row, which is then turned into
    one row per detector; the input is not multiplied by the number of detectors.
    """
    t = F.coalesce(F.col(truth).cast("boolean"), F.lit(False))
    counts = [F.count("*").alias("_rows"), F.count_if(t).alias("_support")]
    for i, column in enumerate(detectors.values()):
        p = F.coalesce(F.col(column).cast("boolean"), F.lit(False))
        counts += [F.count_if(t & p).alias(f"_tp{i}"), F.count_if(~t & p).alias(f"_fp{i}")]
    total = rows.agg(*counts)
    each = [
        F.struct(
            F.lit(name).alias("detector"),
            F.col(f"_tp{i}").alias("true_positives"),
            F.col(f"_fp{i}").alias("false_positives"),
        )
        for i, name in enumerate(detectors)
    ]
    table = total.select("_rows", "_support", F.inline(F.array(*each)))
    tp, fp = F.col("true_positives"), F.col("false_positives")
    fn = F.col("_support") - tp
    table = (
        table.withColumn("false_negatives", fn)
        .withColumn("true_negatives", F.col("_rows") - F.col("_support") - fp)
        .withColumn("_p", ratio_or_zero(tp, tp + fp))
        .withColumn("_r", ratio_or_zero(tp, F.col("_support")))
    )
    f1 = ratio_or_zero(2 * F.col("_p") * F.col("_r"), F.col("_p") + F.col("_r"))
    return table.select(
        "detector",
        half_even("_p", 6).alias("precision"),
        half_even("_r", 6).alias("recall"),
        half_even(f1, 6).alias("f1_score"),
        "true_positives",
        "false_positives",
        "false_negatives",
        "true_negatives",
        F.col("_support").alias("support"),
        F.col("_rows").alias("total_rows"),
    )


def best_detector(evaluation: DataFrame) -> DataFrame:
    """The detector with the best F1, then recall, then precision, then name."""
    return evaluation.orderBy(F.desc("f1_score"), F.desc("recall"), F.desc("precision"), "detector").limit(1)
