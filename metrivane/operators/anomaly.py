"""Anomaly detectors: rolling z-score, robust MAD, combination, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrivane.config import LABEL_COLUMNS, DetectorConfig, Settings
from metrivane.functions.scalars import (
    adverse,
    banded_severity,
    flag,
    half_even,
    lookup,
    ratio,
    severity_label,
    severity_rank,
)
from metrivane.operators.joins import hinted, null_safe_left
from metrivane.operators.medians import exact_median
from metrivane.operators.windows import Trailing, add_trailing
from metrivane.session import stage

MEASURES = [
    "actual_value",
    "expected_value",
    "moving_baseline",
    "percent_variance",
    "monitoring_status",
    "threshold_breached",
    "z_score",
    "zscore_anomaly",
    "zscore_severity",
    "predicted_value",
    "residual",
    "residual_percent",
    "residual_anomaly",
    "residual_severity",
    "combined_anomaly",
    "combined_severity",
]

MAD_SCALE = 0.6745  # fixed value: makes the MAD comparable to a standard deviation


def add_zscore(
    monitoring: DataFrame, dims, config: DetectorConfig = DetectorConfig(), block_days: int | None = None
) -> DataFrame:
    """Two-sided z-score against the lagged window; NULL std or std 0 gives NULL and NORMAL."""
    spread = Trailing("_std", "stddev_samp", "actual_value", -config.window, -1, config.min_periods)
    df = add_trailing(monitoring, list(dims), [spread], block_days=block_days)
    df = df.withColumn("z_score", ratio(F.col("actual_value") - F.col("moving_baseline"), F.col("_std"))).drop("_std")
    severity = banded_severity(F.abs("z_score"), config.z_warning, config.z_critical)
    return df.withColumn("zscore_severity", severity).withColumn(
        "zscore_anomaly", F.col("zscore_severity") != "NORMAL"
    )


def add_residual_flags(df: DataFrame, settings: Settings) -> DataFrame:
    """Residual against ``predicted_value`` and its one-sided flag.

    A KPI without a configured direction never flags.
    """
    cfg = settings.detector
    residual = F.col("actual_value") - F.col("predicted_value")
    df = df.withColumn("residual", residual).withColumn("residual_percent", ratio("residual", "predicted_value"))
    if cfg.residual_mode == "robust_mad":
        df = add_modified_zscore(stage(df), list(cfg.group_columns))
        score, warning, critical = "residual_modified_zscore", cfg.mad_warning, cfg.mad_critical
    elif cfg.residual_mode == "relative_pct":
        score, warning, critical = "residual_percent", cfg.residual_warning, cfg.residual_critical
    else:
        raise ValueError(f"Unknown residual mode: {cfg.residual_mode}")
    direction = lookup("kpi_name", settings.directions)
    severity = banded_severity(adverse(F.col(score), direction), warning, critical)
    return df.withColumn("residual_severity", severity).withColumn(
        "residual_anomaly", F.col("residual_severity") != "NORMAL"
    )


def add_modified_zscore(
    df: DataFrame, group: list[str], value: str = "residual", name: str = "residual_modified_zscore"
) -> DataFrame:
    """0.6745 (x - median) / MAD within each group; NULL when the MAD is 0."""
    medians = hinted(stage(exact_median(df, group, value, "_median")))
    centred = df.join(medians, group, "left")
    spread = centred.select(*group, F.abs(F.col(value) - F.col("_median")).alias("_dev"))
    mads = hinted(stage(exact_median(spread, group, "_dev", "_mad")))
    scored = centred.join(mads, group, "left")
    z = ratio(MAD_SCALE * (F.col(value) - F.col("_median")), F.col("_mad"))
    return scored.withColumn(name, z).drop("_median", "_mad").select(*df.columns, name)


def add_combined(df: DataFrame) -> DataFrame:
    """OR of the z-score and residual flags with the worse severity of the two."""
    worse = F.greatest(severity_rank("zscore_severity"), severity_rank("residual_severity"))
    return df.withColumn("combined_anomaly", F.col("zscore_anomaly") | F.col("residual_anomaly")).withColumn(
        "combined_severity", severity_label(worse)
    )


def label_columns(df: DataFrame) -> DataFrame:
    """Give ``df`` all four label columns: parsed if present, else false and ''."""
    if any(c not in df.columns for c in LABEL_COLUMNS):
        return df.withColumns({"is_incident": F.lit(False), **{c: F.lit("") for c in LABEL_COLUMNS[1:]}})
    return df.withColumn("is_incident", flag("is_incident"))


def join_labels(df: DataFrame, labelled: DataFrame, dims) -> DataFrame:
    """Left join of the labels on the business key; unmatched rows are unlabelled."""
    key = ["date", *dims]
    if any(c not in labelled.columns for c in LABEL_COLUMNS):
        return label_columns(df)  # nothing to join: an unlabelled source
    labels = label_columns(labelled).select(*key, *LABEL_COLUMNS)
    joined = null_safe_left(df.drop(*LABEL_COLUMNS), labels, key)
    return joined.withColumns(
        {
            "is_incident": F.coalesce("is_incident", F.lit(False)),
            **{c: F.coalesce(c, F.lit("")) for c in LABEL_COLUMNS[1:]},
        }
    )


def detect(monitoring: DataFrame, labelled: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The anomaly table: z-score, residual model, combination, labels.

    ``monitoring`` is read several times (model fit, medians, scoring): pass a
    stored or staged table.
    """
    from metrivane.operators.residual import predict

    scored = add_zscore(monitoring, settings.dimensions, settings.detector, settings.block_days)
    scored = add_residual_flags(predict(scored, settings), settings)
    return anomaly_table(add_combined(scored), labelled, settings.dimensions)


def anomaly_table(scored: DataFrame, labelled: DataFrame, dims) -> DataFrame:
    return join_labels(scored, labelled, dims).select("date", *dims, *MEASURES, *LABEL_COLUMNS)


# ------------------------------------------------------------- wide-table detector


def detect_wide(
    df: DataFrame,
    metric: str,
    window: int = 7,
    threshold: float = 2.0,
    series: tuple[str, ...] = ("device_type", "region", "browser"),
) -> DataFrame:
    """Detector for one metric column: full window required, strict ``>``, missing z counts as 0."""
    measures = [
        Trailing("rolling_mean", "avg", metric, -window, -1, window),
        Trailing("rolling_std", "stddev_samp", metric, -window, -1, window),
    ]
    df = add_trailing(df, list(series), measures)
    z = F.coalesce(ratio(F.col(metric) - F.col("rolling_mean"), F.col("rolling_std")), F.lit(0.0))
    return df.withColumn(f"{metric}_zscore", z).withColumn(
        f"{metric}_anomaly", F.abs(f"{metric}_zscore") > threshold
    )


def worst_wide(df: DataFrame, metric: str, segments, n: int = 10) -> DataFrame:
    """The ``n`` flagged rows with the largest absolute z-score, worst first."""
    z = f"{metric}_zscore"
    return (
        df.where(F.col(f"{metric}_anomaly"))
        .orderBy(F.desc(F.abs(z)), "date", *segments)
        .limit(n)
        .select(
            "date",
            *segments,
            half_even(z, 2).alias("z_score"),
            half_even(metric, 4).alias("actual_value"),
            half_even("rolling_mean", 4).alias("rolling_mean"),
        )
    )


