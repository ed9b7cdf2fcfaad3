"""Continuous arrival of the same payloads: new files are flattened and appended by
date, then the bounded lookback is scored again.

Trailing windows count rows, which streams do not support, so each micro-batch
triggers the ordinary batch run over the last days only; its cost does not grow
with the age of the feed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from metrivane.plans.reports import lookback
from metrivane.sources.scans import PAYLOAD_SCHEMA, flatten_payloads


def payload_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed payload files as a stream of panel rows."""
    reader = spark.readStream.schema(PAYLOAD_SCHEMA).option("multiLine", True).option(
        "columnNameOfCorruptRecord", "_corrupt"
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return flatten_payloads(reader.json(path))


def start_feed(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    lookback_days: int,
    on_window: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Append new rows to ``store`` (one folder per batch, replaced if a batch is retried) and
    hand the current lookback to ``on_window``.

    A (date, series) row that arrives again replaces the older one when it is read.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store}/epoch={epoch}")
        if on_window is not None:
            on_window(current_window(spark, store, lookback_days), epoch)

    return (
        payload_stream(spark, landing)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_window(spark: SparkSession, store: str, lookback_days: int) -> DataFrame:
    """The last ``lookback_days`` days of the store, the newest row per (date, series)."""
    rows = spark.read.option("basePath", store).parquet(store)
    last = rows.agg(F.max("date")).first()[0]
    key = ["date", "kpi_name", "project", "access", "agent"]
    newest = lookback(rows, last, lookback_days).groupBy(*key).agg(F.max_by("kpi_value", "epoch").alias("kpi_value"))
    return newest
