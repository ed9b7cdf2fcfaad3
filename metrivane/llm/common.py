"""What the text operators share: shared folders, staged tables, lower-casing, column checks."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metrivane.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share (spark.checkpoint.dir)."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to shared storage and read again.

    Cuts the lineage: what comes later does not start again from the source when an executor
    is lost, and reads only the columns it needs.
    """
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else.

    ``lower`` does no more than that in a text of ASCII alone, and works on its bytes; ``translate`` makes a string of every character.
    """
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark context: Python tasks import from it."""
    sc = spark.sparkContext
    if getattr(sc, "_metrivane_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="metrivane-code-")) / "metrivane_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    sc.addPyFile(str(archive))  # served to the executors by the driver
    sc._metrivane_shipped = True


def text_slices(texts: pa.Array, limit: int = 2 << 20):
    """(first row, list of bytes) for consecutive slices of about ``limit`` bytes; a null is empty."""
    first, rows, size = 0, [], 0
    for i, value in enumerate(texts.cast(pa.large_binary())):
        data = value.as_buffer() if value.is_valid else None
        rows.append(data.to_pybytes() if data is not None else b"")
        size += len(rows[-1])
        if size >= limit:
            yield first, rows
            first, rows, size = i + 1, [], 0
    if rows:
        yield first, rows
