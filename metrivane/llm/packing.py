"""Best-two-fit packing of token sequences.

How well pieces can be packed depends on how many there are of each length, and there are at most
``capacity`` lengths.  So the packing is planned on that histogram, and the plan, a short list of
(lengths of a bin, how many such bins), is dealt out to the pieces by their rank within their length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metrivane.llm.common import ship, stored, table, text_slices
from metrivane.llm.tokens import encoder

CAPACITY = 1024
END = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def best_two_fit(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """[(lengths of a bin, number of such bins)] that use up counts[length] pieces of each length.

    A bin begins with the longest piece left and is filled with the longest that fits, again and again.
    Then its smallest piece gives way to two unpacked ones, if some two fill the gap that it leaves more
    tightly.  A bin is repeated as long as pieces of its lengths last.
    """
    left = np.array(counts, np.int64)
    lengths = np.arange(capacity + 1)
    plan = []
    while left[1:].any():
        free = left.copy()
        bin_, gap = [], capacity
        while True:
            fitting = np.flatnonzero(free[1 : gap + 1])
            if not len(fitting):
                break
            size = int(fitting[-1]) + 1
            bin_.append(size)
            free[size] -= 1
            gap -= size
        if gap and len(bin_) > 1:
            smallest = bin_[-1]
            room = gap + smallest
            upto = np.maximum.accumulate(np.where(free[: room + 1] > 0, lengths[: room + 1], 0))  # longest free one up to each length
            firsts = np.flatnonzero(free[1:room]) + 1
            if len(firsts):
                seconds = upto[room - firsts]
                same = (seconds == firsts) & (free[firsts] < 2)
                seconds = np.where(same, upto[np.maximum(firsts - 1, 0)], seconds)
                sums = np.where(seconds > 0, firsts + seconds, 0)
                best = int(sums.argmax())
                if sums[best] > smallest:
                    bin_[-1:] = sorted((int(firsts[best]), int(seconds[best])), reverse=True)
        bin_.sort(reverse=True)
        sizes, times = np.unique(bin_, return_counts=True)
        repeat = int((left[sizes] // times).min())
        left[sizes] -= repeat * times
        plan.append((bin_, repeat))
    return plan


def slots(plan: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """The plan as rank ranges: of the pieces of a length, those from rank ``first`` on go, ``times`` to a
    bin, to the bins from ``sequence`` on, at ``offset``."""
    rows, used, sequence = [], {}, 0
    for bin_, repeat in plan:
        at = 0
        for size in dict.fromkeys(bin_):
            times = bin_.count(size)
            rows.append((size, used.get(size, 0), times, sequence, at))
            used[size] = used.get(size, 0) + times * repeat
            at += size * times
        sequence += repeat
    rows.sort()
    names = ("length", "first", "times", "sequence", "offset")
    return {n: np.array([r[i] for r in rows], np.int64) for i, n in enumerate(names)}


def placer(plan: list[tuple[list[int], int]]):
    """A vectorised function (length, rank) -> sequence_id, offset."""
    by = slots(plan)
    keys = (by["length"] << 44) + by["first"]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        i = np.searchsorted(keys, (size << 44) + rank, side="right") - 1
        within = rank - by["first"][i]
        times = by["times"][i]
        return pd.DataFrame({"sequence_id": by["sequence"][i] + within // times, "offset": by["offset"][i] + within % times * size})

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset instead of part and nth.

    ``pieces`` is a stored table with length (1 to capacity) and part, nth: the place of a row among
    those of its length within one part.  Only the counts by length, at most ``capacity`` rows, reach the driver.
    """
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    place = placer(best_two_fit(histogram, capacity))
    ranked = pieces.join(offsets, ["length", "part"])
    placed = ranked.withColumn("at", place("length", F.col("before") + F.col("nth")))
    own = [c for c in pieces.columns if c not in ("part", "nth")]
    return placed.select(*own, "at.sequence_id", "at.offset")


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids: only the first may be shorter than ``capacity``."""
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def piece_rows(path: str, ranks: str | None, capacity: int, end: int):
    def run(batches):
        encode = encoder(path, ranks).encode
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids_of = batch.column(0)
            for first, texts in text_slices(batch.column(1)):
                flat, counts = encode(texts)
                out, at = [], 0
                for i, n in enumerate(counts.tolist()):
                    ids = np.append(flat[at : at + n], np.uint32(end)).astype("<u4")
                    at += n
                    start, doc = 0, ids_of[first + i].as_py()
                    for k, size in enumerate(cut_lengths(n + 1, capacity)):
                        crc = zlib.crc32(ids[start : start + size].tobytes())
                        out.append((doc, k, start, size, crc, part, int(seen[size])))
                        seen[size] += 1
                        start += size
                columns = list(zip(*out))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                names = ("doc_id", "piece", "start", "length", "ids_crc32", "part", "nth")
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def pack_documents(docs: DataFrame, path: str, ranks: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the end id alone.  Repeated rows and null doc_ids are packed like any
    other row; other columns play no part; an empty table gives no rows.  ``ranks``: see UnitEncoder.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), docs["text"])
    return pack(stored(rows.mapInArrow(piece_rows(path, ranks, capacity, end), PIECES), "pieces"), capacity)


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return pack_documents(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))
