"""Exact deduplication without hot tasks: local, salted and global combining over full contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrivane.llm.common import ascii_lower, table

SALTS = 16


def text_digest(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def normalised(docs: DataFrame) -> Column:
    return ascii_lower(F.coalesce(docs["text"], F.lit("")))


def content_classes(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """digest, content, keep_id, group_size: one row per distinct content.

    ``rows`` holds doc_id, digest and content.  Every combination compares the digest and the whole
    content, so two contents under one digest stay apart.  The first grouping is combined within each
    map task before it is shuffled by (salt, digest, content); the second combines the few salt
    winners.  A content that holds a third of all rows reaches a shuffle once per task and salt.
    """
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts))
    salted = rows.groupBy(salt.alias("salt"), "digest", "content").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return salted.groupBy("digest", "content").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def classify(docs: DataFrame, digest=text_digest, salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; a null text is the empty text.
    The row with the largest doc_id of a group stays.  Repeated rows with one doc_id and equal texts
    are the same document: all are marked alike.  Rows without a doc_id count in group_size and stay
    only where no row of the group has one.  Other columns play no part; an empty table gives no rows.

    ``digest`` is a parameter so that tests can force collisions.  Rows find their class by digest,
    length and a second hash of the content; adaptive execution splits the hot digests of this join.
    """
    rows = docs.select("doc_id", normalised(docs).alias("content"))
    rows = rows.withColumn("digest", digest(F.col("content")))
    second = [F.xxhash64("content").alias("second"), F.length("content").alias("n")]
    winners = content_classes(rows, salts).select("digest", *second, "keep_id", "group_size")
    members = rows.select("doc_id", "digest", *second, text_digest(F.col("content")).alias("text_sha256"))
    return members.join(winners, ["digest", "second", "n"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    One document of each group of equal texts stays, that with the largest doc_id (see classify);
    of repeated rows with one doc_id and equal texts one stays, and of a group without ids one row.
    """
    kept = classify(docs).filter("kept").select(
        F.col("doc_id").isNull().alias("k_none"), F.coalesce("doc_id", F.lit(0)).alias("k_id"), F.col("text_sha256").alias("k_sha")
    )
    keyed = docs.select(
        F.col("doc_id").isNull().alias("k_none"), F.coalesce("doc_id", F.lit(0)).alias("k_id"),
        text_digest(normalised(docs)).alias("k_sha"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("whole"),
    )
    # join and grouping have the same keys, so the rows are shuffled once
    hit = keyed.join(kept, ["k_none", "k_id", "k_sha"], "left_semi")
    return hit.dropDuplicates(["k_none", "k_id", "k_sha"]).select("whole.*")


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
