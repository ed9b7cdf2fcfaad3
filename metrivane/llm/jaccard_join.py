"""N-gram Jaccard self-join by grouped prefixes.

1. Shingles are counted over all documents.  Map tasks send the hashes of a chunk of documents to
   the owners of hash ranges as packed arrays; the owners send back one byte each: how frequent it is.
2. In every set shingles are ordered from rare to frequent.  Two sets that are similar enough have a shingle
   in common within their prefixes.  Shingles of one document only cannot be that one and are not kept.
3. Documents with identical sets are one node.  Nodes with identical prefix and size are one group.  Groups
   that share a prefix shingle are paired if sizes and places in the prefix allow the overlap that is needed.
4. Every group is paired with one centre per shingle first, and the members are verified.  Only pairs that the
   links found so far leave in different components are then verified as well, so a thousand near copies do not
   make a million pairs, while no link between components is lost.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrivane.llm.common import ship, stored, table
from metrivane.llm.components import components
from metrivane.llm.shingles import column_sets

CHUNK = 12 << 20  # characters of text in a chunk, about
BLOCK = 1 << 20  # shingles that the owner of a hash range gets, about
SETS = "doc_id long, n long, fp binary, grp binary, share double, tokens array<long>, places array<int>, hashes binary"
SETS_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("fp", pa.binary()), ("grp", pa.binary()), ("share", pa.float64()),
     ("tokens", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())), ("hashes", pa.binary())]
)


def count_chunk(k: int, bits: int):
    """A chunk's shingle counts, cut by hash range: chunk, block, keys (32 bits of the hash below the block's)."""

    def run(chunk: pa.Table) -> pa.Table:
        sets = [s for c in chunk.column("text").chunks for s in column_sets(c, k)]
        keys, counts = np.unique(np.concatenate(sets or [np.zeros(0, np.uint64)]), return_counts=True)
        blocks, lows = keys >> np.uint64(64 - bits), ((keys >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype("<u4")
        counts = np.minimum(counts, 65535).astype("<u2")
        edges = np.searchsorted(blocks, np.arange((1 << bits) + 1, dtype=np.uint64))
        rows = [(b, lows[i:j].tobytes(), counts[i:j].tobytes()) for b, (i, j) in enumerate(zip(edges, edges[1:])) if j > i]
        number = chunk.column("chunk")[0].as_py()
        return pa.table(
            {"chunk": pa.array([number] * len(rows), pa.int64()), "block": pa.array([r[0] for r in rows], pa.int64()),
             "keys": pa.array([r[1] for r in rows], pa.binary()), "counts": pa.array([r[2] for r in rows], pa.binary())}
        )

    return run


def rate_block(block: pa.Table) -> pa.Table:
    """For each chunk the frequency class of each of its keys: 0 in one document, growing with the logarithm."""
    keys = [np.frombuffer(x.as_py(), "<u4") for x in block.column("keys")]
    counts = np.concatenate([np.frombuffer(x.as_py(), "<u2") for x in block.column("counts")]).astype(np.int64)
    _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, weights=counts)
    classes = np.minimum(np.floor(8 * np.log2(total)), 255).astype(np.uint8)[inverse]
    cuts = np.cumsum([len(x) for x in keys])[:-1]
    return pa.table(
        {"chunk": block.column("chunk"), "block": block.column("block"),
         "classes": pa.array([x.tobytes() for x in np.split(classes, cuts)], pa.binary())}
    )


def order_chunk(k: int, num: int, den: int):
    """The sets of a chunk with their prefixes, from the texts and the frequency classes of the chunk's shingles."""

    def run(chunk: pa.Table, rated: pa.Table) -> pa.Table:
        sets = [s for c in chunk.column("text").chunks for s in column_sets(c, k)]
        order = np.argsort(rated.column("block").to_numpy())
        payloads = rated.column("classes").to_pylist()
        classes = np.frombuffer(b"".join(payloads[i] for i in order), np.uint8)
        keys = np.unique(np.concatenate(sets or [np.zeros(0, np.uint64)]))
        ids = [x for c in chunk.column("doc_id").chunks for x in c.to_pylist()]
        rows = []
        for doc, s in zip(ids, sets):
            n = len(s)
            if not n:
                rows.append((doc, 0, None, None, None, None, None, None))
                continue
            own = classes[np.searchsorted(keys, s)]
            size = n - -(-num * n // den) + 1
            prefix = np.argsort(own, kind="stable")[:size]  # the sets are sorted by hash, so ties are too
            fp = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
            shared = np.flatnonzero(own[prefix] > 0)
            if not len(shared):  # then it is similar to no other set, unless to an equal one
                rows.append((doc, n, fp, None, None, None, None, None))
                continue
            grp = hashlib.blake2b(s[prefix].tobytes(), digest_size=16, person=n.to_bytes(8, "little")).digest()
            tokens = s[prefix[shared]].view(np.int64)
            rows.append((doc, n, fp, grp, len(shared) / size, tokens, shared.astype(np.int32), s.astype("<u8").tobytes()))
        return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SETS_ARROW)], schema=SETS_ARROW)

    return run


def shingle_table(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, n, fp, grp, share, tokens, places, hashes of every row of ``docs``; see order_chunk."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(chars / CHUNK))
    bits = min(31, max(5, math.ceil(math.log2(max(chars / 6 / BLOCK, 1)))))
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))
    spread = rows.withColumn("chunk", number).repartition(chunks, "chunk")  # read by both branches, shuffled once
    counted = spread.groupBy("chunk").applyInArrow(count_chunk(k, bits), "chunk long, block long, keys binary, counts binary")
    rated = counted.groupBy("block").applyInArrow(rate_block, "chunk long, block long, classes binary")
    sets = spread.groupBy("chunk").cogroup(rated.groupBy("chunk")).applyInArrow(order_chunk(k, num, den), SETS)
    return stored(sets, "shingle-sets")


def needed(num: int, den: int, n: Column, m: Column) -> Column:
    """The least overlap of two similar sets of these sizes, from den overlap >= num (n + m - overlap)."""
    return F.ceil((n + m) * num / F.lit(float(num + den)) - 1e-9)


def possible(num: int, den: int) -> Column:
    """Whether groups x and y that share a shingle can be similar: by their sizes, and by what can follow in
    their order if it is the first that they share."""
    room = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    sizes = F.least("x.n", "y.n") * den >= F.greatest("x.n", "y.n") * num
    return sizes & (room >= needed(num, den, F.col("x.n"), F.col("y.n")))


def verify(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar, compared as whole sets.

    A pair is a row; it carries the set of ``a`` to where the set of ``b`` is joined.  Hot nodes are split by
    adaptive execution in both joins.
    """

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = np.sort(np.concatenate([p, q]))
                same = int((both[1:] == both[:-1]).sum())
                keep.append(den * same >= num * (len(p) + len(q) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = pairs.join(nodes.select(F.col("fp").alias("a"), F.col("hashes").alias("x")), "a")
    both = first.join(nodes.select(F.col("fp").alias("b"), F.col("hashes").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def links(sets: DataFrame, num: int, den: int) -> DataFrame:
    """node, root: the components of the nodes (fp) that similar sets link; nodes without a link are left out."""
    shared = sets.filter("grp is not null")
    nodes = stored(shared.dropDuplicates(["fp"]), "nodes")
    index = nodes.dropDuplicates(["grp"]).select("grp", "n", "share", F.arrays_zip("tokens", "places").alias("z"))
    index = index.select("grp", "n", "share", F.explode("z").alias("z")).select("grp", "n", "share", F.col("z.tokens").alias("token"), F.col("z.places").alias("place"))
    best = index.groupBy("token").agg(F.max(F.struct("share", "grp", "n", "place")).alias("c"), F.count(F.lit(1)).alias("k"))
    index = stored(index, "prefix-index")
    # the centre of a shingle: the group with the fewest shingles of its own in its prefix
    centres = best.filter("k > 1").select("token", F.col("c.grp").alias("grp"), F.col("c.n").alias("n"), F.col("c.place").alias("place"))
    grouped = index.alias("x").join(centres.alias("y"), "token").filter(F.col("x.grp") != F.col("y.grp")).filter(possible(num, den))
    grouped = grouped.select(F.col("x.grp").alias("grp"), F.col("y.grp").alias("centre")).distinct()
    heads = nodes.groupBy("grp").agg(F.min("fp").alias("head"))
    members = nodes.select("grp", "fp")
    outer = grouped.join(members, "grp").join(heads.select(F.col("grp").alias("centre"), "head"), "centre")
    inner = members.join(heads, "grp").filter("fp != head")
    tried = outer.select("fp", "head").unionByName(inner.select("fp", "head"))
    tried = stored(tried.select(F.least("fp", "head").alias("a"), F.greatest("fp", "head").alias("b")).distinct(), "star-pairs")
    edges = stored(verify(tried, nodes, num, den), "star-links")
    found = stored(components(edges), "star-components")
    # what is left: pairs of different components with a shingle in common, but for those tried
    placed = members.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("grp", "fp", F.coalesce("root", "fp").alias("root"))
    posts = index.select("grp", "n", "token", "place").join(placed, "grp")
    inside = nodes.groupBy("grp").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("grp")
    same = nodes.join(inside, "grp").select("grp", "n", F.xxhash64("grp").alias("token"), F.lit(0).alias("place"), "fp")
    same = same.join(placed.select("fp", "root"), "fp").select("grp", "n", "token", "place", "fp", "root")
    posts = stored(posts.select(*same.columns).unionByName(same), "postings")
    by_root = posts.groupBy("token", "root").agg(F.count(F.lit(1)).alias("k"))
    main = by_root.groupBy("token").agg(F.max(F.struct("k", "root")).alias("top"), F.count(F.lit(1)).alias("roots"))
    mixed = main.filter("roots > 1").select("token", F.col("top.root").alias("main"))
    posts = stored(posts.join(mixed, "token"), "mixed-postings")
    few = posts.filter("root != main")
    rest = few.alias("x").join(posts.alias("y"), "token").filter(F.col("x.root") != F.col("y.root")).filter(possible(num, den))
    rest = rest.select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b")).distinct()
    rest = stored(rest.join(tried, ["a", "b"], "left_anti"), "rest-pairs")
    return components(edges.unionByName(verify(rest, nodes, num, den)))


def similar_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Two documents link when den |intersection| >= num |union| of their sets of ``k``-word shingles (shingles.py).
    component_id is the smallest doc_id that links reach, the own one included.  Null and empty texts and
    texts without words have no shingles and no links.  Repeated rows count as documents with equal sets.  A row
    without a doc_id links like any other; its component_id is null only if no linked row has an id.  Other columns
    play no part; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    sets = shingle_table(docs, k, num, den)
    roots = stored(links(sets, num, den), "roots")
    rows = sets.select("doc_id", "n", "fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rows = rows.select("doc_id", "n", F.coalesce("root", "fp").alias("root"))
    least = rows.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(least, "root", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component; all columns as they are.

    Of repeated rows with one doc_id all have it.  A row without a doc_id cannot be named as a copy and stays.
    """
    found = similar_components(docs, k, num, den)
    gone = found.filter("doc_id is not null and doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[docs[f"`{c}`"] for c in docs.columns])


def op1_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"), k=4, num=85)

