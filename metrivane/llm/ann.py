"""Approximate nearest neighbours: a robust-pruned directed graph per shard, searched with a beam.

Equal vectors are one node.  Nodes are dealt to shards of bounded size; a task builds a shard's graph: greedy
searches over the graph so far propose neighbours, and pruning with a relaxed distance keeps near and diverse
ones.  Every query is searched in every shard, in blocks; the best of all shards are merged.

The largest inner product is the smallest distance once every vector has one more component that
brings all of them to the same norm.  Shards hold vectors of about one norm (a factor of two) in a scale of their own, so that
this component is never much longer than a vector and 32 bits tell neighbours apart whatever the norms of the table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metrivane.llm.common import ship, stored, table

SHARD = 8192  # nodes of a shard, about
DEGREE = 40
BUILD = 72  # beam while building
BEAM = 192  # beam of a query
RELAX = 1.2
BLOCK = 20_000  # queries that a task searches in a shard
STEP = 256
K = 20
INDEX = "dim int, shard long, node long, vector array<double>, ids array<long>, edges array<int>"
SHIFT = 0.3  # of the bands of norms, so that unit vectors do not lie on an edge
EVEN = 2.0 ** (2 * (1 - SHIFT)) * 1.0001  # square of the norm, in a band's scale, to which vectors are brought


def beam_search(graph: np.ndarray, data: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int, norms: np.ndarray | None = None):
    """(nodes, distances) of the ``width`` nearest nodes met from ``entry`` for each query, nearest first.

    ``norms`` are the squares of the nodes' norms; with zeros the nearest are those of the largest inner product.

    All queries go one step at a time: each expands the nearest node of its beam that it has not expanded."""
    q, n = len(queries), len(data)
    norms = (data * data).sum(1) if norms is None else norms
    seen = np.zeros((q, n + 1), bool)  # the last column takes what is no new node
    nodes = np.full((q, width), -1, np.int64)
    dist = np.full((q, width), np.inf, np.float32)
    done = np.ones((q, width), bool)
    m = min(len(entry), width)
    nodes[:, :m] = entry[:m]
    dist[:, :m] = norms[entry[:m]] - 2 * queries @ data[entry[:m]].T
    done[:, :m] = False
    seen[:, entry[:m]] = True
    active = np.arange(q)
    while len(active):
        open_ = np.where(done[active], np.inf, dist[active])
        best = open_.argmin(1)
        going = np.isfinite(open_[np.arange(len(active)), best])
        active, best = active[going], best[going]
        if not len(active):
            break
        done[active, best] = True
        near = graph[nodes[active, best]]
        known = (near < 0) | seen[active[:, None], np.maximum(near, 0)]
        seen[active[:, None], np.where(known, n, near)] = True
        near = np.where(known, 0, near)
        d = norms[near] - 2 * np.einsum("qrd,qd->qr", data[near], queries[active], optimize=True)
        d[known] = np.inf
        all_d = np.concatenate([dist[active], d], 1)
        all_n = np.concatenate([nodes[active], near], 1)
        all_x = np.concatenate([done[active], known], 1)
        keep = np.argpartition(all_d, width - 1, axis=1)[:, :width]
        dist[active] = np.take_along_axis(all_d, keep, 1)
        nodes[active] = np.where(np.isfinite(dist[active]), np.take_along_axis(all_n, keep, 1), -1)
        done[active] = np.take_along_axis(all_x, keep, 1) | (nodes[active] < 0)
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(dist, order, 1)


def robust_prune(data: np.ndarray, own: np.ndarray, pool: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Out-edges of the nodes ``own`` from the candidates ``pool`` (-1: none), -1 where there are fewer.

    The nearest candidate left is kept, and those go that it is nearer to, by the factor ``relax``, than the node is."""
    b, c = pool.shape
    safe = np.maximum(pool, 0)
    vectors = data[safe]
    to_own = ((vectors - data[own][:, None, :]) ** 2).sum(2)
    order = np.argsort(np.where(pool == own[:, None], np.inf, to_own), axis=1)
    pool, safe, to_own = (np.take_along_axis(x, order, 1) for x in (pool, safe, to_own))
    vectors = data[safe]
    square = (vectors * vectors).sum(2)
    between = square[:, :, None] + square[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
    alive = (pool >= 0) & (pool != own[:, None])
    alive[:, 1:] &= ~((pool[:, 1:] == pool[:, :-1]) & alive[:, :-1])
    out = np.full((b, degree), -1, np.int32)
    rows = np.arange(b)
    for r in range(degree):
        first = alive.argmax(1)
        has = alive[rows, first]
        if not has.any():
            break
        out[has, r] = pool[rows[has], first[has]]
        alive &= ~(relax * relax * between[rows, first] <= to_own) | ~has[:, None]
        alive[rows, first] = False
    return out


def build_graph(data: np.ndarray, degree: int = DEGREE, width: int = BUILD, relax: float = RELAX) -> tuple[np.ndarray, np.ndarray]:
    """(edges, entry): the graph over ``data`` as a table of out-edges, and the node where searches begin."""
    n = len(data)
    rng = np.random.default_rng(7)
    graph = np.full((n, degree), -1, np.int32)
    entry = np.array([int(((data - data.mean(0)) ** 2).sum(1).argmin())])
    if n <= degree + 1:
        for i in range(n):
            others = np.delete(np.arange(n), i)
            graph[i, : n - 1] = others
        return graph, entry
    start = np.sort(rng.integers(0, n, (n, degree // 2)), 1)
    start[:, 1:][start[:, 1:] == start[:, :-1]] = -1  # an edge list names a node once
    graph[:, : degree // 2] = start
    for own in np.array_split(rng.permutation(n), math.ceil(n / STEP)):
        met, _ = beam_search(graph, data, data[own], entry, width)
        graph[own] = robust_prune(data, own, np.concatenate([met, graph[own]], 1), degree, relax)
        to, back = graph[own].ravel(), np.repeat(own, degree)
        new = (to >= 0) & ~(graph[to] == back[:, None]).any(1)
        back, to = back[new], to[new]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        targets, begin, count = np.unique(to, return_index=True, return_counts=True)
        free = (graph[targets] < 0).sum(1)
        fits = count <= free
        full, pools = [], []
        for t, i, c, fit in zip(targets.tolist(), begin.tolist(), count.tolist(), fits.tolist()):
            if fit:
                graph[t, np.flatnonzero(graph[t] < 0)[:c]] = back[i : i + c]
            else:
                full.append(t)
                pools.append(back[i : i + c])
        if full:
            pool = np.full((len(full), degree + max(map(len, pools))), -1, np.int64)
            pool[:, :degree] = graph[full]
            for j, p in enumerate(pools):
                pool[j, degree : degree + len(p)] = p
            for part in np.array_split(np.arange(len(full)), math.ceil(len(full) / STEP)):
                own_t = np.array(full)[part]
                graph[own_t] = robust_prune(data, own_t, pool[part], degree, relax)
    return graph, entry


def matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


def band_scaled(vectors: np.ndarray, shard: int) -> np.ndarray:
    """Vectors in the scale of their shard's band, which is in the upper bits of its number."""
    return np.ldexp(vectors, -(shard >> 32))


def build_shard(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("node")
    scaled = band_scaled(matrix(rows.column("vector"), np.float64), rows.column("shard")[0].as_py())
    tail = np.sqrt(np.maximum(EVEN - (scaled * scaled).sum(1), 0.0))
    data = np.concatenate([scaled, tail[:, None]], 1).astype(np.float32)
    graph, entry = build_graph(data)
    order = np.arange(len(data))  # the entry is named by its place: the first edge list ends with it
    edges = np.concatenate([graph, np.full((len(data), 1), entry[0], np.int32)], 1)
    column = pa.ListArray.from_arrays(np.arange(len(order) + 1, dtype=np.int32) * edges.shape[1], edges.ravel())
    return rows.append_column("edges", column)


def search_shard(k: int):
    def run(shard: pa.Table, asked: pa.Table) -> pa.Table:
        schema = pa.schema([("query", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])
        if not len(shard) or not len(asked):
            return schema.empty_table()
        shard = shard.sort_by("node")
        exact = matrix(shard.column("vector"), np.float64)
        data = band_scaled(exact, shard.column("shard")[0].as_py()).astype(np.float32)
        edges = matrix(shard.column("edges"), np.int32)
        graph, entry = edges[:, :-1], edges[:1, -1]
        queries, ids = matrix(asked.column("vector"), np.float64), asked.column("query").to_numpy()
        out_q, out_s, out_n = [], [], []
        for part in np.array_split(np.arange(len(ids)), math.ceil(len(ids) / STEP)):
            # a query's own scale and the component that evens out the norms, 0 in a query, do not change its order
            wanted = (queries[part] / np.abs(queries[part]).max(1, keepdims=True)).astype(np.float32)
            found, _ = beam_search(graph, data, wanted, entry, min(BEAM, max(len(data), 1)), np.zeros(len(data), np.float32))
            scores = np.einsum("qnd,qd->qn", exact[np.maximum(found, 0)], queries[part])
            top = np.argsort(np.where(found < 0, np.inf, -scores), axis=1, kind="stable")[:, : k + 1]
            value = np.take_along_axis(scores, top, 1)
            good = np.take_along_axis(found, top, 1) >= 0
            out_q.append(np.repeat(ids[part], good.sum(1)))
            out_s.append(value[good])
            out_n.append(np.take_along_axis(found, top, 1)[good])
        members = shard.column("ids").combine_chunks().take(pa.array(np.concatenate(out_n)))
        return pa.table([pa.array(np.concatenate(out_q)), pa.array(np.concatenate(out_s)), members], schema=schema)

    return run


def usable(vectors: DataFrame) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter("vec_id is not null and vector is not null").filter(fine & F.exists("vector", lambda x: x != 0))


def build_index(rows: DataFrame, k: int = K) -> DataFrame:
    """The stored graphs of all rows: dim, shard, node, vector, ids, edges.

    A node is a distinct vector; ids are its k + 1 smallest, since equal scores go by id and a query
    may be one of them.  The limit is applied within map tasks first, so a vector that a third of all rows share is no
    hot group.  The upper bits of shard name the band of norms, a power of two."""
    ship(rows.sparkSession)
    first = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k + 1)
    nodes = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    peak = F.array_max(F.transform("vector", F.abs))
    square = F.aggregate(F.transform("vector", lambda x: F.pow(x / F.col("peak"), 2)), F.lit(0.0), lambda a, x: a + x)
    nodes = nodes.withColumn("peak", peak).withColumn("band", F.floor(F.log2("peak") + F.log2(square) / 2 + SHIFT))
    nodes = nodes.select("vector", "ids", F.col("ids")[0].alias("node"), F.size("vector").alias("dim"), "band")
    nodes = stored(nodes, "ann-nodes")
    # a band is a power of two, so there are some two thousand at most
    sizes = nodes.groupBy("band").agg(F.ceil(F.count("*") / SHARD).alias("shards"))
    dealt = nodes.join(F.broadcast(sizes), "band").select(
        "dim", (F.shiftleft("band", 32) + F.pmod(F.xxhash64("vector"), F.col("shards"))).alias("shard"), "node", "vector", "ids"
    )
    return stored(dealt.groupBy("dim", "shard").applyInArrow(build_shard, INDEX), "ann-index")


def search(index: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query, vec_id, score, place: for each distinct query vector (query, vector) its k + 1 nearest rows."""
    blocks = max(1, math.ceil(queries.count() / BLOCK))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")
    shards = index.select(F.col("dim").alias("q_dim"), F.col("shard").alias("q_shard")).distinct()
    asked = queries.select("query", "vector", F.size("vector").alias("q_dim"), block.alias("q_block")).join(shards, "q_dim")
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    found = spread.groupBy(*keys).cogroup(asked.groupBy("q_dim", "q_shard", "q_block")).applyInArrow(search_shard(k), "query long, score double, ids array<long>")
    each = found.select("query", "score", F.explode("ids").alias("vec_id"))
    by = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= k + 1)


def neighbours(vectors: DataFrame, every: int = 20, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of all other rows, for each row with vec_id divisible by ``every``.

    Nearness is the inner product in double precision on the vectors as given; equal ones by vec_id.  Vectors
    that are null, empty, zero or hold null or non-finite components take no part, nor do rows without a vec_id.
    Vectors of different lengths are never compared.  Repeated rows of one vec_id are one candidate and
    one query each; other columns play no part; an empty table gives no rows.
    """
    rows = stored(usable(vectors).distinct(), "ann-rows")
    index = build_index(rows, k)
    asked = rows.filter(F.col("vec_id") % every == 0)
    classes = stored(asked.groupBy("vector").agg(F.min("vec_id").alias("query")), "ann-queries")
    found = search(index, classes, k)
    own = asked.join(classes, "vector").select(F.col("vec_id").alias("query_id"), "query")
    all_ = own.join(found, "query").filter("vec_id != query_id")
    by = Window.partitionBy("query_id").orderBy("place")
    ranked = all_.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2_neighbours(spark, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"))
