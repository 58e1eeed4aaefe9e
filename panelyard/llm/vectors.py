"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside cells, one representative per group.

Only vectors with equal labels and lengths are compared. Equal vectors are one node first, with their number, so copies are never
compared with each other. Each label's nodes fall into cells around centroids (k-means with unit centroids, fitted on a
bounded sample: at most SAMPLE nodes a label, the ones with the smallest hashes; every node is then assigned, in batches that
meet their label's centroids once). A node is compared in its own cell, and visits each other cell that a node linked
to it may live in: by the bisecting plane of the two centroids, x can have a link beyond it only if
(x.c_own - x.c_other) / |c_own - c_other| <= sin(arccos(SIMILARITY)). So no link is lost to a cell's border, each
link is counted once from either side, and where the data has clusters few nodes visit.

Natives and visitors of a cell meet in blocks of at most BLOCK x BLOCK, each a group of its own, so a hot cell is many
small tasks. A block gives counts and a spanning forest of its links, never its pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing, as do those with
a null label or a null id. Equal vectors are linked like any others. A repeated id is several vectors: each row counts the other rows
that it is linked with. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import components, forget, table, written

SIMILARITY = 0.93
CELL = 1024
BLOCK = 1024
SAMPLE = 8192
ROUNDS = 8
#: Nodes that are assigned to cells in one group.
ASSIGN = 4096
#: Added to the plane test, far above rounding errors of double products.
SLACK = 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in two steps so that tiny and huge ones neither vanish nor overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k unit centroids of unit rows x; starts from evenly spaced rows, an empty cell takes the row that fits worst."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = x @ c.T
        own = near.argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1)
        empty = np.flatnonzero(size < 1e-12)
        sums[empty] = x[np.argsort(near.max(1))[: len(empty)]]
        c = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return c


def visits(own: np.ndarray, x: np.ndarray, c: np.ndarray, reach: float) -> np.ndarray:
    """Which rows of x (columns: cells) visit which cell, their own included."""
    near = x @ c.T
    out = np.zeros(near.shape, bool)
    for k in np.unique(own):
        rows = np.flatnonzero(own == k)
        gap = np.linalg.norm(c[k] - c, axis=1)
        out[rows] = near[rows, k][:, None] - near[rows] <= reach * gap + SLACK
    out[np.arange(len(x)), own] = True
    return out


def _forest(linked: np.ndarray) -> np.ndarray:
    """Root (smallest index) of each node of a dense symmetric link matrix."""
    root = np.arange(len(linked))
    while True:
        low = np.where(linked, root[None, :], len(linked)).min(1)
        new = np.minimum(root, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _rows(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return np.array(column.combine_chunks().flatten()).reshape(n, -1)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))


def _fit(t: pa.Table) -> pa.Table:
    """Centroids of one label's sample."""
    order = np.lexsort((t["node"].to_numpy(), t["h"].to_numpy()))
    x = unit(_rows(t["v"], len(t)))[order]
    k = min(t["cells"][0].as_py(), len(x))
    c = spherical_kmeans(x, k) if k > 1 else x[:1]
    return pa.table({"g": pa.array([t["g"][0].as_py()], pa.int64()), "centroids": pa.array([c.reshape(-1).tolist()], pa.list_(pa.float64()))})


_PLACED = "g bigint, node bigint, m bigint, own int, cells array<int>, u array<double>"


def _assigner(reach: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Nodes of one batch, and their label's centroids in one row -> own cell, visited cells, unit vector."""

    def assign(t: pa.Table, centroids: pa.Table) -> pa.Table:
        n = len(t)
        x = unit(_rows(t["v"], n)) if n else np.zeros((0, 1))
        c = _rows(centroids["centroids"], 1).reshape(-1, x.shape[1])
        own = (x @ c.T).argmax(1) if n else np.zeros(0, np.int64)
        seen = visits(own, x, c, reach)
        ends = np.concatenate([[0], np.cumsum(seen.sum(1))]).astype(np.int32)
        cells = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(seen)[1].astype(np.int32)))
        return pa.table({"g": t["g"], "node": t["node"], "m": t["m"], "own": pa.array(own.astype(np.int32)), "cells": cells, "u": _lists(x)})

    return assign


def _comparer(similarity: float) -> Callable[[pa.Table], pa.Table]:
    """A block's visitors and natives -> the visitors' counts of linked vectors, and the block's components."""

    def compare(t: pa.Table) -> pa.Table:
        native = t["native"].to_numpy()
        x = _rows(t["u"], len(t))
        ids, m = t["node"].to_numpy(), t["m"].to_numpy()
        a, b = np.flatnonzero(~native), np.flatnonzero(native)
        nodes, counts, root = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(a) and len(b):
            near = x[a] @ x[b].T >= similarity
            near &= ids[a][:, None] != ids[b][None, :]
            hit, met = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            if len(hit):
                nodes, at = np.unique(np.concatenate([ids[a[hit]], ids[b[met]]]), return_inverse=True)
                linked = np.zeros((len(nodes), len(nodes)), bool)
                r, c = np.nonzero(near[np.ix_(hit, met)])
                linked[at[r], at[len(hit) + c]] = True
                root = nodes[_forest(linked | linked.T)]
                # counts go with the visiting side only
                counts = np.zeros(len(nodes), np.int64)
                counts[at[: len(hit)]] = near[hit] @ m[b]
        return pa.table({"node": pa.array(nodes), "n": pa.array(counts), "root": pa.array(root)})

    return compare


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", similarity: float = SIMILARITY) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of vectors."""
    reach = float(np.sqrt(max(0.0, 1 - similarity * similarity)))
    raw = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"), F.col(label).alias("label"))
    finite = "forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(v, x -> x <> 0)"
    fine = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & F.expr(finite), F.lit(False))
    # equal vectors by two 64-bit hashes; one number per label and length
    keyed = raw.where(fine).select("vec_id", "v", F.xxhash64("label", F.size("v")).alias("g"), F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(7), "v").alias("k2"))
    nodes = keyed.groupBy("g", "k1", "k2").agg(F.min("vec_id").alias("low"), F.count("*").alias("m"), F.first("v").alias("v"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    groups = nodes.groupBy("g").agg(F.count("*").alias("n"))
    groups = written(groups.select("g", "n", F.ceil(F.col("n") / CELL).alias("cells"), F.ceil(F.col("n") / ASSIGN).alias("batches")), "groups")
    # the sample: about SAMPLE a label by hash, then exactly the smallest hashes
    drawn = nodes.join(groups, "g").withColumn("h", F.xxhash64("k1", "k2")).where(F.expr(f"n <= {SAMPLE} OR pmod(h, n) < {2 * SAMPLE}"))
    drawn = drawn.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("h", "low"))).where(f"r <= {SAMPLE}").select("g", "cells", "h", F.col("low").alias("node"), "v")
    centroids = written(drawn.groupBy("g").applyInArrow(_fit, "g bigint, centroids array<double>"), "centroids")

    batch = F.pmod(F.xxhash64("node", F.lit(5)), "batches").alias("b")
    left = nodes.join(groups.select("g", "batches"), "g").select("g", batch, "node", "m", "v")
    right = centroids.join(groups, "g").select("g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("batches") - 1)).alias("b"), "centroids")
    placed = written(left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInArrow(_assigner(reach), _PLACED), "placed")
    each = placed.select("g", "node", "m", "own", F.explode("cells").alias("cell"), "u")
    sizes = each.groupBy("g", "cell").agg(F.ceil(F.count_if(F.col("cell") == F.col("own")) / BLOCK).cast("int").alias("nb"), F.ceil(F.count("*") / BLOCK).cast("int").alias("vb"))
    dealt = each.join(written(sizes.where("nb > 0"), "cells"), ["g", "cell"]).withColumn("h", F.xxhash64("node"))
    # each native is in one row of blocks, each node of the cell in one column of blocks
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    natives = dealt.where("cell = own").select("g", "cell", F.pmod("h", "nb").cast("int").alias("i"), every("vb").alias("j"), F.lit(True).alias("native"), "node", "m", "u")
    comers = dealt.select("g", "cell", every("nb").alias("i"), F.pmod("h", "vb").cast("int").alias("j"), F.lit(False).alias("native"), "node", "m", "u")
    found = natives.unionByName(comers).groupBy("g", "cell", "i", "j").applyInArrow(_comparer(similarity), "node bigint, n bigint, root bigint")
    found = written(found, "links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    every_node = nodes.select("g", "k1", "k2", "node", "low", "m").join(counts, "node", "left").join(roots, "node", "left")
    every_node = written(every_node.select("g", "k1", "k2", "low", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root")), "rooted")
    named = every_node.groupBy("root").agg(F.min("low").alias("component_id"))
    known = written(every_node.join(named, "root").select("g", "k1", "k2", "n_links", "component_id"), "known")
    forget(groups, centroids, placed, found, every_node)
    linked = keyed.select("vec_id", "g", "k1", "k2").join(known, ["g", "k1", "k2"]).select("vec_id", F.col("n_links").cast("bigint").alias("n_links"), "component_id")
    alone = raw.where(~fine).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT a AS x, a AS y FROM l UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a),
c AS (SELECT x, min(y) AS root FROM r GROUP BY x), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.root, e.vec_id)::BIGINT AS component_id, coalesce(c.root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.x = e.vec_id
"""
