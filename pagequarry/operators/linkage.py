"""Clusters of vectors by average linkage, in rounds of reciprocal nearest neighbours."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .graph import connected_components

NEAR_SQL = "id long, other long, sim double"


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def _matrix(column, dim: int) -> np.ndarray:
    return np.asarray(pc.list_flatten(column), dtype=np.float64).reshape(-1, dim)


def _best(a: np.ndarray, ids: np.ndarray, b: np.ndarray, others: np.ndarray, least: float) -> list[tuple]:
    """(ids, others, products) for rows of two blocks, or of one with itself, each by id: what is nearest to each row of either, `least` or more.

    Single precision finds the rows that may have such a product; of these all are worked out in double precision.
    """
    same = ids[0] == others[0]
    at = np.arange(len(ids))
    if not same:  # rows that stand too far from all of the other block's, seen from its middle
        middle = _unit(b.mean(axis=0, keepdims=True))[0]
        angle = lambda m: np.arccos(np.clip(_unit(m) @ middle, -1, 1))
        at = np.flatnonzero(angle(a) <= angle(b).max() + math.acos(max(-1.0, min(1.0, least) - 1e-9)) + 1e-6)
    out, top, first = [], np.full(len(others), -np.inf), np.zeros(len(others), np.int64)
    rough, wide = b.astype(np.float32).T, 1e-6 * (b.shape[1] + 1)
    for lo in range(0, len(at), 256):
        part = at[lo : lo + 256]
        sim = a[part].astype(np.float32) @ rough
        if same:
            sim[np.arange(len(part)), part] = -np.inf
        may = part[sim.max(axis=1) >= least - wide]
        for low in range(0, len(may), 64):
            rows = may[low : low + 64]
            sim = np.round(a[rows] @ b.T, 9)
            if same:
                sim[np.arange(len(rows)), rows] = -np.inf
            best = sim.argmax(axis=1)
            value = sim[np.arange(len(rows)), best]
            hit = value >= least
            out.append((ids[rows[hit]], others[best[hit]], value[hit]))
            if not same:
                best = sim.argmax(axis=0)
                value = sim[best, np.arange(len(others))]
                more = (value >= least) & (value > top)
                top[more], first[more] = value[more], ids[rows[best[more]]]
    found = np.isfinite(top)
    return [*out, (others[found], first[found], top[found])]


def nearest_above(clusters: DataFrame, least: float, pivots: int = 0, tile: int = 8192, lanes: int = 32) -> DataFrame:
    """(id, other, sim): for each (id, mean) the other one with the greatest inner product of means, if it is `least` or more.

    Exact. Rows are ordered by the nearest of some of them, `pivots`, at most 256, and packed into blocks of up to `tile`, so
    that no row is held more than once. Each two blocks meet once, for both, as a product of two parts of at most
    `lanes` each, which ships blocks pair by pair and keeps none. Means have length 1 at most, so a product of `least` needs an
    angle of at most its arc cosine, and a row that stands that and the other block's width away from its middle is
    left out. Ties go to the smaller id.
    """
    n, dim = clusters.agg(F.count("*"), F.max(F.size("mean"))).first()
    if n < 2:
        return clusters.sparkSession.createDataFrame([], NEAR_SQL)
    chosen = clusters.orderBy(F.xxhash64("id"), "id").limit(pivots or min(256, max(1, n // 1000))).select("mean").collect()
    centres = _unit(np.array([r.mean for r in chosen], float))
    blocks = -(-n // tile)

    def place(batches):
        for batch in batches:
            cell = (_unit(_matrix(batch.column(1), dim)) @ centres.T).argmax(axis=1)
            yield pa.record_batch([batch.column(0), pa.array(cell.astype(np.int32)), batch.column(1)], ["id", "cell", "mean"])

    def packed(ids, rows):
        order = np.argsort(ids)
        return pa.record_batch([pa.array([int(ids.min())]), pa.array([ids[order].tobytes()]), pa.array([rows[order].tobytes()])], ["block", "ids", "m"])

    def pack(batches):
        ids, rows = np.zeros(0, np.int64), np.zeros((0, dim))
        for batch in batches:
            ids, rows = np.concatenate([ids, batch.column(0).to_numpy()]), np.concatenate([rows, _matrix(batch.column(1), dim)])
            while len(ids) >= tile:
                yield packed(ids[:tile], rows[:tile])
                ids, rows = ids[tile:], rows[tile:]
        if len(ids):
            yield packed(ids, rows)

    placed = clusters.select("id", "mean").mapInArrow(place, "id long, cell int, mean array<double>").repartitionByRange(blocks, "cell", "id").sortWithinPartitions("cell", "id")
    held = written(placed.select("id", "mean").mapInArrow(pack, "block long, ids binary, m binary"))
    side = lambda c: held.select(*[F.col(n).alias(f"{n}_{c}") for n in held.columns]).repartition(min(blocks, lanes))
    pairs = side("a").crossJoin(side("b")).where("block_a <= block_b").select("ids_a", "m_a", "ids_b", "m_b")

    def compare(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids, a, others, b = (np.frombuffer(c[k].as_buffer(), t) for c, t in zip(batch.columns, (np.int64, float) * 2))
                for one, two, sim in _best(a.reshape(-1, dim), ids, b.reshape(-1, dim), others, least):
                    yield pa.record_batch([pa.array(one), pa.array(two), pa.array(sim)], ["id", "other", "sim"])

    found = pairs.mapInArrow(compare, NEAR_SQL)
    return found.groupBy("id").agg(F.max(F.struct("sim", (-F.col("other")).alias("first"))).alias("b")).select("id", (-F.col("b.first")).alias("other"), "b.sim")


def average_linkage(vectors: DataFrame, least: float = 0.85, ident: str = "vec_id", vector: str = "embedding", pivots: int = 0) -> DataFrame:
    """(ident, cluster): clusters by average linkage of cosines, joined while the mean cosine across two is `least` or more.

    The mean cosine across two clusters of unit vectors is the product of their mean vectors, so a cluster is its
    mean and size, and joining two is their weighted mean: the update of all distances at once, without a table of
    pairs. Joining never brings a cluster nearer to a third than its nearer half was, so all pairs that are each
    other's nearest are joined in one round, in any order with the same result, and a cluster without a neighbour near
    enough is done. Each round is written to the shared folder. A cluster is named by its smallest id; equal
    vectors start as one. Null, empty, zero and non-finite vectors are clusters of their own.
    """
    v = F.transform(F.col(vector).cast("array<double>"), lambda x: x)
    rows = vectors.select(F.col(ident).cast("long").alias("id"), v.alias("v")).where("id is not null")
    good = (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    known = rows.where(good).withColumn("l", length).select("id", F.transform("v", lambda x: x / F.col("l")).alias("mean"))
    known = written(known)
    clusters = written(known.groupBy("mean").agg(F.min("id").alias("id"), F.count("*").alias("n")))
    joined = known.join(clusters.select("mean", F.col("id").alias("dst")), "mean").select(F.col("id").alias("src"), "dst").where("src != dst")
    open_ = clusters
    while True:
        near = written(nearest_above(open_, least, pivots))
        back = near.select(F.col("id").alias("other"), F.col("other").alias("id"))
        pairs = written(near.join(back, ["id", "other"], "left_semi").where("id < other").select("id", "other"))
        if pairs.isEmpty():
            break
        joined = joined.union(pairs.select(F.col("other").alias("src"), F.col("id").alias("dst")))
        gone = open_.join(pairs, open_.id == pairs.other).select(pairs.id.alias("into"), F.col("n").alias("m"), F.col("mean").alias("more"))
        left = open_.join(near.select("id"), "id", "left_semi").join(pairs.select(F.col("other").alias("id")), "id", "left_anti")
        both = left.join(gone, F.col("id") == F.col("into"), "left")
        mean = F.when(F.col("m").isNull(), F.col("mean")).otherwise(F.zip_with("mean", "more", lambda a, b: (a * F.col("n") + b * F.col("m")) / (F.col("n") + F.col("m"))))
        grown = both.withColumn("new", mean).withColumn("size", F.col("n") + F.coalesce("m", F.lit(0)))  # apart, as a lambda would read an n made beside it
        open_ = written(grown.select("id", F.col("size").alias("n"), F.col("new").alias("mean")))
    found = connected_components(joined)
    return rows.select("id").join(found, F.col("id") == F.col("node"), "left").select(F.col("id").alias(ident), F.coalesce("component", "id").alias("cluster"))
