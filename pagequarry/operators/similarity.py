"""Cosine search of a stated query set against all rows, in blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _blocks(df: DataFrame, ident: str, vector: str, rows: int, prefix: str) -> DataFrame:
    """Rows packed into blocks of unit vectors: (ids, matrix as bytes)."""

    def pack(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                m = np.array([v if v is not None else [] for v in part.column(1).to_pylist()], float)
                m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
                yield pa.record_batch([pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([m.tobytes()], pa.binary())], [f"{prefix}_ids", f"{prefix}_m"])

    return df.select(F.col(ident).cast("long"), vector).mapInArrow(pack, f"{prefix}_ids array<long>, {prefix}_m binary")


def cosine_top_k(queries: DataFrame, rows: DataFrame, k: int, ident: str, vector: str, block: int = 1024) -> DataFrame:
    """(query_id, ident, sim, rn): the k nearest rows of each query, itself excluded, ties by id.

    Each pair of blocks is one matrix product that keeps k rows for each query, so what is shuffled is
    k rows for each query and block.
    """

    def search(batches):
        for batch in batches:
            for pair in range(batch.num_rows):  # blocks are read where they lie, and one pair's rows leave before the next
                qi, ri = (np.asarray(batch.column(c)[pair].values) for c in (0, 2))
                qm, rm = (np.frombuffer(batch.column(c)[pair].as_buffer()) for c in (1, 3))
                sim = np.round(qm.reshape(len(qi), -1) @ rm.reshape(len(ri), -1).T, 6)
                sim[qi[:, None] == ri[None]] = -np.inf
                out = ([], [], [])
                for a in range(len(qi)):
                    best = np.lexsort((ri, -sim[a]))[:k]
                    best = best[np.isfinite(sim[a][best])]
                    for column, values in zip(out, (np.full(len(best), qi[a]), ri[best], sim[a][best])):
                        column.append(values)
                flat = [np.concatenate(c) for c in out]
                yield pa.record_batch([pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int64)), pa.array(flat[2])], ["query_id", ident, "sim"])

    pairs = _blocks(queries, ident, vector, block, "q").crossJoin(_blocks(rows, ident, vector, block, "r"))
    near = pairs.select("q_ids", "q_m", "r_ids", "r_m").mapInArrow(search, f"query_id long, {ident} long, sim double")
    w = Window.partitionBy("query_id").orderBy(F.desc("sim"), ident)
    return near.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def blended_top_k(queries: DataFrame, parts: DataFrame, k: int, ident: str, page: str, title: str, vector: str, alpha: float = 0.5, block: int = 1024, groups: int = 0) -> DataFrame:
    """(query_id, page, score, rn): the k best pages for each query by alpha * title + (1 - alpha) * best chunk, ties by page.

    parts: a row for each title (true) and chunk of a page. A page without a title is none; one without chunks has -1
    for their best. Pages are dealt into groups by a hash, queries, a stated set, into blocks, and each group meets
    each block in a task of its own: all parts of a page are together, so their maximum is taken there over all
    of them, and k rows for each query leave it.
    """
    size = parts.count()
    groups = groups or max(1, -(-size // 20_000))
    asked = queries.select(F.col(ident).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("v"))
    blocks = max(1, -(-asked.count() // block))
    left = asked.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("b"), "query_id", "v")
    right = parts.select(F.pmod(F.xxhash64(F.col(page)), F.lit(groups)).cast("int").alias("g"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), F.col(page).cast("long").alias("page"), F.col(title).alias("title"), F.col(vector).cast("array<double>").alias("v"))

    def unit(column) -> np.ndarray:
        m = np.asarray(column.combine_chunks().flatten(), float).reshape(len(column), -1)
        return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)

    def best(a: pa.Table, b: pa.Table) -> pa.Table:
        out = ([], [], [])
        if a.num_rows and b.num_rows:
            names, at = np.unique(b.column("page").to_numpy(), return_inverse=True)
            heads = np.asarray(b.column("title").combine_chunks().to_numpy(zero_copy_only=False), bool)
            vectors, ids = unit(b.column("v")), a.column("query_id").to_numpy()
            for lo in range(0, len(ids), 32):
                sim = vectors @ unit(a.column("v").slice(lo, 32)).T
                own, body = np.full((len(names), sim.shape[1]), -np.inf), np.full((len(names), sim.shape[1]), -np.inf)
                np.maximum.at(own, at[heads], sim[heads])
                np.maximum.at(body, at[~heads], sim[~heads])
                score = np.round(alpha * own + (1 - alpha) * np.where(np.isinf(body), -1, body), 6)
                for q in range(sim.shape[1]):
                    top = np.lexsort((names, -score[:, q]))[:k]
                    top = top[np.isfinite(score[top, q])]
                    for column, values in zip(out, (np.full(len(top), ids[lo + q]), names[top], score[top, q])):
                        column.append(values)
        flat = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.table([pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int64)), pa.array(flat[2].astype(float))], ["query_id", "page", "score"])

    found = left.where("v is not null").groupBy("g", "b").cogroup(right.where("v is not null").groupBy("g", "b")).applyInArrow(best, "query_id long, page long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "page")
    return found.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
