"""Mixing sources to target weights by pivotal rounding.

A source's target over its size is how many copies of each of its documents the mix should hold. Whole
copies are certain; the fractional rest is rounded by pivotal steps. Two documents with fractional
probabilities move words from one to the other at random until one of them is integral, in such a way that
the expected copies of each and the sum of words stay what they were; the one that stays fractional meets
the next, in descending order of size. What is left of a bucket is one document that is still fractional.
These are combined in a tree of buckets, 64 to a node, until one is left for each source; it is rounded
at random. So a source misses its target by less than that one document.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

FAN_IN = 64
ROWS = "doc_id long, source string, size long, bucket long, copies long, p double"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("size", pa.int64()), ("bucket", pa.int64()), ("copies", pa.int64()), ("p", pa.float64())])


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size): the number of words of each text."""

    def each(batches):
        for batch in batches:
            n = [len(t.split()) if t else 0 for t in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "source", "size"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).alias("text")).mapInArrow(each, "doc_id long, source string, size long")


def targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, n, source_size, target), one row for each source.

    Weights repeat over the sources in ascending order of code points, null last. The sources share `share`
    times all sizes by weight; none gets over `most` times its size, and what exceeds that goes to the
    others by weight. The windows run over one row per source.
    """
    per = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    # in ascending order of cap over weight the capped sources come first; a level of words per weight fits the rest
    level = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = F.sum("cap").over(level.rowsBetween(Window.unboundedPreceding, -1))
    rest = F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("total", share * F.sum("source_size").over(every))
    per = per.withColumn("level", (F.col("total") - F.coalesce(before, F.lit(0.0))) / rest)
    fits = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level"))))
    per = per.withColumn("held", fits.over(every)["level"])
    target = F.least("cap", F.coalesce(F.col("held") * F.col("weight"), F.col("cap")))
    return per.select("source", "n", "source_size", target.alias("target"))


def pivot_pairs(size: np.ndarray, p: np.ndarray, draw) -> tuple[np.ndarray, int]:
    """Rounds documents of positive sizes two at a time; returns the probabilities and the index left fractional or -1.

    The expected value of each probability and the sum of sizes times probabilities stay what they were.
    """
    p, size, held = p.astype(float).tolist(), size.tolist(), -1
    for i, s in enumerate(size):
        if held >= 0:
            gain = min((1 - p[i]) * s, p[held] * size[held])
            lose = min(p[i] * s, (1 - p[held]) * size[held])
            words = gain if draw() * (gain + lose) < lose else -lose
            p[i], p[held] = p[i] + words / s, p[held] - words / size[held]
        for j in (i, held):
            if j >= 0 and (p[j] < 1e-9 or p[j] > 1 - 1e-9):
                p[j] = float(round(p[j]))
        left = [j for j in (i, held) if j >= 0 and 0 < p[j] < 1]
        held = left[0] if left else -1
    return np.array(p), held


def _draws(*key):
    return np.random.default_rng(zlib.crc32(repr(key).encode())).random


def _bucket(table: pa.Table) -> pa.Table:
    """Rounds one bucket of a source; columns as in ROWS, all p alike and below 1."""
    table = table.sort_by([("size", "descending"), ("doc_id", "ascending")])
    size, p = table.column("size").to_numpy(), table.column("p").to_numpy()
    filled = int((size > 0).sum())
    rounded, left = pivot_pairs(size[:filled], p[:filled], _draws(table.column("source")[0].as_py(), table.column("bucket")[0].as_py()))
    whole = table.column("copies").to_numpy().copy()
    whole[:filled] += np.where(np.arange(filled) == left, 0, rounded).astype(np.int64)
    new = np.full(len(size), np.nan)
    if left >= 0:
        new[left] = rounded[left]
    return table.set_column(4, "copies", pa.array(whole)).set_column(5, "p", pa.array(new, from_pandas=True)).cast(SCHEMA)


def _node(table: pa.Table, last: bool) -> pa.Table:
    """Rounds what the buckets below a node left; the last node rounds its own rest too."""
    table = table.sort_by([("size", "descending"), ("bucket", "ascending")])
    size, whole = table.column("size").to_numpy(), table.column("copies").to_numpy().copy()
    draw = _draws("node", table.column("source")[0].as_py(), int(table.column("bucket").to_numpy().min()), len(table))
    p, left = pivot_pairs(size, table.column("p").to_numpy(), draw)
    if left >= 0 and last:
        p[left], left = float(draw() < p[left]), -1
    whole = whole + np.where(np.arange(len(p)) == left, 0, p).astype(np.int64)
    new = np.where(np.arange(len(p)) == left, p, np.nan)
    return table.set_column(4, "copies", pa.array(whole)).set_column(5, "p", pa.array(new, from_pandas=True)).cast(SCHEMA)


def _node_step(last: bool):
    return lambda table: _node(table.drop_columns(["node"]), last)


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, doc_id: str = "doc_id", text: str = "text", source: str = "source", bucket_rows: int = 4096) -> DataFrame:
    """How many copies of each document a mix of the sources holds.

    Returns one row per row of docs: doc_id, source, size (words), source_size, target (words of the source),
    copies, taken (copies times size). Copies are the source's target over its size, rounded down or up; a
    document without words has 0 taken. A null text has no words; a very long text is one document like any
    other; null sources are one source, the last; repeated rows are rounded each on its own; an empty table
    gives no rows; other columns, whatever their names, are ignored. Draws are seeded by source and bucket,
    so reruns agree. Rows are dealt to buckets by id and size: rows that share an id spread by size, rows
    that share both are one bucket.
    """
    sized = written(sizes(docs, doc_id, text, source))
    per = written(targets(sized, weights, share, most)).withColumnRenamed("source", "of")
    most_rows = per.agg(F.max("n")).first()[0] or 0
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = sized.join(per, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size",
        F.pmod(F.xxhash64("doc_id", "size"), F.ceil(F.col("n") / F.lit(bucket_rows))).cast("long").alias("bucket"),
        F.floor(rate).cast("long").alias("copies"), (rate - F.floor(rate)).alias("p"),
    )
    rounded = written(rows.groupBy("source", "bucket").applyInArrow(_bucket, ROWS))
    open_rows, closed, width = rounded.where("p is not null"), None, -(-most_rows // bucket_rows)
    while True:
        last = width <= FAN_IN
        node = open_rows.withColumn("node", F.lit(0) if last else F.floor(F.col("bucket") / FAN_IN))
        done = written(node.groupBy("source", "node").applyInArrow(_node_step(last), ROWS))
        closed = done if closed is None else closed.union(done)
        if last:
            break
        closed = closed.where("p is null")
        open_rows, width = done.where("p is not null").withColumn("bucket", F.floor(F.col("bucket") / FAN_IN)), -(-width // FAN_IN)
    final = rounded.where("p is null").union(closed)
    taken = final.join(per, F.col("source").eqNullSafe(F.col("of")))
    return taken.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
