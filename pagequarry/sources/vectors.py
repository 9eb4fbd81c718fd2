"""Vectors in ordered .npy parts, with a line of JSON for each row beside them."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import numbered


def npy_parts(spark: SparkSession, path: str) -> DataFrame:
    """(part, row, place, v) of the .npy files that a path or pattern names: rows in order over all parts, parts by name, from 0.

    Files are read by Spark, so any store will do; a part is one task's work. What is counted up in one
    place is one row for each part.
    """

    def each(batches):
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                m = np.load(io.BytesIO(raw), allow_pickle=False)
                if m.ndim != 2:
                    raise ValueError(f"{name} holds no rows of vectors")
                for lo in range(0, len(m), 4096):
                    own = m[lo : lo + 4096].astype(np.float32)
                    flat = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * own.shape[1]), pa.array(own.reshape(-1)))
                    yield pa.record_batch([pa.array([name] * len(own), pa.string()), pa.array(np.arange(lo, lo + len(own))), flat], ["part", "row", "v"])

    rows = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(each, "part string, row long, v array<float>")
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, "part").select("part", "row", (F.col("start") + F.col("row")).alias("place"), "v")


def with_meta(vectors: DataFrame, meta: str, schema: str) -> DataFrame:
    """Vectors of length one beside what the lines of a file of JSON say of them, the first line of the first; an error if there are not as many of both."""
    spark = vectors.sparkSession
    lines = spark.read.text(meta).where("trim(value) != ''").withColumn("_order", F.monotonically_increasing_id())
    told = numbered(lines, [], ["_order"], "_nth").select((F.col("_nth") - 1).alias("place"), F.from_json("value", schema).alias("m"))
    n, m = vectors.count(), told.count()
    if n != m:
        raise ValueError(f"{m} lines for {n} vectors")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)) + 1e-9
    unit = vectors.withColumn("_l", length).withColumn("v", F.transform("v", lambda x: (x / F.col("_l")).cast("float"))).drop("_l")
    return unit.join(told, "place").select("place", "v", "m.*")
