"""Tables on disk that rows are put into by key: only the parts that new rows touch are written anew."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written


def held_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of a table, none if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], schema)


def rewrite(path: str, parts: DataFrame, part: str) -> None:
    """Writes these parts of a table anew and leaves all others as they are; a part without rows can't be given."""
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


class KeyedTable:
    """Rows by key in a number of buckets, which is for good; a key's bucket is its hash.

    Putting rows in reads and writes the buckets of their keys alone, so it costs what is touched. What is
    written is first staged in the shared folder; putting the same rows in again changes nothing, so a run
    that broke off is run again. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, columns: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.columns = spark.createDataFrame([], columns).columns
        self.schema = f"{columns}, bucket int"

    def rows(self) -> DataFrame:
        return held_rows(self.spark, self.path, self.schema).select(*self.columns)

    def put(self, rows: DataFrame, newest: Column, keep_old: bool = False) -> list[int]:
        """Puts rows in, of those with one key the one with the greatest `newest`; rows with a null key go.

        A key that the table has is replaced, or left as it is if keep_old. Returns the buckets that were written.
        """
        whole = F.struct(*[F.col(c) for c in self.columns])
        new = rows.where(F.col(self.key).isNotNull()).groupBy(F.col(self.key).alias("_key")).agg(F.max_by(whole, newest).alias("row")).select("row.*")
        new = written(new.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")))
        old = held_rows(self.spark, self.path, self.schema)
        if keep_old:
            new = written(new.join(old.select(self.key, "bucket"), [self.key, "bucket"], "left_anti").select(new.columns))
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())  # as many as there are buckets at most
        if touched:
            stay = old.where(F.col("bucket").isin(touched)).join(new.select(self.key, "bucket"), [self.key, "bucket"], "left_anti")
            rewrite(self.path, written(stay.select(new.columns).unionByName(new)).repartition("bucket"), "bucket")
        return touched


def upserting(stream: DataFrame, table: KeyedTable, newest: Column, checkpoint: str) -> None:
    """Puts all rows of a stream that no earlier call has into the table, a batch at a time, and stops."""
    stream.writeStream.foreachBatch(lambda batch, _: table.put(batch, newest) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
