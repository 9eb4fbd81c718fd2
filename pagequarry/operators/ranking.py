"""Ranks, caps and orders within groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def top_n(df: DataFrame, keys: list[str], n: int, *order: Column, rank: str = "rn") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= n)


def cap_large(df: DataFrame, keys: list[str], limit: int, kept: int, *order: Column) -> DataFrame:
    """Groups of more than `limit` rows keep their first `kept`; others are whole."""
    w = Window.partitionBy(*keys)
    return df.withColumn("_c", F.count("*").over(w)).withColumn("_n", F.row_number().over(w.orderBy(*order))).where(f"_c <= {limit} or _n <= {kept}").drop("_c", "_n")


def occurrence(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return df.withColumn("occurrence", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def log_score(df: DataFrame, value: Column, name: str, floor: float = 1.0) -> DataFrame:
    """df with log10 of a value scaled to 0 to 1 between the least and the most of all rows; 0.5 where all are alike.

    The bounds are one row, joined back, so rows stay where they are.
    """
    logged = F.log10(F.greatest(value, F.lit(floor)))
    bounds = df.agg(F.min(logged).alias("_lo"), F.max(logged).alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    return df.join(F.broadcast(bounds)).withColumn(name, F.when(span <= 1e-12, F.lit(0.5)).otherwise((logged - F.col("_lo")) / span)).drop("_lo", "_hi")


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Rows numbered from 1 within their keys, or over all rows if there are none, in this order.

    Rows are dealt by ranges of keys and order and written, so the ranges hold; what is summed up is one
    count for each range and key. Neither one order over all rows nor a key with most of them is one task.
    """
    spark = df.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    held = written(df.repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()))
    counts = held.groupBy("_part", *keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    for k in keys:
        offsets = offsets.withColumnRenamed(k, f"_{k}")
    same = F.col("_part") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*order))
    return held.withColumn("_in", inside).join(offsets.withColumnRenamed("_part", "_at"), same).withColumn(name, F.col("_in") + F.col("_before")).select(*df.columns, name)


def share(value: Column, keys: list[str]) -> Column:
    w = Window.partitionBy(*keys)
    total = F.sum(value).over(w)
    return F.when(total > 0, value / total).otherwise(1 / F.count("*").over(w))


def running(df: DataFrame, keys: list[str], order: list[str], **what: tuple[str, Column]) -> DataFrame:
    """df with running sums or maxima, ("sum" or "max", column) by name, over each key's rows in this order, each row's own among them.

    As `numbered`: rows are dealt by ranges of keys and order and written; what is carried from range to range is one
    row for each of them and key, so neither all rows nor a key with most of them is one task. The order should
    tell rows of a key apart; those that it doesn't are in any order. Nulls add nothing.
    """
    spark, op = df.sparkSession, {"sum": F.sum, "max": F.max}
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    held = written(df.withColumns({f"_v_{n}": c for n, (_, c) in what.items()}).repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()))
    totals = held.groupBy("_part", *keys).agg(*[op[o](f"_v_{n}").alias(f"_t_{n}") for n, (o, _) in what.items()])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col("_part").alias("_at"), *[F.col(k).alias(f"_k_{k}") for k in keys], *[op[o](f"_t_{n}").over(before).alias(f"_b_{n}") for n, (o, _) in what.items()])
    same = F.col("_part") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)

    own = held.withColumns({f"_i_{n}": op[o](f"_v_{n}").over(inside) for n, (o, _) in what.items()})
    return own.join(carried, same).select(*df.columns, *[(F.greatest(f"_i_{n}", f"_b_{n}") if o == "max" else F.coalesce(f"_i_{n}", F.lit(0)) + F.coalesce(f"_b_{n}", F.lit(0))).alias(n) for n, (o, _) in what.items()])


def medians(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """(keys, name): the exact median of each key's values, nulls left out; keys without values are missing.

    Equal values are counted before the shuffle; the counts are summed up in order over ranges of values, and the
    one or two values in the middle are those whose sums reach over it. So a group of all rows is no single task, as
    it is for an aggregate that holds a group's values.
    """
    counts = df.select(*keys, value.alias("_x")).where("_x is not null").groupBy(*keys, "_x").agg(F.count("*").alias("_n"))
    summed = running(counts, keys, ["_x"], _upto=("sum", F.col("_n")))
    sizes = summed.groupBy(*keys).agg(F.max("_upto").alias("_all"))
    for k in keys:
        sizes = sizes.withColumnRenamed(k, f"_s_{k}")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    reaches = lambda rank: (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
    middle = summed.join(sizes if keys else F.broadcast(sizes), same).where(reaches(F.expr("(_all - 1) div 2")) | reaches(F.expr("_all div 2")))
    return middle.groupBy(*keys).agg(((F.min("_x") + F.max("_x")) / 2).cast("double").alias(name))


def schedule(requests: DataFrame, host: str, order: list[str], arrival: Column, blocked: Column, first: int = 400, most: int = 8000) -> DataFrame:
    """requests with `starts`: when each may start, in the unit of arrival, if a host is asked one request at a time.

    A request starts when it arrives or, if that is later, the host's delay after the start of the one before. The delay
    is `first`, and each answer that is a block doubles it for good, up to `most`. With the delays summed up
    before each request, a start is that sum and the greatest of all arrivals so far less their own sums: running sums and
    a running maximum, so a host with most of the requests is no single task.
    """
    doubled = F.least(F.lit(most).cast("long"), F.lit(first) * F.pow(F.lit(2.0), F.least(F.col("_b") - F.col("_block"), F.lit(30))).cast("long"))
    told = requests.withColumn("_block", F.coalesce(blocked.cast("long"), F.lit(0))).withColumn("_arrival", arrival.cast("long"))
    delayed = running(told, [host], order, _b=("sum", F.col("_block"))).withColumn("_delay", doubled)
    summed = running(delayed, [host], order, _s=("sum", F.col("_delay"))).withColumn("_before", F.col("_s") - F.col("_delay"))
    late = running(summed, [host], order, _m=("max", F.col("_arrival") - F.col("_before")))
    return late.select(*requests.columns, (F.col("_m") + F.col("_before")).alias("starts"))
