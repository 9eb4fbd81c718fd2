"""Joins, set operations and roll-ups that several queries share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def first_match(rules: list[tuple[str, Column]], otherwise: str | None = None) -> Column:
    """The name of the first rule that holds; the order is part of the meaning."""
    chain = reduce(lambda c, r: c.when(r[1], r[0]) if c is not None else F.when(r[1], r[0]), rules, None)
    return chain.otherwise(otherwise)


def in_range(volume: Column, least: float, difficulty: Column, most: float, null_passes: bool) -> Column:
    """volume >= least and difficulty in range: an unknown one passes, and so does `most`, or neither does, as told."""
    fits = difficulty <= most if null_passes else difficulty < most
    return (volume >= least) & (F.coalesce(fits, F.lit(True)) if null_passes else F.coalesce(fits, F.lit(False)))


def keep_best(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in this order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def enrich(left: DataFrame, right: DataFrame, key: str, *order: Column) -> DataFrame:
    """Left join on the best row of each key of the right side."""
    return left.join(keep_best(right, [key], *order), key, "left")


def missing_from(left: DataFrame, key: str, *known: DataFrame) -> DataFrame:
    """Rows of left whose key none of the known tables has."""
    return left.join(reduce(DataFrame.union, [k.select(F.col(k.columns[0]).alias(key)) for k in known]), key, "left_anti")


def provenance(layers: dict[str, DataFrame], key: str) -> DataFrame:
    """Each key with the sorted names of the layers that hold it."""
    tagged = [df.select(F.col(key), F.lit(name).alias("source")) for name, df in layers.items()]
    return reduce(DataFrame.union, tagged).groupBy(key).agg(F.array_sort(F.collect_set("source")).alias("sources"))


def accounting(universe: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Keys that are missing from the groups, in them twice or more, or invented by them."""
    counts = groups.groupBy(key).count().withColumnRenamed("count", "n")
    both = universe.select(key).distinct().withColumn("known", F.lit(True)).join(counts, key, "full_outer")
    verdict = first_match([("missing", F.col("n").isNull()), ("invented", F.col("known").isNull()), ("duplicate", F.col("n") > 1)])
    return both.select(key, verdict.alias("verdict"), F.coalesce("n", F.lit(0)).alias("n")).where("verdict is not null")


def exclusive(groups: DataFrame, key: str, group: str, universe: DataFrame, rest: str) -> DataFrame:
    """Each key of the universe in the first group that claims it, unknown keys dropped, unclaimed ones in the group `rest`."""
    first = groups.join(universe.select(key).distinct(), key, "left_semi").groupBy(key).agg(F.min(group).alias(group))
    left = universe.select(key).distinct().join(first, key, "left_anti").select(key, F.lit(rest).alias(group))
    return first.select(key, F.col(group).cast("string").alias(group)).union(left)


def subset_or_all(offered: DataFrame, picks: DataFrame, key: str, group: str) -> DataFrame:
    """The offered rows that were picked; a group without any keeps all of its rows."""
    marked = offered.join(picks.select(key).distinct().withColumn("_hit", F.lit(True)), key, "left")
    some = marked.where("_hit").select(group).distinct().withColumn("_some", F.lit(True))
    return marked.join(some, group, "left").where("_hit or _some is null").select(offered.columns)


def survivors(df: DataFrame, body: str, row: str, *order: Column) -> DataFrame:
    """Rows with the hash of their body and, for copies, the row that stands for them: the least of `order`, all ascending.

    One row for each hash is found by aggregation, partly before the shuffle, so that a body with very
    many copies is no single task; joining it back is left to adaptive execution, which splits such a key.
    """
    hashed = df.withColumn("sha", F.sha2(F.col(body), 256))
    best = hashed.groupBy("sha").agg(F.min_by(row, F.struct(*order)).alias("survivor"), F.count("*").alias("copies"))
    return hashed.join(best.withColumnRenamed("sha", "_sha"), F.col("sha").eqNullSafe(F.col("_sha"))).drop("_sha")


#: Bytes of a small side that are sent to all executors at most; a larger one is shuffled.
SMALL = 64 << 20


def sent(df: DataFrame, most: int = SMALL) -> DataFrame:
    """df, written once to the shared folder, so that what made it runs once, and marked for broadcasting if it has at most so many bytes.

    Texts count by their bytes, other columns of plain types as 16, nested ones as long as they are in JSON.
    """
    held = written(df)
    size = F.lit(0)
    for name, kind in held.dtypes:
        c = F.col(f"`{name}`")
        nested = kind.startswith(("array", "map", "struct"))
        size = size + 16 + (F.coalesce(F.octet_length(F.to_json(F.struct(c)) if nested else c), F.lit(0)) if nested or kind in ("string", "binary") else F.lit(0))
    return F.broadcast(held) if (held.agg(F.sum(size)).first()[0] or 0) <= most else held
