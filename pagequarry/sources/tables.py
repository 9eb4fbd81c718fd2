"""Reading inputs: Parquet tables of a folder, delimited and JSON files, with the shape checked up front."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """Cells may span lines and hold doubled quotes; columns go by the header's names."""
    names = [f.name for f in T._parse_datatype_string(schema).fields]
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', sep=sep)
    return raw.select(*[F.col(f"`{n}`").cast("string").alias(n) for n in names]).selectExpr(*[f"try_cast(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in T._parse_datatype_string(schema).fields])


def json_rows(spark: SparkSession, path: str, schema: str, lines: bool = True) -> DataFrame:
    """JSON lines or one document; a missing path is an empty table of the same shape."""
    try:
        return spark.read.schema(schema).json(path, multiLine=not lines)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], schema)
        raise


def write_csv(df: DataFrame, path: str, columns: list[str], sep: str = ",") -> None:
    """These columns in this order: absent ones and nulls become empty cells, others are left out."""
    df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns]).write.mode("overwrite").csv(path, header=True, sep=sep, quoteAll=True, escape='"')


def assert_shape(df: DataFrame, paths: list[str]) -> DataFrame:
    """df itself if it has all of these dotted paths; a column silently absent looks like one that is empty."""

    def held(kind: T.DataType, steps: list[str]) -> bool:
        if not steps:
            return True
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        return isinstance(kind, T.StructType) and steps[0] in kind.names and held(kind[steps[0]].dataType, steps[1:])

    missing = [p for p in paths if not held(df.schema, p.split("."))]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def number(c: Column) -> Column:
    """A number from text such as 1,234; null if it isn't one."""
    return F.regexp_replace(F.trim(c.cast("string")), ",", "").try_cast("double")


def sub_rows(df: DataFrame, column: str, separator: str) -> DataFrame:
    """One row for each delimited part of a cell, with its position; blank parts go."""
    parts = F.posexplode(F.split(F.col(column), separator))
    return df.select("*", parts.alias("part_pos", "part")).withColumn("part", F.trim("part")).where("part != ''")


def blob_path(content: Column, content_type: Column) -> Column:
    """sha[:2]/sha.ext of a content-addressed store."""
    kind = F.lower(content_type)
    ext = F.when(kind.contains("html"), "html").when(kind.contains("xml"), "xml").when(kind.contains("json"), "json").when(kind.contains("pdf"), "pdf").otherwise("bin")
    sha = F.sha2(content, 256)
    return F.concat(F.substring(sha, 1, 2), F.lit("/"), sha, F.lit("."), ext)
