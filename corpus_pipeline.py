"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the docs of the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.llm.mixing import mix_sources
from pagequarry.llm.packing import pack
from pagequarry.llm.queries import tokenizer
from pagequarry.llm.simhash import simhash_dedup
from pagequarry.llm.suffix_dedup import suffix_dedup
from pagequarry.llm.toxicity import clean
from pagequarry.session import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; the others stay as they are.

    A null or empty text is scored as an empty one, a very long one whole; each of repeated rows is judged
    alike; an empty table stays empty; further columns, whatever their names, pass.
    """
    return clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays, and all rows with a null id.

    Null and empty texts are one group, as they have one fingerprint; rows that repeat the id that stays all
    stay; an empty table stays empty; further columns, whatever their names, pass.
    """
    copies = simhash_dedup(docs).where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def _whole(docs: DataFrame) -> Column:
    """All columns as one, so that no name can clash with those of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that an earlier document holds are cut out; bytes of broken characters go with them.

    All documents stay, with n_chars counted anew; a text of which nothing is left, or a null one, is empty.
    A null id comes last; rows that share an id cut nothing from one another; an empty table stays empty;
    further columns, whatever their names, pass.
    """
    row = docs.select("doc_id", "text", _whole(docs.drop("text", "n_chars")).alias("carried"))
    cut = suffix_dedup(row, length=50, carry=("carried",), as_text=True)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return cut.select(*[new.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; those that it takes no words of go, so do null and empty texts.

    Rows that share an id, or have none, stand as often as the one of them that the mix takes most; an empty
    table stays empty; further columns, whatever their names, pass.
    """
    copies = mix_sources(docs).where("taken > 0").groupBy(F.col("doc_id").alias("mixed_id")).agg(F.max("copies").alias("times"))
    worded = docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(_whole(docs).alias("row"))
    both = worded.join(copies, F.col("row.doc_id").eqNullSafe(F.col("mixed_id")))
    return both.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens.

    A null text is empty, so its document is one token; very long texts fill several sequences; repeated rows
    are packed each on its own; an empty table gives none; further columns, whatever their names, are ignored.
    """
    return pack(docs, **tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("mix_sources", mix),
    ("pack", pack_sequences),
]

#: Training and random rounding can't be written in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
