"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hard_negatives, lexical, url_filter, warc
from .ctw import context_tree_scores
from .lattice_dedup import lattice_dedup
from .media import image_copies, rendered
from .mixing import mix_sources
from .packing import pack
from .simhash import simhash_dedup
from .suffix_dedup import suffix_dedup
from .toxicity import toxicity
from .window_dedup import window_dedup


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(_table(spark, sf_dir, "documents"), length=50)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup(_table(spark, sf_dir, "embeddings"), least=0.9)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.query_audit(_table(spark, sf_dir, "pages"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_dedup(_table(spark, sf_dir, "documents"), radius=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = window_dedup(_table(spark, sf_dir, "documents"), window=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree_scores(_table(spark, sf_dir, "documents"))


def tokenizer() -> dict:
    """Where the public byte-level BPE is installed, its splitting pattern and its special strings."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    return {"ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN, "special": tuple((a["content"], a["id"]) for a in added)}


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), **tokenizer())


def op10_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_copies(rendered(_table(spark, sf_dir, "embeddings")))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.lexical_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), most=50)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(hard_negatives.query_rows(_table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(_table(spark, sf_dir, "pages")).drop("score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_lattice_dedup, op3_mix_sources, op4_warc_fixity, op5_simhash_dedup, op6_window_dedup, op7_toxicity, op8_context_tree, op9_pack, op10_image_copies, op11_lexical_search, op12_hard_negatives, op13_url_filter)}


def oracle_sql() -> dict[str, str]:
    return {"op4_warc_fixity": warc.SQL, "op11_lexical_search": lexical.SQL, "op12_hard_negatives": hard_negatives.SQL, "op13_url_filter": url_filter.SQL}
