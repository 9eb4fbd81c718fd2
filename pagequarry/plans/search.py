"""Shingle joins, cosine search, candidate edges, components and chains."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normal_number, words
from ..operators.graph import connected_components
from ..operators.linkage import average_linkage
from ..operators.relational import sent
from ..operators.similarity import cosine_top_k
from .registry import query

_TRI = """SELECT DISTINCT {0}, array_to_string(w[i:i+2], ' ') AS g FROM (SELECT {0}, w, unnest(range(1, len(w) - 1)) AS i FROM (SELECT {0},
  list_filter(string_split(regexp_replace(regexp_replace(lower(text), '(\\d),(\\d)', '\\1\\2', 'g'), '[^a-z0-9%]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM {1}))"""


def trigrams(df: DataFrame, key: str) -> DataFrame:
    """(key, g): the runs of three words, as often as they occur; a set of long texts' runs in one row would be slow to make."""
    w = df.select(key, words(normal_number(F.col("text"))).alias("w"))
    later = lambda start: F.slice("w", F.lit(start), F.size("w"))
    three = w.select(key, F.inline(F.arrays_zip("w", later(2), later(3)))).toDF(key, "a", "b", "c")
    return three.where("c is not null").select(key, F.concat_ws(" ", "a", "b", "c").alias("g"))


@query("benchmark", "documents", sql=f"""
WITH a AS ({_TRI.format("item_id", "benchmark")}), b AS ({_TRI.format("doc_id", "documents")}),
m AS (SELECT item_id, doc_id, count(*) AS shared FROM a JOIN b ON a.g = b.g GROUP BY 1, 2 HAVING count(*) >= 8)
SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id) = 1""")  # fmt: skip
def shingle_match(benchmark: DataFrame, documents: DataFrame) -> DataFrame:
    """For each item the text that shares most trigrams with it, eight at least, the first on a tie.

    Few trigrams of items are sent to all executors, so those of texts meet them before any shuffle.
    """
    shared = trigrams(documents, "doc_id").join(sent(trigrams(benchmark, "item_id").distinct()), "g").distinct().groupBy("item_id", "doc_id").agg(F.count("*").alias("shared")).where("shared >= 8")
    w = Window.partitionBy("item_id").orderBy(F.desc("shared"), "doc_id")
    return shared.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


_UNIT = "u AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), n AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS l FROM u)"
_NEAR = f"""WITH {_UNIT}, s AS (SELECT q.vec_id AS query_id, r.vec_id, r.label, round(list_dot_product(q.v, r.v) / (q.l * r.l), 6) AS sim FROM n q JOIN n r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id)"""


@query("embeddings", sql=f"{_NEAR} SELECT query_id, vec_id, round(sim, 4) AS sim, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rn FROM s QUALIFY rn <= 10")
def cosine_topk(embeddings: DataFrame) -> DataFrame:
    """The ten nearest of every row whose id is divisible by 20, against all rows."""
    near = cosine_top_k(embeddings.where("vec_id % 20 = 0"), embeddings, 10, "vec_id", "embedding")
    return near.select("query_id", "vec_id", F.round("sim", 4).alias("sim"), "rn")


@query("embeddings", sql=f"""
{_NEAR}, t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rn FROM s QUALIFY rn <= 40)
SELECT query_id, vec_id, round(0.5 * sim + 0.5 * max(sim) OVER (PARTITION BY query_id, label), 4) AS blend FROM t""")  # fmt: skip
def blend_rank(embeddings: DataFrame) -> DataFrame:
    """Half a row's own likeness, half the best of its group among the forty nearest."""
    near = cosine_top_k(embeddings.where("vec_id % 20 = 0"), embeddings, 40, "vec_id", "embedding").join(embeddings.select("vec_id", "label"), "vec_id")
    best = F.max("sim").over(Window.partitionBy("query_id", "label"))
    return near.select("query_id", "vec_id", F.round(0.5 * F.col("sim") + 0.5 * best, 4).alias("blend"))


@query("embeddings", sql=f"""
{_NEAR} SELECT query_id, vec_id, round(sim, 4) AS sim FROM (SELECT s.*, a.label AS own, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, s.vec_id) AS rn FROM s JOIN embeddings a ON a.vec_id = query_id) WHERE rn <= 6 AND (label = own AND sim >= 0.80 OR label <> own AND sim >= 0.78)""")  # fmt: skip
def candidate_edges(embeddings: DataFrame) -> DataFrame:
    """Of the six nearest those that are alike enough: 0.80 within a source, 0.78 across two; the six are chosen first."""
    near = cosine_top_k(embeddings.where("vec_id % 20 = 0"), embeddings, 6, "vec_id", "embedding").where("sim >= 0.78")
    labels = embeddings.select("vec_id", "label")
    own = labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("own"))
    return near.join(labels, "vec_id").join(own, "query_id").where("label != own or sim >= 0.80").select("query_id", "vec_id", F.round("sim", 4).alias("sim"))


@query("orders", sql="""
WITH RECURSIVE e AS (SELECT o_custkey AS a, o_custkey + 30 AS b FROM orders WHERE o_totalprice > 150000), two AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT DISTINCT a AS node, a AS reach FROM two UNION SELECT r.node, two.b FROM r JOIN two ON two.a = r.reach) SELECT node, min(reach) AS component FROM r GROUP BY 1""")  # fmt: skip
def components(orders: DataFrame) -> DataFrame:
    return connected_components(orders.where("o_totalprice > 150000").select(F.col("o_custkey").alias("src"), (F.col("o_custkey") + 30).alias("dst")))


_EDGE = "SELECT p_partkey AS src, p_partkey - p_size AS dst FROM part WHERE p_size BETWEEN 1 AND 12 AND p_partkey > p_size"


@query("part", sql=f"""
WITH RECURSIVE e AS ({_EDGE}), c AS (SELECT src, dst, 1 AS hops FROM e UNION ALL SELECT c.src, e.dst, hops + 1 FROM c JOIN e ON c.dst = e.src WHERE hops < 6)
SELECT src, arg_max(dst, hops) AS target, max(hops) AS hops, max(hops) < 6 AS resolved FROM c GROUP BY 1""")  # fmt: skip
def canonical_chain(part: DataFrame) -> DataFrame:
    """Follows redirects for at most six hops; longer chains and loops stay unresolved. Each hop is an equi-join of one row for each source."""
    edge = part.where("p_size between 1 and 12 and p_partkey > p_size").select(F.col("p_partkey").alias("src"), (F.col("p_partkey") - F.col("p_size")).alias("dst"))
    step = edge.select(F.col("src").alias("at"), F.col("dst").alias("next"))
    chain = edge.withColumn("hops", F.lit(1))
    for _ in range(5):
        grown = chain.join(step, chain.dst == step.at, "left")
        chain = grown.select("src", F.coalesce("next", "dst").alias("dst"), (F.col("hops") + F.col("next").isNotNull().cast("int")).alias("hops"))
    return chain.select("src", F.col("dst").alias("target"), "hops", (F.col("hops") < 6).alias("resolved"))


@query("embeddings")
def linked_vectors(embeddings: DataFrame) -> DataFrame:
    """Each vector, and two more that are bent from it a little and more, with its cluster by average linkage at a mean cosine of 0.85.

    Tested against a loop that joins one pair at a time, without SQL.
    """
    each = embeddings.select("vec_id", "embedding", F.explode(F.array(*map(F.lit, range(3)))).alias("k"))
    bent = F.transform("embedding", lambda x, i: x * (1 + 0.35 * F.col("k") * F.cos(i * (F.col("k") + 1) + F.col("vec_id"))))
    return average_linkage(each.withColumn("bent", bent).withColumn("id", 3 * F.col("vec_id") + F.col("k")), 0.85, "id", "bent").withColumnRenamed("id", "vec_id")


@query("embeddings")
def vector_clusters(embeddings: DataFrame) -> DataFrame:
    """Each vector, scaled to length one, with the nearest of 45 means; seeded. Tested for what a mean is, without SQL."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import Normalizer
    from pyspark.ml.functions import array_to_vector

    held = embeddings.where("embedding is not null").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("raw"))
    unit = Normalizer(inputCol="raw", outputCol="features").transform(held)
    found = KMeans(k=45, seed=0, predictionCol="cluster").fit(unit)
    return found.transform(unit).select("vec_id", "cluster")
