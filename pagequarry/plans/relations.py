"""Joins, anti-joins, classifiers, duplicates and set accounting."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import title_key
from ..operators import relational as R
from ..operators.ranking import running
from .registry import query

_CASE = """CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'bad status' WHEN o_totalprice < 20000 THEN 'too small' WHEN o_orderpriority LIKE '5%' THEN 'low priority' WHEN o_orderdate < TIMESTAMP '1993-01-01' THEN 'too old' END"""


def _reason():
    return R.first_match([("bad status", ~F.col("o_orderstatus").isin("F", "O")), ("too small", F.col("o_totalprice") < 20000), ("low priority", F.col("o_orderpriority").startswith("5")), ("too old", F.col("o_orderdate") < F.lit("1993-01-01").cast("timestamp"))])


@query("orders", sql=f"SELECT o_orderkey, {_CASE} AS reason FROM orders")
def drop_reasons(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", _reason().alias("reason"))


@query("orders", sql=f"SELECT coalesce({_CASE}, 'kept') AS reason, count(*) AS n FROM orders GROUP BY 1")
def reason_histogram(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.coalesce(_reason(), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("part", sql="SELECT p_partkey FROM part WHERE p_size * 10 >= 100 AND (nullif(p_partkey % 50, 0) IS NULL OR nullif(p_partkey % 50, 0) <= 40)")
def keyword_filter_null_pass(part: DataFrame) -> DataFrame:
    return part.where(R.in_range(F.col("p_size") * 10, 100, F.nullif(F.col("p_partkey") % 50, F.lit(0)), 40, True)).select("p_partkey")


@query("part", sql="SELECT p_partkey FROM part WHERE p_size * 10 >= 100 AND nullif(p_partkey % 50, 0) < 40")
def keyword_filter_null_fail(part: DataFrame) -> DataFrame:
    """Nulls fail, and so does the bound itself, unlike in keyword_filter_null_pass."""
    return part.where(R.in_range(F.col("p_size") * 10, 100, F.nullif(F.col("p_partkey") % 50, F.lit(0)), 40, False)).select("p_partkey")


@query("customer", "orders", sql="""
SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) ON c_custkey = o_custkey""")  # fmt: skip
def catalogue_traffic_join(customer: DataFrame, orders: DataFrame) -> DataFrame:
    right = orders.withColumnRenamed("o_custkey", "c_custkey")
    return R.enrich(customer.select("c_custkey"), right, "c_custkey", F.desc("o_orderdate"), F.desc("o_orderkey")).select("c_custkey", "o_orderkey", "o_totalprice")


@query("customer", "orders", sql="SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def provable_gaps(customer: DataFrame, orders: DataFrame) -> DataFrame:
    return R.missing_from(customer.select("c_custkey"), "c_custkey", orders.select("o_custkey"))


@query("part", "lineitem", "documents", sql="""
SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45) AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') AND p_partkey NOT IN (SELECT doc_id FROM documents WHERE lang = 'de')""")  # fmt: skip
def accounting_lost(part: DataFrame, lineitem: DataFrame, documents: DataFrame) -> DataFrame:
    return R.missing_from(part.select("p_partkey"), "p_partkey", lineitem.where("l_quantity > 45").select("l_partkey"), lineitem.where("l_returnflag = 'R'").select("l_partkey"), documents.where("lang = 'de'").select("doc_id"))


@query("documents", "labels", sql="SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_keep(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return documents.select("doc_id", "source").join(labels.where("quality = 1"), "doc_id", "left_semi")


@query("documents", "labels", sql="SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_todo(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return R.missing_from(documents.select("doc_id", "source"), "doc_id", labels.select("doc_id"))


@query("documents", sql="""
SELECT doc_id, sha256(text) AS sha, first_value(doc_id) OVER (PARTITION BY sha256(text) ORDER BY n_chars DESC, doc_id) AS survivor, count(*) OVER (PARTITION BY sha256(text)) AS copies FROM documents""")  # fmt: skip
def exact_body_dups(documents: DataFrame) -> DataFrame:
    return R.survivors(documents, "text", "doc_id", -F.col("n_chars"), F.col("doc_id")).select("doc_id", "sha", "survivor", "copies")


@query("documents", sql="""
WITH c AS (SELECT doc_id, n_chars, count(*) OVER w AS copies, first_value(doc_id) OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS keeper FROM documents WINDOW w AS (PARTITION BY sha256(text)))
SELECT doc_id, CASE WHEN copies >= 8 THEN 'template' WHEN copies >= 5 AND n_chars <= 900 THEN 'soft 404' WHEN copies > 1 AND doc_id <> keeper THEN 'collapse' ELSE 'keep' END AS action FROM c""")  # fmt: skip
def body_cluster_action(documents: DataFrame) -> DataFrame:
    """Many equal bodies are a template, several small ones a missing page, others collapse to a keeper."""
    c = R.survivors(documents, "text", "doc_id", F.col("doc_id"))
    action = R.first_match([("template", F.col("copies") >= 8), ("soft 404", (F.col("copies") >= 5) & (F.col("n_chars") <= 900)), ("collapse", (F.col("copies") > 1) & (F.col("doc_id") != F.col("survivor")))], "keep")
    return c.select("doc_id", action.alias("action"))


@query("part", sql="""
WITH k AS (SELECT p_partkey, p_size, array_to_string(list_sort(list_transform(list_filter(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda x: x NOT IN ('the', 'a', 'an', 'for', 'of', 'and', 'with', 'to', 'in', 'on', 'your', 'our', 'free')),
  lambda x: CASE WHEN length(x) > 4 THEN regexp_replace(x, 's$', '') ELSE x END)), ' ') AS key FROM part)
SELECT key, count(*) AS titles, min(p_partkey) AS first_id, array_to_string(list_sort(list(DISTINCT p_size)), ' ') AS slices FROM k GROUP BY 1""")  # fmt: skip
def title_key_merge(part: DataFrame) -> DataFrame:
    return part.groupBy(title_key(F.col("p_name")).alias("key")).agg(F.count("*").alias("titles"), F.min("p_partkey").alias("first_id"), F.array_join(F.array_sort(F.collect_set("p_size")).cast("array<string>"), " ").alias("slices"))


@query("documents", "labels", sql="""
WITH g AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id FROM labels UNION ALL SELECT doc_id + 5 FROM labels WHERE toxic = 1) GROUP BY 1)
SELECT coalesce(d.doc_id, g.doc_id) AS doc_id, CASE WHEN g.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'invented' ELSE 'duplicate' END AS verdict, coalesce(n, 0) AS n
FROM documents d FULL JOIN g ON d.doc_id = g.doc_id WHERE g.doc_id IS NULL OR d.doc_id IS NULL OR n > 1""")  # fmt: skip
def partition_accounting(documents: DataFrame, labels: DataFrame) -> DataFrame:
    groups = labels.select("doc_id").union(labels.where("toxic = 1").select(F.col("doc_id") + 5))
    return R.accounting(documents, groups, "doc_id")


@query("documents", "labels", sql="""
WITH g AS (SELECT doc_id, min(quality) AS grp FROM labels GROUP BY 1) SELECT d.doc_id, coalesce(g.grp::VARCHAR, 'misc') AS grp FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN g ON d.doc_id = g.doc_id""")  # fmt: skip
def mece(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return R.exclusive(labels.select("doc_id", F.col("quality").alias("grp")), "doc_id", "grp", documents, "misc")


@query("conversations", sql="""
WITH q AS (SELECT conv_id, turn, trim(rtrim(trim(text), '?')) AS q FROM conversations WHERE role = 'user')
SELECT lower(q) AS key, arg_min(q, conv_id * 1000 + turn) || '?' AS question, count(*) AS asked FROM q GROUP BY 1""")  # fmt: skip
def question_dedup(conversations: DataFrame) -> DataFrame:
    """Questions alike but for case and a question mark at the end; the first spelling stays."""
    q = F.trim(F.rtrim(F.trim("text"), F.lit("?")))
    asked = conversations.where("role = 'user'").select(q.alias("q"), (F.col("conv_id") * 1000 + F.col("turn")).alias("pos"))
    return asked.groupBy(F.lower("q").alias("key")).agg(F.concat(F.min_by("q", "pos"), F.lit("?")).alias("question"), F.count("*").alias("asked"))


@query("supplier", "nation", sql="SELECT s_suppkey, coalesce(n_name, 'other') AS label, n_regionkey IN (0, 3) AS junk FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey <> 2")
def relabel(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    names = nation.where("n_regionkey != 2")
    return supplier.join(names, F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", F.coalesce("n_name", F.lit("other")).alias("label"), F.col("n_regionkey").isin(0, 3).alias("junk"))


@query("customer", "orders", sql="""
SELECT c_custkey, count(o_orderkey) AS ranked, min(o_orderkey) AS best FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 100000 GROUP BY 1 HAVING count(o_orderkey) >= 3""")  # fmt: skip
def cannibalization(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Keys with three or more strong rankings of our own, and the best of them."""
    per = orders.where("o_totalprice > 100000").groupBy("o_custkey").agg(F.count("*").alias("ranked"), F.min("o_orderkey").alias("best")).where("ranked >= 3")
    return customer.join(per, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "ranked", "best")


@query("documents", "labels", sql="""
WITH a AS (SELECT doc_id, 0 AS net FROM documents WHERE lang = 'fr' UNION ALL SELECT doc_id, 1 FROM labels WHERE quality = 1) SELECT doc_id, min(net) AS net FROM a GROUP BY 1""")  # fmt: skip
def union_left_priority(documents: DataFrame, labels: DataFrame) -> DataFrame:
    nets = documents.where("lang = 'fr'").select("doc_id", F.lit(0).alias("net")).union(labels.where("quality = 1").select("doc_id", F.lit(1)))
    return R.keep_best(nets, ["doc_id"], F.col("net"))


@query("events", sql="""
WITH s AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM events)
SELECT user_id, max(n) AS longest, max(n) >= 2 AS tripped FROM (SELECT user_id, island, count(*) FILTER (WHERE event_type = 'error') AS n FROM s GROUP BY 1, 2) GROUP BY 1""")  # fmt: skip
def breaker_streaks(events: DataFrame) -> DataFrame:
    """The longest run of failures of each key; two in a row trip the breaker."""
    islands = running(events, ["user_id"], ["ts", "event_id"], island=("sum", F.when(F.col("event_type") == "error", 0).otherwise(1)))
    runs = islands.groupBy("user_id", "island").agg(F.count_if(F.col("event_type") == "error").alias("n"))
    return runs.groupBy("user_id").agg(F.max("n").alias("longest"), (F.max("n") >= 2).alias("tripped"))


@query("events", sql="""
WITH last AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS state, max(ts) AS claimed FROM events GROUP BY 1), now AS (SELECT max(ts) AS t FROM events)
SELECT user_id, state, CASE WHEN state = 'purchase' THEN 'done' WHEN state = 'error' THEN 'failed' WHEN claimed < t - INTERVAL 900 SECOND THEN 'reclaim' ELSE 'in progress' END AS lease FROM last, now""")  # fmt: skip
def lease_reclaim(events: DataFrame) -> DataFrame:
    """The state of each item of a work queue; claims older than 900 seconds before the newest event are free again."""
    now = events.agg(F.max("ts").alias("t"))
    last = events.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("state"), F.max("ts").alias("claimed"))
    lease = R.first_match([("done", F.col("state") == "purchase"), ("failed", F.col("state") == "error"), ("reclaim", F.col("claimed") < F.col("t") - F.expr("INTERVAL 900 SECOND"))], "in progress")
    return last.join(F.broadcast(now)).select("user_id", "state", lease.alias("lease"))
