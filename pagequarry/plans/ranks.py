"""Ranks, caps and orders."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ranking as K
from ..operators.relational import keep_best as best
from .registry import query


@query("customer", sql="""
WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1 ELSE 2 END, c_acctbal DESC, c_custkey) AS rank FROM customer) SELECT *, CASE WHEN rank <= 40 THEN 'NOW' ELSE 'LATER' END AS turn FROM r""")  # fmt: skip
def ranked_ideas(customer: DataFrame) -> DataFrame:
    """All by tier, then score; the first forty are for now, the others for later."""
    tier = F.when(F.col("c_mktsegment") == "BUILDING", 0).when(F.col("c_mktsegment") == "MACHINERY", 1).otherwise(2)
    rows = customer.select("c_custkey", tier.alias("tier"), (-F.col("c_acctbal")).alias("low"))
    placed = K.numbered(rows, [], ["tier", "low", "c_custkey"], "rank")
    return placed.select("c_custkey", F.col("rank").cast("long").alias("rank"), F.when(F.col("rank") <= 40, "NOW").otherwise("LATER").alias("turn"))


@query("orders", sql="SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def keep_best(orders: DataFrame) -> DataFrame:
    return best(orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], F.desc("o_totalprice"), F.col("o_orderkey"))


@query("pages", sql="""
SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, url AS keeper FROM pages QUALIFY row_number() OVER (PARTITION BY regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) ORDER BY contains(url, '?'), length(url), url, page_id) = 1""")  # fmt: skip
def keeper_choice(pages: DataFrame) -> DataFrame:
    """Of each host the URL without a query, then the shortest, then the first."""
    named = pages.select(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1).alias("host"), "url", "page_id")
    return best(named, ["host"], F.contains("url", F.lit("?")), F.length("url"), F.col("url"), F.col("page_id")).select("host", F.col("url").alias("keeper"))


@query("orders", sql="SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders QUALIFY rn <= 3")
def top_n_per_group(orders: DataFrame) -> DataFrame:
    return K.top_n(orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], 3, F.desc("o_totalprice"), F.col("o_orderkey")).drop("o_totalprice")


@query("customer", sql="""
WITH r AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) SELECT *, row_number() OVER (PARTITION BY rn ORDER BY c_nationkey) AS place FROM r""")  # fmt: skip
def round_robin(customer: DataFrame) -> DataFrame:
    """Rounds over the groups, the best of each first: (rn, place) is the order."""
    low = customer.select("c_nationkey", "c_custkey", (-F.col("c_acctbal")).alias("low"))
    ranked = K.numbered(low, ["c_nationkey"], ["low", "c_custkey"], "rn").select("c_nationkey", "c_custkey", F.col("rn").cast("long").alias("rn"))
    return ranked.withColumn("place", F.row_number().over(Window.partitionBy("rn").orderBy("c_nationkey")))


@query("orders", sql="""
SELECT o_custkey, o_orderkey FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey) <= 12 OR row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 5""")  # fmt: skip
def cap_large_groups(orders: DataFrame) -> DataFrame:
    return K.cap_large(orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], 12, 5, F.col("o_orderdate"), F.col("o_orderkey")).drop("o_orderdate")


@query("part", sql="""
WITH s AS (SELECT p_partkey, log10(greatest(p_retailprice, 1)) AS v, p_size FROM part WHERE p_size >= 5), m AS (SELECT min(v) AS lo, max(v) AS hi FROM s)
SELECT p_partkey, round(0.7 * CASE WHEN hi - lo <= 1e-12 THEN 0.5 ELSE (v - lo) / (hi - lo) END + 0.3 * (1 - p_size / 50.0), 4) AS score FROM s, m""")  # fmt: skip
def log_score(part: DataFrame) -> DataFrame:
    kept = part.where("p_size >= 5")
    scored = K.log_score(kept.select("p_partkey", "p_size", "p_retailprice"), F.col("p_retailprice"), "v")
    return scored.select("p_partkey", F.round(0.7 * F.col("v") + 0.3 * (1 - F.col("p_size") / 50.0), 4).alias("score"))


@query("conversations", sql="""
SELECT conv_id, turn, thread FROM (SELECT *, (sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING))::BIGINT AS thread FROM conversations) WHERE thread BETWEEN 1 AND 2""")  # fmt: skip
def first_threads(conversations: DataFrame) -> DataFrame:
    """The first two top-level threads with all that hangs below them."""
    held = conversations.select("conv_id", "turn", "role")
    return K.running(held, ["conv_id"], ["turn"], thread=("sum", (F.col("role") == "user").cast("long"))).where("thread between 1 and 2").select("conv_id", "turn", "thread")


@query("lineitem", sql="""
WITH f AS (SELECT l_orderkey, l_suppkey, min(l_linenumber) AS pos FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY pos, l_suppkey) AS number FROM f""")  # fmt: skip
def first_appearance_number(lineitem: DataFrame) -> DataFrame:
    first = lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.min("l_linenumber").alias("pos"))
    return first.select("l_orderkey", "l_suppkey", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("pos", "l_suppkey")).alias("number"))


@query("lineitem", sql="SELECT l_orderkey, l_linenumber, l_partkey, occurrence FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) AS occurrence FROM lineitem) WHERE occurrence <= 2")
def occurrence_cap(lineitem: DataFrame) -> DataFrame:
    return K.occurrence(lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), ["l_partkey"], F.col("l_orderkey"), F.col("l_linenumber")).where("occurrence <= 2")


@query("events", sql="SELECT event_id, event_type || '-' || row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS seq FROM events")
def type_sequence(events: DataFrame) -> DataFrame:
    n = K.numbered(events.select("event_id", "event_type", "ts"), ["event_type"], ["ts", "event_id"], "occurrence")
    return n.select("event_id", F.concat_ws("-", "event_type", "occurrence").alias("seq"))


@query("part", sql="""
SELECT p_partkey, s || CASE WHEN n > 1 THEN '-' || n ELSE '' END AS slug FROM (SELECT p_partkey, s, row_number() OVER (PARTITION BY s ORDER BY p_partkey) AS n FROM (SELECT p_partkey, regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g') AS s FROM part))""")  # fmt: skip
def unique_suffix(part: DataFrame) -> DataFrame:
    n = K.numbered(part.select("p_partkey", F.regexp_replace(F.lower("p_type"), "[^a-z0-9]+", "-").alias("s")), ["s"], ["p_partkey"], "occurrence")
    return n.select("p_partkey", F.concat("s", F.when(F.col("occurrence") > 1, F.concat(F.lit("-"), "occurrence")).otherwise("")).alias("slug"))


@query("part", sql="""
WITH r AS (SELECT p_partkey, p_brand, row_number() OVER w AS rn, count(*) OVER (PARTITION BY p_brand) AS n FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey))
SELECT p_partkey, p_brand, ((rn - 1) * CAST(ceil(n / 15.0) AS BIGINT)) // n + 1 AS part_no, CAST(ceil(n / 15.0) AS BIGINT) AS parts FROM r""")  # fmt: skip
def balanced_chunks(part: DataFrame) -> DataFrame:
    """Each group in the fewest even parts of at most 15."""
    size = part.groupBy("p_brand").agg(F.count("*").alias("n"))
    rows = K.numbered(part.select("p_partkey", "p_brand"), ["p_brand"], ["p_partkey"], "rn").join(size, "p_brand")
    parts = F.ceil(F.col("n") / 15.0)
    return rows.select("p_partkey", "p_brand", (F.floor((F.col("rn") - 1) * parts / F.col("n")) + 1).alias("part_no"), parts.alias("parts"))


@query("lineitem", sql="SELECT l_orderkey, l_linenumber, round(CASE WHEN sum(l_quantity) OVER w > 0 THEN l_quantity / sum(l_quantity) OVER w ELSE 1.0 / count(*) OVER w END, 6) AS share FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)")
def share_of_total(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber", F.round(K.share(F.col("l_quantity"), ["l_orderkey"]), 6).alias("share"))


@query("orders", "customer", sql="""
WITH a AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) <= 30 AS top, o_totalprice < 5000 AS shallow FROM orders),
d AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rn FROM a WHERE NOT top AND NOT shallow AND o_totalprice < 20000)
SELECT o_orderkey, CASE WHEN top THEN 'traffic' ELSE 'shallow' END AS why FROM a WHERE top OR shallow UNION ALL SELECT o_orderkey, 'deep' FROM d WHERE rn <= 10""")  # fmt: skip
def stratified_candidates(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """The 30 strongest of each group, all shallow ones, and the first ten of the deeper ones."""
    a = orders.select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate")
    top = K.top_n(a, ["o_orderpriority"], 30, F.desc("o_totalprice"), F.col("o_orderkey")).select("o_orderkey", F.lit("traffic").alias("why"))
    rest = a.join(top, "o_orderkey", "left_anti")
    shallow = rest.where("o_totalprice < 5000").select("o_orderkey", F.lit("shallow").alias("why"))
    deep = K.top_n(rest.where("o_totalprice >= 5000 and o_totalprice < 20000"), ["o_orderpriority"], 10, F.col("o_orderdate"), F.col("o_orderkey"))
    return top.union(shallow).union(deep.select("o_orderkey", F.lit("deep")))
