"""Votes, pooled records, ordered unions, chunks of components, merges and trees."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators import ranking as K
from ..operators import relational as R
from .registry import query


@query("orders", sql="""
WITH v AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_custkey, CASE WHEN sum(n) >= 3 THEN arg_min(o_orderpriority, (-n, o_orderpriority)) ELSE 'unsure' END AS type FROM v GROUP BY 1""")  # fmt: skip
def majority_vote(orders: DataFrame) -> DataFrame:
    """The commonest value of each group, the first by name on a tie; groups of under three are unsure."""
    votes = orders.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    best = F.min_by("o_orderpriority", F.struct(-F.col("n"), F.col("o_orderpriority")))
    return votes.groupBy("o_custkey").agg(F.when(F.sum("n") >= 3, best).otherwise("unsure").alias("type"))


@query("lineitem", sql="""
WITH f AS (SELECT l_orderkey, l_shipdate::DATE AS d, min(l_linenumber) AS pos FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, string_agg(d::VARCHAR, ' ' ORDER BY pos, d) AS dates FROM f GROUP BY 1""")  # fmt: skip
def ordered_union(lineitem: DataFrame) -> DataFrame:
    """The different values of a group in the order in which they first appear."""
    first = lineitem.groupBy("l_orderkey", F.to_date("l_shipdate").cast("string").alias("d")).agg(F.min("l_linenumber").alias("pos"))
    return first.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "d"))), lambda x: x["d"]), " ").alias("dates"))


@query("lineitem", sql="""
SELECT l_suppkey, count(*) AS n, round(sum(l_extendedprice), 2) AS total, round_even(avg((l_returnflag = 'R')::INT), 3) AS ratio,
  string_agg(DISTINCT l_linestatus, ', ' ORDER BY l_linestatus) AS states, arg_max(l_orderkey, (l_extendedprice, -l_orderkey)) AS example FROM lineitem GROUP BY 1""")  # fmt: skip
def tension_record(lineitem: DataFrame) -> DataFrame:
    """What is counted, summed and told of one tension, and its strongest example."""
    best = F.max_by("l_orderkey", F.struct("l_extendedprice", (-F.col("l_orderkey")).alias("first")))
    ratio = F.bround(F.avg((F.col("l_returnflag") == "R").cast("int")), 3)
    return lineitem.groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"), ratio.alias("ratio"), F.array_join(F.array_sort(F.collect_set("l_linestatus")), ", ").alias("states"), best.alias("example")
    )


@query("events", sql="""
SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 20) AS heavy, count(DISTINCT user_id) AS pages, round_even(100.0 * count(*) / nullif((SELECT count(*) FROM events), 0), 2) AS percent FROM events GROUP BY 1""")  # fmt: skip
def feature_histogram(events: DataFrame) -> DataFrame:
    by = events.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 20).alias("heavy"), F.count_distinct("user_id").alias("pages"))
    total = F.nullif(F.sum("n").over(Window.partitionBy()), F.lit(0))
    return by.select("event_type", "n", "heavy", "pages", F.bround(100.0 * F.col("n") / total, 2).alias("percent"))


@query("conversations", sql="""
WITH s AS (SELECT DISTINCT role, unnest(string_split(text, chr(10))) AS line FROM conversations) SELECT role, count(*) AS snippets, sum(('0x' || substr(md5(line), 1, 8))::BIGINT)::BIGINT AS digest FROM s WHERE line <> '' GROUP BY 1""")  # fmt: skip
def merge_information(conversations: DataFrame) -> DataFrame:
    """Sets of snippets united under one key: how many different ones, and a digest of them that no order changes."""
    lines = conversations.select("role", F.explode(F.split("text", "\n")).alias("line")).where("line != ''").distinct()
    number = F.conv(F.substring(F.md5("line"), 1, 8), 16, 10).cast("long")
    return lines.groupBy("role").agg(F.count("*").alias("snippets"), F.sum(number).alias("digest"))


@query("part", "lineitem", sql="""
SELECT p_brand, count(*) AS promised, count(*) FILTER (WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)) AS covered, min(p_partkey) FILTER (WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)) AS first_hole FROM part GROUP BY 1""")  # fmt: skip
def promise_coverage(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    met = lineitem.where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"), F.lit(1).alias("met")).distinct()
    both = part.select("p_partkey", "p_brand").join(met, "p_partkey", "left")
    return both.groupBy("p_brand").agg(F.count("*").alias("promised"), F.count("met").alias("covered"), F.min(F.when(F.col("met").isNull(), F.col("p_partkey"))).alias("first_hole"))


@query("orders", sql="""
WITH r AS (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders)
SELECT o_orderpriority, string_agg(o_orderkey::VARCHAR, ' ' ORDER BY rn) FILTER (WHERE rn <= 3) AS samples, count(*) AS n FROM r GROUP BY 1""")  # fmt: skip
def group_samples(orders: DataFrame) -> DataFrame:
    """Three examples of each group, and its size."""
    size = orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    top = K.top_n(orders.select("o_orderpriority", "o_orderkey"), ["o_orderpriority"], 3, F.col("o_orderkey"))
    shown = top.groupBy("o_orderpriority").agg(F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")), " ").alias("samples"))
    return shown.join(size, "o_orderpriority")


@query("lineitem", sql="""
WITH a AS (SELECT l_orderkey, l_partkey AS item, l_linenumber * 2 AS place FROM lineitem UNION ALL SELECT l_orderkey, l_suppkey, l_linenumber * 2 + 1 FROM lineitem), f AS (SELECT l_orderkey, item, min(place) AS place FROM a GROUP BY 1, 2)
SELECT l_orderkey, item, row_number() OVER (PARTITION BY l_orderkey ORDER BY place, item) AS number FROM f""")  # fmt: skip
def interleave(lineitem: DataFrame) -> DataFrame:
    """Two lists of each key taken in turns, what was seen before left out."""
    place = F.col("l_linenumber") * 2
    both = lineitem.select("l_orderkey", F.col("l_partkey").alias("item"), place.alias("place")).union(lineitem.select("l_orderkey", "l_suppkey", place + 1))
    first = both.groupBy("l_orderkey", "item").agg(F.min("place").alias("place"))
    return first.select("l_orderkey", "item", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("place", "item")).alias("number"))


@query("orders", sql="SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders")
def global_ids(orders: DataFrame) -> DataFrame:
    """Running numbers over all rows without sorting them in one task."""
    return K.numbered(orders.select("o_orderkey", "o_orderdate"), [], ["o_orderdate", "o_orderkey"], "id").select("o_orderkey", "id")


@query("events", sql="""
SELECT user_id, arg_min(event_type, (CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'error' THEN 3 ELSE 2 END, event_id)) AS best FROM events GROUP BY 1""")  # fmt: skip
def status_priority(events: DataFrame) -> DataFrame:
    tier = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "error", 3).otherwise(2)
    return events.groupBy("user_id").agg(F.min_by("event_type", F.struct(tier, F.col("event_id"))).alias("best"))


@query("conversations", sql="""
SELECT conv_id, arg_max(turn, (length(text), -turn)) AS turn, max(length(text)) AS n FROM conversations WHERE length(text) >= 200 GROUP BY 1""")  # fmt: skip
def longest_wins(conversations: DataFrame) -> DataFrame:
    """The longest text above a floor, the first on a tie."""
    n = F.length("text")
    return conversations.where(n >= 200).groupBy("conv_id").agg(F.max_by("turn", F.struct(n, -F.col("turn"))).alias("turn"), F.max(n).alias("n"))


@query("lineitem", sql="SELECT l_suppkey, l_partkey, count(*) AS uses FROM lineitem GROUP BY 1, 2 HAVING count(*) > 2")
def over_use(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("uses")).where("uses > 2")


@query("part", sql="SELECT p_partkey, p_name, p_brand FROM part QUALIFY row_number() OVER (PARTITION BY lower(trim(p_brand)), substr(p_name, 1, 30) ORDER BY p_partkey) = 1")
def composite_dedup(part: DataFrame) -> DataFrame:
    near = part.select("p_partkey", "p_name", "p_brand", F.lower(F.trim("p_brand")).alias("a"), F.substring("p_name", 1, 30).alias("b"))
    return R.keep_best(near, ["a", "b"], F.col("p_partkey")).select("p_partkey", "p_name", "p_brand")


@query("lineitem", sql="""
SELECT l_orderkey, list_sort(list(l_partkey)) = list_sort(list(DISTINCT l_partkey)) AS same, len(list(l_partkey)) - len(list(DISTINCT l_partkey)) AS again FROM lineitem GROUP BY 1""")  # fmt: skip
def permutation_check(lineitem: DataFrame) -> DataFrame:
    """Whether the items of a list are just those offered, each once."""
    got = lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("x"))
    once = F.array_distinct("x")
    return got.select("l_orderkey", (F.col("x") == once).alias("same"), (F.size("x") - F.size(once)).cast("long").alias("again"))


@query("lineitem", sql="""
WITH b AS (SELECT DISTINCT l_partkey AS number, l_orderkey AS section FROM lineitem WHERE l_quantity > 40) SELECT number, count(*) AS sections, min(section) AS owner FROM b GROUP BY 1""")  # fmt: skip
def box_claims(lineitem: DataFrame) -> DataFrame:
    """A number counts once for each section; the first section owns it, other uses are recorded."""
    return lineitem.where("l_quantity > 40").groupBy(F.col("l_partkey").alias("number")).agg(F.count_distinct("l_orderkey").alias("sections"), F.min("l_orderkey").alias("owner"))


_EDGES = "SELECT o_custkey AS a, o_custkey + 1 AS b FROM orders WHERE o_totalprice > 180000"


@query("orders", sql=f"""
WITH RECURSIVE e AS ({_EDGES}), two AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT DISTINCT a AS node, a AS reach FROM two UNION SELECT r.node, two.b FROM r JOIN two ON two.a = r.reach), c AS (SELECT node, min(reach) AS component FROM r GROUP BY 1)
SELECT node, component, (row_number() OVER (PARTITION BY component ORDER BY node) - 1) // 10 AS chunk FROM c""")  # fmt: skip
def component_chunks(orders: DataFrame) -> DataFrame:
    """Components cut into chunks of at most ten; a component may hold most nodes, so rows are numbered by ranges."""
    edges = orders.where("o_totalprice > 180000").select(F.col("o_custkey").alias("src"), (F.col("o_custkey") + 1).alias("dst"))
    n = K.numbered(G.connected_components(edges), ["component"], ["node"], "rn")
    return n.select("node", "component", F.floor((F.col("rn") - 1) / 10).alias("chunk"))


_LINK = "SELECT DISTINCT l_partkey AS src, (l_partkey + l_suppkey) AS dst FROM lineitem WHERE l_quantity > 48"


@query("lineitem", sql=f"""
WITH RECURSIVE e AS ({_LINK}), w AS (SELECT DISTINCT src AS node, 0 AS depth FROM e WHERE src <= 5 UNION SELECT e.dst, w.depth + 1 FROM w JOIN e ON w.node = e.src WHERE w.depth < 6)
SELECT node, min(depth) AS depth FROM w GROUP BY 1""")  # fmt: skip
def crawl_depth(lineitem: DataFrame) -> DataFrame:
    """How many links away from the roots each page lies, six at most."""
    links = lineitem.where("l_quantity > 48").select(F.col("l_partkey").alias("src"), (F.col("l_partkey") + F.col("l_suppkey")).alias("dst")).distinct()
    return G.reach(links, links.where("src <= 5").select(F.col("src").alias("node")), 6)


_TREE = "SELECT p_partkey AS node, CASE WHEN p_partkey > p_size THEN p_partkey - p_size END AS parent, p_size % 3 = 0 AS has FROM part WHERE p_size > 0"


@query("part", sql=f"""
WITH RECURSIVE t AS ({_TREE}), u AS (SELECT node, parent AS anc, has FROM t UNION ALL SELECT u.node, t.parent, u.has FROM u JOIN t ON u.anc = t.node),
d AS (SELECT node, count(anc) AS depth FROM u GROUP BY 1), k AS (SELECT DISTINCT anc AS node FROM u WHERE has AND anc IS NOT NULL UNION SELECT node FROM t WHERE has)
SELECT node, depth, node IN (SELECT node FROM k) AS kept FROM d""")  # fmt: skip
def tree_paths(part: DataFrame) -> DataFrame:
    """The depth of each node of a tree, and whether it holds something or lies above a node that does; other branches are trimmed."""
    size = F.col("p_size")
    tree = part.where(size > 0).select(F.col("p_partkey").alias("node"), F.when(F.col("p_partkey") > size, F.col("p_partkey") - size).alias("parent"), (size % 3 == 0).alias("full"))
    return G.depths_and_kept(tree)


@query("part", sql=f"""
WITH RECURSIVE t AS ({_TREE}), o AS (SELECT min(node) AS node FROM t WHERE parent IN (SELECT node FROM t) GROUP BY parent HAVING count(*) = 1),
u AS (SELECT node, node AS up FROM t UNION ALL SELECT u.node, t.parent FROM u JOIN t ON u.up = t.node WHERE t.node IN (SELECT node FROM o))
SELECT node, up AS "into" FROM u WHERE up NOT IN (SELECT node FROM o)""")  # fmt: skip
def tree_merged(part: DataFrame) -> DataFrame:
    """The node of a tree that each node ends up in when only children are merged with their parents."""
    size = F.col("p_size")
    tree = part.where(size > 0).select(F.col("p_partkey").alias("node"), F.when(F.col("p_partkey") > size, F.col("p_partkey") - size).alias("parent"))
    return G.only_children_merged(tree)


@query("events", sql="""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS back FROM events)
SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'click') AS clicks, coalesce(string_agg(event_id::VARCHAR, ' ' ORDER BY rn) FILTER (WHERE event_type = 'view' AND rn <= 10), '') AS top,
  max(event_id) FILTER (WHERE event_type = 'click' AND back = 1) AS snippet, coalesce(string_agg(event_id::VARCHAR, ' ' ORDER BY rn) FILTER (WHERE event_type = 'purchase' AND back <= 4), '') AS related FROM r GROUP BY 1""")  # fmt: skip
def typed_extract(events: DataFrame) -> DataFrame:
    """For each user how many items of two types there are, the first ten of one, the last of another and the last four of a third."""
    place = Window.partitionBy("user_id", "event_type")
    ranked = events.withColumn("rn", F.row_number().over(place.orderBy("ts", "event_id"))).withColumn("back", F.row_number().over(place.orderBy(F.desc("ts"), F.desc("event_id"))))
    kind = lambda name: F.col("event_type") == name
    listed = lambda fits: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(fits, F.struct("rn", "event_id")))), lambda x: x["event_id"].cast("string")), " ")
    return ranked.groupBy("user_id").agg(
        F.count_if(kind("view")).alias("views"),
        F.count_if(kind("click")).alias("clicks"),
        listed(kind("view") & (F.col("rn") <= 10)).alias("top"),
        F.max(F.when(kind("click") & (F.col("back") == 1), F.col("event_id"))).alias("snippet"),
        listed(kind("purchase") & (F.col("back") <= 4)).alias("related"),
    )


@query("orders", "customer")
def merge_decisions(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Who survives when pairs are merged in order and a row that was merged away takes part no more."""
    pairs = orders.where("o_totalprice > 150000").select(F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("keep"), (F.col("o_custkey") + 1).alias("gone"))
    return G.apply_merges(pairs)
