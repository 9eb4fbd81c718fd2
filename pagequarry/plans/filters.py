"""Classifiers, filters with consequences, and lookups with a fallback."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.text import word_count
from ..operators import relational as R
from ..sources.tables import number
from .registry import query

#: Name patterns and the cluster that each stands for, the first that fits.
TAXONOMY = [("widgets", r"\bwidget"), ("gears", r"\b(gear|cog)"), ("fasteners", r"\b(bolt|nut|screw)"), ("tubes", r"\b(pipe|tube|valve)")]
_TAX = " ".join(f"WHEN regexp_matches(lower(p_name), '{p}') THEN '{n}'" for n, p in TAXONOMY)


@query("supplier", sql="SELECT s_suppkey, greatest(round(s_acctbal, 0) - 4000, 0) AS follow FROM supplier")
def clamp_follow(supplier: DataFrame) -> DataFrame:
    """A difference that never falls below zero."""
    return supplier.select("s_suppkey", F.greatest(F.round("s_acctbal", 0) - 4000, F.lit(0.0)).alias("follow"))


@query("part", sql=f"SELECT p_partkey, CASE {_TAX} ELSE 'other' END AS cluster FROM part")
def taxonomy(part: DataFrame) -> DataFrame:
    return part.select("p_partkey", R.first_match([(n, F.lower("p_name").rlike(p)) for n, p in TAXONOMY], "other").alias("cluster"))


@query("events", sql="SELECT event_id, CASE WHEN lower(trim(event_type)) IN ('view', 'click', 'purchase') THEN lower(trim(event_type)) ELSE 'error' END AS status FROM events")
def status_vocabulary(events: DataFrame) -> DataFrame:
    """States outside the closed vocabulary, unknown ones too, count as errors."""
    state = F.lower(F.trim("event_type"))
    return events.select("event_id", F.when(state.isin("view", "click", "purchase"), state).otherwise("error").alias("status"))


@query("customer", sql="SELECT c_custkey, coalesce(TRY_CAST(replace(regexp_extract(c_name, '#(.*)$', 1), ',', '') AS DOUBLE), -1) AS n FROM customer")
def numeric_coerce(customer: DataFrame) -> DataFrame:
    return customer.select("c_custkey", F.coalesce(number(F.regexp_extract("c_name", "#(.*)$", 1)), F.lit(-1.0)).alias("n"))


@query("orders", sql="""
WITH m AS (SELECT o_orderkey, o_orderpriority, o_orderstatus <> 'P' AND o_totalprice < 30000 AS low FROM orders),
g AS (SELECT o_orderpriority, avg(low::INT) > 0.15 AS refused FROM m GROUP BY 1)
SELECT o_orderkey, low AND NOT refused AS dropped, refused FROM m JOIN g USING (o_orderpriority)""")  # fmt: skip
def capped_drops(orders: DataFrame) -> DataFrame:
    """Weak rows go unless protected; where that would drop more than 15 % of a group, none does."""
    marked = orders.select("o_orderkey", "o_orderpriority", ((F.col("o_orderstatus") != "P") & (F.col("o_totalprice") < 30000)).alias("low"))
    gate = marked.groupBy("o_orderpriority").agg((F.avg(F.col("low").cast("int")) > 0.15).alias("refused"))
    return marked.join(gate, "o_orderpriority").select("o_orderkey", (F.col("low") & ~F.col("refused")).alias("dropped"), "refused")


@query("labels", sql="""
SELECT doc_id, CASE WHEN toxic = 1 THEN 'DROP' WHEN quality = 1 AND toxic = 0 THEN 'KEEP-CORE' WHEN quality = 1 THEN 'KEEP-TRANSPLANT' ELSE 'MAYBE' END AS verdict FROM labels""")  # fmt: skip
def verdict_table(labels: DataFrame) -> DataFrame:
    good = F.col("quality") == 1
    rules = [("DROP", F.col("toxic") == 1), ("KEEP-CORE", good & (F.col("toxic") == 0)), ("KEEP-TRANSPLANT", good)]
    return labels.select("doc_id", R.first_match(rules, "MAYBE").alias("verdict"))


@query("pages", sql="""
WITH h AS (SELECT page_id, regexp_extract_all(html, '(?i)<a [^>]*href="([^"#?]*)', 1) AS a FROM pages), k AS (SELECT page_id, a, list_filter(a, lambda x: NOT regexp_matches(x, '(?i)^/(th|an|to)')) AS kept FROM h)
SELECT page_id, len(a) AS offered, len(kept) AS kept FROM k WHERE len(kept) > 0 OR len(a) = 0""")  # fmt: skip
def strip_denied(pages: DataFrame) -> DataFrame:
    """Denied links go; a page goes only if that left none of those it had."""
    links = pages.select("page_id", F.regexp_extract_all("html", F.lit('(?i)<a [^>]*href="([^"#?]*)'), F.lit(1)).alias("a"))
    kept = links.withColumn("k", F.filter("a", lambda x: ~x.rlike("(?i)^/(th|an|to)")))
    return kept.where((F.size("k") > 0) | (F.size("a") == 0)).select("page_id", F.size("a").cast("long").alias("offered"), F.size("k").cast("long").alias("kept"))


_NORMAL = r"trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"


@query("conversations", sql=f"""
SELECT b.conv_id, b.turn FROM conversations b JOIN conversations a ON a.conv_id = b.conv_id AND a.turn = b.turn - 1
WHERE contains({_NORMAL.format("a.text")}, array_to_string(string_split({_NORMAL.format("b.text")}, ' ')[1:2], ' '))""")  # fmt: skip
def grounded(conversations: DataFrame) -> DataFrame:
    """Turns whose opening words stand verbatim, but for case and marks, in the turn that they answer."""
    normal = F.trim(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "))
    quote = conversations.select("conv_id", "turn", F.array_join(F.slice(F.split(normal, " "), 1, 2), " ").alias("quote"))
    source = conversations.select("conv_id", (F.col("turn") + 1).alias("turn"), normal.alias("source"))
    return quote.join(source, ["conv_id", "turn"]).where(F.contains("source", F.col("quote"))).select("conv_id", "turn")


@query("documents", "labels", sql="""
WITH p AS (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 1), m AS (SELECT doc_id, lang, doc_id IN (SELECT doc_id FROM p) AS hit FROM documents)
SELECT doc_id, lang FROM m WHERE hit OR lang NOT IN (SELECT lang FROM m WHERE hit)""")  # fmt: skip
def subset_or_all(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Only picks that were offered; a group with none keeps all it offered."""
    picks = labels.where("quality = 1 and toxic = 1").select("doc_id")
    return R.subset_or_all(documents.select("doc_id", "lang"), picks, "doc_id", "lang")


_W = r"len(list_filter(string_split(regexp_replace(text, '\s+', ' ', 'g'), ' '), lambda w: w <> ''))"


@query("documents", sql=f"SELECT doc_id, regexp_matches(substr(text, 1, 1200), '(?i)(not found|404|no longer)') OR {_W} < 80 AS missing_page FROM documents")
def soft_404(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", (F.substring("text", 1, 1200).rlike("(?i)(not found|404|no longer)") | (word_count(F.col("text")) < 80)).alias("missing_page"))


@query("part", sql="""
WITH v AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS item, generate_subscripts(string_split(p_name, ' '), 1) AS pos, CASE WHEN p_size > 25 THEN ['drop'] ELSE [] END AS verdicts FROM part)
SELECT p_partkey, pos - 1 AS pos, item, coalesce(verdicts[pos], 'keep') AS verdict FROM v""")  # fmt: skip
def verdict_align(part: DataFrame) -> DataFrame:
    """Verdicts go to items by position; an item without one is kept."""
    verdicts = F.when(F.col("p_size") > 25, F.array(F.lit("drop"))).otherwise(F.array().cast("array<string>"))
    items = part.select("p_partkey", verdicts.alias("v"), F.posexplode(F.split("p_name", " ")).alias("pos", "item"))
    return items.select("p_partkey", "pos", "item", F.coalesce(F.get("v", F.col("pos")), F.lit("keep")).alias("verdict"))


_HOST = r"regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '')"


@query("pages", sql=f"SELECT {_HOST} AS host, count(*) AS n FROM pages GROUP BY 1 ORDER BY n DESC, host LIMIT 10")
def host_histogram(pages: DataFrame) -> DataFrame:
    """The ten hosts with most pages; a top-k report."""
    return pages.groupBy(U.host(F.col("url")).alias("host")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "host").limit(10)


@query("pages", sql=f"""
WITH h AS (SELECT page_id, {_HOST} AS host FROM pages), d AS (SELECT DISTINCT regexp_extract(host, '([^.]+[.][^.]+)$', 1) AS domain FROM h WHERE NOT starts_with(host, 't'))
SELECT page_id, host, domain FROM h JOIN d ON host = domain OR ends_with(host, '.' || domain)""")  # fmt: skip
def domain_suffix(pages: DataFrame) -> DataFrame:
    """Hosts that are a listed domain or lie below one: each suffix of a host meets the list by equality."""
    hosts = pages.select("page_id", U.host(F.col("url")).alias("host"))
    listed = hosts.where(~F.startswith("host", F.lit("t"))).select(F.regexp_extract("host", "([^.]+[.][^.]+)$", 1).alias("domain")).distinct()
    return hosts.select("page_id", "host", F.explode(U.suffixes(F.col("host"))).alias("domain")).join(listed, "domain")


@query("documents", sql=r"""
WITH u AS (SELECT doc_id, unnest(list_transform(regexp_extract_all(text, 'https?://[^\s<>"()\[\]]+'), lambda x: rtrim(x, '.,'))) AS url FROM documents)
SELECT doc_id, rtrim(lower(url), '/') AS key, count(*) AS n FROM u GROUP BY 1, 2""")  # fmt: skip
def urls_in_text(documents: DataFrame) -> DataFrame:
    """URLs in running text, final marks off, alike but for case and a final slash."""
    found = documents.select("doc_id", F.explode(U.in_text(F.col("text"))).alias("url"))
    return found.groupBy("doc_id", F.rtrim(F.lower("url"), F.lit("/")).alias("key")).agg(F.count("*").alias("n"))


@query("events", "nation", "region", sql="""
SELECT event_id, coalesce(n_name, r_name, 'unknown') AS label FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events) LEFT JOIN nation ON n_nationkey = k LEFT JOIN region ON r_regionkey = k - 25""")  # fmt: skip
def chained_lookup(events: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One table first, then a second one for what it lacks."""
    key = events.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    one = key.join(nation, F.col("n_nationkey") == F.col("k"), "left").join(region, F.col("r_regionkey") == F.col("k") - 25, "left")
    return one.select("event_id", F.coalesce("n_name", "r_name", F.lit("unknown")).alias("label"))
