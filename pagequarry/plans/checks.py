"""Checks of plans, edits and partitions, each a row of what was found; and what is fresh, held or paced."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.ranking import running, schedule, share
from .registry import query

_NUMBER = r"\d[\d,]*\.?\d*%?"


def edit_verdict(before: Column, after: Column, title_before: Column, title_after: Column, tolerance: float = 0.10) -> tuple[Column, Column]:
    """(why an edit is refused, what to look at): arrays of reasons.

    Refused: another title, an empty text, figures that were nowhere before, over a quarter of the tags gone.
    To look at: fewer tags lost, figures whose count moved, a length that moved by over a tenth.
    """
    tags = [F.array_distinct(X.tag_ids(t)) for t in (before, after)]
    figures = [F.regexp_extract_all(t, F.lit(_NUMBER), F.lit(0)) for t in (before, after)]
    lost = F.size(F.array_except(*tags))
    stripped = lost > 0.25 * F.size(tags[0])
    wb, wa = X.word_count(before), X.word_count(after)
    moved = ~F.array_sort(figures[0]).eqNullSafe(F.array_sort(figures[1]))
    block = F.array(
        F.when(~title_before.eqNullSafe(title_after), "title changed"), F.when(F.trim(after) == "", "left empty"),
        F.when(F.size(F.array_except(figures[1], figures[0])) > 0, "figure invented"), F.when(stripped, "tags stripped"),
    )
    warn = F.array(F.when((lost > 0) & ~stripped, "tags lost"), F.when(moved, "figures changed"), F.when((wb > 0) & (F.abs(wa - wb) > tolerance * wb), "length moved"))
    kept = lambda a: F.filter(a, lambda x: x.isNotNull())
    return kept(block), kept(warn)


_EDITED = "CASE turn % 5 WHEN 0 THEN before WHEN 1 THEN '' WHEN 2 THEN before || ' 99' WHEN 3 THEN text || ' [c2] 10 10 x' ELSE text || ' [c1, c2, c3, c4] 10' END"


@query("conversations", sql=rf"""
WITH b AS (SELECT conv_id, turn, text, text || ' [c1, c2, c3, c4] [c5] 10' AS before FROM conversations), e AS (SELECT *, {_EDITED} AS after_ FROM b),
m AS (SELECT *, regexp_extract_all(before, '{_NUMBER}') AS fb, regexp_extract_all(after_, '{_NUMBER}') AS fa, len(list_filter(string_split(regexp_replace(before, '\s+', ' ', 'g'), ' '), lambda w: w <> '')) AS wb,
  len(list_filter(string_split(regexp_replace(after_, '\s+', ' ', 'g'), ' '), lambda w: w <> '')) AS wa, 5 - CASE turn % 5 WHEN 0 THEN 5 WHEN 1 THEN 0 WHEN 2 THEN 5 WHEN 3 THEN 1 ELSE 4 END AS lost FROM e)
SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN conv_id % 7 = 0 THEN 'title changed' END, CASE WHEN trim(after_) = '' THEN 'left empty' END, CASE WHEN len(list_filter(fa, lambda x: NOT list_contains(fb, x))) > 0 THEN 'figure invented' END, CASE WHEN lost > 1.25 THEN 'tags stripped' END], lambda x: x IS NOT NULL), '; ') AS block,
  array_to_string(list_filter([CASE WHEN lost BETWEEN 1 AND 1.25 THEN 'tags lost' END, CASE WHEN list_sort(fa) <> list_sort(fb) THEN 'figures changed' END, CASE WHEN abs(wa - wb) > 0.1 * wb THEN 'length moved' END], lambda x: x IS NOT NULL), '; ') AS warn FROM m""")  # fmt: skip
def tiered_guards(conversations: DataFrame) -> DataFrame:
    """Edits of texts with tags, some left alone, emptied, with a figure too many, without most tags, without one."""
    head, k = F.col("text"), F.col("turn") % 5
    before = F.concat(head, F.lit(" [c1, c2, c3, c4] [c5] 10"))
    after = F.when(k == 0, before).when(k == 1, "").when(k == 2, F.concat(before, F.lit(" 99"))).when(k == 3, F.concat(head, F.lit(" [c2] 10 10 x"))).otherwise(F.concat(head, F.lit(" [c1, c2, c3, c4] 10")))
    rows = conversations.select("conv_id", "turn", before.alias("before"), after.alias("after"), F.when(F.col("conv_id") % 7 == 0, "new").otherwise("old").alias("title"))
    block, warn = edit_verdict(F.col("before"), F.col("after"), F.lit("old"), F.col("title"))
    return rows.select("conv_id", "turn", F.array_join(block, "; ").alias("block"), F.array_join(warn, "; ").alias("warn"))


def paragraph_fault(old: Column, new: Column, in_section: Column, most_paragraphs: int = 6, most_sentences: int = 5) -> Column:
    """Why a new paragraph is refused, "" if it isn't: empty, split in over two, too many in its section, too long, invented tags or figures, other links."""
    parts = F.filter(F.transform(F.split(new, r"\n\s*\n"), lambda p: F.trim(p)), lambda p: p != "")
    links = lambda t: F.array_sort(F.array_distinct(F.regexp_extract_all(t, F.lit(r"https?://[^\s)\]]+"), F.lit(0))))
    figures = lambda t: F.transform(F.regexp_extract_all(t, F.lit(_NUMBER), F.lit(0)), lambda n: F.rtrim(n, F.lit(".,")))
    return (
        F.when(F.size(parts) == 0, "empty").when(F.size(parts) > 2, "split too far").when(in_section - 1 + F.size(parts) > most_paragraphs, "too many in the section")
        .when(F.exists(parts, lambda p: F.size(X.sentences(p)) > most_sentences), "still too long").when(F.size(F.array_except(X.tag_ids(new), X.tag_ids(old))) > 0, "invented tag")
        .when(F.size(F.array_except(figures(new), figures(old))) > 0, "invented figure").when(~links(new).eqNullSafe(links(old)), "changed link").otherwise("")
    )


@query("conversations", sql="""
SELECT conv_id, turn, CASE WHEN turn % 8 = 0 THEN 'empty' WHEN turn % 8 = 1 THEN 'split too far' WHEN turn % 8 = 2 AND conv_id % 7 > 4 OR turn % 8 > 2 AND conv_id % 7 = 6 THEN 'too many in the section' WHEN turn % 8 = 3 THEN 'still too long'
  WHEN turn % 8 = 4 THEN 'invented tag' WHEN turn % 8 = 5 THEN 'invented figure' WHEN turn % 8 = 6 THEN 'changed link' ELSE '' END AS fault FROM conversations""")  # fmt: skip
def paragraph_faults(conversations: DataFrame) -> DataFrame:
    """Replacements of one paragraph by others, each with one fault or none."""
    old = F.lit("A [c1] says 10. See https://a.b/c now.")
    made = ["", "x\n\ny\n\nz", "One [c1].\n\nTwo https://a.b/c", "A. B. C. D. E. F https://a.b/c", "A [c1, c9] https://a.b/c", "A [c1] 11 https://a.b/c", "A [c1] https://a.b/d", "A [c1]: 10, https://a.b/c"]
    new = F.element_at(F.array(*map(F.lit, made)), (F.col("turn") % 8 + 1).cast("int"))
    return conversations.select("conv_id", "turn", paragraph_fault(old, new, F.col("conv_id") % 7 + 1).alias("fault"))


@query("orders", "lineitem", sql="""
WITH s AS (SELECT o_orderkey, o_orderpriority AS h1, o_totalprice, count(l_orderkey) AS h3s, count(*) FILTER (WHERE l_quantity > 40) AS tagged FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT o_orderkey, h3s, tagged, round(tagged / nullif(h3s, 0), 2) AS coverage, CASE WHEN h3s > 0 AND tagged / h3s >= 0.45 AND tagged > 0 THEN 'keep' ELSE 'cut' END AS verdict FROM s""")  # fmt: skip
def section_survival(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """A section stays if 45 % of its parts are tagged, and one at least."""
    parts = lineitem.groupBy("l_orderkey").agg(F.count("*").alias("h3s"), F.count_if(F.col("l_quantity") > 40).alias("tagged"))
    both = orders.join(parts, F.col("o_orderkey") == F.col("l_orderkey"), "left").na.fill(0, ["h3s", "tagged"])
    rate = F.col("tagged") / F.nullif(F.col("h3s"), F.lit(0))
    return both.select("o_orderkey", "h3s", "tagged", F.round(rate, 2).alias("coverage"), F.when((rate >= 0.45) & (F.col("tagged") > 0), "keep").otherwise("cut").alias("verdict"))


@query("orders", "lineitem", sql="""
WITH n AS (SELECT l_orderkey, count(*) AS h3s FROM lineitem GROUP BY 1), t AS (SELECT o_orderkey, coalesce(h3s, 0) AS h3s, CAST(floor(o_totalprice / 300) AS BIGINT) AS target FROM orders LEFT JOIN n ON l_orderkey = o_orderkey)
SELECT o_orderkey, target, h3s, target // (h3s + 1) AS each_ FROM t WHERE target // (h3s + 1) < 200""")  # fmt: skip
def thin_sections(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Sections that get under 200 words for each part and their own heading; those without parts count too."""
    parts = lineitem.groupBy("l_orderkey").agg(F.count("*").alias("h3s"))
    t = orders.join(parts, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.floor(F.col("o_totalprice") / 300).alias("target"), F.coalesce("h3s", F.lit(0).cast("long")).alias("h3s"))
    return t.withColumn("each_", F.floor(F.col("target") / (F.col("h3s") + 1))).where("each_ < 200").select("o_orderkey", "target", "h3s", "each_")


@query("documents", sql="""
WITH now_ AS (SELECT lang AS type, count(*) AS pages, count(*) FILTER (WHERE length(text) >= 400) AS filled FROM documents GROUP BY 1), base AS (SELECT lang AS type, count(*) AS pages, count(*) FILTER (WHERE length(text) >= 300) AS filled FROM documents WHERE doc_id % 5 <> 0 OR lang = 'de' GROUP BY 1 UNION ALL SELECT 'old', 3, 2)
SELECT coalesce(n.type, b.type) AS type, coalesce(n.pages, 0) AS pages, coalesce(n.filled, 0) AS filled, b.pages AS baseline_pages, b.filled AS baseline_filled, coalesce(n.pages, 0) < coalesce(b.pages, 0) OR coalesce(n.filled, 0) < coalesce(b.filled, 0) AS regressed FROM now_ n FULL JOIN base b ON n.type = b.type""")  # fmt: skip
def gap_accounting(documents: DataFrame) -> DataFrame:
    """What there is of each type beside what a baseline had; a type that has less has regressed, also one that is gone."""
    tally = lambda df, n: df.groupBy(F.col("lang").alias("type")).agg(F.count("*").alias("pages"), F.count_if(F.length("text") >= n).alias("filled"))
    base = tally(documents.where("doc_id % 5 != 0 or lang = 'de'"), 300).union(documents.sparkSession.createDataFrame([("old", 3, 2)], "type string, pages long, filled long"))
    both = tally(documents, 400).join(base.select("type", F.col("pages").alias("baseline_pages"), F.col("filled").alias("baseline_filled")), "type", "full_outer").na.fill(0, ["pages", "filled"])
    less = (F.col("pages") < F.coalesce("baseline_pages", F.lit(0))) | (F.col("filled") < F.coalesce("baseline_filled", F.lit(0)))
    return both.withColumn("regressed", less)


@query("orders", "lineitem", "customer", sql="""
WITH n AS (SELECT c_nationkey AS t, count(*) AS posts, count(*) FILTER (WHERE o_orderstatus = 'P') AS misc FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1), v AS (SELECT *, CASE WHEN t % 4 = 0 THEN 'DROP' ELSE 'KEEP' END AS verdict FROM n)
SELECT 'off-brand' AS rule, t FROM v WHERE verdict = 'DROP' AND posts > 20 AND t % 8 <> 0 UNION ALL SELECT 'size alarm', t FROM v WHERE verdict = 'KEEP' AND posts > 60 AND t % 8 <> 1
UNION ALL SELECT 'misc', t FROM v WHERE misc > 0.15 * posts UNION ALL SELECT 'no idea', t FROM v WHERE verdict = 'KEEP' AND t % 5 = 0 UNION ALL SELECT 'no tension', t FROM v WHERE verdict = 'DROP' AND t % 5 <> 0""")  # fmt: skip
def partition_alarms(orders: DataFrame, lineitem: DataFrame, customer: DataFrame) -> DataFrame:
    """Groups that break a rule: a large dropped one that nobody looked at, an overgrown one, too much left over, one without an idea, an idea without one."""
    posts = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("t")).agg(F.count("*").alias("posts"), F.count_if(F.col("o_orderstatus") == "P").alias("misc"))
    t, kept = F.col("t"), F.col("t") % 4 != 0
    rules = {
        "off-brand": ~kept & (F.col("posts") > 20) & (t % 8 != 0), "size alarm": kept & (F.col("posts") > 60) & (t % 8 != 1),
        "misc": F.col("misc") > 0.15 * F.col("posts"), "no idea": kept & (t % 5 == 0), "no tension": ~kept & (t % 5 != 0),
    }
    broken = F.filter(F.array(*[F.when(cond, F.lit(rule)) for rule, cond in rules.items()]), lambda r: r.isNotNull())
    return posts.select(F.explode(broken).alias("rule"), "t")


@query("orders", "lineitem", sql="""
WITH s AS (SELECT o_orderkey, o_orderpriority, o_totalprice, count(l_orderkey) AS n, count(*) FILTER (WHERE l_discount = 0) AS bare FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN n = 0 THEN 'no sections' END, CASE WHEN left(o_orderpriority, 1) = '5' THEN 'missing keyword' END, CASE WHEN o_totalprice < 5000 THEN 'word band missing' END, CASE WHEN bare > 0 THEN 'part without cards' END], lambda x: x IS NOT NULL), '; ') AS hard,
  array_to_string(list_filter([CASE WHEN n BETWEEN 1 AND 2 THEN 'few sections' END, CASE WHEN bare > 2 THEN 'many cuts' END], lambda x: x IS NOT NULL), '; ') AS soft FROM s""")  # fmt: skip
def plan_freeze(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Why a plan can't be frozen, and what to look at before it is."""
    parts = lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_discount") == 0).alias("bare"))
    plan = orders.join(parts, F.col("o_orderkey") == F.col("l_orderkey"), "left").na.fill(0, ["n", "bare"])
    told = lambda **rules: F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(k.replace("_", " "))) for k, c in rules.items()])), "; ")
    hard = told(no_sections=F.col("n") == 0, missing_keyword=F.left("o_orderpriority", F.lit(1)) == "5", word_band_missing=F.col("o_totalprice") < 5000, part_without_cards=F.col("bare") > 0)
    return plan.select("o_orderkey", hard.alias("hard"), told(few_sections=F.col("n").between(1, 2), many_cuts=F.col("bare") > 2).alias("soft"))


@query("orders", "lineitem", sql="""
SELECT o_orderkey, bool_and(l_shipdate <= o_orderdate + INTERVAL 60 DAY) AS fresh FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")  # fmt: skip
def fresh_outputs(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Outputs that no input is newer than; an output's time is its order's date and 60 days."""
    newest = lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("newest"))
    both = orders.join(newest, F.col("o_orderkey") == F.col("l_orderkey"))
    return both.select("o_orderkey", (F.col("newest") <= F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("fresh"))


@query("documents", sql="""
WITH c AS (SELECT DISTINCT md5(text) AS key FROM documents WHERE doc_id % 3 = 0), d AS (SELECT DISTINCT md5(text) AS key FROM documents) SELECT key, key IN (SELECT key FROM c) AS held FROM d""")  # fmt: skip
def content_cache(documents: DataFrame) -> DataFrame:
    """Different contents, and whether a cache keyed by their hash has them already; only the others need work."""
    keys = documents.select(F.md5("text").alias("key")).distinct()
    cache = documents.where("doc_id % 3 = 0").select(F.md5("text").alias("key")).distinct().withColumn("in_cache", F.lit(True))
    return keys.join(cache, "key", "left").select("key", F.col("in_cache").isNotNull().alias("held"))


@query("events", sql="""
WITH e AS (SELECT event_id, user_id, ts, event_type = 'error' AS blocked FROM events), g AS (SELECT *, count(*) FILTER (WHERE NOT blocked) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS streak FROM e),
n AS (SELECT *, count(*) FILTER (WHERE blocked) OVER (PARTITION BY user_id, streak ORDER BY ts, event_id) AS blocks FROM g)
SELECT event_id, least(8.0, 0.4 * 2 ** blocks)::DOUBLE AS delay FROM n""")  # fmt: skip
def paced_requests(events: DataFrame) -> DataFrame:
    """How long to wait behind each request to a host: 0.4 s, doubled for each block in a row, 8 s at most."""
    rows = events.select("event_id", "user_id", "ts", (F.col("event_type") == "error").alias("blocked"))
    rows = running(rows, ["user_id"], ["ts", "event_id"], streak=("sum", (~F.col("blocked")).cast("int")))
    rows = running(rows, ["user_id", "streak"], ["ts", "event_id"], blocks=("sum", F.col("blocked").cast("int")))
    return rows.select("event_id", F.least(F.lit(8.0), 0.4 * F.pow(F.lit(2.0), F.col("blocks"))).alias("delay"))


@query("events", sql="""
WITH e AS (SELECT event_id, user_id, ts, epoch_ms(ts) // 20000 AS arrival, (event_type = 'error')::INT AS b FROM events),
d AS (SELECT *, least(8000, 400 * 2 ** least(sum(b) OVER w - b, 30))::BIGINT AS delay FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, (sum(delay) OVER w - delay)::BIGINT AS before FROM d WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, arrival, (before + max(arrival - before) OVER (PARTITION BY user_id ORDER BY ts, event_id))::BIGINT AS starts FROM s""")  # fmt: skip
def request_schedule(events: DataFrame) -> DataFrame:
    """When each request may start, its host asked one at a time: 0.4 s apart, doubled for good at each block, 8 s at most; in milliseconds, to which times are rounded."""
    micros = F.round(F.unix_micros(F.col("ts").cast("timestamp")), -3)
    asked = events.select("event_id", "user_id", "ts", "event_type", (micros / 20_000_000).cast("long").alias("arrival"))
    return schedule(asked, "user_id", ["ts", "event_id"], F.col("arrival"), F.col("event_type") == "error").select("event_id", "arrival", "starts")


@query("events", sql="""
SELECT user_id AS key, arg_max(value, (ts, event_id)) AS value, max(ts) AS stored FROM events GROUP BY 1""")  # fmt: skip
def latest_by_key(events: DataFrame) -> DataFrame:
    """A table of keys and values after all writes: the last one of each key holds."""
    return events.groupBy(F.col("user_id").alias("key")).agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"), F.max("ts").alias("stored"))


@query("embeddings", sql="""
WITH p AS (SELECT vec_id, vec_id // 100 AS part, label, embedding FROM embeddings) SELECT part, count(*) AS vectors, count(*) FILTER (WHERE vec_id % 97 <> 0) AS meta, count(*) = count(*) FILTER (WHERE vec_id % 97 <> 0) AS whole FROM p GROUP BY 1""")  # fmt: skip
def vector_parts(embeddings: DataFrame) -> DataFrame:
    """Whether each part of a vector store has as many rows of its own as of what tells of them; some of the latter are left out."""
    part = F.floor(F.col("vec_id") / 100).alias("part")
    vectors = embeddings.groupBy(part).agg(F.count("*").alias("vectors"))
    meta = embeddings.where("vec_id % 97 != 0").groupBy(part).agg(F.count("*").alias("meta"))
    return vectors.join(meta, "part", "left").select("part", "vectors", F.coalesce("meta", F.lit(0).cast("long")).alias("meta"), (F.col("vectors") == F.coalesce("meta", F.lit(0))).alias("whole"))


@query("orders", "lineitem", sql="""
WITH s AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 = 0 THEN 0 ELSE l_quantity END AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(round_even(1500::DOUBLE * CASE WHEN sum(v) OVER w > 0 THEN v / sum(v) OVER w ELSE 1.0::DOUBLE / count(*) OVER w END * 1.1::DOUBLE, 0) AS BIGINT) AS words FROM s WINDOW w AS (PARTITION BY l_orderkey)""")  # fmt: skip
def word_budgets(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """1,500 words and a tenth over, split by weight within each order, evenly where no weight is given."""
    weight = F.when(F.col("l_orderkey") % 7 == 0, 0.0).otherwise(F.col("l_quantity"))
    part = lineitem.select("l_orderkey", "l_linenumber", weight.alias("v"))
    return part.select("l_orderkey", "l_linenumber", F.bround(1500 * share(F.col("v"), ["l_orderkey"]) * 1.1, 0).cast("long").alias("words"))
