"""Summaries, pools, ledgers and roll-ups."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import word_count
from ..operators.ranking import medians
from ..session import written
from .registry import query


@query("lineitem", "part", sql="""
SELECT p_brand AS format, count(*) AS pages, sum(l_quantity)::BIGINT AS links, round_even(avg(l_quantity), 1) AS avg_links, max(l_quantity) AS max_links,
  count(DISTINCT l_suppkey) AS competitors, median(l_quantity) FILTER (WHERE l_discount > 0.05) AS median_discounted, strftime(min(l_shipdate), '%Y') AS first_year
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")  # fmt: skip
def format_summary(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    rows = lineitem.join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    q = F.col("l_quantity")
    out = rows.groupBy(F.col("p_brand").alias("format")).agg(
        F.count("*").alias("pages"), F.sum(q).cast("long").alias("links"), F.bround(F.avg(q), 1).alias("avg_links"), F.max(q).alias("max_links"), F.count_distinct("l_suppkey").alias("competitors"),
        F.date_format(F.min("l_shipdate"), "yyyy").alias("first_year"),
    )
    typical = medians(rows.where("l_discount > 0.05"), ["p_brand"], q, "median_discounted")
    return out.join(typical, F.col("format").eqNullSafe(F.col("p_brand")), "left").drop("p_brand").orderBy(F.desc("links"), "format")


@query("events", sql="""
WITH c AS (SELECT user_id AS url, event_type AS core, max(value) AS m FROM events WHERE event_type <> 'error' GROUP BY 1, 2),
clean AS (SELECT url, round(sum(m), 4) AS clean FROM c GROUP BY 1),
top AS (SELECT user_id AS url, event_type AS top_core, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS n FROM events)
SELECT e.user_id AS url, round(sum(e.value), 4) AS raw, any_value(coalesce(clean, 0)) AS clean, any_value(top_core) AS top_core
FROM events e LEFT JOIN clean ON e.user_id = clean.url JOIN top ON e.user_id = top.url AND n = 1 GROUP BY 1""")  # fmt: skip
def traffic_clean(events: DataFrame) -> DataFrame:
    """Raw traffic of a page, and the sum of the best of each core keyword, those in another language left out."""
    core = F.when(F.col("event_type") != "error", F.col("value"))
    two = events.groupBy(F.col("user_id").alias("url"), "event_type").agg(F.sum("value").alias("raw"), F.max(core).alias("best"), F.max(F.struct("value", (-F.col("event_id")).alias("first"))).alias("top"))
    one = two.groupBy("url").agg(F.round(F.sum("raw"), 4).alias("raw"), F.round(F.coalesce(F.sum("best"), F.lit(0.0)), 4).alias("clean"), F.max_by("event_type", "top").alias("top_core"))
    return one


@query("lineitem", sql="""
WITH m AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) AS k FROM m)
SELECT l.l_suppkey AS idea, any_value(r.l_returnflag) AS fit, sum(l_quantity)::BIGINT AS strength, count(DISTINCT l_partkey) AS hosts, median(l_quantity) FILTER (WHERE l_tax > 0) AS typical,
  string_agg(DISTINCT l_linestatus, ' ; ' ORDER BY l_linestatus) AS sources
FROM lineitem l JOIN r ON r.l_suppkey = l.l_suppkey AND k = 1 GROUP BY 1""")  # fmt: skip
def pool_ideas(lineitem: DataFrame) -> DataFrame:
    """Copies of an idea pooled: commonest fit, summed strength, different hosts, typical size, all sources."""
    votes = lineitem.groupBy("l_suppkey", "l_returnflag").count()
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("count"), "l_returnflag")
    mode = votes.withColumn("k", F.row_number().over(w)).where("k = 1").select("l_suppkey", F.col("l_returnflag").alias("fit"))
    pooled = lineitem.groupBy("l_suppkey").agg(
        F.sum("l_quantity").cast("long").alias("strength"), F.count_distinct("l_partkey").alias("hosts"),
        F.array_join(F.array_sort(F.collect_set("l_linestatus")), " ; ").alias("sources"),
    )
    typical = medians(lineitem.where("l_tax > 0"), ["l_suppkey"], F.col("l_quantity"), "typical")
    return pooled.join(mode, "l_suppkey").join(typical, "l_suppkey", "left").withColumnRenamed("l_suppkey", "idea")


@query("orders", sql="""
SELECT o_orderpriority AS type, count(*) AS pages, count(*) FILTER (WHERE o_orderstatus = 'F') AS ok, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS failed,
  round_even(100.0 * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 2) AS coverage FROM orders GROUP BY ROLLUP (o_orderpriority)""")  # fmt: skip
def status_coverage_rollup(orders: DataFrame) -> DataFrame:
    s = F.col("o_orderstatus")
    return orders.rollup(F.col("o_orderpriority").alias("type")).agg(
        F.count("*").alias("pages"), F.count_if(s == "F").alias("ok"), F.count_if(~s.isin("F", "O")).alias("failed"), F.bround(100.0 * F.count_if(s == "F") / F.count("*"), 2).alias("coverage")
    )


@query("events", sql="""
SELECT event_type AS engine, user_id % 10 AS step, round(sum(value), 4) AS cost, count(*) AS calls FROM events GROUP BY ROLLUP (event_type, user_id % 10)""")  # fmt: skip
def ledger_rollup(events: DataFrame) -> DataFrame:
    return events.rollup(F.col("event_type").alias("engine"), (F.col("user_id") % 10).alias("step")).agg(F.round(F.sum("value"), 4).alias("cost"), F.count("*").alias("calls"))


@query("events", sql="""
SELECT event_type AS step, user_id % 3 AS phase, round(sum(value), 4) AS seconds, count(*) AS runs, round_even(100 * sum(value) / sum(sum(value)) OVER (), 2) AS share FROM events GROUP BY 1, 2""")  # fmt: skip
def timing_share(events: DataFrame) -> DataFrame:
    by = events.groupBy(F.col("event_type").alias("step"), (F.col("user_id") % 3).alias("phase")).agg(F.sum("value").alias("s"), F.count("*").alias("runs"))
    return by.select("step", "phase", F.round("s", 4).alias("seconds"), "runs", F.bround(100 * F.col("s") / F.sum("s").over(Window.partitionBy()), 2).alias("share"))


@query("documents", sql="""
WITH m AS (SELECT lang, median(n_chars) AS typical, count(*) AS n FROM documents GROUP BY 1)
SELECT doc_id, d.lang, n_chars, typical, n_chars < 0.25 * typical AND n >= 8 AS thin FROM documents d JOIN m ON d.lang = m.lang""")  # fmt: skip
def median_flag(documents: DataFrame) -> DataFrame:
    """Texts shorter than a quarter of the median of their group, groups of at least 8."""
    typical = medians(documents, ["lang"], F.col("n_chars"), "typical")
    per = documents.groupBy("lang").agg(F.count("*").alias("n")).join(typical, "lang", "left")
    return documents.join(per, "lang").select("doc_id", "lang", "n_chars", "typical", ((F.col("n_chars") < 0.25 * F.col("typical")) & (F.col("n") >= 8)).alias("thin"))


@query("documents", "labels", sql="""
WITH s AS (SELECT doc_id, list_sort(list(DISTINCT src)) AS sources FROM (SELECT doc_id, 'documents' AS src FROM documents UNION ALL SELECT doc_id, 'labels' FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1) GROUP BY 1)
SELECT array_to_string(sources, '+') AS sources, count(*) AS pages, count(*) FILTER (WHERE len(sources) = 1) AS only_here FROM s GROUP BY 1""")  # fmt: skip
def provenance_union(documents: DataFrame, labels: DataFrame) -> DataFrame:
    from ..operators.relational import provenance

    layers = {"documents": documents, "labels": labels.where("quality = 1"), "toxic": labels.where("toxic = 1")}
    return provenance(layers, "doc_id").groupBy(F.array_join("sources", "+").alias("sources")).agg(F.count("*").alias("pages"), F.count_if(F.size("sources") == 1).alias("only_here"))


_BOILER = """
l AS (SELECT DISTINCT doc_id, lang, trim(x) AS line FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS x FROM documents) WHERE trim(x) <> ''),
g AS (SELECT lang, count(DISTINCT doc_id) AS n FROM documents GROUP BY 1 HAVING count(DISTINCT doc_id) >= 8),
f AS (SELECT l.lang, line, count(*) AS docs FROM l JOIN g ON l.lang = g.lang GROUP BY l.lang, line, n HAVING count(*) >= greatest(5, floor({} * n)))"""


def boilerplate(documents: DataFrame, share: float = 0.75) -> DataFrame:
    """(lang, line, docs): lines on at least five texts of a language and such a share of them; groups of under 8 texts are left out."""
    size = documents.groupBy("lang").agg(F.count_distinct("doc_id").alias("n")).where("n >= 8")
    lines = documents.select("doc_id", "lang", F.explode(F.array_distinct(F.transform(F.split("text", "\n"), lambda x: F.trim(x)))).alias("line")).where("line != ''")
    counts = lines.groupBy("lang", "line").agg(F.count_distinct("doc_id").alias("docs"))
    return counts.join(size, "lang").where(F.col("docs") >= F.greatest(F.lit(5), F.floor(F.lit(share) * F.col("n")))).select("lang", "line", "docs")


@query("documents", sql=f"WITH {_BOILER.format(0.75)} SELECT * FROM f")
def boilerplate_lines(documents: DataFrame) -> DataFrame:
    return boilerplate(documents)


_SWITCH = "(length(line) <= 3 AND line = upper(line) AND line <> lower(line)) OR (NOT contains(line, ' ') AND regexp_matches(line, '^(?:Dansk|Deutsch|English|Españ|Franç|Italiano|日本語|Nederlands|Norsk|Polski|Portugu|Svenska){2,}'))"


def switcher(line: Column) -> Column:
    """Whether a line is a language code alone or the names of languages glued together."""
    names = "^(?:Dansk|Deutsch|English|Españ|Franç|Italiano|日本語|Nederlands|Norsk|Polski|Portugu|Svenska){2,}"
    code = (F.length(line) <= 3) & (line == F.upper(line)) & (line != F.lower(line))
    return code | (~F.contains(line, F.lit(" ")) & line.rlike(names))


@query("documents", sql=f"""
WITH {_BOILER.format(0.02)}, x AS (SELECT doc_id, lang, pos, trim(line) AS line FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
k AS (SELECT x.*, line <> '' AND f.line IS NULL AND NOT ({_SWITCH.replace("line", "x.line")}) AS keep FROM x LEFT JOIN f USING (lang, line))
SELECT doc_id, coalesce(sum(len(list_filter(string_split(regexp_replace(line, '\\s+', ' ', 'g'), ' '), lambda w: w <> ''))) FILTER (WHERE keep), 0)::BIGINT AS words, count(*) FILTER (WHERE keep) AS lines, count(*) FILTER (WHERE NOT keep AND line <> '') AS removed FROM k GROUP BY 1""")  # fmt: skip
def deboilerplated(documents: DataFrame) -> DataFrame:
    """What is left of each text without lines that 2 % of its language share, and without switchers.

    The published share is 75 %, which no line of these texts reaches; boilerplate_lines has that.
    """
    lines = documents.select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("pos", "raw")).withColumn("line", F.trim("raw"))
    common = boilerplate(documents, 0.02).select("lang", "line", F.lit(True).alias("common"))
    keep = (F.col("line") != "") & F.col("common").isNull() & ~switcher(F.col("line"))
    marked = lines.join(common, ["lang", "line"], "left").withColumn("keep", keep)
    words = F.sum(F.when(F.col("keep"), word_count(F.col("line"))).otherwise(0)).cast("long")
    return marked.groupBy("doc_id").agg(words.alias("words"), F.count_if("keep").alias("lines"), F.count_if(~F.col("keep") & (F.col("line") != "")).alias("removed"))


@query("orders", sql="""
PIVOT (SELECT o_orderpriority AS theme, o_orderstatus FROM orders) ON o_orderstatus IN ('F', 'O', 'P') USING count(*) GROUP BY theme""")  # fmt: skip
def theme_status_tally(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("o_orderpriority").alias("theme")).pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)


@query("lineitem", sql="""
SELECT l_partkey AS target, count(DISTINCT l_suppkey) AS fan_in FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 20""")  # fmt: skip
def fan_in_alert(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy(F.col("l_partkey").alias("target")).agg(F.count_distinct("l_suppkey").alias("fan_in")).where("fan_in > 20")


@query("conversations", sql="""
SELECT word, array_to_string(list_sort(list(DISTINCT conv_id)), ' ') AS posts FROM (SELECT conv_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}]+')) AS word FROM conversations) GROUP BY 1""")  # fmt: skip
def posting_list(conversations: DataFrame) -> DataFrame:
    found = conversations.select("conv_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{M}]+"), F.lit(0))).alias("word"))
    return found.groupBy("word").agg(F.array_join(F.array_sort(F.collect_set("conv_id")).cast("array<string>"), " ").alias("posts"))


_WORDS = "SELECT DISTINCT conv_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}]+')) AS word FROM conversations"


def posting_blocks_of(found: DataFrame, size: int = 1024) -> DataFrame:
    """(word, block, first, n, gaps) of (word, id): the ids of a word in order, those of each run of `size` ids one row, as steps from one to the next.

    A row is bounded by the size of a run, however many ids a word has; equal pairs are one before the shuffle.
    """
    held = found.where("id is not null").distinct().groupBy("word", F.floor(F.col("id") / size).alias("block")).agg(F.array_sort(F.collect_list("id")).alias("ids"))
    steps = F.zip_with(F.slice("ids", 2, size), F.slice("ids", F.lit(1), F.size("ids") - 1), lambda b, a: b - a)
    return held.select("word", "block", F.get("ids", F.lit(0)).alias("first"), F.size("ids").cast("long").alias("n"), steps.alias("gaps"))


def ids_of_block(first: Column, gaps: Column) -> Column:
    return F.aggregate(gaps, F.array(first), lambda got, step: F.concat(got, F.array(F.element_at(got, -1) + step)))


def common_ids(blocks: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, n): in how many ids both words of a pair are; blocks of the same run meet, and only those."""
    read = blocks.select("word", "block", ids_of_block(F.col("first"), F.col("gaps")).alias("ids"))
    one, two = read.toDF("a", "block", "ids_a"), read.toDF("b", "block", "ids_b")
    met = pairs.join(one, "a").join(two, ["b", "block"])
    return met.groupBy("a", "b").agg(F.sum(F.size(F.array_intersect("ids_a", "ids_b"))).cast("long").alias("n")).where("n > 0")


def _said(conversations: DataFrame) -> DataFrame:
    return conversations.select(F.col("conv_id").alias("id"), F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{M}]+"), F.lit(0))).alias("word"))


@query("conversations", sql=f"""
WITH w AS ({_WORDS}), g AS (SELECT word, conv_id, conv_id // 64 AS block, conv_id - lag(conv_id) OVER (PARTITION BY word, conv_id // 64 ORDER BY conv_id) AS gap FROM w)
SELECT word, block, min(conv_id) AS "first", count(*) AS n, coalesce(string_agg(gap::VARCHAR, ' ' ORDER BY conv_id) FILTER (WHERE gap IS NOT NULL), '') AS gaps FROM g GROUP BY 1, 2""")  # fmt: skip
def posting_blocks(conversations: DataFrame) -> DataFrame:
    """The conversations of each word in blocks, one for each 64 ids, as the first and the steps to the next."""
    return posting_blocks_of(_said(conversations), 64).withColumn("gaps", F.array_join(F.col("gaps").cast("array<string>"), " "))


@query("conversations", sql=f"""
WITH w AS ({_WORDS}), t AS (SELECT word FROM w GROUP BY 1 ORDER BY count(*) DESC, word LIMIT 12)
SELECT x.word AS a, y.word AS b, count(*) AS n FROM w x JOIN w y ON x.conv_id = y.conv_id AND x.word < y.word WHERE x.word IN (FROM t) AND y.word IN (FROM t) GROUP BY 1, 2""")  # fmt: skip
def posting_intersections(conversations: DataFrame) -> DataFrame:
    """In how many conversations both of any two of the twelve commonest words are, by meeting their blocks."""
    blocks = written(posting_blocks_of(_said(conversations), 64))
    top = blocks.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(12).select(F.col("word").alias("a"))
    return common_ids(blocks, top.join(top.select(F.col("a").alias("b")), F.col("a") < F.col("b")))


@query("conversations")
def posting_list_all(conversations: DataFrame) -> DataFrame:
    """The same as posting_list; tested against Python."""
    found = conversations.select("conv_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{M}]+"), F.lit(0))).alias("word"))
    return found.groupBy("word").agg(F.array_join(F.array_sort(F.collect_set("conv_id")).cast("array<string>"), " ").alias("posts"))
