"""Layers united under one key, ordered lookups, pooled rows, hubs and what is left to reach."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls as U
from ..operators.ranking import top_n
from ..operators.relational import sent
from .pages import _BARE, _HOST, _NAME, _QUERY, _RAISED, _TRACKED
from .registry import query

_KEY = f"""'https://' || {_HOST} || {_RAISED} || CASE WHEN len(list_filter({_QUERY}, lambda p: p <> '' AND {_NAME} NOT IN ({_TRACKED}))) > 0
  THEN '?' || array_to_string(list_filter({_QUERY}, lambda p: p <> '' AND {_NAME} NOT IN ({_TRACKED})), '&') ELSE '' END"""


@query("pages", sql=f"""
WITH u AS (SELECT 0 AS rank, 'cms' AS source, url, '' AS title FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT 1, 'sitemap', replace(url, 'http://', 'https://'), 'S' || page_id FROM pages WHERE page_id % 3 = 0
  UNION ALL SELECT 2, 'archive', url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_medium=a', 'A' || page_id FROM pages WHERE NOT contains(url, '#')),
k AS (SELECT *, {_KEY} AS key FROM u), p AS (SELECT key, array_to_string(list_sort(list(DISTINCT source)), ' ') AS sources, arg_min(url, (rank, url)) AS preferred, list_sort(list(DISTINCT url)) AS all_, arg_min(title, (rank, url)) FILTER (WHERE title <> '') AS title FROM k GROUP BY 1)
SELECT key, sources, preferred, array_to_string(list_filter(all_, lambda x: x <> preferred), ' ') AS aliases, title FROM p""")  # fmt: skip
def union_by_key(pages: DataFrame) -> DataFrame:
    """Three layers of URLs under one key: which layers have it, the best one's spelling, the other spellings, the first title that isn't empty.

    Of titles under one spelling in one layer the one of the least page is first.
    """

    def layer(rank, source, df, url, title):
        return df.select(F.lit(rank).alias("rank"), F.lit(source).alias("source"), url.alias("url"), title.alias("title"), "page_id")

    url, ident = F.col("url"), F.col("page_id").cast("string")
    tagged = F.concat(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit("utm_medium=a"))
    every = (
        layer(0, "cms", pages.where("page_id % 2 = 0"), url, F.lit(""))
        .union(layer(1, "sitemap", pages.where("page_id % 3 = 0"), F.replace(url, F.lit("http://"), F.lit("https://")), F.concat(F.lit("S"), ident)))
        .union(layer(2, "archive", pages.where(~F.contains(url, F.lit("#"))), tagged, F.concat(F.lit("A"), ident)))
    )
    at = F.struct("rank", "url", "page_id")
    groups = every.groupBy(U.match_key(url).alias("key")).agg(
        F.array_sort(F.collect_set("source")).alias("sources"), F.min_by("url", at).alias("preferred"), F.array_sort(F.collect_set("url")).alias("all_"),
        F.min_by(F.col("title"), F.when(F.col("title") != "", at)).alias("title"),
    )
    return groups.select("key", F.array_join("sources", " ").alias("sources"), "preferred", F.array_join(F.array_remove("all_", F.col("preferred")), " ").alias("aliases"), "title")


_HREFS = """SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '(?i)<a [^>]*href="([^"#?]*)', 1)) AS href FROM pages"""


@query("pages", sql=f"""
WITH l AS ({_HREFS}), s AS (SELECT page_id - 1 AS hub, href FROM l WHERE page_id > 0 AND length(href) % 2 = 1), n AS (SELECT hub, count(*) AS spokes, count(l.href) AS linked FROM s LEFT JOIN l ON l.page_id = hub AND l.href = s.href GROUP BY 1)
SELECT hub, spokes, linked, round_even(100.0::DOUBLE * linked / spokes, 1) AS pct, CASE WHEN linked = 0 THEN 'orphaned' WHEN linked >= 0.4 * spokes OR linked >= 5 THEN 'true' ELSE 'weak' END AS verdict FROM n""")  # fmt: skip
def hub_spokes(pages: DataFrame) -> DataFrame:
    """How many of its spokes each hub links to, and what that makes it; the spokes are a table of (hub, href), here links of the next page."""
    hrefs = F.regexp_extract_all("html", F.lit('(?i)<a [^>]*href="([^"#?]*)'), F.lit(1))
    links = pages.select("page_id", F.explode(hrefs).alias("href")).distinct()
    spokes = links.where("page_id > 0 and length(href) % 2 = 1").select((F.col("page_id") - 1).alias("hub"), "href")
    met = spokes.join(links.select(F.col("page_id").alias("hub"), "href", F.lit(1).alias("hit")), ["hub", "href"], "left")
    n = met.groupBy("hub").agg(F.count("*").alias("spokes"), F.count("hit").alias("linked"))
    verdict = F.when(F.col("linked") == 0, "orphaned").when((F.col("linked") >= 0.4 * F.col("spokes")) | (F.col("linked") >= 5), "true").otherwise("weak")
    return n.select("hub", "spokes", "linked", F.bround(100.0 * F.col("linked") / F.col("spokes"), 1).alias("pct"), verdict.alias("verdict"))


LOCALES = ["ar", "cs", "da", "de", "es", "fi", "fr", "he", "id", "it", "ja", "ko", "nl", "no", "pl", "pt", "ru", "sv", "tr", "zh"]
_CODES = ", ".join(f"'{c}'" for c in LOCALES)


@query("pages", sql=rf"""
WITH p AS (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN replace(url, '://', '://De.') ELSE url END AS url FROM pages), s AS (SELECT page_id, split_part({_HOST}, '.', 1) AS sub, len(string_split({_HOST}, '.')) > 2 AS deep, lower(list_filter(string_split({_RAISED}, '/'), lambda x: x <> '')[1]) AS step FROM p)
SELECT page_id, CASE WHEN deep AND sub IN ({_CODES}) THEN sub ELSE step END AS locale FROM s WHERE deep AND sub IN ({_CODES}) OR step IN ({_CODES})""")  # fmt: skip
def foreign_pages(pages: DataFrame) -> DataFrame:
    """Pages in another language by their sub-domain or the first step of their path; every fourth URL gets such a sub-domain."""
    url = F.when(F.col("page_id") % 4 == 0, F.replace("url", F.lit("://"), F.lit("://De."))).otherwise(F.col("url"))
    labels = F.split(U.host(url), r"\.")
    sub = F.when((F.size(labels) > 2) & labels[0].isin(LOCALES), labels[0])
    return pages.select("page_id", F.coalesce(sub, U.locale(url, LOCALES)).alias("locale")).where("locale is not null")


@query("conversations", sql=r"""
WITH q AS (SELECT conv_id, turn, text, substr(text, 11, 40) || CASE WHEN turn % 3 = 0 THEN ' not there' ELSE '' END AS quote FROM conversations)
SELECT conv_id, turn FROM q WHERE contains(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), trim(regexp_replace(lower(quote), '[^a-z0-9]+', ' ', 'g')))""")  # fmt: skip
def grounded_quotes(conversations: DataFrame) -> DataFrame:
    """Records whose quote stands in their source, whatever the case and punctuation; every third quote has words that don't."""
    quote = F.concat(F.substring("text", 11, 40), F.when(F.col("turn") % 3 == 0, " not there").otherwise(""))
    records = conversations.select("conv_id", "turn", quote.alias("quote"))
    held = records.join(conversations.select("conv_id", "turn", "text"), ["conv_id", "turn"])
    return held.where(F.contains(X.flat(F.col("text")), X.flat(F.col("quote")))).select("conv_id", "turn")


@query("orders", "part", sql="""
WITH o AS (SELECT o_orderkey, [o_orderkey * 7 % 2500, o_custkey * 3 % 2500, 5, -1] AS ids FROM orders), e AS (SELECT o_orderkey, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM o)
SELECT o_orderkey, string_agg(p_name, '; ' ORDER BY pos) AS names FROM e JOIN part ON p_partkey = id GROUP BY 1""")  # fmt: skip
def ordered_lookup(orders: DataFrame, part: DataFrame) -> DataFrame:
    """The names of a list of ids in the order of the list; ids without a name are left out."""
    ids = F.array(F.col("o_orderkey") * 7 % 2500, F.col("o_custkey") * 3 % 2500, F.lit(5).cast("long"), F.lit(-1).cast("long"))
    each = orders.select("o_orderkey", F.posexplode(ids).alias("pos", "p_partkey"))
    found = each.join(sent(part.select("p_partkey", "p_name")), "p_partkey")
    return found.groupBy("o_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "p_name"))), lambda x: x["p_name"]), "; ").alias("names"))


@query("part", sql="""
WITH m AS (SELECT p_name, p_type, count(*) AS n FROM part GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY count(*) DESC, p_type) = 1),
g AS (SELECT p_name, arg_min(p_brand, p_partkey) FILTER (WHERE p_size % 3 = 0) AS angle, sum(p_size)::BIGINT AS words, count(DISTINCT p_brand) AS hosts, median(p_size) FILTER (WHERE p_size > 10) AS middle, string_agg(p_partkey::VARCHAR, ' | ' ORDER BY p_partkey) FILTER (WHERE p_size > 45) AS proof FROM part GROUP BY 1)
SELECT g.p_name AS asset, m.p_type AS format, angle, words, hosts, middle, coalesce(proof, '') AS proof FROM g JOIN m ON m.p_name = g.p_name""")  # fmt: skip
def pooled_ideas(part: DataFrame) -> DataFrame:
    """Ideas of one name pooled: the commonest format, the first angle that isn't empty, sums, sources, a median over large ones, proofs in order."""
    counts = part.groupBy("p_name", "p_type").agg(F.count("*").alias("n"))
    mode = counts.groupBy("p_name").agg(F.min_by("p_type", F.struct(-F.col("n"), "p_type")).alias("format"))
    size = F.col("p_size")
    pooled = part.groupBy("p_name").agg(
        F.min_by("p_brand", F.when(size % 3 == 0, F.col("p_partkey"))).alias("angle"), F.sum("p_size").alias("words"), F.count_distinct("p_brand").alias("hosts"),
        F.median(F.when(size > 10, size)).alias("middle"), F.array_sort(F.collect_list(F.when(size > 45, F.col("p_partkey")))).alias("proofs"),
    )
    return pooled.join(mode, "p_name").select(F.col("p_name").alias("asset"), "format", "angle", "words", "hosts", "middle", F.array_join(F.col("proofs").cast("array<string>"), " | ").alias("proof"))


@query("documents", "labels", sql="""
WITH w AS (SELECT DISTINCT doc_id FROM documents WHERE doc_id % 2 = 0), r AS (SELECT doc_id FROM labels WHERE quality = 1 UNION SELECT doc_id FROM labels WHERE toxic = 1)
SELECT (SELECT count(*) FROM w) AS wanted, (SELECT count(*) FROM w SEMI JOIN r USING (doc_id)) AS reached, (SELECT count(*) FROM r ANTI JOIN w USING (doc_id)) AS extra, (SELECT count(*) FROM w SEMI JOIN r USING (doc_id)) >= 0.8 * (SELECT count(*) FROM w) AS trustworthy""")  # fmt: skip
def reached_ids(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """How many wanted ids two lists reach together, each counted once, and how many they hold that nobody wants."""
    want = documents.where("doc_id % 2 = 0").select("doc_id").distinct().withColumn("want", F.lit(1))
    got = labels.where("quality = 1").select("doc_id").union(labels.where("toxic = 1").select("doc_id")).distinct().withColumn("got", F.lit(1))
    n = want.join(got, "doc_id", "full_outer").agg(F.count("want").alias("wanted"), F.count(F.when(F.col("want").isNotNull(), F.col("got"))).alias("reached"), F.count_if(F.col("want").isNull()).alias("extra"))
    return n.withColumn("trustworthy", F.col("reached") >= 0.8 * F.col("wanted"))


@query("orders", sql="""
WITH r AS (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders), g AS (SELECT o_orderpriority, string_agg(o_orderkey::VARCHAR, ' ' ORDER BY rn) FILTER (WHERE rn <= 3) AS samples, count(*) AS n FROM r GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY n DESC, o_orderpriority) AS place FROM g""")  # fmt: skip
def samples_by_size(orders: DataFrame) -> DataFrame:
    """Three examples of each group, the largest group first; the last window runs over one row for each group."""
    size = orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    top = top_n(orders.select("o_orderpriority", "o_orderkey"), ["o_orderpriority"], 3, F.col("o_orderkey"))
    shown = top.groupBy("o_orderpriority").agg(F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")), " ").alias("samples"))
    return shown.join(size, "o_orderpriority").withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "o_orderpriority")))


@query("documents", "labels", sql="""
WITH v AS (SELECT d.doc_id, d.source, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN quality = 1 THEN 'good' ELSE 'bad' END AS verdict FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
c AS (SELECT source, count(*) FILTER (WHERE verdict = 'good') AS good, count(*) FILTER (WHERE verdict = 'bad') AS bad, count(*) FILTER (WHERE verdict = 'missing') AS missing FROM v GROUP BY 1),
m AS (SELECT source, doc_id // 1000 AS part, string_agg(doc_id::VARCHAR, ' ' ORDER BY doc_id) AS misses FROM v WHERE verdict = 'bad' GROUP BY 1, 2)
SELECT c.*, part, misses FROM c LEFT JOIN m ON m.source IS NOT DISTINCT FROM c.source""")  # fmt: skip
def verdict_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Verdicts of each source counted, and the ids of all that missed, those of a thousand ids to a row; sources without misses once."""
    verdict = F.when(F.col("quality").isNull(), "missing").when(F.col("quality") == 1, "good").otherwise("bad")
    v = documents.select("doc_id", "source").join(labels.select("doc_id", "quality"), "doc_id", "left").withColumn("verdict", verdict)
    counts = v.groupBy("source").agg(*[F.count_if(F.col("verdict") == k).alias(k) for k in ("good", "bad", "missing")])
    missed = v.where("verdict = 'bad'").groupBy(F.col("source").alias("of"), F.expr("doc_id div 1000").alias("part")).agg(F.array_sort(F.collect_list("doc_id")).alias("m"))
    out = counts.join(missed, F.col("source").eqNullSafe(F.col("of")), "left")
    return out.select("source", "good", "bad", "missing", "part", F.array_join(F.col("m").cast("array<string>"), " ").alias("misses"))


@query("conversations", sql="""
WITH r AS (SELECT conv_id, turn, text AS t, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn) AS rn FROM conversations WHERE role <> 'system')
SELECT conv_id, string_agg(t, ' || ' ORDER BY rn) AS body, count(*) AS n FROM r WHERE rn <= 15 GROUP BY 1""")  # fmt: skip
def joined_top(conversations: DataFrame) -> DataFrame:
    """The fifteen strongest comments of each thread as one text, the strongest first."""
    rows = conversations.where("role != 'system'").select("conv_id", F.col("text").alias("t"), F.length("text").alias("score"), "turn")
    top = top_n(rows, ["conv_id"], 15, F.desc("score"), F.col("turn"))
    return top.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "t"))), lambda x: x["t"]), " || ").alias("body"), F.count("*").alias("n"))


@query("pages", sql="""
WITH p AS (SELECT page_id, html, strlen(html) AS bytes, CASE WHEN page_id % 3 = 0 THEN strlen(html) + page_id % 2 * 10 END AS declared, page_id % 6 = 0 AS encoded FROM pages)
SELECT page_id, declared IS NOT NULL AND NOT encoded AND bytes < declared AS cut_off, NOT regexp_matches(lower(right(html, 4096)), '</html>') AS unclosed FROM p""")  # fmt: skip
def cut_off_pages(pages: DataFrame) -> DataFrame:
    """Pages with fewer bytes than they said, unless they came encoded, and pages without an end tag, which is a warning."""
    size = F.octet_length("html")
    declared = F.when(F.col("page_id") % 3 == 0, size + F.col("page_id") % 2 * 10)
    cut = F.coalesce((F.col("page_id") % 6 != 0) & (size < declared), F.lit(False))
    return pages.select("page_id", cut.alias("cut_off"), (~F.contains(F.lower(F.right("html", F.lit(4096))), F.lit("</html>"))).alias("unclosed"))


@query("documents", "labels", sql="""
WITH m AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'misc' ELSE 'q' || quality END AS t FROM labels), d AS (SELECT count(*) - count(DISTINCT doc_id) AS duplicates, count(*) FILTER (WHERE t = 'misc') AS misc, count(*) AS n FROM m)
SELECT duplicates, (SELECT count(*) FROM (SELECT DISTINCT doc_id FROM documents) x ANTI JOIN m USING (doc_id)) AS missing, (SELECT count(*) FROM (SELECT DISTINCT doc_id FROM m) y ANTI JOIN documents USING (doc_id)) AS extra, misc, n > 0 AND misc <= 0.15 * n AS misc_ok FROM d""")  # fmt: skip
def partition_coverage(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Whether each id is in one group: how many are in several, in none, or made up, and whether at most 15 % are left over."""
    m = labels.select("doc_id", (F.col("toxic") == 1).alias("misc"))
    per = m.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if("misc").alias("misc"))
    both = documents.select("doc_id").distinct().withColumn("known", F.lit(1)).join(per, "doc_id", "full_outer")
    t = both.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"), F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("known").isNull()).alias("extra"), F.coalesce(F.sum("misc"), F.lit(0)).cast("long").alias("misc"), F.coalesce(F.sum("n"), F.lit(0)).alias("all_"))
    return t.select("duplicates", "missing", "extra", "misc", ((F.col("all_") > 0) & (F.col("misc") <= 0.15 * F.col("all_"))).alias("misc_ok"))


@query("lineitem", sql="""
WITH f AS (SELECT l_partkey % 400 AS target, count(DISTINCT l_orderkey) AS fan_in FROM lineitem WHERE l_quantity > 40 GROUP BY 1) SELECT DISTINCT l_orderkey AS src, l_partkey % 400 AS target, CASE WHEN fan_in > 20 THEN 'flagged' ELSE 'collapsed' END AS state
FROM lineitem JOIN f ON f.target = l_partkey % 400 WHERE l_quantity > 40""")  # fmt: skip
def fan_in_guard(lineitem: DataFrame) -> DataFrame:
    """Canonical links, of which those to a target that over 20 pages name are flagged and not followed."""
    links = lineitem.where("l_quantity > 40").select(F.col("l_orderkey").alias("src"), (F.col("l_partkey") % 400).alias("target")).distinct()
    fan = links.groupBy("target").agg(F.count("*").alias("fan_in"))
    return links.join(fan, "target").select("src", "target", F.when(F.col("fan_in") > 20, "flagged").otherwise("collapsed").alias("state"))


@query("part", "orders", sql="""
WITH k AS (SELECT DISTINCT lower(trim(p_name)) AS kw FROM part), r AS (SELECT lower(trim(CASE WHEN o_custkey % 2 = 0 THEN ' Cold ' ELSE 'SMALL ' END || CASE o_orderkey % 3 WHEN 0 THEN 'widget' WHEN 1 THEN 'bolt' ELSE 'x' END)) AS kw, o_orderkey AS url, o_custkey % 30 + 1 AS rank FROM orders)
SELECT k.kw, arg_min(url, (rank, url)) AS url, min(rank) AS rank, min(rank) <= 10 AS ours FROM k JOIN r ON r.kw = k.kw GROUP BY 1""")  # fmt: skip
def own_rankings(part: DataFrame, orders: DataFrame) -> DataFrame:
    """Keywords for which we rank already: the best of our pages, and whether it is among the first ten."""
    said = F.concat(F.when(F.col("o_custkey") % 2 == 0, " Cold ").otherwise("SMALL "), F.when(F.col("o_orderkey") % 3 == 0, "widget").when(F.col("o_orderkey") % 3 == 1, "bolt").otherwise("x"))
    held = orders.select(F.lower(F.trim(said)).alias("kw"), F.col("o_orderkey").alias("url"), (F.col("o_custkey") % 30 + 1).alias("rank"))
    best = held.groupBy("kw").agg(F.min_by("url", F.struct("rank", "url")).alias("url"), F.min("rank").alias("rank"))
    asked = part.select(F.lower(F.trim("p_name")).alias("kw")).distinct()
    return asked.join(best, "kw").select("kw", "url", "rank", (F.col("rank") <= 10).alias("ours"))


@query("conversations", sql=r"""
WITH u AS (SELECT conv_id, turn, list_transform(regexp_extract_all('see https://A.b/' || turn || '/, https://a.b/' || turn || ' and http://c.d/' || (conv_id % 3) || '. https://A.b/' || turn, 'https?://[^\s<>"()\[\]]+'), lambda x: rtrim(x, '.,')) AS u FROM conversations)
SELECT conv_id, turn, array_to_string(list_filter(u, lambda x, i: NOT list_contains(list_transform(u[1:i - 1], lambda y: rtrim(lower(y), '/')), rtrim(lower(x), '/'))), ' ') AS urls FROM u""")  # fmt: skip
def ordered_urls(conversations: DataFrame) -> DataFrame:
    """The different URLs of a text in order of appearance, alike but for case and a slash at the end counted once."""
    t = F.col("turn").cast("string")
    text = F.concat(F.lit("see https://A.b/"), t, F.lit("/, https://a.b/"), t, F.lit(" and http://c.d/"), F.col("conv_id") % 3, F.lit(". https://A.b/"), t)
    key = lambda x: F.rtrim(F.lower(x), F.lit("/"))
    rows = conversations.select("conv_id", "turn", U.in_text(text).alias("u"))
    kept = F.filter("u", lambda x, i: ~F.array_contains(F.transform(F.slice("u", F.lit(1), i), key), key(x)))
    return rows.select("conv_id", "turn", F.array_join(kept, " ").alias("urls"))
