"""Matching claims, keywords and names to what may support them, and stacking and choosing among sources."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls as U
from ..operators.patterns import containing, near_domains
from ..operators.ranking import numbered
from ..operators.relational import sent
from ..operators.similarity import cosine_top_k
from ..session import written
from .registry import query
from .search import trigrams

def topic_pages(keywords: DataFrame, pages: DataFrame, generic: int = 80, cap: int = 30) -> DataFrame:
    """(idea, cell): the pages of which title and URL hold every stem of one of an idea's keywords.

    keywords: (idea, pos, keyword); pages: (url, title, pos). Keywords of more than `generic` pages are left out;
    a page counts once for an idea, whatever the case of its URL or a slash at its end; `cap` pages are shown
    in order, with how many more there are. A stem of three letters or more shares its first three with the
    page, so keywords meet pages by the first three letters of their longest stem, not all by all.
    """
    tokens = F.transform(F.filter(F.regexp_extract_all(F.lower("keyword"), F.lit("[a-z0-9]+"), F.lit(0)), lambda t: F.length(t) >= 3), X.stem)
    asked = keywords.select("keyword", tokens.alias("stems")).distinct().where(F.size("stems") > 0)
    longest = F.array_max(F.transform("stems", lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))["t"]
    asked = asked.withColumn("gram", F.left(longest, F.lit(3)))
    hay = F.lower(F.concat("title", F.lit(" "), "url"))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("hay") - 2, F.lit(1))), lambda i: F.substring("hay", i, F.lit(3))))
    held = pages.select("url", "title", F.col("pos").alias("page_pos"), hay.alias("hay"))
    met = held.withColumn("gram", F.explode(grams)).join(sent(asked), "gram").where(F.forall("stems", lambda t: F.contains(F.col("hay"), t)))
    met = met.select("keyword", "url", "title", "page_pos")
    usable = met.groupBy("keyword").count().where(F.col("count") <= generic).select("keyword")
    hits = keywords.join(met.join(usable, "keyword", "left_semi"), "keyword")
    first = F.min(F.struct("pos", "page_pos", "title", "url")).alias("h")
    distinct = hits.groupBy("idea", F.lower(F.rtrim("url", F.lit("/"))).alias("key")).agg(first)
    total = F.count("*").over(Window.partitionBy("idea"))
    ranked = distinct.withColumn("total", total).withColumn("rn", F.row_number().over(Window.partitionBy("idea").orderBy("h"))).where(F.col("rn") <= cap)
    shown = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "h"))), lambda x: F.concat(x["h"]["title"], F.lit(" — "), x["h"]["url"])), "; ")
    more = F.when(F.col("total") > cap, F.concat(F.lit("; (+"), F.col("total") - cap, F.lit(" more of "), F.col("total"), F.lit(")"))).otherwise("")
    return ranked.groupBy("idea", "total").agg(shown.alias("cell")).select("idea", F.concat("cell", more).alias("cell"))


_STEMMED = f"CASE {' '.join(f'''WHEN t LIKE '%{x}' AND length(t) > {len(x) + 2} THEN left(t, -{len(x)})''' for x in X.SUFFIXES)} ELSE t END"
_TITLE = "trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1))"


@query("benchmark", "pages", sql=f"""
WITH w AS (SELECT item_id AS idea, regexp_extract_all(lower(text), '[a-z]+') AS w FROM benchmark),
k AS (SELECT idea, pos, w[4 * pos + 1] || CASE WHEN pos = 1 THEN '' ELSE ' ' || w[4 * pos + 2] END AS keyword FROM w CROSS JOIN (SELECT unnest([0, 1, 2]) AS pos)),
q AS (SELECT DISTINCT keyword, list_transform(list_filter(regexp_extract_all(lower(keyword), '[a-z0-9]+'), lambda t: length(t) >= 3), lambda t: {_STEMMED}) AS stems FROM k WHERE keyword IS NOT NULL),
p AS (SELECT url, {_TITLE} AS title, page_id AS pos, lower({_TITLE} || ' ' || url) AS hay FROM pages),
m AS (SELECT keyword, url, title, pos AS page_pos FROM q JOIN p ON len(stems) > 0 AND len(list_filter(stems, lambda t: contains(hay, t))) = len(stems)),
u AS (SELECT * FROM m WHERE keyword IN (SELECT keyword FROM m GROUP BY 1 HAVING count(*) <= 80)),
h AS (SELECT idea, lower(rtrim(url, '/')) AS key, min(struct_pack(pos := k.pos, page_pos := page_pos, title := title, url := url)) AS h FROM k JOIN u USING (keyword) GROUP BY 1, 2),
r AS (SELECT *, count(*) OVER (PARTITION BY idea) AS total, row_number() OVER (PARTITION BY idea ORDER BY h) AS rn FROM h)
SELECT idea, string_agg(h.title || ' — ' || h.url, '; ' ORDER BY rn) || CASE WHEN total > 30 THEN '; (+' || (total - 30) || ' more of ' || total || ')' ELSE '' END AS cell FROM r WHERE rn <= 30 GROUP BY idea, total""")  # fmt: skip
def topic_catalogue(benchmark: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages for three keywords of each item: two pairs of its words and a single one."""
    w = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    pick = lambda i: F.get("w", F.lit(i))
    made = F.array(F.concat(pick(0), F.lit(" "), pick(1)), pick(4), F.concat(pick(8), F.lit(" "), pick(9)))
    keywords = benchmark.select(F.col("item_id").alias("idea"), w.alias("w")).select("idea", F.posexplode(made).alias("pos", "keyword")).where("keyword is not null")
    title = F.trim(F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1))
    return topic_pages(keywords, pages.select("url", title.alias("title"), F.col("page_id").alias("pos")))


_NORM = r"trim(regexp_replace(regexp_replace(lower({}), '(\d),(\d)', '\1\2', 'g'), '[^a-z0-9%]+', ' ', 'g'))"
_GRAMS = "SELECT DISTINCT {0}, array_to_string(w[i:i+2], ' ') AS g FROM (SELECT {0}, w, unnest(range(1, len(w) - 1)) AS i FROM (SELECT {0}, list_filter(string_split({2}, ' '), lambda x: x <> '') AS w FROM {1}))"
_CARD = "text || ' in ' || (1990 + item_id) || ' about ' || (10 + item_id % 80) || ' percent'"
_SNIP = "CASE WHEN doc_id % 3 = 0 THEN text || ' in ' || (1990 + doc_id % 60) || ' about ' || (10 + doc_id % 80) || ' percent' ELSE text END"


def numeric(token: Column) -> Column:
    """Whether a word holds two digits or more."""
    return F.length(F.regexp_replace(token, "[^0-9]", "")) >= 2


@query("benchmark", "documents", sql=f"""
WITH c AS (SELECT item_id, {_CARD} AS t FROM benchmark), s AS (SELECT doc_id, {_SNIP} AS t FROM documents), a AS ({_GRAMS.format("item_id", "c", _NORM.format("t"))}), b AS ({_GRAMS.format("doc_id", "s", _NORM.format("t"))}),
m AS (SELECT item_id, doc_id, count(*) AS shared, bool_or(len(list_filter(string_split(a.g, ' '), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g')) >= 2)) > 0) AS figure FROM a JOIN b ON a.g = b.g GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id) AS rn FROM m)
SELECT item_id, doc_id, shared FROM r WHERE rn = 1 AND shared >= 3 AND figure""")  # fmt: skip
def card_sources(benchmark: DataFrame, documents: DataFrame) -> DataFrame:
    """For each card the snippet that shares most runs of three words, if it shares three at least and one of them holds a figure."""
    card = F.concat("text", F.lit(" in "), 1990 + F.col("item_id"), F.lit(" about "), 10 + F.col("item_id") % 80, F.lit(" percent"))
    added = F.concat("text", F.lit(" in "), 1990 + F.col("doc_id") % 60, F.lit(" about "), 10 + F.col("doc_id") % 80, F.lit(" percent"))
    snippets = documents.select("doc_id", F.when(F.col("doc_id") % 3 == 0, added).otherwise(F.col("text")).alias("text"))
    return by_runs(benchmark.select("item_id", card.alias("text")), snippets)


def by_runs(cards: DataFrame, texts: DataFrame) -> DataFrame:
    """(item_id, doc_id, shared): for each card the text that shares most runs of three words, the first on a tie, if three and a figure in one of them."""
    cards, snippets = trigrams(cards, "item_id"), trigrams(texts, "doc_id")
    shared = snippets.join(sent(cards.distinct()), "g").distinct().withColumn("figure", F.exists(F.split("g", " "), numeric))
    best = shared.groupBy("item_id", "doc_id").agg(F.count("*").alias("shared"), F.bool_or("figure").alias("figure"))
    top = best.groupBy("item_id").agg(F.max(F.struct("shared", -F.col("doc_id"), "doc_id", "figure")).alias("b")).select("item_id", "b.doc_id", "b.shared", "b.figure")
    return top.where("shared >= 3 and figure").select("item_id", "doc_id", "shared")


def number_windows(text: Column, pad: int = 16) -> Column:
    """The surroundings of each number of a normalised text, with two words of letters at least."""
    n, found = F.length(text), F.regexp_extract_all(text, F.lit(r"\d+%?"), F.lit(0))
    rest = F.split(text, r"\d+%?", -1)
    begins = F.transform(found, lambda m, i: F.aggregate(F.slice(rest, F.lit(1), i + 1), F.lit(0), lambda a, x: a + F.length(x)) + F.aggregate(F.slice(found, F.lit(1), i), F.lit(0), lambda a, x: a + F.length(x)))
    cut = F.transform(begins, lambda b, i: F.trim(F.substring(text, F.greatest(b - pad, F.lit(0)) + 1, F.least(b + F.length(F.get(found, i)) + pad, n) - F.greatest(b - pad, F.lit(0)))))
    return F.array_distinct(F.filter(cut, lambda w: F.size(F.filter(F.split(w, " "), lambda t: t.rlike("^[a-z]+$"))) >= 2))


_CLAIM = "CASE WHEN item_id % 2 = 0 THEN 'total cost was ' || (20 + item_id) || ' euro per month' ELSE '| Cost was | ' || (20 + item_id) || ' euro' END"
_TOLD = "CASE WHEN doc_id % 9 = 0 THEN text || ': Total cost was ' || (20 + doc_id % 97) || ' Euro per month.' ELSE text END"
_AT = r"coalesce(list_sum(list_transform(regexp_split_to_array(n, '\d+%?')[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(regexp_extract_all(n, '\d+%?')[1:i - 1], lambda x: length(x))), 0)"


@query("benchmark", "documents", sql=rf"""
WITH c AS (SELECT item_id, {_CLAIM} AS t FROM benchmark), s AS (SELECT doc_id, {_TOLD} AS t FROM documents), a AS ({_GRAMS.format("item_id", "c", _NORM.format("t"))}), b AS ({_GRAMS.format("doc_id", "s", _NORM.format("t"))}),
m AS (SELECT item_id, doc_id, count(*) AS shared, bool_or(len(list_filter(string_split(a.g, ' '), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g')) >= 2)) > 0) AS figure FROM a JOIN b ON a.g = b.g GROUP BY 1, 2),
one AS (SELECT item_id, doc_id FROM m QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id) = 1 AND shared >= 3 AND figure),
n AS (SELECT item_id, {_NORM.format("t")} AS n FROM c ANTI JOIN one USING (item_id)), i AS (SELECT item_id, n, unnest(range(1, len(regexp_extract_all(n, '\d+%?')) + 1)) AS i FROM n),
p AS (SELECT item_id, n, i, ({_AT})::BIGINT AS b, length(regexp_extract_all(n, '\d+%?')[i]) AS k FROM i),
w AS (SELECT item_id, i, trim(substr(n, greatest(b - 16, 0) + 1, least(b + k + 16, length(n)) - greatest(b - 16, 0))) AS w FROM p),
f AS (SELECT * FROM w WHERE len(list_filter(string_split(w, ' '), lambda t: regexp_full_match(t, '[a-z]+'))) >= 2),
two AS (SELECT item_id, doc_id, w FROM f JOIN (SELECT doc_id, {_NORM.format("t")} AS n FROM s) t ON contains(t.n, w) QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY doc_id, i) = 1)
SELECT item_id, doc_id, NULL AS evidence FROM one UNION ALL SELECT * FROM two""")  # fmt: skip
def number_window_sources(benchmark: DataFrame, documents: DataFrame) -> DataFrame:
    """For each claim a text that proves it: the one that shares most runs of three words, a figure among them, or else a surrounding of a number.

    Only claims that no text matched by its runs are looked for again: the first text that holds a number of
    the claim with 16 characters on both sides, and the first such surrounding in it, is their source and evidence.
    """
    count = 20 + F.col("item_id")
    claims = benchmark.select("item_id", F.when(F.col("item_id") % 2 == 0, F.concat(F.lit("total cost was "), count, F.lit(" euro per month"))).otherwise(F.concat(F.lit("| Cost was | "), count, F.lit(" euro"))).alias("text"))
    added = F.concat("text", F.lit(": Total cost was "), 20 + F.col("doc_id") % 97, F.lit(" Euro per month."))
    texts = documents.select("doc_id", F.when(F.col("doc_id") % 9 == 0, added).otherwise(F.col("text")).alias("text"))
    matched = written(by_runs(claims, texts).select("item_id", "doc_id"))
    left = claims.join(matched, "item_id", "left_anti").select("item_id", F.posexplode(number_windows(F.trim(X.normal_number(F.col("text"))))).alias("i", "w"))
    left = written(left)
    met = containing(texts.select("doc_id", X.normal_number(F.col("text")).alias("n")), left, "doc_id", "n", "w").join(left, "w")
    first = met.groupBy("item_id").agg(F.min_by(F.struct("doc_id", "w"), F.struct("doc_id", "i")).alias("b")).select("item_id", "b.doc_id", F.col("b.w").alias("evidence"))
    return matched.withColumn("evidence", F.lit(None).cast("string")).unionByName(first)


def best_overlap(wanted: DataFrame, named: DataFrame) -> DataFrame:
    """(want, name, shared): for each text asked the name that shares most different words, the first in order on a tie."""
    words = lambda df, key, text: df.select(key, F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))).alias("word"))
    met = words(wanted, "want", "text").join(sent(words(named, "name", "name")), "word").groupBy("want", "name").agg(F.count("*").alias("shared"))
    return met.groupBy("want").agg(F.min_by(F.struct("name", "shared"), F.struct(-F.col("shared"), "name")).alias("b")).select("want", "b.name", "b.shared")


@query("documents", "part", sql="""
WITH d AS (SELECT doc_id AS want, unnest(list_distinct(regexp_extract_all(lower(text || ' ' || CASE doc_id % 3 WHEN 0 THEN 'Small Widget' WHEN 1 THEN 'cold bolt brand' ELSE '' END), '[a-z0-9]+'))) AS word FROM documents),
n AS (SELECT name, unnest(list_distinct(regexp_extract_all(lower(name), '[a-z0-9]+'))) AS word FROM (SELECT DISTINCT p_name AS name FROM part))
SELECT want, name, count(*) AS shared FROM d JOIN n USING (word) GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY want ORDER BY count(*) DESC, name) = 1""")  # fmt: skip
def fuzzy_lookup(documents: DataFrame, part: DataFrame) -> DataFrame:
    kind = F.col("doc_id") % 3
    said = F.concat(F.col("text"), F.lit(" "), F.when(kind == 0, "Small Widget").when(kind == 1, "cold bolt brand").otherwise(""))
    return best_overlap(documents.select(F.col("doc_id").alias("want"), said.alias("text")), part.select(F.col("p_name").alias("name")).distinct())


def placed(orphans: DataFrame, survivors: DataFrame) -> DataFrame:
    """(orphan, into, fallback): each orphan where it was told to go, else to the survivor that shares most tags, the lowest index on a tie.

    orphans: (orphan, chosen, tags); survivors: (index, tags). A choice that names no survivor counts as none;
    an orphan that shares no tag with any goes to the first.
    """
    index = survivors.select(F.col("index").alias("chosen"), F.lit(True).alias("known"))
    told = orphans.join(sent(index), "chosen", "left").select("orphan", "tags", F.when(F.col("known"), F.col("chosen")).alias("into"))
    tag = survivors.select("index", F.explode(F.array_distinct("tags")).alias("tag"))
    lost = told.where("into is null").select("orphan", F.explode(F.array_distinct("tags")).alias("tag"))
    best = lost.join(sent(tag), "tag").groupBy("orphan", "index").agg(F.count("*").alias("n")).groupBy("orphan").agg(F.min_by("index", F.struct(-F.col("n"), "index")).alias("best"))
    first = survivors.agg(F.min("index").alias("lowest"))
    return told.join(best, "orphan", "left").join(F.broadcast(first)).select("orphan", F.coalesce("into", "best", "lowest").alias("into"), F.col("into").isNull().alias("fallback"))


@query("supplier", "lineitem", "part", sql="""
WITH t AS (SELECT DISTINCT l_suppkey, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_quantity > 48),
o AS (SELECT s_suppkey AS orphan, CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey END AS chosen FROM supplier WHERE s_suppkey % 2 = 1),
v AS (SELECT s_suppkey AS i FROM supplier WHERE s_suppkey % 2 = 0 AND s_suppkey <= 20), k AS (SELECT orphan, i AS into_ FROM o JOIN v ON chosen = i),
n AS (SELECT orphan, i, count(*) AS n FROM o JOIN t a ON a.l_suppkey = orphan JOIN t b USING (p_brand) JOIN v ON b.l_suppkey = i GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY orphan ORDER BY count(*) DESC, i) = 1)
SELECT o.orphan, coalesce(into_, n.i, (SELECT min(i) FROM v)) AS "into", into_ IS NULL AS fallback FROM o LEFT JOIN k USING (orphan) LEFT JOIN n USING (orphan)""")  # fmt: skip
def orphan_placement(supplier: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Every second supplier placed with one of the others, by the brands that both sell most of."""
    tags = lineitem.where("l_quantity > 48").join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_suppkey").agg(F.collect_set("p_brand").alias("tags"))
    both = supplier.join(tags, F.col("s_suppkey") == F.col("l_suppkey"), "left").withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))
    orphans = both.where("s_suppkey % 2 = 1").select(F.col("s_suppkey").alias("orphan"), F.when(F.col("s_suppkey") % 3 == 0, F.col("s_nationkey").cast("long")).alias("chosen"), "tags")
    return placed(orphans, both.where("s_suppkey % 2 = 0 and s_suppkey <= 20").select(F.col("s_suppkey").alias("index"), "tags"))


def clause(text: Column) -> Column:
    """The first part of a claim that carries a number and three words; the whole claim if none does."""
    parts = F.split(text, r"(?<=[.;:])\s+|\s[–—-]\s|\|")
    fit = F.filter(parts, lambda p: p.rlike(r"\d") & (X.word_count(p) >= 3))
    return F.trim(F.coalesce(F.get(fit, F.lit(0)), text))


@query("conversations", sql=r"""
WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN text || '; costs rose by ' || (10 + turn) || ' percent | and ' || text ELSE text END AS t FROM conversations),
p AS (SELECT *, string_split(regexp_replace(regexp_replace(t, '([.;:])\s+', '\1␞', 'g'), '\s[–—-]\s|\|', '␞', 'g'), '␞') AS p FROM c)
SELECT conv_id, turn, trim(coalesce(list_filter(p, lambda x: regexp_matches(x, '\d') AND len(list_filter(string_split(regexp_replace(x, '\s+', ' ', 'g'), ' '), lambda w: w <> '')) >= 3)[1], t)) AS clause FROM p""")  # fmt: skip
def number_clauses(conversations: DataFrame) -> DataFrame:
    head = F.col("text")
    made = F.when(F.col("turn") % 2 == 0, F.concat(head, F.lit("; costs rose by "), 10 + F.col("turn"), F.lit(" percent | and "), F.col("text"))).otherwise(head)
    return conversations.select("conv_id", "turn", clause(made).alias("clause"))


def query_clean(title: Column) -> Column:
    """A title without what stands in parentheses, "untitled" if nothing is left."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(title, F.lit("")), r"\([^)]*\)", " "), r"\s+", " "))
    return F.when(bare == "", "untitled").otherwise(bare)


@query("part", sql=r"""
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'untitled' ELSE trim(regexp_replace(regexp_replace(p_name || '  (' || p_brand || ') ' || p_type, '\([^)]*\)', ' ', 'g'), '\s+', ' ', 'g')) END AS query FROM part""")  # fmt: skip
def clean_queries(part: DataFrame) -> DataFrame:
    title = F.when(F.col("p_size") % 7 == 0, F.concat(F.lit("("), "p_name", F.lit(")"))).otherwise(F.concat("p_name", F.lit("  ("), "p_brand", F.lit(") "), "p_type"))
    return part.select("p_partkey", query_clean(title).alias("query"))


@query("pages", sql=r"""
WITH p AS (SELECT page_id, lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1)) AS place FROM pages), d AS (SELECT DISTINCT regexp_extract(place, '([^.]+)\.example\.', 1) AS word FROM p WHERE page_id % 25 = 0)
SELECT page_id FROM p WHERE NOT EXISTS (SELECT 1 FROM d WHERE word <> '' AND contains(place, word))""")  # fmt: skip
def denied_hosts(pages: DataFrame) -> DataFrame:
    """Pages whose host holds none of the words of a list, which is a table: names of the sites of every 25th page."""
    placed = pages.select("page_id", F.lower(F.regexp_extract("url", "^[^:]*://([^/?#]*)", 1)).alias("place"))
    words = placed.where("page_id % 25 = 0").select(F.regexp_extract("place", r"([^.]+)\.example\.", 1).alias("word"))
    hosts = placed.select("place", F.col("place").alias("text")).distinct()
    return placed.join(containing(hosts, words, "place", "text", "word"), "place", "left_anti").select("page_id")


@query("events", sql="SELECT event_id, event_type AS intent FROM events WHERE event_type IN ('purchase', 'signup')")
def intent_filter(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin("purchase", "signup")).select("event_id", F.col("event_type").alias("intent"))


def _scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, relevance, protected): a score of 0 to 2 or none, and whether a rule protects the row."""
    score = labels.groupBy("doc_id").agg(F.max(F.col("quality") + F.col("toxic")).alias("relevance"))
    return documents.select("doc_id", "n_chars").join(score, "doc_id", "left").select("doc_id", "relevance", (F.col("n_chars") > 4000).alias("protected"))


_SCORED = "s AS (SELECT d.doc_id, n_chars > 4000 AS protected, relevance FROM documents d LEFT JOIN (SELECT doc_id, max(quality + toxic) AS relevance FROM labels GROUP BY 1) l ON l.doc_id = d.doc_id)"


@query("documents", "labels", sql=f"WITH {_SCORED} SELECT doc_id, relevance IS NULL AS unscored FROM s WHERE protected OR relevance IS NULL OR relevance > 0")
def score_filter(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Drops what is scored low and not protected; what has no score stays."""
    kept = _scored(documents, labels).where("protected or relevance is null or relevance > 0")
    return kept.select("doc_id", F.col("relevance").isNull().alias("unscored"))


@query("documents", "labels", sql=f"""
WITH {_SCORED}, n AS (SELECT count(*) AS total, count(*) FILTER (WHERE NOT protected AND relevance = 0) AS dropped, count(*) FILTER (WHERE relevance IS NULL) AS unscored FROM s)
SELECT total, dropped, unscored, round_even(100.0::DOUBLE * dropped / total, 2) AS dropped_pct, round_even(100.0::DOUBLE * unscored / total, 2) AS unscored_pct, 100.0::DOUBLE * dropped / total > 15 OR 100.0::DOUBLE * unscored / total > 15 AS flag FROM n""")  # fmt: skip
def drop_rate_flag(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """How much a filter drops and how much it never scored; a flag if either is over 15 %."""
    low = ~F.col("protected") & (F.col("relevance") == 0)
    n = _scored(documents, labels).agg(F.count("*").alias("total"), F.count_if(low).alias("dropped"), F.count_if(F.col("relevance").isNull()).alias("unscored"))
    pct = lambda c: F.when(F.col("total") > 0, 100.0 * F.col(c) / F.col("total")).otherwise(0.0)
    return n.select("total", "dropped", "unscored", F.bround(pct("dropped"), 2).alias("dropped_pct"), F.bround(pct("unscored"), 2).alias("unscored_pct"), ((pct("dropped") > 15) | (pct("unscored") > 15)).alias("flag"))


@query("part", sql="""
SELECT p_partkey, row_number() OVER (ORDER BY CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'PROMO' THEN 1 WHEN 'STANDARD' THEN 2 ELSE 5 END, -(greatest(len(regexp_split_to_array(p_name || CASE WHEN p_size % 4 = 0 THEN '; two, three and four' ELSE '' END, '[;,]| and ')), 1) * (p_size % 3 + 1)),
  CASE p_brand WHEN 'Brand#1' THEN 0 WHEN 'Brand#2' THEN 1 WHEN 'Brand#3' THEN 2 ELSE 1 END, p_partkey) AS place FROM part""")  # fmt: skip
def evidence_rank(part: DataFrame) -> DataFrame:
    """Ideas by fit, then by how much evidence they have times how beatable they are, then by effort."""
    fit = F.when(F.col("p_type") == "ECONOMY", 0).when(F.col("p_type") == "PROMO", 1).when(F.col("p_type") == "STANDARD", 2).otherwise(5)
    example = F.concat("p_name", F.when(F.col("p_size") % 4 == 0, "; two, three and four").otherwise(""))
    strength = F.greatest(F.size(F.split(example, "[;,]| and ")), F.lit(1)) * (F.col("p_size") % 3 + 1)
    effort = F.when(F.col("p_brand") == "Brand#1", 0).when(F.col("p_brand") == "Brand#2", 1).when(F.col("p_brand") == "Brand#3", 2).otherwise(1)
    ideas = part.select("p_partkey", fit.alias("fit"), (-strength).alias("weak"), effort.alias("effort"))
    return numbered(ideas, [], ["fit", "weak", "effort", "p_partkey"], "place").select("p_partkey", F.col("place").cast("long").alias("place"))


@query("orders", sql="""
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O' ORDER BY CASE left(o_orderpriority, 1) WHEN '1' THEN 0 WHEN '2' THEN 1 ELSE 2 END, o_orderdate, o_orderkey LIMIT 1""")  # fmt: skip
def next_eligible(orders: DataFrame) -> DataFrame:
    """The one row to take next: open ones by urgency, the oldest first."""
    urgency = F.when(F.left("o_orderpriority", F.lit(1)) == "1", 0).when(F.left("o_orderpriority", F.lit(1)) == "2", 1).otherwise(2)
    return orders.where("o_orderstatus = 'O'").orderBy(urgency, "o_orderdate", "o_orderkey").limit(1).select("o_orderkey", "o_orderpriority")


_FLATTED = "regexp_replace({}, '[.-]', '', 'g')"


@query("pages", sql=rf"""
WITH h AS (SELECT DISTINCT regexp_replace(lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1)), '^www\.', '') AS host FROM pages), d AS (SELECT regexp_replace(host, '\.(com|net|org)$', '') AS dead FROM h WHERE length(host) % 3 = 0)
SELECT dead, min(host) AS live FROM d JOIN h ON host <> dead AND (starts_with({_FLATTED.format("host")}, {_FLATTED.format("dead")}) OR starts_with({_FLATTED.format("dead")}, split_part({_FLATTED.format("host")}, 'com', 1))
  OR length(replace(split_part(dead, '.', 1), '-', '')) >= 4 AND starts_with({_FLATTED.format("host")}, replace(split_part(dead, '.', 1), '-', ''))) GROUP BY 1""")  # fmt: skip
def domain_repair(pages: DataFrame) -> DataFrame:
    """For each dead domain the first live one that is plainly its own; the dead ones are the stated set that is asked."""
    live = pages.select(U.host(F.col("url")).alias("live")).distinct()
    dead = live.where(F.length("live") % 3 == 0).select(F.regexp_replace("live", r"\.(com|net|org)$", "").alias("dead")).distinct()
    return near_domains(dead, live)


#: The columns of an idea.
IDEA = [
    "Sources", "Brand fit", "Asset", "Format", "Tool escalation", "Distinct angle", "What it'd be",
    "# pages", "# words", "Total domains", "# comps", "# posts", "Beatability", "Effort", "Proof URLs",
    "RAG candidates", "Topic pages we own", "Reference links", "Reuse verdict", "Chosen links", "Why",
]


def mapped(df: DataFrame, columns: list[str], **values: Column) -> DataFrame:
    """df as a table of these columns of text, "" where no value is given or it is null; values by column name."""
    return df.select(*[F.coalesce(values[c].cast("string"), F.lit("")).alias(c) if c in values else F.lit("").alias(c) for c in columns])


@query("part", "supplier", "conversations", sql="""
SELECT * FROM (SELECT 'M1' AS Sources, p_type AS fit, CASE WHEN p_size % 9 = 0 THEN ' ' ELSE p_name END AS asset, p_brand AS format, '' AS angle, p_size::VARCHAR AS pages FROM part
UNION ALL SELECT 'M2', CASE WHEN s_nationkey < 12 THEN 'CORE' ELSE 'SKIP' END, s_name, '', '', '' FROM supplier
UNION ALL SELECT 'M3', role, CASE WHEN turn = 1 THEN '' ELSE text END, '', trim('[' || conv_id || '] ' || turn), '' FROM conversations) WHERE trim(asset) <> ''""")  # fmt: skip
def stacked_ideas(part: DataFrame, supplier: DataFrame, conversations: DataFrame) -> DataFrame:
    """Three sources of ideas in one table, without those that have no asset."""
    c = F.col
    m1 = mapped(part, IDEA, **{"Sources": F.lit("M1"), "Brand fit": c("p_type"), "Asset": F.when(c("p_size") % 9 == 0, " ").otherwise(c("p_name")), "Format": c("p_brand"), "# pages": c("p_size")})
    m2 = mapped(supplier, IDEA, **{"Sources": F.lit("M2"), "Brand fit": F.when(c("s_nationkey") < 12, "CORE").otherwise("SKIP"), "Asset": c("s_name")})
    angle = F.trim(F.concat(F.lit("["), c("conv_id"), F.lit("] "), c("turn")))
    m3 = mapped(conversations, IDEA, **{"Sources": F.lit("M3"), "Brand fit": c("role"), "Asset": F.when(c("turn") == 1, "").otherwise(F.col("text")), "Distinct angle": angle})
    ideas = m1.unionByName(m2).unionByName(m3).where(F.trim("Asset") != "")
    return ideas.select("Sources", F.col("Brand fit").alias("fit"), F.col("Asset").alias("asset"), F.col("Format").alias("format"), F.col("Distinct angle").alias("angle"), F.col("`# pages`").alias("pages"))


_BLANK = ", ".join(f"'' AS \"{c}\"" for c in IDEA[15:])
_NAMED = lambda *values: ", ".join(f"coalesce(({v})::VARCHAR, '') AS \"{c}\"" for c, v in zip(IDEA, values))


@query("part", "supplier", "conversations", sql=f"""
SELECT * FROM (SELECT {_NAMED("'M1'", "p_type", "CASE WHEN p_size % 9 = 0 THEN ' ' ELSE p_name END", "p_name", "CASE WHEN p_size % 2 = 0 THEN p_brand END", "p_brand", "''", "p_size", "p_size * 10", "p_partkey % 90", "p_size % 7", "''", "''", "''", "'https://p/' || p_partkey")}, {_BLANK} FROM part
UNION ALL SELECT {_NAMED("'M2'", "CASE WHEN s_nationkey < 12 THEN 'CORE' ELSE 'SKIP' END", "s_name", "'list'", "''", "s_suppkey % 3", "s_name || '!'", "''", "''", "''", "''", "''", "s_nationkey % 4", "CASE WHEN s_suppkey % 5 <> 0 THEN 'low' END", "'https://s/' || s_suppkey")}, {_BLANK} FROM supplier
UNION ALL SELECT {_NAMED("'M3'", "role", "CASE WHEN turn = 1 THEN '' ELSE text END", "''", "''", "trim(CASE WHEN turn % 2 = 0 THEN '[' || conv_id || '] ' ELSE '' END || CASE WHEN turn % 3 = 0 THEN '' ELSE role END)", "turn % 4", "''", "''", "''", "''", "conv_id % 8", "''", "''", "'https://c/' || conv_id")}, {_BLANK} FROM conversations)
WHERE trim("Asset") <> ''""")  # fmt: skip
def stacked_columns(part: DataFrame, supplier: DataFrame, conversations: DataFrame) -> DataFrame:
    """Three sources in the 21 columns of an idea, each with what it has of them; rows without an asset go."""
    c, x = F.col, F.lit
    m1 = mapped(part, IDEA, **{
        "Sources": x("M1"), "Brand fit": c("p_type"), "Asset": F.when(c("p_size") % 9 == 0, " ").otherwise(c("p_name")), "Format": c("p_name"), "Tool escalation": F.when(c("p_size") % 2 == 0, c("p_brand")), "Distinct angle": c("p_brand"),
        "# pages": c("p_size"), "# words": c("p_size") * 10, "Total domains": c("p_partkey") % 90, "# comps": c("p_size") % 7, "Proof URLs": F.concat(x("https://p/"), "p_partkey"),
    })
    m2 = mapped(supplier, IDEA, **{
        "Sources": x("M2"), "Brand fit": F.when(c("s_nationkey") < 12, "CORE").otherwise("SKIP"), "Asset": c("s_name"), "Format": x("list"), "Distinct angle": c("s_suppkey") % 3, "What it'd be": F.concat("s_name", x("!")),
        "Beatability": c("s_nationkey") % 4, "Effort": F.when(c("s_suppkey") % 5 != 0, "low"), "Proof URLs": F.concat(x("https://s/"), "s_suppkey"),
    })
    angle = F.trim(F.concat(F.when(c("turn") % 2 == 0, F.concat(x("["), "conv_id", x("] "))).otherwise(""), F.when(c("turn") % 3 == 0, "").otherwise(c("role"))))
    m3 = mapped(conversations, IDEA, **{
        "Sources": x("M3"), "Brand fit": c("role"), "Asset": F.when(c("turn") == 1, "").otherwise(c("text")), "Distinct angle": angle, "What it'd be": c("turn") % 4, "# posts": c("conv_id") % 8, "Proof URLs": F.concat(x("https://c/"), "conv_id"),
    })
    return m1.unionByName(m2).unionByName(m3).where(F.trim("Asset") != "")


@query("customer", "nation", sql="""
WITH kept AS (SELECT n_name AS name FROM nation WHERE n_nationkey % 4 <> 0), told AS (SELECT n_name AS name, [lower(n_name), substr(n_name, 1, 3)] AS aliases FROM nation WHERE n_nationkey % 8 = 0), asked AS (SELECT DISTINCT lower(n_name) AS alias FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT name, FALSE AS added FROM kept UNION ALL SELECT DISTINCT name, TRUE FROM (SELECT name, unnest(aliases) AS alias FROM told) t WHERE alias IN (SELECT alias FROM asked) AND name NOT IN (SELECT name FROM kept)""")  # fmt: skip
def added_by_alias(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """What was kept, and what was left out but is asked for under one of its names."""
    kept = nation.where("n_nationkey % 4 != 0").select(F.col("n_name").alias("name"))
    told = nation.where("n_nationkey % 8 = 0").select(F.col("n_name").alias("name"), F.explode(F.array(F.lower("n_name"), F.substring("n_name", 1, 3))).alias("alias"))
    asked = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.lower("n_name").alias("alias")).distinct()
    back = told.join(asked, "alias", "left_semi").join(kept, "name", "left_anti").select("name").distinct()
    return kept.withColumn("added", F.lit(False)).union(back.withColumn("added", F.lit(True)))


@query("embeddings", sql="""
WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), n AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS l FROM u),
s AS (SELECT q.vec_id AS query_id, r.vec_id, round(list_dot_product(q.v, r.v) / (q.l * r.l), 6) AS sim FROM n q JOIN n r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id),
t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rn FROM s QUALIFY rn <= 40),
x AS (SELECT *, CASE WHEN query_id % 40 = 0 THEN (vec_id * 37 % 101) / 100.0::DOUBLE END AS outer_score FROM t)
SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY coalesce(outer_score, sim) DESC, rn) AS place, coalesce(outer_score, 0.0) AS score FROM x QUALIFY place <= 15""")  # fmt: skip
def reranked(embeddings: DataFrame) -> DataFrame:
    """Fifteen of the forty nearest by a score from outside; where a query got none, in the order of likeness with score 0."""
    near = cosine_top_k(embeddings.where("vec_id % 20 = 0"), embeddings, 40, "vec_id", "embedding")
    scored = near.withColumn("outer_score", F.when(F.col("query_id") % 40 == 0, F.col("vec_id") * 37 % 101 / 100.0))
    w = Window.partitionBy("query_id").orderBy(F.desc(F.coalesce("outer_score", "sim")), "rn")
    return scored.withColumn("place", F.row_number().over(w)).where("place <= 15").select("query_id", "vec_id", "place", F.coalesce("outer_score", F.lit(0.0)).alias("score"))


@query("pages", sql=r"""
WITH p AS (SELECT page_id, url, CASE page_id % 5 WHEN 0 THEN 'homepage' WHEN 1 THEN 'pricing' WHEN 2 THEN 'product' ELSE 'other' END AS kind FROM pages)
SELECT page_id, CASE WHEN kind = 'other' THEN 'kind is other' WHEN contains(url, '/en/4') THEN 'leaf page' WHEN regexp_matches(url, '(?i)/(fr|pricing-new)/') THEN 'duplicate' WHEN regexp_matches(url, '(?i)how-to-|top-\d|\.html$') THEN 'article' END AS why,
  CASE WHEN kind = 'other' OR contains(url, '/en/4') OR regexp_matches(url, '(?i)/(fr|pricing-new)/') OR regexp_matches(url, '(?i)how-to-|top-\d|\.html$') THEN NULL
  ELSE row_number() OVER (PARTITION BY (kind = 'other' OR contains(url, '/en/4') OR regexp_matches(url, '(?i)/(fr|pricing-new)/') OR regexp_matches(url, '(?i)how-to-|top-\d|\.html$')) ORDER BY kind <> 'homepage', -(page_id * 37 % 101), page_id) END AS place FROM p""")  # fmt: skip
def link_targets(pages: DataFrame) -> DataFrame:
    """Pages that an ending may link to, in order, and why the others are left out: first reason only."""
    u, k = F.col("url"), F.col("page_id") % 5
    kind = F.when(k == 0, "homepage").when(k == 1, "pricing").when(k == 2, "product").otherwise("other")
    rows = pages.select("page_id", kind.alias("kind"), (-(F.col("page_id") * 37 % 101)).alias("traffic"), "url")
    why = F.when(F.col("kind") == "other", "kind is other").when(F.contains(u, F.lit("/en/4")), "leaf page").when(u.rlike("(?i)/(fr|pricing-new)/"), "duplicate").when(u.rlike(r"(?i)how-to-|top-\d|\.html$"), "article")
    judged = rows.select("page_id", (F.col("kind") != "homepage").alias("later"), "traffic", why.alias("why"))
    kept = numbered(judged.where("why is null"), [], ["later", "traffic", "page_id"], "place").select("page_id", "why", F.col("place").cast("long").alias("place"))
    return kept.union(judged.where("why is not null").select("page_id", "why", F.lit(None).cast("long")))
