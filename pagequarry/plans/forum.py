"""Posts and trees of comments in forum pages, and what of a page bears on a claim."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.forum import comment_rows
from .registry import query


@query("conversations", sql=r"""
SELECT conv_id, conv_id || 'x' || turn AS comment_id, CASE WHEN turn % 3 > 0 THEN conv_id || 'x' || (turn - 1) ELSE '' END AS parent_id, turn % 3 AS depth, role AS author, CASE WHEN turn % 5 <> 4 THEN turn - 2 END AS score,
  trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM conversations""")  # fmt: skip
def forum_comments(conversations: DataFrame) -> DataFrame:
    """Each conversation as a page of nested comments, three deep, and read back."""
    c = F.col
    name = F.concat("conv_id", F.lit("x"), "turn")
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    points = F.when(c("turn") % 5 != 4, F.concat(F.lit('<span class="score unvoted" title="'), c("turn") - 2, F.lit(' points">points</span>'))).otherwise("")
    opened = F.concat(
        F.lit('<div class="thing comment" data-fullname="t1_'), name, F.lit('" data-author="'), "role", F.lit('">'), points,
        F.lit('<form><div class="usertext"><div class="md"><div><p>'), escaped, F.lit('</p></div></div></div></form><div class="child">'),
    )
    closed = F.when((c("turn") % 3 == 0) & (c("turn") > 0), "</div></div>" * 3).otherwise("")
    parts = F.array_sort(F.collect_list(F.struct("turn", F.concat(closed, opened).alias("html"))))
    pages = conversations.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda p: p["html"]), "").alias("page"))
    found = pages.select("conv_id", F.explode(comment_rows("page")).alias("r"))
    return found.select("conv_id", "r.comment_id", "r.parent_id", "r.depth", "r.author", "r.score", "r.text")


def posts(pages: DataFrame, key: str, html: str) -> DataFrame:
    """One row for each scored post of a listing page: (key, post_id, subreddit, score, comment_count, flair, date, author, title, image_url, url)."""
    block = F.col("block")
    blocks = pages.select(key, F.explode(F.split(html, r'(?=<div [^>]*class="[^"]*\bthing\b)')).alias("block"))
    attr = lambda name: F.regexp_extract(block, f'data-{name}="([^"]*)"', 1)
    text = lambda pattern: F.trim(F.regexp_replace(X.unescaped(F.regexp_extract(block, pattern, 1)), r"\s+", " "))
    link, n = attr("url"), lambda name: F.coalesce(attr(name).try_cast("int"), F.lit(0))
    return blocks.where(F.contains(block, F.lit('data-fullname="t3_')) & (attr("score") != "")).select(
        key,
        F.substring(attr("fullname"), F.lit(4), F.length(attr("fullname"))).alias("post_id"),
        attr("subreddit").alias("subreddit"),
        n("score").alias("score"),
        n("comments-count").alias("comment_count"),
        text(r'class="linkflairlabel[^"]*"[^>]*title="([^"]*)"').alias("flair"),
        attr("timestamp").alias("date"),
        attr("author").alias("author"),
        text(r'class="title may-blank[^"]*"[^>]*>([^<]+)<').alias("title"),
        F.when(link.rlike(r"i\.redd\.it|i\.imgur\.com|preview\.redd\.it"), link).otherwise("").alias("image_url"),
        attr("permalink").alias("path"),
    )


@query("part", sql="""
SELECT p_partkey // 25 AS page, p_partkey::VARCHAR AS post_id, p_brand AS subreddit, p_size AS score, p_size % 4 AS comment_count, CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END AS flair, p_name || ' & "more"' AS title,
  CASE WHEN p_size % 3 = 0 THEN 'https://i.redd.it/' || p_partkey ELSE '' END AS image_url FROM part WHERE p_size % 7 <> 0""")  # fmt: skip
def forum_posts(part: DataFrame) -> DataFrame:
    """Listing pages of 25 posts made of parts and read back; a post without a score is left out."""
    c = F.col
    flair = F.when(c("p_size") % 2 == 0, F.concat(F.lit('<span class="linkflairlabel x" title="'), "p_type", F.lit('">f</span>'))).otherwise("")
    score = F.when(c("p_size") % 7 != 0, c("p_size").cast("string")).otherwise("")
    link = F.concat(F.when(c("p_size") % 3 == 0, "https://i.redd.it/").otherwise("https://x.example/"), "p_partkey")
    html = F.concat(
        F.lit('<div class="x thing link" data-fullname="t3_'), "p_partkey", F.lit('" data-subreddit="'), "p_brand", F.lit('" data-score="'), score, F.lit('" data-comments-count="'), c("p_size") % 4,
        F.lit('" data-url="'), link, F.lit('">'), flair, F.lit('<a class="title may-blank y" href="#">'), "p_name", F.lit(' &amp;\n &quot;more&quot;</a></div>'),
    )
    pages = part.groupBy(F.floor(c("p_partkey") / 25).alias("page")).agg(F.array_join(F.array_sort(F.collect_list(html)), "\n").alias("html"))
    return posts(pages, "page", "html").select("page", "post_id", "subreddit", "score", "comment_count", "flair", "title", "image_url")


def evidence_window(claim: Column, page: Column, size: int = 8000) -> Column:
    """What of a page a judge reads about a claim: its first quarter of the budget, then the surroundings of the claim's numbers.

    Places are taken by how many of the claim's words of five letters stand within 700 characters, the later
    one on a tie; those that would overlap one taken before are passed over. A page within the budget is kept
    whole, one with no such number is cut at the budget. White space is squeezed.
    """
    budget = size - size // 4
    figures = F.filter(F.array_distinct(F.regexp_extract_all(X.normal_number(claim), F.lit(r"\d+%?"), F.lit(0))), lambda n: n.rlike(r"\d\d"))
    words = F.array_distinct(F.regexp_extract_all(F.lower(claim), F.lit("[a-z]{5,}"), F.lit(0)))

    def places(low: Column, figure: Column) -> Column:
        """Where a figure stands that is no part of a longer one, counted from 0."""
        size_of = lambda parts: F.transform(parts, lambda p: F.length(p) + F.length(figure))
        parts = F.split(low, F.concat(F.lit(r"(?<!\d)"), figure, F.lit(r"(?!\d)")), -1)
        ends = F.aggregate(size_of(parts), F.array(F.lit(0)), lambda got, n: F.concat(got, F.array(F.element_at(got, -1) + n)))
        return X.held(ends, lambda e: F.transform(F.slice(e, F.lit(2), F.size(e) - 2), lambda end: end - F.length(figure)))

    def scored(low: Column, at: Column) -> Column:
        begin = F.greatest(at - 700, F.lit(0))
        count = lambda near: F.size(F.filter(words, lambda w: F.contains(near, w)))
        return F.struct((-X.held(F.substring(low, begin + 1, at + 700 - begin), count)).alias("score"), (-at).alias("at"))

    def step(text: Column, s: Column, hit: Column) -> Column:
        span = F.least(F.lit(3000), budget - s["taken"])
        begin = F.greatest(-hit["at"] - F.floor(span / 2).cast("int"), F.lit(0))
        fits = (span >= 600) & ~F.exists(s["used"], lambda u: F.abs(u - begin) < span)
        more = F.struct((s["taken"] + span).alias("taken"), F.concat(s["used"], F.array(begin)).alias("used"), F.concat(s["cuts"], F.array(F.substring(text, begin + 1, span))).alias("cuts"))
        return F.when(fits, more).otherwise(s)

    start = F.struct(F.lit(0).alias("taken"), F.array().cast("array<int>").alias("used"), F.array().cast("array<string>").alias("cuts"))

    def window(text: Column) -> Column:
        hits = X.held(F.lower(text), lambda low: F.transform(F.flatten(F.transform(figures, lambda f: places(low, f))), lambda at: scored(low, at)))
        cuts = F.aggregate(F.array_sort(hits), start, lambda s, hit: step(text, s, hit))["cuts"]
        shown = lambda c: F.when(F.size(c) > 0, F.array_join(F.concat(F.array(F.left(text, F.lit(size // 4))), c), "\n…\n")).otherwise(F.left(text, F.lit(size)))
        return F.when(F.length(text) <= size, text).otherwise(X.held(cuts, shown))

    return X.held(F.regexp_replace(F.regexp_replace(page, r"\s+", " "), "^ | $", ""), window)


@query("documents")
def evidence_windows(documents: DataFrame) -> DataFrame:
    """Windows of 2,000 characters for a claim on each text, the text with two places that hold its number."""
    figure = (F.col("doc_id") % 80 + 10).cast("string")
    claim = F.concat(F.lit("average growth reached "), figure, F.lit("% within months"))
    page = F.concat(F.lit("In "), figure, F.lit("% of cases. "), "text", F.lit(" the average growth was "), figure, F.lit("% over months. "), "text")
    return documents.select("doc_id", evidence_window(claim, page, 2000).alias("window"))


@query("pages", sql=r"""
WITH t AS (SELECT page_id, regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g') AS t FROM pages)
SELECT page_id, trim(replace(replace(replace(replace(replace(replace(replace(t, '&copy;', '©'), '&middot;', '·'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) AS text FROM t""")  # fmt: skip
def tags_stripped(pages: DataFrame) -> DataFrame:
    """Pages without tags, character references spelled out, &nbsp; as a plain space, white space squeezed."""
    bare = F.regexp_replace(F.regexp_replace("html", "<[^>]+>", " "), r"\s+", " ")
    return pages.select("page_id", F.trim(X.unescaped(F.replace(bare, F.lit("&nbsp;"), F.lit(" ")))).alias("text"))
