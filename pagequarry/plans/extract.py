"""What else is read out of pages and documents: heads, embedded JSON, tidy lines, languages, sections, tables."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.sitemaps import sitemap_kind, walk
from .registry import query

_HEAD = "regexp_extract(html, '(?is)<head[^>]*>(.*?)</head>', 1)"
_CANON = ('(?i)<link[^>]*rel="canonical"[^>]*href="([^"]*)"', '(?i)<link[^>]*href="([^"]*)"[^>]*rel="canonical"')


@query("pages", sql=f"""
WITH p AS (SELECT page_id, html, CASE WHEN page_id % 2 = 0 THEN '<html lang="xx-YY"><head><meta name="description" content=" about ' || page_id || ' "><link rel="canonical" href=" ' || url || ' "></head>' || html ELSE html END AS h FROM pages)
SELECT page_id, trim(regexp_extract(h, '(?i)<meta[^>]*name="description"[^>]*content="([^"]*)"', 1)) AS description, left(trim(regexp_extract(h, '(?i)<html[^>]*lang="([^"]*)"', 1)), 5) AS lang,
  trim(coalesce(nullif(regexp_extract({_HEAD.replace("html", "h", 1)}, '{_CANON[0]}', 1), ''), regexp_extract({_HEAD.replace("html", "h", 1)}, '{_CANON[1]}', 1))) AS canonical FROM p""")  # fmt: skip
def html_meta(pages: DataFrame) -> DataFrame:
    """Description, language and the canonical link of the head; every second page has some put in front."""
    front = F.concat(F.lit('<html lang="xx-YY"><head><meta name="description" content=" about '), F.col("page_id"), F.lit(' "><link rel="canonical" href=" '), "url", F.lit(' "></head>'), "html")
    h = pages.select("page_id", F.when(F.col("page_id") % 2 == 0, front).otherwise(F.col("html")).alias("h"))
    head = F.regexp_extract("h", "(?is)<head[^>]*>(.*?)</head>", 1)
    canonical = F.coalesce(F.nullif(F.regexp_extract(head, _CANON[0], 1), F.lit("")), F.regexp_extract(head, _CANON[1], 1))
    told = F.trim(F.regexp_extract("h", '(?i)<meta[^>]*name="description"[^>]*content="([^"]*)"', 1))
    lang = F.left(F.trim(F.regexp_extract("h", '(?i)<html[^>]*lang="([^"]*)"', 1)), F.lit(5))
    return h.select("page_id", told.alias("description"), lang.alias("lang"), F.trim(canonical).alias("canonical"))


def article_body(html: Column) -> Column:
    """The longest articleBody at any depth of a page's valid JSON-LD scripts; "" if there is none."""
    scripts = F.regexp_extract_all(html, F.lit(r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1))
    valid = F.array_join(F.filter(scripts, lambda s: F.try_parse_json(s).isNotNull()), "\n")
    found = F.regexp_extract_all(valid, F.lit(r'"articleBody"\s*:\s*("(?:[^"\\]|\\.)*")'), F.lit(1))
    bodies = F.transform(found, lambda s: F.get_json_object(F.concat(F.lit('{"b":'), s, F.lit("}")), "$.b"))
    longest = F.array_max(F.transform(bodies, lambda b, i: F.struct(F.length(b).alias("n"), (-i).alias("i"), b.alias("b"))))["b"]
    return F.trim(F.coalesce(longest, F.lit("")))


@query("benchmark", sql="""
SELECT item_id, md5(CASE WHEN item_id % 5 = 0 THEN '' WHEN length(text) > 5 THEN trim(text) ELSE 'short' END) AS body FROM benchmark""")  # fmt: skip
def json_ld_body(benchmark: DataFrame) -> DataFrame:
    """Each item's text read back out of a page made of it, where it lies deep among others; every fifth script is broken."""
    own = F.to_json(F.struct(F.col("text").alias("articleBody"), F.array(F.struct(F.lit("short").alias("articleBody"))).alias("@graph")))
    html = F.concat(F.lit('<html><script type="application/ld+json">{"@graph":[{"a":'), own, F.when(F.col("item_id") % 5 == 0, F.lit("}]]")).otherwise(F.lit("}]}")), F.lit("</script></html>"))
    return benchmark.select("item_id", F.md5(article_body(html)).alias("body"))


@query("pages", sql=r"""
WITH p AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '<html><body><div id="root"></div></body></html>' ELSE html END AS h FROM pages),
b AS (SELECT page_id, h, trim(regexp_replace(regexp_replace(regexp_extract(h, '(?is)<body[^>]*>(.*)', 1), '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS t FROM p)
SELECT page_id, regexp_matches(h, '(?i)<body') AND length(t) < 200 AND regexp_matches(h, '\sid="(root|app|__next|___gatsby)"') AS spa FROM b""")  # fmt: skip
def spa_roots(pages: DataFrame) -> DataFrame:
    """Pages whose body has hardly any text but an element that scripts fill; every third page is made into one."""
    h = pages.select("page_id", F.when(F.col("page_id") % 3 == 0, F.lit('<html><body><div id="root"></div></body></html>')).otherwise(F.col("html")).alias("h"))
    text = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("h", "(?is)<body[^>]*>(.*)", 1), "<[^>]*>", ""), r"\s+", " "))
    spa = F.col("h").rlike("(?i)<body") & (F.length(text) < 200) & F.col("h").rlike(r'\sid="(root|app|__next|___gatsby)"')
    return h.select("page_id", spa.alias("spa"))


#: Lines that page builders leave behind, and links that skip a menu.
TEMPLATE_TOKEN = r"(?i)^\s*(?:\[/?element-\d+\]|\[/?et_pb_\w+\]|\.[a-z][\w-]{2,}|#[a-z][\w-]{2,}|\{[^}]*\}|/\*.*\*/)\s*$"
SKIP_LINK = r"(?i)^\s*skip to (?:content|main)"


def tidy(text: Column) -> Column:
    """Text without builders' tokens, without what stands before the first heading or long line behind a skip link, and with single blank lines."""
    lines = F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.rtrim(F.replace(x, F.lit("\t"), F.lit(" ")))), lambda x: ~x.rlike(TEMPLATE_TOKEN))
    at = lambda some: F.array_min(some)

    def opened(lines: Column, skip: Column) -> Column:
        to = at(F.filter(F.transform(lines, lambda x, i: F.when((i > skip) & (F.startswith(F.trim(x), F.lit("#")) | (F.length(F.trim(x)) > 60)), i)), lambda i: i.isNotNull()))
        return X.held(to, lambda k: F.when(k.isNull(), lines).otherwise(F.slice(lines, F.coalesce(k, F.lit(0)) + 1, F.greatest(F.size(lines), F.lit(1)))))

    def begun(lines: Column) -> Column:
        skip = at(F.filter(F.transform(F.slice(lines, 1, 80), lambda x, i: F.when(x.rlike(SKIP_LINK), i)), lambda i: i.isNotNull()))
        return X.held(skip, lambda k: opened(lines, k))

    spaced = lambda rest: F.filter(rest, lambda x, i: (F.trim(x) != "") | ((i > 0) & (F.trim(F.get(rest, i - 1)) != "")))
    kept = X.held(X.held(lines, begun), spaced)
    return F.trim(F.array_join(F.transform(kept, lambda x: F.when(F.trim(x) == "", "").otherwise(x)), "\n"), F.lit(" \n\t"))


_TIDY_IN = "CASE doc_id % 4 WHEN 0 THEN '.hero-box' || chr(10) || 'Skip to content' || chr(10) || 'Menu' || chr(10) || text WHEN 1 THEN chr(10) || chr(10) || text || chr(10) || chr(10) || chr(10) || '[element-3]' || chr(10) || 'end' ELSE text END"


@query("documents", sql=rf"""
WITH l AS (SELECT doc_id, list_filter(list_transform(string_split({_TIDY_IN}, chr(10)), lambda x: rtrim(replace(x, chr(9), ' '))), lambda x: NOT regexp_matches(x, '{TEMPLATE_TOKEN}')) AS l FROM documents),
s AS (SELECT *, list_min(list_filter(range(1, least(80, len(l)) + 1), lambda i: regexp_matches(l[i], '{SKIP_LINK}'))) AS i FROM l),
j AS (SELECT *, list_min(list_filter(range(1, len(l) + 1), lambda k: k > i AND (starts_with(trim(l[k]), '#') OR length(trim(l[k])) > 60))) AS j FROM s),
r AS (SELECT doc_id, CASE WHEN j IS NULL THEN l ELSE l[j:] END AS r FROM j),
k AS (SELECT doc_id, list_filter(r, lambda x, i: trim(x) <> '' OR (i > 1 AND trim(r[i - 1]) <> '')) AS k FROM r)
SELECT doc_id, md5(trim(array_to_string(list_transform(k, lambda x: CASE WHEN trim(x) = '' THEN '' ELSE x END), chr(10)), ' ' || chr(9) || chr(10))) AS text FROM k""")  # fmt: skip
def tidied(documents: DataFrame) -> DataFrame:
    """Texts tidied, some of them with a menu and builders' tokens put in."""
    menu = F.concat(F.lit(".hero-box\nSkip to content\nMenu\n"), "text")
    loose = F.concat(F.lit("\n\n"), "text", F.lit("\n\n\n[element-3]\nend"))
    kind = F.col("doc_id") % 4
    return documents.select("doc_id", F.md5(tidy(F.when(kind == 0, menu).when(kind == 1, loose).otherwise(F.col("text")))).alias("text"))


def from_title(body: Column) -> Column:
    """A body from its first line with one # on, unless that is past the middle or missing."""
    before = F.regexp_extract(body, r"(?s)\A(.*?)(?:\A|(?<=\n))#\s+\S", 1)
    found = body.rlike(r"(?m)^#\s+\S")
    return F.when(found & (F.length(before) <= 0.5 * F.length(body)), F.substring(body, F.length(before) + 1, F.length(body))).otherwise(body)


@query("conversations", sql=r"""
WITH b AS (SELECT conv_id, turn, CASE conv_id % 3 WHEN 0 THEN 'Menu' || chr(10) || '# Title' || chr(10) || text WHEN 1 THEN text || chr(10) || '# Late' ELSE text END AS body FROM conversations),
m AS (SELECT *, CASE WHEN regexp_matches(body, '^#\s+\S') THEN 0 ELSE length(regexp_extract(body, '(?s)^(.*?\n)#\s+\S', 1)) END AS begins, regexp_matches(body, '(?m)^#\s+\S') AS found FROM b)
SELECT conv_id, turn, md5(CASE WHEN found AND begins <= 0.5 * length(body) THEN substr(body, begins + 1) ELSE body END) AS body FROM m""")  # fmt: skip
def preamble_trim(conversations: DataFrame) -> DataFrame:
    """Texts without what stands before their title; some get a title early or late."""
    early, late = F.concat(F.lit("Menu\n# Title\n"), "text"), F.concat("text", F.lit("\n# Late"))
    kind = F.col("conv_id") % 3
    return conversations.select("conv_id", "turn", F.md5(from_title(F.when(kind == 0, early).when(kind == 1, late).otherwise(F.col("text")))).alias("body"))


def language_key(lang: Column, url: Column) -> Column:
    """Two letters of a page's own language, else those of the first step of its path, else en."""
    own, step = F.lower(F.left(F.trim(F.coalesce(lang, F.lit(""))), F.lit(2))), F.regexp_extract(url, "^https?://[^/]+/([a-z]{2})/", 1)
    return F.coalesce(F.nullif(own, F.lit("")), F.nullif(step, F.lit("")), F.lit("en"))


@query("pages", sql=r"""
WITH p AS (SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN '' ELSE regexp_extract(html, '(?i)<html[^>]*lang="([A-Za-z-]+)"', 1) END AS lang FROM pages)
SELECT coalesce(nullif(lower(left(trim(lang), 2)), ''), nullif(regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1), ''), 'en') AS lang, count(*) AS pages FROM p GROUP BY 1""")  # fmt: skip
def language_keys(pages: DataFrame) -> DataFrame:
    """Pages by language; every second one is taken to have no language of its own."""
    told = F.when(F.col("page_id") % 2 == 0, "").otherwise(F.regexp_extract("html", '(?i)<html[^>]*lang="([A-Za-z-]+)"', 1))
    return pages.groupBy(language_key(told, F.col("url")).alias("lang")).agg(F.count("*").alias("pages"))


@query("pages", sql="""
SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'index' WHEN 1 THEN 'urlset' WHEN 2 THEN 'txt' WHEN 3 THEN 'bad' WHEN 4 THEN 'bad' ELSE 'html' END AS kind FROM pages""")  # fmt: skip
def sitemap_kinds(pages: DataFrame) -> DataFrame:
    """Kinds of documents made of the pages: an index, a list of URLs in XML and in lines, words, declared entities, the page itself."""
    u = F.col("url")
    made = [
        F.concat(F.lit('<?xml version="1.0"?>\n<sitemapindex xmlns="s"><sitemap><loc>'), u, F.lit("</loc></sitemap></sitemapindex>")),
        F.concat(F.lit('  <?xml version="1.0"?><!-- x --><urlset><url><loc>'), u, F.lit("</loc></url></urlset>")),
        F.concat(u, F.lit("\n\n"), u), F.concat(F.lit("see "), u), F.concat(F.lit("<!DOCTYPE x [<!ENTITY a 'b'>]><urlset>"), u),
    ]
    body = F.col("html")
    for k, value in enumerate(made):
        body = F.when(F.col("page_id") % 6 == k, value).otherwise(body)
    return pages.select("page_id", sitemap_kind(body).alias("kind"))


_NESTED = """
WITH RECURSIVE n AS (SELECT page_id AS k, url AS page, 'https://ex.com/sm/' || page_id || '.xml' AS sm FROM pages),
e AS (SELECT k AS src, unnest(CASE WHEN k % 10 <= 4 THEN [k + 1, k + 7, k - k % 50] WHEN k % 10 <= 6 THEN [k + 3] ELSE [] END) AS dst FROM n),
r AS (SELECT k, 0 AS depth FROM n WHERE k % 50 = 0 UNION SELECT dst, depth + 1 FROM r JOIN e ON src = k WHERE depth < {}), d AS (SELECT k, min(depth) AS depth FROM r GROUP BY 1)"""


@query("pages", sql=f"""
{_NESTED.format(6)} SELECT 'https://ex.com/sm/' || d.k || '.xml' AS sitemap, depth, CASE WHEN depth > 5 THEN 'too deep' WHEN n.k IS NULL THEN 'not fetched' WHEN d.k % 10 <= 4 THEN 'index' WHEN d.k % 10 <= 6 THEN 'urlset' WHEN d.k % 10 = 7 THEN 'txt' WHEN d.k % 10 = 8 THEN 'html' ELSE 'HTTP 404' END AS outcome
FROM d LEFT JOIN n USING (k)""")  # fmt: skip
def sitemap_visits(pages: DataFrame) -> DataFrame:
    """Every sitemap that those declared lead to, by the fewest steps, and what it turned out to be."""
    return walk(*_nested_sitemaps(pages))[0]


@query("pages", sql=f"""
{_NESTED.format(5)}, u AS (SELECT sm, depth, unnest(CASE WHEN k % 10 BETWEEN 5 AND 6 THEN [struct_pack(loc := page, lastmod := '2024-01-0' || (1 + k % 9))] WHEN k % 10 = 7 THEN [struct_pack(loc := page, lastmod := ''), struct_pack(loc := 'https://ex.com/p/' || k, lastmod := '')] ELSE [] END) AS x FROM d JOIN n USING (k))
SELECT x.loc, x.lastmod, sm AS sitemap, depth FROM u QUALIFY row_number() OVER (PARTITION BY x.loc ORDER BY depth, sm, x.lastmod) = 1""")  # fmt: skip
def sitemap_pages(pages: DataFrame) -> DataFrame:
    """The pages that the sitemaps list, each with the sitemap nearest to those declared."""
    return walk(*_nested_sitemaps(pages))[1]


def _nested_sitemaps(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A document made of each page, an index, a list, lines, the page itself or none, that names others and in a loop one before it; every 50th is declared."""
    k = F.col("page_id")
    at = lambda n: F.concat(F.lit("https://ex.com/sm/"), n, F.lit(".xml"))
    loc = lambda tag, *inner: F.concat(F.lit(f"<{tag}>\n  <loc> "), inner[0], F.lit(" </loc>"), *inner[1:], F.lit(f"</{tag}>"))
    index = F.concat(F.lit('<?xml version="1.0"?><!-- <sitemap><loc>no</loc></sitemap> --><sitemapindex xmlns="s">'), loc("sitemap", at(k + 1)), loc("sitemap", at(k + 7)), loc("sitemap", F.concat(at(k - k % 50), F.lit("/"))), F.lit("</sitemapindex>"))
    escaped = F.replace("url", F.lit("&"), F.lit("&amp;"))
    urlset = F.concat(F.lit("<s:urlset>"), loc("s:url", escaped, F.lit("<lastmod>2024-01-0"), 1 + k % 9, F.lit("</lastmod>")), loc("s:url", at(k + 3)), F.lit("</s:urlset>"))
    lines = F.concat("url", F.lit("\r\n\nhttps://ex.com/p/"), k)
    body = F.when(k % 10 <= 4, index).when(k % 10 <= 6, urlset).when(k % 10 == 7, lines).when(k % 10 == 8, F.concat(F.lit("<html>"), "html"))
    fetched = pages.select(at(k).alias("url"), F.lit(None).cast("string").alias("final_url"), F.when(k % 10 == 9, 404).otherwise(200).alias("status"), body.alias("body"))
    return fetched, pages.where(k % 50 == 0).select(at(k).alias("url"))


def sections(texts: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, pos, h1, h2, h3, line): each line of a text below the headings that hold for it.

    A heading ends those of lower levels. Windows run over the lines of one text.
    """
    lines = texts.select(*key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    mark = F.length(F.regexp_extract("line", r"^(#{1,3})\s", 1))
    w = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("level", mark).withColumn("name", F.trim(F.regexp_replace("line", r"^#{1,3}\s+", "")))
    out, above = lines, F.lit(-1)
    for level in (1, 2, 3):
        last = F.max(F.when(F.col("level") == level, F.struct("pos", "name"))).over(w)
        ended = F.max(F.when((F.col("level") > 0) & (F.col("level") < level), F.col("pos"))).over(w)
        out = out.withColumn(f"h{level}", F.when(last["pos"] > F.coalesce(ended, above), last["name"]))
    return out.where("level = 0").select(*key, "pos", "h1", "h2", "h3", "line")


_OUTLINE = "CASE WHEN pos % 7 = 0 THEN '# ' WHEN pos % 5 = 0 THEN '## ' WHEN pos % 3 = 0 THEN '### ' ELSE '' END || word"


@query("conversations", sql=f"""
WITH w AS (SELECT conv_id, turn, unnest(string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' ')) AS word, generate_subscripts(string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' '), 1) - 1 AS pos FROM conversations),
l AS (SELECT conv_id, turn, pos, word, CASE WHEN pos % 7 = 0 THEN 1 WHEN pos % 5 = 0 THEN 2 WHEN pos % 3 = 0 THEN 3 ELSE 0 END AS level FROM w),
m AS (SELECT *, max(pos) FILTER (WHERE level = 1) OVER s AS p1, max(pos) FILTER (WHERE level = 2) OVER s AS p2, max(pos) FILTER (WHERE level = 3) OVER s AS p3 FROM l WINDOW s AS (PARTITION BY conv_id, turn ORDER BY pos)),
n AS (SELECT m.*, CASE WHEN p2 > coalesce(p1, -1) THEN p2 END AS q2, CASE WHEN p3 > greatest(coalesce(p1, -1), coalesce(p2, -1)) THEN p3 END AS q3 FROM m WHERE level = 0)
SELECT n.conv_id, n.turn, coalesce(a.word, '') AS h1, coalesce(b.word, '') AS h2, coalesce(c.word, '') AS h3, count(*) AS lines FROM n LEFT JOIN l a ON a.conv_id = n.conv_id AND a.turn = n.turn AND a.pos = p1
  LEFT JOIN l b ON b.conv_id = n.conv_id AND b.turn = n.turn AND b.pos = q2 LEFT JOIN l c ON c.conv_id = n.conv_id AND c.turn = n.turn AND c.pos = q3 GROUP BY ALL""")  # fmt: skip
def section_tree(conversations: DataFrame) -> DataFrame:
    """Lines under each heading of outlines made of the texts, a word to a line, every third, fifth and seventh a heading."""
    words = F.split(F.regexp_replace("text", r"\s+", " "), " ")
    mark = lambda i: F.when(i % 7 == 0, "# ").when(i % 5 == 0, "## ").when(i % 3 == 0, "### ").otherwise("")
    made = conversations.select("conv_id", "turn", F.array_join(F.transform(words, lambda x, i: F.concat(mark(i), x)), "\n").alias("text"))
    shown = [F.coalesce(h, F.lit("")).alias(h) for h in ("h1", "h2", "h3")]
    return sections(made, ["conv_id", "turn"]).groupBy("conv_id", "turn", *shown).agg(F.count("*").alias("lines"))


@query("documents", sql=r"""
WITH l AS (SELECT doc_id, trim(unnest(string_split('| name | size |' || chr(10) || '|---|---|' || chr(10) || '| ' || source || ' | ' || n_chars || ' |' || chr(10) || '- **' || lang || '** - ' || doc_id || chr(10) || text, chr(10)))) AS line FROM documents)
SELECT doc_id, 'row' AS kind, trim(string_split(line, '|')[2]) AS a, trim(string_split(line, '|')[3]) AS b FROM l WHERE regexp_matches(line, '^\|.*\|$') AND NOT regexp_matches(line, '^[|\s:-]+$')
UNION ALL SELECT doc_id, 'item', regexp_extract(line, '^[-*]\s+\*\*(.+?)\*\*', 1), trim(regexp_extract(line, '^[-*]\s+\*\*.+?\*\*\s*[-:]?\s*(.*)$', 1)) FROM l WHERE regexp_matches(line, '^[-*]\s+\*\*.+?\*\*')""")  # fmt: skip
def markdown_rows(documents: DataFrame) -> DataFrame:
    """Rows of tables and items with a bold name out of texts, each with a small table put in front; rules between rows are left out."""
    front = F.concat(F.lit("| name | size |\n|---|---|\n| "), "source", F.lit(" | "), "n_chars", F.lit(" |\n- **"), "lang", F.lit("** - "), "doc_id", F.lit("\n"), "text")
    line = documents.select("doc_id", F.explode(F.transform(F.split(front, "\n"), lambda x: F.trim(x))).alias("line"))
    cells = F.split("line", r"\|")
    rows = line.where(F.col("line").rlike(r"^\|.*\|$") & ~F.col("line").rlike(r"^[|\s:-]+$"))
    rows = rows.select("doc_id", F.lit("row").alias("kind"), F.trim(F.get(cells, F.lit(1))).alias("a"), F.trim(F.get(cells, F.lit(2))).alias("b"))
    items = line.where(F.col("line").rlike(r"^[-*]\s+\*\*.+?\*\*"))
    name, rest = F.regexp_extract("line", r"^[-*]\s+\*\*(.+?)\*\*", 1), F.trim(F.regexp_extract("line", r"^[-*]\s+\*\*.+?\*\*\s*[-:]?\s*(.*)$", 1))
    return rows.union(items.select("doc_id", F.lit("item"), name, rest))


@query("conversations", sql=r"""
WITH s AS (SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN ' Introduction ' WHEN 1 THEN 'Conclusion and outlook' WHEN 2 THEN 'Summary' ELSE left(text, 20) END AS title FROM conversations)
SELECT conv_id, turn FROM s WHERE trim(lower(title)) <> 'introduction' AND NOT regexp_matches(trim(lower(title)), '^(conclusion|summary)')""")  # fmt: skip
def written_sections(conversations: DataFrame) -> DataFrame:
    """Sections but introductions, conclusions and summaries."""
    kind = F.col("conv_id") % 4
    title = F.when(kind == 0, " Introduction ").when(kind == 1, "Conclusion and outlook").when(kind == 2, "Summary").otherwise(F.left("text", F.lit(20)))
    name = F.trim(F.lower(title))
    return conversations.where((name != "introduction") & ~name.rlike("^(conclusion|summary)")).select("conv_id", "turn")


@query("conversations", sql=r"""
WITH o AS (SELECT conv_id, turn, 'noise' || chr(10) || '  Reuse verdict: ★ ' || CASE turn % 4 WHEN 0 THEN 'Reuse as is' WHEN 1 THEN 'partly REUSE it' WHEN 2 THEN 'New' ELSE 'maybe' END || chr(10) || 'Chosen links: https://a.b/' || conv_id || ', x' || chr(10) || 'Why: ' || text AS o FROM conversations)
SELECT conv_id, turn, CASE turn % 4 WHEN 2 THEN 'New' ELSE 'Reuse' END AS verdict, 'https://a.b/' || conv_id || ', x' AS links, trim(text) AS why
FROM conversations WHERE turn % 4 <> 3""")  # fmt: skip
def labelled_lines(conversations: DataFrame) -> DataFrame:
    """Verdict, links and reason out of answers with labelled lines; answers without a known verdict are dropped."""
    said = F.element_at(F.array(*map(F.lit, ["Reuse as is", "partly REUSE it", "New", "maybe"])), (F.col("turn") % 4 + 1).cast("int"))
    answer = F.concat(F.lit("noise\n  Reuse verdict: ★ "), said, F.lit("\nChosen links: https://a.b/"), "conv_id", F.lit(", x\nWhy: "), F.col("text"))
    rows = conversations.select("conv_id", "turn", answer.alias("answer"))
    verdict = F.lower(F.regexp_replace(F.regexp_extract("answer", r"(?im)^[ \t]*Reuse verdict:[ \t]*(.+?)[ \t]*$", 1), "^[^A-Za-z]*", ""))
    known = F.filter(F.array(F.lit("Reuse"), F.lit("New")), lambda v: F.contains(verdict, F.lower(v)))
    links = F.trim(F.regexp_extract("answer", r"(?im)^[ \t]*Chosen links:[ \t]*(.*)$", 1))
    why = F.trim(F.regexp_extract("answer", r"(?is)\bWhy:\s*(.+)$", 1))
    return rows.select("conv_id", "turn", F.get(known, F.lit(0)).alias("verdict"), links.alias("links"), why.alias("why")).where("verdict is not null")


@query("documents", sql=r"""
WITH t AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents) SELECT doc_id, CASE WHEN length(t) <= 60 THEN t ELSE regexp_replace(left(t, 60), '\s+\S*$', '') || '…' END AS clip FROM t""")  # fmt: skip
def clips(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", X.clipped(F.col("text"), 60).alias("clip"))
