"""URL keys and what is read out of HTML."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.text import html_to_text as plain_text
from .registry import query

_BARE = "regexp_replace(trim(url), '#.*$', '')"
_HOST = rf"regexp_replace(lower(regexp_extract({_BARE}, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?:]*)', 1)), '^www\.', '')"
_PATH = f"regexp_replace(regexp_extract({_BARE}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '')"
_ROOTED = f"CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END"
_ESCAPE = "'%[0-9A-Fa-f]{2}'"


def _escaped(path: str, replace: str) -> str:
    """SQL of a path with each escape e replaced."""
    rest, found = f"regexp_split_to_array({path}, {_ESCAPE})", f"list_transform(regexp_extract_all({path}, {_ESCAPE}), lambda e: {replace})"
    return f"array_to_string(list_transform({rest}, lambda part, i: part || coalesce(({found})[i], '')), '')"


_RAISED = _escaped(f"({_ROOTED})", "upper(e)")
_QUERY = rf"string_split(regexp_extract({_BARE}, '\?(.*)$', 1), '&')"
_NAME = "regexp_extract(p, '^([^=]*)', 1)"
_TRACKED = ", ".join(f"'{t}'" for t in U.TRACKING)
_BEGINS = " OR ".join(f"starts_with(lower(x.k), '{t}')" for t in U.TRACKING_PREFIXES)
LANGS = ["de", "fr", "es"]


_DIGITS = "0123456789abcdef", "0123456789ABCDEF"
_DIGIT = "substr('{}', (1 + page_id // {} % 16)::INT, 1)"
_ESCAPING = "SELECT page_id, regexp_replace(url, '^([^:]*://[^/?#]*)', '\\1/%' || {} || {} || '%' || {} || {}) AS url FROM pages".format(*(_DIGIT.format(_DIGITS[d], k) for d, k in ((0, 16), (1, 1), (1, 1), (0, 16))))


def _escaping():
    """URLs with two escapes behind their host, told by the page's id, with one digit in small letters and one in capitals."""
    digit = lambda case, k: F.substr(F.lit(_DIGITS[case]), (1 + F.floor(F.col("page_id") / k) % 16).cast("int"), F.lit(1))
    put = F.concat(F.lit("$1/%"), digit(0, 16), digit(1, 1), F.lit("%"), digit(1, 1), digit(0, 16))
    return F.regexp_replace("url", F.lit("^([^:]*://[^/?#]*)"), put)


@query("pages", sql=rf"""
WITH k AS (SELECT page_id, {_HOST} AS h, {_RAISED} AS p0, list_filter({_QUERY}, lambda p: p <> '' AND {_NAME} NOT IN ({_TRACKED})) AS q FROM ({_ESCAPING})),
u AS (SELECT *, list_filter(q, lambda p, i: NOT list_contains(list_transform(q[1:i - 1], lambda o: regexp_extract(o, '^([^=]*)', 1)), {_NAME})) AS one FROM k)
SELECT page_id, 'https://' || h || p0 || CASE WHEN len(one) > 0 THEN '?' || array_to_string(one, '&') ELSE '' END AS match_key FROM u""")  # fmt: skip
def url_match_key(pages: DataFrame) -> DataFrame:
    """The key of each URL, with two escapes put behind its host, of all 256 and in any letters."""
    return pages.select("page_id", U.match_key(_escaping()).alias("match_key"))


@query("pages", sql=rf"""
WITH k AS (SELECT page_id, {_HOST} AS h, {_ROOTED} AS p0, list_transform(list_filter({_QUERY}, lambda p: p <> ''), lambda p: struct_pack(k := url_decode(replace({_NAME}, '+', ' ')), v := url_decode(replace(regexp_extract(p, '=(.*)$', 1), '+', ' ')))) AS q FROM pages),
s AS (SELECT page_id, h, p0, list_sort(list_filter(q, lambda x: NOT ({_BEGINS}))) AS q FROM k)
SELECT page_id, h || p0 || CASE WHEN len(q) > 0 THEN '?' || array_to_string(list_transform(q, lambda x: replace(url_encode(x.k) || '=' || url_encode(x.v), '%20', '+')), '&') ELSE '' END AS canon FROM s""")  # fmt: skip
def url_canon(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", U.canon_url(F.col("url")).alias("canon"))


_WAY = f"regexp_extract({_BARE}, '^[^:]*://[^/?]*([^?]*)', 1)"
_SPELLED = "CASE WHEN regexp_matches(chr(('0x' || e[2:3])::INT), '[A-Za-z0-9._~-]') THEN chr(('0x' || e[2:3])::INT) ELSE upper(e) END"


@query("pages", sql=rf"""
SELECT page_id, lower(regexp_extract({_BARE}, '^([^:]*)', 1)) || '://' || lower(regexp_extract({_BARE}, '^[^:]*://([^/?]*)', 1))
  || CASE WHEN {_WAY} = '' THEN '/' ELSE {_escaped(_WAY, _SPELLED)} END || regexp_extract({_BARE}, '(\?.*)$', 1) AS stored FROM ({_ESCAPING})""")  # fmt: skip
def url_stored(pages: DataFrame) -> DataFrame:
    """The form that is kept, of URLs with two escapes behind their host; the SQL leaves out dot segments and ports, which a test has."""
    return pages.select("page_id", U.stored(_escaping()).alias("stored"))


@query("pages", sql=rf"""
SELECT page_id, lower(list_filter(string_split({_PATH}, '/'), lambda s: s <> '')[1]) AS locale FROM pages WHERE lower(list_filter(string_split({_PATH}, '/'), lambda s: s <> '')[1]) IN ('de', 'fr', 'es')""")  # fmt: skip
def locale_filter(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", U.locale(F.col("url"), LANGS).alias("locale")).where("locale is not null")


@query("pages", sql=rf"""
SELECT page_id, {_HOST} AS host, coalesce(list_filter(string_split({_PATH}, '/'), lambda s: s <> '')[-1], '')[:60] AS label, {_HOST} = 'thther.example.org' AS own FROM pages""")  # fmt: skip
def url_parts(pages: DataFrame) -> DataFrame:
    url = F.col("url")
    return pages.select("page_id", U.host(url).alias("host"), F.left(F.coalesce(F.try_element_at(U.segments(url), F.lit(-1)), F.lit("")), F.lit(60)).alias("label"), (U.host(url) == "thther.example.org").alias("own"))


@query("pages", sql=rf"""
WITH p AS (SELECT url, regexp_extract({_BARE}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1) AS path FROM pages)
SELECT CASE WHEN regexp_matches(path, '{U.PROTOCOL_FILE}') OR regexp_matches(path, '{U.ASSET}') OR regexp_matches(path, '{U.MACHINE}') THEN 'other' WHEN contains(url, '?') THEN 'query' ELSE 'content' END AS kind, count(*) AS n FROM p GROUP BY 1""")  # fmt: skip
def content_urls(pages: DataFrame) -> DataFrame:
    u = F.col("url")
    kind = F.when(U.not_content(u), "other").when(F.contains(u, F.lit("?")), "query").otherwise("content")
    return pages.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


_STOPPED = ", ".join(f"'{w}'" for w in U.SLUG_STOP)


@query("part", sql=rf"""
WITH w AS (SELECT p_partkey, list_filter(regexp_split_to_array(regexp_replace(lower(split_part('The ' || p_name || ' and ' || p_type || ' of ' || p_brand, ':', 1)), '[^a-z0-9\s-]', ' ', 'g'), '\s+'), lambda x: x <> '') AS w FROM part),
k AS (SELECT p_partkey, list_filter(w, lambda x, i: i = 1 OR x NOT IN ({_STOPPED}))[1:5] AS k FROM w),
c AS (SELECT p_partkey, list_filter(k, lambda x, i: i = 1 OR length(array_to_string(k[1:i - 1], '-')) < 45) AS k FROM k)
SELECT p_partkey, coalesce(nullif(trim(left(array_to_string(k, '-'), 45), '-'), ''), 'topic') AS slug FROM c""")  # fmt: skip
def slugs(part: DataFrame) -> DataFrame:
    title = F.concat(F.lit("The "), "p_name", F.lit(" and "), "p_type", F.lit(" of "), "p_brand")
    return part.select("p_partkey", U.slug(title).alias("slug"))


@query("pages", sql="""
SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, lower(regexp_extract(html, '(?i)<html[^>]*lang="([A-Za-z-]+)"', 1)) AS lang, length(html) < 200 AS tiny FROM pages""")  # fmt: skip
def html_title_lang(pages: DataFrame) -> DataFrame:
    title = F.trim(F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1))
    return pages.select("page_id", title.alias("title"), F.lower(F.regexp_extract("html", '(?i)<html[^>]*lang="([A-Za-z-]+)"', 1)).alias("lang"), (F.length("html") < 200).alias("tiny"))


@query("pages", sql="""
WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<h[1-3][^>]*>.*?</h[1-3]>')) AS x FROM pages)
SELECT page_id, regexp_extract(x, '(?i)<h([1-3])', 1)::INT AS level, trim(regexp_replace(x, '<[^>]+>', '', 'g')) AS heading FROM h""")  # fmt: skip
def html_headings(pages: DataFrame) -> DataFrame:
    found = pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit("(?is)<h[1-3][^>]*>.*?</h[1-3]>"), F.lit(0))).alias("x"))
    return found.select("page_id", F.regexp_extract("x", "(?i)<h([1-3])", 1).cast("int").alias("level"), F.trim(F.regexp_replace("x", "<[^>]+>", "")).alias("heading"))


_LINKS = """SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a [^>]*href="([^"#?]*)', 1)) AS href FROM pages"""


def _links(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('(?i)<a [^>]*href="([^"#?]*)'), F.lit(1))).alias("href"))


@query("pages", sql=f"SELECT page_id, href, count(*) AS n FROM ({_LINKS}) WHERE href <> '' AND NOT regexp_matches(href, '(?i)^(mailto|javascript|tel):') GROUP BY 1, 2")
def link_extract(pages: DataFrame) -> DataFrame:
    return _links(pages).where("href != '' and not rlike(href, '(?i)^(mailto|javascript|tel):')").groupBy("page_id", "href").agg(F.count("*").alias("n"))


@query("pages", sql=f"""
WITH l AS (SELECT DISTINCT page_id, lower(regexp_replace(href, '[^A-Za-z/]', '', 'g')) AS t FROM ({_LINKS})), s AS (SELECT unnest(['/the', '/and', '/of', '/in', '/to', '/de', '/la', '/der', '/on', '/is']) AS t),
h AS (SELECT p.page_id, count(s.t) AS linked FROM pages p LEFT JOIN l ON l.page_id = p.page_id LEFT JOIN s ON s.t = l.t GROUP BY 1)
SELECT page_id, linked, CASE WHEN linked = 0 THEN 'orphaned' WHEN linked >= 4 THEN 'true' ELSE 'weak' END AS verdict FROM h""")  # fmt: skip
def hub_link_verdict(pages: DataFrame) -> DataFrame:
    """How many of ten spokes a hub links to: none is orphaned, 40 % or five are true, else weak."""
    spokes = F.array(*map(F.lit, ["/the", "/and", "/of", "/in", "/to", "/de", "/la", "/der", "/on", "/is"]))
    hrefs = F.regexp_extract_all("html", F.lit('(?i)<a [^>]*href="([^"#?]*)'), F.lit(1))
    linked = F.size(F.array_intersect(spokes, F.transform(hrefs, lambda h: F.lower(F.regexp_replace(h, "[^A-Za-z/]", "")))))
    return pages.select("page_id", linked.cast("long").alias("linked"), F.when(linked == 0, "orphaned").when((linked >= 4) | (linked >= 5), "true").otherwise("weak").alias("verdict"))


@query("pages")
def html_to_text(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", plain_text("html").alias("text"))
