"""Keys and parts of URLs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import held, rewritten

#: Query parameters that only tell how a visitor came.
TRACKING = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "utm_source_platform", "utm_creative_format",
    "gclid", "gclsrc", "gbraid", "wbraid", "dclid", "fbclid", "igshid", "ttclid", "twclid", "li_fat_id",
    "msclkid", "hsa_acc", "hsa_cam", "hsa_grp", "hsa_ad", "hsa_src", "hsa_tgt", "hsa_kw", "hsa_mt", "hsa_net", "hsa_ver",
    "mc_cid", "mc_eid", "_bta_c", "_bta_tid", "vero_id", "fpr", "irclickid", "aff_id", "affiliate", "partner_id",
    "ref", "source", "srsltid", "gad_source", "campaignid", "adgroupid",
]
#: With these a tracking parameter of a variant begins.
TRACKING_PREFIXES = ["utm_", "ref", "referrer", "fbclid", "gclid", "msclkid", "mc_cid", "mc_eid", "_hsenc", "_hsmi", "hsctatracking", "igshid", "src", "source", "campaign"]
#: Words that a slug leaves out unless they come first.
SLUG_STOP = ["the", "a", "an", "of", "for", "to", "and", "by", "in", "on", "with", "your", "how", "what"]
#: Paths of protocol files, of assets and of a site's machinery.
PROTOCOL_FILE = r"(?i)(/\.well-known/|/(robots\.txt|security\.txt|ads\.txt|humans\.txt|favicon\.ico|manifest\.json|browserconfig\.xml|sitemap[\w-]*\.xml|sitemap[\w-]*\.xml\.gz)$)"
ASSET = (
    r"(?i)\.(?:png|jpe?g|gif|webp|avif|svg|ico|bmp|tiff?|woff2?|ttf|otf|eot|css|js|mjs|cjs|map|"
    r"mp4|webm|mov|avi|wmv|mp3|wav|ogg|m4a|zip|gz|tgz|tar|rar|7z|dmg|exe|pkg)$"
)
MACHINE = r"(?i)^/(?:wp-json|wp-admin|wp-includes|wp-content|xmlrpc\.php|_next/static|_nuxt|_vercel|cdn-cgi|ghost/api|admin/api|api/v\d+|graphql)(?:/|$)"


def _parts(url: Column) -> tuple[Column, Column, Column]:
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?:]*)", 1))
    path = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1)
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    return host, path, query


def path_of(url: Column) -> Column:
    return _parts(url)[1]


def host(url: Column) -> Column:
    return F.regexp_replace(_parts(url)[0], r"^www\.", "")


def _name(pair: Column) -> Column:
    return F.regexp_extract(pair, r"^([^=]*)", 1)


def _path(path: Column) -> Column:
    bare = F.regexp_replace(path, r"/+$", "")
    return F.when(bare == "", "/").otherwise(bare)


def _escapes(path: Column, replace) -> Column:
    """A path with each percent escape replaced, in one pass, so none is made of what another leaves."""
    return F.when(F.contains(path, F.lit("%")), rewritten(path, "%[0-9A-Fa-f]{2}", replace)).otherwise(path)


def match_key(url: Column) -> Column:
    """One key for spellings of one page.

    https, no www, port or fragment, no tracking parameters, of a repeated parameter the first, no slash at
    the end of a path but the root's, escapes in upper case; the order of parameters is kept.
    """
    _, path, query = _parts(url)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~_name(p).isin(TRACKING))
    kept = F.filter(kept, lambda p, i: ~F.array_contains(F.transform(F.slice(kept, F.lit(1), i), _name), _name(p)))
    path = _escapes(_path(path), F.upper)
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.concat(F.lit("https://"), host(url), path, tail)


def _form(text: Column) -> Column:
    """Form encoding in which a tilde stays and an asterisk doesn't."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _unform(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def canon_url(url: Column) -> Column:
    """host and path, and the parameters sorted, without those whose name begins like a tracking one."""
    _, path, query = _parts(url)
    tracked = lambda p: F.exists(F.array(*map(F.lit, TRACKING_PREFIXES)), lambda t: F.startswith(F.lower(p["k"]), t))
    pairs = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: F.struct(_unform(_name(p)).alias("k"), _unform(F.regexp_extract(p, r"=(.*)$", 1)).alias("v")))
    kept = F.array_sort(F.filter(pairs, lambda p: ~tracked(p)))
    shown = F.array_join(F.transform(kept, lambda p: F.concat(_form(p["k"]), F.lit("="), _form(p["v"]))), "&")
    return F.concat(host(url), _path(path), F.when(F.size(kept) > 0, F.concat(F.lit("?"), shown)).otherwise(""))


def undotted(path: Column) -> Column:
    """A path without . and .. segments; what they lead above the root for is dropped."""
    steps = F.split(path, "/")
    kept = F.aggregate(
        F.filter(steps, lambda s: s != "."), F.array().cast("array<string>"),
        lambda got, s: F.when(s != "..", F.concat(got, F.array(s))).when(F.size(got) > 1, F.slice(got, F.lit(1), F.size(got) - 1)).otherwise(got),
    )
    out = F.array_join(kept, "/")
    return F.when(F.element_at(steps, -1).isin(".", "..") & ~F.endswith(out, F.lit("/")), F.concat(out, F.lit("/"))).otherwise(out)


#: What files end in that are no pages to crawl.
BINARY = [".pdf", ".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".ico", ".css", ".js", ".zip", ".gz", ".mp3", ".mp4", ".webm", ".woff", ".woff2", ".xml", ".json"]
_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?"


def resolved(base: Column, href: Column) -> Column:
    """What a link on a page leads to: http and https alone, without fragment; null if it is none, or a file that is no page."""
    link = F.trim(href, F.lit(" \t\r\n\f"))
    scheme, place, path, query = (F.regexp_extract(link, _SPLIT, k) for k in range(1, 5))
    on_scheme, on_place, on_path, on_query = (F.regexp_extract(base, _SPLIT, k) for k in range(1, 5))
    folder = F.regexp_replace(on_path, "[^/]*$", "")
    merged = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), path))
    here = F.concat(on_place, F.when(path == "", on_path).otherwise(undotted(merged)), F.when((path == "") & (query == ""), on_query).otherwise(query))
    whole = F.when(scheme != "", F.concat(F.lower(scheme), F.lit("://"), place, path, query)).when(F.startswith(link, F.lit("//")), F.concat(F.lower(on_scheme), F.lit("://"), place, path, query)).otherwise(F.concat(F.lower(on_scheme), F.lit("://"), here))
    ends = F.lower(F.regexp_extract(whole, r"^[^:]*://[^/?]*([^?]*)", 1)).rlike("(" + "|".join(BINARY).replace(".", r"\.") + ")$")
    fits = (link != "") & ~F.startswith(link, F.lit("#")) & ((scheme == "") | F.lower(scheme).isin("http", "https") & F.startswith(F.substr(link, F.length(scheme) + 2), F.lit("//"))) & ~ends
    return F.when(fits, whole)


def stored(url: Column) -> Column:
    """A URL as it is kept: scheme and host in lower case, no default port, no dot segments, / for an empty path, no fragment.

    Escapes are in upper case, those of letters, digits and -._~ are spelled out. What has no scheme and host is only trimmed.
    """
    text = F.trim(url)
    whole = text.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+")
    bare = F.regexp_replace(text, "#.*$", "")
    scheme = F.lower(F.regexp_extract(bare, "^([^:]*)", 1))
    place = F.lower(F.regexp_extract(bare, "^[^:]*://([^/?]*)", 1))
    place = F.when(scheme == "http", F.regexp_replace(place, ":80$", "")).when(scheme == "https", F.regexp_replace(place, ":443$", "")).otherwise(place)
    path = undotted(F.regexp_extract(bare, "^[^:]*://[^/?]*([^?]*)", 1))
    char = lambda e: F.char(F.conv(F.substr(e, F.lit(2)), 16, 10).cast("int"))
    path = _escapes(path, lambda e: F.when(char(e).rlike("[A-Za-z0-9._~-]"), char(e)).otherwise(F.upper(e)))
    query = F.regexp_extract(bare, r"(\?.*)$", 1)
    return F.when(whole, F.concat(scheme, F.lit("://"), place, F.when(path == "", "/").otherwise(path), query)).otherwise(text)


def header_canonical(link: Column) -> Column:
    """The URL that a Link header names as canonical, the first if several, empty if none."""
    parts = F.filter(F.split(F.coalesce(link, F.lit("")), ","), lambda p: F.lower(p).rlike('rel="canonical"|rel=canonical'))
    named = F.filter(F.transform(parts, lambda p: F.trim(F.regexp_extract(p, "<([^>]+)>", 1))), lambda u: u != "")
    return F.coalesce(F.get(named, F.lit(0)), F.lit(""))


def not_content(url: Column) -> Column:
    """Whether a URL is a protocol file, an asset or machinery rather than a page."""
    path = path_of(url)
    return path.rlike(PROTOCOL_FILE) | path.rlike(ASSET) | path.rlike(MACHINE)


def near_domain(dead: Column, live: Column) -> Column:
    """Whether a live domain is plainly that of a dead one: alike but for dots, hyphens and what follows com, or for the ending."""
    flat = lambda d: F.regexp_replace(d, "[.-]", "")
    stem = F.replace(F.split(dead, r"\.")[0], F.lit("-"), F.lit(""))
    head = F.split(flat(live), "com")[0]
    return F.startswith(flat(live), flat(dead)) | F.startswith(flat(dead), head) | ((F.length(stem) >= 4) & F.startswith(flat(live), stem))


def segments(url: Column) -> Column:
    return F.filter(F.split(_parts(url)[1], "/"), lambda s: s != "")


def locale(url: Column, codes: list[str]) -> Column:
    """The first path segment if it is one of these language codes."""
    first = F.lower(F.get(segments(url), F.lit(0)))
    return F.when(first.isin(codes), first)


def on_domain(url: Column, domain: Column) -> Column:
    """Whether the host is the domain or lies below it."""
    return (host(url) == domain) | F.endswith(host(url), F.concat(F.lit("."), domain))


def slug(title: Column, stop: list[str] = SLUG_STOP, words: int = 5, longest: int = 45) -> Column:
    """Lower-case ASCII words before a colon, joined by hyphens; "topic" if none.

    Stop words are left out but for the first word. No word follows once there are so many or the words
    before it are so long; then the slug is cut to that length.
    """
    parts = F.filter(F.split(F.regexp_replace(F.lower(F.split(title, ":")[0]), r"[^a-z0-9\s-]", " "), r"\s+"), lambda w: w != "")
    first = F.slice(F.filter(parts, lambda w, i: (i == 0) | ~w.isin(stop)), 1, words)
    fitting = lambda k: F.filter(k, lambda w, i: (i == 0) | (F.length(F.array_join(F.slice(k, F.lit(1), i), "-")) < longest))
    named = lambda k: F.trim(F.substring(F.array_join(fitting(k), "-"), 1, longest), F.lit("-"))
    return held(held(first, named), lambda out: F.when(out == "", "topic").otherwise(out))


def suffixes(host: Column) -> Column:
    """A host and each domain above it: a.b.c, b.c, c."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def in_text(text: Column) -> Column:
    """The URLs in running text, without full stops and commas behind them."""
    return F.transform(F.regexp_extract_all(text, F.lit(r'https?://[^\s<>"()\[\]]+'), F.lit(0)), lambda u: F.rtrim(u, F.lit(".,")))
