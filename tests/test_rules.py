"""Links against the standard library's, and phrases against a pattern for each."""

import itertools
import re
from urllib.parse import urljoin, urlsplit, urlunsplit

import numpy as np
from pyspark.sql import functions as F

from pagequarry.functions import urls as U
from pagequarry.plans.rules import first_reached, phrase_counts, tells


def test_resolved(spark):
    bases = ["http://x.com", "https://X.com/a/b/c.html?q=1#f", "http://x.com/a/", "http://x.com/a/../b/c"]
    hrefs = ["d", "/d/../e", "../d", "../../../d", "./d/.", "d/..", "?z=/../1", "//y.org/p?q#f", "http://z.net", "HTTPS://z.net/a/../b#t", "d#f", "a/b/./c?x#y", "../d/?u=http://a/b", "  d\n", "d:e/f", "ftp://x/y", "mailto:a@b", "javascript:void(0)", "tel:1", "#top", "", "/f.PDF", "/f.pdf?x=1", "p.json#a", "/a.pdf/b", "feed.xml"]
    pairs = list(itertools.product(bases, hrefs))
    got = {(r.b, r.h): r.u for r in spark.createDataFrame(pairs, "b string, h string").select("b", "h", U.resolved(F.col("b"), F.col("h")).alias("u")).collect()}
    for base, href in pairs:
        link, want = href.strip(), None
        if link and not link.startswith(("#", "mailto:", "tel:", "javascript:")):
            parts = urlsplit(urljoin(base, link))
            if parts.scheme in ("http", "https") and not parts.path.lower().endswith(tuple(U.BINARY)):
                want = urlunsplit((parts.scheme, parts.netloc, parts.path, parts.query, ""))
        assert got[base, href] == want, (base, href)


def test_header_canonical(spark):
    cases = {'<http://a>; rel="next", <http://b >; rel="canonical"': "http://b", "<http://c>; REL=canonical": "http://c", 'rel="canonical"': "", "": "", "<http://d>; rel=alternate": "", 'x rel=canonical, <http://e>; rel=canonical': "http://e"}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "h string").select("h", U.header_canonical(F.col("h")).alias("u"))
    assert {r.h: r.u for r in df.collect()} == cases | {None: ""}


def test_phrase_counts(spark):
    rng = np.random.default_rng(1)
    parts = ["cost", "per", "hire", "a", "A", "cost-per-hire", "costs", "é", "cost’s", "“per”", "10", "per.", "_"]
    texts = ["".join(str(rng.choice(parts)) + str(rng.choice([" ", "-", "  ", "\n", ", ", "–"])) for _ in range(40)) for _ in range(60)] + [None, "", "a a a a a", "a-a—a a"]
    phrases = ["cost per hire", "Cost-per-hire", "a a", "per", "a", "10", "", None, "!!", "hire a cost", "é", "a a a"]
    got = {(r.k, r.p): r.n for r in phrase_counts(spark.createDataFrame(list(enumerate(texts)), "k long, t string").repartition(3), spark.createDataFrame([(p,) for p in phrases], "p string"), "k", "t", "p").collect()}
    joiner, want = r"[\s\-‐-―'‘’\"“”]+", {}
    for (k, text), phrase in itertools.product(enumerate(texts), phrases):
        words = [re.escape(w) for w in re.split(r"[^a-z0-9]+", (phrase or "").lower()) if w]
        n = len(re.findall(r"(?<![a-z0-9])" + joiner.join(words) + r"(?![a-z0-9])", text or "", re.I)) if words else 0
        if n:
            want[k, phrase] = n
    assert got == want


def test_tells(spark):
    text = "We leverage — and LEVERAGED — robustness; not only, not just. Let's go; lets see. In conclusion, at the end of the day, game-changing."
    row = spark.createDataFrame([(text,)], "t string").select(*[c.alias(n) for n, c in tells(F.col("t")).items()]).first()
    assert row.asDict() == {"em_dashes": 2, "tier1_words": 4, "not_just": 2, "lets": 2, "in_conclusion": 2}


def test_first_reached(spark):
    links = spark.createDataFrame([(0, k) for k in range(1, 30)] + [(k, k + 100) for k in range(1, 30)] + [(5, 0)], "src long, dst long")
    got = first_reached(links, spark.createDataFrame([(0,)], "node long"), 6, 35).collect()
    assert [(r.node, r.depth) for r in got] == [(0, 0)] + [(k, 1) for k in range(1, 30)] + [(k, 2) for k in range(101, 106)]
