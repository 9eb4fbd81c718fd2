"""Queries against their SQL on rows that the smallest tables lack."""

from collections import Counter
from datetime import datetime

import duckdb
import pyarrow as pa

from pagequarry import plans
from pagequarry.plans import checks, forum, merges, rules


def by_sql(name, **tables):
    con = duckdb.connect()
    for table, rows in tables.items():
        con.register(table, rows)
    return Counter(map(tuple, con.sql(plans.oracle_sql()[name]).fetchall()))


def by_spark(df):
    return Counter(map(tuple, df.collect()))


def test_references_without_semicolon(spark):
    """A reference cut off before its semicolon is text, as are names that none has."""
    html = ["<p>a &amp b &amp;amp; &amp;lt; &lt;x&gt; &quot;q&quot;&nbsp;&amp</p>", "<title>cut&amp</title><p>&notit; &ltx &gt</p>", "<p>&amp;&amp &nosuch; & ; &;</p>", None]
    pages = pa.table({"page_id": pa.array(range(len(html)), pa.int64()), "html": html})
    frame = spark.createDataFrame(list(enumerate(html)), "page_id long, html string")
    assert by_spark(forum.tags_stripped(frame)) == by_sql("tags_stripped", pages=pages)
    assert by_spark(rules.html_markdown(frame)) == by_sql("html_markdown", pages=pages)
    assert [r.text for r in forum.tags_stripped(spark.createDataFrame([(1, "&eacute;&#233;&#xE9;&#233 &hellip;")], "page_id long, html string")).collect()] == ["ééé&#233 …"]


def test_arrivals_are_rounded(spark):
    """Times half a millisecond before a boundary and later arrive behind it, as in SQL."""
    times = [datetime(2024, 1, 3, 3, 42, 19, 999601), datetime(2024, 1, 3, 3, 42, 19, 999499), datetime(2024, 1, 3, 3, 42, 19, 999500), datetime(1969, 12, 31, 23, 59, 39, 999499), datetime(1969, 12, 31, 23, 59, 59, 999500)]
    rows = [(k, 1 + k % 2, t, "error" if k % 3 else "view") for k, t in enumerate(times)]
    events = pa.table(dict(zip(("event_id", "user_id", "ts", "event_type"), map(list, zip(*rows)))))
    frame = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string")
    assert by_spark(checks.request_schedule(frame)) == by_sql("request_schedule", events=events)


def test_titles_of_one_spelling(spark):
    """Several pages of one layer with one spelling: the title is the least page's, whatever the order of rows."""
    urls = [(k, f"http{'s' * (k % 2)}://a.example.org/{'x' if k < 60 else 'y'}") for k in range(3, 120)]
    pages = pa.table({"page_id": pa.array([k for k, _ in urls], pa.int64()), "url": [u for _, u in urls]})
    want = by_sql("union_by_key", pages=pages)
    for frame in (urls, urls[::-1], sorted(urls, key=lambda r: r[0] * 7919 % 127)):
        assert by_spark(merges.union_by_key(spark.createDataFrame(frame, "page_id long, url string").repartition(4))) == want


def test_phrases_in_texts_of_one_id(spark):
    """Texts that share an id, or have none, are counted each for itself; phrases of one spelling are phrases of their own."""
    texts = ["a a a a", "a a a a", "A-a—a a", "a a a", "a a a", None, "", "a\xa0a", "a\x1ca", "a\x00a", "a\r\na\f\ta", "a' \"a“”a", "a_a", "the \u212a a", "Straße a ẞ a", "‐a―a", "aaaa 10 a 10"]
    rows = list(zip([1, 1, 2, None, None, *range(5, 17)], texts))
    asked = list(enumerate(["a", "A a", "a-a a b", None, "", "k", "k", "a. a", "!!", "10", "10 a", "stra e"]))
    documents = pa.table({"doc_id": pa.array([k for k, _ in rows], pa.int64()), "text": texts})
    benchmark = pa.table({"item_id": pa.array([k for k, _ in asked], pa.int64()), "text": [t for _, t in asked]})
    got = by_spark(rules.phrase_table(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string")))
    assert got == by_sql("phrase_table", documents=documents, benchmark=benchmark)
    assert got[1, "a a", 2] == 2 and got[None, "a a", 1] == 2
