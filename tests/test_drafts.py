"""Drafts and forum pages: cases worked by hand, and the window of evidence against a plain loop."""

import re

import pytest
from pyspark.sql import functions as F

from pagequarry.functions.forum import parsed_comments
from pagequarry.operators.graph import only_children_merged
from pagequarry.plans import drafts as D
from pagequarry.plans.forum import evidence_window, posts
from pagequarry.streaming.queue import snapshot


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, found",
    [
        ('say {"a": [1, {"b": "}"}]} then', '{"a": [1, {"b": "}"}]}'),
        ("```json\n[1, 2]\n``` and {}", "[1, 2]"),
        ('x ["a \\" ]", 2] y', '["a \\" ]", 2]'),
        ('{"a": "\\\\"} {"b": 1}', '{"a": "\\\\"}'),
        ("{not json}", None),
        ("no brackets", None),
        ('{"a": 1', None),
        ("", None),
        (None, None),
    ],
)
def test_first_json(spark, text, found):
    assert one(spark, D.first_json(F.lit(text).cast("string"))) == found


@pytest.mark.parametrize(
    "prose, anchor, linked",
    [
        ("The Rating-Scale works", "rating scale", "The [Rating-Scale](u) works"),
        ("RICE, ICE, MoSCoW here", "rice ice moscow", "[RICE, ICE, MoSCoW](u) here"),
        ("see [a b](https://x.y/z) and a b", "a b", "see [a b](https://x.y/z) and [a b](u)"),
        ("a ---- b", "a b", None),
        ("costs $5 now", "$5", "costs [$5](u) now"),
        ("anything", " - ", None),
        (None, "a", None),
    ],
)
def test_with_anchor(spark, prose, anchor, linked):
    assert one(spark, D.with_anchor(F.lit(prose).cast("string"), F.lit(anchor), F.lit("u"))) == linked


def test_outline_and_section(spark):
    outline = "# Topic\n## A\n- b\ntext\n## See also\n## C [1]"
    assert one(spark, D.outline_cleaned(F.lit(outline))) == "# Topic\n## A\n### b\n## C "
    assert one(spark, D.outline_cleaned(F.lit("# Old\n# Topic\n## A"), F.lit("topic"))) == "# Topic\n## A"
    section = "# H\nA whole one. Cut off here\n\nIn summary, all.\n## Conclusion\nGone.\n## Next\nKept [1, 2]."
    assert one(spark, D.section_cleaned(F.lit(section))) == "# H\n\nA whole one.\n\n## Next\n\nKept [1] [2]."


def test_read_status(spark):
    long = "word " * 90
    assert one(spark, D.read_status(F.lit(long))) == "ok"
    assert one(spark, D.read_status(F.lit("Page Not Found " + long))) == "soft-404"
    assert one(spark, D.read_status(F.lit(long * 3 + "page not found"))) == "ok"
    assert one(spark, D.read_status(F.lit("few words"))) == "short"
    assert one(spark, D.read_status(F.lit(None).cast("string"))) == "short"


def test_edit_faults(spark):
    before = "# H\nIt cost 1,200 in all. See [it](https://x.y) [c1].\n- item"
    faults = lambda after: one(spark, D.edit_faults(F.lit(before), F.lit(after)))
    assert faults(before) == []
    assert faults(before.replace("1,200", "1,300")) == ["lost", "made"]
    assert faults(before.replace("[c1]", "[c1] [c1]")) == ["made", "tags"] or faults(before.replace("[c1]", "[c1] [c1]")) == ["tags"]
    assert faults(before.replace("x.y", "x.z")) == ["links"]
    assert faults(before.replace("# H", "# I")) == ["headings"]
    assert faults(before.replace("- item", "- items")) == ["structure"]
    assert "longer" in faults(before.replace("all. See", "all, see"))
    assert one(spark, D.edit_faults(F.lit(None).cast("string"), F.lit(None).cast("string"))) == []


def plain_window(claim, page, size):
    text = " ".join(page.split())
    if len(text) <= size:
        return text
    numbers = dict.fromkeys(n for n in re.findall(r"\d+%?", re.sub(r"[^a-z0-9%]+", " ", re.sub(r"(\d),(\d)", r"\1\2", claim.lower()))) if len(n.rstrip("%")) > 1)
    words = set(re.findall("[a-z]{5,}", claim.lower()))
    places = [m.start() for n in numbers for m in re.finditer(rf"(?<!\d){n}(?!\d)", text.lower())]
    near = {at: sum(w in text.lower()[max(0, at - 700) : at + 700] for w in words) for at in places}
    left, begins, out = size - size // 4, [], [text[: size // 4]]
    for at in sorted(places, key=lambda at: (near[at], at), reverse=True):
        span = min(3000, left)
        begin = max(0, at - span // 2)
        if span >= 600 and all(abs(begin - b) >= span for b in begins):
            begins, left = [*begins, begin], left - span
            out.append(text[begin : begin + span])
    return "\n…\n".join(out) if begins else text[:size]


def test_evidence_window(spark):
    words = ["growth", "market", "in 2010", "rose 37% over", "about 1,200 people", "the", "salary", "37 of", "12"]
    page = lambda seed, n: " ".join(words[(i * i + seed * i + i // 7) % len(words)] if i % 11 else "plain filler" for i in range(n))
    cases = [(c, page(s, n), size) for s, (c, n, size) in enumerate([("growth of 37% in salary", 3000, 8000), ("1200 people", 900, 2000), ("37 or 12 of the market", 4000, 8000), ("no figure", 900, 2000), ("5 only", 900, 2000), ("37%", 5, 2000)])]
    for claim, text, size in cases:
        assert one(spark, evidence_window(F.lit(claim), F.lit(text), size)) == plain_window(claim, text, size)


def test_comments_and_posts(spark):
    page = """<div class="thing comment" data-fullname="t1_a" data-author="x"><span class="score unvoted" title="-3 points"></span><div class="md"><p>One &amp;
      two <b>three</b></p><div>four</div></div><div class="child"><div class=" thing id comment" data-fullname="t1_b"><div class="md">inner</div></div></div></div>
      <div class="thing comment" data-fullname="t1_c"></div></div></div>"""
    rows = [(r["comment_id"], r["parent_id"], r["depth"], r["score"], r["text"]) for r in parsed_comments(page)]
    assert rows == [("a", "", 0, -3, "One & two threefour"), ("b", "a", 1, None, "inner"), ("c", "", 0, None, "")]
    assert parsed_comments(None) == [] and parsed_comments("</div>") == []
    html = '<div class=" thing link" data-fullname="t3_p" data-score="4" data-comments-count="" data-permalink="/r/1"><a class="title may-blank" href="x">A &lt;b&gt;</a></div><div class="thing" data-fullname="t3_q" data-score="">'
    got = posts(spark.createDataFrame([(1, html), (2, None)], "k int, html string"), "k", "html").collect()
    assert [(r.post_id, r.score, r.comment_count, r.title, r.flair, r.path) for r in got] == [("p", 4, 0, "A <b>", "", "/r/1")]


def test_snapshot(spark, tmp_path):
    made = []
    make = lambda: made.append(1) or spark.range(3)
    folder = f"file://{tmp_path}"
    assert snapshot(spark, folder, "first", make).count() == 3
    assert snapshot(spark, folder, "first", make).count() == 3 and len(made) == 1


def test_only_children_merged(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, 3), (6, 5), (7, 99)], "node int, parent int")
    assert {r.node: r.into for r in only_children_merged(tree).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5, 7: 7}
    with pytest.raises(ValueError):
        only_children_merged(spark.createDataFrame([(1, 2), (2, 1)], "node int, parent int"))
