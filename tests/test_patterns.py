"""Strings in texts, domains near domains and blocks of postings against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.operators.patterns import containing, near_domains
from pagequarry.plans.aggregates import common_ids, ids_of_block, posting_blocks_of


@pytest.mark.parametrize("most", [1 << 20, 40])
def test_containing(spark, most):
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abé "), rng.integers(0, 60))) for _ in range(200)] + [None, "", "ABBA", "ab" * 50_000]
    patterns = ["".join(rng.choice(list("abé "), rng.integers(1, 6))) for _ in range(60)] + ["", None, "bab", "bab", "ab" * 2000, "A"]
    rows = spark.createDataFrame([(k % 201, t, "x") for k, t in enumerate(texts)], "id long, text string, p string").repartition(3)
    asked = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    got = sorted(map(tuple, containing(rows, asked, "id", "text", "pattern", most).collect()))
    assert got == sorted({(k % 201, p) for k, t in enumerate(texts) for p in patterns if p and t and p in t})
    assert containing(rows, asked.limit(0), "id", "text", "pattern", most).count() == 0
    assert containing(rows.limit(0), asked, "id", "text", "pattern", most).count() == 0


def test_near_domains(spark):
    def near(dead, live):
        flat, stem, other = dead.replace(".", "").replace("-", ""), dead.split(".")[0].replace("-", ""), live.replace(".", "").replace("-", "")
        return other.startswith(flat) or flat.startswith(other.split("com")[0]) or (len(stem) >= 4 and other.startswith(stem))

    rng = np.random.default_rng(2)
    part = lambda: "".join(rng.choice(list("abc-m"), rng.integers(1, 5)))
    live = sorted({f"{part()}{part()}.{'com' if rng.random() < 0.5 else part()}" for _ in range(120)} | {"makipeople.com", "zz.io"})
    dead = sorted({f"{part()}.{part()}" for _ in range(60)} | set(live[::9]) | {"maki.people", "zz.io", "q"})
    for own in (live, [*live, "company.io", "com.net"], ["com.net"]):  # with domains that begin any, too
        frames = [spark.createDataFrame([(d,) for d in x] + [(None,), ("",)], f"{n} string") for n, x in (("dead", dead), ("live", own))]
        got = near_domains(*frames)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and plan.count("BroadcastNestedLoopJoin") == 1  # with the one row of domains that begin any
        want = {d: next((x for x in sorted(own) if x != d and near(d, x)), None) for d in dead if d.strip('.-')}
        assert {r.dead: r.live for r in got.collect()} == {d: x for d, x in want.items() if x}


def test_posting_blocks(spark):
    rng = np.random.default_rng(3)
    pairs = [("all", k) for k in range(5000)] + [("half", int(k)) for k in rng.choice(5000, 2500, replace=False)] + [("one", 4999)] * 3 + [("none", None)]
    blocks = posting_blocks_of(spark.createDataFrame(pairs, "word string, id long").repartition(3), 100)
    rows = blocks.select("word", "block", "n", ids_of_block(F.col("first"), F.col("gaps")).alias("ids")).collect()
    assert max(r.n for r in rows) == 100 and sum(r.word == "all" for r in rows) == 50
    for word in ("all", "half", "one"):
        assert sorted(i for r in rows if r.word == word for i in r.ids) == sorted({i for w, i in pairs if w == word})
    asked = spark.createDataFrame([("all", "half"), ("half", "one"), ("one", "none")], "a string, b string")
    half = {i for w, i in pairs if w == "half"}
    assert {(r.a, r.b): r.n for r in common_ids(blocks, asked).collect()} == {("all", "half"): 2500} | ({("half", "one"): 1} if 4999 in half else {})
