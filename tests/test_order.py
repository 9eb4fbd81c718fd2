"""Running sums, medians and clusters against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.operators.linkage import average_linkage, nearest_above
from pagequarry.operators.ranking import medians, running


def test_running(spark):
    rng = np.random.default_rng(1)
    rows = [([None, "a", "b"][int(rng.integers(0, 3))] if k > 400 else "hot", int(rng.integers(0, 50)), k, int(rng.integers(-9, 9)) if k % 7 else None) for k in range(700)]
    df = spark.createDataFrame(rows, "k string, t long, id long, x long").repartition(5)
    for keys in (["k"], []):
        got = {r.id: (r.total, r.top) for r in running(df, keys, ["t", "id"], total=("sum", F.col("x")), top=("max", F.col("x"))).collect()}
        held = {}
        for k, _, ident, x in sorted(rows, key=lambda r: r[1:3]):
            own = held.setdefault(k if keys else 0, [])
            own += [x] if x is not None else []
            assert got[ident] == (sum(own), max(own, default=None))
    assert running(df.limit(0), ["k"], ["t"], n=("sum", F.lit(1))).count() == 0


def test_medians(spark):
    rng = np.random.default_rng(2)
    one = [("all", float(x)) for x in np.round(rng.normal(size=5001), 3)]  # a group of nearly all rows
    few = [("few", 3.0), ("few", 1.0), ("two", 2.0), ("none", None), (None, 7.0), (None, 8.0), (None, None)] + [("same", 4.0)] * 90
    df = spark.createDataFrame(one + few, "k string, x double").repartition(6)
    got = medians(df, ["k"], F.col("x"), "m")
    plan = got._jdf.queryExecution().toString().lower()
    assert "median(" not in plan and "percentile" not in plan and "collect_list" not in plan
    want = {k: float(np.median([x for j, x in one + few if j == k and x is not None])) for k in ("all", "few", "two", None, "same")}
    assert {r.k: r.m for r in got.collect()} == want
    assert [r.m for r in medians(df, [], F.col("x"), "m").collect()] == [float(np.median([x for _, x in one + few if x is not None]))]


def plain_linkage(v, least):
    """Joins the two nearest clusters, one pair at a time, while the mean of all cosines across them is enough."""
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    cos, groups = unit @ unit.T, [[k] for k in range(len(v))]
    while len(groups) > 1:
        m = np.zeros((len(groups), len(v)))
        for k, g in enumerate(groups):
            m[k, g] = 1 / len(g)
        mean = np.round(m @ cos @ m.T, 9)
        np.fill_diagonal(mean, -2)
        best = mean.max()
        if best < least:
            break
        i, j = min((groups[i][0], groups[j][0], i, j) for i, j in zip(*np.nonzero(mean == best)) if i < j)[2:]
        groups[i] = sorted(groups[i] + groups[j])
        del groups[j]
        groups.sort(key=lambda g: g[0])
    return {k: g[0] for g in groups for k in g}


@pytest.mark.parametrize("pivots", [7])
def test_average_linkage(spark, pivots):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 12))
    v = centres[rng.integers(0, 40, 500)] + 0.35 * rng.normal(size=(500, 12))
    v[490:] = v[:10] * 2  # copies but for their length
    v[480:485] = v[100]
    rows = [(k, [float(x) for x in row]) for k, row in enumerate(v)]
    odd = [(900, None), (901, []), (902, [0.0] * 12), (903, [float("nan")] * 12), (None, [1.0] * 12)]
    got = {r.vec_id: r.cluster for r in average_linkage(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"), 0.85, pivots=pivots).collect()}
    want = plain_linkage(v, 0.85)
    assert 50 < len(set(want.values())) < 450 and max(np.bincount(list(want.values()))) > 4
    assert got == want | {k: k for k in (900, 901, 902, 903)}


def test_nearest_in_tiles(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(300, 6))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(k, [float(x) for x in row]) for k, row in enumerate(v)], "id long, mean array<double>")
    sim = np.round(v @ v.T, 9)
    np.fill_diagonal(sim, -2)
    want = {k: int(sim[k].argmax()) for k in range(300) if sim[k].max() >= 0.8}
    for pivots, tile in ((1, 64), (20, 16)):
        assert {r.id: r.other for r in nearest_above(df, 0.8, pivots, tile).collect()} == want


def test_linked_vectors(spark):
    """The query against the loop, on the first of its vectors; clusters never join what stands apart, so each three are their own."""
    from pagequarry import plans

    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").where("embedding is not null").orderBy("vec_id").limit(150).collect()
    bent = {3 * r.vec_id + k: np.array(r.embedding, float) * (1 + 0.35 * k * np.cos(np.arange(len(r.embedding)) * (k + 1) + r.vec_id)) for r in rows for k in range(3)}
    ids = sorted(bent)
    want = plain_linkage(np.array([bent[i] for i in ids]), 0.85)
    frame = spark.createDataFrame([(r.vec_id, r.embedding) for r in rows], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.cluster for r in plans.search.linked_vectors(frame).collect()}
    assert got == {ids[k]: ids[c] for k, c in want.items()} and {1, 2, 3} <= set(np.bincount(list(want.values())))
