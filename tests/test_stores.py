"""Tables and vectors that are put into by key: what is kept, what is rewritten, and what a search finds."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.operators.vector_store import VectorStore
from pagequarry.sources.keyed import KeyedTable, upserting


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="spark-")


def test_keyed_table(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", "url", "url string, value long, ts long", 8)
    assert table.rows().count() == 0 and table.put(table.rows(), F.col("ts")) == []
    frame = lambda rows: spark.createDataFrame(rows, "url string, value long, ts long")
    first = [(f"u{k}", k, 1) for k in range(40)] + [("u3", 99, 2), ("u3", 98, 0), (None, 1, 1)]
    assert len(table.put(frame(first), F.col("ts"))) == 8
    want = {f"u{k}": k for k in range(40)} | {"u3": 99}
    assert {r.url: r.value for r in table.rows().collect()} == want
    before = files(f"{folder}/t")
    touched = table.put(frame([("u5", 500, 0), ("new", 7, 0)]), F.col("ts"))
    gone = before - files(f"{folder}/t")
    assert 1 <= len(touched) <= 2 and {int(f.split("bucket=")[1].split("/")[0]) for f in gone} <= set(touched)
    assert len(before & files(f"{folder}/t")) == len(before) - len(gone) and gone
    assert {r.url: r.value for r in table.rows().collect()} == want | {"u5": 500, "new": 7}
    assert table.put(frame([("u5", 1, 9), ("u6", 1, 9)]), F.col("ts"), keep_old=True) == []
    assert {r.url: r.value for r in table.rows().collect()} == want | {"u5": 500, "new": 7}


def test_upserting_stream(spark, folder):
    schema = "url string, value long, ts long"
    table = KeyedTable(spark, f"{folder}/t", "url", schema, 4)
    for step in range(3):
        spark.createDataFrame([(f"u{k}", 10 * step + k, step) for k in range(step, 6)], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        upserting(spark.readStream.schema(schema).parquet(f"{folder}/in"), table, F.col("ts"), f"{folder}/checkpoint")
        upserting(spark.readStream.schema(schema).parquet(f"{folder}/in"), table, F.col("ts"), f"{folder}/checkpoint")  # nothing new
    assert {r.url: r.value for r in table.rows().collect()} == {f"u{k}": 10 * min(k, 2) + k for k in range(6)}


def test_vector_store(spark, folder):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(25, 16))
    v = centres[rng.integers(0, 25, 3000)] + 0.7 * rng.normal(size=(3000, 16))
    row = lambda k, x: (k, [float(y) for y in x])
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    odd = [(9000, None), (9001, []), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (None, [1.0] * 16)]
    store = VectorStore.made(frame([row(k, x) for k, x in enumerate(v[:2990])] + odd), f"{folder}/s")
    assert store.rows().count() == 2990
    unit = (v / np.linalg.norm(v, axis=1, keepdims=True))[:2990]
    sim = unit @ unit.T
    np.fill_diagonal(sim, -2)
    want = np.argsort(-sim, axis=1)[:, :10]
    got = {}
    for r in store.search(frame([row(k, x) for k, x in enumerate(v[:2990])]), tile=700).collect():  # all rows ask
        got.setdefault(r.query_id, {})[r.id] = r.sim
    recall = np.mean([len(set(want[k]) & set(got[k])) / 10 for k in range(2990)])
    assert recall >= 0.9 and store._centres()[1] < len(store._centres()[0])
    assert all(abs(sim[k, j] - s) < 1e-5 for k in range(0, 2990, 50) for j, s in got[k].items())
    before = files(f"{folder}/s/cells")
    touched = store.put(frame([row(5, v[2995]), row(6, -v[6]), row(2999, v[2999])]))
    gone = {int(f.split("cell=")[1].split("/")[0]) for f in before - files(f"{folder}/s/cells")}
    assert gone <= set(touched) and len(touched) <= 5 and store.rows().count() == 2991
    now = {r.query_id: r.id for r in store.search(frame([row(7000, v[2995])]), k=1).collect()}
    assert now == {7000: 5}
    assert store.search(frame([row(1, v[1])]).limit(0)).count() == 0
