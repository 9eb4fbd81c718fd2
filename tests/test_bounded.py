"""What a step holds or ships at a time, and that results stay the same."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagequarry.functions import diff, text, urls
from pagequarry.operators import linkage, patterns, similarity, vector_store
from pagequarry.operators.vector_store import VectorStore
from pagequarry.plans import extract


def test_no_row_is_held_twice(spark, monkeypatch):
    """Rows without structure come near to every cell; each is packed into one block all the same, and none is missed."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=(400, 24))
    v[200:] = v[:200] + 0.3 * rng.normal(size=(200, 24))
    v[-1] = v[0]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    tables = []
    monkeypatch.setattr(linkage, "written", lambda df: tables.append(df.cache()) or tables[-1])
    df = spark.createDataFrame([(k, [float(x) for x in row]) for k, row in enumerate(v)], "id long, mean array<double>")
    sim = np.round(v @ v.T, 9)
    np.fill_diagonal(sim, -2)
    want = {k: (int(sim[k].argmax()), sim[k].max()) for k in range(400) if sim[k].max() >= 0.85}
    got = {r.id: (r.other, r.sim) for r in linkage.nearest_above(df, 0.85, 40, 50, 3).collect()}
    assert {k: o for k, (o, _) in got.items()} == {k: o for k, (o, _) in want.items()} and len(want) > 150
    held = tables[0].count() if "m" not in tables[0].columns else tables[0].agg(F.sum(F.octet_length("ids")) / 8).first()[0]
    assert held == 400


class Captured:
    """Stands in for a table and keeps what runs in its tasks."""

    def select(self, *_):
        return self

    crossJoin = select

    def mapInArrow(self, f, _):
        self.task = f
        raise StopIteration


def task_of(call, table):
    with pytest.raises(StopIteration):
        call(table)
    return table.task


def test_rows_with_cells_leave_in_slices(monkeypatch):
    """A batch whose every row goes to most cells isn't made whole; rows and cells are the same."""
    rng = np.random.default_rng(3)
    centres, v = rng.normal(size=(256, 16)), rng.normal(size=(6000, 16)).astype(np.float32)
    monkeypatch.setattr(VectorStore, "_centres", lambda self: (centres, 200))
    store = VectorStore.__new__(VectorStore)
    batch = pa.record_batch([pa.array(range(6000), pa.int64()), pa.array(list(v), pa.list_(pa.float32()))], ["id", "v"])
    out = list(task_of(lambda rows: store._placed(rows, 200), Captured())([batch]))
    assert max(b.nbytes for b in out) <= 24 << 20 and len(out) > 1
    cells = np.concatenate([b.column("cell").to_numpy() for b in out]).reshape(6000, 200)
    unit = v / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    assert (cells == np.argsort(-(unit @ centres.T), axis=1, kind="stable")[:, :200]).all()
    assert [x for b in out for x in b.column("id").to_pylist()] == [k for k in range(6000) for _ in range(200)]


def test_asking_vectors_are_held_once(spark, monkeypatch, tmp_path):
    """A vector that asks most cells is no row for each of them: it is packed into one block, as each row is, and what is found is the same for all tiles."""
    rng = np.random.default_rng(4)
    v = rng.normal(size=(1500, 12)).astype(np.float32)
    v[700:740] = v[3]  # copies, and one that isn't quite
    v[740] = v[3] * np.float32(1.0001)
    frame = spark.createDataFrame([(k, [float(x) for x in row]) for k, row in enumerate(v)], "vec_id long, embedding array<float>").repartition(3)
    store = VectorStore.made(frame, str(tmp_path / "s"))
    tables = []
    monkeypatch.setattr(vector_store, "written", lambda df: tables.append(df.cache()) or tables[-1])
    centres, _ = store._centres()
    unit = v / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    sim = np.round(unit @ unit.T, 6)
    np.fill_diagonal(sim, -np.inf)
    near, own = np.argsort(-(unit @ centres.T), axis=1, kind="stable"), (unit @ centres.T).argmax(axis=1)
    for probes, tile in ((len(centres) - 3, 0), (len(centres) - 3, 130), (4, 200), (len(centres), 0)):
        tables.clear()
        found = store.search(frame, probes=probes, tile=tile)
        assert "Generate" not in plan(found)
        blocks = {c: t.agg(F.sum(F.octet_length(c)) / 8).first()[0] for t in tables for c in ("asked", "ids") if c in t.columns}
        assert blocks == {"asked": 1500, "ids": 1500}
        got = {}
        for r in found.collect():
            got.setdefault(r.query_id, []).append((r.rn, r.id, r.sim))
        for k in range(1500):
            may = np.flatnonzero(np.isin(own, near[k, :probes]) & (np.arange(1500) != k))
            want = may[np.lexsort((may, -sim[k, may]))[:10]]
            assert sorted(got[k]) == [(n, int(j), sim[k, j]) for n, j in enumerate(want, 1)]


def test_of_many_copies_few_are_compared(monkeypatch):
    """Copies are no square of pairs, and nearly equal vectors leave in pieces; the nearest are the same."""
    rng = np.random.default_rng(6)
    v = rng.normal(size=(3000, 8)).astype(np.float32)
    v[500:2500] = v[7]
    v[2500:] = v[9] + (3e-6 * rng.normal(size=(500, 8))).astype(np.float32)
    ids, cells = rng.permutation(9000)[:3000].astype(np.int64), np.sort(rng.integers(0, 3, 3000))
    cells[500:2500] = 1
    near = rng.random((3000, 3)) < 0.8
    exact = []
    monkeypatch.setattr(vector_store, "WAITING", 20_000)
    monkeypatch.setattr(np, "einsum", lambda how, a, b, f=np.einsum: exact.append(len(a)) or f(how, a, b))
    got = {}
    for q, k, s in zip(*vector_store.nearest(ids, v, near, ids, v, cells, 10)):
        got.setdefault(int(q), []).append((-s, int(k)))
    unit = v / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    sim = np.round(unit @ unit.T, 6)
    for k in range(3000):
        may = np.flatnonzero(near[k][cells] & (ids != ids[k]))
        assert got.get(int(ids[k]), []) == [(-sim[k, j], int(ids[j])) for j in may[np.lexsort((ids[may], -sim[k, may]))[:10]]]
    assert sum(exact) < 1_000_000  # 4 million pairs of copies alone


def test_nearest_cells_of_equal_centres():
    """Cells that are equally near count in their order, and no tile has more rows than it may."""
    sim = np.round(np.random.default_rng(2).normal(size=(200, 40)), 1)
    for probes in (1, 7, 39, 40, 60):
        want = np.zeros(sim.shape, bool)
        np.put_along_axis(want, np.argsort(-sim, axis=1, kind="stable")[:, :probes], True, axis=1)
        assert (vector_store.probed(sim, probes) == want).all()
    order, counts = vector_store.chained(sim), {c: (c * 37) % 90 for c in range(200)} | {11: 1000}
    first, parts = vector_store.dealt(order, counts, 100)
    assert sorted(order) == list(range(200)) and parts[11] == 10
    held = {}
    for c in range(200):
        for p in range(parts[c]):
            held[first[c] + p] = held.get(first[c] + p, 0) + counts.get(c, 0) / parts[c]
    assert max(held.values()) <= 100 and len(held) <= 2 * sum(counts.values()) / 100 + 1


def test_the_sample_is_compared_in_slices(monkeypatch):
    """Centres and probes are those of all likenesses at once, of which the driver holds few."""
    import tracemalloc

    rng = np.random.default_rng(9)
    sample = rng.normal(size=(20_000, 8))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    tracemalloc.start()
    centres = vector_store.fitted(sample, 300, 2)
    probes = vector_store.probes_for(sample, centres, 10, 0.95)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20  # 48 MB of likenesses to centres and 240 MB of sorting before
    sim = sample[:500] @ sample.T
    np.fill_diagonal(sim, -np.inf)
    near = np.argsort(-sim, axis=1)[:, :10]
    place = np.argsort(np.argsort(-(sample[:500] @ centres.T), axis=1), axis=1)
    rank = np.take_along_axis(place, (sample @ centres.T).argmax(axis=1)[near], axis=1)
    assert probes == int(np.quantile(rank, 0.95, method="higher")) + 1
    assert [vector_store.probes_for(sample[:n], centres[:c], 10, 0.95) for n, c in ((0, 5), (1, 1), (3, 2))] == [5, 1, 2]


def test_pairs_of_blocks_leave_one_by_one(monkeypatch):
    """What one pair of blocks found leaves before the next is looked at."""
    rng = np.random.default_rng(5)
    blocks = [(list(range(lo, lo + 30)), rng.normal(size=(30, 8))) for lo in (0, 30, 60)]
    monkeypatch.setattr(similarity, "_blocks", lambda *_: table)
    table, seen = Captured(), []
    search = task_of(lambda _: similarity.cosine_top_k(table, table, 5, "vec_id", "embedding"), table)
    ids, m = pa.array([i for i, _ in blocks], pa.list_(pa.int64())), pa.array([x.tobytes() for _, x in blocks], pa.binary())
    batch = pa.record_batch([pa.array([blocks[0][0]] * 3, pa.list_(pa.int64())), pa.array([blocks[0][1].tobytes()] * 3, pa.binary()), ids, m], ["q_ids", "q_m", "r_ids", "r_m"])
    for b in search([batch]):
        seen.append({(q, r): s for q, r, s in zip(*(b.column(c).to_pylist() for c in range(3)))})
    assert [len(s) for s in seen] == [150] * 3
    for (others, rows), got in zip(blocks, seen):
        sim = np.round(blocks[0][1] @ rows.T, 6)
        for q in range(30):
            want = sorted(((-sim[q, k], r) for k, r in enumerate(others) if r != q))[:5]
            assert [(q, r) for _, r in want] == [k for k in got if k[0] == q] and all(got[q, r] == -s for s, r in want)


def test_texts_are_read_out_of_arrow():
    """Pages and pairs of texts come as Arrow arrays, slices too, and nulls are empty."""
    pages = pa.array(["<h1>a</h1><p>b&amp;c</p>", None, "<ul><li>x</ul>"])
    assert text.html_to_text.func(pages).to_pylist() == ["# a\n\nb&c", "", "- x"]
    assert text.html_to_text.func(pages.slice(2)).to_pylist() == ["- x"]
    old, new = pa.array(["a b c", None, "x"] * 200), pa.array(["a c", None, "x y"] * 200)
    got = diff.word_edits.func(old, new)
    assert len(got) == 600 and got.field("similarity").to_pylist()[:3] == [0.8, 1.0, 0.667] and [len(e) for e in got.field("edits").to_pylist()] == [1, 0, 1] * 200
    assert len(diff.word_edits.func(old.slice(0, 0), new.slice(0, 0))) == 0


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_and_lines_are_worked_out_once(spark):
    """What lambdas read for each element stands in the plan once."""
    df = spark.createDataFrame([("The a: b",)], "t string")
    assert plan(df.select(urls.slug(F.col("t")).alias("x"))).count("lower(") == 1
    assert plan(df.select(extract.tidy(F.col("t")).alias("x"))).count("split(") == 1


def test_phrases_are_counted_where_texts_are_read(spark, monkeypatch):
    """No run of words is a row that others are grouped with; few leave a task at a time, and phrases that no task holds are found as well."""
    texts = spark.createDataFrame([(k, "a b, a b a-b c " * (k % 9)) for k in range(600)], "k long, t string").repartition(2)
    asked = spark.createDataFrame([("a b",), ("A-b",), ("b",), ("a b c",), ("c a",), ("z",), (None,)], "p string")
    found = patterns.phrase_counts(texts, asked, "k", "t", "p")
    assert not any(step in plan(found) for step in ("Generate", "Aggregate", "Window"))
    each = {"a b": 3, "A-b": 3, "b": 3, "a b c": 1}
    want = sorted((k, p, n * (k % 9)) for k in range(600) if k % 9 for p, n in each.items()) + [(k, "c a", k % 9 - 1) for k in range(600) if k % 9 > 1]
    monkeypatch.setattr(patterns, "RUNS", 50)
    for most in (patterns.PHRASE_BYTES, 0):
        assert sorted(map(tuple, patterns.phrase_counts(texts, asked, "k", "t", "p", most).collect())) == sorted(want)
    assert patterns.phrase_counts(texts, asked.limit(0), "k", "t", "p").count() == 0


def test_asked_runs_alone_leave_a_task():
    held = {"a b", "b"}
    assert patterns.counted_runs("a b a c. b", [1, 2], {"a": [2], "b": [1]}, held) == {"a b": 1, "b": 2}
    assert patterns.counted_runs("a b a c. b", [1, 2], None, None) == {"a": 2, "b": 2, "c": 1, "a b": 1, "b a": 1, "a c": 1}
