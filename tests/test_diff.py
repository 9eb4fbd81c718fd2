"""Word diffs against a table of all pairs, and texts made anew from their edits."""

import time

import numpy as np

from pagequarry import plans
from pagequarry.functions.diff import matched, opcodes, word_edits


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_opcodes():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = ([str(w) for w in rng.integers(0, rng.integers(1, 9), rng.integers(0, 40))] for _ in "ab")
        ops, made = opcodes(a, b), []
        i = j = 0
        for op, i1, i2, j1, j2 in ops:
            assert (i1, j1) == (i, j) and (i2 > i1) == (op != "insert") and (j2 > j1) == (op != "delete")
            assert op != "equal" or a[i1:i2] == b[j1:j2]
            made += b[j1:j2] if op != "equal" else a[i1:i2]
            i, j = i2, j2
        assert (i, j) == (len(a), len(b)) and made == b
        assert all(x[0] != y[0] or x[0] != "equal" for x, y in zip(ops, ops[1:]))
        assert sum(i2 - i1 for op, i1, i2, _, _ in ops if op == "equal") == longest(a, b)
    a, b = (rng.integers(0, 50, 20_000).tolist() for _ in "ab")  # long and unlike
    began = time.time()
    assert len(matched(a, b)) > 4_500 and time.time() - began < 60


def test_word_edits(spark):
    pairs = [("a b c d", "a x c d e"), ("", ""), (None, "n"), ("same  words", "same words"), ("gone all", None)]
    got = spark.createDataFrame(pairs, "a string, b string").select(word_edits("a", "b").alias("d")).select("d.*").collect()
    assert [r.similarity for r in got] == [round(6 / 9, 3), 1.0, 0.0, 1.0, 0.0]
    assert [(e.op, e.was, e.now) for e in got[0].edits] == [("replace", "b", "x"), ("insert", "", "e")]
    rows = plans.queries()["section_edits"](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(0 <= r.similarity <= 1 for r in rows) and any(r.op == "replace" for r in rows)
