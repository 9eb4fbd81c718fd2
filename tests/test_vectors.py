"""Parts of vectors in order, and lines of JSON beside them."""

import json
import tempfile

import numpy as np
import pytest

from pagequarry.sources.vectors import npy_parts, with_meta


def test_npy_parts(spark):
    folder, rng = tempfile.mkdtemp(prefix="spark-"), np.random.default_rng(1)
    parts = [rng.normal(size=(n, 5)).astype(kind) for n, kind in ((3, "<f4"), (5000, "<f8"), (1, "<f2"))]
    for k, m in enumerate(parts):
        np.save(f"{folder}/part-{k:04d}.npy", m)
    whole = np.concatenate([m.astype(np.float32) for m in parts])
    with open(f"{folder}/meta.jsonl", "w") as f:
        f.writelines(json.dumps({"url": f"u{k}", "chunk": k % 3}) + "\n" for k in range(len(whole)))
    rows = npy_parts(spark, f"{folder}/part-*.npy")
    got = {r.place: r for r in rows.collect()}
    assert len(got) == len(whole) and all(np.array_equal(np.float32(got[k].v), whole[k]) for k in (0, 2, 3, 4098, 5002, 5003))
    told = {r.place: r for r in with_meta(rows, f"{folder}/meta.jsonl", "url string, chunk int").collect()}
    assert all(told[k].url == f"u{k}" and abs(np.linalg.norm(told[k].v) - 1) < 1e-5 for k in range(0, len(whole), 97))
    with open(f"{folder}/meta.jsonl", "a") as f:
        f.write('{"url": "one more"}\n')
    with pytest.raises(ValueError, match="5005 lines for 5004"):
        with_meta(rows, f"{folder}/meta.jsonl", "url string, chunk int")
