"""The frontier as a stream: claims within a lease, leases that run out, and the same states whenever it is replayed."""

import tempfile
from datetime import datetime, timedelta

import numpy as np

from pagequarry.streaming import frontier

SCHEMA = "url string, at timestamp, seq long, event string"


def test_step():
    s = frontier.step
    assert s(None, "claim", 1.0) == (None, False) and s(None, "add", 1.0) == (("pending", 0, None), True)
    assert s(("pending", 0, None), "claim", 5.0) == (("in_progress", 1, 5.0), True)
    assert s(("in_progress", 1, 5.0), "claim", 905.0) == (("in_progress", 1, 5.0), False)
    assert s(("in_progress", 1, 5.0), "claim", 905.1) == (("in_progress", 2, 905.1), True)
    assert s(("done", 1, 5.0), "claim", 9999.0) == (("done", 1, 5.0), False) and s(("done", 1, 5.0), "add", 1.0)[1] is False
    assert s(("in_progress", 1, 5.0), "fail", 6.0) == (("failed", 1, 5.0), True)


def test_replayed_twice(spark):
    rng, zero = np.random.default_rng(1), datetime(2024, 1, 1)
    files, seq = [], 0
    for part in range(4):
        own = []
        for _ in range(250):
            at = zero + timedelta(seconds=float(part * 2000 + rng.uniform(0, 2000)))
            own.append((f"u{rng.integers(0, 60)}", at, seq, str(rng.choice(["add", "claim", "claim", "done", "fail"], p=[0.3, 0.3, 0.3, 0.05, 0.05]))))
            seq += 1
        files.append(sorted(own, key=lambda r: r[1]))
    folder = tempfile.mkdtemp(prefix="spark-")
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    want, held = {}, {}
    for url, at, n, event in (r for rows in files for r in rows):
        held[url], took = frontier.step(held.get(url), event, at.timestamp())
        want[n] = (url, took, held[url] and held[url][1])
    runs = []
    for run in range(2):
        told = frontier.replay(spark, f"{folder}/in", SCHEMA, f"{folder}/out{run}", f"{folder}/check{run}")
        rows = told.collect()
        assert {r.seq: (r.url, r.granted, r.attempts) for r in rows if r.seq is not None} == want
        runs.append(sorted(map(repr, rows)))
    assert runs[0] == runs[1]
    granted = sorted((r.url, r.at) for r in rows if r.event == "claim" and r.granted)
    assert all(a[0] != b[0] or (b[1] - a[1]).total_seconds() > frontier.LEASE for a, b in zip(granted, granted[1:]))
    expired = [r for r in rows if r.event == "expired"]
    assert expired and all(r.state == "pending" for r in expired)
    assert len(frontier.replay(spark, f"{folder}/in", SCHEMA, f"{folder}/out1", f"{folder}/check1").collect()) == len(rows)  # nothing new
