"""Lexical search, hard negatives and the URL filter against plain versions, and their edge cases."""

import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagequarry.llm import hard_negatives, lattice_dedup, lexical, simhash, toxicity, url_filter

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, item_id string, score int, shard int, term string, n long, rank int"


def plain_search(docs, items, most):
    """Scores of all documents by the published formula, in Python's whole numbers."""
    terms = lambda t: re.findall(lexical.TERM, (t or "").translate(str.maketrans(lexical.CAPITALS, lexical.SMALL)))
    rows = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in rows), sum(len(t) for _, t in rows)
    df = {}
    for _, t in rows:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        found = []
        for doc, t in rows:
            mass = 50 + 50 * len(t) * n_docs // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * tf // (1000 * tf + 20 * mass)) for x in set(terms(text)) if (tf := t.count(x)))
            if score > 0:
                found.append((-score, math.inf if doc is None else doc, doc))
        out += [(item, k + 1, doc, -score) for k, (score, _, doc) in enumerate(sorted(found, key=lambda r: r[:2])[:most])]
    return sorted(out, key=str)


def test_varints():
    values = np.array([0, 1, 127, 128, 300, 1 << 14, (1 << 14) - 1, 1 << 21, 1 << 40, (1 << 62) - 1])
    data, at = lexical.varints(values)
    assert lexical.from_varints(data).tolist() == values.tolist() and len(at) == len(values) + 1
    assert lexical.from_varints(lexical.varints(np.zeros(0, np.int64))[0]).tolist() == []


def test_merge_in_short_runs():
    rng = np.random.default_rng(3)
    mass = rng.integers(50, 200, 500)
    plain, lists = np.zeros(500, np.int64), []
    for _ in range(12):
        number = np.flatnonzero(rng.random(500) < rng.choice([0.02, 0.3, 0.9]))
        tf, one = rng.integers(1, 4, len(number)), lexical.Postings(int(rng.integers(0, 5)))
        plain[number] += one.weight * ((10**9 * tf) // (1000 * tf + 20 * mass[number]))
        for lo in range(0, len(number), 7):  # many blocks
            own = number[lo : lo + 7]
            gap = np.diff(own, prepend=own[0])
            one.add(int(own[0]), lexical.varints(np.stack([gap, tf[lo : lo + 7]], axis=1).reshape(-1))[0].tobytes())
        lists += [one] if len(number) else []
    want = sorted(((int(s), -k) for k, s in enumerate(plain) if s > 0), reverse=True)[:20]
    for span in (1, 16, 4096):
        assert sorted(lexical.best_of(lists, mass, 20, span), reverse=True) == want


def test_lexical_search(spark):
    rng = np.random.default_rng(4)
    word = ["alpha", "Beta", "gämma", "ÄÖ", "x1", "of", "the", "日本語"]
    texts = [None, "", " .,-", "of", " ".join(rng.choice(word, 40_000)), "A" * 300, "the the the of", "THE the The of", "alpha-beta_gämma", "\u00a0x1\u00a0"]
    texts += [" ".join(rng.choice(word, rng.integers(1, 30))) for _ in range(60)]
    docs = [(i * 3 % 67, t) for i, t in enumerate(texts)] + [(5, texts[20]), (5, texts[20]), (None, "alpha of"), (None, None)]
    items = [(1, "Alpha the, x1!"), (2, None), (3, ""), (4, "日本語 gämma"), (5, "nowhere"), (6, "of of of"), (7, " ".join(word))]
    frame = spark.createDataFrame([(i, t, "b", 1, 2, "c", 3, 4) for i, t in docs], SCHEMA).repartition(3)
    asked = spark.createDataFrame([(i, t, 5, 6) for i, t in items], "item_id int, text string, doc_id int, term int")
    for most, shard in ((5, 12 << 20), (50, 400)):  # one shard a task, then many
        index = lexical.written(lexical.build_index(frame, shard_bytes=shard))
        got = sorted(map(tuple, lexical.search(index, asked, most, items_at_once=3).select("item_id", "rank", "doc_id", "score").collect()), key=str)
        assert got == plain_search(docs, items, most)
    assert lexical.lexical_search(frame.limit(0), asked).count() == 0
    assert lexical.lexical_search(frame, asked.limit(0)).count() == 0


def plain_negatives(rows, every, low, high, positives=5, negatives=10):
    good = [(i, label, v) for i, label, v in rows if None not in (i, label, v) and v and None not in v]
    out = []
    for i, label, v in sorted({(i, label, tuple(v)) for i, label, v in good if i % every == 0}):
        others = sorted((-sum(map(int.__mul__, v, w)), j, m == label) for j, m, w in good if j != i and len(w) == len(v))
        for s, j in sorted(set([(-s, j) for s, j, same in others if same][:positives])):
            found = [(-t, k) for t, k, same in others if not same and low * s <= -100 * t <= high * s][:negatives]
            out += [(i, j, n + 1, k, s, t) for n, (t, k) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("scale", [30, 3, 1 << 20])
def test_hard_negatives(spark, scale):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 8))
    rows = [(k, int(rng.integers(0, 3)), [int(x) for x in np.floor(scale * (base[rng.integers(0, 6)] + 0.6 * rng.normal(size=8)))]) for k in range(300)]
    rows += [(400 + k, k % 3, rows[10 * k][2]) for k in range(20)]  # ties
    rows += [(7, 1, rows[7][2]), (7, 1, rows[7][2]), (3, 0, [0] * 8), (500, 1, [5, 5]), (510, 2, [4, 4]), (520, 1, [6, 5])]
    rows += [(None, 1, [1] * 8), (600, None, [1] * 8), (610, 1, None), (620, 1, []), (630, 1, [1, None, 3, 4, 5, 6, 7, 8])]
    frame = spark.createDataFrame([(*r, "a", 1, 2) for r in rows], "vec_id long, label int, v array<long>, anchor string, dim int, score int").repartition(3)
    got = hard_negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0, at_once=16)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, 10, 30, 90)
    assert hard_negatives.hard_negatives(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(6)
    v = rng.integers(-130, 130, (500, 24))
    lo, width = v.min(0), np.maximum(1, -(-(v.max(0) - v.min(0) + 1) // hard_negatives.CELLS))
    block = hard_negatives.Block(24, np.arange(500).tobytes(), np.zeros(500, np.int64).tobytes(), ((v - lo) // width).astype(np.uint8).tobytes(), np.stack([lo, width]).tobytes(), v.astype(np.int64).tobytes())
    low, high = block.bounds(v[:20])
    exact = v[:20] @ v.T
    assert (low <= exact).all() and (exact <= high).all()
    assert ((high - low) < np.ptp(exact) / 10).mean() > 0.99  # narrow enough to leave most rows out


def test_url_filter(spark):
    urls = ["https://a.example.org/es/1", "http://EXAMPLE.org/en/12?x=/", "http://example.org", "http://notexample.org/es/1", "http://x.com/fr/a", "http://x.COM/de/#b", "http://com/de/", "http://xcom/fr/"]
    urls += [None, "", "no scheme", "x://://org/", "http://net/" + "ä" * 5000, "://org/\n/", "http://org:80/", "http://example.org/en/1", "HTTP://A.ORG?/"]
    urls += [f"https://site{k}.example.net/{s}/{k}" for k in range(20) for s in ("fr", "es")] + ["http://x.com/fr/a"] * 3
    frame = spark.createDataFrame([(i, u, "h", "p", 1.0) for i, u in enumerate(urls)] + [(None, urls[0], "h", "p", 1.0)], "page_id long, url string, host string, rule string, score double")
    rows = url_filter.url_filter(frame).collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == len(urls) + 1
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = host.translate(str.maketrans(url_filter.CAPITALS, url_filter.SMALL))
        fit = max(((len(h + p), h + p, told) for told, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), default=(0, None, None))
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, fit[1]), u
        assert got[i].verdict in ("allow", "block") and (fit[2] is None or got[i].verdict == fit[2])
    assert got[8].score == got[9].score and got[None].verdict == "block"
    assert len({r.score for r in rows if r.page_id is not None and urls[r.page_id] == "http://x.com/fr/a"}) == 1
    assert url_filter.url_filter(frame.limit(0)).count() == 0


def test_url_models(spark):
    """Gains against a plain model by counting, and what the models say of labelled URLs that they did not see."""
    text = ["aab", "abab", "ba", "", "bbbb"]
    label = ["allow", "allow", "block", "allow", "block"]
    runs = lambda u: [(url_filter.START + u + url_filter.END)[max(0, j - url_filter.RUN + 1) : j + 1] for j in range(1, len(u) + 2)]
    long = "xy" * 200 + "é"
    frame = spark.createDataFrame([(u,) for u in [*text, long]], "url string")
    cut = {r.url: list(itertools.chain(*r.runs)) for r in frame.select("url", F.transform(url_filter.runs_of(F.col("url")), lambda p: F.coalesce(p, F.array().cast("array<string>"))).alias("runs")).collect()}
    assert cut == {u: runs(u) for u in [*text, long]}
    fit = spark.createDataFrame([(c, r) for u, c in zip(text, label) for r in runs(u)], "label string, run string")
    seen = sorted({r for u in [*text, "abc", "bab"] for r in runs(u)})
    got = {r.run: r.gain for r in url_filter._gains(spark.createDataFrame([(r,) for r in seen], "run string"), url_filter._model(fit)).collect()}

    def chance(run, c):
        own, p = [r for u, x in zip(text, label) if x == c for r in runs(u)], url_filter.ANY
        for k in range(1, len(run) + 1):
            after = [r[-1] for r in own if len(r) >= k and r[-k:-1] == run[-k:-1]]
            if after:
                p = (after.count(run[-1]) + len(set(after)) * p) / (len(after) + len(set(after)))
        return p

    for run in seen:
        assert got[run] == pytest.approx(math.log(chance(run, "allow")) - math.log(chance(run, "block")), abs=1e-12)
    pages = spark.read.parquet(f"{FOLDER}/../sf0.1/pages.parquet")
    held = url_filter.url_filter(pages).where("rule is not null").join(pages.select("page_id", "url"), "page_id").where(F.substr(F.md5("url"), F.lit(1), F.lit(1)).isin(*url_filter.HELD)).toPandas()
    # what rules allow must score above what they block, judged by models that saw neither
    good, bad = held.score[held.verdict == "allow"].to_numpy(), held.score[held.verdict == "block"].to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.98


def test_toxicity_scores(spark):
    """Scores against a forward pass written out window by window, word by word and character by character."""
    rng = np.random.default_rng(8)
    word = ["alpha", "Beta!!", "scum", "(scum)", "gämma", "x", "***", "lo" * 30, "the"]
    texts = [" ".join(rng.choice(word, n)) for n in (1, 5, 31, 32, 33, 56, 57, 200)] + ["", "  \n", "!" * 60]
    net = toxicity.Net(3, seed=5)
    p = net.p
    p["out_b"] = np.array([0.3], np.float32)
    cut = lambda w: pieces_of(w.encode())
    hashed = {}

    def pieces_of(raw):
        data = np.array([toxicity._LOWER[c] for c in raw], np.uint8)
        block = toxicity.Block(pa.table({"doc_id": pa.array([0], pa.int64()), "text": pa.array([raw.decode()])}))
        words = toxicity.Words(block)
        toxicity.pieces(words, block, data)
        return [bytes(data[a:b]) for a, b in zip(words.starts, words.ends)]

    def core(piece):
        return piece.strip(bytes(k for k in range(128) if toxicity._JOINT[k])) or piece

    def hash_of(piece):
        block = toxicity.Block(pa.table({"doc_id": pa.array([0], pa.int64()), "text": pa.array([piece.decode()])}))
        return int(toxicity.Words(block).hashes(block.bytes)[0])

    known = np.sort(np.array([hash_of(b"scum"), hash_of(b"beta")], np.uint64))
    row = {int(h): k + 1 for k, h in enumerate(known)}
    sigmoid = lambda v: 1 / (1 + np.exp(-v))

    def steps(inputs, u):
        h, out, k = np.zeros(u.shape[0]), [], u.shape[0]
        for v in inputs:
            a = h @ u
            z, r = sigmoid(v[:k] + a[:k]), sigmoid(v[k : 2 * k] + a[k : 2 * k])
            new = np.tanh(v[2 * k :] + r * a[2 * k :])
            h = new + z * (h - new)
            out.append(h)
        return out

    def vector(piece):
        if piece not in hashed:
            kinds = [int(toxicity._CLASS[c]) for c in piece]
            ends = [steps([p["chars"][d][c] for c in (kinds if d == 0 else kinds[::-1])], p["char_u"][d])[-1] for d in (0, 1)]
            hashed[piece] = np.concatenate([p["words"][row.get(hash_of(core(piece)), 0)], *ends])
        return hashed[piece]

    def score(text):
        words = [x for w in text.split() for x in cut(w)]
        best = -np.inf
        for at in range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE):
            own = [vector(x) for x in words[at : at + toxicity.WINDOW]]
            both = [steps([v @ p["in"][d] + p["in_b"][d] for v in (own if d == 0 else own[::-1])], p["u"][d]) for d in (0, 1)]
            h = np.array([np.concatenate([f, b]) for f, b in zip(both[0], both[1][::-1])]).reshape(len(own), 2 * toxicity.H)
            e = np.tanh(h @ p["att"]) @ p["att_v"]
            a = np.exp(e - e.max()) / np.exp(e - e.max()).sum() if len(own) else e
            best = max(best, float((a[:, None] * h).sum(axis=0) @ p["out"] + p["out_b"][0]))
        return sigmoid(best)

    got = toxicity.Scorer(p, known).texts(pa.array(texts))
    assert np.allclose(got, [score(t) for t in texts], atol=1e-5)


def test_toxicity_keeps_settings_and_texts_aside(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(k, "you scum" if k % 3 == 0 else "a fine day") for k in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 0, int(k % 3 == 0)) for k in range(200)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(docs, labels).where("predicted != if(doc_id % 3 = 0, 1, 0)").count() == 0
    assert spark.conf.get(key) == before


def test_simhash_runs(spark):
    """Tile pairs are skipped in the runs of a real table, and runs of any size give the links of all pairs."""
    docs = spark.read.parquet(f"{FOLDER}/../sf0.1/documents.parquet")
    fps = np.array([r.fp for r in simhash.fingerprints(docs).select("fp").distinct().collect()], np.int64).view(np.uint64)
    blocks, agree, bits = simhash._blocks(len(fps), 4)
    mask = np.uint64((1 << bits) - 1)
    held = whole = 0
    for value in np.unique(fps & mask):
        count = np.sort(np.bitwise_count(fps[fps & mask == value]).astype(np.int64))
        tiles = -(-len(count) // 256)
        held, whole = held + len(simhash.near_tiles(count, 4, 256)), whole + tiles * (tiles + 1) // 2
    assert 0 < held < 0.9 * whole and len(fps) / (1 << bits) >= 1024
    rng = np.random.default_rng(9)
    some = rng.integers(0, 1 << 63, 700, np.int64)
    for k in range(1, 5):
        some = np.append(some, some[:150] ^ (1 << rng.integers(0, 63, 150)))
    want = {int(x): 0 for x in some}
    u = np.unique(some).view(np.uint64)
    a, b = np.nonzero(np.bitwise_count(u[:, None] ^ u[None]) <= 4)
    root = simhash.forest(a, b, len(u))
    frame = spark.createDataFrame([(int(x), k) for k, x in enumerate(np.unique(some))], "fp long, rep long")
    for run in (1, 64, 1 << 20):  # whole blocks, some bits of each, one run
        simhash.RUN, before = run, simhash.RUN
        try:
            links = simhash.near_fingerprints(frame, 4).collect()
        finally:
            simhash.RUN = before
        got = simhash.forest(np.array([r.src for r in links]), np.array([r.dst for r in links]), len(u))
        assert (got == root).all() and len(want) == len(u)


@pytest.mark.parametrize("most", [x[0] for x in lattice_dedup.LEVELS])
def test_lattice_levels(spark, most):
    """At each level nine tenths of the links at a cosine of 0.9 exactly are found, and few of the pairs of random vectors are compared."""
    tables, probes, width = next(x[1:] for x in lattice_dedup.LEVELS if x[0] == most)
    rng = np.random.default_rng(10)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    base = unit(rng.normal(size=(400, 64)))
    off = rng.normal(size=(400, 64))
    off = unit(off - (off * base).sum(axis=1, keepdims=True) * base)
    v = np.concatenate([base, 0.9005 * base + np.sqrt(1 - 0.9005**2) * off])
    frame = spark.createDataFrame([(k, [float(x) for x in row], 1, "x") for k, row in enumerate(v)] + [(0, [float(x) for x in v[0]], 1, "x")], "vec_id long, embedding array<double>, tab int, cell string")
    got = lattice_dedup.lattice_dedup(frame, level=(tables, probes, width)).collect()
    assert len(got) == 801 and sum(r.n_links for r in got if r.vec_id >= 400) >= 0.9 * 400
    assert [r.n_links >= 1 and r.component_id == 0 for r in got if r.vec_id == 0] == [True, True]  # one id twice
    random = unit(rng.normal(size=(20_000, 64)))
    cells = lattice_dedup.Lattice(64, tables, probes, width).cells(random)
    compared = 0.0
    for t in range(tables):
        own, n = np.unique(cells[:, t, 0], return_counts=True)
        at = np.minimum(np.searchsorted(own, cells[:1000, t]), len(own) - 1)
        compared += np.where(own[at] == cells[:1000, t], n[at], 0).sum() / 1000
    assert compared < {100_000: 0.018, 1_000_000: 0.0045}.get(most, 0.003) * len(random)
