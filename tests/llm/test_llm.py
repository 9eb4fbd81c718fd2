"""The training-data operators against brute force, and their edge cases."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagequarry.llm import ctw, media, queries, toxicity, warc
from pagequarry.llm.gsaca import suffix_array
from pagequarry.llm.lattice_dedup import ROOTS, lattice_dedup, nearest_e8
from pagequarry.llm.mixing import mix_sources, pivot_pairs
from pagequarry.llm.packing import pack
from pagequarry.llm.simhash import compare_tiles, fingerprint, simhash_dedup
from pagequarry.llm.suffix_dedup import suffix_dedup
from pagequarry.llm.window_dedup import lengths_to, window_dedup

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g int, bucket string, fp string, copies int"


def cover(items, width):
    """Which items are in a run of `width` that also starts in an earlier list."""
    seen, out = set(), []
    for own in items:
        gone, new = [False] * len(own), set()
        for p in range(len(own) - width + 1):
            run = tuple(own[p : p + width]) if not isinstance(own, bytes) else own[p : p + width]
            if run in seen:
                gone[p : p + width] = [True] * width
            new.add(run)
        seen |= new
        out.append(gone)
    return out


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, copies, and columns whose names clash with our own."""
    rng = np.random.default_rng(1)
    word = ["alpha", "beta", "gämma", "delta", "x", "of", "the"]
    long = " ".join(rng.choice(word, 40_000))
    shared = " ".join(rng.choice(word, 80))
    texts = [None, "", "   ", "one two", long, long[:3000] + " ! " + shared, shared, shared, "pre " + shared + " post", "a" * 400, "a" * 300, "\n\t x y", "idiot " * 60]
    rows = [(i, t, "en", [None, "s1", "s0", "s1"][i % 4], None, i, "b", "f", 2) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (50, None, None, None, None, None, None, None, None), (None, shared, None, "s1", 3, 0, "", "", 0)], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(400):
        a = rng.integers(0, rng.integers(1, 5), rng.integers(0, 60))
        s = a.tolist()
        assert suffix_array(a).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_suffix_dedup(spark, odd, none):
    for docs in (odd.where("doc_id is not null"), spark.read.parquet(f"{FOLDER}/documents.parquet")):
        rows = sorted((r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect())
        got = {r.doc_id: r for r in suffix_dedup(docs).collect()}
        for (k, text), gone in zip(rows, cover([t for _, t in rows], 50)):
            assert (got[k].n_bytes, got[k].n_removed) == (len(text), sum(gone))
            assert bytes(got[k].kept) == bytes(c for c, g in zip(text, gone) if not g)
    assert suffix_dedup(odd).count() == odd.count()
    assert suffix_dedup(none).count() == 0


def test_window_dedup(spark, odd, none):
    for docs in (odd.where("doc_id is not null"), spark.read.parquet(f"{FOLDER}/documents.parquet")):
        rows = sorted((r.doc_id, (r.text or "").encode().split()) for r in docs.select("doc_id", "text").collect())
        got = {r.doc_id: r for r in window_dedup(docs).collect()}
        for (k, words), gone in zip(rows, cover([w for _, w in rows], 50)):
            assert (got[k].n_words, got[k].n_removed) == (len(words), sum(gone))
            assert got[k].kept_text.encode() == b" ".join(w for w, g in zip(words, gone) if not g)
    assert window_dedup(odd).count() == odd.count()
    assert lengths_to(50) == [13, 25, 50] and lengths_to(7) == [7] and lengths_to(100) == [13, 25, 50, 100]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted((r.doc_id, (r.text or "").encode().split()) for r in docs.select("doc_id", "text").collect())
    for window in (9, 30, 120):  # one, three and five levels
        got = {r.doc_id: r.n_removed for r in window_dedup(docs, window).collect()}
        assert got == {k: sum(gone) for (k, _), gone in zip(rows, cover([w for _, w in rows], window))}
    assert window_dedup(none).count() == 0


def test_lattice(spark):
    y = np.random.default_rng(1).normal(size=(200, 8)) * 2
    p = nearest_e8(y)
    far = ((y - p) ** 2).sum(1)
    assert far.max() <= 1 + 1e-9 and (((y[:, None] - p[:, None] - ROOTS) ** 2).sum(2) >= far[:, None] - 1e-9).all()
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    off = rng.normal(size=(300, 64))
    off -= (off * base).sum(1, keepdims=True) * base
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    cos = rng.uniform(0.9, 1.0, (300, 1))
    v = np.concatenate([base, cos * base + np.sqrt(1 - cos**2) * off, base[:5], base[:2] * 3])
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(v)]
    rows += [(900, None), (901, []), (902, [0.0] * 64), (903, [math.nan] * 64), (904, [None] * 64), (905, [1.0]), (None, [1.0] * 64)]
    got = {r.vec_id: r for r in lattice_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(1) - 1
    found = np.array([got[i].n_links for i in range(len(v))])
    assert (found <= want).all() and found.sum() >= 0.9 * want.sum()
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in range(900, 906))
    assert lattice_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_lattice_sizes(spark):
    """A longer or shorter vector leaves the links of the others alone; each size has its own."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.repeat(rng.normal(size=(20, 64)), 2, axis=0) * rng.uniform(1, 2, (40, 1)))]
    long = [float(x) for x in rng.normal(size=65)]
    rows += [(100, long), (101, [2 * x for x in long]), (102, [1.0, 2.0]), (103, [2.0, 4.0]), (104, [1.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    want = {i: (1, i // 2 * 2, i % 2 == 0) for i in [*range(40), 100, 101, 102, 103]} | {104: (0, 104, True)}
    assert got == want


def test_mixing(spark, odd, none):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = mix_sources(docs).toPandas()
    per = got.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert abs(per.target.sum() - 1.5 * per["size"].sum()) < 1e-6 * per.target.sum()
    assert (per.target <= 2 * per["size"] + 1e-6).all() and (got.taken <= 2 * got["size"]).all()
    assert (abs(per.taken - per.target) <= got["size"].groupby(got.source).max()).all()
    again = mix_sources(docs.repartition(5)).toPandas()
    assert got.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()
    one = mix_sources(odd).toPandas()
    assert len(one) == odd.count() and mix_sources(none).count() == 0
    size, taken = np.array([50, 30, 9, 8, 2, 1]), np.zeros(6)
    for seed in range(4000):
        p, left = pivot_pairs(size, np.full(6, 0.3), np.random.default_rng(seed).random)
        assert abs((p * size).sum() - 0.3 * size.sum()) < 1e-6
        assert all(x in (0, 1) or i == left for i, x in enumerate(p.tolist()))
        taken += p
    assert abs(taken / 4000 - 0.3).max() < 0.04
    # targets against a plain version: what exceeds twice a source's size is shared again until none does
    for table in (docs, odd):
        rows = table.select("source", "text").collect()
        sizes = {}
        for r in rows:
            sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").encode().split())
        order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
        want, left, free = {}, 1.5 * sum(sizes.values()), set(sizes)
        while free:
            full = {s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * sizes[s]}
            if not full:
                want |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
                break
            want |= {s: 2.0 * sizes[s] for s in full}
            left -= sum(2.0 * sizes[s] for s in full)
            free -= full
        mixed = mix_sources(table).collect()
        assert all(abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) and r.source_size == sizes[r.source] for r in mixed)


def test_warc(spark, monkeypatch):
    kind = "page_id long, url string, html string, digest int, archive string, copies int, state int"
    pages = spark.createDataFrame([(1, "http://a", "<p>é</p>", 0, "", 0, 0), (2, None, None, 1, "", 0, 0), (None, "u", "", 2, "", 0, 0), (1, "http://a", "<p>é</p>", 3, "", 0, 0), (3, "u", "x" * 100_000, 4, "", 0, 0)], kind)
    replica = spark.createDataFrame([(1, "http://a", "<p>x</p>", 0, "", 0, 0), (2, "", "", 1, "", 0, 0), (9, "u", "", 2, "", 0, 0), (3, "u", "x" * 100_000, 4, "", 0, 0)], kind)
    got = warc.audit(pages, replica).collect()
    assert sorted((str(r.page_id), r.state, r.copies) for r in got) == [("1", "altered", 2), ("2", "intact", 1), ("3", "intact", 1), ("9", "added", 1), ("None", "missing", 1)]
    back = {(r.url, r.html) for r in warc.read_archives(warc.archives(pages)).collect()}
    assert back == {("http://a", "<p>é</p>"), ("", ""), ("u", ""), ("u", "x" * 100_000)}
    assert {r.state for r in warc.audit(pages, pages.limit(0)).collect()} == {"missing"} and warc.audit(pages.limit(0), pages.limit(0)).count() == 0
    # many records: what was lost, added and changed is found, and only ranges that differ are gone into
    monkeypatch.setattr(warc, "ARCHIVE", 256)
    many = spark.range(3000).selectExpr("id AS page_id", "concat('http://h/', id) AS url", "repeat('ab', int(id % 50)) AS html")
    other = many.where("page_id % 500 != 7").selectExpr("page_id", "url", "IF(page_id % 400 = 3, 'changed', html) AS html").union(many.where("page_id % 900 = 5").selectExpr("page_id + 10000", "url", "html"))
    states = {r.page_id: r.state for r in warc.audit(many, other).collect()}
    want = {i: "missing" if i % 500 == 7 else "altered" if i % 400 == 3 else "intact" for i in range(3000)} | {i + 10000: "added" for i in range(3000) if i % 900 == 5}
    assert states == want
    mine, theirs = warc.manifest(many), warc.manifest(other, 12)
    bad = warc.damaged(warc.levels(mine), warc.levels(theirs)).count()
    assert bad <= 6 + 2 * 8 + 4 and mine.where("start < 0 or start > offset").count() == 0


def test_warc_copies(spark):
    """A copy that was lost or added is told of, in a range that otherwise agrees."""
    row = lambda k: (k, f"http://x/{k}", "t")
    frame = lambda ids: spark.createDataFrame([row(k) for k in ids], "page_id long, url string, html string")
    pages, replica = frame([1, 1, 2, 3, 3, 4, None, None]), frame([1, 2, 2, 3, 3, None, 5])
    got = sorted(((r.page_id, r.copies, r.state) for r in warc.audit(pages, replica).collect()), key=str)
    assert got == sorted([(1, 2, "fewer"), (2, 1, "more"), (3, 2, "intact"), (4, 1, "missing"), (None, 2, "fewer"), (5, 1, "added")], key=str)


def test_warc_parse():
    def one(body, name=b"Content-Length", n=None):
        return b"WARC/1.1\r\nWARC-Record-ID: <r>\r\n%s: %d\r\n\r\n%s\r\n\r\n" % (name, len(body) if n is None else n, body)

    good, low, cut = one(b"body"), one(b"", b"content-length"), one(b"b", n=3)
    assert list(warc.parse(b"junk")) == [(0, 4, None, b"junk")] and list(warc.parse(b"")) == []
    got = list(warc.parse(good + b"junk" + low + cut + good))
    assert [(h is not None, body) for _, _, h, body in got] == [(True, b"body"), (False, b"junk"), (True, b""), (False, cut), (True, b"body")]
    at = 0
    for offset, length, _, _ in got:
        assert offset == at
        at += length
    assert at == len(good + b"junk" + low + cut + good)
    assert [h is not None for _, _, h, _ in warc.parse(good[:-3])] == [False]


def test_simhash(spark, odd, none):
    rng = np.random.default_rng(3)
    fp = rng.integers(0, 2**63, 300, dtype=np.uint64)
    fp[:50] = fp[100:150] ^ (np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64))
    a, b = compare_tiles(fp, 4, tile=37)
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if (int(fp[i]) ^ int(fp[j])).bit_count() <= 4}
    assert {(min(x), max(x)) for x in zip(a.tolist(), b.tolist())} == want
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r.doc_id: r for r in simhash_dedup(docs).collect()}
    prints = {r.doc_id: fingerprint(r.text.encode()) for r in docs.collect()}
    low = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if low[j] < low[i] and (prints[i] ^ prints[j]).bit_count() <= 4:
                    low[i], changed = low[j], True
    assert {i: (r.fp & (2**64 - 1), r.component_id) for i, r in got.items()} == {i: (prints[i], low[i]) for i in prints}
    edge = {r.doc_id: r for r in simhash_dedup(odd).collect()}
    assert edge[1].fp == 0 and edge[50].component_id == 0 and edge[None].component_id is None and edge[7].component_id == 6
    assert simhash_dedup(none).count() == 0


def test_toxicity(spark, odd):
    rng = np.random.default_rng(5)
    words = ["wa", "lo", "mi", "ter", "san", "pol", "ne"]
    docs, labels = [], []
    for i in range(400):
        text = ["".join(rng.choice(words, 2)) for _ in range(60)]
        if i % 4 == 0:
            text[int(rng.integers(60))] = ["grobble", "snark"][i % 8 // 4]
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = [r for r in toxicity.toxicity(docs, labels).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got) and len(got) > 50
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in got) >= 0.9 * len(got)
    scored = toxicity.toxicity(odd, labels).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_toxicity_long_words():
    """Every byte of a word without spaces is read, and a term joined to others otherwise than by spaces is found."""
    rng = np.random.default_rng(6)
    parts = ["wa", "lo", "mi", "ter", "san", "pol", "ne"]

    def words(n):
        return ["".join(rng.choice(parts, 2)) for _ in range(n)]

    texts, toxic = [], np.arange(240) % 4 == 0
    for bad in toxic:
        text = words(60)
        if bad:
            text[int(rng.integers(60))] = "grobble"
        texts.append(" ".join(text))
    params, known = toxicity.train(texts, toxic.astype(np.int64))
    score = toxicity.Scorer(params, known)
    for joint in ("_", ",", "\u00a0", "\u3000", "--"):
        half = [joint.join(words(900)) for _ in (0, 1)]
        clean, bad = (joint.join([half[0], middle, half[1]]) for middle in ("wami", "grobble"))
        assert len(bad.encode()) >= 9_000
        got = score.texts(pa.array([clean, bad]))
        assert got[0] < 0.5 <= got[1], joint
    one, two = ("".join(parts) * 330 + middle + "".join(parts) * 330 for middle in ("wami", "grobble"))
    assert len(two) > 10_000 and np.ptp(score.texts(pa.array([one, two]))) > 0
    table = pa.table({"doc_id": pa.array([0, 1, 2]), "text": pa.array([one, "short", "x" * 25 + "_y"])})
    block = toxicity.Block(table)
    data = toxicity._LOWER[block.bytes]
    cut = toxicity.Words(block)
    whole = list(zip(cut.starts, cut.ends))
    toxicity.pieces(cut, block, data)
    read = np.zeros(len(data), bool)
    for lo, hi in zip(cut.starts, cut.ends):
        assert 0 < hi - lo <= toxicity.LONGEST
        read[lo:hi] = True
    assert all(read[lo:hi].all() for lo, hi in whole) and len(cut.bound) == 4 and cut.bound[2] - cut.bound[1] == 1


def test_gru_gradient():
    rng = np.random.default_rng(0)
    x, u, mask = rng.normal(size=(4, 3, 6)), rng.normal(size=(2, 6)), rng.random((4, 3)) < 0.8
    weight = rng.normal(size=(4, 3, 2))
    _, cache = toxicity.gru(x, mask, u, keep=True)
    dx, du = toxicity.gru_back(weight, mask, u, cache)
    for grad, value in ((dx, x), (du, u)):
        for at in ((0,) * value.ndim, tuple(s - 1 for s in value.shape)):
            value[at] += 1e-5
            up = (toxicity.gru(x, mask, u) * weight).sum()
            value[at] -= 2e-5
            down = (toxicity.gru(x, mask, u) * weight).sum()
            value[at] += 1e-5
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-6


def test_context_trees(spark, odd, none, monkeypatch):
    """Every weighted probability of a small corpus, by recursion over its nodes."""
    docs = spark.createDataFrame([(3, "aBab"), (4, "abba ab"), (6, None), (7, "ba"), (8, "A\0b"), (9, "a")], "doc_id long, text string")
    text_of = {r.doc_id: bytes([ctw.EDGE]) * ctw.DEPTH + (r.text or "").lower().encode() + bytes([ctw.EDGE]) for r in docs.collect()}
    train = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    counts = {}
    for r in train:
        data = text_of[r.doc_id]
        for i in range(ctw.DEPTH, len(data)):
            for d in range(ctw.DEPTH + 1):
                for b in range(8):
                    key = (data[i - d : i], b, data[i] >> (8 - b))
                    counts.setdefault(key, [0, 0])[data[i] >> (7 - b) & 1] += 1

    def kt(n):
        return math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.log(math.pi) - math.lgamma(sum(n) + 1)

    def weighted(key):
        if len(key[0]) == ctw.DEPTH:
            return kt(counts[key])
        below = sum(weighted(k) for k in list(counts) if len(k[0]) == len(key[0]) + 1 and k[0][1:] == key[0] and k[1:] == key[1:])
        return np.logaddexp(math.log(0.5) + kt(counts[key]), math.log(0.5) + below)

    memo = {k: weighted(k) for k in counts}

    def one(context, b, prefix, d=0):
        key = (context[len(context) - d :], b, prefix)
        n = counts.get(key, [0, 0])
        own = (n[1] + 0.5) / (sum(n) + 1)
        if d == ctw.DEPTH:
            return own
        trust = math.exp(math.log(0.5) + kt(n) - memo[key]) if key in memo else 0.5
        return trust * own + (1 - trust) * one(context, b, prefix, d + 1)

    got = {r.doc_id: r for r in ctw.context_tree_scores(docs).collect()}
    for r in docs.collect():
        data, total = text_of[r.doc_id], 0.0
        for i in range(ctw.DEPTH, len(data)):
            for b in range(8):
                p = one(data[i - ctw.DEPTH : i], b, data[i] >> (8 - b))
                total += math.log10(p if data[i] >> (7 - b) & 1 else 1 - p)
        assert abs(got[r.doc_id].score - total) < 1e-4
    assert ctw.context_tree_scores(odd).count() == odd.count()
    plain = {r.doc_id: r.score for r in ctw.context_tree_scores(odd).collect()}
    monkeypatch.setattr(ctw, "MASK", 0)
    table = pa.table({"doc_id": [1, 2], "text": ["abc abd " * 50, "xyz\0"]})
    sorted_codes = ctw.Corpus(table)
    monkeypatch.setattr(ctw, "MASK", 1 << 27)
    masked = ctw.Corpus(table)
    assert (sorted_codes.codes == masked.codes).all() and (sorted_codes.gram == masked.gram).all() and len(plain) == len(set(plain))
    assert ctw.context_tree_scores(none).count() == 0


def test_packing(spark, odd, none):
    from tokenizers import Tokenizer

    import public_tokenizers

    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = spark.createDataFrame([(70, "a<|endoftext|> b <|endoftext|><|endoftext|>c<|endof"), (71, "<|endoftext|>")], "doc_id long, text string")
    odd = odd.unionByName(special, allowMissingColumns=True)
    assert 50256 in tool.encode("<|endoftext|>", add_special_tokens=False).ids
    ids = {r.doc_id: np.array([*tool.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4") for r in odd.collect()}
    rows = pack(odd, **queries.tokenizer()).toPandas()
    for k, part in rows.fillna({"doc_id": -1}).groupby("doc_id"):
        own, at = ids[None if k == -1 else k], 0
        for r in part.sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[at : at + r.length].tobytes())
            at += r.length
        assert at == len(own)
    for _, s in rows.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *np.cumsum(s.length)[:-1]]
        n = int(s.length.sum())
        assert n == 2048 or n & (n - 1) == 0
    assert pack(none, **queries.tokenizer()).count() == 0


def test_media(spark):
    rng = np.random.default_rng(4)
    pictures = [np.kron(rng.uniform(20, 235, (16, 16)), np.ones((6, 6))) for _ in range(6)]
    rows = [(2 * i, media.encode_pgm(p)) for i, p in enumerate(pictures)] + [(2 * i + 1, media.encode_pgm(0.9 * p[5:85, 9:89] + 10)) for i, p in enumerate(pictures)]
    rows += [(90, None), (91, b""), (92, b"P5\n9 9\n255\n"), (93, rows[0][1]), (None, rows[0][1])]
    got = {r.image_id: r.component_id for r in media.image_copies(spark.createDataFrame(rows, "image_id long, image binary")).collect()}
    assert got == {i: i // 2 * 2 for i in range(12)} | {90: 90, 91: 91, 92: 92, 93: 0, None: None}
    assert media.image_copies(spark.createDataFrame([], "image_id long, image binary")).count() == 0


def some_corners(rng, images, per=30, kinds=40, flips=True):
    """Corners whose descriptors are a few common ones, with bits flipped or not, some images shifted copies of others."""
    out = []
    common = rng.integers(0, 1 << 62, (kinds, 4))
    for k in range(images):
        rows = [[k, *map(int, rng.integers(0, 300, 2)), int(rng.integers(0, 3)), int(rng.integers(0, 32)), [int(v) for v in common[rng.integers(kinds)]]] for _ in range(per)]
        if flips:
            for r in rows:
                for part in rng.choice(4, 3, replace=False):
                    r[5][part] ^= 1 << int(rng.integers(0, 62))
        if k % 10 in (1, 2) and out:  # copies of the image before, in a chain
            before = out[-1]
            rows[:7] = [[k, x + 5, y - 3, scale, turn, list(parts)] for _, x, y, scale, turn, parts in before[:7]]
        out.append(rows)
    return [tuple(r) for rows in out for r in rows]


def slow_links(rows, votes=5, grid=12.0):
    """Each pair of images with all their matches, one pair after the other."""
    images, out = {}, set()
    for r in rows:
        images.setdefault(r[0], []).append(r)
    for a in images:
        for b in images:
            cells = {}
            for _, ax, ay, ascale, aturn, aparts in images[a] if a < b else ():
                for _, bx, by, bscale, bturn, bparts in images[b]:
                    if any(p == q for p, q in zip(aparts, bparts)):
                        spin, grow = (bturn - aturn) % 32, 2.0 ** (bscale - ascale)
                        c, s = math.cos(spin * (2 * math.pi / 32)), math.sin(spin * (2 * math.pi / 32))
                        x, y = ax * grow, ay * grow
                        dx, dy = bx - (c * x - s * y), by - (s * x + c * y)
                        for half in (0, 0.5):
                            for turn in (0, 1):
                                cell = (half, turn, grow, (spin + turn) // 2 % 16, math.floor(dx / grid + half), math.floor(dy / grid + half))
                                cells.setdefault(cell, set()).add((ax, ay))
            if any(len(v) >= votes for v in cells.values()):
                out.add((a, b))
    return out


@pytest.mark.parametrize("flips, sent", [(True, 200_000), (False, 200_000), (True, 0)])
def test_media_partners(spark, monkeypatch, flips, sent):
    """The groups are those of all pairs of corners, however crowded the runs."""
    monkeypatch.setattr(media, "SENT_RUNS", sent)
    rows = some_corners(np.random.default_rng(8), 40, per=14, flips=flips)
    root = list(range(40))
    for a, b in sorted(slow_links(rows)):
        root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    corners = spark.createDataFrame(rows, "image_id long, x int, y int, scale int, turn int, parts array<long>")
    got = dict(enumerate(range(40))) | {r.node: r.component for r in media.image_links(corners).collect()}
    assert got == dict(enumerate(root)) and 1 < len(set(root)) < 40


def test_media_groups(spark):
    """Groups of 2, 20 and 1,000 different edits, amid unrelated images, are whole and apart."""
    rng = np.random.default_rng(12)
    rows, want = [], {}
    for size in (1,) * 60 + (2, 20, 1000):
        picture = np.kron(rng.uniform(20, 235, (16, 16)), np.ones((6, 6)))
        first = len(rows)
        for _ in range(size):
            y, x = rng.integers(0, 17, 2)
            edit = rng.uniform(0.7, 0.95) * picture[y : y + 80, x : x + 80] + rng.uniform(0, 10) + rng.normal(0, 1, (80, 80))
            want[len(rows)] = first
            rows.append((len(rows), media.encode_pgm(edit)))
    got = {r.image_id: r.component_id for r in media.image_copies(spark.createDataFrame(rows, "image_id long, image binary")).collect()}
    assert got == want


def test_pipeline(spark, tmp_path):
    """Each stage, on what the one before kept, against a plain version of what it decides."""
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    flagged = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    for name, stage in P.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        before, after = {r.doc_id: r for r in docs.collect()}, out.collect()
        if name != "pack":
            assert out.columns == docs.columns
        ids = [r.doc_id for r in after]
        if name == "toxicity":
            assert set(ids) == set(before) - flagged
        elif name == "simhash_dedup":
            assert set(ids) == {r.doc_id for r in simhash_dedup(docs).where("doc_id = component_id").collect()}
        elif name == "suffix_dedup":
            texts = [before[k].text.encode() for k in sorted(before)]
            for k, t, gone in zip(sorted(before), texts, cover(texts, 50)):
                kept = bytes(c for c, g in zip(t, gone) if not g).decode("utf-8", "ignore")
                assert {r.text for r in after if r.doc_id == k} == {kept}
        elif name == "mix_sources":
            want = {r.doc_id: r.copies for r in mix_sources(docs).where("taken > 0").collect()}
            assert {k: ids.count(k) for k in set(ids)} == {k: n for k, n in want.items() if n}
        else:
            assert sum(r.length for r in after) == sum(r.doc_tokens for r in after if r.start == 0)
        docs = out


def test_pipeline_odd(spark, odd, none):
    """Each stage over nulls, empty and long texts, repeated ids and clashing names, against plain versions of their own."""
    import corpus_pipeline as P

    extra = {"kept": F.lit(7), "time": F.lit(777), "times": F.lit(778), "row": F.lit("r"), "component_id": F.lit(-1), "carried": F.lit(0), "a b": F.lit(1)}
    docs = odd.withColumns(extra).union(odd.where("doc_id = 3").withColumns(extra)).withColumnRenamed("copies", "mixed_id")
    empty = none.withColumns(extra).withColumnRenamed("copies", "mixed_id")
    stages = dict(P.STAGES)
    texts = {r.doc_id: r.text for r in odd.collect()}
    for name, stage in P.STAGES[:4]:
        assert stage(spark, empty, FOLDER).count() == 0
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        rows = out.collect()
        assert all((r.kept, r.time, r.times, r.row, r.component_id, r["a b"]) == (7, 777, 778, "r", -1, 1) for r in rows)
        ids = [r.doc_id for r in rows]
        if name == "toxicity":
            scores = {r.doc_id: r.predicted for r in toxicity.toxicity(odd, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
            assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in docs.collect() if not scores[r.doc_id])
        elif name == "simhash_dedup":
            prints = {k: fingerprint((t or "").encode()) for k, t in texts.items() if k is not None}
            low = dict(zip(prints, prints))
            for _ in prints:
                low = {i: min(low[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 4) for i in prints}
            assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in docs.collect() if r.doc_id is None or low[r.doc_id] == r.doc_id)
        elif name == "suffix_dedup":
            known = sorted((k for k in texts if k is not None)) + [None]
            data = [(texts[k] or "").encode() for k in known]
            want = {k: bytes(c for c, g in zip(t, gone) if not g).decode("utf-8", "ignore") for k, t, gone in zip(known, data, cover(data, 50))}
            assert sorted((str(r.doc_id), r.text, r.n_chars) for r in rows) == sorted((str(r.doc_id), want[r.doc_id], len(want[r.doc_id])) for r in docs.collect())
        else:
            sizes = {k: len((t or "").encode().split()) for k, t in texts.items()}
            assert all(sizes[k] for k in ids) and max(ids.count(k) for k in set(ids)) <= 4 and ids.count(3) in (0, 2, 4)
            total = sum(sizes[r.doc_id] for r in docs.collect())
            assert abs(sum(sizes[k] for k in ids) - 1.5 * total) <= 0.5 * total
    packed = stages["pack"](spark, docs, FOLDER).collect()
    assert sum(r.length for r in packed) == sum(r.doc_tokens for r in packed if r.start == 0) and stages["pack"](spark, empty, FOLDER).count() == 0
