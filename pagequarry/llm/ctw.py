"""Scoring texts by context-tree weighting over bytes.

A byte is eight binary decisions, each with a tree of contexts of its own: the bits of the byte so far and
the 0 to DEPTH bytes before it. A text is the UTF-8 bytes with A-Z lower-cased, as for the words, and ends
with the byte 255, which no UTF-8 text holds; the same byte stands before its first one as context. Each node holds how often a 0 and a 1 followed in the training texts, and
its Krichevsky-Trofimov estimate; a node's weighted probability is the mean of its own estimate and of the
product of its children's, so all depths are mixed, by how well each told the training texts. A text's
score is the log of the product of its bytes' mixed probabilities, end of text included.

Nothing of the corpus is broadcast or collected but the two top levels of the trees, at most 256 contexts
of 255 nodes. The rest is dealt by the last two bytes of context: a group of documents asks a bucket for
the probability of each different byte-in-context that it holds, and in the same way for the counts of
its different words, from which the unigram base score comes. So what travels grows with the corpus.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import exchange as X
from .words import Words

DEPTH = 5
#: Stands before and behind each text; never part of UTF-8.
EDGE = 255
#: Bytes of the mask with which contexts are numbered; beyond that they are sorted.
MASK = 1 << 27
HALF = math.log(0.5)
WORDS, GRAMS = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive values, by Stirling's series after a shift by eight."""
    shift = np.ones_like(x)
    for k in range(8):
        shift *= x + k
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi) - log_gamma(zeros + ones + 1)


def fold(n: str, folds: int):
    return F.pmod(F.crc32(F.col(n).cast("string")), F.lit(folds))


class Level:
    """The binary nodes of all contexts of one depth: sorted keys (context, node 1 to 255) and their counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        # codes: context bytes, the nearest first, then the symbol; sorted
        context, symbol = codes >> 8, codes & 255
        keys, zeros, ones = [], [], []
        for b in range(8):
            key = (context << 8) | (1 << b) | (symbol >> (8 - b))
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            bit = (symbol >> (7 - b)) & 1
            keys.append(key[first])
            ones.append(np.add.reduceat(counts * bit, first))
            zeros.append(np.add.reduceat(counts, first) - ones[-1])
        key = np.concatenate(keys)
        order = np.argsort(key)
        self.keys, self.zeros, self.ones = key[order], np.concatenate(zeros)[order], np.concatenate(ones)[order]
        self.own = log_kt(self.zeros, self.ones)
        self.kt = (self.ones + 0.5) / (self.zeros + self.ones + 1)

    def weigh(self, below: np.ndarray | None) -> None:
        """below: the sum of the children's logs; none at the greatest depth."""
        self.log = self.own if below is None else np.logaddexp(HALF + self.own, HALF + below)
        self.trust = None if below is None else np.exp(HALF + self.own - self.log)


def shorter(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same counts with the farthest byte of context left out."""
    cut = ((codes >> 16) << 8) | (codes & 255)
    order = np.argsort(cut, kind="stable")
    cut, counts = cut[order], counts[order]
    first = np.flatnonzero(np.append(True, cut[1:] != cut[:-1]))
    return cut[first], np.add.reduceat(counts, first)


class Trees:
    """The trees below depth 1 of some contexts: codes of DEPTH bytes of context and the symbol, sorted and different."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes = codes
        at, n, self.levels = codes, counts.astype(float), {}
        for d in range(DEPTH, 1, -1):
            self.levels[d] = Level(at, n)
            at, n = shorter(at, n)
        self.up = {}
        self.levels[DEPTH].weigh(None)
        for d in range(DEPTH - 1, 1, -1):
            child, level = self.levels[d + 1], self.levels[d]
            self.up[d] = np.searchsorted(level.keys, ((child.keys >> 16) << 8) | (child.keys & 255))
            level.weigh(np.bincount(self.up[d], child.log, len(level.keys)))

    def tops(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(key, zeros, ones, log) summed to contexts of one byte."""
        level = self.levels[2]
        key, back = np.unique(((level.keys >> 16) << 8) | (level.keys & 255), return_inverse=True)
        return key, *(np.bincount(back, v, len(key)) for v in (level.zeros, level.ones, level.log))

    def log_probability(self, top: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Natural logs of the mixed probability of each code; top: (trust, estimate) of depths 0 and 1 by node."""
        deep = self.levels[DEPTH]
        p, at = deep.kt, np.arange(len(deep.keys))
        for d in range(DEPTH - 1, 1, -1):
            at, level = self.up[d][at], self.levels[d]
            p = level.trust[at] * level.kt[at] + (1 - level.trust[at]) * p
        near, node = deep.keys >> (8 * DEPTH), deep.keys & 255
        for (trust, kt), k in ((top[1], near * 256 + node), (top[0], node)):
            p = trust[k] * kt[k] + (1 - trust[k]) * p
        out = np.zeros(len(self.codes))
        context, symbol = self.codes >> 8, self.codes & 255
        for b in range(8):
            q = p[np.searchsorted(deep.keys, (context << 8) | (1 << b) | (symbol >> (8 - b)))]
            out += np.log(np.where((symbol >> (7 - b)) & 1, q, 1 - q))
        return out


def parts(codes: np.ndarray, most: int = 60_000):
    """Cuts sorted codes into ranges of about so many, never within a context of two bytes."""
    first = np.flatnonzero(np.append(True, np.diff(codes >> (8 * (DEPTH - 1))) != 0))
    lo = 0
    for hi in [*first[1:].tolist(), len(codes)]:
        if hi - lo >= most or hi == len(codes):
            yield slice(lo, hi)
            lo = hi


def top_levels(rows: list[tuple[int, float, float, float]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(trust, estimate) by node of depth 0, and by context and node of depth 1."""
    zeros, ones, below = (np.zeros(65536) for _ in range(3))
    for key, z, o, log in rows:
        zeros[key], ones[key], below[key] = z, o, log
    out = []
    for _ in range(2):
        own = log_kt(zeros, ones)
        log = np.logaddexp(HALF + own, HALF + below)
        out.append((np.exp(HALF + own - log), (ones + 0.5) / (zeros + ones + 1)))
        zeros, ones, below = (v.reshape(-1, 256).sum(axis=0) for v in (zeros, ones, log))
    return out[::-1]


class Corpus:
    """The different words and bytes-in-context of a block, and where they occur."""

    def __init__(self, table: pa.Table):
        self.block = b = X.Block(table)
        self.words = Words(b)
        self.hash, word = np.unique(self.words.hashes(_LOWER[b.bytes]), return_inverse=True)
        self.word = word.astype(np.int32)
        # each text behind DEPTH bytes EDGE of context and before one that ends it
        sizes = np.diff(b.at)
        self.begin = b.at[:-1] + (DEPTH + 1) * np.arange(b.n) + DEPTH
        lower = _LOWER[b.bytes]
        wide = np.full(len(b.bytes) + (DEPTH + 1) * b.n, EDGE, np.uint8)
        symbol = np.zeros(len(wide), bool)
        for lo, n, at in zip(b.at.tolist(), sizes.tolist(), self.begin.tolist()):
            wide[at : at + n] = lower[lo : lo + n]
            symbol[at : at + n + 1] = True
        place = np.flatnonzero(symbol).astype(np.int32)
        self.starts = np.append(0, np.cumsum(sizes + 1))
        used = np.flatnonzero(np.bincount(wide, minlength=256))
        number_of = np.zeros(256, np.int32)
        number_of[used] = np.arange(len(used))
        small, base = number_of[wide], len(used)
        ident = small[place - DEPTH] if len(place) else np.zeros(0, np.int32)
        count = base
        for back in range(DEPTH - 1, -1, -1):
            if count * base <= MASK:
                ident = ident * np.int32(base) + small[place - back]
                there = np.zeros(count * base, bool)
                there[ident] = True
                number = np.cumsum(there, dtype=np.int32) - np.int32(1)
                ident, count = number[ident], int(number[-1]) + 1
            else:  # very long texts: the same numbers by sorting
                known, ident = np.unique(ident.astype(np.int64) * base + small[place - back], return_inverse=True)
                ident, count = ident.astype(np.int32), len(known)
        where = np.zeros(count, np.int32)
        where[ident] = place
        self.codes = np.zeros(count if len(place) else 0, np.int64)
        if len(place):
            for k in range(1, DEPTH + 1):
                self.codes = (self.codes << 8) | wide[where - k]
            self.codes = (self.codes << 8) | wide[where]
        order = np.argsort(self.codes)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.codes, self.gram = self.codes[order], rank[ident] if len(order) else ident

    def buckets(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return X.bucket_of(self.hash, n), X.bucket_of(X.mix((self.codes >> (8 * (DEPTH - 1))).astype(np.uint64) + np.uint64(99)), n)


ASKED = pa.schema([("g", pa.int32()), ("bucket", pa.int64()), ("stage", pa.int32()), ("rows", pa.binary()), ("counts", pa.binary())])
ASKED_SQL = "g int, bucket long, stage int, rows binary, counts binary"
#: A bucket in one row: what all groups ask of it, and the sums that the tops of the trees need.
MET = pa.schema([("bucket", pa.int64()), *[(n, pa.list_(ASKED.field(n).type)) for n in ("g", "stage", "rows", "counts")], ("words", pa.list_(pa.float64())), ("key", pa.list_(pa.int64())), *[(n, pa.list_(pa.float64())) for n in ("zeros", "ones", "log")]])
MET_SQL = "bucket long, g array<int>, stage array<int>, rows array<binary>, counts array<binary>, words array<double>, key array<long>, zeros array<double>, ones array<double>, log array<double>"


def _read(table: pa.Table, stage: int) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The rows of a stage: (table, different keys, counts of each, key of each item, where each row's items begin)."""
    mine = table.filter(pc.equal(table.column("stage"), stage))
    rows = [X.unsqueeze(r.as_py(), np.int64) if stage == GRAMS else X.from_low(np.frombuffer(r.as_py(), np.uint8).reshape(-1, 6)) for r in mine.column("rows")]
    counts = [X.unsqueeze(c.as_py(), np.uint32) for c in mine.column("counts")]
    if not rows:
        return mine, np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(1, np.int64)
    keys, back = np.unique(np.concatenate(rows), return_inverse=True)
    return mine, keys, np.bincount(back, np.concatenate(counts), len(keys)), back.astype(np.int32), np.cumsum([0, *map(len, rows)])


def _gather(table: pa.Table) -> pa.Table:
    """One row of MET for a bucket."""
    _, _, words, _, _ = _read(table, WORDS)
    _, codes, counts, _, _ = _read(table, GRAMS)
    tops = [Trees(codes[at], counts[at]).tops() for at in parts(codes)] if len(codes) else []
    tops = [np.concatenate(v) for v in zip(*tops)] if tops else [np.zeros(0)] * 4
    out = {"bucket": [table.column("bucket")[0].as_py()]} | {n: [table.column(n).to_pylist()] for n in ("g", "stage", "rows", "counts")}
    out |= {"words": [[float(np.sum(words > 0)), float(words.sum())]]} | {n: [v] for n, v in zip(("key", "zeros", "ones", "log"), tops)}
    return pa.table(out, schema=MET)


def context_tree_scores(docs: DataFrame, folds: int = 7, held_fold: int = 2, doc_id: str = "doc_id", text: str = "text", group_bytes: int = 3 << 20, bucket_bytes: int = 8 << 20) -> DataFrame:
    """Scores every text, learning from those whose fold (CRC-32 of the id as text, modulo folds) is not held_fold.

    Returns one row per row of docs: doc_id, held_out, n_tokens (words and one end), n_known (tokens met in
    training), train_tokens, base_score (log10, unigrams with one added), score (log10 of the text's
    probability) and bits_per_byte. A null text is empty; a very long text is one task's work; a null id is
    trained on and not held out; repeated rows count as often as they occur; an empty table gives no rows;
    other columns, whatever their names, are ignored.
    """
    n_groups, n_buckets = X.counts_for(X.total_bytes(docs, text), group_bytes, bucket_bytes)
    held = F.coalesce(fold("doc_id", folds) == held_fold, F.lit(False))
    dealt = X.grouped(docs, n_groups, doc_id, text)
    held_ids = lambda ids: np.array([i is not None and zlib.crc32(str(i).encode()) % folds == held_fold for i in ids.to_pylist()], bool)

    def ask(table: pa.Table) -> pa.Table:
        x = Corpus(table)
        g = table.column("g")[0].as_py()
        train = ~held_ids(x.block.raw_ids)
        out = {k: [] for k in ASKED.names}
        own = train[x.words.of].astype(np.float64)
        symbols = np.repeat(train, np.diff(x.starts)).astype(np.float64)
        items = ((WORDS, x.hash, np.bincount(x.word, own, len(x.hash))), (GRAMS, x.codes, np.bincount(x.gram, symbols, len(x.codes))))
        for (stage, keys, counts), bucket in zip(items, x.buckets(n_buckets)):
            order, found, bounds = X.by_bucket(bucket)
            for b, lo, hi in zip(found, bounds, bounds[1:]):
                at = order[lo:hi]
                for name, value in zip(ASKED.names, (g, int(b), stage, X.squeeze(keys[at]) if stage == GRAMS else X.low_bytes(keys[at], 6).tobytes(), X.squeeze(counts[at].astype(np.uint32)))):
                    out[name].append(value)
        return pa.table(out, schema=ASKED)

    met = written(dealt.groupBy("g").applyInArrow(X.lean(ask), ASKED_SQL).groupBy("bucket").applyInArrow(X.lean(_gather), MET_SQL))
    nodes = met.select(F.inline(F.arrays_zip("key", "zeros", "ones", "log"))).groupBy("key").agg(F.sum("zeros"), F.sum("ones"), F.sum("log"))
    top = top_levels([tuple(r) for r in nodes.collect()])  # at most 256 * 255 rows
    ends = docs.select(F.col(doc_id).cast("long").alias("doc_id")).where(~held).count()
    distinct, tokens = (int(x or 0) for x in met.agg(F.sum(F.col("words")[0]), F.sum(F.col("words")[1])).first())
    tokens, distinct = tokens + ends, distinct + (ends > 0)

    def tell(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].values for n in ("g", "stage", "rows", "counts")}
                table = pa.table(row | {"bucket": pa.array([batch.column("bucket")[k].as_py()] * len(row["g"]), pa.int64())})
                mine, _, counts, back, bounds = _read(table, WORDS)
                if mine.num_rows:
                    yield from X.answer(mine, WORDS, counts[back].astype(np.uint32), bounds).to_batches()
                mine, codes, counts, back, bounds = _read(table, GRAMS)
                if mine.num_rows:
                    yield from X.answer(mine, GRAMS, np.concatenate([Trees(codes[at], counts[at]).log_probability(top).astype(np.float32) for at in parts(codes)])[back], bounds).to_batches()

    def score(table: pa.Table, told: pa.Table) -> pa.Table:
        x = Corpus(table)
        words, grams = x.buckets(n_buckets)
        counts = X.answers(told, WORDS, words, np.uint32)[x.word].astype(np.float64)
        logs = X.answers(told, GRAMS, grams, np.float32)[x.gram].astype(np.float64)
        n_words, bits = np.diff(x.words.bound), np.diff(x.starts)

        def per_text(values, bound):
            sums = np.append(0.0, np.cumsum(values))
            return sums[bound[1:]] - sums[bound[:-1]]

        base = per_text(np.log10(counts + 1), x.words.bound) + math.log10(ends + 1) - (n_words + 1) * math.log10(tokens + distinct + 1)
        total = per_text(logs, x.starts) / math.log(10)
        known = per_text(counts > 0, x.words.bound).astype(np.int64) + (ends > 0)
        out = [x.block.raw_ids, held_ids(x.block.raw_ids), n_words + 1, known, np.full(x.block.n, tokens), base, total, -total * math.log2(10) / bits]
        return pa.table(dict(zip(("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"), out)))

    told = met.select("bucket", "g", "stage", "rows", "counts").mapInArrow(tell, X.ANSWER_SQL)
    return dealt.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(X.lean_pair(score), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
