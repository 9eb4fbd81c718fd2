"""Toxicity scores from a bidirectional gated recurrent network, trained in numpy.

A word is a learned vector (if what it is without the signs at its ends was in five texts of the training sample)
beside the last states of a bidirectional GRU over its characters. A word of more than LONGEST bytes becomes several, so that every byte
is read: it is cut where letters, digits and non-ASCII bytes meet other bytes or a space that is none in
ASCII, and what is still longer into overlapping pieces of LONGEST bytes. A second bidirectional GRU reads the words of a window, attention
pools its states, and a logistic unit scores the window. A text is covered by overlapping windows of
WINDOW words, and its score is that of its highest window.

Training knows labels of whole texts only: at first every window of a toxic text counts as toxic, then
only the one that scores highest. The sample is bounded by a parameter; scoring covers all texts. A
worker keeps the input projections of words it has met, so characters are read once for each different
word rather than for each occurrence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import Block, release
from .lexical import hashes
from .words import Words

WINDOW, STRIDE = 32, 24
CHARS, LONGEST = 64, 24
WORD, CHAR_H, H = 8, 8, 8
#: Words whose projections a worker keeps; beyond that it starts anew from the words at hand.
KEPT_WORDS = 60_000

#: Classes of lower-case bytes: letters and digits their own, other ASCII and other bytes by a few.
_CLASS = np.full(256, 40, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CLASS[ord("0") : ord("9") + 1] = np.arange(27, 37)
_CLASS[list(b".,;:!?")] = 37
_CLASS[list(b"*@$#%&")] = 38
_CLASS[128:] = 41 + (np.arange(128) % 16)
#: ASCII bytes other than letters and digits.
_JOINT = (_CLASS >= 37) & (np.arange(256) < 128)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def gru(x: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: bool = False):
    """States (T, N, H) of a GRU whose inputs x (T, N, 3H: update, reset, new) are projected already; masked steps keep the state."""
    t, n, h3 = x.shape
    h = np.zeros((n, h3 // 3), x.dtype)
    out, cache = np.empty((t, n, h3 // 3), x.dtype), []
    k = h3 // 3
    for i in range(t):
        a = h @ u
        zr = _sigmoid(x[i, :, : 2 * k] + a[:, : 2 * k])
        z, r = zr[:, :k], zr[:, k:]
        new = np.tanh(x[i, :, 2 * k :] + r * a[:, 2 * k :])
        after = np.where(mask[i][:, None], new + z * (h - new), h)
        if keep:
            cache.append((h, z, r, new, a[:, 2 * k :]))
        out[i] = h = after
    return (out, cache) if keep else out


def gru_back(d_out: np.ndarray, mask: np.ndarray, u: np.ndarray, cache: list):
    """Gradients of the inputs and of u, given those of all states."""
    t, n, k = d_out.shape
    dx, du = np.zeros((t, n, 3 * k), d_out.dtype), np.zeros_like(u)
    dh = np.zeros((n, k), d_out.dtype)
    for i in range(t - 1, -1, -1):
        h, z, r, new, a = cache[i]
        dh = dh + d_out[i]
        m = mask[i][:, None]
        live = np.where(m, dh, 0)
        d_new = live * (1 - z) * (1 - new * new)
        d_z = live * (h - new) * z * (1 - z)
        d_r = d_new * a * r * (1 - r)
        dx[i] = np.concatenate([d_z, d_r, d_new], axis=1)
        da = np.concatenate([d_z, d_r, d_new * r], axis=1)
        du += h.T @ da
        dh = np.where(m, live * z, dh) + da @ u.T
    return dx, du


def sums_by(n: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums (n, K) of the rows of values (..., K) by the index of each."""
    out = np.zeros((n, values.shape[-1]), values.dtype)
    at, values = at.reshape(-1), values.reshape(-1, values.shape[-1])
    if len(at):
        order = np.argsort(at, kind="stable")
        starts = np.flatnonzero(np.diff(at[order], prepend=-1))
        out[at[order[starts]]] = np.add.reduceat(values[order], starts, axis=0)
    return out


class Net:
    """Parameters as a dict of float32 arrays; row 0 of the word vectors stands for all unknown words."""

    def __init__(self, n_words: int, seed: int = 3):
        rng = np.random.default_rng(seed)

        def w(*shape, by=0.3):
            return rng.normal(0, by, shape).astype(np.float32)

        self.p = {"chars": w(2, CHARS, 3 * CHAR_H), "char_u": w(2, CHAR_H, 3 * CHAR_H), "words": w(n_words, WORD, by=0.1), "in": w(2, WORD + 2 * CHAR_H, 3 * H), "in_b": w(2, 3 * H, by=0.01)}
        self.p |= {"u": w(2, H, 3 * H), "att": w(2 * H, 8), "att_v": w(8), "out": w(2 * H), "out_b": np.zeros(1, np.float32)}
        self.p["words"][0] = 0

    def characters(self, chars: np.ndarray, keep: bool = False):
        """Last states (N, 2 CHAR_H) over rows of character classes, 0 behind the end."""
        length = (chars > 0).sum(axis=1)
        back = np.where(np.arange(chars.shape[1]) < length[:, None], np.take_along_axis(chars, np.maximum(length[:, None] - 1 - np.arange(chars.shape[1]), 0), 1), 0)
        states, caches = [], []
        for d, c in enumerate((chars, back)):
            x = self.p["chars"][d][c.T]
            got = gru(x, c.T > 0, self.p["char_u"][d], keep)
            states.append((got[0] if keep else got)[-1])
            caches.append((c, got[1] if keep else None))
        return (np.concatenate(states, axis=1), caches) if keep else np.concatenate(states, axis=1)

    def projections(self, chars: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Inputs of both word GRUs (N, 2, 3H) for words of these characters and rows of word vectors."""
        states = np.empty((len(chars), 2 * CHAR_H), np.float32)
        length = (chars > 0).sum(axis=1)
        order = np.argsort(length, kind="stable")
        for lo in range(0, len(order), 4096):
            rows = order[lo : lo + 4096]
            states[rows] = self.characters(chars[rows, : max(1, length[rows[-1]])])
        v = np.concatenate([self.p["words"][word], states], axis=1)
        return np.stack([v @ self.p["in"][d] + self.p["in_b"][d] for d in (0, 1)], axis=1)

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Of windows: x (N, T, 2, 3H), mask (N, T)."""
        m = np.ascontiguousarray(mask.T)
        f = gru(np.ascontiguousarray(x[:, :, 0].swapaxes(0, 1)), m, self.p["u"][0], keep)
        b = gru(np.ascontiguousarray(x[:, ::-1, 1].swapaxes(0, 1)), m[::-1], self.p["u"][1], keep)
        h = np.concatenate([f[0] if keep else f, (b[0] if keep else b)[::-1]], axis=2)
        t = np.tanh(h @ self.p["att"])
        e = np.where(m, t @ self.p["att_v"], -30)
        a = np.exp(e - e.max(axis=0)) * m
        a /= a.sum(axis=0) + 1e-9
        pooled = (a[:, :, None] * h).sum(axis=0)
        out = pooled @ self.p["out"] + self.p["out_b"][0]
        return (out, (m, f[1], b[1], h, t, a, pooled)) if keep else out

    def step(self, chars, word, ids, mask, y, weight, adam: dict, rate: float) -> float:
        """One step of Adam on windows: ids (N, T) are rows of chars and word."""
        p, g = self.p, {}
        # short words and long ones apart, so that short ones take few steps
        length = (chars > 0).sum(axis=1)
        states, groups = np.empty((len(chars), 2 * CHAR_H), np.float32), []
        for rows in (np.flatnonzero(length <= 8), np.flatnonzero(length > 8)):
            if len(rows):
                states[rows], caches = self.characters(chars[rows, : max(1, length[rows].max())], keep=True)
                groups.append((rows, caches))
        v = np.concatenate([p["words"][word], states], axis=1)
        x = np.stack([v @ p["in"][d] + p["in_b"][d] for d in (0, 1)], axis=1)[ids]
        out, (m, fc, bc, h, t, a, pooled) = self.logits(x, mask, keep=True)
        q = _sigmoid(out)
        d_out = ((q - y) * weight / weight.sum()).astype(np.float32)
        g["out"], g["out_b"] = pooled.T @ d_out, d_out.sum(keepdims=True)
        d_pool = d_out[:, None] * p["out"]
        d_a = (d_pool[None] * h).sum(axis=2)
        d_e = a * (d_a - (a * d_a).sum(axis=0))
        d_t = d_e[:, :, None] * p["att_v"] * (1 - t * t)
        g["att_v"] = np.einsum("tn,tnk->k", d_e, t)
        g["att"] = np.einsum("tnh,tnk->hk", h, d_t)
        d_h = a[:, :, None] * d_pool[None] + d_t @ p["att"].T
        fx, fu = gru_back(d_h[:, :, :H], m, p["u"][0], fc)
        bx, bu = gru_back(d_h[::-1, :, H:], m[::-1], p["u"][1], bc)
        g["u"] = np.stack([fu, bu])
        dx = np.stack([sums_by(len(chars), ids.T, fx), sums_by(len(chars), ids.T[::-1], bx)], axis=1)
        g["in"] = np.stack([v.T @ dx[:, d] for d in (0, 1)])
        g["in_b"] = dx.sum(axis=0)
        dv = dx[:, 0] @ p["in"][0].T + dx[:, 1] @ p["in"][1].T
        g["words"] = sums_by(len(p["words"]), word, dv[:, :WORD])
        g["words"][0] = 0
        g["chars"], g["char_u"] = np.zeros_like(p["chars"]), np.zeros_like(p["char_u"])
        for rows, caches in groups:
            for d, (c, cache) in enumerate(caches):
                d_s = np.zeros((c.shape[1], len(c), CHAR_H), np.float32)
                d_s[-1] = dv[rows, WORD + d * CHAR_H : WORD + (d + 1) * CHAR_H]
                cx, du = gru_back(d_s, c.T > 0, p["char_u"][d], cache)
                g["char_u"][d] += du
                g["chars"][d] += sums_by(CHARS, c.T, cx)
        adam["n"] = adam.get("n", 0) + 1
        for k, value in g.items():
            one, two = adam.setdefault(k, [np.zeros_like(value), np.zeros_like(value)])
            one += 0.1 * (value - one)
            two += 0.01 * (value * value - two)
            p[k] -= (rate * (one / (1 - 0.9 ** adam["n"])) / (np.sqrt(two / (1 - 0.99 ** adam["n"])) + 1e-7)).astype(np.float32)
        return float(-(weight * (y * np.log(q + 1e-7) + (1 - y) * np.log(1 - q + 1e-7))).sum() / weight.sum())


def pieces(words: Words, block: Block, data: np.ndarray) -> None:
    """Cuts the words of more than LONGEST bytes, in place."""
    long = words.ends - words.starts > LONGEST
    if not long.any():
        return
    joint = _JOINT[data]
    for space in (b"\xc2\xa0", b"\xe3\x80\x80"):  # no-break and ideographic spaces
        width = len(space)
        at = np.flatnonzero(np.logical_and.reduce([data[k : len(data) - width + 1 + k] == c for k, c in enumerate(space)]))
        for k in range(width):
            joint[at + k] = True
    within = np.zeros(len(data) + 1, np.int32)
    within[words.starts[long] + 1] += 1
    within[words.ends[long]] -= 1
    cuts = np.flatnonzero((np.cumsum(within)[1:-1] > 0) & (joint[1:] != joint[:-1])) + 1
    starts, ends = np.sort(np.append(words.starts, cuts)), np.sort(np.append(words.ends, cuts))
    half = LONGEST // 2
    per = np.maximum(0, -(-(ends - starts - LONGEST) // half)) + 1
    rank = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    words.starts = np.repeat(starts, per) + rank * half
    words.ends = np.minimum(words.starts + LONGEST, np.repeat(ends, per))
    words.bound = np.searchsorted(words.starts, block.at)
    words.of = np.repeat(np.arange(block.n), np.diff(words.bound))
    words.n = len(words.starts)


def cores(data: np.ndarray, start: np.ndarray, length: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """A hash of each word without the ASCII bytes at its ends that are neither letters nor digits; of the whole word if it has no others."""
    if not len(start):
        return np.zeros(0, np.uint64)
    solid = ~_JOINT[data[np.minimum(start[:, None] + np.arange(LONGEST), len(data) - 1)]] & inside
    some = solid.any(axis=1)
    head, tail = solid.argmax(axis=1), LONGEST - solid[:, ::-1].argmax(axis=1)
    starts, ends = np.where(some, start + head, start).astype(np.int64), np.where(some, start + tail, start + length).astype(np.int64)
    out, order = np.empty(len(starts), np.uint64), np.argsort(starts, kind="stable")
    out[order] = hashes(data, starts[order], ends[order])
    return out


class Texts:
    """The windows of a block of texts: different words, and for each window the words in it."""

    def __init__(self, block: Block):
        data = _LOWER[block.bytes]
        words = Words(block)
        pieces(words, block, data)
        self.hash, first, word = np.unique(hashes(data, words.starts, words.ends), return_index=True, return_inverse=True)
        word = word.astype(np.int32)
        start, length = words.starts[first].astype(np.int32), (words.ends - words.starts)[first].astype(np.int32)
        at = np.arange(LONGEST, dtype=np.int32)
        inside = at < length[:, None]
        self.core = cores(data, start, length, inside)
        self.chars = np.where(inside, _CLASS[data[np.minimum(start[:, None] + at, max(0, len(data) - 1))]], np.uint8(0)) if len(data) else np.zeros((0, LONGEST), np.uint8)
        n = np.diff(words.bound)
        per = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
        self.of = np.repeat(np.arange(block.n), per)
        rank = np.arange(len(self.of)) - np.repeat(np.cumsum(per) - per, per)
        begin = words.bound[:-1][self.of] + rank * STRIDE
        self.ids = begin[:, None] + np.arange(WINDOW)
        self.mask = self.ids < words.bound[1:][self.of][:, None]
        self.ids = word[np.minimum(self.ids, max(0, words.n - 1))] if words.n else np.zeros(self.ids.shape, np.int32)
        self.n = block.n


def train(texts: list[str], toxic: np.ndarray, epochs: int = 6, seed: int = 3) -> tuple[dict, np.ndarray]:
    """Parameters of a Net and the sorted hashes of the words that have vectors of their own (row k + 1).

    Every fifth text of either kind, if that leaves ten of each, is kept aside: no step is made on it, it tells after
    which epoch to stop, and where the threshold is. Smaller samples do all on the texts that train.
    """
    table = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    x = Texts(Block(table))
    cores, core = np.unique(x.core, return_inverse=True)
    pairs = np.unique(x.of[:, None].astype(np.int64) * max(1, len(cores)) + core[np.where(x.mask, x.ids, x.ids[:, :1])])
    common = np.bincount(pairs % max(1, len(cores)), minlength=len(cores)) >= 5  # in so many texts
    row = np.where(common, np.cumsum(common), 0)[core]
    known = cores[common]
    aside = np.zeros(x.n, bool)
    for kind in (0, 1):
        aside[np.flatnonzero(toxic == kind)[4::5]] = True
    if min((aside & (toxic == 1)).sum(), (aside & (toxic == 0)).sum()) < 10:
        aside[:] = False
    judge = aside if aside.any() else np.ones(x.n, bool)
    least, kept = np.inf, None
    net, adam, rng = Net(len(known) + 1, seed), {}, np.random.default_rng(seed)
    y = toxic[x.of].astype(np.float32)
    for epoch in range(epochs):
        use = np.ones(len(y), bool)
        if epoch >= 2:  # of a toxic text only its highest window
            use = (y == 0) | (score >= best[x.of])
        use &= ~aside[x.of]
        pos, neg = np.flatnonzero(use & (y == 1)), np.flatnonzero(use & (y == 0))
        take = min(len(neg), 5_000)
        if epoch >= 2 and len(neg) > take:  # half of them those that score highest
            hard = neg[np.argsort(-score[neg], kind="stable")[: take // 2]]
            neg = np.append(hard, rng.choice(neg, take - len(hard), replace=False))
        elif len(neg) > take:
            neg = rng.choice(neg, take, replace=False)
        if len(pos) > take:
            pos = rng.choice(pos, take, replace=False)
        # small samples are gone through in smaller steps, and several times
        batch = int(np.clip((len(pos) + len(neg)) // 20, 16, 256))
        turns = max(1, 60 * batch // max(1, len(pos) + len(neg)))
        order = np.concatenate([rng.permutation(np.append(pos, neg)) for _ in range(turns)])
        heavy = max(1.0, len(neg) / max(1, len(pos)))
        for lo in range(0, len(order), batch):
            at = order[lo : lo + batch]
            some, ids = np.unique(x.ids[at], return_inverse=True)
            net.step(x.chars[some], row[some], ids.reshape(len(at), WINDOW), x.mask[at], y[at], np.where(y[at] > 0, heavy, 1.0).astype(np.float32), adam, 0.01 if epoch < 4 else 0.003)
        score = score_windows(net, net.projections(x.chars, row), x)
        best = np.full(x.n, -np.inf)
        np.maximum.at(best, x.of, score)
        wrong = np.logaddexp(0, np.where(toxic == 1, -best, best))
        loss = sum(wrong[judge & (toxic == k)].mean() for k in (0, 1))
        if epoch >= 2 and loss < least:
            least, kept = loss, ({k: v.copy() for k, v in net.p.items()}, best)
    # the threshold: between texts of both kinds where they lie apart, nearer to toxic ones, else where the shares of both that are wrong are least
    net.p, best = kept
    order = np.flatnonzero(judge)[np.argsort(best[judge], kind="stable")]
    sorted_best, kind = best[order], toxic[order].astype(np.int64)
    missed, alarms = np.append(0, np.cumsum(kind)) / max(1, kind.sum()), np.append(np.cumsum((1 - kind)[::-1])[::-1], 0) / max(1, (1 - kind).sum())
    wrong = np.round(missed + alarms, 9)
    gaps = np.append(np.append(sorted_best[0] - 1, 0.7 * sorted_best[1:] + 0.3 * sorted_best[:-1]), sorted_best[-1] + 1)
    cuts = np.flatnonzero(wrong == wrong.min())
    net.p["out_b"] = net.p["out_b"] - np.float32(gaps[cuts[len(cuts) // 2]])
    return net.p, known


def score_windows(net: Net, projected: np.ndarray, x: Texts) -> np.ndarray:
    out = np.empty(len(x.of), np.float32)
    for lo in range(0, len(out), 1024):
        out[lo : lo + 1024] = net.logits(projected[x.ids[lo : lo + 1024]], x.mask[lo : lo + 1024])
    return out


class Scorer:
    """Scores batches of texts in a worker."""

    def __init__(self, params: dict, known: np.ndarray):
        self.net = Net(1)
        self.net.p, self.known = params, known
        self.hash, self.projected = np.zeros(0, np.uint64), np.zeros((0, 2, 3 * H), np.float32)

    def __call__(self, block: Block) -> np.ndarray:
        x = Texts(block)
        if not len(x.hash):
            x.hash, x.core, x.chars = np.zeros(1, np.uint64), np.zeros(1, np.uint64), np.zeros((1, LONGEST), np.uint8)
        at = np.minimum(np.searchsorted(self.hash, x.hash), max(0, len(self.hash) - 1))
        new = np.flatnonzero(self.hash[at] != x.hash) if len(self.hash) else np.arange(len(x.hash))
        fresh = self.net.projections(x.chars[new], self._rows(x.core[new]))
        mine = np.empty((len(x.hash), 2, 3 * H), np.float32)
        mine[new] = fresh
        if len(self.hash):
            old = self.hash[at] == x.hash
            mine[old] = self.projected[at[old]]
        if len(self.hash) + len(new) > KEPT_WORDS:
            self.hash, self.projected = x.hash, mine
        else:
            every = np.append(self.hash, x.hash[new])
            order = np.argsort(every)
            self.hash, self.projected = every[order], np.concatenate([self.projected, fresh])[order]
        logit = score_windows(self.net, mine, x)
        best = np.full(x.n, -np.inf)
        np.maximum.at(best, x.of, logit)
        return _sigmoid(best.astype(np.float64))

    def texts(self, column: pa.Array) -> np.ndarray:
        order = pa.array(np.arange(len(column), dtype=np.int64))
        return self(Block(pa.table({"doc_id": order, "text": column.fill_null("")})))

    def _rows(self, h: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, at + 1, 0)


def slices(batch: pa.RecordBatch, text: int, n_bytes: int = 1 << 19):
    """Cuts a batch into parts of about so many bytes of text, which is in that column."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0), np.int64)
    part = np.cumsum(sizes) // n_bytes
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(sizes)]])
    for lo, hi in zip(bounds, bounds[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 600, folds: int = 5, doc_id: str = "doc_id", text: str = "text", longest: int = 12_000) -> tuple[dict, np.ndarray]:
    """Trains on at most `sample` toxic and 3 times as many other labelled texts, none of them in fold 0 of `folds`.

    The fold of a document is the CRC-32 of its id as text. The sample is the first by a hash of the id. Texts
    of `longest` bytes or more are not in it, which bounds what the driver holds; all texts are scored. Of
    rows that share an id the smallest text counts, and of labels that contradict each other toxic. An epoch
    takes at most 5,000 windows of either kind, half of them those that the net takes for the other kind.
    """
    ident = F.col(doc_id).cast("long")
    short = docs.where((F.pmod(F.crc32(ident.cast("string")), F.lit(folds)) != 0) & (F.octet_length(text) < longest))
    marked = labels.select(F.col("doc_id").cast("long").alias("marked_id"), F.col("toxic")).where("toxic is not null").groupBy("marked_id").agg(F.max("toxic").alias("toxic"))
    both = short.select(ident.alias("marked_id")).distinct().join(marked, "marked_id").withColumn("turn", F.xxhash64("marked_id"))
    chosen = [[r.marked_id for r in both.where(F.col("toxic") == k).orderBy("turn", "marked_id").limit(sample * (1 if k else 3)).select("marked_id").collect()] for k in (1, 0)]
    one = lambda ids: short.where(ident.isin(ids)).groupBy(ident.alias("marked_id")).agg(F.min(text).alias("text")).orderBy("marked_id")
    parts = [one(ids).select("text", F.lit(k).alias("toxic")).collect() if ids else [] for k, ids in zip((1, 0), chosen)]
    rows = [*parts[0], *parts[1]]
    if not parts[0] or not parts[1]:
        return Net(1).p | {"out": np.zeros(2 * H, np.float32), "out_b": np.array([9.0 if parts[0] else -9.0], np.float32)}, np.zeros(0, np.uint64)
    out = train([r.text for r in rows], np.array([r.toxic for r in rows]))
    release()
    return out


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 600, folds: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Returns one row per row of docs: doc_id, held_out (in fold 0, never trained on), score, predicted.

    score is 0 to 1; predicted is 1 from 0.5 on. A null text is empty; texts without words get the score of
    an empty window; a very long text is scored whole, window by window; a null id is never held out or
    trained on; repeated rows are scored alike; without labels of both kinds all scores are alike; an empty
    table gives no rows; other columns, whatever their names, are ignored.
    """
    params, known = fit(docs, labels, sample, folds, doc_id, text)

    def each(batches):
        scorer = Scorer(params, known)
        for batch in batches:
            for part in slices(batch, 1):
                yield pa.record_batch([part.column(0), pa.array(scorer.texts(part.column(1)))], ["doc_id", "score"])
                release()

    ident = F.col(doc_id).cast("long")
    scored = docs.select(ident.alias("doc_id"), F.col(text).alias("text")).mapInArrow(each, "doc_id long, score double")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, sample: int = 600, folds: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that score below 0.5, all columns as they are; rows as in toxicity()."""
    params, known = fit(docs, labels, sample, folds, doc_id, text)
    at = docs.columns.index(text)

    def each(batches):
        scorer = Scorer(params, known)
        for batch in batches:
            for part in slices(batch, at):
                yield part.filter(pa.array(scorer.texts(part.column(at)) < 0.5))
                release()

    return docs.mapInArrow(each, docs.schema)
