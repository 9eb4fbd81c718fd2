"""Substring dedup by level-wise doubling over windows of words.

A window of w words can only repeat where windows of half its length repeat. For windows of 50 words the
levels are 13, 25 and 50. At each level a full window that is still a candidate is looked at through the
one window of the level's length in it that hashes lowest: equal windows choose equal ones, so no repeat
is missed and few positions travel. Candidates whose chosen window occurs in one document alone are
dropped; what survives is extended to about twice the length, until the full length is reached or no
candidate is left, where nothing more is asked. Full windows are compared by 80 bits of hash within a
bucket, which at 100 TB adds some 20 bits: the chance that any two of 10^13 different windows are taken
for equal is then about 1 in 20,000. The answer marks windows that also start in a document with a
smaller id.

Cost: a packed shuffle of hashes for each level and one of the texts, whatever the size of a group of
copies; equal windows of one group of documents meet as hashes of a few bytes, never as pairs.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import exchange as X
from .words import BASE, LANES, Words


def lengths_to(window: int, first: int = 13) -> list[int]:
    """The lengths of the levels, each about twice the one before, from about `first` words to the window."""
    out = [window]
    while out[-1] > first:
        out.append((out[-1] + 1) // 2)
    return out[::-1]


class Levels:
    """The windows of one block, and which of them are still candidates for a repeat."""

    def __init__(self, table: pa.Table, window: int, n_buckets: int):
        self.block = X.Block(table)
        self.words = Words(self.block)
        self.window, self.n_buckets = window, n_buckets
        n = max(0, self.words.n - window + 1)
        word = self.words.hashes(self.block.bytes)
        self.lanes = [X.mix(word ^ np.uint64(k)) for k in LANES]
        last = self.words.bound[self.words.of + 1]
        self.open = (np.arange(n) + window) <= last[:n]

    def choose(self, length: int) -> None:
        """Of each candidate the window of this length that hashes lowest: its place and key."""
        self.spread = window = self.window - length + 1
        self.low = X.mix(X.rolled(self.lanes[0], length, BASE)) | np.uint64(1)
        self.least = X.slide(self.low, window, np.minimum)[: len(self.open)]
        pad = np.zeros(window - 1, np.uint64)
        held = np.where(self.open, self.least, 0).astype(np.uint64)
        chosen = X.slide(np.concatenate([pad, held, pad]), window, np.maximum) if len(held) else self.low[:0]
        self.at = np.flatnonzero(self.low[: len(chosen)] == chosen)
        self.keys = X.mix(self.low[self.at])
        self.bucket = X.bucket_of(self.keys, self.n_buckets)

    def narrow(self, flags: np.ndarray) -> None:
        """Drops the candidates whose chosen window isn't flagged."""
        held = np.full(len(self.low), np.iinfo(np.uint64).max, np.uint64)
        hit = self.at[flags > 0]
        held[hit] = self.low[hit]
        if len(self.open):
            self.open &= X.slide(held, self.spread, np.minimum)[: len(self.open)] == self.least

    def whole(self) -> None:
        """The candidates themselves, with two hashes of each."""
        self.at = np.flatnonzero(self.open)
        self.both = [X.mix(X.rolled(h, self.window, BASE)[self.at]) for h in self.lanes]
        self.bucket = X.bucket_of(self.both[0], self.n_buckets)


def _in_two_documents(table: pa.Table, stage: int) -> pa.Table:
    rows, ids, bounds = X.unpack(table, 5)
    key = X.from_low(rows)
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
    several = np.minimum.reduceat(ids[order], first) != np.maximum.reduceat(ids[order], first)
    flags = np.zeros(len(key), np.uint8)
    flags[order] = np.repeat(several, np.diff(np.append(first, len(key))))
    return X.answer(table, stage, flags, bounds)


def _in_an_earlier_document(table: pa.Table, stage: int) -> pa.Table:
    rows, ids, bounds = X.unpack(table, 10)
    wide = rows.copy()
    a, b = X.from_low(wide[:, :8]), X.from_low(wide[:, 8:])
    order = np.lexsort((b, a))
    first = np.flatnonzero(np.append(True, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)))
    least = np.minimum.reduceat(ids[order], first)
    flags = np.zeros(len(a), np.uint8)
    flags[order] = ids[order] > np.repeat(least, np.diff(np.append(first, len(a))))
    return X.answer(table, stage, flags, bounds)


def window_dedup(docs: DataFrame, window: int = 50, doc_id: str = "doc_id", text: str = "text", group_bytes: int = 2 << 20, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Removes each word covered by a window of words that also starts in a document with a smaller id.

    Words are runs of bytes other than space and tab to carriage return. Returns one row per row of docs:
    doc_id, n_words, n_removed, spans (removed runs of words, from and to), kept_text (kept words joined
    by one space). A null text has no words; a very long text is one task's work; a null id counts as larger
    than all ids; rows that share an id are not earlier than one another; an empty table gives no rows;
    other columns, whatever their names, are ignored.
    """
    n_groups, n_buckets = X.counts_for(X.total_bytes(docs, text), group_bytes, bucket_bytes)
    dealt = X.grouped(docs, n_groups, doc_id, text)
    lengths = lengths_to(window)

    def reached(table: pa.Table, told: pa.Table | None, level: int) -> Levels:
        """The windows to ask for at a level, after the answers of all levels before."""
        x = Levels(table, window, n_buckets)
        for k in range(level):
            x.choose(lengths[k])
            x.narrow(X.answers(told, k, x.bucket, np.uint8))
        if level < len(lengths) - 1:
            x.choose(lengths[level])
        else:
            x.whole()
        return x

    def ask(level: int):
        def packed(table: pa.Table, told: pa.Table | None = None) -> pa.Table:
            x = reached(table, told, level)
            rows = X.low_bytes(x.keys, 5) if level < len(lengths) - 1 else np.concatenate([X.low_bytes(h, 5) for h in x.both], axis=1)
            return X.pack(table.column("g")[0].as_py(), x.bucket, x.words.of[x.at], rows, x.block)

        return X.lean(packed) if not level else X.lean_pair(packed)

    def reply(level: int):
        met = _in_two_documents if level < len(lengths) - 1 else _in_an_earlier_document
        return X.lean(lambda table: met(table, level))

    def cut(table: pa.Table, told: pa.Table) -> pa.Table:
        x = reached(table, told, len(lengths) - 1)
        marks = np.zeros(x.words.n + window + 1, np.int32)
        hit = x.at[X.answers(told, len(lengths) - 1, x.bucket, np.uint8) > 0]
        marks[hit] += 1
        marks[hit + window] -= 1
        gone = np.cumsum(marks)[: x.words.n] > 0
        sums = np.append(0, np.cumsum(gone))
        n_removed = np.diff(sums[x.words.bound])
        spans, kept = [], []
        for k in range(x.block.n):
            lo, hi = x.words.bound[k], x.words.bound[k + 1]
            words = x.block.text(k).split()
            if n_removed[k]:
                own = gone[lo:hi]
                turn = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
                spans.append([{"from": int(i), "to": int(j)} for i, j in zip(turn[::2], turn[1::2])])
                words = compress(words, ~own)
            else:
                spans.append([])
            kept.append(b" ".join(words).decode())
        return pa.table({"doc_id": x.block.raw_ids, "n_words": np.diff(x.words.bound), "n_removed": n_removed, "spans": pa.array(spans, CUT.field("spans").type), "kept_text": kept}, schema=CUT)

    told = None
    for level in range(len(lengths)):
        mine = dealt.groupBy("g")
        asked = mine.applyInArrow(ask(level), X.PACKED_SQL) if told is None else mine.cogroup(told.groupBy("g")).applyInArrow(ask(level), X.PACKED_SQL)
        answers = asked.groupBy("bucket").applyInArrow(reply(level), X.ANSWER_SQL)
        told = answers if told is None else told.unionByName(answers)
    return dealt.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(X.lean_pair(cut), "doc_id long, n_words long, n_removed long, spans array<struct<from: long, to: long>>, kept_text string")


CUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))), ("kept_text", pa.string())])
