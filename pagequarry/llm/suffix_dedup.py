"""Substring dedup over bytes with suffix arrays.

Every string of `length` bytes holds one run of `length`/2 or so bytes that hashes lowest among those in
it, its anchor; equal strings have equal anchors at the same place. So documents first exchange packed
hashes of anchors (about 8 % of positions) and of their surroundings: all bytes that any string with this
anchor can hold. Surroundings that occur in one document alone are done; of equal surroundings only the
smallest document goes on, for the others cover nothing that it doesn't. Where an anchor is left with
several different surroundings, these are concatenated for each bucket, the anchor as one symbol, and
sorted into a suffix array (gsaca.py). Strings that are equal are neighbours there, over all offsets and
documents at once, and each is marked if a smaller document holds it. Bytes of a surrounding that agree
with no other one around the same anchor cannot be in a shared string and are left out of the text.

Cost: two packed shuffles and one of the texts. The suffix array takes one string for each different
surrounding, so exact copies of any number cost as much as one, and a passage in very many documents
costs its edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from . import exchange as X
from .gsaca import suffix_array

BASE = 0xD1342543DE82EF95
#: Never part of a UTF-8 text; stands before and after each one.
PAD = 0xFF
#: Surroundings in one suffix array, at least; anchors with more of them get one of their own.
PART = 250


class Anchors:
    """The anchors of one block: place in the padded bytes, document, hash, hash of the surroundings."""

    def __init__(self, table: pa.Table, length: int):
        self.length = length
        self.spread = max(1, length // 2)  # strings that can share an anchor
        self.k = length - self.spread + 1  # bytes of an anchor
        self.flank = self.spread - 1
        self.block = b = X.Block(table)
        gap = length
        self.at = b.at[:-1] + gap * (1 + np.arange(b.n))
        self.bytes = np.full(len(b.bytes) + gap * (b.n + 1), PAD, np.uint8)
        self.sizes = np.diff(b.at)
        for i in range(b.n):
            self.bytes[self.at[i] : self.at[i] + self.sizes[i]] = b.bytes[b.at[i] : b.at[i + 1]]
        run = X.rolled(X.mix(self.bytes.astype(np.uint64) + np.uint64(1)) if len(self.bytes) < 4096 else SPREAD_BYTES[self.bytes], self.k, BASE)
        low = X.mix(run) | np.uint64(1)
        valid = np.zeros(len(self.bytes) + 1, np.int8)
        long = self.sizes >= length
        valid[self.at[long]] += 1
        np.add.at(valid, self.at[long] + self.sizes[long] - length + 1, -1)
        valid = np.cumsum(valid[: max(0, len(low) - self.flank)], dtype=np.int8) > 0
        least = X.slide(low, self.spread, np.minimum)
        pad = np.zeros(self.flank, np.uint64)
        chosen = X.slide(np.concatenate([pad, np.where(valid, least, 0).astype(np.uint64), pad]), self.spread, np.maximum)
        self.place = np.flatnonzero(low[: len(chosen)] == chosen)
        self.of = np.searchsorted(self.at, self.place, side="right") - 1
        self.key = X.mix(low[self.place])
        side = [run[self.place - self.flank], run[self.place + self.flank]]
        self.around = X.mix(self.key ^ X.mix(side[0] + np.uint64(7)) ^ X.mix(side[1] * np.uint64(3)))

    def surroundings(self, at: np.ndarray) -> np.ndarray:
        """A row of bytes for each of these anchors: what the strings that hold it can reach."""
        return self.bytes[self.place[at][:, None] + np.arange(-self.flank, self.k + self.flank)]


SPREAD_BYTES = X.mix(np.arange(1, 257, dtype=np.uint64))


def _surroundings_met(table: pa.Table) -> pa.Table:
    """0: nothing to do; 1: a smaller document has the same surroundings; 2: others have the anchor, but differ."""
    rows, ids, bounds = X.unpack(table, 10)
    key, around = X.from_low(rows[:, :5]), X.from_low(rows[:, 5:])
    order = np.lexsort((ids, around, key))
    k, a, d = key[order], around[order], ids[order]
    new_key = np.append(True, k[1:] != k[:-1])
    new = new_key | np.append(True, a[1:] != a[:-1])
    first = np.flatnonzero(new)
    least = np.repeat(d[first], np.diff(np.append(first, len(d))))
    lead = d == least
    group = np.flatnonzero(new_key)
    size = np.diff(np.append(group, len(d)))
    mixed = (np.add.reduceat(new.astype(np.int64), group) > 1) & (np.minimum.reduceat(least, group) != np.maximum.reduceat(least, group))
    flags = np.zeros(len(d), np.uint8)
    flags[order] = np.where(~lead, 1, np.where(np.repeat(mixed, size), 2, 0))
    return X.answer(table, 1, flags, bounds)


def _longest_shared(text: np.ndarray, k: int) -> np.ndarray:
    """By how many bytes behind the first k each row agrees with some other row; -1 if no other has those k."""
    order = np.argsort(np.ascontiguousarray(text).view(f"V{text.shape[1]}").reshape(-1), kind="stable")
    agree = np.cumprod(text[order[1:]] == text[order[:-1]], axis=1, dtype=np.int8).sum(axis=1)
    agree = np.where(agree >= k, agree - k, -1)
    out = np.full(len(text), -1, np.int64)
    out[order[1:]] = agree
    out[order[:-1]] = np.maximum(out[order[:-1]], agree)
    return out


def strings_in_order(rows: np.ndarray, ids: np.ndarray, flank: int, k: int) -> np.ndarray:
    """For each row of surroundings and each offset of a string in it: whether a smaller id has that string.

    rows: distinct or not; anchors (columns flank to flank + k) may differ. Returns booleans, one column
    for each offset. Strings that hold a padding byte are never marked.
    """
    as_one = np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").reshape(-1)
    distinct, back = np.unique(as_one, return_inverse=True)
    least = np.full(len(distinct), X.NULL_ID, np.int64)
    np.minimum.at(least, back, ids)
    text = distinct.view(np.uint8).reshape(-1, rows.shape[1])
    anchor = np.ascontiguousarray(text[:, flank : flank + k]).view(f"V{k}").reshape(-1)
    _, group, sizes = np.unique(anchor, return_inverse=True, return_counts=True)
    marked = np.zeros((len(distinct), flank + 1), bool)
    ahead = _longest_shared(text[:, flank:], k)
    behind = _longest_shared(np.concatenate([text[:, flank : flank + k], text[:, :flank][:, ::-1]], axis=1), k)
    inside = np.flatnonzero((sizes[group] > 1) & (ahead + behind >= flank))
    inside = inside[np.argsort(group[inside], kind="stable")]
    starts = np.flatnonzero(np.append(True, np.diff(group[inside]) != 0)) if len(inside) else []
    parts, last = [], 0
    for i in [*starts[1:], len(inside)]:
        if i - last >= PART or i == len(inside):
            parts.append(inside[last:i])
            last = i
    for part in parts if len(inside) else []:
        wide = 2 * flank + 2
        full = np.zeros((len(part), wide), np.int64)  # left, anchor, right, end
        full[:, :flank] = text[part, :flank].astype(np.int64) + 1
        full[:, flank] = 258 + group[part] - group[part[0]]
        full[:, flank + 1 : wide - 1] = text[part, flank + k :].astype(np.int64) + 1
        column = np.arange(wide)
        used = (column >= (flank - behind[part])[:, None]) & (column <= (flank + ahead[part])[:, None])
        used[:, -1] = True
        row, column = np.nonzero(used)
        order = suffix_array(full[used])
        order = order[column[order] <= np.minimum(flank, ahead[part][row[order]])]
        flat = np.append(full[used], np.zeros(flank + 1, np.int64))
        same = np.ones(max(0, len(order) - 1), bool)
        for step in range(flank + 1):
            symbol = flat[order + step]
            same &= symbol[1:] == symbol[:-1]
        first = np.flatnonzero(np.append(True, ~same))
        row, column = row[order], column[order]
        mine = least[part[row]]
        smallest = np.repeat(np.minimum.reduceat(mine, first), np.diff(np.append(first, len(order))))
        marked[part[row], column] = mine > smallest
        reach = np.lib.stride_tricks.sliding_window_view(text[part] == PAD, flank + k, axis=1)
        marked[part] &= ~reach.any(axis=2)
    return marked[back]


def _strings_met(table: pa.Table, flank: int, k: int) -> pa.Table:
    wide = 2 * flank + k
    packed = table.set_column(table.schema.get_field_index("rows"), "rows", pa.array([X.unsqueeze(x.as_py(), np.uint8).tobytes() for x in table.column("rows")], pa.binary()))
    rows, ids, bounds = X.unpack(packed, wide)
    bits = np.packbits(strings_in_order(rows, ids, flank, k), axis=1)
    return X.answer(table, 2, bits, bounds)


def suffix_dedup(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), as_text: bool = False, group_bytes: int = 2 << 20, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Removes each byte covered by a string of so many bytes that also starts in a document with a smaller id.

    Returns one row per row of docs: doc_id, n_bytes, n_removed, spans (removed runs of bytes, from and to),
    kept (the remaining bytes; as_text: decoded, bytes of
    broken characters left out), and the columns of docs named in carry, whose names must differ from those
    and from g and text. Strings never cross documents and are judged on the input. A null text is empty; a
    very long text is one task's work; a null id counts as larger than all ids; rows that share an id are not
    earlier than one another; an empty table gives no rows; other columns, whatever their names, are ignored.
    """
    n_groups, n_buckets = X.counts_for(X.total_bytes(docs, text), group_bytes, bucket_bytes)
    dealt = X.grouped(docs, n_groups, doc_id, text, carry)
    result = StructType.fromDDL("doc_id long, n_bytes long, n_removed long, spans array<struct<from: long, to: long>>, kept " + ("string" if as_text else "binary"))
    for name in carry:
        result = result.add(dealt.schema[name])
    spread = max(1, length // 2)
    flank, k = spread - 1, length - spread + 1

    def anchors(table: pa.Table) -> pa.Table:
        x = Anchors(table, length)
        rows = np.concatenate([X.low_bytes(x.key, 5), X.low_bytes(x.around, 5)], axis=1)
        return X.pack(table.column("g")[0].as_py(), X.bucket_of(x.key, n_buckets), x.of, rows, x.block)

    def split(table: pa.Table, told: pa.Table) -> tuple[Anchors, np.ndarray, np.ndarray]:
        x = Anchors(table, length)
        flags = X.answers(told, 1, X.bucket_of(x.key, n_buckets), np.uint8)
        return x, flags, np.flatnonzero(flags == 2)

    def surroundings(table: pa.Table, told: pa.Table) -> pa.Table:
        x, _, at = split(table, told)
        packed = X.pack(table.column("g")[0].as_py(), X.bucket_of(x.key[at], n_buckets), x.of[at], x.surroundings(at), x.block)
        small = pa.array([X.squeeze(np.frombuffer(v.as_py(), np.uint8)) for v in packed.column("rows")], pa.binary())
        return packed.set_column(packed.schema.get_field_index("rows"), "rows", small)

    kind = pa.string() if as_text else pa.binary()

    def cut(table: pa.Table, told: pa.Table) -> pa.Table:
        x, flags, at = split(table, told)
        marks = np.zeros(len(x.bytes) + 1, np.int32)
        whole = np.flatnonzero(flags == 1)
        own = x.of[whole]
        # all strings of these surroundings: from the first start to the last end within the document
        lo = np.maximum(x.place[whole] - flank, x.at[own])
        hi = np.minimum(x.place[whole] + k + flank, x.at[own] + x.sizes[own])
        np.add.at(marks, lo, 1)
        np.add.at(marks, hi, -1)
        width = (flank + 8) // 8
        order = np.argsort(X.bucket_of(x.key[at], n_buckets), kind="stable")
        bits = np.zeros((len(at), width), np.uint8)
        mine = told.filter(pa.compute.equal(told.column("stage"), 2)).sort_by("bucket")
        if len(at):
            bits[order] = np.concatenate([X.unsqueeze(v.as_py(), np.uint8).reshape(-1, width) for v in mine.column("flags")])
        which, offset = np.nonzero(np.unpackbits(bits, axis=1)[:, : flank + 1])
        start = x.place[at[which]] - flank + offset
        np.add.at(marks, start, 1)
        np.add.at(marks, start + length, -1)
        gone = np.cumsum(marks)[:-1] > 0
        removed, n_spans, spans, kept = [], [], [], []
        for i in range(x.block.n):
            own = gone[x.at[i] : x.at[i] + x.sizes[i]]
            body = x.bytes[x.at[i] : x.at[i] + x.sizes[i]]
            n = int(own.sum())
            turn = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0)) if n else np.zeros(0, np.int64)
            removed.append(n)
            spans.append([{"from": int(a), "to": int(b)} for a, b in zip(turn[::2], turn[1::2])])
            kept.append((body[~own] if n else body).tobytes())
        out = pa.table({"doc_id": x.block.raw_ids, "n_bytes": x.sizes, "n_removed": removed, "spans": pa.array(spans, CUT.field("spans").type), "kept": pa.array([b.decode("utf-8", "ignore") for b in kept] if as_text else kept, kind)}, schema=CUT.set(4, pa.field("kept", kind)))
        for name in carry:
            out = out.append_column(table.schema.field(name), table.column(name).take(x.block.order))
        return out

    told = dealt.groupBy("g").applyInArrow(X.lean(anchors), X.PACKED_SQL).groupBy("bucket").applyInArrow(X.lean(_surroundings_met), X.ANSWER_SQL)
    more = dealt.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(X.lean_pair(surroundings), X.PACKED_SQL).groupBy("bucket").applyInArrow(X.lean(lambda t: _strings_met(t, flank, k)), X.ANSWER_SQL)
    return dealt.groupBy("g").cogroup(told.unionByName(more).groupBy("g")).applyInArrow(X.lean_pair(cut), result)


CUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))), ("kept", pa.binary())])
