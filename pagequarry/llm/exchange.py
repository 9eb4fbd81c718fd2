"""Packed exchanges between groups of documents and buckets of hashes.

Operators that must compare every window of every text would emit one row for each window. Here a
group of documents packs what it has for a bucket into one row of binary columns instead, a bucket
answers with one packed row, and the group reads the answers in the order in which it asked. Both
sides rebuild that order from the documents, so positions never travel.

The documents themselves are dealt by group once; every stage reads the same exchange.
"""

from __future__ import annotations

import ctypes
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ids stand for null ids at the end of the order.
NULL_ID = np.iinfo(np.int64).max


def total_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def counts_for(n_bytes: int, group_bytes: int = 4 << 20, bucket_bytes: int = 16 << 20) -> tuple[int, int]:
    """How many groups of documents and buckets of hashes so many bytes of text need."""
    return max(1, math.ceil(n_bytes / group_bytes)), max(1, math.ceil(n_bytes / bucket_bytes))


def grouped(docs: DataFrame, n_groups: int, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(g, doc_id, text, carried columns), the shape in which all stages read the documents; a null text is empty."""
    ident, body = F.col(doc_id).cast("long"), F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.pmod(F.xxhash64(ident), F.lit(n_groups)).cast("int").alias("g"), ident.alias("doc_id"), body.alias("text"), *carry)


def release() -> None:
    """Gives freed memory back to the system; Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass


def lean(f):
    """f, a function of one table, that gives back its memory when done."""

    def run(table: pa.Table) -> pa.Table:
        try:
            return f(table)
        finally:
            release()

    return run


def lean_pair(f):
    """As lean, for a function of two tables."""

    def run(table: pa.Table, other: pa.Table) -> pa.Table:
        try:
            return f(table, other)
        finally:
            release()

    return run


class Block:
    """The documents of one group in a fixed order: ids, the bytes of all texts, where each begins."""

    def __init__(self, table: pa.Table):
        self.order = pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")])
        table = table.select(["doc_id", "text"]).take(self.order)
        col = table.column("doc_id").combine_chunks()
        self.raw_ids = col
        self.ids = np.asarray(pc.fill_null(col, NULL_ID), dtype=np.int64)
        texts = pa.chunked_array([table.column("text").cast(pa.large_string()).combine_chunks()]).combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.chunk(0)
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        whole = np.frombuffer(data, np.uint8) if data is not None and len(texts) else np.zeros(0, np.uint8)
        self.bytes, self.at = whole[at[0] : at[-1]], at - at[0]
        self.n = len(texts)

    def text(self, k: int) -> bytes:
        return self.bytes[self.at[k] : self.at[k + 1]].tobytes()


def squeeze(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def unsqueeze(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def low_bytes(h: np.ndarray, k: int) -> np.ndarray:
    """The k low bytes of each 64-bit value, as rows of bytes."""
    return np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :k]


def from_low(rows: np.ndarray) -> np.ndarray:
    full = np.zeros((len(rows), 8), np.uint8)
    full[:, : rows.shape[1]] = rows
    return full.view("<u8").reshape(-1)


def bucket_of(h: np.ndarray, n_buckets: int) -> np.ndarray:
    """From the bits above 40, which packed rows leave out."""
    return ((h >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.uint32 if n_buckets > 65536 else np.uint16)


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, buckets, bounds): a stable order by bucket, the buckets that occur, where each begins."""
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    return order, found.astype(np.int64), np.append(first, len(order))


def pack(g: int, bucket: np.ndarray, doc: np.ndarray, rows: np.ndarray, block: Block) -> pa.Table:
    """One row for each bucket: the rows of bytes that go there, and which documents they are of.

    doc: the index in the block of each row, ascending.
    """
    order, found, bounds = by_bucket(bucket)
    out = {"g": [], "bucket": [], "rows": [], "docs": [], "counts": []}
    rows, doc = rows[order], doc[order]
    for b, lo, hi in zip(found, bounds, bounds[1:]):
        which, n = np.unique(doc[lo:hi], return_counts=True)
        out["g"].append(g)
        out["bucket"].append(int(b))
        out["rows"].append(rows[lo:hi].tobytes())
        out["docs"].append(squeeze(np.diff(block.ids[which], prepend=0)))
        out["counts"].append(squeeze(n.astype(np.uint32)))
    return pa.table(out, schema=PACKED)


PACKED = pa.schema([("g", pa.int32()), ("bucket", pa.int64()), ("rows", pa.binary()), ("docs", pa.binary()), ("counts", pa.binary())])
PACKED_SQL = "g int, bucket long, rows binary, docs binary, counts binary"
ANSWER = pa.schema([("g", pa.int32()), ("bucket", pa.int64()), ("stage", pa.int32()), ("flags", pa.binary())])
ANSWER_SQL = "g int, bucket long, stage int, flags binary"


def unpack(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, ids, bounds): all rows of bytes of a bucket, the document id of each, where each packed row begins."""
    rows = [np.frombuffer(x.as_py(), np.uint8).reshape(-1, width) for x in table.column("rows")]
    ids = [np.repeat(np.cumsum(unsqueeze(d.as_py(), np.int64)), unsqueeze(c.as_py(), np.uint32)) for d, c in zip(table.column("docs"), table.column("counts"))]
    return np.concatenate(rows), np.concatenate(ids), np.cumsum([0, *map(len, rows)])


def answer(table: pa.Table, stage: int, flags: np.ndarray, bounds: np.ndarray) -> pa.Table:
    packed = [squeeze(flags[lo:hi]) for lo, hi in zip(bounds, bounds[1:])]
    return pa.table({"g": table.column("g"), "bucket": table.column("bucket"), "stage": pa.array([stage] * len(packed), pa.int32()), "flags": packed}, schema=ANSWER)


def answers(table: pa.Table, stage: int, bucket: np.ndarray, dtype) -> np.ndarray:
    """The flags of a stage, in the order of the items that asked, whose buckets are given."""
    out = np.zeros(len(bucket), dtype)
    if not len(bucket):
        return out
    order = np.argsort(bucket, kind="stable")
    mine = table.filter(pc.equal(table.column("stage"), stage)).sort_by("bucket")
    out[order] = np.concatenate([unsqueeze(x.as_py(), dtype) for x in mine.column("flags")])
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def rolled(one: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hashes of all runs of so many items, by doubling: a run is two runs of half its length side by side."""
    done, span, have = None, 1, one
    todo, got = length, 0
    while todo:
        if todo & 1:
            if done is None:
                done, got = have, span
            else:
                n = min(len(done), len(have) - got)
                done = done[:n] * np.uint64(pow(base, span, 1 << 64)) + have[got : got + n]
                got += span
        todo >>= 1
        if todo:
            have = have[: len(have) - span] * np.uint64(pow(base, span, 1 << 64)) + have[span:] if len(have) > span else have[:0]
            span *= 2
    return done[: max(0, len(one) - length + 1)]


def slide(a: np.ndarray, width: int, op) -> np.ndarray:
    """op (np.minimum, np.maximum) over every run of so many values, by doubling."""
    span = 1
    full = len(a) - width + 1
    if full <= 0:
        return a[:0]
    while span * 2 <= width:
        a = op(a[: len(a) - span], a[span:])
        span *= 2
    return op(a[:full], a[width - span : width - span + full]) if span < width else a[:full]
