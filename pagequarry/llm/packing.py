"""Packing documents into sequences by bounded-space online packing.

Each partition reads its documents once and keeps a fixed number of open windows. Whole windows of a long
document go out at once; its rest goes where it fits best. When none fits, the fullest window is topped up
with a cut of the rest and goes out. What is still open at the end of the partitions is merged in a tree,
64 nodes to one, where pieces fill windows one after the other; the root cuts its last window into lengths
that are powers of two, so nothing is padded there.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

FAN_IN = 64
PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("node", pa.int64()), ("ids", pa.binary())])
PIECE_SQL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, node long, ids binary"


@lru_cache(maxsize=1)
def encoder(path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()):
    """The byte-level BPE whose ranks are at path; equal to the tokenizers file of the same vocabulary.

    special: strings that are one id of their own wherever they stand in a text.
    """
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tool = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))
    names = [name for name, _ in special]

    def encode(text: str) -> list[int]:
        if any(name in text for name in names):
            return tool.encode(text, allowed_special="all")
        return tool.encode_ordinary(text)

    return encode


class Pieces:
    """Rows of PIECE; sequences are numbered from `first` up."""

    def __init__(self, first: int):
        self.next, self.rows = first, []

    def emit(self, window: list) -> None:
        at = 0
        for doc, start, ids, total in window:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next, at, None, None))
            at += len(ids)
        self.next += 1

    def hold(self, window: list, node: int) -> None:
        for doc, start, ids, total in window:
            self.rows.append((doc, start, len(ids), None, total, None, None, node, ids.tobytes()))

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(PIECE), PIECE)], schema=PIECE)


class OpenWindows:
    """At most `most` open windows of `size` tokens, ordered by room left."""

    def __init__(self, size: int, most: int, out: Pieces):
        self.size, self.most, self.out = size, most, out
        self.room: list[int] = []
        self.windows: list[list] = []

    def add(self, doc, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.size:
            self.out.emit([(doc, start, ids[start : start + self.size], total)])
            start += self.size
        while start < total:
            n = total - start
            k = bisect.bisect_left(self.room, n)
            if k < len(self.room):  # the best fit
                window, room = self.windows.pop(k), self.room.pop(k)
            elif len(self.room) < self.most:
                window, room = [], self.size
            else:  # none fits: the fullest one is topped up
                window, room = self.windows.pop(0), self.room.pop(0)
                n = room
            window.append((doc, start, ids[start : start + n], total))
            start += n
            if room == n:
                self.out.emit(window)
            else:
                k = bisect.bisect_left(self.room, room - n)
                self.room.insert(k, room - n)
                self.windows.insert(k, window)

    def close(self, node: int) -> None:
        for window in self.windows:
            self.out.hold(window, node)
        self.room, self.windows = [], []


def _merge(table: pa.Table, size: int, level: int, last: bool) -> pa.Table:
    node = table.column("up")[0].as_py()
    table = table.sort_by([("node", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
    out, window, room = Pieces((level << 56) | (node << 24)), [], size
    for doc, start, total, raw in zip(*(table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))):
        ids = np.frombuffer(raw, "<u4")
        while len(ids):
            n = min(room, len(ids))
            window.append((doc, start, ids[:n], total))
            start, ids, room = start + n, ids[n:], room - n
            if not room:
                out.emit(window)
                window, room = [], size
    if not last:
        out.hold(window, node)
    else:
        left = size - room
        while left:
            part, want, window_now = [], 1 << (left.bit_length() - 1), window
            left -= want
            window = []
            for doc, start, ids, total in window_now:
                n = min(want, len(ids))
                if n:
                    part.append((doc, start, ids[:n], total))
                if n < len(ids):
                    window.append((doc, start + n, ids[n:], total))
                want -= n
            out.emit(part)
    return pa.Table.from_batches([out.batch()])


def _merge_step(size: int, level: int, last: bool):
    return lambda table: _merge(table, size, level, last)


def pack(docs: DataFrame, ranks: str, pattern: str, special: tuple[tuple[str, int], ...] = (), size: int = 2048, windows: int = 64, end: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ranks, pattern, special: the vocabulary file, the splitting pattern and the special strings of a
    byte-level BPE. A document is its ids and then `end`. A null text is empty, so its document is the one
    id; a very long text is cut over as many sequences as it fills; repeated rows are packed each on its
    own; a null id stays null; an empty table gives no rows; other columns, whatever their names, are
    ignored. Sequence ids depend on how the input is split into partitions.
    """

    def each(batches):
        part = TaskContext.get().partitionId()
        encode, out = encoder(ranks, pattern, special), Pieces(part << 24)
        held = OpenWindows(size, windows, out)
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(body) if body else []
                ids.append(end)
                held.add(doc, np.array(ids, "<u4"))
            yield out.batch()
        held.close(part)
        yield out.batch()

    pieces = written(docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(each, PIECE_SQL))
    left, level, done = pieces.where("node is not null"), 1, pieces.where("node is null")
    width = (left.agg(F.max("node")).first()[0] or 0) + 1
    while True:
        last = width <= FAN_IN
        up = left.withColumn("up", F.floor(F.col("node") / FAN_IN))
        merged = up.groupBy("up").applyInArrow(_merge_step(size, level, last), PIECE_SQL)
        if last:
            break
        merged = written(merged)
        done, left, level, width = done.unionByName(merged.where("node is null")), merged.where("node is not null"), level + 1, -(-width // FAN_IN)
    return done.unionByName(merged).drop("node", "ids")
