"""Ranked lexical search, document at a time.

Documents are dealt into shards as they are read; a shard numbers its documents by doc_id and holds for each
of its terms the postings (number of the document, occurrences) as gaps in bytes of seven bits, in blocks of
bounded length. The index is one table with a row for each block, and a row for each shard that holds ids and
lengths. To search, the blocks of the asked terms meet in a task for each shard and block of items. There the
lists of an item are merged by a heap of their next documents: documents are taken in runs of numbers, a run
ends when every list has gone past it, and so a document's score is whole when it is offered to the item's heap
of best documents, which is bounded and ordered by score, then doc_id. What shards return is merged for each item, a
first time before the shuffle.

All arithmetic on scores is in 64-bit integers. Terms of one shard are told apart by 64 bits of hash and their length.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from . import exchange as X
from .words import powers

#: What terms are made of: all characters but ASCII ones that are neither letter nor digit.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
IS_TERM = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
#: Bytes that are hashed at once.
PIECE = 1 << 21
#: Postings in a block.
BLOCK = 1024
#: Bytes of query terms that are sent to all executors at most; more are shuffled.
SENT_BYTES = 16 << 20

INDEX = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("block", pa.int32()), ("first", pa.int64()), ("n", pa.int64()), ("total", pa.int64()), ("postings", pa.binary())])
INDEX_SQL = "shard long, term string, block int, first long, n long, total long, postings binary"


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values as bytes of seven bits, low ones first, the last one without its high bit; and where each begins."""
    size = np.ones(len(values), np.int64)
    for bits in range(7, 63, 7):
        more = values >> bits
        if not more.any():
            break
        size += more > 0
    at = np.append(0, np.cumsum(size))
    out = np.empty(at[-1], np.uint8)
    for k in range(int(size.max(initial=0))):
        has = size > k
        out[at[:-1][has] + k] = ((values[has] >> (7 * k)) & 127) | np.where(size[has] > k + 1, 128, 0)
    return out, at


def from_varints(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    start = np.append(0, last[:-1] + 1)
    size = last - start + 1
    out = np.zeros(len(last), np.int64)
    for k in range(int(size.max(initial=0))):
        has = size > k
        out[has] |= (data[start[has] + k].astype(np.int64) & 127) << (7 * k)
    return out


def spans_of_terms(block: X.Block) -> tuple[np.ndarray, np.ndarray]:
    """Where terms start and end in the bytes of the block; none crosses documents."""
    solid = IS_TERM[block.bytes]
    begins = np.zeros(len(solid) + 1, bool)
    begins[block.at] = True
    before, after = np.append(True, ~solid[:-1]), np.append(~solid[1:], True)
    n = len(solid)
    return np.flatnonzero(solid & (before[:n] | begins[:-1])), np.flatnonzero(solid & (after[:n] | begins[1:])) + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each term, small letters for capitals; worked out over pieces of bounded length."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + PIECE, "right")))
        part = LOWER[data[base : ends[j - 1]]]
        up, down = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(0x1F3)) * up[: len(part)], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = X.mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    size = ends - starts
    at = np.append(0, np.cumsum(size))
    flat = LOWER[data[np.arange(at[-1]) + np.repeat(starts - at[:-1], size)]]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat)).cast(pa.string())


def shard_of(table: pa.Table, shard: int) -> pa.Table:
    """The index rows of one shard: its documents' ids and lengths under the empty term, then the blocks of each term."""
    block = X.Block(table)
    starts, ends = spans_of_terms(block)
    doc = np.searchsorted(block.at, starts, "right") - 1
    length = np.bincount(doc, minlength=block.n)
    about = pa.table([[shard], [""], [-1], [0], [int((length > 0).sum())], [len(starts)], [X.squeeze(np.concatenate([block.ids, length.astype(np.int64)]))]], schema=INDEX)
    if not len(starts):
        return about
    key = hashes(block.bytes, starts, ends)
    order = np.argsort(key, kind="stable")
    key, doc, size = key[order], doc[order], (ends - starts)[order]
    fresh = np.append(True, (key[1:] != key[:-1]) | (size[1:] != size[:-1]))
    posting = np.flatnonzero(fresh | np.append(True, doc[1:] != doc[:-1]))
    tf, number, fresh = np.diff(np.append(posting, len(doc))), doc[posting], fresh[posting]
    nth = np.arange(len(posting)) - np.maximum.accumulate(np.where(fresh, np.arange(len(posting)), 0))
    row = np.flatnonzero(nth % BLOCK == 0)
    gap = np.diff(number, prepend=0)
    gap[row] = 0
    data, at = varints(np.stack([gap, tf], axis=1).reshape(-1))
    cut = np.append(at[2 * row], len(data))
    source = order[posting[row]]
    rows = pa.table(
        [
            pa.array(np.full(len(row), shard)),
            _strings(block.bytes, starts[source], ends[source]),
            pa.array((nth[row] // BLOCK).astype(np.int32)),
            pa.array(number[row].astype(np.int64)),
            pa.array(np.diff(np.append(row, len(posting))).astype(np.int64)),
            pa.array(np.zeros(len(row), np.int64)),
            pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary()),
        ],
        schema=INDEX,
    )
    return pa.concat_tables([about, rows])


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = 12 << 20) -> DataFrame:
    """The index of all terms of all texts, as rows to be written: (shard, term, block, first, n, total, postings).

    No text is shuffled: a shard is what one task reads in a row, up to about so many bytes of text, or one longer
    text. The row of the empty term has in n the documents with a term and in total their terms.
    """

    def built(batches) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, count
            if held:
                out = shard_of(pa.Table.from_batches(held), (part << 32) + count)
                held, size, count = [], 0, count + 1
                yield from out.to_batches(max_chunksize=100_000)
                X.release()

        for batch in batches:
            ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0)))
            lo = 0
            while lo < batch.num_rows:
                before = ends[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, before + shard_bytes - size, "right")))
                held.append(batch.slice(lo, hi - lo))
                size += int(ends[hi - 1] - before)
                lo = hi
                if size >= shard_bytes * 0.9:
                    yield from flush()
        yield from flush()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(built, INDEX_SQL)


class Postings:
    """The blocks of one term in one shard, each decoded when a merge first reaches it."""

    def __init__(self, weight: int):
        self.weight, self.first, self.packed = weight, [], []

    def add(self, first: int, packed: bytes) -> None:
        self.first.append(first)
        self.packed.append(packed)

    def block(self, k: int, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of documents, what the term adds to their scores)."""
        if isinstance(self.packed[k], bytes):
            gap, tf = from_varints(np.frombuffer(self.packed[k], np.uint8)).reshape(-1, 2).T
            number = np.cumsum(gap) + self.first[k]
            self.packed[k] = (number, self.weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * mass[number])))
        return self.packed[k]


def best_of(lists: list[Postings], mass: np.ndarray, most: int, span: int = 4096) -> list[tuple[int, int]]:
    """The best (score, -number of document) of a shard: a merge of the lists by a heap of their next documents."""
    heads = [(x.first[0], k, 0, 0) for k, x in enumerate(lists)]
    heapq.heapify(heads)
    best: list[tuple[int, int]] = []
    while heads:
        lo = heads[0][0]
        total = np.zeros(min(span, len(mass) - lo), np.int64)
        while heads and heads[0][0] < lo + span:
            _, k, at, within = heapq.heappop(heads)
            number, adds = lists[k].block(at, mass)
            to = int(np.searchsorted(number, lo + span))
            total[number[within:to] - lo] += adds[within:to]
            if to < len(number):
                heapq.heappush(heads, (int(number[to]), k, at, to))
            elif at + 1 < len(lists[k].first):
                heapq.heappush(heads, (lists[k].first[at + 1], k, at + 1, 0))
        found = np.flatnonzero(total > (best[0][0] if len(best) == most else 0))
        if len(found) > most:
            found = found[np.lexsort((found, -total[found]))[:most]]
        for score, number in zip(total[found].tolist(), (found + lo).tolist()):
            if len(best) < most:
                heapq.heappush(best, (score, -number))
            else:
                heapq.heappushpop(best, (score, -number))
    return best


def _search(table: pa.Table, n_docs: int, n_terms: int, most: int) -> pa.Table:
    """The best documents of one shard for each item of one block."""
    table = table.sort_by([("term", "ascending"), ("block", "ascending")])
    out: dict[str, list] = {"item_id": [], "doc_id": [], "score": []}
    about = np.frombuffer(b"".join(table.column("postings")[:1].to_pylist()), np.uint8)
    both = X.unsqueeze(about.tobytes(), np.int64)
    ids, length = both[: len(both) // 2], both[len(both) // 2 :]
    mass = 50 + (50 * length * n_docs) // n_terms
    lists, items, asked = {}, {}, table.column("items")
    for k, (term, first, weight, packed) in enumerate(zip(*(table.column(c).to_pylist() for c in ("term", "first", "weight", "postings")))):
        if not term:
            continue
        if term not in lists:
            lists[term] = Postings(weight)
            for item in asked[k].as_py():
                items.setdefault(item, []).append(lists[term])
        lists[term].add(first, packed)
    for item, own in items.items():
        for score, number in best_of(own, mass, most):
            out["item_id"].append(item)
            out["doc_id"].append(int(ids[-number]) if ids[-number] != X.NULL_ID else None)
            out["score"].append(score)
    return pa.table(out, schema=pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]))


def terms_of(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.regexp_extract_all(F.translate(text, CAPITALS, SMALL), F.lit(f"({TERM})")))


def search(index: DataFrame, items: DataFrame, most: int = 50, item_id: str = "item_id", text: str = "text", items_at_once: int = 256) -> DataFrame:
    """(item_id, rank, doc_id, score) of the best documents of a written index for each item, scores above 0 only.

    The weight of a term is floor(1000 ln((2N + 2) / (2df + 1))), the score of a document the sum of
    weight * ((10^9 tf) div (1000 tf + 20 m)), m being 50 + (50 n N) div L. Items that share an id ask with the terms
    of them all.
    """
    n_docs, n_terms = index.where("block < 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    n_items = items.select(item_id).distinct().count()
    blocks = max(1, math.ceil(n_items / items_at_once))
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.explode(terms_of(F.col(text))).alias("term")).distinct()
    dealt = asked.withColumn("at", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))
    wanted = written(dealt.groupBy("term", "at").agg(F.collect_list("item_id").alias("items")))
    size = wanted.agg(F.sum(F.octet_length("term") + 8 * F.size("items") + 32)).first()[0] or 0
    small = F.broadcast if size <= SENT_BYTES else lambda x: x
    held = index.where("block >= 0").join(small(wanted.select("term").distinct()), "term", "left_semi")
    ratio = F.lit(2.0 * n_docs + 2.0) / (2 * F.sum("n") + 1)
    weights = held.groupBy("term").agg(F.floor(1000 * F.log(ratio)).cast("long").alias("weight"))
    weighed = written(wanted.join(weights, "term"))
    hits = index.where("block >= 0").join(small(weighed), "term").select("shard", "at", "term", "block", "first", "weight", "items", "postings")
    about = index.where("block < 0").select("shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("at"), "term", "block", "first", F.lit(0).cast("long").alias("weight"), F.array().cast("array<long>").alias("items"), "postings")
    found = hits.unionByName(about).groupBy("shard", "at").applyInArrow(X.lean(lambda t: _search(t, n_docs, max(1, n_terms), most)), "item_id long, doc_id long, score long")
    w = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).select("item_id", "rank", "doc_id", "score")


def lexical_search(docs: DataFrame, items: DataFrame, most: int = 50) -> DataFrame:
    """Builds the index of docs (doc_id, text), writes it to the shared folder and searches it for items (item_id, text).

    A null text has no terms, of a document or an item; a very long text is a shard of its own; ties go to the
    smaller doc_id, a null doc_id last; repeated rows are documents each on its own; with no documents or no items
    there are no rows; further columns, whatever their names, are ignored.
    """
    return search(written(build_index(docs)), items, most)


SQL = rf"""
with words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '{TERM}') as t from documents),
     sizes as (select doc_id, len(t) as n from words where len(t) > 0),
     totals as (select count(*) as nd, sum(n)::bigint as nt from sizes),
     tfs as (select doc_id, term, count(*) as tf from (select doc_id, unnest(t) as term from words) group by all),
     dfs as (select term, count(*) as df from tfs group by term),
     asked as (select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '{TERM}')) as term from benchmark),
     scored as (select item_id, doc_id, sum(floor(1000 * ln((2 * nd + 2)::double / (2 * df + 1)))::bigint * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nt))))::bigint as score
                from asked join dfs using (term) join tfs using (term) join sizes using (doc_id), totals group by item_id, doc_id),
     ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
select item_id::bigint as item_id, rank::integer as rank, doc_id, score from ranked where rank <= 50
"""
