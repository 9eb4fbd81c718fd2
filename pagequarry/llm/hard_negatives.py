"""Hard negatives by a vector-approximation file.

Each component of each row is quantised into one of 64 cells between the least and the most that any row has in
that place; the file holds blocks of these codes beside the whole numbers themselves. For a block of anchors the
edges of a row's cells are looked up, and give a lower and an upper bound of its score with each anchor: the
score of the middles of the cells, less or more the widths that the anchor's components reach over. Only rows whose
bounds let them into what is asked for are scored exactly:

1. positives: rows of the anchor's label, less those whose upper bound is under as many lower bounds as are asked for;
2. negatives: rows of other labels whose bounds reach into the window of a positive's score, less those under as many
   lower bounds of rows that are inside it for certain.

Each pass meets blocks of anchors, a stated query set, with blocks of all rows, and returns a bounded number of rows
for each anchor and block; the best of them all are taken by a window that prunes before the shuffle. No row is
grouped by label, so a label of any share is spread like the rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

CELLS = 64


def _numbers(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dim)


def bounds_of(whole: DataFrame) -> DataFrame:
    """(dim, lows, highs): the least and the most of each component, for each number of components.

    Tasks return one row for each number of components that they meet, so what is gathered is small.
    """

    def partial(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column(0))
            for dim in pc.unique(sizes).to_pylist():
                v = np.asarray(batch.filter(pc.equal(sizes, dim)).column(0).flatten()).reshape(-1, dim)
                yield pa.record_batch([pa.array([dim], pa.int32()), pa.array([v.min(0)], pa.list_(pa.int64())), pa.array([v.max(0)], pa.list_(pa.int64()))], ["dim", "lows", "highs"])

    parts = whole.select("v").mapInArrow(partial, "dim int, lows array<long>, highs array<long>")
    each = parts.select("dim", F.posexplode(F.arrays_zip("lows", "highs"))).groupBy("dim", "pos").agg(F.min("col.lows").alias("lo"), F.max("col.highs").alias("hi"))
    in_order = F.array_sort(F.collect_list(F.struct("pos", "lo", "hi")))
    return each.groupBy("dim").agg(in_order.alias("e")).select("dim", F.col("e.lo").alias("lows"), F.col("e.hi").alias("highs"))


def file_of(whole: DataFrame, rows: int = 4096) -> DataFrame:
    """The vector-approximation file: a row for each block, with ids, labels, codes, edges of cells, and the numbers."""

    def pack(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column("v"))
            for dim in pc.unique(sizes).to_pylist():
                part = batch.filter(pc.equal(sizes, dim))
                for at in range(0, part.num_rows, rows):
                    own = part.slice(at, rows)
                    v = np.asarray(own.column("v").flatten()).reshape(-1, dim)
                    lo, hi = (np.array(own.column(c)[0].as_py(), np.int64) for c in ("lows", "highs"))
                    width = np.maximum(1, -(-(hi - lo + 1) // CELLS))
                    codes = ((v - lo) // width).astype(np.uint8)
                    packed = [x.tobytes() for x in (np.asarray(own.column("vec_id")), np.asarray(own.column("label")), codes, np.stack([lo, width]), v)]
                    yield pa.record_batch([pa.array([dim], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], ["dim", "ids", "labels", "codes", "edges", "numbers"])

    edged = whole.withColumn("dim", F.size("v")).join(F.broadcast(bounds_of(whole)), "dim")
    return edged.select("vec_id", "label", "v", "lows", "highs").mapInArrow(pack, "dim int, ids binary, labels binary, codes binary, edges binary, numbers binary")


class Block:
    """Some rows of the file, and the bounds of their scores."""

    def __init__(self, dim, ids, labels, codes, edges, numbers):
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        self.numbers = np.frombuffer(numbers, "<i8").reshape(-1, dim)
        lo, width = np.frombuffer(edges, "<i8").reshape(2, dim)
        middle = lo + width * np.arange(CELLS)[:, None] + (width - 1) / 2  # by cell and component
        self.middle = middle[np.frombuffer(codes, np.uint8).reshape(-1, dim), np.arange(dim)]
        self.half = (width - 1) / 2

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds, (anchor, row); a little wider than the sums, for what doubles can't hold of huge ones."""
        a = anchors.astype(np.float64)
        mid, reach = a @ self.middle.T, (np.abs(a) @ self.half)[:, None]
        reach = reach + 1e-12 * (np.abs(mid) + reach) + 1e-6
        return mid - reach, mid + reach


def _kth(bound: np.ndarray, k: int) -> float:
    return -np.inf if len(bound) < k else float(np.partition(bound, len(bound) - k)[len(bound) - k])


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


FOUND = ["anchor_id", "slot", "vec_id", "score"]
FOUND_SQL = "anchor_id long, slot long, vec_id long, score long"


def _found(out: list[list]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in out], FOUND)


def _scan(each):
    """A function of batches of (block of anchors, block of rows) that calls `each` for every pair and lists what it yields."""

    def run(batches):
        for batch in batches:
            for pair in batch.to_pylist():
                out: list[list] = [[], [], [], []]
                block = Block(*(pair[c] for c in ("dim", "ids", "labels", "codes", "edges", "numbers")))
                anchors = np.frombuffer(pair["a_numbers"], "<i8").reshape(-1, pair["dim"])
                for slot, anchor, best, score in each(block, anchors, pair):
                    for column, values in zip(out, (np.full(len(best), anchor), np.full(len(best), slot), block.ids[best], score)):
                        column.append(values)
                yield _found(out)

    return run


def _positives(k: int):
    def each(block: Block, anchors: np.ndarray, pair: dict):
        ids, labels = np.frombuffer(pair["a_ids"], "<i8"), np.frombuffer(pair["a_labels"], "<i8")
        low, high = block.bounds(anchors)
        for a in range(len(ids)):
            own = np.flatnonzero((block.labels == labels[a]) & (block.ids != ids[a]))
            may = own[high[a, own] >= _kth(low[a, own], k)]
            score = block.numbers[may] @ anchors[a]
            best = _best(score, block.ids[may], k)
            yield 0, ids[a], may[best], score[best]

    return each


def _negatives(k: int, low_pct: int, high_pct: int):
    def each(block: Block, anchors: np.ndarray, pair: dict):
        ids, labels = np.frombuffer(pair["a_ids"], "<i8"), np.frombuffer(pair["a_labels"], "<i8")
        low, high = block.bounds(anchors)
        told = np.frombuffer(pair["a_told"], "<i8").reshape(-1, 3)  # anchor's place, positive's id, its score
        for at, slot, positive in told:
            a = int(at)
            # whole scores s with low_pct * positive <= 100 * s <= high_pct * positive
            least, most = -(-low_pct * int(positive) // 100), high_pct * int(positive) // 100
            other = np.flatnonzero((block.labels != labels[a]) & (block.ids != ids[a]) & (high[a] >= least) & (low[a] <= most))
            inside = low[a, other][(low[a, other] >= least) & (high[a, other] <= most)]
            may = other[high[a, other] >= _kth(inside, k)]
            score = block.numbers[may] @ anchors[a]
            hit = (score >= least) & (score <= most)
            may, score = may[hit], score[hit]
            best = _best(score, block.ids[may], k)
            yield slot, ids[a], may[best], score[best]

    return each


def _anchor_blocks(anchors: DataFrame, at_once: int) -> DataFrame:
    """Anchors, each with its positives so far, packed (dim, ids, labels, numbers, told), one block to a partition."""

    def pack(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column("v"))
            for dim in pc.unique(sizes).to_pylist():
                part = batch.filter(pc.equal(sizes, dim))
                for lo in range(0, part.num_rows, at_once):
                    own = part.slice(lo, at_once)
                    told = [(k, p["vec_id"], p["score"]) for k, ps in enumerate(own.column("told").to_pylist()) for p in ps or ()]
                    packed = [np.asarray(own.column("vec_id")), np.asarray(own.column("label")), np.asarray(own.column("v").flatten()), np.array(told, np.int64)]
                    yield pa.record_batch([pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)], ["a_dim", "a_ids", "a_labels", "a_numbers", "a_told"])

    parts = max(1, -(-anchors.count() // at_once))
    return anchors.repartition(parts).select("vec_id", "label", "v", "told").mapInArrow(pack, "a_dim int, a_ids binary, a_labels binary, a_numbers binary, a_told binary")


def _first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low_pct: int = 30, high_pct: int = 90, at_once: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over rows (vec_id, label, v).

    v holds whole numbers; a score is their inner product. An anchor's positives are the first other rows of its
    label; for each, the first rows of other labels whose score is from low_pct to high_pct per cent of the positive's.
    Higher scores come first, ties by smaller vec_id. Rows with a null id, label or vector, an empty vector or a null
    component take no part; vectors of different numbers of components don't meet; rows that repeat an id are
    each a row to others, but never to themselves; a positive that is repeated has its negatives once; an empty table
    gives no rows; further columns, whatever their names, are ignored.
    """
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull())
    whole = rows.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("v").cast("array<long>").alias("v"), is_anchor.alias("anchor"))
    whole = written(whole)
    file = written(file_of(whole))
    anchors = whole.where("anchor").dropDuplicates(["vec_id", "label", "v"]).select("vec_id", "label", "v", F.lit(None).cast("array<struct<vec_id: long, score: long>>").alias("told"))

    def met(asking: DataFrame, each) -> DataFrame:
        pairs = file.join(_anchor_blocks(asking, at_once).hint("shuffle_replicate_nl"), F.col("dim") == F.col("a_dim"))
        return pairs.mapInArrow(_scan(each), FOUND_SQL)

    first = _first(met(anchors, _positives(positives)), positives, "anchor_id")
    told = written(first.groupBy("anchor_id").agg(F.collect_set(F.struct("vec_id", "score")).alias("told")))
    asking = anchors.drop("told").join(told, anchors.vec_id == told.anchor_id).drop("anchor_id")
    best = _first(met(asking, _negatives(negatives, low_pct, high_pct)), negatives, "anchor_id", "slot")
    scores = told.select("anchor_id", F.inline("told")).select("anchor_id", F.col("vec_id").alias("slot"), F.col("score").alias("positive_score"))
    return best.join(scores, ["anchor_id", "slot"]).select("anchor_id", F.col("slot").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def query_rows(embeddings: DataFrame) -> DataFrame:
    """Whole numbers of 256ths, and labels moved on by one where the id is divisible by 7; rows with non-finite components go."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return embeddings.where(finite).select("vec_id", label.alias("label"), F.transform(v, lambda x: F.floor(256 * x)).alias("v"))


SQL = """
with good as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
              from embeddings
              where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
     pairs as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
               from good a join good b on a.vec_id % 100 = 0 and b.vec_id <> a.vec_id and len(a.v) = len(b.v)),
     near as (select * from pairs where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.vec_id as positive_id, row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id)::integer as rank,
       n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
from near p join pairs n on n.anchor_id = p.anchor_id and not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id) <= 10
"""
