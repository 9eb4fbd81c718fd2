"""A store of vectors on disk: an inverted file of cells, that is added to by id and searched by cosine."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import written
from ..sources.keyed import KeyedTable, held_rows, rewrite

ROWS = "id long, v array<float>, cell int"
#: Rows that centres are fitted to, and that choose the number of probes, at most.
SAMPLE, ASKED = 50_000, 500
#: Bytes of rows with their cells, and of likenesses to centres, that one task makes at a time.
PLACED_BYTES = 8 << 20
#: Bytes of asking vectors and of rows that meet in one group, and how many pairs wait there to be compared exactly.
ASKED_BYTES, MET_BYTES, WAITING = 4 << 20, 32 << 20, 1 << 18


def _unit(column) -> np.ndarray:
    m = np.asarray(pc.list_flatten(column), dtype=np.float64).reshape(len(column), -1)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def valid(vectors: DataFrame, ident: str, vector: str) -> DataFrame:
    """(id, v): rows with an id and a vector of finite components that isn't zero."""
    rows = vectors.select(F.col(ident).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v"))
    good = F.col("id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.where(good)


def _closest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, a slice at a time."""
    step = max(1, PLACED_BYTES // (8 * max(1, len(centres))))
    return np.concatenate([np.zeros(0, np.int64), *((rows[lo : lo + step] @ centres.T).argmax(axis=1) for lo in range(0, len(rows), step))])


def fitted(sample: np.ndarray, cells: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """Centres of a bounded sample of unit vectors by spherical k-means."""
    rng = np.random.default_rng(seed)
    centres = sample[np.sort(rng.choice(len(sample), min(cells, len(sample)), replace=False))]
    for _ in range(rounds):
        own = _closest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-300), centres)
    return centres


def probes_for(sample: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """How many nearest cells hold such a share of the k nearest rows, measured on the sample by comparing all."""
    asked = sample[: min(ASKED, len(sample))]
    near = np.zeros((len(asked), min(k, len(sample))), np.int64)
    for lo in range(0, len(asked), 20):
        sim = asked[lo : lo + 20] @ sample.T
        sim[np.arange(len(sim)), np.arange(lo, lo + len(sim))] = -np.inf
        near[lo : lo + 20] = np.argsort(-sim, axis=1)[:, :k]
    place = np.argsort(np.argsort(-(asked @ centres.T), axis=1), axis=1)
    rank = place[np.arange(len(asked))[:, None], _closest(sample, centres)[near]]
    return int(np.quantile(rank, recall, method="higher")) + 1 if rank.size else len(centres)


def chained(centres: np.ndarray) -> list[int]:
    """Cells in an order in which each is followed by the one of those left that is nearest to it."""
    order, left = [], np.ones(len(centres), bool)
    for _ in range(len(centres)):
        order.append(int(np.where(left, centres @ centres[order[-1]], -np.inf).argmax()) if order else 0)
        left[order[-1]] = False
    return order


def dealt(order: list[int], counts: dict[int, int], most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each cell the first tile that its rows go to, and to how many: cells that follow each other share one of up to `most` rows, larger cells have some of their own."""
    first, parts, tile, held = np.zeros(len(order), np.int32), np.ones(len(order), np.int32), 0, 0
    for cell in order:
        n = counts.get(cell, 0)
        if held and held + n > most:
            tile, held = tile + 1, 0
        first[cell], parts[cell], held = tile, max(1, -(-n // most)), held + n
        if parts[cell] > 1:
            tile, held = tile + int(parts[cell]), 0
    return first, parts


def probed(sim: np.ndarray, probes: int) -> np.ndarray:
    """Which cells are the nearest, so many, of ties the first, by the likenesses to all centres."""
    if probes >= sim.shape[1]:
        return np.ones(sim.shape, bool)
    least = np.partition(sim, -probes, axis=1)[:, -probes, None]
    over, ties = sim > least, sim == least
    return over | ties & (np.cumsum(ties, axis=1) <= probes - over.sum(axis=1, keepdims=True))


def _in_run(new: np.ndarray) -> np.ndarray:
    """How many places each is behind the start of its run."""
    at = np.arange(len(new))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _single(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of rows, and the rows at length 1 in single precision, a slice at a time."""
    length, unit = np.empty(len(m)), np.empty(m.shape, np.float32)
    for lo in range(0, len(m), 4096):
        part = m[lo : lo + 4096].astype(float)
        length[lo : lo + 4096] = np.maximum(np.linalg.norm(part, axis=1), 1e-300)
        unit[lo : lo + 4096] = part / length[lo : lo + 4096, None]
    return length, unit


def nearest(asked: np.ndarray, one: np.ndarray, near: np.ndarray, ids: np.ndarray, two: np.ndarray, cells: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, ids, cosines to six digits): for each asking vector the k nearest rows of its cells, itself excluded, ties by id.

    Single precision finds the rows that may be among them, as near as the k-th of those met before; of these all are worked out
    in double precision. Of equal vectors in a cell only the first k + 1 are met, as no other can be among the k.
    """
    dim = one.shape[1]
    wide = 1e-6 + 1.2e-7 * (dim + 4)  # six digits, and what a product in single precision may be off, twice over
    mark = two.view(np.uint32) @ (np.uint32(2654435761) * np.arange(1, 2 * dim, 2, dtype=np.uint32))  # equal for equal vectors
    order = np.lexsort((ids, mark, cells))
    new = (np.diff(cells[order], prepend=-1) != 0) | np.r_[True, (two[order[1:]] != two[order[:-1]]).any(axis=1)]
    order = order[_in_run(new) <= k]
    ids, two, cells = ids[order], two[order], cells[order]
    (length, rough), (size, met) = _single(one), _single(two)
    least, step = np.full(len(one), -np.inf, np.float32), max(1, ASKED_BYTES // (8 * dim))
    kept, waiting = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), []
    n = 0

    def settle():
        q, r = (np.concatenate(c) for c in zip(*waiting))
        other = asked[q] != ids[r]
        q, r = q[other], r[other]
        exact = [np.zeros(0)]
        for lo in range(0, len(q), step):
            i, j = q[lo : lo + step], r[lo : lo + step]
            exact.append(np.round(np.einsum("ij,ij->i", one[i] / length[i, None], two[j] / size[j, None]), 6))
        q, r, sim = (np.concatenate(c) for c in zip(kept, (q, r, np.concatenate(exact))))
        at = np.lexsort((ids[r], -sim, q))
        q, r, sim = q[at], r[at], sim[at]
        place = _in_run(np.diff(q, prepend=-1) != 0)
        last = place == k - 1
        least[q[last]] = np.maximum(least[q[last]], sim[last] - wide)
        waiting.clear()
        return q[place < k], r[place < k], sim[place < k]

    _, starts = np.unique(cells, return_index=True)
    for lo, hi in zip(starts, [*starts[1:], len(cells)]):
        mine = np.flatnonzero(near[:, cells[lo]])
        for part in (mine[at : at + 2048] for at in range(0, len(mine), 2048)):
            asking = rough[part]
            for low in range(lo, hi, 512):
                sim = asking @ met[low : min(hi, low + 512)].T
                hit = sim >= least[part, None]
                if sim.shape[1] > k + 1 and np.count_nonzero(hit) > 2 * k * len(part):  # itself may be one of k + 1
                    least[part] = np.maximum(least[part], np.partition(sim, -k - 1, axis=1)[:, -k - 1] - 2 * wide)
                    hit = sim >= least[part, None]
                some = np.flatnonzero(hit.any(axis=1))
                q, r = np.nonzero(hit[some])
                if len(q):
                    waiting.append((part[some[q]], low + r))
                    n += len(q)
                if n > WAITING:
                    kept, n = settle(), 0
    if waiting:
        kept = settle()
    return asked[kept[0]], ids[kept[1]], kept[2]


def _packed(keys: list[np.ndarray], columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """Rows with equal keys as one: the keys, and the bytes of what they have in each column."""
    order = np.lexsort(keys[::-1])
    cut = np.any([np.diff(key[order]) != 0 for key in keys], axis=0)
    parts = np.split(order, np.flatnonzero(cut) + 1) if len(order) else []
    return pa.record_batch([pa.array([int(key[p[0]]) for p in parts], pa.int32()) for key in keys] + [pa.array([c[p].tobytes() for p in parts], pa.binary()) for c in columns], names)


def _part(ids: np.ndarray, cell: np.ndarray, tiles: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The tile of each row: one of its cell's, by a hash of the id."""
    return tiles[0][cell] + ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % tiles[1][cell]


class VectorStore:
    """Vectors in cells around centres, one folder for each cell; which cell an id is in is a keyed table beside them.

    Centres are fitted to at most SAMPLE rows, chosen by a hash of their ids, and every row is stored. Putting rows in
    writes the cells that they come to or leave, and no others. A search compares each asking vector with all rows
    of its nearest cells, exactly; how many cells is chosen when the store is made, so that 95 % of
    the ten nearest are found as measured on the sample.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.places = KeyedTable(spark, f"{self.path}/places", "id", "id long, cell int", 16)

    @classmethod
    def made(cls, vectors: DataFrame, path: str, ident: str = "vec_id", vector: str = "embedding", cells: int = 0, k: int = 10, recall: float = 0.95) -> VectorStore:
        rows = valid(vectors, ident, vector)
        n = rows.count()
        share = max(1, math.ceil(n / SAMPLE))
        held = rows.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()
        sample = _unit(held.column("v").combine_chunks()) if held.num_rows else np.zeros((0, 1))
        centres = fitted(sample, cells or max(1, min(4096, math.isqrt(n))))
        probes = probes_for(sample, centres, k, recall)
        about = [(k, [float(x) for x in c], probes) for k, c in enumerate(centres)]
        vectors.sparkSession.createDataFrame(about, "cell int, centre array<double>, probes int").write.parquet(f"{path.rstrip('/')}/centres")
        store = cls(vectors.sparkSession, path)
        store.put(vectors, ident, vector)
        return store

    def _centres(self) -> tuple[np.ndarray, int]:
        rows = self.spark.read.parquet(f"{self.path}/centres").orderBy("cell").collect()  # 4096 at most
        return np.array([r.centre for r in rows], float), rows[0].probes if rows else 0

    def rows(self) -> DataFrame:
        return held_rows(self.spark, f"{self.path}/cells", ROWS).where("id is not null")

    def _placed(self, rows: DataFrame, most: int) -> DataFrame:
        """(id, v, cell): each row with its nearest cells, so many, the nearest first."""
        centres, _ = self._centres()

        def place(batches):
            step = max(1, PLACED_BYTES // (4 * centres.shape[1] * min(most, len(centres)) + 8 * len(centres))) if len(centres) else 1024
            for batch in (b.slice(lo, step) for b in batches for lo in range(0, b.num_rows, step)):
                order = np.argsort(-(_unit(batch.column(1)) @ centres.T), axis=1, kind="stable")[:, :most]
                at = pa.array(np.repeat(np.arange(batch.num_rows), order.shape[1]))
                yield pa.record_batch([batch.column(0).take(at), batch.column(1).take(at), pa.array(order.reshape(-1).astype(np.int32))], ["id", "v", "cell"])

        return rows.select("id", "v").mapInArrow(place, ROWS)

    def put(self, vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding") -> list[int]:
        """Puts rows in, in place of those with the same ids; of several with one id the greatest vector stays. Returns the cells written."""
        new = written(self._placed(valid(vectors, ident, vector).groupBy("id").agg(F.max("v").alias("v")), 1))
        before = self.places.rows().join(new.select("id"), "id", "left_semi")
        touched = sorted(r.cell for r in new.select("cell").union(before.select("cell")).distinct().collect())
        if touched:
            stay = held_rows(self.spark, f"{self.path}/cells", ROWS).where(F.col("cell").isin(touched) & F.col("id").isNotNull()).join(new.select("id"), "id", "left_anti")
            mark = self.spark.createDataFrame([(None, None, c) for c in touched], ROWS)  # a cell that all rows left is still written
            rewrite(f"{self.path}/cells", written(stay.select("id", "v", "cell").unionByName(new).unionByName(mark)).repartition("cell"), "cell")
            self.places.put(new.select("id", "cell"), F.col("cell"))
        return touched

    def search(self, asking: DataFrame, k: int = 10, ident: str = "vec_id", vector: str = "embedding", probes: int = 0, tile: int = 0) -> DataFrame:
        """(query_id, id, sim, rn): the k nearest rows in the nearest cells of each asking vector, itself excluded, ties by id; of several with one id the greatest vector asks.

        Asking vectors are dealt into tiles by their nearest cell, rows into larger ones by theirs, both packed into blocks. A tile of asking
        vectors meets each tile of rows, less those of cells that none of it asks, in a group of its own that returns k rows for each
        asking vector; a vector is compared with the rows of its own cells alone. `tile`: rows of a tile, 4 and 32 MB of them if 0.
        """
        centres, held = self._centres()
        if not len(centres):
            return self.spark.createDataFrame([], "query_id long, id long, sim double, rn int")
        cells, dim, probes = len(centres), centres.shape[1], probes or max(1, held)
        asked = written(self._placed(valid(asking, ident, vector).groupBy("id").agg(F.max("v").alias("v")), 1))
        asks, rows = ({r.cell: r.n for r in df.groupBy("cell").agg(F.count("*").alias("n")).collect()} for df in (asked, self.rows()))  # 4096 at most
        order, total = chained(centres), sum(asks.values())
        asks_to = dealt(order, asks, tile or min(max(1, ASKED_BYTES // (4 * dim)), max(1024, total // 16)))
        rows_to = dealt(order, rows, tile or max(1, MET_BYTES // (4 * dim)))
        step = max(1, PLACED_BYTES // (8 * cells))

        def read(batch):
            return batch.column(0).to_numpy(), np.asarray(pc.list_flatten(batch.column(1)), np.float32).reshape(-1, dim), batch.column(2).to_numpy()

        def ask(batches):
            for batch in batches:
                ids, v, cell = read(batch)
                near = [np.packbits(probed(_unit(batch.column(1).slice(lo, step)) @ centres.T, probes), axis=1) for lo in range(0, len(ids), step)]
                if near:
                    yield _packed([_part(ids, cell, asks_to)], [ids, v, np.concatenate(near)], ["q", "asked", "a", "near"])

        def meet(batches):
            for batch in batches:
                ids, v, cell = read(batch)
                yield _packed([_part(ids, cell, rows_to), cell], [ids, v], ["r", "cell", "ids", "b"])

        def needed(batches):
            for batch in batches:
                for q, near in zip(batch.column(0).to_pylist(), batch.column(1)):
                    bits = np.bitwise_or.reduce(np.frombuffer(near.as_buffer(), np.uint8).reshape(-1, -(-cells // 8)))
                    at = np.flatnonzero(np.unpackbits(bits, count=cells)).astype(np.int32)
                    yield pa.record_batch([pa.array(np.full(len(at), q, np.int32)), pa.array(at)], ["q", "cell"])

        def compare(a: pa.Table, b: pa.Table) -> pa.Table:
            out = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            if a.num_rows and b.num_rows:
                whole = lambda t, name, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in t.column(name)])
                ids, near = whole(a, "asked", np.int64), whole(a, "near", np.uint8)
                of = np.repeat(b.column("cell").to_numpy(), [len(x.as_buffer()) // 8 for x in b.column("ids")])
                bits = np.unpackbits(near.reshape(len(ids), -1), axis=1, count=cells).view(bool)
                out = nearest(ids, whole(a, "a", np.float32).reshape(-1, dim), bits, whole(b, "ids", np.int64), whole(b, "b", np.float32).reshape(-1, dim), of, k)
            return pa.table([pa.array(c) for c in out], ["query_id", "id", "sim"])

        left = written(asked.mapInArrow(ask, "q int, asked binary, a binary, near binary"))
        right = written(self.rows().mapInArrow(meet, "r int, cell int, ids binary, b binary"))
        need = written(left.select("q", "near").mapInArrow(needed, "q int, cell int").distinct())
        pairs = need.join(right.select("cell", "r").distinct(), "cell").select("q", "r").distinct().toDF("q", "r")
        tiles = left.join(pairs, "q").groupBy("q", "r").cogroup(right.join(need, "cell").groupBy("q", "r"))
        found = tiles.applyInArrow(compare, "query_id long, id long, sim double")
        w = Window.partitionBy("query_id").orderBy(F.desc("sim"), "id")
        return found.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
