"""Near-duplicate vectors by lattice hashing.

Vectors are scaled to length one and projected to 8 dimensions by several random orthonormal maps, each
with a random shift; the nearest point of the E8 lattice is the cell of a vector in that table. A vector
stands in its own cell and looks into the neighbouring cells whose lattice points are next nearest. All
that meet in a cell are compared by cosine in double precision, so no link is wrong; links between
vectors that no table brings together are missed (recall is measured in the tests).

Vectors of each number of components have a lattice of their own. Equal vectors are one row with a count. A pair is counted only where it meets first, by table and cell,
which a task can tell from the two vectors alone; so tasks return counts and a spanning forest, never
pairs. Cells of more than TILE rows are cut into tiles, each pair of tiles to a task of its own.
"""

from __future__ import annotations

import itertools
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import written
from .exchange import mix
from .simhash import forest

TILE = 4096
#: (up to so many different vectors, tables, neighbouring cells, width): finer cells in more tables as vectors grow more.
#: Each finds some 98 % of the links at a cosine of 0.9 and all but some at more, and compares a random pair with a
#: chance of 0.014, 0.0031 and 0.0018.
LEVELS = ((100_000, 5, 4, 0.55), (1_000_000, 8, 8, 0.38), (math.inf, 14, 8, 0.32))


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of plus or minus 1, or all of plus or minus 1/2 with an even number of minuses."""
    whole = [[s if k == i else t if k == j else 0 for k in range(8)] for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)]
    half = [[x / 2 for x in signs] for signs in itertools.product((1, -1), repeat=8) if signs.count(-1) % 2 == 0]
    return np.array(whole + half, float)


ROOTS = roots()


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """The nearest point of E8 to each row of y: the nearer of those in D8 and in D8 moved by 1/2."""

    def nearest_d8(x: np.ndarray) -> np.ndarray:
        near = np.rint(x)
        odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
        off = x[odd] - near[odd]
        worst = np.abs(off).argmax(axis=1)
        near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
        return near

    a, b = nearest_d8(y), nearest_d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1))[:, None], a, b)


class Lattice:
    """Cells of unit vectors: an array (vector, table, 1 + probes) of hashes, own cell first."""

    def __init__(self, dim: int, tables: int, probes: int, width: float, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.maps = [np.linalg.qr(rng.normal(size=(max(dim, 8), 8)))[0][:dim] * math.sqrt(max(dim, 8) / 8) / width for _ in range(tables)]
        self.shifts = rng.uniform(-1, 1, (tables, 8))
        self.tables, self.probes = tables, probes

    def cells(self, unit: np.ndarray) -> np.ndarray:
        out = np.empty((len(unit), self.tables, 1 + self.probes), np.uint64)
        for t in range(self.tables):
            y = unit @ self.maps[t] + self.shifts[t]
            own = nearest_e8(y)
            near = np.argpartition(-((y - own) @ ROOTS.T), self.probes, axis=1)[:, : self.probes]
            points = np.concatenate([own[:, None], own[:, None] + ROOTS[near]], axis=1)
            h = np.full(points.shape[:2], t + 1, np.uint64)
            for k in range(8):
                h = mix(h * np.uint64(31) + (2 * points[:, :, k]).astype(np.int64).view(np.uint64))
            out[:, t] = h
        return out


@lru_cache(maxsize=8)
def lattice_of(dim: int, tables: int, probes: int, width: float) -> Lattice:
    return Lattice(dim, tables, probes, width)


def _unit(raw: list[bytes], dtype: str) -> np.ndarray:
    v = np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1).astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _meet(table: pa.Table, lattice: Lattice, least: float, dtype: str) -> pa.Table:
    table = table.sort_by([(c, "ascending") for c in ("tab", "cell", "one", "other", "rep")])
    rep, first, back = np.unique(table.column("rep").to_numpy(), return_index=True, return_inverse=True)
    raw = table.column("vec").take(pa.array(first)).to_pylist()
    copies = table.column("copies").to_numpy()[first]
    unit = _unit(raw, dtype)
    cells = lattice.cells(unit)
    tab, cell, one, other, mine, home = (table.column(c).to_numpy(zero_copy_only=False) for c in ("tab", "cell", "one", "other", "mine", "home"))
    new = (tab[1:] != tab[:-1]) | (cell[1:] != cell[:-1]) | (one[1:] != one[:-1]) | (other[1:] != other[:-1])
    bounds = np.concatenate([[0], np.flatnonzero(new) + 1, [len(tab)]])
    links, src, dst = np.zeros(len(rep), np.int64), [], []
    for lo, hi in zip(bounds, bounds[1:]):
        if hi - lo < 2 or not home[lo:hi].any():
            continue
        t, at = tab[lo], np.uint64(np.int64(cell[lo]).view(np.uint64))
        left = np.arange(lo, hi)[mine[lo:hi] == one[lo]]
        right = np.arange(lo, hi)[mine[lo:hi] == other[lo]]
        for x in range(0, len(left), 512):
            rows = left[x : x + 512]
            near = unit[back[rows]] @ unit[back[right]].T >= least
            near &= home[rows][:, None] | home[right][None]
            if one[lo] == other[lo]:
                near &= rows[:, None] < right[None]
            i, j = np.nonzero(near)
            a, b = back[rows[i]], back[right[j]]
            a, b = a[a != b], b[a != b]
            if not len(a):
                continue
            again = np.zeros(len(a), bool)
            for k in range(t + 1):
                ab = (cells[a, k] == cells[b, k, :1]).any(axis=1)
                ba = (cells[b, k] == cells[a, k, :1]).any(axis=1)
                if k < t:
                    again |= ab | ba
                else:  # in this table they can meet in both of their own cells: the smaller one counts
                    both = ab & ba & (cells[a, k, 0] != cells[b, k, 0])
                    again |= both & (np.minimum(cells[a, k, 0], cells[b, k, 0]) != at)
            a, b = a[~again], b[~again]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            src.append(a)
            dst.append(b)
    out = {"src": rep[links > 0], "dst": np.full(int((links > 0).sum()), -1), "n": links[links > 0]}
    if src:
        root = forest(np.concatenate(src), np.concatenate(dst), len(rep))
        held = np.flatnonzero(root != np.arange(len(rep)))
        out = {"src": np.append(out["src"], rep[held]), "dst": np.append(out["dst"], rep[root[held]]), "n": np.append(out["n"], np.full(len(held), -1))}
    return pa.table(out, schema=MET)


MET = pa.schema([("src", pa.int64()), ("dst", pa.int64()), ("n", pa.int64())])


def lattice_dedup(vectors: DataFrame, least: float = 0.9, level: tuple[int, int, float] | None = None, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Links vectors whose cosine is at least `least`.

    level: tables, neighbouring cells and width; by default those of LEVELS for as many different vectors.

    Returns one row per row of vectors: vec_id, n_links (other rows linked directly), component_id (smallest
    id reachable), kept (vec_id = component_id). Vectors of different numbers of components don't link; those
    that are null, empty, zero or hold null or non-finite components link with nothing, as do rows with a
    null id (component null, kept null). Repeated rows link with each other; of ties the smallest id names the
    component; an empty table gives no rows; further columns, whatever their names, are ignored.
    """
    v = F.col(embedding)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    kind = rows.schema["v"].dataType.elementType.simpleString()
    dtype = "<f4" if kind == "float" else "<f8"
    good = F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    checked = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    valid = checked.where("good").select("vec_id", "v")
    distinct = written(valid.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    n = distinct.count()
    tables, probes, width = level or next(x[1:] for x in LEVELS if n <= x[0])

    def place(batches):
        for whole in batches:
            sizes = pa.compute.list_value_length(whole.column(0))
            for dim in pa.compute.unique(sizes).to_pylist():
                batch = whole.filter(pa.compute.equal(sizes, dim))
                n = batch.num_rows
                raw = [x.tobytes() for x in np.asarray(batch.column(0).flatten()).astype(dtype).reshape(n, dim)]
                cells = lattice_of(dim, tables, probes, width).cells(_unit(raw, dtype)).view(np.int64)
                each = tables * (1 + probes)
                which = np.repeat(np.arange(n), each)
                yield pa.record_batch(
                    [
                        pa.array(np.full(n * each, dim, np.int32)),
                        pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), 1 + probes), n)),
                        pa.array(cells.reshape(-1)),
                        pa.array(np.tile(np.arange(1 + probes) == 0, n * tables)),
                        batch.column(1).take(pa.array(which)),
                        batch.column(2).take(pa.array(which)),
                        pa.array(raw, pa.binary()).take(pa.array(which)),
                    ],
                    ["dim", "tab", "cell", "home", "rep", "copies", "vec"],
                )

    entries = distinct.mapInArrow(place, "dim int, tab int, cell long, home boolean, rep long, copies long, vec binary")
    crowded = entries.groupBy("dim", "tab", "cell").count().where(F.col("count") > TILE)
    tiles = F.coalesce(F.ceil(F.col("count") / F.lit(TILE)).cast("int"), F.lit(1))
    mine = F.pmod(F.xxhash64("rep"), tiles).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), tiles - 1), lambda o: F.struct(F.least(mine, o).alias("one"), F.greatest(mine, o).alias("other"), mine.alias("mine")))
    tiled = entries.join(crowded, ["dim", "tab", "cell"], "left").select("dim", "tab", "cell", "home", "rep", "copies", "vec", F.inline(pairs))
    slots = max(1, math.ceil(n * tables * (1 + probes) / 20_000))
    slot = F.pmod(F.xxhash64("tab", "cell", "one", "other"), F.lit(slots)).cast("int")
    met = written(tiled.withColumn("slot", slot).groupBy("dim", "slot").applyInArrow(lambda t: _meet(t, lattice_of(t.column("dim")[0].as_py(), tables, probes, width), least, dtype), "src long, dst long, n long"))
    found = connected_components(met.where("n < 0").select("src", "dst"))
    linked = met.where("n > 0").groupBy("src").agg(F.sum("n").alias("near"))
    whole = distinct.join(linked, distinct.rep == linked.src, "left").join(found, distinct.rep == found.node, "left")
    whole = whole.select("v", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linking = valid.join(whole, "v").select("vec_id", "n_links", "component_id")
    alone = checked.where(~F.col("good")).select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return linking.union(alone).select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
