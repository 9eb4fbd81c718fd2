"""SimHash fingerprints, and exact comparison of fingerprints in tiles.

Fingerprints of equal bits meet first, so copies cost one row. All of few fingerprints are one run. Of more, two
within the radius agree wholly in at least one of radius + 1 blocks of bits, so those that agree in the first bits
of a block, as many as leave some RUN rows together, form a run (once whole blocks are too coarse, there are more of
them, and several must agree). A run is sorted by population count and compared tile against tile with
exclusive-or and bit counts; tile pairs whose population counts differ beyond the radius are skipped, which is some
third of those in a run. A run of more than TILE rows is cut into tiles by
population count and hash before it is shuffled, each pair of tiles to a task of its own. A task reports
a spanning forest of its links, not all of them.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import written

#: Rows of one run that one task compares.
TILE = 8192
#: Rows of a run that even fingerprints are dealt into, of some tiles.
RUN = 2048


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Bit by bit, whether over half of the XXH64 values of the text's word shingles have it set."""
    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(flat, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1]
    counts = np.zeros(64, np.int64)
    n = len(starts)
    for lo in range(0, n, 1 << 16):
        pairs = zip(starts[lo : lo + (1 << 16)].tolist(), ends[lo + shingle - 1 : lo + shingle - 1 + (1 << 16)].tolist())
        bits = np.unpackbits(np.frombuffer(b"".join([xxhash.xxh64_digest(flat[i:j], seed) for i, j in pairs]), np.uint8)).reshape(-1, 64)
        whole = len(bits) // 255 * 255
        counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a signed long; a null text has no words, and so 0."""

    def each(batches):
        for batch in batches:
            values = [fingerprint(t or b"", shingle) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(each, "doc_id long, fp long")


def _blocks(n: int, radius: int) -> tuple[int, int, int]:
    """So many blocks, so many of them that must agree, and in so many of their first bits, that a run holds some tiles of n even fingerprints."""
    for agree in range(1, 4):
        blocks = radius + agree
        if n >> (64 * agree // blocks) <= TILE or agree == 3:
            break
    bits = max(0, round(math.log2(max(1, n) / RUN))) if agree == 1 else 64
    return blocks, agree, bits


def _runs(fp: Column, radius: int, n: int) -> Column:
    blocks, agree, bits = _blocks(n, radius)
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    out = []
    for which in combinations(range(blocks), agree) if bits else [()]:
        mask = sum(((1 << min(bits, cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in which)
        mask -= (mask >> 63) << 64
        out.append(F.struct(F.lit(len(out)).alias("band"), fp.bitwiseAND(F.lit(mask)).alias("value")))
    return F.array(*out)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index reachable from each of n indices over the links a[i] - b[i]."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_tiles(count: np.ndarray, radius: int, tile: int) -> list[tuple[int, int]]:
    """Where the pairs of tiles begin whose population counts, in ascending order, come within the radius of each other."""
    starts = range(0, len(count), tile)
    return [(i, j) for i in starts for j in range(i, len(count), tile) if count[j] <= count[min(i + tile, len(count)) - 1] + radius]


def compare_tiles(fp: np.ndarray, radius: int, tile: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of indices whose values differ in at most radius bits."""
    count = np.bitwise_count(fp).astype(np.int64)
    order = np.argsort(count, kind="stable")
    fp, count = fp[order], count[order]
    left, right = [], []
    for i, j in near_tiles(count, radius, tile):
        near = np.bitwise_count(fp[i : i + tile, None] ^ fp[None, j : j + tile]) <= radius
        if i == j:
            near = np.triu(near, 1)
        x, y = np.nonzero(near)
        left.append(order[x + i])
        right.append(order[y + j])
    return (np.concatenate(left), np.concatenate(right)) if left else (order[:0], order[:0])


def _links(table: pa.Table, radius: int) -> pa.Table:
    table = table.sort_by([(c, "ascending") for c in ("band", "value", "one", "other")])
    fp = table.column("fp").to_numpy().view(np.uint64)
    rep = table.column("rep").to_numpy()
    key = [table.column(c).to_numpy() for c in ("band", "value", "one", "other")]
    new = np.zeros(max(0, len(fp) - 1), bool)
    for k in key:
        new |= k[1:] != k[:-1]
    bounds = np.concatenate([[0], np.flatnonzero(new) + 1, [len(fp)]])
    src, dst = [], []
    for lo, hi in zip(bounds, bounds[1:]):
        if hi - lo > 1:
            a, b = compare_tiles(fp[lo:hi], radius)
            if len(a):
                root = forest(a, b, hi - lo)
                held = np.flatnonzero(root != np.arange(hi - lo))
                src.append(rep[lo:hi][held])
                dst.append(rep[lo:hi][root[held]])
    return pa.table({"src": np.concatenate(src) if src else rep[:0], "dst": np.concatenate(dst) if dst else rep[:0]}, schema=LINKS)


LINKS = pa.schema([("src", pa.int64()), ("dst", pa.int64())])


def near_fingerprints(fps: DataFrame, radius: int = 4) -> DataFrame:
    """(src, dst): links between the rows (fp, rep) that span all that are within the radius."""
    n = fps.count()
    runs = fps.select("fp", "rep", F.inline(_runs(F.col("fp"), radius, n)))
    crowded = runs.groupBy("band", "value").count().where(F.col("count") > TILE)
    bits = F.bit_count("fp")
    salts = F.ceil(F.col("count") / F.lit(8 * TILE)).cast("int")
    mine = bits * salts + F.pmod(F.xxhash64("fp"), salts).cast("int")
    others = F.sequence(F.greatest(bits - radius, F.lit(0)) * salts, F.least(bits + radius, F.lit(64)) * salts + salts - 1)
    pairs = F.when(F.col("count").isNull(), F.array(F.struct(F.lit(0).alias("one"), F.lit(0).alias("other")))).otherwise(
        F.transform(others, lambda o: F.struct(F.least(mine, o).alias("one"), F.greatest(mine, o).alias("other")))
    )
    tiles = runs.join(crowded, ["band", "value"], "left").select("fp", "rep", "band", "value", F.inline(pairs))
    slots = max(1, math.ceil(n / 20_000))
    slot = F.pmod(F.xxhash64("band", "value", "one", "other"), F.lit(slots)).cast("int")
    return tiles.withColumn("slot", slot).groupBy("slot").applyInArrow(lambda t: _links(t, radius), "src long, dst long")


def simhash_dedup(docs: DataFrame, radius: int = 4, shingle: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Returns one row per row of docs: doc_id, fp (64 bits as a long), component_id.

    component_id is the smallest id that links of at most radius differing bits reach. A null text is
    empty; texts without words have fingerprint 0 and link like any other; a very long text is read whole by one
    task. Rows with a null id get their fingerprint, link with nothing and have a null component; rows that share an id
    or a text link like others, and of ties the smallest id names the component; an empty table gives no rows;
    other columns, whatever their names, are ignored.
    """
    prints = written(fingerprints(docs, shingle, doc_id, text))
    fps = written(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    found = connected_components(near_fingerprints(fps, radius))
    whole = fps.join(found, fps.rep == found.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return prints.join(whole, "fp", "left").select("doc_id", "fp", component)
