"""Connected components over an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): each node that has an edge to another one, and the smallest node reachable from it.

    Alternates two steps until nothing changes, each a grouped minimum and a join: neighbours larger than
    a node are hooked to the smallest neighbour, then smaller ones are. The rounds needed grow with the
    logarithm of the diameter. Each round is written to the shared folder, so plans stay short and a
    lost executor costs one round. Null ends are left out.
    """
    a, b = F.col(src), F.col(dst)
    edge = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    edge, seen = written(edge), None
    while True:
        both = edge.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edge.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi != lo").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi")
        hooked = small.where("lo != m").select(F.greatest("lo", "m").alias("hi"), F.least("lo", "m").alias("lo")).union(low.select("hi", "m")).distinct()
        edge = written(hooked)
        now = tuple(edge.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
        if now == seen:
            break
        seen = now
    roots = edge.select(F.col("lo").alias("node")).distinct()
    return edge.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots.select("node", F.col("node").alias("component")))


def reach(links: DataFrame, roots: DataFrame, most: int) -> DataFrame:
    """(node, depth): nodes at most so many links (src, dst) from the roots, by the fewest; each round follows the newest only."""
    seen = written(roots.select("node").where("node is not null").distinct().withColumn("depth", F.lit(0)))
    edges = written(links.select(F.col("src").alias("node"), "dst").distinct())
    newest = seen
    for depth in range(1, most + 1):
        met = newest.join(edges, "node").select(F.col("dst").alias("node")).where("node is not null").distinct()
        newest = written(met.join(seen, "node", "left_anti").withColumn("depth", F.lit(depth)))
        if newest.isEmpty():
            break
        seen = seen.union(newest)
    return seen


def depths_and_kept(tree: DataFrame) -> DataFrame:
    """(node, depth, kept) of a tree (node, parent, full): kept if full or above a full node.

    Pointers double their length each round, so rounds grow with the logarithm of the depth; a node without
    a parent in the table is a root, and depth counts the known nodes above. Loops raise an error.
    """
    nodes = tree.select("node", F.coalesce("full", F.lit(False)).alias("full"), "parent")
    known = nodes.select(F.col("node").alias("parent"))
    up = nodes.join(known.hint("merge"), "parent", "left_semi").select("node", F.col("parent").alias("up"), F.lit(1).cast("long").alias("steps"))
    up = written(nodes.select("node", "full").join(up.hint("merge"), "node", "left").select("node", "full", "up", F.coalesce("steps", F.lit(0).cast("long")).alias("steps")))
    for _ in range(40):
        if up.where("up is not null").isEmpty():
            return up.select("node", F.col("steps").alias("depth"), F.col("full").alias("kept"))
        higher = up.select(F.col("node").alias("at"), F.col("up").alias("next"), F.col("steps").alias("more"))
        lifted = up.where("full and up is not null").select(F.col("up").alias("node"), F.lit(True).alias("lifted")).distinct()
        grown = up.join(higher.hint("merge"), F.col("up") == F.col("at"), "left").join(lifted.hint("merge"), "node", "left")  # as large as the tree, so not for the driver
        up = written(grown.select("node", (F.col("full") | F.coalesce("lifted", F.lit(False))).alias("full"), F.col("next").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0).cast("long"))).alias("steps")))
    raise ValueError("the tree has a loop")


def only_children_merged(tree: DataFrame) -> DataFrame:
    """(node, into) of a tree (node, parent): an only child goes into the nearest node above that is none, others into themselves.

    A parent that the table lacks counts as none. Pointers double their length each round. Loops raise an error.
    """
    known = tree.select(F.col("node").alias("parent"))
    only = tree.join(known, "parent", "left_semi").groupBy("parent").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1").select("node", "parent")
    at = written(tree.select("node").join(only, "node", "left").select("node", F.coalesce("parent", "node").alias("into"), F.col("parent").isNotNull().alias("only")))
    for _ in range(40):
        above = at.where("into != node").select(F.col("node").alias("into"), F.col("into").alias("higher"))
        if at.join(above, "into", "left_semi").isEmpty():
            if at.where("only and into = node").isEmpty():
                return at.select("node", "into")
            break
        at = written(at.join(above, "into", "left").select("node", F.coalesce("higher", "into").alias("into"), "only"))
    raise ValueError("the tree has a loop")


def apply_merges(pairs: DataFrame) -> DataFrame:
    """(seq, keep, gone, done): decisions in order of seq, skipping those with an end that was merged away before.

    Decisions depend on earlier ones that share an end, so each round settles those whose ends no open
    earlier decision shares, many at once, and drops those whose ends are gone by then.
    """
    start = pairs.where("keep is not null and gone is not null")
    open_, settled = written(start), []
    while not open_.isEmpty():
        ends = open_.select("seq", F.col("keep").alias("end")).union(open_.select("seq", "gone"))
        first = ends.groupBy("end").agg(F.min("seq").alias("first"))
        a, b = first.select(F.col("end").alias("keep"), F.col("first").alias("fa")), first.select(F.col("end").alias("gone"), F.col("first").alias("fb"))
        now = written(open_.join(a, "keep").join(b, "gone").where("seq = fa and seq = fb").select("seq", "keep", "gone"))
        settled.append(now.withColumn("done", F.lit(True)))
        dead = now.select(F.col("gone").alias("end")).distinct()
        left = open_.join(now.select("seq"), "seq", "left_anti")
        hit = F.col("d1").isNotNull() | F.col("d2").isNotNull()
        marked = left.join(dead.select(F.col("end").alias("keep"), F.lit(1).alias("d1")), "keep", "left").join(dead.select(F.col("end").alias("gone"), F.lit(1).alias("d2")), "gone", "left")
        marked = written(marked.select("seq", "keep", "gone", hit.alias("skip")))
        settled.append(marked.where("skip").select("seq", "keep", "gone", F.lit(False).alias("done")))
        open_ = written(marked.where("not skip").select("seq", "keep", "gone"))
    out = start.select("seq", "keep", "gone", F.lit(True).alias("done")).limit(0)
    for part in settled:
        out = out.union(part)
    return out
