"""Copies of images by local descriptors.

Each image gets corners at several scales (the strongest responses of a corner detector on a pyramid), an
orientation for each from the intensity centroid of its patch, and a descriptor of 256 binary tests turned
by that orientation. The descriptor is four parts of 64 bits, each the key of a Hamming table: corners of
two images match if they agree in a whole part. All images that share a key form a run. The matches of two
images vote for rotation, scale and shift; the images link once enough different corners agree on one.

Matches are made twice, so that a group of copies never makes all its pairs. First each run matches its
images with the one of the smallest and the one of the largest id only: as these are the same in all runs
that two copies share, their votes are whole, and a group of n copies costs 2 n matches for each run. Then
runs whose images are still of several components match all pairs across components. A pair of images
that shares a run is thus in one component, or has had all its votes counted: the components are those
of all pairs. After the descriptors all of it is joins and aggregates, which split and combine crowded
runs; nothing is cut. Images with the same pixels are one row until the end.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import written

#: Runs that are sent to all executors at most (some 100 bytes each); beyond that they are shuffled.
SENT_RUNS = 200_000
#: Half the side of a patch, and what is left free at the edges of an image.
REACH = 13
MARGIN = REACH + 3
BITS = 256
_RNG = np.random.default_rng(11)
#: Pairs of points within a patch that are compared.
TESTS = np.clip(_RNG.normal(0, 6.0, (BITS, 4)), -REACH, REACH)
TURNS = 32
_ANGLES = 2 * np.pi * np.arange(TURNS) / TURNS


def decode_pgm(raw: bytes | None) -> np.ndarray | None:
    """The pixels of a binary 8-bit PGM (P5) or PPM (P6, as grey); None if it isn't one."""
    if not raw or raw[:2] not in (b"P5", b"P6"):
        return None
    fields, at = [], 2
    try:
        while len(fields) < 3:
            while raw[at : at + 1].isspace():
                at += 1
            if raw[at : at + 1] == b"#":
                at = raw.index(b"\n", at)
                continue
            end = at
            while raw[end : end + 1].isdigit():
                end += 1
            fields.append(int(raw[at:end]))
            at = end
        w, h, most = fields
        n = w * h * (3 if raw[1:2] == b"6" else 1)
        if most != 255 or w < 1 or h < 1 or len(raw) < at + 1 + n:
            return None
        px = np.frombuffer(raw, np.uint8, n, at + 1).astype(np.float32)
        return px.reshape(h, w) if raw[1:2] == b"5" else px.reshape(h, w, 3).mean(axis=2)
    except ValueError:
        return None


def encode_pgm(px: np.ndarray) -> bytes:
    px = np.clip(np.rint(px), 0, 255).astype(np.uint8)
    return b"P5\n%d %d\n255\n" % (px.shape[1], px.shape[0]) + px.tobytes()


def _box(a: np.ndarray, r: int) -> np.ndarray:
    """Means over squares of side 2r + 1, edges repeated."""
    p = np.pad(a, ((r + 1, r), (r + 1, r)), mode="edge").cumsum(axis=0).cumsum(axis=1)
    k = 2 * r + 1
    return (p[k:, k:] - p[:-k, k:] - p[k:, :-k] + p[:-k, :-k]) / (k * k)


def _highest(a: np.ndarray, r: int = 2) -> np.ndarray:
    """Maxima over squares of side 2r + 1, wrapped at the edges."""
    for axis in (0, 1):
        a = np.maximum.reduce([np.roll(a, d, axis) for d in range(-r, r + 1)])
    return a


def describe(image: np.ndarray, per_scale: int = 32, scales: int = 3) -> tuple[np.ndarray, ...]:
    """(x, y, scale, turn, descriptor as rows of 32 bytes) of the corners of an image; x and y in its own pixels."""
    out, now = [], image.astype(np.float64)
    for scale in range(scales):
        h, w = now.shape
        if min(h, w) < 2 * MARGIN + 4:
            break
        smooth = _box(now, 1)
        gy, gx = np.gradient(smooth)
        xx, yy, xy = _box(gx * gx, 2), _box(gy * gy, 2), _box(gx * gy, 2)
        response = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
        inner = np.zeros_like(response, bool)
        inner[MARGIN:-MARGIN, MARGIN:-MARGIN] = True
        y, x = np.nonzero(inner & (response == _highest(response)) & (response > 1.0))
        keep = np.argsort(-response[y, x], kind="stable")[:per_scale]
        y, x = y[keep], x[keep]
        if len(x):
            oy, ox = np.mgrid[-7:8, -7:8]
            disc = ox * ox + oy * oy <= 56
            oy, ox = oy[disc], ox[disc]
            patch = smooth[y[:, None] + oy, x[:, None] + ox]
            patch = patch - patch.mean(axis=1, keepdims=True)
            turn = np.rint(np.arctan2(patch @ oy, patch @ ox) / (2 * np.pi) * TURNS).astype(np.int64) % TURNS
            c, s = np.cos(_ANGLES[turn])[:, None], np.sin(_ANGLES[turn])[:, None]
            soft = _box(smooth, 2)

            def at(px, py, soft=soft, x=x, y=y, c=c, s=s, h=h, w=w):
                down = np.clip(y[:, None] + np.rint(s * px + c * py).astype(np.int64), 0, h - 1)
                return soft[down, np.clip(x[:, None] + np.rint(c * px - s * py).astype(np.int64), 0, w - 1)]

            bits = at(TESTS[:, 0], TESTS[:, 1]) < at(TESTS[:, 2], TESTS[:, 3])
            out.append((x << scale, y << scale, np.full(len(x), scale), turn, np.packbits(bits, axis=1)))
        now = now[: h // 2 * 2, : w // 2 * 2].reshape(h // 2, 2, w // 2, 2).mean(axis=(1, 3))
    return tuple(map(np.concatenate, zip(*out))) if out else (*np.zeros((4, 0), int), np.zeros((0, BITS // 8), np.uint8))


CORNER = pa.struct([*[(n, pa.int32()) for n in ("x", "y", "scale", "turn")], ("parts", pa.list_(pa.int64()))])
FEATURES = "image_id long, sha string, corners array<struct<x: int, y: int, scale: int, turn: int, parts: array<long>>>"


def features(images: DataFrame, per_scale: int = 32, scales: int = 3) -> DataFrame:
    """(image_id, sha, corners) of images (image_id, image: bytes of a PGM or PPM); those that can't be decoded have no corners."""

    def each(batches):
        for batch in batches:
            out, sizes = [], []
            for raw in batch.column(2).to_pylist():
                px = decode_pgm(raw)
                got = describe(px, per_scale, scales) if px is not None else None
                sizes.append(0 if got is None else len(got[0]))
                if sizes[-1]:
                    out.append(got)
            x, y, scale, turn, bits = map(np.concatenate, zip(*out)) if out else describe(np.zeros((1, 1)))
            parts = np.ascontiguousarray(bits).view(">i8").astype(np.int64).reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * (BITS // 64)), pa.array(parts))
            corners = pa.StructArray.from_arrays([*[pa.array(np.asarray(c, np.int32)) for c in (x, y, scale, turn)], lists], fields=list(CORNER))
            bounds = pa.array(np.cumsum([0, *sizes]).astype(np.int32))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.ListArray.from_arrays(bounds, corners)], ["image_id", "sha", "corners"])

    return images.select(F.col("image_id").cast("long").alias("image_id"), F.sha2("image", 256).alias("sha"), "image").mapInArrow(each, FEATURES)


def linked(matches: DataFrame, votes: int, grid: float) -> DataFrame:
    """(src, dst): images of which enough different corners agree on rotation, scale and shift.

    matches: (one, other), structs of image_id, x, y, scale and turn. A shift votes for the grid cell it
    lies in and, moved by half a cell, for another; so does a rotation.
    """
    spin = F.pmod(F.col("other.turn") - F.col("one.turn"), F.lit(TURNS))
    grow = F.col("other.scale") - F.col("one.scale")
    angle, by = spin * (2 * math.pi / TURNS), F.pow(F.lit(2.0), grow)
    x, y = F.col("one.x") * by, F.col("one.y") * by
    moved = matches.select(
        F.col("one.image_id").alias("src"), F.col("other.image_id").alias("dst"), F.col("one.x").alias("x"), F.col("one.y").alias("y"), spin.alias("spin"), grow.alias("grow"),
        (F.col("other.x") - (F.cos(angle) * x - F.sin(angle) * y)).alias("dx"), (F.col("other.y") - (F.sin(angle) * x + F.cos(angle) * y)).alias("dy"),
    )

    def cell(half: int, turn: int) -> Column:
        down, right = (F.floor(F.col(c) / grid + half / 2).cast("int") for c in ("dx", "dy"))
        return F.struct(F.lit(2 * half + turn).alias("way"), F.pmod(F.floor((F.col("spin") + turn) / 2).cast("int"), F.lit(TURNS // 2)).alias("bin"), down.alias("across"), right.alias("down"))

    place = ["src", "dst", "grow", "way", "bin", "across", "down"]
    cells = moved.select("src", "dst", "grow", "x", "y", F.inline(F.array(*[cell(h, t) for h in (0, 1) for t in (0, 1)])))
    return cells.distinct().groupBy(*place).count().where(F.col("count") >= votes).select("src", "dst").distinct()


def image_links(corners: DataFrame, votes: int = 5, grid: float = 12.0) -> DataFrame:
    """(node, component) of images that link; corners: (image_id, x, y, scale, turn, parts), one row for each corner."""
    corner = F.struct("image_id", "scale", "x", "y", "turn").alias("corner")
    entries = corners.select(corner, F.posexplode("parts").alias("part", "value"))
    ends = entries.groupBy("part", "value").agg(F.min("corner").alias("first"), F.max("corner").alias("last")).where("first.image_id != last.image_id")
    ends = written(ends)
    small = ends.count() <= SENT_RUNS
    runs = written(entries.join(F.broadcast(ends) if small else ends, ["part", "value"]))
    below = runs.where("corner.image_id != first.image_id").select(F.col("first").alias("one"), F.col("corner").alias("other"))
    above = runs.where("corner.image_id != last.image_id").select(F.col("corner").alias("one"), F.col("last").alias("other"))
    near = written(linked(below.union(above), votes, grid))
    grouped = connected_components(near)
    placed = runs.select("part", "value", "corner").join(grouped, F.col("corner.image_id") == F.col("node"), "left")
    placed = placed.select("part", "value", "corner", F.coalesce("component", "corner.image_id").alias("of")).distinct()
    mixed = placed.groupBy("part", "value").agg(F.min("of").alias("lo"), F.max("of").alias("hi")).where("lo != hi").select("part", "value")
    across = written(placed.join(mixed, ["part", "value"], "left_semi"))
    one = across.select("part", "value", F.col("corner").alias("one"), F.col("of").alias("lo"))
    other = across.select("part", "value", F.col("corner").alias("other"), F.col("of").alias("hi"))
    rest = linked(one.join(other, ["part", "value"]).where("lo < hi").select("one", "other"), votes, grid)
    return connected_components(near.union(rest))


def image_copies(images: DataFrame, votes: int = 5, grid: float = 12.0, per_scale: int = 32, scales: int = 3) -> DataFrame:
    """Groups images (image_id, image) that are cropped or edited copies of one another.

    Returns one row per row of images: image_id, n_corners, component_id (smallest id that links reach). Two
    images link if at least `votes` different corners agree on rotation, scale and shift, shifts within
    about `grid` pixels. Images of under 36 pixels have no corners; null or undecodable images have none
    either; such images are alone but for those of equal bytes. Rows with a null id get a null component;
    equal images are one group; very large images have no more corners than others; an empty table gives no
    rows; other columns, whatever their names, are ignored.
    """
    found = written(features(images, per_scale, scales))
    whole = written(found.where("image_id is not null and sha is not null").groupBy("sha").agg(F.min("image_id").alias("rep"), F.any_value("corners").alias("corners")))
    corners = whole.select(F.col("rep").alias("image_id"), F.inline("corners"))
    parts = image_links(corners, votes, grid)
    known = whole.select("sha", "rep").join(parts, F.col("rep") == F.col("node"), "left").select("sha", F.coalesce("component", "rep").alias("component_id"))
    out = found.select("image_id", "sha", F.size("corners").cast("long").alias("n_corners")).join(known, "sha", "left")
    component = F.when(F.col("image_id").isNotNull(), F.coalesce("component_id", "image_id"))
    return out.select("image_id", "n_corners", component.alias("component_id"))


def rendered(vectors: DataFrame, side: int = 96, crop: int = 76) -> DataFrame:
    """(image_id, image): a grey image of each embedding, and a cropped and edited copy for each 20th id.

    The 64 components are spread over a grid of 256 patches, image 2 * vec_id. Rows whose id is divisible by 20
    have a copy too, image 2 * vec_id + 1: a part of the image of `crop` pixels, moved by the id, with
    less contrast, more light and a little noise. Vectors that are null or hold other than 64 finite
    components have no image.
    """

    def each(batches):
        step = np.zeros((side, 16))
        step[np.arange(side), np.arange(side) * 16 // side] = 1
        spread = np.random.default_rng(5).normal(0, 1, (256, 64))
        for batch in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):
            ids, out = [], []
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(None if k is None else 2 * k)
                if v is None or len(v) != 64 or None in v or not np.isfinite(v).all():
                    out.append(None)
                    continue
                px = 128 + 40 * (step @ (spread @ np.array(v)).reshape(16, 16) @ step.T)
                out.append(encode_pgm(px))
                if k is not None and k % 20 == 0:
                    ids.append(2 * k + 1)
                    x, y = k // 20 * 7 % (side - crop + 1), k // 20 * 11 % (side - crop + 1)
                    noise = np.random.default_rng(abs(k)).normal(0, 2, (crop, crop))
                    out.append(encode_pgm(0.85 * px[y : y + crop, x : x + crop] + 25 + noise))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["image_id", "image"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(each, "image_id long, image binary")
