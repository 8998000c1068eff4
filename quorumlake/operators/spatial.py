"""Boxes, rings, grids: the relational part of the vector operators, and shapes without a geometry library.

Range joins become equi joins on covering grid cells; exact tests follow. This module is boxes, simple rings and grids; free
polygons are in ``layers``, searches in ``near``.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.operators.graph import connected_components
from quorumlake.operators.near import nearest_of
from quorumlake.plans.staging import Stage

BOX = ("x0", "y0", "x1", "y1")


def overlap_area(a: str, b: str) -> Column:
    """Area that boxes with columns ``{a}x0``... and ``{b}x0``... share; 0 if they only touch."""
    side = lambda lo, hi: F.greatest(F.least(F.col(a + hi), F.col(b + hi)) - F.greatest(F.col(a + lo), F.col(b + lo)), F.lit(0.0))
    return side("x0", "x1") * side("y0", "y1")


def box_join(left: DataFrame, right: DataFrame, cell: float, a: str = "a_", b: str = "b_") -> DataFrame:
    """Pairs of boxes that share area, with ``area``. Both sides go to the grid cells they cover; a pair is
    kept in one cell only, the one that holds the lower left corner of the shared box, so nothing is
    sorted out afterwards."""
    def cells(df: DataFrame, p: str) -> DataFrame:
        at = lambda c: F.floor(F.col(p + c) / cell)
        d = df.withColumn("_cx", F.explode(F.sequence(at("x0"), at("x1"))))
        return d.withColumn("_cy", F.explode(F.sequence(at("y0"), at("y1"))))

    pairs = cells(left, a).join(cells(right, b), ["_cx", "_cy"])
    corner = lambda c: F.floor(F.greatest(F.col(a + c), F.col(b + c)) / cell)
    pairs = pairs.where((F.col("_cx") == corner("x0")) & (F.col("_cy") == corner("y0"))).withColumn("area", overlap_area(a, b))
    return pairs.where("area > 0").drop("_cx", "_cy")


def apportion(overlaps: DataFrame, target: str, source: str, area: str, source_area: str, weight: str, tally: DataFrame, party: str = "party", n: str = "n") -> DataFrame:
    """``(target, party, votes)``: each source's weight goes to the targets by area and to its parties by seats."""
    share = F.col(weight) * F.col(area) / F.col(source_area)
    seats = tally.groupBy(source).agg(F.sum(n).alias("_seats"))
    t = tally.join(seats, source).select(source, party, (F.col(n) / F.col("_seats")).alias("_part"))
    return overlaps.select(target, source, share.alias("_w")).join(t, source).groupBy(target, party).agg(F.sum(F.col("_w") * F.col("_part")).alias("votes"))


def projected_winner(votes: DataFrame, target: str, parts: DataFrame, part: str, threshold: float = 0.97) -> DataFrame:
    """``(target, party, purity, single)``: the party with most apportioned votes, its share, and whether one
    source made up more than ``threshold`` of the target. ``parts`` has (target, part) per source."""
    w = Window.partitionBy(target)
    top = votes.withColumns({"_rn": F.row_number().over(w.orderBy(F.desc("votes"), "party")), "_all": F.sum("votes").over(w)}).where("_rn = 1")
    one = parts.groupBy(target).agg((F.max(part) / F.sum(part) > threshold).alias("single"), F.count("*").alias("sources"))
    return top.join(one, target).select(target, "party", F.try_divide("votes", "_all").alias("purity"), (F.col("single") | (F.col("sources") == 1)).alias("single"))


#: Anchors that are written into the expression; beyond, they are searched by a tree.
FEW_ANCHORS = 64


def nearest(points: DataFrame, anchors: DataFrame, id_col: str, label: str, dims: tuple[str, ...] = ("x", "y"), within: list[str] = (), few: int = FEW_ANCHORS) -> DataFrame:
    """Each point's nearest anchor (squared distance, then label) and ``d2``. With ``within`` only anchors of the same group compete;
    a point whose group has none, or without coordinates, is left out.

    A few anchors are compared in the row, without a join; others are searched down a tree of cells (``near.nearest_of``).
    """
    order = [F.col(label)]
    a = anchors.where(" and ".join(f"`{d}` is not null" for d in dims)).select(label, *within, *[F.col(d).cast("double").alias(f"_{d}") for d in dims])
    points = points.where(" and ".join(f"`{d}` is not null" for d in dims))
    if not within:
        rows = a.orderBy(*order).limit(few + 1).collect()  # bounded by ``few``
        if not rows:
            return points.limit(0).select(id_col).join(a.select(label).limit(0)).withColumn("d2", F.lit(0.0))
        if len(rows) <= few:
            kind = a.schema[label].dataType
            d2 = lambda r: sum(((F.col(d) - F.lit(r[f"_{d}"])) * (F.col(d) - F.lit(r[f"_{d}"])) for d in dims), F.lit(0.0))
            best = F.array_min(F.array(*[F.struct(d2(r).alias("d2"), F.lit(r[label]).cast(kind).alias("label")) for r in rows]))
            return points.select(id_col, best.alias("_b")).select(id_col, F.col("_b.label").alias(label), F.col("_b.d2").alias("d2"))
    if len(dims) != 2:
        raise ValueError("more anchors than a few are searched in two dimensions")
    things = a.select(label, *within, *[F.col(f"_{d}").alias(f"{c}{i}") for i in "01" for c, d in zip("xy", dims)])
    return nearest_of(points, things, id_col, label, within, *dims)


def nearest_by_array(points: DataFrame, anchors: list[list[float]], vector: str) -> Column:
    """Index of the nearest of a few anchors for an array column, without a join."""
    d = [F.aggregate(F.zip_with(vector, F.array(*map(F.lit, a)), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x) for a in anchors]
    return F.array_min(F.array(*[F.struct(x.alias("d2"), F.lit(i).alias("i")) for i, x in enumerate(d)]))["i"]


def kmeans(points: DataFrame, k: int, id_col: str, dims: tuple[str, ...] = ("x", "y"), rounds: int = 30) -> DataFrame:
    """Lloyd's rounds from the k points with the smallest hashes (MD5 of the id); seeds numbered north to south, west to east."""
    seeds = points.orderBy(F.md5(F.col(id_col).cast("string")), id_col).limit(k).select(*dims).collect()  # k rows
    centres = [[float(s[d]) for d in dims] for s in seeds]
    p = points.withColumn("_v", F.array(*[F.col(d).cast("double") for d in dims]))
    for _ in range(rounds):
        mean = p.groupBy(nearest_by_array(p, centres, "_v").alias("c")).agg(*[F.avg(d).alias(d) for d in dims]).collect()  # k rows
        moved = {r.c: [r[d] for d in dims] for r in mean}
        new = [moved.get(i, c) for i, c in enumerate(centres)]
        if np.allclose(new, centres, atol=1e-9):
            break
        centres = new
    centres.sort(key=lambda c: (-c[-1], *c[:-1]))
    return p.withColumn("seed", nearest_by_array(p, centres, "_v")).drop("_v")


def ring_area(ring: Column) -> Column:
    """Signed area of ``array<struct<x,y>>`` (closed or not): positive if counter-clockwise."""
    turned = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.aggregate(F.zip_with(ring, turned, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]), F.lit(0.0), lambda s, x: s + x) / 2


def clockwise(ring: Column) -> Column:
    return F.when(ring_area(ring) > 0, F.reverse(ring)).otherwise(ring)


def ring_box(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def centroid(ring: Column) -> Column:
    """Centre of mass of a ring."""
    turned = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    cross = F.zip_with(ring, turned, lambda p, q: F.struct((p["x"] * q["y"] - q["x"] * p["y"]).alias("c"), (p["x"] + q["x"]).alias("x"), (p["y"] + q["y"]).alias("y")))
    total = lambda f: F.aggregate(cross, F.lit(0.0), lambda s, x: s + f(x))
    a = total(lambda x: x["c"])
    return F.struct((total(lambda x: x["c"] * x["x"]) / (3 * a)).alias("x"), (total(lambda x: x["c"] * x["y"]) / (3 * a)).alias("y"))


def inside(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point lies in a ring: an odd number of edges cross the ray to its right."""
    turned = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))

    def crosses(p, q):
        level = (p["y"] > y) != (q["y"] > y)
        return F.when(level, F.when(x < (q["x"] - p["x"]) * (y - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) + p["x"], 1).otherwise(0)).otherwise(0)

    return F.aggregate(F.zip_with(ring, turned, crosses), F.lit(0), lambda s, x: s + x) % 2 == 1


def clip_convex(ring: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Sutherland-Hodgman: the part of a ring inside a convex counter-clockwise window."""
    out = ring
    for a, b in zip(window, np.roll(window, -1, 0)):
        if not len(out):
            break
        side = (b[0] - a[0]) * (out[:, 1] - a[1]) - (b[1] - a[1]) * (out[:, 0] - a[0])
        kept = []
        for i in range(len(out)):
            p, q, sp, sq = out[i - 1], out[i], side[i - 1], side[i]
            if (sp >= 0) != (sq >= 0):
                kept.append(p + (q - p) * (sp / (sp - sq)))
            if sq >= 0:
                kept.append(q)
        out = np.array(kept).reshape(-1, 2)
    return out


def clip_area(df: DataFrame, ring: str, window: str, name: str = "area") -> DataFrame:
    """Adds the area that a ring shares with a convex window, both ``array<struct<x,y>>``; by Arrow batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r, w in zip(b.column(b.schema.get_field_index(ring)).to_pylist(), b.column(b.schema.get_field_index(window)).to_pylist()):
                if not r or not w:
                    out.append(None)
                    continue
                r, w = (np.array([[p["x"], p["y"]] for p in s], float) for s in (r, w))
                x, y = w.T
                w = w[::-1] if (x * np.roll(y, -1) - np.roll(x, -1) * y).sum() < 0 else w
                x, y = clip_convex(r, w).T
                out.append(float(abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], [*b.schema.names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{schema}, {name} double")


def grid(df: DataFrame, keys: list[str], step: float) -> DataFrame:
    """Cells ``(keys, ix, iy, x, y)`` of boxes with columns x0 y0 x1 y1: centres every ``step``."""
    n = lambda lo, hi: F.greatest(F.round((F.col(hi) - F.col(lo)) / step).cast("int"), F.lit(1)) - 1
    d = df.select(*keys, "x0", "y0", F.explode(F.sequence(F.lit(0), n("x0", "x1"))).alias("ix"), n("y0", "y1").alias("_ny"))
    d = d.select(*keys, "x0", "y0", "ix", F.explode(F.sequence(F.lit(0), F.col("_ny"))).alias("iy"))
    return d.select(*keys, "ix", "iy", (F.col("x0") + (F.col("ix") + 0.5) * step).alias("x"), (F.col("y0") + (F.col("iy") + 0.5) * step).alias("y"))


def capacity_allocate(cells: DataFrame, seeds: DataFrame, quota: str = "quota", rounds: int = 300, strict: bool = False) -> DataFrame:
    """``cells`` (cell_id, x, y) with ``label``: the seed of the least distance less an additive weight. Each round moves a seed's
    weight by how far its count is from its target, in spreads of all distances, until all are within max(2, 0.4 % of the cells).

    Targets are the quotas' shares of the cells, rounded, the last one what is left. Seeds (label, x, y, quota) are few and keep the
    order of their labels, in which ties go; the driver holds their weights and counts. If ``rounds`` do not do, the last
    round's labels are returned with a warning, or ``strict`` fails.
    """
    s = sorted(((r.label, r.x, r.y, float(r[quota])) for r in seeds.collect()), key=lambda r: r[0])  # a row a seed
    base = Stage(cells.sparkSession, "capacity").put(cells, "cells")
    far = [F.hypot(F.col("x") - F.lit(x), F.col("y") - F.lit(y)) for _, x, y, _ in s]
    n, *moments = base.agg(F.count("*"), *[F.sum(d) for d in far], *[F.sum(d * d) for d in far]).first()
    if not n or not s:
        return base.withColumn("label", F.lit(None).cast(seeds.schema["label"].dataType))
    mean = sum(moments[: len(s)]) / (n * len(s))
    spread = max(0.0, sum(moments[len(s) :]) / (n * len(s)) - mean * mean) ** 0.5
    target = [round(q / sum(r[3] for r in s) * n) for *_, q in s]
    target[-1] = n - sum(target[:-1])
    weight = [0.0] * len(s)

    def number() -> Column:
        return F.array_min(F.array(*[F.struct((d - F.lit(w)).alias("d"), F.lit(i).alias("i")) for i, (d, w) in enumerate(zip(far, weight))]))["i"]

    met = False
    for i in range(rounds):
        got = {r.i: r.n for r in base.groupBy(number().alias("i")).agg(F.count("*").alias("n")).collect()}
        error = [got.get(i, 0) - t for i, t in enumerate(target)]
        met = max(map(abs, error)) <= max(2, int(0.004 * n))
        if met or i == rounds - 1:
            break
        weight = [w - e / n * spread * 1.5 for w, e in zip(weight, error)]
    if not met:
        if strict:
            raise RuntimeError(f"capacities were not met in {rounds} rounds")
        warnings.warn(f"capacities were not met in {rounds} rounds", stacklevel=2)
    labels = F.array(*[F.lit(r[0]).cast(seeds.schema["label"].dataType) for r in s])
    return base.withColumn("label", F.get(labels, number()))


def _parts(cells: DataFrame, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """Neighbouring cell pairs (a, b, la, lb), and each cell's connected part of its label (node, label, component)."""
    key = F.struct("ix", "iy")
    steps = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((1, 0), (-1, 0), (0, 1), (0, -1))]))
    near = cells.select(key.alias("a"), F.col("label").alias("la"), steps.alias("s"), "ix", "iy")
    near = near.select("a", "la", (F.col("ix") + F.col("s.dx")).alias("ix"), (F.col("iy") + F.col("s.dy")).alias("iy"))
    near = stage.put(near.join(cells.select("ix", "iy", F.col("label").alias("lb")), ["ix", "iy"]).select("a", F.struct("ix", "iy").alias("b"), "la", "lb"), "near")
    found = connected_components(near.where("la <=> lb"), "a", "b")
    part = cells.select(key.alias("node"), "label").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return near, stage.put(part, "part")


def _move(cells: DataFrame, choose, rounds: int) -> DataFrame:
    """Rounds in which the parts that ``choose(part)`` names go, all at once, to the label they touch most."""
    stage = Stage(cells.sparkSession, "parts")
    cur = stage.put(cells.select("ix", "iy", "label"), "cells")
    for _ in range(rounds):
        near, part = _parts(cur, stage)
        touch = near.where("lb is not null and not la <=> lb").join(part.select(F.col("node").alias("a"), "component"), "a").join(choose(part), "component")
        touch = touch.groupBy("component", "lb").agg(F.count("*").alias("n"))
        move = touch.groupBy("component").agg(F.max(F.struct("n", F.col("lb").alias("to"))).alias("_m")).select("component", F.col("_m.to").alias("to"))
        move = stage.put(move, "move")
        if move.isEmpty():
            break
        cur = stage.put(part.join(move, "component", "left").select("node.ix", "node.iy", F.coalesce("to", "label").alias("label")), "cells")
    return cur


def contiguity_repair(cells: DataFrame, most_share: float = 0.15, rounds: int = 6) -> DataFrame:
    """``cells`` (ix, iy, label): the parts of a label beside its largest one, if they hold at most ``most_share``
    of its cells, move to the label they touch most."""
    def choose(part: DataFrame) -> DataFrame:
        w = Window.partitionBy("label")
        size = part.groupBy("label", "component").agg(F.count("*").alias("n"))
        size = size.withColumns({"_rn": F.row_number().over(w.orderBy(F.desc("n"), "component")), "_all": F.sum("n").over(w)})
        return size.where((F.col("_rn") > 1) & (F.col("n") <= most_share * F.col("_all"))).select("component")

    return _move(cells, choose, rounds)


def absorb_slivers(cells: DataFrame, least_cells: int, rounds: int = 6) -> DataFrame:
    """Parts of under ``least_cells`` cells go to the neighbour with the longest common border."""
    return _move(cells, lambda part: part.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") < least_cells).select("component"), rounds)


def fill_holes(cells: DataFrame, rounds: int = 4) -> DataFrame:
    """Unlabelled parts that do not reach the grid's edge go to the neighbour with the longest common border."""
    edge = cells.agg(F.min("ix").alias("x0"), F.max("ix").alias("x1"), F.min("iy").alias("y0"), F.max("iy").alias("y1"))

    def choose(part: DataFrame) -> DataFrame:
        p = part.where("label is null").crossJoin(F.broadcast(edge))  # one row
        at = (F.col("node.ix") == F.col("x0")) | (F.col("node.ix") == F.col("x1")) | (F.col("node.iy") == F.col("y0")) | (F.col("node.iy") == F.col("y1"))
        return p.groupBy("component").agg(F.max(at).alias("_edge")).where("not _edge").select("component")

    return _move(cells, choose, rounds)


def detached_lobes(cells: DataFrame, receivers: DataFrame) -> DataFrame:
    """All parts of a label but its largest go to the label that ``receivers`` (label, receiver) names for it."""
    stage = Stage(cells.sparkSession, "lobes")
    _, part = _parts(stage.put(cells.select("ix", "iy", "label"), "cells"), stage)
    size = part.groupBy("label", "component").agg(F.count("*").alias("n"))
    rn = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "component"))
    lobe = size.withColumn("_rn", rn).where("_rn > 1").join(receivers, "label").select("component", "receiver")
    return part.join(lobe, "component", "left").select("node.ix", "node.iy", F.coalesce("receiver", "label").alias("label"))


def partition_mismatch(a: DataFrame, b: DataFrame) -> DataFrame:
    """Of two labelled grids: cells of either, of both, and with different labels."""
    j = a.select("ix", "iy", F.col("label").alias("la")).join(b.select("ix", "iy", F.col("label").alias("lb")), ["ix", "iy"], "full_outer")
    return j.agg(F.count("*").alias("cells"), F.count_if(F.col("la").isNotNull() & F.col("lb").isNotNull()).alias("shared"), F.count_if(~F.col("la").eqNullSafe(F.col("lb"))).alias("different"))


def same_in_all(shapes: DataFrame, key: str, period: str, shape: str, n_periods: int) -> DataFrame:
    """One row ``*`` for shapes that are equal in all periods, else one a period."""
    c = shapes.groupBy(key).agg(F.countDistinct(shape).alias("_d"), F.count("*").alias("_n"), F.min(shape).alias("_s"))
    one = (F.col("_d") == 1) & (F.col("_n") == n_periods)
    single = c.where(one).select(key, F.lit("*").alias(period), F.col("_s").alias(shape))
    return single.unionByName(shapes.join(c.where(~one).select(key), key).select(key, F.col(period).cast("string").alias(period), shape))


def shared_borders(cells: DataFrame) -> DataFrame:
    """``(a, b, length)``: neighbouring cell pairs of two labels, the grid's measure of a common border."""
    right = cells.select((F.col("ix") + 1).alias("ix"), "iy", F.col("label").alias("a"))
    up = cells.select("ix", (F.col("iy") + 1).alias("iy"), F.col("label").alias("a"))
    both = right.unionByName(up).join(cells.select("ix", "iy", F.col("label").alias("b")), ["ix", "iy"]).where("a <> b")
    return both.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("length"))


def urban_or_small(boxes: list[tuple[float, float, float, float]], least: float) -> Column:
    """Whether a row's box (x0, y0, x1, y1) meets one of ``boxes`` or its ``area`` is under ``least``."""
    c, hit = F.col, F.lit(False)
    for x0, y0, x1, y1 in boxes:
        hit = hit | ((c("x0") < x1) & (c("x1") > x0) & (c("y0") < y1) & (c("y1") > y0))
    return hit | (c("area") < least)
