"""Nearest points and borders, containment, and pairs within reach, over tables of any distribution.

The nearest of many things is found down a tree of cells, each split in sixteen while it holds more than ``LEAF`` of them: cells follow
the things' counts, so towns and lone places cost alike. A level is one join: points, those of a small cell together, keep the cells whose nearest
corner is no farther than the least of all their farthest corners. Only the few cells that are left at the end meet their things.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.plans.joins import join_dim, small
from quorumlake.plans.staging import Scope, Stage

#: Things of a cell that is not split, and levels at most: things that fill less than 4^-12 of the map share a cell.
LEAF, DEEPEST = 32, 12
#: Items that the points of a small cell get as an array.
HELD = 512
#: Items that lie flat in the row of a small cell, so that its points are settled by compiled arithmetic, not by a function of an array.
FLAT = 8
#: Rows, and bytes of their values, of the small cells' table that may be sent to every executor: the points, very many more, then stay where they are.
SENT_ROWS, SENT_BYTES = 1_000_000, 128 << 20


def segment_d2(x: Column, y: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Squared distance of a point to a segment; one of no length is a point."""
    ux, uy = x1 - x0, y1 - y0
    along = F.coalesce(F.try_divide((x - x0) * ux + (y - y0) * uy, ux * ux + uy * uy), F.lit(0.0))
    along = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    dx, dy = x - (x0 + along * ux), y - (y0 + along * uy)
    return dx * dx + dy * dy


def _cells(items: DataFrame, within: list[str], stage: Stage) -> tuple[DataFrame, DataFrame, int, Callable[[str, Column], Column], bool] | None:
    """Nodes (within, level, cx, cy, box, inner) and items with their leaf (within, level, cx, cy); the deepest level; the cell of a coordinate one
    level below it; whether all items are points."""
    mid = {"_mx": (F.col("x0") + F.col("x1")) / 2, "_my": (F.col("y0") + F.col("y1")) / 2}
    long = F.max((F.col("x0") != F.col("x1")) | (F.col("y0") != F.col("y1"))).alias("long")
    s = items.withColumns(mid).agg(F.count("*").alias("n"), long, F.min("_mx").alias("x"), F.min("_my").alias("y"), F.greatest(F.max("_mx") - F.min("_mx"), F.max("_my") - F.min("_my")).alias("side")).first()
    if not s.n:
        return None
    depth = min(DEEPEST, max(1, math.ceil(math.log(max(1, s.n / LEAF), 16)) + 2))
    at = lambda c, lo, k: F.least(F.floor((F.col(c) - lo) / (s.side or 1.0) * F.pow(F.lit(4.0), k)), F.pow(F.lit(4.0), k).cast("long") - 1)
    d = items.withColumns(mid).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    d = d.withColumns({"cx": at("_mx", s.x, F.col("level")), "cy": at("_my", s.y, F.col("level"))}).drop("_mx", "_my")
    key = [*within, "level", "cx", "cy"]
    box = [F.min(F.least("x0", "x1")).alias("bx0"), F.min(F.least("y0", "y1")).alias("by0"), F.max(F.greatest("x0", "x1")).alias("bx1"), F.max(F.greatest("y0", "y1")).alias("by1")]
    nodes = d.groupBy(*key).agg(F.count("*").alias("n"), *box).withColumn("inner", (F.col("n") > LEAF) & (F.col("level") < depth)).drop("n")
    nodes = stage.put(nodes, "nodes")
    up = nodes.where("inner").select(*within, (F.col("level") + 1).alias("level"), F.col("cx").alias("ux"), F.col("cy").alias("uy"))
    ends = nodes.where("not inner").withColumns({"ux": F.floor(F.col("cx") / 4), "uy": F.floor(F.col("cy") / 4)})
    leaves = ends.where("level = 0").select(*key).unionByName(ends.join(up, [*within, "level", "ux", "uy"]).select(*key))
    cell = lambda axis, c: F.floor((c - (s.x if axis == "x" else s.y)) / (s.side or 1.0) * 4.0 ** (depth + 1))
    return nodes, stage.put(d.join(leaves, key), "items"), depth, cell, not s.long


def _undominated(met: DataFrame, block: list[str]) -> DataFrame:
    """Rows of ``met`` (block, its box px0 to py1, point items) without items that another one beats in the whole box. Of two points one is nearer on each side of a line, so
    an item that is farther at all four corners is farther everywhere; it is held against those nearest to the corners and to the middle."""
    at = lambda x, y: (x - F.col("x0")) * (x - F.col("x0")) + (y - F.col("y0")) * (y - F.col("y0"))
    px, py = [F.col("px0"), F.col("px1")], [F.col("py0"), F.col("py1")]
    corners = [f"_c{i}" for i in range(4)]
    d = met.withColumns({c: at(px[i // 2], py[i % 2]) for i, c in enumerate(corners)} | {"_cm": at((px[0] + px[1]) / 2, (py[0] + py[1]) / 2)})
    w = Window.partitionBy(*block)
    d = d.withColumns({f"_by{c}": F.min_by(F.struct(*corners), F.col(c)).over(w) for c in [*corners, "_cm"]})
    slack = F.greatest(*corners) * 1e-12  # distances in the box are no larger, and are rounded by less
    beaten = F.lit(False)
    for by in [*corners, "_cm"]:
        less = F.lit(True)
        for c in corners:
            less = less & (F.col(f"_by{by}")[c] + slack < F.col(c))
        beaten = beaten | less
    return d.where(~beaten).select(*met.columns)


def nearest_of(points: DataFrame, items: DataFrame, id_col: str, label: str, within: list[str] = (), x: str = "x", y: str = "y") -> DataFrame:
    """``(id, label, d2)``: each point's nearest item, a segment (x0, y0, x1, y1) or a point (both ends equal), by squared distance, then label. With
    ``within`` only items of the same group compete. Points without coordinates, or whose group has no item, are left out; points that repeat an
    id are rows of their own."""
    p = Stage(points.sparkSession, "near").put(points.select(F.col(id_col).alias("_id"), *within, F.col(x).alias("_x"), F.col(y).alias("_y")), "points")
    found = with_nearest(p, items, label, within, "_x", "_y", "_label")
    return found.where("_d2 is not null").select(F.col("_id").alias(id_col), F.col("_label").alias(label), F.col("_d2").alias("d2"))


def with_nearest(points: DataFrame, items: DataFrame, label: str, within: list[str] = (), x: str = "x", y: str = "y", to: str = "nearest", how: str = "left") -> DataFrame:
    """``points``, each row once, with ``to``, the nearest item's label as in ``nearest_of``, and ``_d2``; both null where there is none. With ``how``
    inner those points are left out; a filter on the result would be pushed below the distances, which would be computed over again for it.

    Points of a small cell go down the tree together, by their box: of the few cells left at the end those items are kept that may be nearest to a place
    in the box. These go to the points in one row, up to ``FLAT`` of them as columns of their own if all items are points, more as an array, so a point is shuffled once
    at most and no pair of point and item is ever a row. Cells with over ``HELD`` such items (places around a ring of them) give pairs instead."""
    within = list(within)
    with Scope(points.sparkSession) as made:
        stage = Stage(points.sparkSession, "near")
        ends = ["x0", "y0", "x1", "y1"]
        items = items.where(" and ".join(f"{c} is not null" for c in ends)).select(*within, label, *[F.col(c).cast("double").alias(c) for c in ends])
        items = stage.put(items.groupBy(*within, *ends).agg(F.min(label).alias(label)), "things")
        tree = _cells(items, within, stage)
        if tree is None:
            points = points if how == "left" else points.limit(0)
            return points.withColumns({to: F.lit(None).cast(items.schema[label].dataType), "_d2": F.lit(None).cast("double")})
        nodes, held, depth, cell, dots = tree
        px, py = F.col(x).cast("double"), F.col(y).cast("double")
        p = points.withColumns({"_bx": cell("x", px), "_by": cell("y", py)})
        block = [*within, "_bx", "_by"]
        boxes = p.where("_bx is not null and _by is not null").groupBy(*block).agg(*[f(c).alias(n) for c, v in ((px, "x"), (py, "y")) for f, n in ((F.min, f"p{v}0"), (F.max, f"p{v}1"))])
        boxes = stage.put(boxes, "blocks")
        of = [*block, "px0", "py0", "px1", "py1"]
        gap = lambda c, lo, hi: F.greatest(F.col(lo) - F.col(f"p{c}1"), F.col(f"p{c}0") - F.col(hi), F.lit(0.0))
        far = lambda c, lo, hi: F.greatest(F.abs(F.col(f"p{c}0") - F.col(lo)), F.abs(F.col(f"p{c}0") - F.col(hi)), F.abs(F.col(f"p{c}1") - F.col(lo)), F.abs(F.col(f"p{c}1") - F.col(hi)))
        d2 = lambda f: f("x", "bx0", "bx1") * f("x", "bx0", "bx1") + f("y", "by0", "by1") * f("y", "by0", "by1")
        close = lambda d: d.withColumns({"low": d2(gap), "reach": F.min(d2(far)).over(Window.partitionBy(*block))}).where(F.col("low") <= F.col("reach") * (1 + 1e-12))
        node = ["level", "cx", "cy"]
        root = nodes.where("level = 0").select(*within, F.lit(0).alias("level"), "cx", "cy", "inner")
        front = join_dim(boxes, root, within, "inner") if within else boxes.crossJoin(F.broadcast(root))  # one row
        front = stage.put(front.select(*of, *node, "inner"), "front")
        for k in range(depth):
            inner = front.where("inner")
            if inner.isEmpty():
                break
            kids = nodes.where(F.col("level") == k + 1).withColumns({"ux": F.floor(F.col("cx") / 4), "uy": F.floor(F.col("cy") / 4)})
            down = inner.select(*of, F.col("cx").alias("ux"), F.col("cy").alias("uy"))
            down = join_dim(down, kids, [*within, "ux", "uy"], "inner")
            done = join_dim(front.where("not inner").drop("inner"), nodes, [*within, *node], "inner")
            cols = [*of, *node, "inner", "bx0", "by0", "bx1", "by1"]
            front = stage.put(close(down.select(*cols).unionByName(done.select(*cols))).select(*of, *node, "inner"), "front")
            stage.drop("front", keep_last=True)
        box = {f"b{c}{i}": f(f"{c}0", f"{c}1") for c in "xy" for i, f in ((0, F.least), (1, F.greatest))}
        met = close(front.join(held, [*within, *node]).withColumns(box))
        if dots:
            met = _undominated(met, block)
        met = met.select(*block, F.struct(*(ends[:2] if dots else ends), F.col(label).alias("label")).alias("_i"), F.count("*").over(Window.partitionBy(*block)).alias("_n"))
        met = stage.put(met, "met")
        wide = stage.put(met.where(F.col("_n") > HELD).select(*block).distinct(), "wide")
        crowded = not wide.isEmpty()
        few = met.where(F.col("_n") <= HELD).groupBy(*block).agg(F.collect_list("_i").alias("_near"))
        flat = range(FLAT if dots else 0)
        if dots:
            parts = [F.get("_near", F.lit(i))[c].alias(f"_{c}{i}") for i in flat for c in ("x0", "y0", "label")]
            few = few.select(*block, F.when(F.size("_near") > FLAT, F.col("_near")).alias("_near"), *parts)
        few = stage.put(few, "few")
        made.keep(few, met, wide)
        arrays = not few.where("_near is not null").isEmpty()
        if not arrays:
            few = few.drop("_near")
    dot = lambda u, v, x0, y0: (u - x0) * (u - x0) + (v - y0) * (v - y0)
    to_item = lambda u, v, i: dot(u, v, i["x0"], i["y0"]) if dots else segment_d2(u, v, i["x0"], i["y0"], i["x1"], i["y1"])
    best = lambda u, v, i: F.struct(to_item(u, v, i).alias("d2"), i["label"].isNull().alias("none"), i["label"].alias("label"))
    narrow = p.join(F.broadcast(wide) if small(wide) else wide, block, "left_anti") if crowded else p
    narrow = narrow.join(F.broadcast(few) if small(few, SENT_ROWS, SENT_BYTES) else few.hint("shuffle_hash"), block, how)
    d2, least = None, None
    if dots:
        # the least distance first, then the least label at it: both compile, which a minimum over an array does not
        narrow = narrow.withColumns({f"_d{i}": dot(px, py, F.col(f"_x0{i}"), F.col(f"_y0{i}")) for i in flat})
        narrow = narrow.withColumn("_least", F.least(*[f"_d{i}" for i in flat]))
        d2, least = F.col("_least"), F.least(*[F.when(F.col(f"_d{i}") == F.col("_least"), F.col(f"_label{i}")) for i in flat])
    if arrays:
        narrow = narrow.withColumn("_b", F.array_min(F.transform("_near", lambda i: best(px, py, i))))
        d2, least = (F.when(F.col("_near").isNotNull(), F.col(f"_b.{c}")).otherwise(v) if dots else F.col(f"_b.{c}") for c, v in (("d2", d2), ("label", least)))
    out = narrow.select(*points.columns, least.alias(to), d2.alias("_d2"))
    if crowded:
        with Scope(points.sparkSession) as made:
            rows = Stage(points.sparkSession, "near").put(p.join(wide, block, "left_semi").withColumn("_pid", F.monotonically_increasing_id()), "rows")
            made.keep(rows)
        pairs = rows.select("_pid", *block, F.col(x).cast("double").alias("_px"), F.col(y).cast("double").alias("_py")).join(met, block)
        got = pairs.groupBy("_pid").agg(F.min(best(F.col("_px"), F.col("_py"), F.col("_i"))).alias("_b"))
        out = out.unionByName(rows.join(got, "_pid").select(*points.columns, F.col("_b.label").alias(to), F.col("_b.d2").alias("_d2")))
    return out


def containing(points: DataFrame, edges: DataFrame, id_col: str, key: str, x: str = "x", y: str = "y") -> DataFrame:
    """``(id, key)``: the shapes (directed edges, see ``layers``) that hold each point. Below as many edges that run back as forth a point is outside; a
    border belongs to the shape above or right of it, so of a partition one shape holds a point. Points meet shapes whose boxes hold them, by
    grid cells, then the edges of these above or below it, by strips."""
    from quorumlake.operators.layers import _in_strips, boxes

    stage = Stage(points.sparkSession, "containing")
    b = stage.put(boxes(edges, [key], "b_"), "boxes")
    mean = b.agg(F.avg(F.greatest(F.col("b_x1") - F.col("b_x0"), F.col("b_y1") - F.col("b_y0"))).alias("d")).first().d
    if mean is None:
        return points.select(id_col).limit(0).join(edges.select(key).limit(0))
    side = max(1.0, mean)
    width = max(1.0, 4.0 * edges.agg(F.avg(F.abs(F.col("x1") - F.col("x0")))).first()[0])
    at = lambda c: F.floor(F.col(c) / side)
    cells = b.withColumn("_cx", F.explode(F.sequence(at("b_x0"), at("b_x1")))).withColumn("_cy", F.explode(F.sequence(at("b_y0"), at("b_y1"))))
    p = points.where(f"`{x}` is not null and `{y}` is not null").select(F.monotonically_increasing_id().alias("_pid"), F.col(id_col).alias("_id"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    p = stage.put(p, "points")
    met = p.withColumns({"_cx": at("_x"), "_cy": at("_y")}).join(cells, ["_cx", "_cy"]).where("_x between b_x0 and b_x1 and _y between b_y0 and b_y1")
    met = met.select("_pid", "_id", "_x", "_y", key, F.floor(F.col("_x") / width).alias("strip"))
    e = _in_strips(edges, key, width, "e")
    height = F.col("eyu") + (F.col("eyv") - F.col("eyu")) * (F.col("_x") - F.col("eu")) / (F.col("ev") - F.col("eu"))
    above = met.join(e, [key, "strip"]).where((F.col("_x") >= F.col("eu")) & (F.col("_x") < F.col("ev")) & (F.col("_y") < height))
    return above.groupBy("_pid", "_id", key).agg(F.sum("es").alias("_w")).where("_w > 0").select(F.col("_id").alias(id_col), key)


def placed(points: DataFrame, edges: DataFrame, id_col: str, key: str, x: str = "x", y: str = "y") -> DataFrame:
    """``(id, key, d2)``: the shape that holds a point (the smallest of several; d2 is 0), else the one with the nearest border. Ids are unique. Of equal
    shapes only the smallest, which is the answer, is asked."""
    from quorumlake.operators.layers import equal_shapes, of_first

    stage = Stage(points.sparkSession, "placed")
    edges = stage.put(edges.where(F.col(key).isNotNull()).select(key, "x0", "y0", "x1", "y1"), "given")
    edges = stage.put(of_first(edges, equal_shapes(edges, key), key), "edges")
    inside = containing(points, edges, id_col, key, x, y).groupBy(id_col).agg(F.min(key).alias(key)).withColumn("d2", F.lit(0.0))
    inside = Stage(points.sparkSession, "placed").put(inside, "inside")
    rest = points.join(inside.select(id_col), id_col, "left_anti")
    return inside.unionByName(nearest_of(rest, edges, id_col, key, (), x, y).select(id_col, key, "d2"))


def within_reach(a: DataFrame, b: DataFrame, a_key: str, b_key: str, reach: float) -> DataFrame:
    """``(a, b)``: pairs of shapes of two layers that overlap, touch, or come within ``reach``. Edges, cut to pieces of a cell's length, meet in the cells
    around them."""
    from quorumlake.operators.layers import common_areas

    size = lambda d: d.select(F.avg(F.greatest(F.abs(F.col("x1") - F.col("x0")), F.abs(F.col("y1") - F.col("y0")))).alias("d"))
    mean = max([size(d).first().d or 0.0 for d in (a, b)])
    side = max(4.0 * reach, mean, 1.0)

    def pieces(d: DataFrame, key: str, p: str, far: float) -> DataFrame:
        ends = {c: F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")}
        n = F.greatest(F.ceil(F.greatest(F.abs(ends["x1"] - ends["x0"]), F.abs(ends["y1"] - ends["y0"])) / side), F.lit(1))
        d = d.select(key, *[v.alias(p + c) for c, v in ends.items()], n.alias("_n")).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
        for c in "xy":
            lo = F.col(f"{p}{c}0") + (F.col(f"{p}{c}1") - F.col(f"{p}{c}0")) * F.col("_i") / F.col("_n")
            hi = F.col(f"{p}{c}0") + (F.col(f"{p}{c}1") - F.col(f"{p}{c}0")) * (F.col("_i") + 1) / F.col("_n")
            d = d.withColumn(f"_c{c}", F.explode(F.sequence(F.floor((F.least(lo, hi) - far) / side), F.floor((F.greatest(lo, hi) + far) / side))))
        return d.drop("_n", "_i").distinct()

    met = pieces(a, a_key, "a_", reach).join(pieces(b, b_key, "b_", 1e-9), ["_cx", "_cy"])
    pt = lambda s, i: (F.col(f"{s}_x{i}"), F.col(f"{s}_y{i}"))
    d2 = F.least(*[segment_d2(*pt(s, i), *pt(o, 0), *pt(o, 1)) for s, o in ("ab", "ba") for i in (0, 1)])
    turn = lambda o, p, q: (p[0] - o[0]) * (q[1] - o[1]) - (p[1] - o[1]) * (q[0] - o[0])
    apart = lambda s, o: turn(pt(s, 0), pt(s, 1), pt(o, 0)) * turn(pt(s, 0), pt(s, 1), pt(o, 1)) < 0
    near = met.where((apart("a", "b") & apart("b", "a")) | (d2 <= reach * reach)).select(a_key, b_key)
    return near.unionByName(common_areas(a, b, a_key, b_key).select(a_key, b_key)).distinct()
