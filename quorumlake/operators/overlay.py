"""Overlays of shapes that may lie over one another: the map they make together, as pieces of border with the shapes on either side.

``arrangement`` cuts all edges where they cross, touch or run along one another; a piece then knows the set of shapes that cover its left and its right. Every
overlay is a rule on those sets: what two share, what one lacks, who keeps what, what an outline cuts off. Crossings are found in grid
cells with exact integer signs; their places are rounded to 1/1024 quantum, so that edges that meet in a point agree on it.
The sets hold the shapes over one place, which is the only thing that a row gathers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.operators import layers as M
from quorumlake.operators.near import containing
from quorumlake.plans.joins import join_dim, spread
from quorumlake.plans.staging import Scope, Stage

FINE = 1024.0


def _crossings(edges: DataFrame) -> DataFrame:
    """``(e, x, y)``: places at which edge ``e`` meets another that is neither on its line nor joined to its ends."""
    long_ = F.greatest(F.abs(F.col("x1") - F.col("x0")), F.abs(F.col("y1") - F.col("y0")))
    side = max(1.0, 2.0 * (edges.agg(F.avg(long_)).first()[0] or 0.0))
    n = F.greatest(F.ceil(long_ / side), F.lit(1)).cast("long")
    d = edges.withColumn("_n", n).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    for c in "xy":
        at = lambda i: F.col(f"{c}0") + (F.col(f"{c}1") - F.col(f"{c}0")) * i / F.col("_n")  # noqa: B023,E731
        lo, hi = at(F.col("_i")), at(F.col("_i") + 1)
        d = d.withColumn(f"_c{c}", F.explode(F.sequence(F.floor((F.least(lo, hi) - 1e-6) / side), F.floor((F.greatest(lo, hi) + 1e-6) / side))))
    ends = ["x0", "y0", "x1", "y1"]
    d = d.select("e", *ends, *M.LINE, "_cx", "_cy").distinct()
    e, f = (d.select("_cx", "_cy", *[F.col(c).alias(p + c) for c in ("e", *ends, *M.LINE)]) for p in "ef")
    same = (F.col("esteep") == F.col("fsteep")) & (F.col("eslope") == F.col("fslope"))  # parallel: on one line or apart
    point = lambda p, i: (F.col(f"{p}x{i}"), F.col(f"{p}y{i}"))
    turn = lambda o, p, q: (p[0] - o[0]) * (q[1] - o[1]) - (p[1] - o[1]) * (q[0] - o[0])
    meets = lambda p, q: (p[0] == q[0]) & (p[1] == q[1])
    joined = meets(point("e", 0), point("f", 0)) | meets(point("e", 0), point("f", 1)) | meets(point("e", 1), point("f", 0)) | meets(point("e", 1), point("f", 1))
    t = {
        "f0": turn(point("e", 0), point("e", 1), point("f", 0)), "f1": turn(point("e", 0), point("e", 1), point("f", 1)),
        "e0": turn(point("f", 0), point("f", 1), point("e", 0)), "e1": turn(point("f", 0), point("f", 1), point("e", 1)),
    }
    met = e.join(f, ["_cx", "_cy"]).where(F.col("ee") < F.col("fe")).where(~same & ~joined).withColumns(t)
    met = met.where((F.signum("f0") * F.signum("f1") <= 0) & (F.signum("e0") * F.signum("e1") <= 0))

    def place(c: str) -> Column:
        on = F.col(f"e{c}0") + (F.col(f"e{c}1") - F.col(f"e{c}0")) * (F.col("e0") / (F.col("e0") - F.col("e1")))
        out = F.round(on * FINE) / FINE
        for k in ("f1", "f0", "e1", "e0"):  # an end that lies on the other edge is the place itself
            out = F.when(F.col(k) == 0, F.col(f"{k[0]}{c}{k[1]}").cast("double")).otherwise(out)
        return out

    met = met.select("ee", "fe", place("x").alias("x"), place("y").alias("y")).distinct()
    return met.select(F.explode(F.array("ee", "fe")).alias("e"), "x", "y").distinct()


def _stretches(e: DataFrame) -> DataFrame:
    """``(line, x0, y0, x1, y1)``: edges that overlap or touch on a line as one, however many shapes they border. A crossing cuts the whole line, so it is
    looked for once, not for each pair of edges that pass there."""
    end = lambda i: F.struct(F.col(f"t{i}").alias("t"), F.col(f"o{i}").alias("o"), F.lit(1 - 2 * i).alias("opens"))
    d = e.select(*M.LINE, F.explode(F.array(end(0), end(1))).alias("_e")).select(*M.LINE, "_e.*")
    d = d.repartition(*M.LINE).groupBy(*M.LINE, "t", "o").agg(F.sum("opens").alias("opens"))
    w = Window.partitionBy(*M.LINE).orderBy("t")
    d = d.withColumn("over", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("over = 0 or over = opens and opens > 0")
    d = d.withColumns({"t2": F.lead("t").over(w), "o2": F.lead("o").over(w)}).where("over > 0")
    xy = {"x0": ("o", "t"), "y0": ("t", "o"), "x1": ("o2", "t2"), "y1": ("t2", "o2")}
    return d.select(*M.LINE, *[F.when(F.col("steep"), F.col(a)).otherwise(F.col(b)).alias(c) for c, (a, b) in xy.items()])


def arrangement(edges: DataFrame, key: str = "id") -> DataFrame:
    """``(x0, y0, x1, y1, left, right)``: pieces of all borders, with sorted arrays of the shapes (whole numbers) over either side; pieces with the
    same on both sides go. ``edges`` is a table of directed edges (see ``layers``); shapes may overlap, touch, repeat and lie inside one another.

    Shapes of equal edges are laid as one (``layers.equal_shapes``); each set that occurs gets all of them at the end, once."""
    with Scope(edges.sparkSession) as made:
        stage = Stage(edges.sparkSession, "overlay")
        edges = stage.put(edges.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), "x0", "y0", "x1", "y1"), "given")
        same = stage.put(M.equal_shapes(edges, "key"), "equal")
        p = stage.put(_laid(M.of_first(edges, same, "key")), "laid")
        sets = stage.put(whole_sets(p.select(F.explode(F.array("left", "right")).alias("set")).distinct(), same), "sets")
        made.keep(p, sets)
    for c in ("left", "right"):
        p = p.join(sets.select(F.col("set").alias(c), F.col("whole").alias(f"_{c}")), c)
    return p.select("x0", "y0", "x1", "y1", F.col("_left").alias("left"), F.col("_right").alias("right"))


def whole_sets(sets: DataFrame, same: DataFrame) -> DataFrame:
    """``sets`` with ``whole``: the column ``set``, an array of first shapes, with all that equal them (``same``: key, first), in order."""
    groups = same.groupBy("first").agg(F.collect_list("key").alias("_keys"))
    d = sets.withColumn("_s", F.monotonically_increasing_id())
    d = Stage(sets.sparkSession, "sets").put(d, "sets")
    each = join_dim(d.select("_s", F.explode("set").alias("first")), groups, "first", "inner").groupBy("_s").agg(F.sort_array(F.flatten(F.collect_list("_keys"))).alias("whole"))
    return d.join(each, "_s", "left").withColumn("whole", F.coalesce("whole", F.array().cast("array<bigint>"))).drop("_s")


def _laid(edges: DataFrame) -> DataFrame:
    """``arrangement`` of shapes (key) none of which equals another."""
    with Scope(edges.sparkSession) as made:
        stage = Stage(edges.sparkSession, "overlay")
        e = M._on_lines(edges.select("key", "x0", "y0", "x1", "y1"))
        e = stage.put(e, "edges")
        steep = F.col("steep")
        whole = stage.put(_stretches(e).withColumn("e", F.monotonically_increasing_id()), "stretches")
        cross = _crossings(whole).join(whole.select("e", *M.LINE), "e").select(*M.LINE, F.when(steep, F.col("y")).otherwise(F.col("x")).alias("t"), F.when(steep, F.col("x")).otherwise(F.col("y")).alias("o"))
        ends = e.select(*M.LINE, F.explode(F.array(*[F.struct(F.col(f"t{i}").cast("double").alias("t"), F.col(f"o{i}").cast("double").alias("o")) for i in (0, 1)])).alias("_")).select(*M.LINE, "_.*")
        w = Window.partitionBy(*M.LINE).orderBy("t", "o")
        cuts = ends.unionByName(cross).distinct().withColumns({"k": F.row_number().over(w), "t2": F.lead("t").over(w), "o2": F.lead("o").over(w)})
        cuts = stage.put(cuts, "cuts")
        at = lambda i: cuts.select(*M.LINE, F.col("t").alias(f"t{i}"), F.col("o").alias(f"o{i}"), F.col("k").alias(f"k{i}"))
        spans = e.select("key", "ahead", *M.LINE, *[F.col(f"{c}{i}").cast("double").alias(f"{c}{i}") for c in "to" for i in (0, 1)])
        spans = spans.join(at(0), [*M.LINE, "t0", "o0"]).join(at(1), [*M.LINE, "t1", "o1"])
        one = spans.select("key", "ahead", *M.LINE, F.explode(F.sequence("k0", F.col("k1") - 1)).alias("k"))
        side = lambda way: F.array_sort(F.collect_set(F.when(F.col("ahead") == way, F.col("key"))))
        p = one.groupBy(*M.LINE, "k").agg(side(1).alias("l"), side(-1).alias("r")).join(cuts, [*M.LINE, "k"])
        xy = {"x0": ("o", "t"), "y0": ("t", "o"), "x1": ("o2", "t2"), "y1": ("t2", "o2")}
        p = p.select(*[F.when(steep, F.col(a)).otherwise(F.col(b)).alias(c) for c, (a, b) in xy.items()], "l", "r").where("x0 <> x1 or y0 <> y1")
        p = stage.put(p.withColumn("piece", F.monotonically_increasing_id()), "pieces")
        mid = p.select("piece", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"))
        over = containing(mid, e.select("key", "x0", "y0", "x1", "y1"), "piece", "key").groupBy("piece").agg(F.collect_set("key").alias("over"))
        over = stage.put(over, "over")
        made.keep(p, over)
    rest = F.array_except(F.coalesce("over", F.array().cast("array<bigint>")), F.concat("l", "r"))
    out = spread(p, "piece").join(over, "piece", "left").select("x0", "y0", "x1", "y1", F.array_sort(F.concat("l", rest)).alias("left"), F.array_sort(F.concat("r", rest)).alias("right"))
    return out.where("left <> right")


def half_edges(pieces: DataFrame) -> DataFrame:
    """``(face, x0, y0, x1, y1)``: pieces from both sides, the face on the left; without the face that no shape covers."""
    back = pieces.select(F.col("right").alias("face"), F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x0").alias("x1"), F.col("y0").alias("y1"))
    return pieces.select(F.col("left").alias("face"), "x0", "y0", "x1", "y1").unionByName(back).where(F.size("face") > 0)


def face_areas(pieces: DataFrame) -> DataFrame:
    """``(face, area)``: how much lies under each set of shapes and no other."""
    return half_edges(pieces).groupBy("face").agg((F.sum(F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0")) / 2).alias("area"))


def faces_of(edges: DataFrame, key: str = "id") -> DataFrame:
    """``face_areas`` of the arrangement of ``edges``, for which equal shapes are one until its faces are summed up: no piece carries them all."""
    with Scope(edges.sparkSession) as made:
        stage = Stage(edges.sparkSession, "faces")
        edges = stage.put(edges.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), "x0", "y0", "x1", "y1"), "given")
        same = stage.put(M.equal_shapes(edges, "key"), "equal")
        faces = stage.put(whole_sets(face_areas(_laid(M.of_first(edges, same, "key"))).withColumnRenamed("face", "set"), same), "faces")
        made.keep(faces)
    return faces.select(F.col("whole").alias("face"), "area")


def relabelled(pieces: DataFrame, rule) -> DataFrame:
    """The pieces after ``rule``, a function from a column of sets to one of sets; borders between equal sets vanish."""
    return pieces.withColumns({"left": rule(F.col("left")), "right": rule(F.col("right"))}).where("left <> right")


def difference(pieces: DataFrame, cutter: int) -> DataFrame:
    """All shapes without what ``cutter`` covers, and without it (a carve: ``cutter`` stays where ``relabelled`` keeps it)."""
    return relabelled(pieces, lambda s: F.when(F.array_contains(s, cutter), F.array().cast("array<bigint>")).otherwise(s))


def intersection(pieces: DataFrame, frame: int) -> DataFrame:
    """All shapes within ``frame``, without it."""
    return relabelled(pieces, lambda s: F.when(F.array_contains(s, frame), F.array_remove(s, frame)).otherwise(F.array().cast("array<bigint>")))


def shapes_of(pieces: DataFrame, key: str = "id") -> DataFrame:
    """Edges (key, x0, y0, x1, y1) of the shapes: those that lie on one side of a piece only."""
    def one(a: str, b: str, *ends: str) -> DataFrame:
        return pieces.select(F.explode(F.array_except(a, b)).alias(key), *[F.col(e).alias(n) for e, n in zip(ends, ("x0", "y0", "x1", "y1"))])

    return one("left", "right", "x0", "y0", "x1", "y1").unionByName(one("right", "left", "x1", "y1", "x0", "y0"))


def resolve_overlaps(pieces: DataFrame) -> DataFrame:
    """The pieces with at most one shape a side: pairs that overlap are settled one after the other, in the order of their ids, as earlier ones left them;
    what two share stays with the one of the longer outline (of equals the first). Pairs without a shape in common do not wait for
    one another: a round settles every pair that is first for both its shapes."""
    stage = Stage(pieces.sparkSession, "resolve")
    cur = stage.put(pieces, "pieces")
    faces = cur.select(F.explode(F.array("left", "right")).alias("s")).where("size(s) > 1").distinct()
    pair = faces.select(F.explode("s").alias("a"), "s").select("a", F.explode("s").alias("b")).where("a < b").distinct()
    open_ = stage.put(pair, "pairs")
    while not open_.isEmpty():
        both = open_.select(F.explode(F.array("a", "b")).alias("id"), F.struct("a", "b").alias("p"))
        first = both.groupBy("id").agg(F.min("p").alias("p")).groupBy("p").agg(F.count("*").alias("n")).where("n = 2").select("p.a", "p.b")
        outline = shapes_of(cur).groupBy("id").agg(F.round(F.sum(M.length()), 6).alias("long"))
        ready = first.join(outline.toDF("a", "la"), "a", "left").join(outline.toDF("b", "lb"), "b", "left")
        ready = stage.put(ready.select("a", "b", (F.coalesce("la", F.lit(0.0)) >= F.coalesce("lb", F.lit(0.0))).alias("stays")), "ready")
        sets = cur.select(F.explode(F.array("left", "right")).alias("s")).where("size(s) > 1").distinct()
        lost = sets.withColumn("id", F.explode("s")).join(ready.select(F.col("a").alias("id"), "b", "stays"), "id").where("array_contains(s, b)")
        lost = lost.groupBy("s").agg(F.collect_set(F.when(F.col("stays"), F.col("b")).otherwise(F.col("id"))).alias("lost"))
        lost = stage.put(lost, "lost")
        for c in ("left", "right"):
            cur = join_dim(cur, lost.withColumnRenamed("s", c), c, "left").withColumn(c, F.array_except(c, F.coalesce("lost", F.array().cast("array<bigint>")))).drop("lost")
        cur = stage.put(cur.where("left <> right"), "pieces")
        open_ = stage.put(open_.join(ready.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        for name in ("pieces", "pairs"):
            stage.drop(name, keep_last=True)
    return cur


def snapped(pieces: DataFrame, frame: int) -> DataFrame:
    """Shapes that do not overlap, cut at ``frame`` and filled up to it: what ``frame`` holds and no shape covers goes, part by part, to the shape with
    the longest border on it (of equals the smallest); a part that touches no shape stays open, for ``near.nearest_of`` to place."""
    stage = Stage(pieces.sparkSession, "snap")
    inside = stage.put(relabelled(pieces, lambda s: F.when(F.array_contains(s, frame), s).otherwise(F.array().cast("array<bigint>"))), "inside")
    bare = F.array(F.lit(frame).cast("long"))
    e = half_edges(inside).where(F.col("face") == bare)
    chained = stage.put(M.rings(e.select(F.lit(0).alias("all"), "x0", "y0", "x1", "y1"), ["all"]), "rings")
    # a part may have several rings, its outline and its holes: they are joined by the piece of map they bound, an outline holding its holes
    sizes = M.ring_sizes(chained, ["all"]).select("ring", "area")
    outlines = chained.join(sizes.where("area > 0"), "ring").select(F.col("ring").alias("id"), "x0", "y0", "x1", "y1")
    hole = chained.join(sizes.where("area < 0"), "ring").groupBy("ring").agg(F.min(F.struct("x0", "y0")).alias("p")).select("ring", F.col("p.x0").alias("x"), F.col("p.y0").alias("y"))
    holder = containing(hole.withColumn("x", F.col("x") - 1 / FINE), outlines, "ring", "id")
    areas = sizes.select(F.col("ring").alias("id"), "area")
    holder = holder.join(areas, "id").groupBy("ring").agg(F.min_by("id", "area").alias("part"))
    part = stage.put(chained.join(holder, "ring", "left").select(F.coalesce("part", "ring").alias("part"), "x0", "y0", "x1", "y1"), "part")
    back = inside.where(F.col("left") == bare).select("x0", "y0", "x1", "y1", F.col("right").alias("other")).unionByName(
        inside.where(F.col("right") == bare).select(F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x0").alias("x1"), F.col("y0").alias("y1"), F.col("left").alias("other"))
    )
    touch = part.join(back, ["x0", "y0", "x1", "y1"])
    on = touch.select("part", F.explode(F.array_remove("other", frame)).alias("to"), M.length().alias("w")).groupBy("part", "to").agg(F.round(F.sum("w"), 6).alias("w"))
    goes = on.groupBy("part").agg(F.max(F.struct("w", (-F.col("to")).alias("n"), "to")).alias("m")).select("part", F.col("m.to").alias("to"))
    owner = stage.put(part.join(goes, "part").select("x0", "y0", "x1", "y1", "to"), "owner")
    rev = owner.select(F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x0").alias("x1"), F.col("y0").alias("y1"), F.col("to").alias("rto"))
    out = inside.join(owner, ["x0", "y0", "x1", "y1"], "left").join(rev, ["x0", "y0", "x1", "y1"], "left")
    open_ = lambda side: F.when(F.col(side) == bare, F.col(side)).otherwise(F.array_remove(F.col(side), frame))
    filled = lambda side, to: F.when((F.col(side) == bare) & F.col(to).isNotNull(), F.array(F.col(to))).otherwise(open_(side))
    return out.select("x0", "y0", "x1", "y1", filled("left", "to").alias("left"), filled("right", "rto").alias("right")).where("left <> right")
