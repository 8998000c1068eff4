"""Maps as edge tables: dissolve, shared borders, arcs, simplification, common areas; any number of shapes, of any form.

A layer is a table of directed edges (key, x0, y0, x1, y1) with the shape on the left: outer rings run counter-clockwise, holes
clockwise. Coordinates are whole numbers (degrees over a quantum) up to 2^24 either way. Then the line an edge lies on is told
exactly by two whole numbers, its slope and its offset in binary fractions (``_on_lines``), and everything that concerns common borders is one grouped sum over
the ends of edges on a line and one running sum along it. Neighbours need not share their vertices: a long edge
facing many short ones is split where they end.

Scale: a shape is never gathered in a task. Rows are dealt by their lines once, for the sums at equal points and for the windows along a line; what a
shape's own parts have in common goes before that, without a shuffle where its edges lie in one task. Rings and arcs are numbered by pointer jumping (``list_ranks``), a join a round over all lists at once, as many rounds as the
logarithm of the longest. Layers must not overlap themselves where that is said; it is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.operators.spatial import ring_area
from quorumlake.plans.joins import join_dim
from quorumlake.plans.staging import Scope, Stage

#: Coordinates up to this are told apart by lines of doubles: slopes differ by 2^-50 at least, offsets by 2^-25.
REACH = 1 << 24
#: They are kept as whole numbers of these parts: windows and groups over doubles are dealt anew each time.
SLOPE, OFFSET = float(1 << 52), float(1 << 28)
LINE = ["steep", "slope", "offset"]


def edges_of(shapes: DataFrame, keys: list[str], rings: str = "rings", quantum: float = 1.0) -> DataFrame:
    """Edges of ``array<array<struct<x,y>>>``, the first ring the outer one, others its holes, closed or not, in any direction; a shape of many
    parts is a row a part. Rings of under three points or without area, and null shapes, have no edges."""
    near = lambda c: F.round(c / F.lit(quantum)).cast("long")
    d = shapes.select(*keys, F.posexplode(rings).alias("_i", "_r"))
    once = lambda c: F.explode(F.array(c))  # noqa: E731  (made once: filters and projections after it do not repeat it)
    d = d.select(*keys, "_i", once(F.transform("_r", lambda p: F.struct(near(p["x"]).alias("x"), near(p["y"]).alias("y")))).alias("_r"))
    area = ring_area(F.transform("_r", lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))))
    d = d.withColumn("_a", once(area)).where("_a <> 0").withColumn("_r", F.when((F.col("_a") > 0) == (F.col("_i") == 0), F.col("_r")).otherwise(F.reverse("_r")))
    turned = F.concat(F.slice("_r", 2, F.size("_r")), F.slice("_r", 1, 1))
    d = d.select(*keys, F.explode(F.arrays_zip(F.col("_r").alias("p"), turned.alias("q"))).alias("_e"))
    d = d.select(*keys, *[F.col(f"_e.{p}.{c}").alias(f"{c}{i}") for i, p in enumerate("pq") for c in "xy"])
    return d.where("x0 <> x1 or y0 <> y1")


def _on_lines(edges: DataFrame) -> DataFrame:
    """Adds the line (steep, slope, offset) and the ends' places on it: ``t0`` < ``t1``, the other coordinates ``o0``, ``o1``; ``ahead`` is 1 if the
    edge runs that way, else -1. Two edges are on one line if and only if the three numbers are equal."""
    far = F.greatest(*[F.abs(c) for c in ("x0", "y0", "x1", "y1")]) > REACH
    ok = F.when(far, F.raise_error(F.lit(f"a coordinate is beyond {REACH} quanta"))).otherwise(F.lit(True))
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    steep = F.abs(dy) > F.abs(dx)
    cross = F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0")
    slope = F.when(steep, F.try_divide(dx, dy)).otherwise(F.try_divide(dy, dx))
    offset = F.when(steep, F.try_divide(cross, dy)).otherwise(F.try_divide(cross, dx))
    d = edges.where(ok).withColumns({"steep": steep, "slope": (slope * SLOPE).cast("long"), "offset": (offset * OFFSET).cast("long")})
    at = {f"_{k}{i}": F.when(F.col("steep"), F.col(f"{a}{i}")).otherwise(F.col(f"{b}{i}")) for i in "01" for k, a, b in (("t", "y", "x"), ("o", "x", "y"))}
    d = d.withColumns(at).withColumn("ahead", F.when(F.col("_t0") < F.col("_t1"), 1).otherwise(-1))
    pick = lambda k, i: F.when(F.col("ahead") == 1, F.col(f"_{k}{i}")).otherwise(F.col(f"_{k}{1 - i}"))
    return d.withColumns({f"{k}{i}": pick(k, i) for k in "to" for i in (0, 1)}).drop(*at)


def _ends(edges: DataFrame, keep: list[str]) -> DataFrame:
    """Both ends of each edge on its line: (keep, line, ahead, t, o, opens)."""
    d = _on_lines(edges)
    end = lambda i: F.struct(F.col(f"t{i}").alias("t"), F.col(f"o{i}").alias("o"), F.lit(1 - 2 * i).alias("opens"))
    return d.select(*keep, *LINE, "ahead", F.explode(F.array(end(0), end(1))).alias("_e")).select(*keep, *LINE, "ahead", "_e.*")


def _between(d: DataFrame, by: list[str], sums: list[str]) -> DataFrame:
    """Stretches of a line between neighbouring ends: running ``sums`` up to the first end, the ends as points (px, py), (qx, qy)."""
    w = Window.partitionBy(*by, *LINE).orderBy("t")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({s: F.sum(s).over(run) for s in sums} | {"t2": F.lead("t").over(w), "o2": F.lead("o").over(w)}).where("t2 is not null")
    point = {"px": ("steep", "o", "t"), "py": ("steep", "t", "o"), "qx": ("steep", "o2", "t2"), "qy": ("steep", "t2", "o2")}
    return d.withColumns({k: F.when(F.col(s), F.col(a)).otherwise(F.col(b)) for k, (s, a, b) in point.items()})


def _checked(c: str, most: int, why: str) -> Column:
    return F.when(F.abs(c) > most, F.raise_error(F.lit(why))).otherwise(F.lit(True))


def dissolve(edges: DataFrame, by: list[str]) -> DataFrame:
    """``(by, x0, y0, x1, y1)``: the outline of each group's shapes, which must not overlap. What two of them share cancels, whole or in part; straight
    stretches are one edge. A group without an outline does not occur; null keys are a group."""
    return _outline(_ends(edges, by).repartition(*by, *LINE), by)


def shape_outlines(edges: DataFrame, by: list[str]) -> DataFrame:
    """``dissolve`` of single shapes, which is not dealt by lines: edges that lie in tasks by their shapes (some of ``by``) are not shuffled at all."""
    d = edges.select(*by, "x0", "y0", "x1", "y1")
    return _outline(_ends(d, by), by)


def _outline(ends: DataFrame, by: list[str]) -> DataFrame:
    d = ends.groupBy(*by, *LINE, "t", "o").agg(F.sum(F.col("ahead") * F.col("opens")).alias("level")).where("level <> 0")
    d = _between(d, by, ["level"]).where("level <> 0").where(_checked("level", 1, "shapes of a group overlap"))
    turn = lambda a, b: F.when(F.col("level") > 0, F.col(a)).otherwise(F.col(b))
    return d.select(*by, turn("px", "qx").alias("x0"), turn("py", "qy").alias("y0"), turn("qx", "px").alias("x1"), turn("qy", "py").alias("y1"))


def border_pieces(edges: DataFrame, key: str = "id") -> DataFrame:
    """``(x0, y0, x1, y1, left, right)``: the layer as stretches with the shape on either side, null outside. ``key`` is a whole number; shapes must not
    overlap. One shape at a time lies on a side, so the running sum of the keys that open less those that close names it."""
    sides = {}
    for side, way in (("left", 1), ("right", -1)):
        mine = F.when(F.col("ahead") == way, F.col("opens")).otherwise(0)
        sides |= {f"n_{side}": F.sum(mine), side: F.sum(F.col(key).cast("long") * mine)}
    own = shape_outlines(edges.where(F.col(key).isNotNull()), [key])
    d = _ends(own, [key]).repartition(*LINE).groupBy(*LINE, "t", "o").agg(*[v.alias(k) for k, v in sides.items()])
    d = d.where(" or ".join(f"`{s}` <> 0" for s in sides))  # where nothing changes on either side a stretch runs on
    d = _between(d, [], list(sides)).where("n_left <> 0 or n_right <> 0")
    d = d.where(_checked("n_left", 1, "shapes overlap")).where(_checked("n_right", 1, "shapes overlap"))
    d = d.select(F.col("px").alias("x0"), F.col("py").alias("y0"), F.col("qx").alias("x1"), F.col("qy").alias("y1"), *[F.when(F.col(f"n_{s}") != 0, F.col(s)).alias(s) for s in ("left", "right")])
    return d.where("not left <=> right")


def equal_shapes(edges: DataFrame, key: str = "id") -> DataFrame:
    """``(key, first)``: each shape with the smallest one that has the same edges. Shapes are told apart by hashes of their edges; where the edges of those of one
    hash are not the same, which is checked, each stays by itself. No shape is gathered."""
    ends = ["x0", "y0", "x1", "y1"]
    e = edges.groupBy(key, *ends).agg(F.count("*").alias("_m"))
    mark = lambda salt: F.sum(F.xxhash64(F.lit(salt), *ends, "_m").cast("decimal(38,0)"))
    s = e.groupBy(key).agg(mark(1).alias("_h"), mark(2).alias("_g"), F.count("*").alias("_n"))
    s = Stage(edges.sparkSession, "equal").put(s, "marks")
    first = s.groupBy("_h", "_g", "_n").agg(F.min(key).alias("first"), F.count("*").alias("_of")).where("_of > 1").drop("_of")
    found = s.join(first, ["_h", "_g", "_n"]).select(key, "first", "_n")
    found = Stage(edges.sparkSession, "equal").put(found, "found")
    union = join_dim(e, found, key, "inner").groupBy("first", "_n", *ends, "_m").agg(F.count("*").alias("_k")).groupBy("first", "_n").agg(F.count("*").alias("_all"))
    good = union.where("_all = _n").select("first")
    named = join_dim(found.select(key, "first"), good, "first", "left_semi")
    return join_dim(s.select(key), named, key).select(key, F.coalesce("first", key).alias("first"))


def of_first(edges: DataFrame, same: DataFrame, key: str = "id") -> DataFrame:
    """The edges of one shape of those that are equal."""
    return join_dim(edges, same.where(F.col(key) == F.col("first")).select(key), key, "left_semi").select(key, "x0", "y0", "x1", "y1")


def length() -> Column:
    return F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))


def shared_borders(pieces: DataFrame) -> DataFrame:
    """``(a, b, length)``, a < b: how long the common border of two shapes is."""
    both = pieces.where("left is not null and right is not null")
    return both.groupBy(F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b")).agg(F.sum(length()).alias("length"))


# ---------------------------------------------------------------- lists


def list_ranks(links: DataFrame) -> DataFrame:
    """``links`` (id long, nxt long or null) are disjoint lists and circles; ``(id, list, closed, at)``: ``at`` grows along each. A list is named by its last
    element, a circle by its smallest, which comes first.

    Pointer jumping: in round k an element knows the smallest element, and its distance, of the 2^k from it on, and the element
    after them. Rounds end when every pointer has left its list, or gone round its circle: then its target knows the same smallest element. If that holds
    for one element of a circle, all of it have gone round. Lists and circles that are through leave the table every few rounds, so only long ones
    are carried on."""
    stage = Stage(links.sparkSession, "lists")
    cur = links.select("id", "nxt", F.col("id").alias("m"), F.lit(0).cast("long").alias("d"), F.coalesce("nxt", "id").alias("tail"), F.when(F.col("nxt").isNull(), 0).otherwise(1).cast("long").alias("steps"))
    cur, step, through = stage.put(cur, "lists"), 1, []
    while True:
        j = cur.select(F.col("id").alias("nxt"), *[F.col(c).alias(f"j_{c}") for c in ("nxt", "m", "d", "tail", "steps")])
        on = cur.join(j, "nxt", "left")
        less, ends = F.col("j_m") < F.col("m"), F.col("nxt").isNull()
        cur = on.select(
            "id", F.col("j_nxt").alias("nxt"), F.when(less, F.col("j_m")).otherwise(F.col("m")).alias("m"), F.when(less, F.col("j_d") + step).otherwise(F.col("d")).alias("d"),
            F.when(ends, F.col("tail")).otherwise(F.col("j_tail")).alias("tail"), (F.col("steps") + F.when(ends, 0).otherwise(F.col("j_steps"))).alias("steps"), (~ends & (F.col("m") != F.col("j_m"))).alias("moved"),
        )
        cur = stage.put(cur, "lists")
        stage.drop("lists", keep_last=True)
        step *= 2
        if cur.where("moved").isEmpty():
            break
        if step in (4, 16) or step > 16 and step.bit_length() % 3 == 0:
            round_ = stage.put(cur.where("nxt is not null and not moved").select("m").distinct(), "round")
            going = cur.where("nxt is not null").join(round_, "m", "left_anti").select(cur.columns)
            aim = going.select(F.col("nxt").alias("id"))
            # of an open list's end what no pointer aims at now none will
            left = cur.where("nxt is null")
            through.append(stage.put(cur.where("nxt is not null").join(round_, "m", "left_semi").select(cur.columns).unionByName(left.join(aim, "id", "left_anti").select(cur.columns)), "through"))
            cur = stage.put(going.unionByName(left.join(aim, "id", "left_semi").select(cur.columns)), "lists")
            stage.drop("lists", keep_last=True)
    for d in through:
        cur = cur.unionByName(d)
    closed = F.col("nxt").isNotNull()
    first = F.when(F.col("d") == 0, F.lit(-(1 << 62))).otherwise(-F.col("d"))
    return cur.select("id", F.when(closed, F.col("m")).otherwise(F.col("tail")).alias("list"), closed.alias("closed"), F.when(closed, first).otherwise(-F.col("steps")).alias("at"))


def _around(dx: Column, dy: Column) -> list[Column]:
    """A direction's place counter-clockwise, in exact numbers: a quarter, and the slope in it."""
    flat = F.abs(dx) >= F.abs(dy)
    quarter = F.when(flat, F.when(dx > 0, 0).otherwise(2)).otherwise(F.when(dy > 0, 1).otherwise(3))
    return [quarter, F.when(flat, F.try_divide(dy, dx)).otherwise(-F.try_divide(dx, dy))]


def rings(outline: DataFrame, by: list[str]) -> DataFrame:
    """``(by, ring, at, x0, y0, x1, y1)``: the edges of ``dissolve`` chained to rings, in the order of ``at``. Where rings touch in a point, each
    keeps to its own side: the next edge is the first one clockwise from the way back."""
    stage = Stage(outline.sparkSession, "rings")
    e = stage.put(outline.withColumn("_id", F.monotonically_increasing_id()), "edges")
    way = lambda a, b, comes: [*by, *[F.col(f"{c}{a}").alias(f"_{c}") for c in "xy"], *[(F.col(f"{c}{b}") - F.col(f"{c}{a}")).alias(f"_d{c}") for c in "xy"], "_id", F.lit(comes).alias("_comes")]
    v = e.select(*way(1, 0, True)).unionByName(e.select(*way(0, 1, False)))
    quarter, slope = _around(F.col("_dx"), F.col("_dy"))
    w = Window.partitionBy(*by, "_x", "_y").orderBy("_quarter", "_slope")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    v = v.withColumns({"_quarter": quarter, "_slope": slope}).withColumn("_nxt", F.coalesce(F.lag("_id").over(w), F.last("_id").over(whole)))
    ranks = list_ranks(v.where("_comes").select(F.col("_id").alias("id"), F.col("_nxt").alias("nxt")))
    ranks = ranks.select(F.col("id").alias("_id"), F.col("list").alias("ring"), "at")
    return e.join(ranks, "_id").select(*by, "ring", "at", "x0", "y0", "x1", "y1")


def _area(edges: DataFrame) -> Column:
    """Half the sum of the edges' cross products: exact for whole coordinates."""
    twice = F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0")
    return F.sum(twice.cast("decimal(20,0)") if edges.schema["x0"].dataType.typeName() == "long" else twice).cast("double") / 2


def ring_sizes(chained: DataFrame, by: list[str]) -> DataFrame:
    """``(by, ring, area, length, edges)``: a hole's area is negative."""
    return chained.groupBy(*by, "ring").agg(_area(chained).alias("area"), F.sum(length()).alias("length"), F.count("*").alias("edges"))


def outline_sizes(edges: DataFrame, by: list[str]) -> DataFrame:
    """``(by, area, length)`` of whole outlines, holes taken off: the sums of ``ring_sizes``, for which no ring needs to be chained."""
    return edges.groupBy(*by).agg(_area(edges).alias("area"), F.sum(length()).alias("length"))


def areas(edges: DataFrame, by: list[str]) -> DataFrame:
    """``(by, area)``."""
    return edges.groupBy(*by).agg(_area(edges).alias("area"))


# ---------------------------------------------------------------- arcs


def arcs(pieces: DataFrame) -> DataFrame:
    """``(arc, closed, at, x0, y0, x1, y1, left, right, alone)``: border pieces chained between junctions, where three or more meet. Both
    shapes refer to the same arc; it runs with the smaller one (none is the smallest) on its left. ``alone`` tells an arc of one piece."""
    stage = Stage(pieces.sparkSession, "arcs")
    back = F.coalesce(F.col("left") > F.col("right"), F.col("right").isNull())
    turn = lambda a, b: F.when(back, F.col(b)).otherwise(F.col(a))
    p = pieces.select(*[turn(a, b).alias(a) for a, b in (("x0", "x1"), ("y0", "y1"), ("x1", "x0"), ("y1", "y0"), ("left", "right"), ("right", "left"))])
    p = stage.put(p.withColumn("id", F.monotonically_increasing_id()), "pieces")
    end = lambda i: F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y"), F.lit(i == 1).alias("comes"))
    ends = p.select("id", F.explode(F.array(end(0), end(1))).alias("_e")).select("id", "_e.*")
    meet = ends.groupBy("x", "y").agg(F.count("*").alias("n"), F.max(F.when(F.col("comes"), F.col("id"))).alias("id"), F.max(F.when(~F.col("comes"), F.col("id"))).alias("nxt"))
    links = stage.put(meet.where("n = 2 and id is not null and nxt is not null").select("id", "nxt"), "links")
    last = links.select(F.col("nxt").alias("id")).join(links, "id", "left_anti").withColumn("nxt", F.lit(None).cast("long"))
    # a piece between two junctions is an arc: only the others are numbered
    ranks = stage.put(list_ranks(links.unionByName(last)), "ranks")
    d = join_dim(p, ranks, "id", "left").withColumns({"arc": F.coalesce("list", "id"), "alone": F.col("list").isNull()})
    return d.select("arc", F.coalesce("closed", F.lit(False)).alias("closed"), F.coalesce("at", F.lit(0).cast("long")).alias("at"), "x0", "y0", "x1", "y1", "left", "right", "alone")


def simplify(chained: DataFrame, tolerance: float) -> DataFrame:
    """``arcs`` with fewer points: none that goes was farther than ``tolerance`` from its arc's new line (Douglas-Peucker). An arc's ends stay; of a closed
    one at least the first point and two others do, so no ring vanishes. Each arc is simplified once, so neighbours stay equal along it.

    Arcs of one piece stay as they are. In rounds over all others: the farthest point of each open stretch, by a grouped maximum, splits it or closes it."""
    stage = Stage(chained.sparkSession, "simplify")
    cols = ["arc", "at", "x0", "y0", "x1", "y1", "closed", "left", "right"]
    straight = chained.where("alone").select(cols)
    chained = stage.put(chained.where("not alone").select(cols), "chained")
    sides = chained.groupBy("arc").agg(F.first("closed").alias("closed"), F.first("left").alias("left"), F.first("right").alias("right"))
    ends = chained.groupBy("arc").agg(F.max_by(F.struct("x1", "y1"), "at").alias("e"), F.max("at").alias("last"))
    ends = ends.select("arc", (F.col("last") + F.lit(1)).alias("at"), F.col("e.x1").alias("x"), F.col("e.y1").alias("y"))
    points = chained.select("arc", "at", F.col("x0").alias("x"), F.col("y0").alias("y")).unionByName(ends)
    span = points.groupBy("arc").agg(F.min_by(F.struct("at", "x", "y"), "at").alias("lo"), F.max_by(F.struct("at", "x", "y"), "at").alias("hi"))
    kept = stage.put(span.select("arc", "lo.*").unionByName(span.select("arc", "hi.*")), "kept")
    span = span.join(sides.select("arc", "closed"), "arc").select("arc", F.when(F.col("closed"), 2).otherwise(0).alias("must"), "lo", "hi")
    cur = stage.put(points.join(span, "arc").where("at > lo.at and at < hi.at"), "open")
    x0, y0, ux, uy = F.col("lo.x"), F.col("lo.y"), F.col("hi.x") - F.col("lo.x"), F.col("hi.y") - F.col("lo.y")
    long2 = (ux * ux + uy * uy).cast("double")
    along = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide((F.col("x") - x0) * ux + (F.col("y") - y0) * uy, long2), F.lit(0.0))))
    off = F.hypot(F.col("x") - x0 - along * ux, F.col("y") - y0 - along * uy)
    while not cur.isEmpty():
        far = cur.withColumn("off", off).groupBy("arc", F.col("lo.at").alias("from")).agg(F.max(F.struct("off", (-F.col("at")).alias("n"), "at", "x", "y", "must")).alias("f"))
        far = far.where((F.col("f.off") > tolerance) | (F.col("f.must") > 0)).select("arc", "from", F.struct("f.at", "f.x", "f.y").alias("split"))
        far = stage.put(far, "far")
        kept = kept.unionByName(far.select("arc", "split.*"))
        on = cur.withColumn("from", F.col("lo.at")).join(far, ["arc", "from"]).where("at <> split.at")
        before = F.col("at") < F.col("split.at")
        must = F.when((F.col("must") == 2) & before, 1).otherwise(0)  # of a closed arc the first split's first half is split once more
        cur = on.select("arc", "at", "x", "y", must.alias("must"), F.when(before, F.col("lo")).otherwise(F.col("split")).alias("lo"), F.when(before, F.col("split")).otherwise(F.col("hi")).alias("hi"))
        cur = stage.put(cur, "open")
        stage.drop("open", keep_last=True)
    w = Window.partitionBy("arc").orderBy("at")
    d = kept.select("arc", "at", F.col("x").alias("x0"), F.col("y").alias("y0"), F.lead("x").over(w).alias("x1"), F.lead("y").over(w).alias("y1"))
    d = d.where("x1 is not null and (x0 <> x1 or y0 <> y1)").join(sides, "arc")
    return straight.unionByName(d.select(cols))


def sides_of(pieces: DataFrame, key: str = "id") -> DataFrame:
    """Border pieces or arcs as edges (key, x0, y0, x1, y1) of the shapes on both sides."""
    one = pieces.where("left is not null").select(F.col("left").alias(key), "x0", "y0", "x1", "y1")
    return one.unionByName(pieces.where("right is not null").select(F.col("right").alias(key), F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x0").alias("x1"), F.col("y0").alias("y1")))


# ---------------------------------------------------------------- common areas


def boxes(edges: DataFrame, keys: list[str], prefix: str = "") -> DataFrame:
    """``(keys, x0, y0, x1, y1)`` as doubles."""
    lo, hi = (lambda c: F.least(f"{c}0", f"{c}1")), (lambda c: F.greatest(f"{c}0", f"{c}1"))
    return edges.groupBy(*keys).agg(*[f(g(c)).cast("double").alias(f"{prefix}{c}{i}") for i, f, g in ((0, F.min, lo), (1, F.max, hi)) for c in "xy"])


def _in_strips(edges: DataFrame, key: str, width: float, p: str) -> DataFrame:
    """Edges cut at multiples of ``width``: (key, strip, {p}u, {p}v, {p}yu, {p}yv, {p}s), u < v; s is 1 where the shape is below. Upright edges bound
    no area and go."""
    d = edges.where("x0 <> x1")
    lo = lambda a, b: F.when(F.col("x0") < F.col("x1"), F.col(a)).otherwise(F.col(b)).cast("double")
    d = d.select(key, lo("x0", "x1").alias("_u"), lo("x1", "x0").alias("_v"), lo("y0", "y1").alias("_yu"), lo("y1", "y0").alias("_yv"), F.when(F.col("x0") > F.col("x1"), 1).otherwise(-1).alias(f"{p}s"))
    d = d.withColumn("strip", F.explode(F.sequence(F.floor(F.col("_u") / width), F.ceil(F.col("_v") / width) - 1)))
    u, v = F.greatest("_u", F.col("strip") * F.lit(width)), F.least("_v", (F.col("strip") + 1) * F.lit(width))
    at = lambda x: F.col("_yu") + (F.col("_yv") - F.col("_yu")) * (x - F.col("_u")) / (F.col("_v") - F.col("_u"))
    return d.select(key, "strip", u.alias(f"{p}u"), v.alias(f"{p}v"), at(u).alias(f"{p}yu"), at(v).alias(f"{p}yv"), f"{p}s")


def _cell(a: DataFrame, b: DataFrame) -> float:
    """Side of the grid cells in which boxes of two tables meet: twice their mean span."""
    span = lambda d, p: d.select(F.greatest(F.col(f"{p}x1") - F.col(f"{p}x0"), F.col(f"{p}y1") - F.col(f"{p}y0")).alias("d"))
    return max(1.0, 2.0 * (span(a, "a_").unionByName(span(b, "b_")).agg(F.avg("d")).first()[0] or 1.0))


def centres(edges: DataFrame, by: list[str]) -> DataFrame:
    """``(by, area, cx, cy)``: shapes' areas and centres of mass."""
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1"))
    cross = x0 * y1 - x1 * y0
    s = edges.groupBy(*by).agg(F.sum(cross).alias("_a"), F.sum(cross * (x0 + x1)).alias("_x"), F.sum(cross * (y0 + y1)).alias("_y"))
    return s.select(*by, (F.col("_a") / 2).alias("area"), (F.col("_x") / (3 * F.col("_a"))).alias("cx"), (F.col("_y") / (3 * F.col("_a"))).alias("cy"))


def common_areas(a: DataFrame, b: DataFrame, a_key: str = "a", b_key: str = "b", width: float | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """``(a, b, area)`` of pairs of shapes of two layers that share area, of any form, holes included; of those of ``pairs`` (a, b) only, if given.

    A shape is the signed sum of the areas below its edges, so two shapes share the signed sum, over pairs of their edges that lie over one another,
    of the area below both: the integral of the lower one, in closed form. Less than 10^-9 of what their boxes share is rounding. Edges are cut at strips of ``width`` (four mean edges
    if not given) and meet in the strips that the pair's boxes share; no point is located and no crossing is chained."""
    from quorumlake.operators.spatial import box_join, overlap_area

    stage = Stage(a.sparkSession, "common")
    both = a.select((F.col("x1") - F.col("x0")).alias("d")).unionByName(b.select((F.col("x1") - F.col("x0")).alias("d")))
    mean = both.agg(F.avg(F.abs("d"))).first()[0]
    width = width or max(1.0, 4.0 * (mean or 1.0))
    ba, bb = stage.put(boxes(a, [a_key], "a_"), "a"), stage.put(boxes(b, [b_key], "b_"), "b")
    if pairs is not None:
        met = pairs.join(ba, a_key).join(bb, b_key).withColumn("area", overlap_area("a_", "b_")).where("area > 0")
    else:
        met = box_join(ba, bb, _cell(ba, bb))
    lo, hi, base = F.greatest("a_x0", "b_x0"), F.least("a_x1", "b_x1"), F.greatest("a_y0", "b_y0")
    pairs = met.select(a_key, b_key, base.alias("base"), F.col("area").alias("boxed"), F.explode(F.sequence(F.floor(lo / width), F.ceil(hi / width) - 1)).alias("strip"))
    pairs = stage.put(pairs, "pairs")
    met = pairs.join(_in_strips(a, a_key, width, "e"), [a_key, "strip"]).join(_in_strips(b, b_key, width, "f"), [b_key, "strip"])
    u, v = F.greatest("eu", "fu"), F.least("ev", "fv")
    met = met.where(u < v)
    y = lambda p, x: F.col(f"{p}yu") + (F.col(f"{p}yv") - F.col(f"{p}yu")) * (x - F.col(f"{p}u")) / (F.col(f"{p}v") - F.col(f"{p}u")) - F.col("base")
    met = met.select(a_key, b_key, "boxed", (F.col("es") * F.col("fs")).alias("s"), (v - u).alias("w"), y("e", u).alias("a0"), y("e", v).alias("a1"), y("f", u).alias("b0"), y("f", v).alias("b1"))
    gap0, gap1 = F.col("a0") - F.col("b0"), F.col("a1") - F.col("b1")
    low0, low1 = F.least("a0", "b0"), F.least("a1", "b1")
    part = gap0 / (gap0 - gap1)
    cross = F.col("a0") + (F.col("a1") - F.col("a0")) * part
    below = F.when(gap0 * gap1 < 0, part * (low0 + cross) / 2 + (1 - part) * (cross + low1) / 2).otherwise((low0 + low1) / 2)
    out = met.groupBy(a_key, b_key).agg(F.sum(F.col("s") * F.col("w") * below).alias("area"), F.first("boxed").alias("boxed"))
    return out.where(F.col("area") > 1e-9 * F.col("boxed")).drop("boxed")


# ---------------------------------------------------------------- repairs by common borders


def absorb(parts: DataFrame, pieces: DataFrame, least: float, rounds: int = 6) -> DataFrame:
    """``(id, owner)``: parts (id, area) of under ``least`` go to the neighbour with the longest common border, of equals to the smallest; in rounds, all small
    ones at once, until none is left that has a neighbour. A part that went brings its area to its owner."""
    stage = Stage(parts.sparkSession, "absorb")
    borders = stage.put(shared_borders(pieces), "borders")
    owner = stage.put(parts.select("id", F.col("id").alias("owner"), "area"), "owner")
    for _ in range(rounds):
        size = owner.groupBy("owner").agg(F.sum("area").alias("area"))
        named = owner.select("id", "owner")
        b = borders.join(named.toDF("a", "oa"), "a").join(named.toDF("b", "ob"), "b").where("oa <> ob")
        b = b.select(F.explode(F.array(F.struct(F.col("oa").alias("p"), F.col("ob").alias("q")), F.struct(F.col("ob").alias("p"), F.col("oa").alias("q")))).alias("_"), "length").select("_.*", "length")
        b = b.groupBy("p", "q").agg(F.sum("length").alias("length")).join(size.where(F.col("area") < least).select(F.col("owner").alias("p"), F.col("area").alias("own")), "p")
        move = b.join(size.toDF("q", "other"), "q").groupBy("p").agg(F.max(F.struct(F.round("length", 9).alias("length"), (-F.col("q")).alias("n"), "q", "own", "other")).alias("m"))
        # of two small ones that choose each other only the smaller (of equals the one with the larger id) goes
        move = stage.put(move.select("p", "m.q", "m.own", "m.other"), "move")
        back = move.select(F.col("q").alias("p"), F.col("p").alias("q"), F.lit(True).alias("mutual"))
        move = move.join(back, ["p", "q"], "left").where("mutual is null or own < other or (own = other and p > q)").select("p", "q")
        # who goes to one that goes too waits for the next round
        move = stage.put(move.join(move.select(F.col("p").alias("q")), "q", "left_anti"), "move")
        if move.isEmpty():
            break
        owner = stage.put(owner.join(move.withColumnRenamed("p", "owner"), "owner", "left").select("id", F.coalesce("q", "owner").alias("owner"), "area"), "owner")
        stage.drop("owner", keep_last=True)
    return owner.select("id", "owner")


def fill_holes(edges: DataFrame, key: str = "id", least: float = 0.0) -> DataFrame:
    """The layer with its holes of over ``least`` given to the shape with the longest border on them, of equals to the smallest: edges (key, ...). A
    hole is a ring of the whole layer's outline that runs clockwise."""
    with Scope(edges.sparkSession) as made:
        stage = Stage(edges.sparkSession, "holes")
        edges = stage.put(edges.select(key, "x0", "y0", "x1", "y1"), "edges")
        pieces = stage.put(border_pieces(edges, key), "pieces")
        one = F.when(F.col("left").isNull(), F.struct(F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x0").alias("x1"), F.col("y0").alias("y1"))).otherwise(F.struct("x0", "y0", "x1", "y1"))
        outer = pieces.where("left is null or right is null").select(one.alias("e"), F.coalesce("left", "right").alias(key), F.lit(0).alias("all")).select("all", key, "e.*")
        chained = stage.put(_rings_with(outer, key), "rings")
        holes = ring_sizes(chained, ["all"]).where(F.col("area") < -least).select("ring")
        owners = chained.join(holes, "ring").groupBy("ring", key).agg(F.sum(length()).alias("length"))
        owners = owners.groupBy("ring").agg(F.max(F.struct(F.round("length", 9).alias("length"), (-F.col(key)).alias("n"), F.col(key).alias("to"))).alias("m")).select("ring", F.col("m.to").alias("to"))
        filled = stage.put(chained.join(owners, "ring").select(F.col("to").alias(key), F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x0").alias("x1"), F.col("y0").alias("y1")), "filled")
        made.keep(edges, filled)
    return dissolve(edges.select(key, "x0", "y0", "x1", "y1").unionByName(filled), [key])


def _rings_with(outer: DataFrame, key: str) -> DataFrame:
    """Rings of the whole outline, each edge with the shape it belongs to."""
    stage = Stage(outer.sparkSession, "rings")
    e = stage.put(outer, "edges")
    return rings(e.select("all", "x0", "y0", "x1", "y1"), ["all"]).join(e.select(key, "x0", "y0", "x1", "y1"), ["x0", "y0", "x1", "y1"])
