import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumlake.operators import layers as M

EDGES = "id long, x0 long, y0 long, x1 long, y1 long"


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def box(x0, y0, x1, y1):
    return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))


def layer(spark, shapes):
    df = spark.createDataFrame([(i, r) for i, r in shapes], "id long, rings array<array<struct<x:double,y:double>>>")
    return M.edges_of(df, ["id"])


def points(df, by=()):
    return sorted(tuple(r[c] for c in (*by, "x0", "y0", "x1", "y1")) for r in df.collect())


def test_edges_run_with_the_shape_on_their_left(spark):
    hole = box(1, 1, 2, 2)
    e = layer(spark, [(1, [box(0, 0, 4, 4), hole]), (2, [list(reversed(box(4, 0, 6, 4)))]), (3, [ring((0, 0), (1, 1))]), (4, None), (5, [box(7, 7, 7, 9)])])
    assert {r.id: r.area for r in M.areas(e, ["id"]).collect()} == {1: 15.0, 2: 8.0}
    closed = layer(spark, [(1, [[*box(0, 0, 4, 4), {"x": 0.0, "y": 0.0}]])])
    assert closed.count() == 4
    with pytest.raises(Exception, match="beyond"):
        M.dissolve(layer(spark, [(1, [box(0, 0, 1 << 25, 1)])]), ["id"]).collect()


def test_dissolve_of_unequal_neighbours(spark):
    """A long edge faces three short ones; a hole stays; corners that touch keep their rings apart; overlaps are refused."""
    e = layer(spark, [(1, [box(0, 0, 9, 3)]), (2, [box(0, 3, 3, 6)]), (3, [box(3, 3, 6, 6)]), (4, [box(6, 3, 9, 6)])]).withColumn("g", F.lit(1))
    assert points(M.dissolve(e, ["g"])) == [(0, 0, 9, 0), (0, 6, 0, 0), (9, 0, 9, 6), (9, 6, 0, 6)]
    around = [(i, [box(x, y, x + 1, y + 1)]) for i, (x, y) in enumerate([(0, 0), (1, 0), (2, 0), (0, 1), (2, 1), (0, 2), (1, 2), (2, 2), (3, 3)])]
    e = layer(spark, around).withColumn("g", F.lit(None).cast("int"))
    sizes = M.ring_sizes(M.rings(M.dissolve(e, ["g"]), ["g"]), ["g"])
    assert sorted(r.area for r in sizes.collect()) == [-1.0, 1.0, 9.0]
    with pytest.raises(Exception, match="overlap"):
        M.dissolve(layer(spark, [(1, [box(0, 0, 2, 2)]), (2, [box(1, 0, 3, 2)])]).withColumn("g", F.lit(1)), ["g"]).collect()
    with pytest.raises(Exception, match="overlap"):
        M.border_pieces(layer(spark, [(1, [box(0, 0, 2, 2)]), (2, [box(0, 0, 2, 2)])])).collect()


def test_random_map_against_its_cells(spark):
    """Cells of random labels on a sheared grid: areas, rings, outlines and common borders as the cells' own."""
    r = random.Random(4)
    n = 14
    label = {(x, y): r.randrange(3) for x in range(n) for y in range(n)}
    at = lambda u, v: (3 * u + v, 2 * v - u)
    shapes = [(x * n + y, [ring(at(x, y), at(x + 1, y), at(x + 1, y + 1), at(x, y + 1))]) for x, y in label]
    of = spark.createDataFrame([(x * n + y, k) for (x, y), k in label.items()], "id long, g int")
    e = layer(spark, shapes).join(of, "id")
    sizes = M.ring_sizes(M.rings(M.dissolve(e, ["g"]), ["g"]), ["g"]).collect()
    seen, parts = set(), defaultdict(int)
    for c in label:
        if c not in seen:
            parts[label[c]] += 1
            todo = [c]
            while todo:
                x, y = todo.pop()
                if (x, y) in seen:
                    continue
                seen.add((x, y))
                todo += [b for b in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)) if label.get(b) == label[c]]
    for g in range(3):
        mine = [s for s in sizes if s.g == g]
        assert sum(s.area for s in mine) == 7.0 * sum(k == g for k in label.values())
        assert sum(s.area > 0 for s in mine) == parts[g]
    want = defaultdict(float)
    for (x, y), k in label.items():
        for b, w in (((x + 1, y), math.sqrt(5)), ((x, y + 1), math.sqrt(10))):
            if b in label and label[b] != k:
                want[tuple(sorted((k, label[b])))] += w
    borders = M.shared_borders(M.border_pieces(M.dissolve(e, ["g"]).withColumnRenamed("g", "id")))
    assert {(b.a, b.b): pytest.approx(b.length) for b in borders.collect()} == dict(want)


@pytest.mark.parametrize("parts", [1, 5])
def test_lists_and_circles(spark, parts):
    r = random.Random(parts)
    ids, links, want = list(range(100, 700)), [], {}
    r.shuffle(ids)
    at = 0
    for n, closed in ((1, False), (1, True), (2, True), (3, False), (17, True), (64, True), (65, False), (200, False)):
        mine, at = ids[at : at + n], at + n
        links += [(a, b) for a, b in zip(mine, mine[1:])] + [(mine[-1], mine[0] if closed else None)]
        first = mine.index(min(mine))
        want |= {i: (min(mine) if closed else mine[-1], closed, (k - first) % n if closed else k) for k, i in enumerate(mine)}
    got = M.list_ranks(spark.createDataFrame(links, "id long, nxt long").repartition(parts)).collect()
    by = defaultdict(list)
    for g in got:
        by[g.list, g.closed].append((g["at"], g.id))
    assert {i: (k[0], k[1], n) for k, v in by.items() for n, (_, i) in enumerate(sorted(v))} == want


def distance(p, a, b):
    u = (b[0] - a[0], b[1] - a[1])
    t = max(0, min(1, ((p[0] - a[0]) * u[0] + (p[1] - a[1]) * u[1]) / ((u[0] ** 2 + u[1] ** 2) or 1)))
    return math.hypot(p[0] - a[0] - t * u[0], p[1] - a[1] - t * u[1])


def peucker(line, tolerance):
    if len(line) < 3:
        return line
    far = max(range(1, len(line) - 1), key=lambda i: (distance(line[i], line[0], line[-1]), -i))
    if distance(line[far], line[0], line[-1]) <= tolerance:
        return [line[0], line[-1]]
    return peucker(line[: far + 1], tolerance)[:-1] + peucker(line[far:], tolerance)


def test_simplified_once_for_both_sides(spark):
    """Two shapes along a jagged line: the line is an arc of its own, simplified as a plain recursion does, and both shapes have it."""
    r = random.Random(8)
    jag = [(50 + r.randrange(-9, 10), y) for y in range(0, 101, 2)]
    left, right = ring((0, 0), *jag, (0, 100)), ring((100, 100), *reversed(jag), (100, 0))
    p = M.border_pieces(layer(spark, [(1, [left]), (2, [right]), (3, [box(40, 200, 41, 201)])]))
    chained = M.arcs(p)
    assert {(s.left, s.right): s.n for s in chained.groupBy("left", "right").agg(F.countDistinct("arc").alias("n")).collect()} == {(1, 2): 1, (None, 1): 1, (None, 2): 1, (None, 3): 1}
    for tolerance in (0.0, 3.0, 8.0):
        s = M.simplify(chained, tolerance)
        mine = {(q.x0, q.y0) for q in s.where("left = 1 and right = 2").collect()} | {(q.x1, q.y1) for q in s.where("left = 1 and right = 2").collect()}
        assert mine == set(peucker(jag, tolerance))
        e = M.sides_of(s)
        ends = {(q.id, q.x0, q.y0, q.x1, q.y1) for q in e.collect()}
        assert {(2, x1, y1, x0, y0) for i, x0, y0, x1, y1 in ends if i == 1 and (x0, y0) in mine and (x1, y1) in mine} <= ends
        assert e.where("id = 3").count() >= 3  # a small ring does not vanish
        assert M.ring_sizes(M.rings(M.dissolve(e, ["id"]), ["id"]), ["id"]).count() == 3


def star(seed, n, at):
    g = np.random.default_rng(seed)
    a = np.sort(g.uniform(0, 2 * np.pi, n))
    d = g.uniform(100, 400, n)
    return [(round(at[0] + x), round(at[1] + y)) for x, y in zip(d * np.cos(a), d * np.sin(a))]


def inside(p, line):
    hit = False
    for a, b in zip(line, line[1:] + line[:1]):
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
            hit = not hit
    return hit


@pytest.mark.parametrize("width", [None, 37.0])
def test_common_areas_of_stars(spark, width):
    """Concave shapes against sampled points; strips of any width agree; a shape shares all of itself with itself."""
    a = {i: star(i, 11, (0, 0)) for i in range(3)}
    b = {i: star(i + 50, 9, (100 * i, 60)) for i in range(3)}
    ea = layer(spark, [(i, [ring(*s)]) for i, s in a.items()]).withColumnRenamed("id", "a")
    eb = layer(spark, [(i, [ring(*s)]) for i, s in b.items()]).withColumnRenamed("id", "b")
    got = {(r.a, r.b): r.area for r in M.common_areas(ea, eb, width=width).collect()}
    grid = [(x + 0.5, y + 0.5) for x in range(-400, 400, 8) for y in range(-400, 400, 8)]
    for (i, s), (j, t) in ((p, q) for p in a.items() for q in b.items()):
        assert got.get((i, j), 0) == pytest.approx(64 * sum(inside(p, s) and inside(p, t) for p in grid), rel=0.06, abs=600)
    own = {(r.a, r.b): r.area for r in M.common_areas(ea, ea.withColumnRenamed("a", "b"), width=width).collect()}
    assert all(own[r.a, r.a] == pytest.approx(r.area) for r in M.areas(ea, ["a"]).collect())
    assert M.common_areas(ea.limit(0), eb).count() == 0


def test_slivers_and_holes_go_to_the_longest_border(spark):
    shapes = [(1, [box(0, 0, 10, 10)]), (2, [box(10, 0, 20, 10)]), (3, [box(10, 10, 11, 12)]), (4, [box(9, 10, 10, 14)]), (5, [box(40, 40, 41, 41)])]
    p = M.border_pieces(layer(spark, shapes))
    parts = M.areas(layer(spark, shapes), ["id"])
    assert {r.id: r.owner for r in M.absorb(parts, p, 5.0).collect()} == {1: 1, 2: 2, 3: 4, 4: 4, 5: 5}  # a sliver beside a sliver makes one that is large enough
    frame = [(1, [box(0, 0, 6, 2)]), (2, [box(0, 4, 6, 6)]), (3, [box(0, 2, 2, 4)]), (4, [box(4, 2, 6, 4)])]
    filled = M.fill_holes(layer(spark, frame))
    assert {r.id: r.area for r in M.areas(filled, ["id"]).collect()} == {1: 16.0, 2: 12.0, 3: 4.0, 4: 4.0}  # all four borders are equal: the smallest
    assert {r.id: r.area for r in M.areas(M.fill_holes(layer(spark, frame), least=5.0), ["id"]).collect()} == {1: 12.0, 2: 12.0, 3: 4.0, 4: 4.0}


def test_straight_stretches_are_one_piece(spark):
    """Two rows of bricks, each row a shape of eight: their border is one piece, not one a brick; rows are dealt over the cores before they grow."""
    cells = [(k, [ring((2 * i, k), (2 * i + 2, k), (2 * i + 2, k + 1), (2 * i, k + 1))]) for k in (0, 1) for i in range(8)]
    d = spark.createDataFrame(cells, "id int, rings array<array<struct<x:double,y:double>>>")
    p = M.border_pieces(M.edges_of(d, ["id"])).collect()
    assert sorted((r.x0, r.x1) for r in p if r.left is not None and r.right is not None) == [(0, 16)] and len(p) == 7


def test_ranks_of_lists_that_leave_early(spark):
    """Short and long lists and circles at once: each is told apart and put in order."""
    links, n = [], 0
    for size in (1, 2, 3, 5, 8, 33, 150):
        for closed in (False, True):
            ids = list(range(n, n + size))
            n += size
            links += [(a, b) for a, b in zip(ids, ids[1:])] + [(ids[-1], ids[0] if closed else None)]
    got = {r.id: r for r in M.list_ranks(spark.createDataFrame(links, "id long, nxt long")).collect()}
    assert len(got) == n
    for a, b in links:
        assert got[a].closed == (b is not None and got[b].closed) or b is not None
        if b is not None:
            assert got[a].list == got[b].list and (got[a].at < got[b].at or b == got[b].list)
    assert len({r.list for r in got.values()}) == 14


def test_short_lists_are_not_carried_on(spark, monkeypatch):
    """A long list among short circles: the last rounds hold the long one alone."""
    sizes, put = [], M.Stage.put

    def noted(self, df, name):
        out = put(self, df, name)
        if name == "lists":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(M.Stage, "put", noted)
    links = [(3 * i + k, 3 * i + (k + 1) % 3) for i in range(100) for k in range(3)] + [(1000 + i, 1001 + i if i < 59 else None) for i in range(60)]
    got = M.list_ranks(spark.createDataFrame(links, "id long, nxt long")).collect()
    assert len(got) == 360 and len({r.list for r in got}) == 101 and sizes[-1] <= 60


def test_bricks_are_edges_at_once(spark):
    """Edges made without arrays are those of the boxes; borders of shapes whose edges lie together are dealt once, by their lines."""
    from quorumlake.plans import map_queries as Q
    from quorumlake.plans.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    u, v = F.col("u"), F.col("v")
    d = spark.range(900).select("id", (F.col("id") % 30).alias("u"), F.floor(F.col("id") / 30).alias("v"))
    boxes = M.edges_of(d.select("id", F.array(Q.box(u, v, u + 2, v + 1)).alias("rings")), ["id"])
    assert points(d.select("id", F.explode(Q.box_edges(u, v, u + 2, v + 1)).alias("e")).select("id", "e.*"), ["id"]) == points(boxes, ["id"])
    plan = M.border_pieces(Q.bricks(t))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # orders over cores, ends over lines


def test_arcs_of_one_piece_are_not_numbered(spark):
    """Two squares side by side: their common border is an arc of one piece, the outer borders have three each; without a tolerance all points stay."""
    p = M.border_pieces(layer(spark, [(1, [box(0, 0, 2, 3)]), (2, [box(2, 0, 4, 3)])]))
    rows = M.arcs(p).collect()
    assert {(r.left, r.right): r.alone for r in rows} == {(1, 2): True, (None, 1): False, (None, 2): False} and len({r.arc for r in rows}) == 3
    assert points(M.simplify(M.arcs(p), 0.0)) == sorted((r.x0, r.y0, r.x1, r.y1) for r in rows)
