import random

import pytest
from pyspark.sql import functions as F

from quorumlake.operators import near as D
from quorumlake.operators import overlay as X
from tests.test_layers import box, distance, layer, ring


@pytest.mark.parametrize("leaf", [1, 32])
@pytest.mark.parametrize("kind", ["even", "towns", "one place"])
def test_nearest_against_all(spark, monkeypatch, leaf, kind):
    """Points and segments, even or in towns, with ties, repeated things, missing places and groups without any."""
    monkeypatch.setattr(D, "LEAF", leaf)
    r = random.Random(leaf)
    place = {"even": lambda: r.uniform(0, 100), "towns": lambda: r.choice([0, 0, 0, 5000]) + r.gauss(0, 1), "one place": lambda: 7.0}[kind]
    things = [(i, i % 2, x := place(), y := place(), x + r.choice([0, 3]), y + r.choice([0, 1])) for i in range(150)]
    things += [(i + 1000, *t) for i, *t in things[:20]]
    spots = [(i, i % 3, place(), place()) for i in range(80)] + [(900, 0, None, 1.0), (901, 0, 3.0, 3.0), (901, 0, 3.0, 3.0)]
    items = spark.createDataFrame([*things, (5, 0, None, 1.0, 1.0, 1.0)], "label int, g int, x0 double, y0 double, x1 double, y1 double")
    points = spark.createDataFrame(spots, "id int, g int, x double, y double")
    for within in ([], ["g"]):
        got = sorted((p.id, p.label, round(p.d2, 6)) for p in D.nearest_of(points, items, "id", "label", within).collect())
        want = []
        for i, g, x, y in spots:
            near = [(distance((x, y), t[2:4], t[4:]) ** 2, t[0]) for t in things if x is not None and (not within or t[1] == g)]
            if near:
                d2, label = min(near)
                want.append((i, label, round(d2, 6)))
        assert [w[::2] for w in want and sorted(want)] == [g[::2] for g in got]
        assert sum(a != b for a, b in zip(sorted(want), got)) <= 1  # equal distances by another path of rounding
    assert D.nearest_of(points, items.limit(0), "id", "label").count() == 0


def test_containment_then_border(spark):
    e = layer(spark, [(1, [box(0, 0, 10, 10), box(4, 4, 6, 6)]), (2, [box(10, 0, 20, 10)]), (3, [ring((30, 0), (40, 0), (35, 10))])])
    spots = [(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 10.0, 5.0), (4, 25.0, 1.0), (5, 35.0, 5.0), (6, 100.0, 0.0), (7, None, 1.0), (8, 0.0, 0.0)]
    p = spark.createDataFrame(spots, "pid int, x double, y double")
    inside = {(r.pid, r.id) for r in D.containing(p, e, "pid", "id").collect()}
    assert inside == {(1, 1), (3, 2), (5, 3), (8, 1)}
    got = {r.pid: (r.id, round(r.d2, 6)) for r in D.placed(p, e, "pid", "id").collect()}
    assert got == {1: (1, 0), 2: (1, 1), 3: (2, 0), 4: (2, 25), 5: (3, 0), 6: (3, 3600), 8: (1, 0)}


def test_within_reach(spark):
    a = layer(spark, [(1, [box(0, 0, 100, 2)]), (2, [box(0, 50, 5, 55)])]).withColumnRenamed("id", "a")
    b = layer(spark, [(1, [box(90, 5, 95, 8)]), (2, [box(1, 51, 2, 52)]), (3, [box(50, -5, 52, 9)]), (4, [box(500, 0, 501, 1)])]).withColumnRenamed("id", "b")
    assert {tuple(r) for r in D.within_reach(a, b, "a", "b", 3.0).collect()} == {(1, 1), (2, 2), (1, 3)}
    assert {tuple(r) for r in D.within_reach(a, b, "a", "b", 2.9).collect()} == {(2, 2), (1, 3)}


def test_overlays(spark):
    """Slanted shapes that cross, a corner on an edge, edges along one another, one inside another, two that are equal."""
    shapes = [(1, [ring((0, 0), (12, 0), (6, 12))]), (2, [box(0, 0, 12, 6)]), (3, [box(2, 1, 4, 3)]), (4, [box(2, 1, 4, 3)]), (5, [ring((6, 12), (10, 14), (2, 14))])]
    p = X.arrangement(layer(spark, shapes))
    faces = {tuple(r.face): round(r.area, 6) for r in X.face_areas(p).collect()}
    assert faces == {(1,): 18.0, (1, 2): 50.0, (2,): 18.0, (1, 2, 3, 4): 4.0, (5,): 8.0}
    size = lambda d: {r.id: round(r.area, 6) for r in X.shapes_of(d).groupBy("id").agg((F.sum(F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0")) / 2).alias("area")).collect()}
    assert size(p) == {1: 72.0, 2: 72.0, 3: 4.0, 4: 4.0, 5: 8.0}
    assert size(X.intersection(p, 1))[2] == 54.0 and size(X.difference(p, 1))[2] == 18.0
    assert size(X.resolve_overlaps(p)) == {1: 72.0, 2: 18.0, 5: 8.0}  # the triangle has the longest outline


def test_snap_fills_open_parts(spark):
    """What the frame holds and no shape covers goes, part by part, to the longest border; a part around a shape keeps its hole."""
    shapes = [(1, [box(-5, 0, 10, 10)]), (2, [box(20, 2, 28, 8)]), (9, [box(0, 0, 30, 10)])]
    p = X.snapped(X.arrangement(layer(spark, shapes)), 9)
    size = {r.id: round(r.area, 6) for r in X.shapes_of(p).groupBy("id").agg((F.sum(F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0")) / 2).alias("area")).collect()}
    assert size == {1: 100.0, 2: 200.0}


def test_points_of_a_cell_go_down_together(spark, monkeypatch):
    """No staged table has a row a point, and points inside a ring of very many things, which gives pairs, have the nearest too."""
    import math

    from quorumlake.plans import staging

    sizes, put = [], staging.Stage.put

    def noted(self, df, name):
        out = put(self, df, name)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(staging.Stage, "put", noted)
    seeds = [(i, (i * 37 % 101) * 2, i * 53 % 97) for i in range(30)]
    items = spark.createDataFrame([(i, x, y, x, y) for i, x, y in seeds], "label int, x0 int, y0 int, x1 int, y1 int")
    cells = spark.range(20_000).selectExpr("id % 200 as x", "id div 200 as y")
    got = D.with_nearest(cells, items, "label").collect()
    assert len(got) == 20_000 and max(sizes) < 5_000
    for r in got[::97]:
        assert (r._d2, r.nearest) == min(((r.x - x) ** 2 + (r.y - y) ** 2, i) for i, x, y in seeds)
    ring = [(i, math.cos(i), math.sin(i)) for i in range(700)]
    items = spark.createDataFrame([(i, x, y, x, y) for i, x, y in ring], "label int, x0 double, y0 double, x1 double, y1 double")
    dots = [(0.0, 0.0), (1e-7, 0.0), (0.0, 1e-7), (3.0, 0.5), (None, 1.0)]
    got = {(r.x, r.y): r for r in D.with_nearest(spark.createDataFrame(dots, "x double, y double"), items, "label").collect()}
    assert len(got) == 5 and got[None, 1.0].nearest is None
    for a, b in dots[:-1]:
        d = got[a, b]._d2
        assert abs(d - min((a - x) ** 2 + (b - y) ** 2 for _, x, y in ring)) < 1e-12


def test_crossings_are_looked_for_once_a_line(spark):
    """Forty copies of a square over thirty of another: edges that lie on one line are one stretch, and the sets over each face are whole."""
    from quorumlake.operators import layers as M

    square = lambda x, y: [{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + 6, y), (x + 6, y + 6), (x, y + 6))]
    rows = [(i, [square(0, 0)]) for i in range(40)] + [(100 + i, [square(2, 3)]) for i in range(30)]
    e = M.edges_of(spark.createDataFrame(rows, "id long, rings array<array<struct<x:double,y:double>>>"), ["id"])
    lines = X._stretches(M._on_lines(e))
    assert sorted((r.x0, r.y0, r.x1, r.y1) for r in lines.collect()) == sorted([(0, 0, 6, 0), (0, 0, 0, 6), (6, 0, 6, 6), (0, 6, 6, 6), (2, 3, 8, 3), (2, 3, 2, 9), (8, 3, 8, 9), (2, 9, 8, 9)])
    faces = {tuple(r.face): r.area for r in X.face_areas(X.arrangement(e)).collect()}
    a, b = tuple(range(40)), tuple(range(100, 130))
    assert faces == {a: 24.0, b: 24.0, a + b: 12.0}


def test_equal_shapes_are_laid_once(spark, monkeypatch):
    """Copies of shapes meet points and other shapes once; each set gets all of them, the smallest holds a point. Shapes that share a hash and differ stay apart."""
    from quorumlake.operators import layers as M

    shapes = [(i, [box(0, 0, 6, 6)]) for i in range(5, 25)] + [(i, [box(2, 3, 8, 9)]) for i in range(40, 60)] + [(3, [box(2, 3, 8, 10)])]
    e = layer(spark, shapes)
    same = {r.id: r.first for r in M.equal_shapes(e).collect()}
    assert same == {i: 5 if i < 25 else 40 for i in [*range(5, 25), *range(40, 60)]} | {3: 3}
    laid, real = [], X._laid
    monkeypatch.setattr(X, "_laid", lambda d: laid.append(d.select("key").distinct().count()) or real(d))
    a, b = tuple(range(5, 25)), tuple(range(40, 60))
    want = {a: 24.0, (3, *b): 24.0, (3, *a, *b): 12.0, (3,): 6.0}
    assert {tuple(r.face): r.area for r in X.faces_of(e).collect()} == want
    assert {tuple(r.face): r.area for r in X.face_areas(X.arrangement(e)).collect()} == want and laid == [3, 3]
    asked, held = [], D.containing
    monkeypatch.setattr(D, "containing", lambda p, d, *how: asked.append(d.select("id").distinct().count()) or held(p, d, *how))
    p = spark.createDataFrame([(1, 1.0, 1.0), (2, 7.0, 8.0), (3, 7.0, 9.5), (4, -3.0, 1.0)], "pid int, x double, y double")
    assert {r.pid: (r.id, r.d2) for r in D.placed(p, e, "pid", "id").collect()} == {1: (5, 0), 2: (3, 0), 3: (3, 0), 4: (5, 9)} and asked == [3]
    monkeypatch.setattr(M.F, "xxhash64", lambda *c: M.F.lit(1))
    assert all(r.id == r.first for r in M.equal_shapes(e).collect())


@pytest.mark.parametrize("flat, held", [(8, 512), (2, 512), (2, 3)])
def test_points_meet_few_items_in_compiled_code(spark, monkeypatch, flat, held):
    """Of the items of a small cell those that another one beats in all of it go; the rest lie flat beside the points, as an array or in pairs: the same rows, ties included."""
    from quorumlake.plans import staging

    sizes, put = {}, staging.Stage.put

    def noted(self, df, name):
        out = put(self, df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(staging.Stage, "put", noted)
    monkeypatch.setattr(D, "FLAT", flat)
    monkeypatch.setattr(D, "HELD", held)
    r = random.Random(flat + held)
    seeds = [(i, 2 * r.randrange(60), 2 * r.randrange(30), i % 2) for i in range(150)]
    items = spark.createDataFrame([(i, x, y, x, y, g) for i, x, y, g in seeds], "label int, x0 int, y0 int, x1 int, y1 int, g int")
    cells = spark.range(7200).selectExpr("id % 120 as x", "id div 120 as y", "cast(id % 3 as int) as g").unionByName(spark.createDataFrame([(None, 1, 0)], "x long, y long, g int"))
    df = D.with_nearest(cells, items, "label", ["g"])
    if flat == 8:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "transform(" not in plan and "SortMergeJoin" not in plan
    got = [((q.x, q.y), (q._d2, q.nearest)) for q in df.collect()]
    of = {g: [t for t in seeds if t[3] == g] for g in range(3)}
    best = lambda i: min((((i % 120 - x) ** 2 + (i // 120 - y) ** 2, k) for k, x, y, _ in of[i % 3]), default=(None, None))
    want = {(i % 120, i // 120): best(i) for i in range(7200)}
    assert len(got) == 7201 and dict(got) == want | {(None, 1): (None, None)}
    assert sizes["met"] < 8 * sizes["blocks"]
    inner = D.with_nearest(cells, items, "label", ["g"], how="inner").collect()
    assert {(q.x, q.y): (q._d2, q.nearest) for q in inner} == {k: v for k, v in want.items() if v[1] is not None} and len(inner) == 4800


def test_least_distances_are_computed_once(spark):
    """The query's cells meet their seeds without functions of arrays, and no filter computes the distances over again."""
    from quorumlake.plans.catalog import QUERIES

    plan = QUERIES["nearest_class_fill"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "transform(" not in plan and "Filter isnotnull(least" not in plan


def test_no_cells_and_no_seeds(spark, tmp_path):
    """An image without orders, or without suppliers, has no cells with a seed."""
    from quorumlake.plans.catalog import QUERIES

    for empty in ("orders", "supplier"):
        for name in ("orders", "supplier"):
            d = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
            (d.limit(0) if name == empty else d).write.parquet(f"{tmp_path}/{empty}/{name}.parquet")
        assert QUERIES["nearest_class_fill"](spark, f"{tmp_path}/{empty}").count() == 0
