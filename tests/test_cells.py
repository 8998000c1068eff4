import random
import struct
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quorumlake.operators import cells as C
from quorumlake.operators import graph as G
from quorumlake.operators import layers as M
from tests.test_layers import box, layer, ring


def grid(seed, w, h, kinds):
    r = random.Random(seed)
    return {(x, y): r.choice(kinds) for x in range(w) for y in range(h)}


def table(spark, g):
    return spark.createDataFrame([(1, y, x, k) for (x, y), k in g.items()], "id int, y int, x int, label int")


@pytest.mark.parametrize("diagonal", [False, True])
def test_components_across_tiles(spark, monkeypatch, diagonal):
    monkeypatch.setattr(C, "TILE", 7)
    g = grid(3, 40, 12, [None, 0, 1])
    near = [(1, 0), (-1, 0), (0, 1), (0, -1)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if diagonal else [])
    seen, want = set(), Counter()
    for c, k in g.items():
        if k is None or c in seen:
            continue
        todo, part = [c], set()
        while todo:
            p = todo.pop()
            if p not in part:
                part.add(p)
                todo += [q for dx, dy in near if g.get(q := (p[0] + dx, p[1] + dy)) == k]
        seen |= part
        xs, ys = [x for x, _ in part], [y for _, y in part]
        want[k, len(part), min(xs), min(ys), max(xs), max(ys), round(sum(xs) / len(part), 6)] += 1
    parts = C.components(C.runs(table(spark, g), ["id"]), ["id"], diagonal=diagonal)
    assert Counter((s.label, s.cells, s.x0, s.y0, s.x1, s.y1, round(s.cx, 6)) for s in C.sizes(parts, ["id", "label"]).collect()) == want
    few = C.sizes(C.large(parts, ["id"], 3, 0.5, "label"), ["id", "label"]).collect()
    top = {k: max(n for j, n, *_ in want if j == k) for k in (0, 1)}
    assert Counter((s.label, s.cells) for s in few) == Counter({x: n for x, n in Counter((k, n) for k, n, *_ in want.elements()).items() if x[1] >= max(3, top[x[0]] / 2)})


@pytest.mark.parametrize("kinds", [[None, 0, 1], [0, 0, 0, 1], ["a", "b", "c", None]])
def test_blocks_change_no_part_and_no_outline(spark, monkeypatch, kinds):
    """Parts and outlines are the same whether a block holds all cells or few of them; runs that no tile cut are whole; repeated cells count once."""
    g = grid(11, 60, 30, kinds)
    rows = [(1, y - 9, x - 21, k) for (x, y), k in g.items()]
    t = spark.createDataFrame(rows + rows[:50], f"id int, y int, x int, label {'string' if 'a' in kinds else 'int'}")
    found = []
    for tile, band in ((256, 64), (7, 4), (5, 1)):
        monkeypatch.setattr(C, "TILE", 256)
        r = C.runs(t, ["id"])
        monkeypatch.setattr(C, "TILE", tile)
        monkeypatch.setattr(C, "BAND", band)
        parts = C.sizes(C.components(r, ["id"]), ["id", "label"]).drop("part").collect()
        found.append((sorted(map(tuple, parts)), sorted(map(tuple, C.outlines(r, ["id", "label"]).collect()))))
    assert found[0] == found[1] == found[2] and sum(p[2] for p in found[0][0]) == sum(k is not None for k in g.values())


def test_little_is_shuffled_of_an_image(spark, monkeypatch):
    """Runs need one shuffle of the cells, none if these lie by rows; what meets beyond blocks is what lies at their borders."""
    cells = spark.range(400 * 300).selectExpr("id div 400 y", "id % 400 x", "(hash(id) & 255) % 3 label")
    shuffles = lambda d: d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles(C.runs(cells, [])) == 1 and shuffles(C.runs(cells.repartition(4, "y"), [])) == 1
    seen = []
    monkeypatch.setattr(C, "connected_components", lambda e, *a: seen.append(e.count()) or G.connected_components(e, *a))
    r = C.runs(cells, [])
    C.components(r, []).count()
    assert seen[0] < r.count() / 3


def test_contours_scanlines_and_overlaps(spark, monkeypatch):
    """Outlines of a mask drawn as scanlines give the mask again; cells in common as counted; what lies near a core."""
    monkeypatch.setattr(C, "TILE", 5)
    g = grid(5, 23, 17, [None, 2, 2])
    r = C.runs(table(spark, g), ["id"])
    e = C.outlines(r, ["id"])
    drawn = {(x, s.y) for s in C.rasterised(e, ["id"]).collect() for x in range(s.x0, s.x1 + 1)}
    assert drawn == {c for c, k in g.items() if k is not None}
    assert sum(a.area for a in M.areas(e, ["id"]).collect()) == len(drawn)
    half = C.rasterised(layer(spark, [(1, [ring((0, 0), (20, 0), (0, 20))])]), ["id"])
    other = C.shared(r.withColumn("a", F.lit(1)), half.withColumn("b", F.lit(1)), ["id"], "a", "b").first()
    assert other.cells == sum(x + y < 19 for x, y in drawn) and half.agg(F.sum(F.col("x1") - F.col("x0") + 1)).first()[0] == 190
    shots = spark.createDataFrame([(1, y, x, 1) for y in range(3) for x in (0, 1, 2, 9, 10)] + [(1, 9, 30, 1)], "id int, y int, x int, label int")
    parts = C.components(C.runs(shots, ["id"]), ["id"])
    core = C.runs(spark.createDataFrame([(1, 1, 3, 1), (1, 1, 11, 1)], "id int, y int, x int, label int"), ["id"])
    assert C.embedded(parts, core, ["id"], 1).count() == 0
    assert {(s.x0, s.cells) for s in C.sizes(C.embedded(parts, core, ["id"], 2), ["id"]).collect()} == {(0, 9), (9, 6)}
    lines = spark.createDataFrame([(1, y, x) for y in (3, 4, 12) for x in range(20 if y != 4 else 18)] + [(1, 8, 1)], "id int, y int, x int")
    assert [(p["at"], p.cells) for p in C.peaks(lines, ["id"], "y", 0.5, 3).orderBy("at").collect()] == [(3, 20), (12, 20)]


def test_nearest_class(spark):
    g = grid(9, 15, 11, [0, 1, 2])
    r = random.Random(2)
    seeds = [(i, r.randrange(15), r.randrange(11), i % 2) for i in range(9)]
    c = spark.createDataFrame([(x, y, k) for (x, y), k in g.items()], "x int, y int, d int")
    got = {(q.x, q.y): q.label for q in C.nearest_class(c, spark.createDataFrame(seeds, "label int, x int, y int, d int"), within=["d"]).collect()}
    assert got == {(x, y): min((((x - a) ** 2 + (y - b) ** 2, i) for i, a, b, d in seeds if d == k), default=(0, None))[1] for (x, y), k in g.items()}


def test_images(spark, tmp_path):
    line = b"\0" + bytes((10, 20, 30)) * 6
    data = line * 3 + line[:-3] + bytes((200, 0, 0))
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 6, 4, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(data)) + chunk(b"IEND", b"")
    (tmp_path / "a.png").write_bytes(png)
    (tmp_path / "b.png").write_bytes(b"junk")
    d = C.images(spark, str(tmp_path))
    assert sorted((i.height, i.width) for i in d.collect() if i.height) == [(4, 6)] and d.count() == 2
    p = C.pixels(d)
    assert Counter((q.r, q.g, q.b) for q in p.collect()) == {(10, 20, 30): 23, (200, 0, 0): 1}
    h = p.where("x = 5 and y = 3").select(*[v.alias(k) for k, v in C.hsv(F.col("r"), F.col("g"), F.col("b")).items()]).first()
    assert (h.hue, h.saturation, h.value) == (0, 255, 200)


def test_basins_against_growing_one_by_one(spark):
    r = random.Random(6)
    nodes, heights = range(60), list(range(60))
    r.shuffle(heights)
    edges = [(i, j, max(heights[i], heights[j])) for i in nodes for j in (i + 1, i + 8) if j < 56 and (j != i + 1 or j % 8)] + [(57, 58, 3), (3, 3, 0)]
    seeds = {0: "a", 20: "b", 55: "c"}
    own = dict(seeds)
    while True:
        open_ = [((w, min(i, j), max(i, j)), q, own[p]) for i, j, w in edges for p, q in ((i, j), (j, i)) if p in own and q not in own]
        if not open_:
            break
        _, q, label = min(open_)
        own[q] = label
    got = G.basins(spark.createDataFrame(edges, "a int, b int, w int"), spark.createDataFrame(list(seeds.items()), "node int, label string")).collect()
    assert {g.node: g.label for g in got} == {n: own.get(n) for n in {*range(56), 57, 58}}


def test_basins_follow_long_chains_of_picks(spark, monkeypatch):
    """Every node of a long path picks the next one: followed by pointer jumping, not by rounds of components."""
    monkeypatch.setattr(G, "connected_components", None)
    edges = [(i, i + 1, i) for i in range(90)] + [(200, 201, 5), (201, 202, 5), (300, 301, 1)]
    seeds = spark.createDataFrame([(0, "a"), (90, "b"), (202, "c")], "node int, label string")
    got = {r.node: r.label for r in G.basins(spark.createDataFrame(edges, "a int, b int, w int"), seeds).collect()}
    assert got == {i: "a" for i in range(90)} | {90: "b", 200: "c", 201: "c", 202: "c", 300: None, 301: None}
