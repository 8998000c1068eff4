import itertools
import random

import pytest
from pyspark.sql import functions as F

from quorumlake.operators import assignment as A
from quorumlake.operators import graph as G
from quorumlake.operators import spatial as V


def test_only_free_seat(spark):
    regions = spark.createDataFrame([("r1", "d1", 9), ("r2", "d1", 5), ("r3", "d2", 7)], "region string, district string, area int")
    seats = spark.createDataFrame([("s1", "d1"), ("s2", "d1"), ("s2", "d2")], "seat string, district string")
    got = {(r.region, r.seat) for r in A.only_free_seat(regions, seats).collect()}
    assert got == {("r3", "s2"), ("r1", "s1")}  # s2 is taken through d2, which leaves s1 alone in d1


def test_border_growth(spark):
    borders = spark.createDataFrame([("a", "b", 5), ("a", "c", 9), ("b", "d", 2), ("d", "e", 1)], "a string, b string, length int")
    start = spark.createDataFrame([("b", "B"), ("c", "C")], "unit string, label string")
    got = {r.unit: r.label for r in A.border_growth(borders, start).collect()}
    assert got == {"a": "C", "b": "B", "c": "C", "d": "B", "e": "B"}


def test_least_cost(spark):
    r = random.Random(1)
    for n, m in ((1, 1), (3, 3), (4, 6)):
        c = [[r.random() for _ in range(m)] for _ in range(n)]
        best = min(sum(c[i][p[i]] for i in range(n)) for p in itertools.permutations(range(m), n))
        got = A.least_cost(c)
        assert abs(sum(c[i][j] for i, j in enumerate(got)) - best) < 1e-12 and len(set(got)) == n
    d = spark.createDataFrame([("g", "x", "1", 1.0), ("g", "x", "2", 2.0), ("g", "y", "1", 1.0), ("g", "y", "2", 9.0)], "g string, left string, right string, cost double")
    assert {(r.left, r.right) for r in A.optimal_pairs(d, "g").collect()} == {("x", "2"), ("y", "1")}


def test_line_pairs_of_any_size(spark):
    """In order on a line: as cheap as the matrix has it, in groups over its bound, and an error where the sides differ in size."""
    left = spark.range(5000).selectExpr("id % 2 as g", "id as left", "id * 7919 % 10007 as v")
    right = spark.range(5000).selectExpr("id % 2 as g", "id as right", "id * 31 % 5003 as w")
    got = A.line_pairs(left, right, "g").groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("right").alias("m"), F.sum("cost").alias("c")).collect()
    for r in got:
        v, w = (sorted(i * a % b for i in range(r.g, 5000, 2)) for a, b in ((7919, 10007), (31, 5003)))
        assert (r.n, r.m, r.c) == (2500, 2500, sum(abs(x - y) for x, y in zip(v, w)))
    a, b = left.where("left < 14"), right.where("right < 14")
    best = A.optimal_pairs(a.join(b, "g").selectExpr("g", "left", "right", "double(abs(v - w)) as cost"), "g").join(a, ["g", "left"]).join(b, ["g", "right"])
    assert best.selectExpr("sum(abs(v - w)) as c").first().c == A.line_pairs(a, b, "g").agg(F.sum("cost").alias("c")).first().c
    with pytest.raises(Exception, match="differ in size"):
        A.line_pairs(a, b.where("right > 0"), "g").collect()


def test_slivers_holes_and_lobes(spark):
    cells = [(x, y, None if (x, y) in ((2, 2), (0, 5)) else 7 if (x, y) == (4, 4) else 0 if x < 5 else 1) for x in range(9) for y in range(6)]
    df = spark.createDataFrame(cells, "ix int, iy int, label int")
    holes = {(r.ix, r.iy): r.label for r in V.fill_holes(df).collect()}
    assert holes[2, 2] == 0 and holes[0, 5] is None and holes[4, 4] == 7
    small = {(r.ix, r.iy): r.label for r in V.absorb_slivers(df.where("label is not null"), 2).collect()}
    assert small[4, 4] == 0
    lobes = spark.createDataFrame([(x, 0, 3) for x in (0, 1, 2, 5)] + [(3, 0, 4), (4, 0, 4)], "ix int, iy int, label int")
    to = spark.createDataFrame([(3, 4)], "label int, receiver int")
    assert {r.ix: r.label for r in V.detached_lobes(lobes, to).collect()} == {0: 3, 1: 3, 2: 3, 3: 4, 4: 4, 5: 4}


def test_ids_and_families(spark):
    groups = spark.createDataFrame([(["a", "b"],), (["b", "c"],), (["x", "y"],)], "ids array<string>")
    live = spark.createDataFrame([("b",), ("c",)], "id string")
    r = G.resolve_ids(groups, live)
    assert {x.id: x.resolved for x in r.collect()} == {"a": "b", "b": "b", "c": "b", "x": None, "y": None}
    edges = spark.createDataFrame([("f", "a", "q", "son"), ("f", "a", "c", "self"), ("f", "b", "q", "son")], "family string, a string, b string, rel string")
    people = spark.createDataFrame([("b", "Bee", 3)], "id string, name string, wins int")
    nodes, kept = G.family_graph(edges, people, r)
    assert {(n.id, n.name, n.wins, n.known) for n in nodes.collect()} == {("b", "Bee", 3, True), ("q", None, 0, False)}
    assert [(e.a, e.b) for e in kept.collect()] == [("b", "q")]
