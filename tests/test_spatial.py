import random

import numpy as np
from pyspark.sql import functions as F

from quorumlake.operators import quality as Q
from quorumlake.operators import spatial as V

BOX = "x0 double, y0 double, x1 double, y1 double"


def boxes(spark, p, rows):
    d = spark.createDataFrame(rows, f"id int, {BOX}")
    return d.select(F.col("id").alias(f"{p}id"), *[F.col(c).alias(p + c) for c in V.BOX])


def test_box_join_against_brute_force(spark):
    r = random.Random(1)
    make = lambda n: [(i, x := r.uniform(-20, 20), y := r.uniform(-20, 20), x + r.uniform(0, 12), y + r.uniform(0, 12)) for i in range(n)]
    a, b = make(40), make(40)
    got = {(x.a_id, x.b_id): round(x.area, 9) for x in V.box_join(boxes(spark, "a_", a), boxes(spark, "b_", b), 5.0).collect()}
    area = lambda p, q: max(0, min(p[3], q[3]) - max(p[1], q[1])) * max(0, min(p[4], q[4]) - max(p[2], q[2]))
    assert got == {(p[0], q[0]): round(area(p, q), 9) for p in a for q in b if area(p, q) > 0}


def test_apportionment(spark):
    j = V.box_join(boxes(spark, "a_", [(1, 5.0, 0.0, 15.0, 1.0)]), boxes(spark, "b_", [(7, 0.0, 0.0, 10.0, 1.0)]), 10.0)
    j = j.select(F.col("a_id").alias("t"), F.col("b_id").alias("s"), "area", F.lit(10.0).alias("whole"), F.lit(100.0).alias("w"))
    tally = spark.createDataFrame([(7, "p", 1), (7, "q", 1)], "s int, party string, n int")
    got = {r.party: r.votes for r in V.apportion(j, "t", "s", "area", "whole", "w", tally).collect()}
    assert got == {"p": 25.0, "q": 25.0}


def test_capacity(spark):
    cells = spark.createDataFrame([(i, float(i), 0.0) for i in range(400)], "cell_id int, x double, y double")
    seeds = spark.createDataFrame([("a", 0.0, 0.0, 0.75), ("b", 399.0, 0.0, 0.25)], "label string, x double, y double, quota double")
    got = {r.label: r["count"] for r in V.capacity_allocate(cells, seeds).groupBy("label").count().collect()}
    assert abs(got["a"] - 300) <= 2 and got["a"] + got["b"] == 400


def test_contiguity(spark):
    cells = [(x, y, 1 if (x, y) == (1, 1) else 0 if x < 5 else 1) for x in range(10) for y in range(6)]
    df = spark.createDataFrame(cells, "ix int, iy int, label int")
    got = {(r.ix, r.iy): r.label for r in V.contiguity_repair(df).collect()}
    assert got == {(x, y): 0 if x < 5 else 1 for x, y, _ in cells}
    b = V.shared_borders(df.where("ix > 1")).first()
    assert (b.a, b.b, b.length) == (0, 1, 6)


def test_rings(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 3), (0, 3))])
    r = spark.range(1).select(
        V.ring_area(ring).alias("a"), V.ring_area(V.clockwise(ring)).alias("c"), V.ring_box(ring).alias("b"), V.centroid(ring).alias("m"),
        V.inside(ring, F.lit(1.0), F.lit(1.0)).alias("i"), V.inside(ring, F.lit(5.0), F.lit(1.0)).alias("o"),
    ).first()
    assert (r.a, r.c, r.b.x1, r.m.x, r.m.y, r.i, r.o) == (12.0, -12.0, 4.0, 2.0, 1.5, True, False)
    tri = V.clip_convex(np.array([[0, 0], [4, 0], [0, 4]], float), np.array([[0, 0], [2, 0], [2, 2], [0, 2]], float))
    x, y = tri.T
    assert abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2) == 4.0
    assert len(V.clip_convex(np.array([[9, 9], [10, 9], [9, 10]], float), np.array([[0, 0], [1, 0], [1, 1]], float))) == 0


def test_nearest_and_kmeans(spark):
    p = spark.createDataFrame([(i, float(i), 0.0) for i in range(10)], "id int, x double, y double")
    a = spark.createDataFrame([("l", 0.0, 0.0), ("r", 8.0, 0.0)], "label string, x double, y double")
    got = {r.id: r.label for r in V.nearest(p, a, "id", "label").collect()}
    assert got == {i: "l" if i <= 4 else "r" for i in range(10)}  # a tie goes to the smaller label
    k = V.kmeans(spark.createDataFrame([(i, float(i % 2) * 100 + i / 10, 0.0) for i in range(20)], "id int, x double, y double"), 2, "id").collect()
    assert len({(r.id % 2, r.seed) for r in k}) == 2


def test_checks(spark):
    df = spark.createDataFrame([(1,), (3,)], "n int")
    assert [r.n for r in Q.gaps(df, "n", 1, 4).orderBy("n").collect()] == [2, 4]
    f = spark.createDataFrame([(10, 5, 16, 3, 4, 7, 9), (10, 5, 15, 3, 4, 8, 11), (None, 5, 15, 3, 4, 7, 1)], "valid_votes int, rejected_votes int, polled_total int, reg_male int, reg_female int, reg_total int, winner_votes int")
    assert [r.v for r in f.select(Q.ballot_flags().alias("v")).collect()] == [["polled"], ["registered", "winner"], []]
    a, b = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, a string"), spark.createDataFrame([(1, "x"), (2, "z"), (3, None)], "k int, b string")
    r = Q.agreement(a, b, ["k"], "a", "b").first()
    assert (r.checked, r.agree, r.rate) == (3, 1, 33.3) and Q.disagreements(a, b, ["k"], "a", "b").count() == 2
    try:
        Q.exactly(df, 3)
    except ValueError:
        return
    raise AssertionError("a wrong count passed")
