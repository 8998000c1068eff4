import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumlake.operators import fitting as T


def test_relational_fits(spark):
    pairs = spark.createDataFrame([(k, x, y, 2 * x - y + 5, x + 2 * y - 1) for k in (1, 2) for x, y in ((0.0, 0.0), (1.0, 0.0), (0.0, 2.0), (3.0, 1.0))] + [(3, 1.0, 1.0, 2.0, 2.0)], "k int, x double, y double, u double, v double")
    got = {r.k: r for r in T.anchor_similarity(pairs, ["k"]).collect()}
    assert [got[1][c] for c in ("a", "b", "tx", "ty", "rms")] == pytest.approx([2, 1, 5, -1, 0], abs=1e-6) and got[3].a is None
    labels = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", "b"), ("s", "far"), ("s", "none")], "sheet string, unit string")
    places = spark.createDataFrame([("a", 70.0, 30.0), ("b", 70.5, 30.5), ("far", 75.0, 30.0)], "unit string, lon double, lat double")
    assert sorted((r.unit, r.kept) for r in T.majority_cluster(labels, places, "sheet", "unit").collect()) == [("a", True), ("a", True), ("b", True), ("far", False), ("none", False)]
    seats = spark.createDataFrame([("r", "1", 1.0, None, 5.0), ("r", "2", 2.0, 3.0, 5.0), ("q", "3", None, 3.0, 5.0), ("t", "4", None, None, 5.0), ("t", "5", None, 4.0, 6.0), ("u", "6", None, None, 7.0), ("u", "7", None, None, 7.0)], "region string, seat string, own double, earlier double, district double")
    got = {r.seat: (r.source, r.seed) for r in T.seed_cascade(seats, "region", "own", "earlier", "district").collect()}
    assert got == {"1": ("own", 1), "2": ("own", 2), "3": ("earlier", 3), "4": ("district", 5), "5": ("district", 6), "6": ("kmeans", None), "7": ("kmeans", None)}


def test_projection(spark):
    e, n = T.utm(F.col("lon"), F.col("lat"), 42)
    row = spark.createDataFrame([(67.0, 24.86)], "lon double, lat double").select(e.alias("e"), n.alias("n"), T.utm_zone(F.col("lon")).alias("z")).first()
    # a degree and a half east of the central meridian 69: two degrees west here
    assert row.z == 42 and row.n == pytest.approx(2751000, abs=3000) and row.e == pytest.approx(500000 - 2 * 111319.49 * np.cos(np.radians(24.86)) * 0.9996, abs=400)
    row = spark.createDataFrame([(69.0, 0.0)], "lon double, lat double").select(e.alias("e"), n.alias("n")).first()
    assert (row.e, row.n) == pytest.approx((500000, 0))
