from pyspark.sql import functions as F

from quorumlake.operators import career as K
from quorumlake.operators import contest as C

CAND = "seat string, name string, party string, votes long, pos int"


def results(spark, rows, **how):
    df = spark.createDataFrame(rows, CAND)
    return {r.seat: r for r in C.results(df, ["seat"], "name", "party", "votes", ["pos"], **how).collect()}


def test_rank_ties_and_missing_votes(spark):
    df = spark.createDataFrame([("X", "a", "p", 100, 0), ("X", "b", "p", None, 1), ("X", "c", "q", 100, 2)], CAND)
    got = {r["name"]: r["rank"] for r in C.ranked(df, ["seat"], "votes", ["pos"]).collect()}
    assert got == {"a": 1, "c": 2, "b": 3}
    r = results(spark, [("X", "a", "p", 100, 0), ("X", "b", "p", None, 1), ("X", "c", "q", 100, 2)])["X"]
    assert (r.winner, r.margin, r.winner_share) == ("a", 0.0, 50.0)


def test_uncontested_and_zero_runner_up(spark):
    rows = [("Y", "sole", "p", None, 0), ("Z", "w", "p", 50, 1), ("Z", "r", "q", 0, 2)]
    got = results(spark, rows)
    assert (got["Y"].winner, got["Y"].winner_votes, got["Y"].winner_share, got["Y"].margin, got["Y"].n_candidates) == ("sole", None, None, None, 1)
    assert got["Z"].margin == 100.0 and results(spark, rows, zero_is_null=True)["Z"].margin is None


def test_keep_first_and_modes(spark):
    df = spark.createDataFrame([("s", "second", 2), ("s", "first", 1)], "k string, v string, pos int")
    assert C.keep_first(df, ["k"], ["pos"]).first().v == "first"
    m = spark.createDataFrame([("g", v, i) for i, v in enumerate("qpqp")], "g string, v string, pos int")
    assert C.mode_first(m, ["g"], "v", "pos").first().v == "q"
    t = spark.createDataFrame([("u", "p", 400), ("u", "p", 500), ("u", "q", 600), ("u", "q", 400), ("u", "r", 9000)], "u string, v string, m int")
    r = C.mode_tiebreak(t, ["u"], "v", "m").first()
    assert (r.v, r.tied) == ("q", True)


def test_weighted_mean_and_electorate(spark):
    df = spark.createDataFrame([("u", 50.0, 100), ("u", 90.0, None), ("u", 70.0, 0)], "u string, t double, reg int")
    assert df.groupBy("u").agg(C.weighted_mean(F.col("t"), F.col("reg")).alias("m")).first().m == 50.0
    e = spark.createDataFrame([("a", 10, None, None), ("a", None, 5, 50.0), ("b", None, 5, 50.0), ("b", None, None, None), ("c", None, None, None)], "u string, reg int, wv int, ws double")
    got = {r.u: r.electorate for r in C.electorate(e, ["u"], F.col("reg"), F.col("wv"), F.col("ws")).collect()}
    assert got == {"a": 10.0, "b": 10.0, "c": 100000.0}


def test_swings_follow_lineage(spark):
    s = spark.createDataFrame([(1, "old", 40.0), (1, "x", 60.0), (2, "new", 45.0), (2, "y", 55.0)], "t int, p string, v double")
    link = spark.createDataFrame([("new", "old")], "new string, old string")
    got = {r.p: r.swing for r in C.swings(s, "t", "p", "v", link).collect()}
    assert got == {"new": 5.0, "x": -60.0, "y": 55.0}


def test_null_order_and_natural_order(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "i int, v int")
    assert [r.i for r in df.orderBy(C.asc("v")).collect()] == [2, 3, 1]
    assert [r.i for r in df.orderBy(C.desc("v")).collect()] == [1, 3, 2]
    from quorumlake.functions.textnorm import seat_number

    na = spark.createDataFrame([("NA-10",), ("NA-2",), ("none",)], "na string")
    assert [r.na for r in na.orderBy(C.asc("na") if False else seat_number(F.col("na")).asc_nulls_last()).collect()] == ["NA-2", "NA-10", "none"]


def test_priority_layout_pairs(spark):
    a, b = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string")
    assert {(r.k, r.v, r.tier) for r in C.priority([a, b], ["k"]).collect()} == {(1, "a", 0), (2, "b", 1)}
    n = spark.createDataFrame([("x", 3), ("y", 2)], "p string, n int")
    assert {(r.p, r.start, r.end) for r in C.running_layout(n, ["p"], "n").collect()} == {("x", 0, 3), ("y", 3, 5)}
    left, right = spark.createDataFrame([("g", 1), ("g", 2)], "g string, l int"), spark.createDataFrame([("g", 9)], "g string, r int")
    assert [(r.l, r.r) for r in C.ordinal_pairs(left, right, ["g"], ["l"], ["r"]).collect()] == [(1, 9)]


def test_rounding_is_half_up(spark):
    r = spark.range(1).select(F.round(F.lit(0.25), 1).alias("a"), F.round(F.lit(2.675), 2).alias("b")).first()
    assert (r.a, r.b) == (0.3, 2.68)


def test_best_row_and_periods(spark):
    df = spark.createDataFrame([(1, 2000, "2", 0), (1, 2000, "1", 1), (1, 2004, "x", 2), (1, 2004, "5", 3)], "p int, y int, r string, pos int")
    got = {r.y: r.r for r in K.best_rows(df, "p", "y", F.col("r") == "1", "r", ["pos"]).collect()}
    assert got == {2000: "1", 2004: "5"}
    rows = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 1, "a"), (2, 2, "a")], "p int, n int, party string")
    s = K.steps(rows, "p", ["n"], ["n", "party"])
    assert s.count() == 2 and s.where("next_n = n + 1").count() == 1
    r = K.retention(s.where("next_n = n + 1"), "party", "next_party", ["n"], 1).first()
    assert (r.stayed, r.total, r.rate) == (1, 1, 1.0)


def test_turnover_and_persistence(spark):
    rows = spark.createDataFrame([(1, 1, True), (1, 2, True), (2, 1, True), (2, 3, True), (3, 2, True), (3, 1, False)], "p int, n int, won boolean")
    got = {r.n: (r.winners, r.ran_again, r.won_again, r.newcomers, r.rate) for r in K.turnover(rows, "p", "n", "won").collect()}
    assert got == {1: (2, 1, 1, 2, 1.0), 2: (2, 0, 0, 0, 0.0), 3: (1, 0, 0, 0, 0.0)}
    w = spark.createDataFrame([("g", "a")] * 3 + [("g", "b")], "g string, p string")
    r = K.persistence(w, ["g"], "p").first()
    assert (r.wins, r.winners, r.held_by_2, r.held_by_3) == (4, 2, 0.75, 0.75)
    s = K.switches(spark.createDataFrame([(1, "a", "b"), (1, "b", "b")], "p int, x string, y string"), "p", "x", "y")
    assert s.first().switches == 1
    assert K.seat_moves(spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, ""), (2, None)], "p int, d string"), "p", "d").first().districts == ["a", "b"]
