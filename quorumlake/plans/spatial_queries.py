"""Boxes of nations and suppliers, seeds over embeddings, grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlake.operators import spatial as V
from quorumlake.plans.registry import Tables, query

BOXES = """a AS (SELECT n_nationkey AS target, (n_nationkey % 5) * 10.0 AS x0, (n_nationkey // 5) * 10.0 AS y0, (n_nationkey % 5) * 10.0 + 9.0 AS x1, (n_nationkey // 5) * 10.0 + 9.0 AS y1 FROM nation),
b AS (SELECT s_suppkey AS source, (s_suppkey * 7 % 40)::DOUBLE AS x0, (s_suppkey * 11 % 40)::DOUBLE AS y0, (s_suppkey * 7 % 40 + 3 + s_suppkey % 5)::DOUBLE AS x1, (s_suppkey * 11 % 40 + 4)::DOUBLE AS y1, s_nationkey % 4 AS party FROM supplier),
o AS (SELECT target, source, (LEAST(a.x1, b.x1) - GREATEST(a.x0, b.x0)) * (LEAST(a.y1, b.y1) - GREATEST(a.y0, b.y0)) AS area, (b.x1 - b.x0) * (b.y1 - b.y0) AS whole, party
  FROM a JOIN b ON a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1)"""


def boxes(t: Tables) -> DataFrame:
    n, s = F.col("n_nationkey"), F.col("s_suppkey")
    x, y = (n % 5) * 10.0, F.floor(n / 5) * 10.0
    a = t.nation.select(n.alias("target"), x.alias("a_x0"), y.cast("double").alias("a_y0"), (x + 9).alias("a_x1"), (y + 9).cast("double").alias("a_y1"))
    u, v = (s * 7 % 40).cast("double"), (s * 11 % 40).cast("double")
    b = t.supplier.select(s.alias("source"), u.alias("b_x0"), v.alias("b_y0"), (u + 3 + s % 5).alias("b_x1"), (v + 4).alias("b_y1"), (F.col("s_nationkey") % 4).alias("party"))
    return V.box_join(a, b, cell=10.0)


@query(f"WITH {BOXES} SELECT target, source, area FROM o")
def bbox_join(t):
    return boxes(t).select("target", "source", "area")


@query(f"WITH {BOXES} SELECT target, party, round(SUM((100.0 * area / whole)::DECIMAL(18,6))::DOUBLE, 4) AS votes FROM o GROUP BY ALL")
def apportion(t):
    """A hundred votes of each source go to the targets by area."""
    o = boxes(t).withColumn("whole", (F.col("b_x1") - F.col("b_x0")) * (F.col("b_y1") - F.col("b_y0"))).withColumn("w", F.lit(100.0))
    tally = t.supplier.select(F.col("s_suppkey").alias("source"), (F.col("s_nationkey") % 4).alias("party"), F.lit(1).alias("n"))
    share = (F.col("w") * F.col("area") / F.col("whole")).cast("decimal(18,6)")
    exact = o.select("target", "source", share.alias("v"), F.lit(1).alias("one"))
    votes = V.apportion(exact.withColumn("w", F.col("v")), "target", "source", "one", "one", "w", tally)
    return votes.select("target", "party", F.round("votes", 4).alias("votes"))


@query(f"""WITH {BOXES}, v AS (SELECT target, party, round(SUM((area / whole)::DECIMAL(18,9))::DOUBLE, 6) AS votes FROM o GROUP BY ALL),
p AS (SELECT target, MAX(area) / SUM(area::DECIMAL(18,6))::DOUBLE > 0.5 AS single, COUNT(*) AS n FROM o GROUP BY target)
SELECT v.target, v.party, round(votes / s, 4) AS purity, single OR n = 1 AS single FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY target ORDER BY votes DESC, party) AS rn, SUM(votes) OVER (PARTITION BY target) AS s FROM v) v
JOIN p USING (target) WHERE rn = 1""")
def projected_seats(t):
    o = boxes(t).withColumn("whole", (F.col("b_x1") - F.col("b_x0")) * (F.col("b_y1") - F.col("b_y0")))
    votes = o.groupBy("target", "party").agg(F.round(F.sum((F.col("area") / F.col("whole")).cast("decimal(18,9)")).cast("double"), 6).alias("votes"))
    return V.projected_winner(votes, "target", o, "area", 0.5).withColumn("purity", F.round("purity", 4))


@query("""WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings), s AS (SELECT vec_id AS label, x, y FROM p WHERE vec_id < 20)
SELECT vec_id, label FROM (SELECT p.vec_id, s.label, ROW_NUMBER() OVER (PARTITION BY p.vec_id ORDER BY (p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y), s.label) AS rn FROM p, s) WHERE rn = 1""")
def nearest_seed(t):
    p = t.embeddings.select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    s = p.where("vec_id < 20").select(F.col("vec_id").alias("label"), "x", "y")
    return V.nearest(p, s, "vec_id", "label").select("vec_id", "label")


@query("""WITH RECURSIVE p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings),
s AS (SELECT ROW_NUMBER() OVER (ORDER BY md5(vec_id::VARCHAR), vec_id) - 1 AS c, x, y FROM p QUALIFY c < 5),
r(i, c, x, y) AS (SELECT 0, c::BIGINT, x, y FROM s UNION ALL
  SELECT i, c, AVG(x), AVG(y) FROM (SELECT r.i + 1 AS i, p.vec_id, p.x, p.y, arg_min(r.c, ((p.x - r.x) * (p.x - r.x) + (p.y - r.y) * (p.y - r.y), r.c)) AS c FROM r, p WHERE r.i < 30 GROUP BY ALL) GROUP BY i, c),
e AS (SELECT ROW_NUMBER() OVER (ORDER BY y DESC, x) - 1 AS seed, x, y FROM r WHERE i = 30)
SELECT vec_id, arg_min(seed, ((p.x - e.x) * (p.x - e.x) + (p.y - e.y) * (p.y - e.y), seed))::INT AS seed FROM p, e GROUP BY vec_id""")
def kmeans_assign(t):
    p = t.embeddings.select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return V.kmeans(p, 5, "vec_id").select("vec_id", "seed")


def unit_grid(t: Tables) -> DataFrame:
    """A grid of cells, a column of them a nation."""
    box = t.nation.select(F.col("n_nationkey").alias("k"), F.col("n_nationkey").cast("double").alias("x0"), F.lit(0.0).alias("y0"), (F.col("n_nationkey") + 1.0).alias("x1"), F.lit(20.0).alias("y1"))
    return V.grid(box, ["k"], 1.0).select(F.col("k").cast("int").alias("ix"), "iy", "x", "y")


@query("SELECT n_nationkey::INT AS ix, i::INT AS iy, n_nationkey + 0.5::DOUBLE AS x, i + 0.5::DOUBLE AS y FROM nation, range(20) r(i)")
def grid_cells(t):
    return unit_grid(t)


@query("""WITH r(n, px, py, qx, qy) AS (VALUES (1, 2, 1, 22, 3), (2, 22, 3, 15, 18), (3, 15, 18, 4, 14), (4, 4, 14, 2, 1))
SELECT n_nationkey::INT AS ix, i::INT AS iy FROM nation, range(20) g(i) WHERE (SELECT COUNT(*) FROM r WHERE (py > i + 0.5) <> (qy > i + 0.5)
  AND n_nationkey + 0.5 < (qx - px) * (i + 0.5 - py)::DOUBLE / (qy - py) + px) % 2 = 1""")
def cells_inside(t):
    """Cells whose centre lies in a quadrilateral."""
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((2, 1), (22, 3), (15, 18), (4, 14))])
    return unit_grid(t).where(V.inside(ring, F.col("x"), F.col("y"))).select("ix", "iy")


@query("""WITH RECURSIVE c AS (SELECT (n_nationkey * 20 + i)::INT AS cell_id, n_nationkey + 0.5 AS x, i + 0.5 AS y FROM nation, range(20) r(i)),
s(k, x, y, q) AS (VALUES (0, 2.0, 2.0, 0.4), (1, 20.0, 3.0, 0.3), (2, 5.0, 17.0, 0.2), (3, 21.0, 16.0, 0.1)),
d AS (SELECT cell_id, k, sqrt((c.x - s.x) * (c.x - s.x) + (c.y - s.y) * (c.y - s.y))::DOUBLE AS d FROM c, s),
n AS (SELECT COUNT(*) AS n FROM c), spread AS (SELECT stddev_pop(d) AS sd FROM d),
t AS (SELECT k, CASE WHEN k < 3 THEN round(q * n) ELSE n - (SELECT SUM(round(q * n)) FROM s WHERE k < 3) END::BIGINT AS t FROM s, n),
r(i, k, w, e) AS (SELECT 0, k, 0.0::DOUBLE, 999::BIGINT FROM t UNION ALL
  SELECT r.i + 1, r.k, CASE WHEN g.worst <= GREATEST(2, floor(0.004 * n)) THEN r.w ELSE r.w - g.e / n::DOUBLE * sd * 1.5 END, g.e
  FROM r JOIN (SELECT t.k, COALESCE(m, 0) - t AS e, MAX(abs(COALESCE(m, 0) - t)) OVER () AS worst FROM t LEFT JOIN (
      SELECT k, COUNT(*) AS m FROM (SELECT cell_id, arg_min(d.k, (d.d - r.w, d.k)) AS k FROM d JOIN r ON r.k = d.k GROUP BY cell_id) GROUP BY k) f ON f.k = t.k) g ON g.k = r.k, n, spread WHERE r.i < 299)
SELECT cell_id, arg_min(d.k, (d.d - r.w, d.k))::INT AS label FROM d JOIN r ON r.k = d.k WHERE r.i = (SELECT MAX(i) FROM r) GROUP BY cell_id""")
def capacity_allocate(t):
    """Cells dealt to four seeds by quota."""
    cells = unit_grid(t).select((F.col("ix") * 20 + F.col("iy")).alias("cell_id"), "x", "y")
    seeds = t.spark.createDataFrame([(0, 2.0, 2.0, 0.4), (1, 20.0, 3.0, 0.3), (2, 5.0, 17.0, 0.2), (3, 21.0, 16.0, 0.1)], "label int, x double, y double, quota double")
    return V.capacity_allocate(cells, seeds).select("cell_id", "label")


@query("SELECT n_nationkey::INT AS ix, i::INT AS iy, CASE WHEN n_nationkey < 12 THEN 0 ELSE 1 END AS label FROM nation, range(20) r(i)")
def contiguity_repair(t):
    """Cells labelled by halves, with strays; each label is connected afterwards."""
    stray = (F.col("ix") % 9 == 4) & (F.col("iy") % 7 == 3)
    label = F.when(F.col("ix") < 12, 0).otherwise(1)
    return V.contiguity_repair(unit_grid(t).select("ix", "iy", F.when(stray, 1 - label).otherwise(label).alias("label")))


@query("""WITH c AS (SELECT n_nationkey AS ix, i AS iy, (n_nationkey // 9 + i // 8)::INT AS label FROM nation, range(20) r(i)),
p AS (SELECT a.label AS l, b.label AS m FROM c a JOIN c b ON (b.ix = a.ix + 1 AND b.iy = a.iy) OR (b.ix = a.ix AND b.iy = a.iy + 1))
SELECT LEAST(l, m) AS a, GREATEST(l, m) AS b, COUNT(*) AS length FROM p WHERE l <> m GROUP BY ALL""")
def shared_borders(t):
    label = (F.floor(F.col("ix") / 9) + F.floor(F.col("iy") / 8)).cast("int")
    return V.shared_borders(unit_grid(t).select("ix", "iy", label.alias("label")))


@query("""WITH s AS (SELECT c_nationkey AS k, year AS y, MIN(c_mktsegment) AS shape FROM customer, (VALUES (1992), (1993), (1994)) v(year) WHERE (c_custkey + year) % 3 > 0 OR c_nationkey % 2 = 0 GROUP BY ALL),
c AS (SELECT k, COUNT(DISTINCT shape) AS d, COUNT(*) AS n, MIN(shape) AS shape FROM s GROUP BY k)
SELECT k, '*' AS period, shape FROM c WHERE d = 1 AND n = 3 UNION ALL SELECT s.k, y::VARCHAR, s.shape FROM s JOIN c USING (k) WHERE NOT (d = 1 AND n = 3)""")
def shape_dedupe(t):
    """Shapes equal in all periods become one row."""
    years = t.spark.createDataFrame([(1992,), (1993,), (1994,)], "period int")
    s = t.customer.crossJoin(F.broadcast(years)).where(((F.col("c_custkey") + F.col("period")) % 3 > 0) | (F.col("c_nationkey") % 2 == 0))
    s = s.groupBy(F.col("c_nationkey").alias("k"), "period").agg(F.min("c_mktsegment").alias("shape"))
    return V.same_in_all(s, "k", "period", "shape", 3)


@query("""SELECT n_nationkey AS k, 12.0 + n_nationkey AS area, 0.0 AS x0, 3.0 + n_nationkey / 4.0 AS x1 FROM nation""")
def ring_measures(t):
    """Area and bounds of rings, made clockwise first."""
    w = F.lit(3.0) + F.col("n_nationkey") / F.lit(4.0)
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    ring = V.clockwise(F.array(p(F.lit(0), F.lit(0)), p(w, F.lit(0)), p(w, F.lit(4)), p(F.lit(0), F.lit(4))))
    d = t.nation.select(F.col("n_nationkey").alias("k"), ring.alias("r"))
    return d.select("k", (-V.ring_area(F.col("r"))).alias("area"), V.ring_box(F.col("r"))["x0"].alias("x0"), V.ring_box(F.col("r"))["x1"].alias("x1"))


@query("SELECT s_suppkey AS id, LEAST(4.0, 1.0 + s_suppkey % 6) * 2.0 AS area FROM supplier")
def clip_areas(t):
    """Area of rectangles inside a window of width four."""
    p = lambda x, y: F.struct(x.cast("double").alias("x"), F.lit(y).cast("double").alias("y"))
    w = F.lit(1.0) + F.col("s_suppkey") % 6
    d = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.array(p(F.lit(0), 0), p(w, 0), p(w, 5), p(F.lit(0), 5)).alias("ring"),
        F.array(p(F.lit(-1), 1), p(F.lit(4), 1), p(F.lit(4), 3), p(F.lit(-1), 3)).alias("win"),
    )
    return V.clip_area(d, "ring", "win").select("id", "area")
