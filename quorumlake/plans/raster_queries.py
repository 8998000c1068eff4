"""Images of the driver's tables: a cell an eighth of an order, 400 a row, its class a group of customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.operators import cells as C
from quorumlake.operators import graph as G
from quorumlake.operators import layers as M
from quorumlake.plans.joins import spread
from quorumlake.plans.map_queries import SHAPES, notched
from quorumlake.plans.registry import Tables, query

CELLS = """c AS (SELECT (o_orderkey * 8 + k) AS n, (o_orderkey * 8 + k) % 400 AS x, (o_orderkey * 8 + k) // 400 AS y, (o_custkey + k // 3) % 3 AS label FROM orders, range(8) r(k))"""
#: Components by labels that neighbours, and labels of labels, lower.
PARTS = f"""{CELLS},
adj AS (SELECT a.n, b.n AS m FROM c a JOIN c b ON b.label = a.label AND ((b.y = a.y AND b.x = a.x + 1) OR (b.y = a.y + 1 AND b.x = a.x))),
near AS (SELECT n, m FROM adj UNION ALL SELECT m, n FROM adj),
lab(r, n, l) AS (SELECT 0, n, n FROM c UNION ALL SELECT r, n, MIN(l) FROM (
    SELECT p.r + 1 AS r, p.n, p.l FROM lab p UNION ALL SELECT p.r + 1, b.m, p.l FROM lab p JOIN near b ON b.n = p.n UNION ALL SELECT p.r + 1, p.n, q.l FROM lab p JOIN lab q ON q.n = p.l
    UNION ALL SELECT p.r + 1, p.l, q.l FROM lab p JOIN near b ON b.n = p.n JOIN lab q ON q.n = b.m) x WHERE r <= 25 GROUP BY r, n),
part AS (SELECT c.*, l FROM lab JOIN c USING (n) WHERE r = 25)"""


def cells(t: Tables) -> DataFrame:
    # an order's eight cells lie in one row of the image; a row's orders are dealt together, so that its runs need no other shuffle
    d = spread(t.orders.select("o_orderkey", "o_custkey", F.floor(F.col("o_orderkey") / 50).alias("y")), "y")
    d = d.select("y", "o_custkey", F.explode(F.expr("sequence(o_orderkey * 8, o_orderkey * 8 + 7)")).alias("n"))
    return d.select("y", (F.col("n") % 400).alias("x"), ((F.col("o_custkey") + F.floor(F.col("n") % 8 / 3)) % 3).alias("label"))


@query(f"""WITH RECURSIVE {PARTS}
SELECT label, COUNT(*) AS cells, MIN(x) AS x0, MIN(y) AS y0, MAX(x) AS x1, MAX(y) AS y1, round(AVG(x), 6) AS cx, round(AVG(y), 6) AS cy FROM part GROUP BY label, l HAVING COUNT(*) >= 5""")
def colour_segments(t):
    """Connected parts of one class with at least five cells: their size, box and centre."""
    parts = C.components(C.runs(cells(t), []), [])
    return C.sizes(parts, ["label"]).where("cells >= 5").select("label", "cells", "x0", "y0", "x1", "y1", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


@query(f"""WITH {CELLS}, s AS (SELECT label, COUNT(*) AS n FROM c GROUP BY label),
e AS (SELECT a.label, COUNT(*) AS n FROM c a JOIN c b ON b.label = a.label AND ((b.y = a.y AND b.x = a.x + 1) OR (b.y = a.y + 1 AND b.x = a.x)) GROUP BY a.label)
SELECT label, s.n::DOUBLE AS area, (4 * s.n - 2 * e.n)::DOUBLE AS length FROM s JOIN e USING (label)""")
def label_polygons(t):
    """Labels as polygons: the area and the length of their outlines."""
    return M.outline_sizes(C.outlines(C.runs(cells(t), []), ["label"]), ["label"])


@query(f"""WITH {SHAPES.split("ab AS")[0]} g AS (SELECT x.i AS x, y.i AS y, (2 * (x.i + 0.5) - (y.i + 0.5)) / 7 AS u, (3 * (y.i + 0.5) + (x.i + 0.5)) / 7 AS v FROM range(0, 420) x(i), range(-110, 220) y(i)),
m AS (SELECT b, x, y, SUM(s) AS n FROM g JOIN b ON u > u0 AND u <= u1 AND v > v0 AND v <= v1 GROUP BY ALL)
SELECT b, COUNT(*) AS cells, COUNT(DISTINCT y) AS rows_ FROM m WHERE n > 0 GROUP BY b""")
def rasterised_shapes(t):
    """Notched shapes as runs of cells, by their centres (the unit cells' centres lie on no border)."""
    r = C.rasterised(notched(t), ["b"])
    return r.groupBy("b").agg(F.sum(F.col("x1") - F.col("x0") + 1).cast("long").alias("cells"), F.countDistinct("y").alias("rows_"))


@query(f"""WITH {CELLS}, s AS (SELECT s_suppkey AS seed, s_suppkey * 37 % 400 AS sx, s_suppkey * 11 % (SELECT MAX(y) + 1 FROM c) AS sy, s_suppkey % 3 AS label FROM supplier)
SELECT x, y, seed FROM (SELECT x, y, seed, ROW_NUMBER() OVER (PARTITION BY n ORDER BY (x - sx) * (x - sx) + (y - sy) * (y - sy), seed) AS rn FROM c JOIN s USING (label)) WHERE rn = 1""")
def nearest_class_fill(t):
    """Each cell's nearest seed of its own district."""
    c = cells(t)
    top = t.orders.agg(F.max(F.floor(F.col("o_orderkey") / 50))).first()[0]  # the last row of the image, read off the orders
    high = F.lit(0 if top is None else top) + 1
    k = F.col("s_suppkey")
    seeds = t.supplier.select(k.alias("seed"), (k * 37 % 400).alias("x"), (k * 11 % high).alias("y"), (k % 3).alias("label"))
    return C.nearest_class(c, seeds, "seed", ["label"], "inner").select("x", "y", "seed")


@query("""WITH RECURSIVE h AS (SELECT c_custkey AS n, c_nationkey AS g, (ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) AS r, c_acctbal AS h FROM customer),
e AS (SELECT a.g, a.n AS p, b.n AS q, GREATEST(a.h, b.h) AS w, LEAST(a.n, b.n) AS u, GREATEST(a.n, b.n) AS v FROM h a JOIN h b ON a.g = b.g AND abs(a.r % 6 - b.r % 6) + abs(a.r // 6 - b.r // 6) = 1),
lab(node, label) USING KEY (node) AS (SELECT n, n FROM (SELECT MIN(c_custkey) AS n FROM customer GROUP BY c_nationkey UNION SELECT MAX(c_custkey) FROM customer GROUP BY c_nationkey)
  UNION (SELECT q, label FROM recurring.lab JOIN e ON p = node WHERE q NOT IN (SELECT node FROM recurring.lab) QUALIFY ROW_NUMBER() OVER (PARTITION BY g ORDER BY w, u, v) = 1))
SELECT node, label FROM lab""")
def basins(t):
    """Each nation's customers as a grid six wide, flooded from the first and the last one; heights are balances."""
    r = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) - 1
    h = t.customer.select(F.col("c_custkey").alias("n"), F.col("c_nationkey").alias("g"), r.alias("r"), F.col("c_acctbal").alias("h"))
    h = h.select("n", "g", "h", (F.col("r") % 6).alias("x"), F.floor(F.col("r") / 6).alias("y"))
    steps = F.explode(F.array(F.struct((F.col("x") + 1).alias("x"), F.col("y").alias("y")), F.struct(F.col("x"), (F.col("y") + 1).alias("y"))))
    near = h.select(F.col("n").alias("a"), F.col("h").alias("ha"), "g", steps.alias("s")).select("a", "ha", "g", "s.*").join(h.select(F.col("n").alias("b"), F.col("h").alias("hb"), "g", "x", "y"), ["g", "x", "y"])
    ends = t.customer.groupBy("c_nationkey").agg(F.array_distinct(F.array(F.min("c_custkey"), F.max("c_custkey"))).alias("n"))
    seeds = ends.select(F.explode("n").alias("node")).withColumn("label", F.col("node"))
    return G.basins(near.select("a", "b", F.greatest("ha", "hb").alias("w")), seeds).select("node", "label")
