"""Fits of one map on another: similarity from anchors as sums of a grouped aggregation, seeds, projection."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.operators import layers as M
from quorumlake.plans.staging import Scope, Stage

# ---------------------------------------------------------------- similarity


def anchor_similarity(pairs: DataFrame, group: list[str], x: str = "x", y: str = "y", u: str = "u", v: str = "v") -> DataFrame:
    """``(group, a, b, tx, ty, rms, n)``: the map (x, y) -> (a x - b y + tx, b x + a y + ty), a turn, a scale and a shift, that
    brings the anchors nearest to (u, v) by squares. Sums of map-side combined aggregates; one place alone gives nulls."""
    m = {c: F.avg(c) for c in (x, y, u, v)}
    both = lambda p, q: F.avg(F.col(p) * F.col(q)) - m[p] * m[q]
    square = lambda p, q: both(p, p) + both(q, q)
    s = pairs.groupBy(*group).agg(
        (both(x, u) + both(y, v)).alias("_p"), (both(x, v) - both(y, u)).alias("_q"), F.nullif(square(x, y), F.lit(0.0)).alias("_s"),
        square(u, v).alias("_t"), *[f.alias(f"_{c}") for c, f in m.items()], F.count("*").alias("n"),
    )
    a, b = F.col("_p") / F.col("_s"), F.col("_q") / F.col("_s")
    left = F.col("_t") - (F.col("_p") * F.col("_p") + F.col("_q") * F.col("_q")) / F.col("_s")
    return s.select(
        *group, a.alias("a"), b.alias("b"), (F.col(f"_{u}") - a * F.col(f"_{x}") + b * F.col(f"_{y}")).alias("tx"),
        (F.col(f"_{v}") - b * F.col(f"_{x}") - a * F.col(f"_{y}")).alias("ty"), F.sqrt(F.greatest(left, F.lit(0.0))).alias("rms"), "n",
    )


def majority_cluster(labels: DataFrame, places: DataFrame, sheet: str, unit: str, most_km: float = 150.0) -> DataFrame:
    """``labels`` (sheet, unit, ..) with ``kept``: whether the unit lies within ``most_km`` of its sheet's commonest unit (first by
    name of equals). ``places`` is (unit, lon, lat); a unit without a place is not kept."""
    top = labels.groupBy(sheet, unit).agg(F.count("*").alias("_n")).groupBy(sheet).agg(F.max_by(unit, F.struct("_n", F.lit(0))).alias("_any"), F.max("_n").alias("_n"))
    first = labels.groupBy(sheet, unit).agg(F.count("*").alias("_n")).join(top.select(sheet, "_n"), [sheet, "_n"]).groupBy(sheet).agg(F.min(unit).alias("_mode"))
    at = places.select(F.col(unit), F.col("lon").alias("_lon"), F.col("lat").alias("_lat"))
    mode = first.join(at.withColumnRenamed(unit, "_mode"), "_mode").select(sheet, F.col("_lon").alias("_mlon"), F.col("_lat").alias("_mlat"))
    from quorumlake.functions.textnorm import planar_km

    d = planar_km(F.col("_lon") - F.col("_mlon"), F.col("_lat") - F.col("_mlat"), F.col("_mlat"))
    out = labels.join(at, unit, "left").join(mode, sheet, "left")
    return out.withColumn("kept", F.coalesce(d < most_km, F.lit(False))).select(*labels.columns, "kept")


def seed_cascade(seats: DataFrame, region: str, own: str, earlier: str, district: str) -> Column | DataFrame:
    """``seats`` with ``source`` and ``seed``, the first of these that all seats of a region have: their own centres; those of an
    earlier map, if it has as many; those of their districts, if all differ; else null, and k-means has to make them."""
    w = Window.partitionBy(region)
    n, all_of = F.count("*").over(w), lambda c: F.count(c).over(w) == F.count("*").over(w)
    apart = F.size(F.collect_set(district).over(w)) == n
    source = F.when(all_of(own), "own").when(all_of(earlier), "earlier").when(all_of(district) & apart, "district").otherwise("kmeans")
    d = seats.withColumn("source", source)
    return d.withColumn("seed", F.when(F.col("source") == "own", F.col(own)).when(F.col("source") == "earlier", F.col(earlier)).when(F.col("source") == "district", F.col(district)))


# ---------------------------------------------------------------- projection


def utm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    """Easting and northing on the northern UTM grid of a zone, by Krüger's series (under a millimetre within the zone)."""
    f, radius = 1 / 298.257223563, 6378137.0
    n = f / (2 - f)
    big = radius / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - F.lit(zone * 6 - 183.0))
    atanh = lambda z: F.log((1 + z) / (1 - z)) / 2
    t = F.sinh(atanh(F.sin(phi)) - F.lit(e) * atanh(F.lit(e) * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east = eta + sum((F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(alpha, 1)), F.lit(0.0))
    north = xi + sum((F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(alpha, 1)), F.lit(0.0))
    return F.lit(500000.0) + F.lit(0.9996 * big) * east, F.lit(0.9996 * big) * north


def utm_zone(lon: Column) -> Column:
    """The zone whose centre is nearest."""
    return (F.floor((lon + 180) / 6) % 60 + 1).cast("int")


# ---------------------------------------------------------------- fits by overlap

#: Edges of a map's candidates are told apart by its number times this plus the candidate's.
MANY = 64


def scored(candidates: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """``candidates`` (g, k, m11, m12, m21, m22, tx, ty, cx, cy) with ``iou``, the share that the moved shape ``a`` and shape ``b`` (edges with g, a whole number) have
    in common of both. A point goes to m (p - c) + t. All candidates of all maps are measured together, by ``common_areas``."""
    stage = Stage(a.sparkSession, "scored")
    c = stage.put(candidates.withColumn("_c", F.col("g") * MANY + F.col("k")), "candidates")
    to = lambda i, j, t, x, y: F.col(i) * (F.col(x) - F.col("cx")) + F.col(j) * (F.col(y) - F.col("cy")) + F.col(t)
    ends = {f"{n}{k}": to(i, j, t, f"x{k}", f"y{k}") for k in "01" for n, i, j, t in (("x", "m11", "m12", "tx"), ("y", "m21", "m22", "ty"))}
    moved = stage.put(a.join(c, "g").select("_c", *[v.alias(n) for n, v in ends.items()]), "moved")
    common = M.common_areas(moved, b, "_c", "g", pairs=c.select("_c", "g")).select("_c", F.col("area").alias("_both"))
    sizes = M.areas(moved, ["_c"]).withColumnRenamed("area", "_a").join(common, "_c", "left")
    both = F.coalesce("_both", F.lit(0.0))
    out = c.join(sizes, "_c", "left").join(M.areas(b, ["g"]).withColumnRenamed("area", "_b"), "g", "left")
    return out.withColumn("iou", F.coalesce(F.try_divide(both, F.col("_a") + F.col("_b") - both), F.lit(0.0))).drop("_c", "_a", "_b", "_both")


def _turned(d: DataFrame, angle: Column, size: Column) -> DataFrame:
    cos, sin = F.cos(angle) * size, F.sin(angle) * size
    return d.withColumns({"m11": cos, "m12": -sin, "m21": sin, "m22": cos})


def rotated_iou(a: DataFrame, b: DataFrame, most: int = 15, step: int = 3) -> DataFrame:
    """``(g, angle, iou)``: the turn of ``a`` about its centre, in whole degrees from -most to most, that covers ``b`` best once their centres lie on each other; of
    equally good ones the smallest."""
    at = M.centres(a, ["g"]).select("g", "cx", "cy").join(M.centres(b, ["g"]).select("g", F.col("cx").alias("tx"), F.col("cy").alias("ty")), "g")
    d = at.select("*", F.posexplode(F.sequence(F.lit(-most), F.lit(most), F.lit(step))).alias("k", "angle"))
    s = scored(_turned(d, F.radians("angle"), F.lit(1.0)), a, b)
    best = s.groupBy("g").agg(F.max(F.struct(F.round("iou", 9).alias("r"), (-F.abs("angle")).alias("n"), "angle", "iou")).alias("m"))
    return best.select("g", "m.angle", "m.iou")


def fit_overlap(a: DataFrame, b: DataFrame, rounds: int = 16, reach: float = 0.2) -> DataFrame:
    """``(g, m11, m12, m21, m22, tx, ty, cx, cy, iou)``: for each map the affine change of ``a`` that covers ``b`` best, as far as a search by ``rounds`` finds it.

    It begins with the centres and areas made equal and the best of 48 turns. A round tries each of the six numbers a step up and down, for all maps in one
    job, and takes the best; where none is better, the map's step is halved."""
    with Scope(a.sparkSession) as made:
        stage = Stage(a.sparkSession, "fit")
        own, to = M.centres(a, ["g"]), M.centres(b, ["g"]).toDF("g", "b_area", "tx", "ty")
        d = own.join(to, "g").select("g", "cx", "cy", "tx", "ty", F.sqrt(F.col("b_area") / F.col("area")).alias("size"), F.sqrt("b_area").alias("span"))
        d = _turned(d.select("*", F.explode(F.sequence(F.lit(0), F.lit(47))).alias("k")), F.radians(F.col("k") * 7.5), F.col("size"))
        numbers = ["m11", "m12", "m21", "m22", "tx", "ty"]
        keep = ["iou", *numbers, "cx", "cy", "size", "span"]

        def best(s: DataFrame) -> DataFrame:
            top = s.groupBy("g").agg(F.max(F.struct(F.round("iou", 9).alias("_r"), (-F.col("k")).alias("_n"), *keep)).alias("m"))
            return top.select("g", "m.*")

        cur = stage.put(best(scored(d, a, b)).drop("_r", "_n").withColumn("step", F.lit(reach)), "cur")
        for _ in range(rounds):
            k = F.explode(F.sequence(F.lit(0), F.lit(2 * len(numbers)))).alias("k")
            d = cur.drop("iou").select("*", k)
            way = F.when(F.col("k") % 2 == 1, F.col("step")).otherwise(-F.col("step"))
            d = d.withColumns({n: F.when(F.ceil(F.col("k") / 2) == i, F.col(n) + way * F.col("size" if n[0] == "m" else "span")).otherwise(F.col(n)) for i, n in enumerate(numbers, 1)})
            d = d.where("m11 * m22 > m12 * m21")
            new = best(scored(d.drop("step"), a, b)).join(cur.select("g", "step"), "g")
            cur = stage.put(new.withColumn("step", F.when(F.col("_n") == 0, F.col("step") / 2).otherwise(F.col("step"))).drop("_r", "_n"), "cur")
            stage.drop("cur", keep_last=True)
        made.keep(cur)
    return cur.select("g", *numbers, "cx", "cy", "iou")
