"""Images and grids of any size as tables of runs: segments, components, contours, scanlines, overlaps.

A run is a stretch (y, x0, x1) of a row's cells of one class, both ends included. An image of flat colours has few of them, and everything
here works on runs: components join runs of neighbouring rows, contours cancel the sides of their rectangles, overlaps join
runs of two tables. Long runs are cut at every ``TILE`` columns, so a join's key is a row's tile, never a row or an image. Components and contours are settled inside
blocks of ``BAND`` rows and ``TILE`` columns first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from quorumlake.operators import layers as M
from quorumlake.operators.graph import connected_components
from quorumlake.operators.near import with_nearest
from quorumlake.plans.joins import spread
from quorumlake.plans.staging import Stage

TILE = 256
#: Rows of a block: what lies inside one is settled there.
BAND = 64


def images(spark: SparkSession, path) -> DataFrame:
    """Images by Spark's own reader: (id, height, width, channels, data); files that it cannot decode have no data."""
    d = spark.read.format("image").option("dropInvalid", False).load(path).select("image.*")
    bad = F.col("height") < 1
    return d.select(F.col("origin").alias("id"), *[F.when(~bad, F.col(c)).alias(a) for c, a in (("height", "height"), ("width", "width"), ("nChannels", "channels"), ("data", "data"))])


def pixels(shot: DataFrame) -> DataFrame:
    """``(id, y, x, r, g, b)`` of ``images``: rows of pixels are cut out first, so no row holds an exploded image."""
    line = F.substring("data", F.col("y") * F.col("width") * F.col("channels") + 1, F.col("width") * F.col("channels"))
    rows = shot.where("data is not null").withColumn("y", F.explode(F.expr("sequence(0, height - 1)"))).select("id", "y", "width", "channels", F.hex(line).alias("_h"))
    d = rows.withColumn("x", F.explode(F.expr("sequence(0, width - 1)")))
    part = lambda i: F.conv(F.substring("_h", (F.col("x") * F.col("channels") + F.least(F.lit(i), F.col("channels") - 1)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
    return d.select("id", "y", "x", part(2).alias("r"), part(1).alias("g"), part(0).alias("b"))


def hsv(r: Column, g: Column, b: Column) -> dict[str, Column]:
    """Hue in degrees (0 for greys), saturation and value from 0 to 255."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    span = F.nullif(top - low, F.lit(0))
    hue = F.when(top == r, (g - b) / span).when(top == g, (b - r) / span + 2).otherwise((r - g) / span + 4)
    return {"hue": F.coalesce(F.pmod(hue * 60, F.lit(360.0)), F.lit(0.0)), "saturation": F.coalesce((top - low) * 255 / F.nullif(top, F.lit(0)), F.lit(0.0)), "value": top}


def runs(cells: DataFrame, keys: list[str], kind: str = "label") -> DataFrame:
    """``(keys, kind, y, x0, x1)`` of cells (keys, y, x, kind); cells of a null kind make none. A cell that repeats counts once."""
    # a cell that repeats has one rank, so nothing but the window deals the cells; a table that lies by ``y`` stays where it is
    w = Window.partitionBy(*keys, "y", "_t", kind).orderBy("x")
    d = cells.where(F.col(kind).isNotNull()).select(*keys, "y", "x", kind, F.floor(F.col("x") / TILE).alias("_t")).withColumn("_g", F.col("x") - F.dense_rank().over(w))
    return d.groupBy(*keys, kind, "y", "_t", "_g").agg(F.min("x").alias("x0"), F.max("x").alias("x1")).drop("_t", "_g")


def tiled(r: DataFrame, reach: int = 0) -> DataFrame:
    """Runs with the tiles that they, widened by ``reach``, lie in."""
    return r.withColumn("tile", F.explode(F.sequence(F.floor((F.col("x0") - reach) / TILE), F.floor((F.col("x1") + reach) / TILE))))


def _touching(kind: np.ndarray, y: np.ndarray, x0: np.ndarray, x1: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of numbers of runs of one kind that touch: below one another, or side by side in a row. ``y`` and ``x`` count from a block's corner."""
    at = lambda k, row, x: (k * (BAND + 2) + row) * (TILE + 4) + x + 2
    start, end = at(kind, y, x0), at(kind, y, x1)
    order = np.argsort(start, kind="stable")
    start, far = start[order], np.maximum.accumulate(end[order])
    low = np.searchsorted(far, at(kind, y + 1, x0 - wide), "left")
    n = np.maximum(np.searchsorted(start, at(kind, y + 1, x1 + wide), "right") - low, 0)
    a = np.repeat(np.arange(len(y)), n)
    b = order[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    met = end[b] >= at(kind, y + 1, x0 - wide)[a]
    beside = np.searchsorted(start, end + 1, "left")
    got = np.append(start, -1)[beside] == end + 1
    return np.concatenate([a[met], np.nonzero(got)[0]]), np.concatenate([b[met], order[beside[got]]])


def _least_numbers(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` the smallest number that the pairs connect it with."""
    of = np.arange(n)
    while True:
        low, high = np.minimum(of[a], of[b]), np.maximum(of[a], of[b])
        if (low == high).all():
            return of
        np.minimum.at(of, high, low)
        while (of[of] != of).any():
            of = of[of]


def _in_blocks(r: DataFrame, keys: list[str], kind: str, wide: int) -> DataFrame:
    """Runs with ``root``, the smallest ``run`` that those of their block of ``BAND`` rows and ``TILE`` columns connect them with: a row for each block that a run lies
    in, ``home`` the first; ``open`` if one of those lies at the block's border. A block has a bounded number of cells."""
    named = r.columns

    def run(block: pa.Table) -> pa.Table:
        t = block.sort_by("run")
        column = lambda c: t.column(c).to_numpy()
        code = t.column(kind).combine_chunks().dictionary_encode().indices
        ok = code.is_valid().to_numpy(zero_copy_only=False) & all(t.column(k).null_count == 0 for k in keys)
        y, tile, ids = column("y").astype(np.int64), column("tile"), column("run")
        left = tile * TILE
        x0, x1 = np.maximum(column("x0") - left, 0), np.minimum(column("x1") - left, TILE - 1)
        at = np.nonzero(ok)[0]
        a, b = _touching(code.fill_null(0).to_numpy()[at].astype(np.int64), (y % BAND)[at], x0[at], x1[at], wide)
        of = _least_numbers(len(ids), at[a], at[b])
        outer = np.isin(y % BAND, (0, BAND - 1)) | (x0 == 0) | (x1 == TILE - 1)
        more = {"root": ids[of], "home": np.floor_divide(column("x0"), TILE) == tile, "open": np.isin(of, of[outer])}
        t = t.select(named)
        for name, values in more.items():
            t = t.append_column(name, pa.array(values))
        return t

    schema = StructType([*r.schema.fields, StructField("root", LongType()), StructField("home", BooleanType()), StructField("open", BooleanType())])
    return tiled(r).withColumn("_band", F.floor(F.col("y") / BAND)).groupBy(*keys, "_band", "tile").applyInArrow(run, schema)


def components(r: DataFrame, keys: list[str], kind: str = "label", diagonal: bool = False) -> DataFrame:
    """Runs with ``part``, the number of their connected part: runs of one kind that touch, in neighbouring rows or side by side. Runs are joined inside blocks first, a
    block a task; joins and rounds over the whole table see only the runs at the blocks' borders."""
    stage = Stage(r.sparkSession, "runs")
    wide = int(diagonal)
    r = stage.put(r.withColumn("run", F.monotonically_increasing_id()), "runs")
    local = stage.put(_in_blocks(r, keys, kind, wide), "blocks")
    first, last = F.floor(F.col("x0") / TILE), F.floor(F.col("x1") / TILE)
    border = (F.pmod("y", F.lit(BAND)).isin(0, BAND - 1)) | (first != last) | (F.col("x0") == first * TILE) | (F.col("x1") == last * TILE + TILE - 1)
    outer = local.where("home").where(border)
    low = tiled(outer).select(*keys, kind, "y", "tile", "x0", "x1", "run")
    up = tiled(outer, wide).select(*keys, kind, (F.col("y") - 1).alias("y"), "tile", F.col("x0").alias("u0"), F.col("x1").alias("u1"), F.col("run").alias("dst"))
    met = low.join(up, [*keys, kind, "y", "tile"]).where((F.col("x0") <= F.col("u1") + wide) & (F.col("u0") <= F.col("x1") + wide)).select(F.col("run").alias("src"), "dst")
    seam = outer.select(*keys, kind, "y", (F.col("x1") + 1).alias("x0"), F.col("run").alias("src")).join(outer.select(*keys, kind, "y", "x0", F.col("run").alias("dst")), [*keys, kind, "y", "x0"])
    own = local.where(border).select(F.col("run").alias("src"), F.col("root").alias("dst"))
    found = connected_components(met.unionByName(seam.select("src", "dst")).unionByName(own))
    home, cols = local.where("home"), [c for c in r.columns if c != "run"]
    done = home.where("not open").select(*cols, F.col("root").alias("part"))
    rest = home.where("open").join(found.withColumnRenamed("node", "root"), "root", "left")
    return done.unionByName(rest.select(*cols, F.coalesce("component", "root").alias("part")))


def sizes(parts: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, part, cells, x0, y0, x1, y1, cx, cy)``: how many cells, the box (ends included) and the centre of each part."""
    n = F.col("x1") - F.col("x0") + 1
    cx, cy = F.sum(n * (F.col("x0") + F.col("x1")) / 2), F.sum(n * F.col("y"))
    box = [F.min("x0").alias("bx0"), F.min("y").alias("by0"), F.max("x1").alias("bx1"), F.max("y").alias("by1")]
    d = parts.groupBy(*keys, "part").agg(F.sum(n).cast("long").alias("cells"), *box, (cx / F.sum(n)).alias("cx"), (cy / F.sum(n)).alias("cy"))
    return d.withColumnsRenamed({f"b{c}": c for c in ("x0", "y0", "x1", "y1")})


def large(parts: DataFrame, keys: list[str], least: int = 1, share: float = 0.0, kind: str | None = None) -> DataFrame:
    """Parts of at least ``least`` cells and at least ``share`` of the largest one (of their kind, if named)."""
    group = [*keys, *([kind] if kind else [])]
    n = parts.groupBy(*group, "part").agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("_n")).where(F.col("_n") >= least)
    if share > 0:
        n = _with(n, n.groupBy(*group).agg(F.max("_n").alias("_top")), group).where(F.col("_n") >= share * F.col("_top"))
    return parts.join(n.select(*group, "part"), [*group, "part"], "left_semi")


def _with(rows: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their group's totals; without keys these are one row."""
    return rows.join(totals, keys) if keys else rows.crossJoin(F.broadcast(totals))


def grown(r: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """Cells within ``reach`` columns and rows of a run, as runs (which may overlap)."""
    return r.select(*keys, F.explode(F.sequence(F.col("y") - reach, F.col("y") + reach)).alias("y"), (F.col("x0") - reach).alias("x0"), (F.col("x1") + reach).alias("x1"))


def shared(a: DataFrame, b: DataFrame, keys: list[str], a_key: str, b_key: str) -> DataFrame:
    """``(keys, a, b, cells)`` that runs of two tables have in common. Runs of one shape do not overlap."""
    x = tiled(a).select(*keys, a_key, "y", "tile", "x0", "x1")
    y = tiled(b).select(*keys, b_key, "y", "tile", F.col("x0").alias("u0"), F.col("x1").alias("u1"))
    lo = F.greatest("x0", "u0", F.col("tile") * TILE)
    hi = F.least("x1", "u1", F.col("tile") * TILE + TILE - 1)
    return x.join(y, [*keys, "y", "tile"]).where(lo <= hi).groupBy(*keys, a_key, b_key).agg(F.sum(hi - lo + 1).cast("long").alias("cells"))


def embedded(parts: DataFrame, core: DataFrame, keys: list[str], reach: int, share: float = 0.5) -> DataFrame:
    """Parts with more than ``share`` of their cells within ``reach`` of the core's runs."""
    near = components(_flat(grown(core, keys, reach).withColumn("_one", F.lit(1)), [*keys, "_one"]), keys, "_one").select(*keys, F.lit(1).alias("_one"), "y", "x0", "x1")
    hit = shared(parts, near, keys, "part", "_one")
    n = parts.groupBy(*keys, "part").agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("_n"))
    return parts.join(hit.join(n, [*keys, "part"]).where(F.col("cells") > share * F.col("_n")).select(*keys, "part"), [*keys, "part"], "left_semi")


def _flat(r: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping runs merged."""
    w = Window.partitionBy(*keys, "y").orderBy("x0", "x1")
    before = F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = r.withColumn("_new", F.when(before + 1 >= F.col("x0"), 0).otherwise(1)).withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(*keys, "y", "_g").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("_g")


def peaks(cells: DataFrame, keys: list[str], axis: str, share: float, apart: int) -> DataFrame:
    """``(keys, at, cells)``: rows or columns (``axis`` y or x) that a line fills: those with at least ``share`` of the fullest one's cells, of those less than
    ``apart`` from one another in a chain the fullest, then the first."""
    n = cells.groupBy(*keys, F.col(axis).alias("at")).agg(F.count("*").alias("cells"))
    top = n.groupBy(*keys).agg(F.max("cells").alias("_top"))
    n = _with(n, top, keys).where(F.col("cells") >= share * F.col("_top"))
    w = Window.partitionBy(*keys).orderBy("at")
    n = n.withColumn("_new", F.when(F.col("at") - F.lag("at").over(w) < apart, 0).otherwise(1))
    n = n.withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    best = n.groupBy(*keys, "_g").agg(F.max(F.struct("cells", (-F.col("at")).alias("n"), "at")).alias("m"))
    return best.select(*keys, "m.at", "m.cells")


# ---------------------------------------------------------------- cells and polygons


def outlines(r: DataFrame, by: list[str]) -> DataFrame:
    """Edges (by, x0, y0, x1, y1) around each group's runs, holes included: the contours of a mask, or the polygons of labels (see ``layers`` to chain
    and simplify them). A cell is a unit square.

    Sides cancel inside blocks of ``BAND`` rows and ``TILE`` columns first, for which the runs are dealt once; only what ends at a block's border goes on, by its lines."""
    corner = {"a": ("x0", "y"), "b": ("x1 + 1", "y"), "c": ("x1 + 1", "y + 1"), "d": ("x0", "y + 1")}
    side = lambda p, q: F.expr(f"struct({corner[p][0]} as x0, {corner[p][1]} as y0, {corner[q][0]} as x1, {corner[q][1]} as y1)")
    cut = tiled(r).select(*by, "y", "tile", F.greatest("x0", F.col("tile") * TILE).alias("x0"), F.least("x1", F.col("tile") * TILE + TILE - 1).alias("x1"))
    block = [*by, "_band", "tile"]
    cut = spread(cut.withColumn("_band", F.floor(F.col("y") / BAND)), *block)
    e = cut.select(*block, F.explode(F.array(*[side(p, q) for p, q in ("ab", "bc", "cd", "da")])).alias("_e")).select(*block, *[F.col(f"_e.{c}").cast("long").alias(c) for c in ("x0", "y0", "x1", "y1")])
    within = lambda c, n, size: (F.least(f"{c}0", f"{c}1") > F.col(n) * size) & (F.greatest(f"{c}0", f"{c}1") < (F.col(n) + 1) * size)
    e = M.shape_outlines(e, block).withColumn("_inner", within("x", "tile", TILE) & within("y", "_band", BAND))
    e = Stage(r.sparkSession, "outlines").put(e, "blocks")
    edges = lambda d: d.select(*by, "x0", "y0", "x1", "y1")
    return edges(e.where("_inner")).unionByName(M.dissolve(edges(e.where("not _inner")), by))


def rasterised(edges: DataFrame, keys: list[str], x0: float = 0.0, y0: float = 0.0, step: float = 1.0) -> DataFrame:
    """Runs (keys, y, x0, x1) of the cells whose centre lies in a shape: edges go to the rows whose centre line they cross, the crossings of a row are
    paired in their order. Cell (0, 0) has its corner in (x0, y0); a centre on a border belongs to the shape on its right."""
    lo, hi = F.least("y0", "y1"), F.greatest("y0", "y1")
    first, last = F.ceil((lo - y0) / step - 0.5), F.ceil((hi - y0) / step - 0.5) - 1
    d = edges.withColumns({"_first": first, "_last": last}).where("_first <= _last").withColumn("y", F.explode(F.sequence("_first", "_last")))
    level = F.lit(y0) + (F.col("y") + 0.5) * step
    d = d.select(*keys, "y", (F.col("x0") + (F.col("x1") - F.col("x0")) * (level - F.col("y0")) / (F.col("y1") - F.col("y0"))).alias("_x"))
    w = Window.partitionBy(*keys, "y").orderBy("_x")
    d = d.withColumns({"_n": F.row_number().over(w), "_to": F.lead("_x").over(w)}).where("_n % 2 = 1")
    at = lambda c: F.ceil((F.col(c) - x0) / step - 0.5)
    return d.select(*keys, "y", at("_x").alias("x0"), (at("_to") - 1).alias("x1")).where("x0 <= x1")


def nearest_class(cells: DataFrame, seeds: DataFrame, label: str = "label", within: list[str] = (), how: str = "left") -> DataFrame:
    """``cells`` (x, y, within) with the label of the nearest seed (x, y, label, within), in cells; of equally near ones the smallest label. With
    ``within`` only seeds of the same district compete; a cell whose district has none has a null label, or is left out if ``how`` is inner."""
    items = seeds.select(*within, label, *[F.col(a).alias(f"{a}{i}") for a in "xy" for i in "01"])
    return with_nearest(cells, items, label, list(within), to="_nearest", how=how).drop("_d2").withColumnRenamed("_nearest", label)
