"""Connected components and clique edges as relational fixpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlake.plans.joins import join_dim
from quorumlake.plans.staging import Stage


#: Edges from which on whole components are taken out of the rounds; below it the jobs for that take longer than they save.
SETTLE = 1 << 18


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def _settled(stage: Stage, e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (hi, lo) of the stars that nothing else touches, which are whole components, and all others. An end is amiss if it has two smaller neighbours, or smaller
    and larger ones; a star is open if one of its ends is."""
    end = lambda c, h, n: e.select(F.col(c).alias("n"), F.lit(h).cast("long").alias("h"), F.lit(n).cast("long").alias("l"))
    amiss = end("hi", 1, 0).unionByName(end("lo", 0, 1)).groupBy("n").agg(F.sum("h").alias("h"), F.max("l").alias("l")).where("h > 1 or (h = 1 and l = 1)")
    amiss = stage.put(amiss.select("n", "l"), "amiss")
    stars = join_dim(e, amiss.select(F.col("n").alias("hi")), "hi", "left_semi").select("lo").unionByName(amiss.where("l = 1").select(F.col("n").alias("lo")))
    stars = stage.put(stars.distinct(), "open")
    return stage.put(join_dim(e, stars, "lo", "left_anti").select("hi", "lo"), "settled"), stage.put(join_dim(e, stars, "lo", "left_semi").select("hi", "lo"), "edges")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for each node that an edge between two nodes touches; component is the smallest node.

    Alternating large-star and small-star rounds: each node's neighbours are hooked to its smallest
    neighbour until only stars remain. A round is two map-side combined minima, two joins that
    adaptive execution may split at hot nodes, and a table staged in the shared folder. Components that are
    single stars leave a table of over ``SETTLE`` edges before rounds 1, 2, 4, 8 and so on, so only others are carried on.
    Null ends and self-loops are ignored; an empty input gives an empty result.
    """
    spark = edges.sparkSession
    stage = Stage(spark, "components")
    e = (
        edges.select(F.greatest(src, dst).alias("hi"), F.least(src, dst).alias("lo"))
        .where(F.col(src).isNotNull() & F.col(dst).isNotNull())
        .where(F.col("hi") != F.col("lo"))
        .distinct()
    )
    e = stage.put(e, "edges")
    before, done = _signature(e), []
    for i in range(max_rounds):
        if before[0] > SETTLE and i & (i + 1) == 0:
            whole, e = _settled(stage, e)
            done.append(whole)
            stage.drop("edges", keep_last=True)
            before = _signature(e)
        if not before[0]:
            break
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = stage.put(small.unionByName(root.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        stage.drop("edges", keep_last=True)
        after = _signature(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    for whole in done:
        e = e.unionByName(whole)
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def capped_clique_edges(members: DataFrame, group: list[str], node: str, low: int = 2, high: int = 8) -> DataFrame:
    """All pairs ``(src, dst)``, src < dst, of the distinct nodes of each group with ``low`` to ``high`` of them.

    Groups outside the bounds make no edge: the cap is the feature, so a group is never larger than ``high``.
    """
    m = members.select(*group, node).where(F.col(node).isNotNull()).distinct()
    sized = m.groupBy(*group).agg(F.count("*").alias("_n")).where(F.col("_n").between(low, high)).drop("_n")
    kept = m.join(sized, group)
    a = kept.select(*group, F.col(node).alias("src"))
    b = kept.select(*group, F.col(node).alias("dst"))
    return a.join(b, group).where("src < dst").select("src", "dst").distinct()


def resolve_ids(groups: DataFrame, live: DataFrame, id_col: str = "id") -> DataFrame:
    """``(id, resolved)``: for every id of the groups' arrays ``ids`` the smallest live id that the groups connect it
    with; null if none is live."""
    edges = groups.select(F.explode("ids").alias("src"), F.col("ids").getItem(0).alias("dst"))
    found = connected_components(edges)
    alive = found.join(live.select(F.col(id_col).alias("node")).distinct(), "node").groupBy("component").agg(F.min("node").alias("resolved"))
    return found.join(alive, "component", "left").select(F.col("node").alias(id_col), "resolved")


def family_graph(edges: DataFrame, persons: DataFrame, resolved: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes (family, id, name, wins, known) and edges (family, a, b, rel) of families.

    Ends are resolved first; edges from a person to themself go; ends that ``persons`` (id, name, wins) lacks become
    placeholder nodes without a name and with 0 wins.
    """
    e = edges
    if resolved is not None:
        for end in "ab":
            r = resolved.select(F.col("id").alias(end), F.col("resolved").alias(f"_{end}"))
            e = e.join(r, end, "left").withColumn(end, F.coalesce(f"_{end}", end)).drop(f"_{end}")
    e = e.where("a <> b").select("family", "a", "b", "rel").distinct()
    ends = e.select("family", F.col("a").alias("id")).unionByName(e.select("family", F.col("b").alias("id"))).distinct()
    nodes = ends.join(persons.select("id", "name", "wins", F.lit(True).alias("_known")), "id", "left")
    return nodes.select("family", "id", "name", F.coalesce("wins", F.lit(0)).alias("wins"), F.coalesce("_known", F.lit(False)).alias("known")), e


def block_families(a: DataFrame, b: DataFrame, persons: DataFrame, block: list[str]) -> tuple[DataFrame, DataFrame]:
    """``family_graph`` of edges that join all of ``a`` (family, block, id) with all of ``b`` (family, block, id, rel) of one block: nodes (family, id, name,
    wins, known, ties), and the edges. Ties, the edges a node has, are counted from the sizes of the blocks' sides, so that no edge is made for the nodes, whose work grows
    with the members; the edges are as many as there are pairs, and are made only where they are read. Repeated members count once; one that is on
    both sides of a block has no tie with itself. Members without an id go. A person is in one block of a family on each side; others are an error."""
    a, b = (d.select("family", *block, "id", *more).where("id is not null").distinct() for d, more in ((a, []), (b, ["rel"])))
    once = lambda d: d.select("family", *block, "id").distinct().groupBy("family", "id").agg(F.count("*").alias("_n"))
    check = once(a).unionByName(once(b)).agg(F.max("_n")).first()[0]
    if (check or 1) > 1:
        raise ValueError("a person is in several blocks of a family")
    key = ["family", *block]
    sizes = a.groupBy(*key).agg(F.count("*").alias("_a"), F.lit(0).cast("long").alias("_b")).unionByName(b.groupBy(*key).agg(F.lit(0).cast("long").alias("_a"), F.count("*").alias("_b")))
    sizes = sizes.groupBy(*key).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    side = lambda d, ours: d.select(*key, "id", F.lit(ours).alias("_on_a"), F.lit(1 - ours).alias("_on_b"))
    m = side(a, 1).unionByName(side(b, 0)).groupBy(*key, "id").agg(F.sum("_on_a").alias("_on_a"), F.sum("_on_b").alias("_on_b"))
    m = join_dim(m, sizes, key, "inner")
    # on both sides the tie with itself is left out of either count
    ties = F.col("_on_a") * F.col("_b") + F.col("_on_b") * F.col("_a") - 2 * F.col("_on_a") * F.col("_on_b")
    ends = m.groupBy("family", "id").agg(F.sum(ties).alias("ties")).where("ties > 0")
    nodes = ends.join(persons.select("id", "name", "wins", F.lit(True).alias("_known")), "id", "left")
    nodes = nodes.select("family", "id", "name", F.coalesce("wins", F.lit(0)).alias("wins"), F.coalesce("_known", F.lit(False)).alias("known"), "ties")
    edges = a.withColumnRenamed("id", "a").join(b.withColumnRenamed("id", "b"), key).where("a <> b").select("family", "a", "b", "rel")
    return nodes, edges


def component_regions(members: DataFrame, seat: str, unit: str, forced: DataFrame | None = None) -> DataFrame:
    """``(region, seats, units)``: seats that share units, directly or by others, make one region of all their units; ``forced`` (src,
    dst) joins seats besides. region is the smallest seat."""
    m = members.select(F.col(seat).alias("s"), F.col(unit).alias("u")).where("s is not null and u is not null").distinct()
    edges = m.join(m.groupBy("u").agg(F.min("s").alias("dst")), "u").select(F.col("s").alias("src"), "dst")
    found = connected_components(edges if forced is None else edges.unionByName(forced.select("src", "dst")))
    named = m.join(found.withColumnRenamed("node", "s"), "s", "left").withColumn("region", F.coalesce("component", "s"))
    return named.groupBy("region").agg(F.array_sort(F.collect_set("s")).alias("seats"), F.array_sort(F.collect_set("u")).alias("units"))


def _led_to(stage: Stage, pick: DataFrame) -> DataFrame:
    """``(part, whole)``: where picks (part, to), one a part, lead in the end. Circles are of two parts that pick each other; the smaller one stays. Four steps a round,
    then sixteen and so on."""
    back = pick.select(F.col("to").alias("part"), F.col("part").alias("to"), F.lit(True).alias("_back"))
    cur = stage.put(pick.join(back, ["part", "to"], "left").where("_back is null or part > to").select("part", "to"), "joined")
    while True:
        on, at = cur, "to"
        for step in ("_1", "_2", "_3"):
            on = on.join(cur.select(F.col("part").alias(at), F.col("to").alias(step)), at, "left")
            at = step
        cur = stage.put(on.select("part", F.coalesce("_3", "_2", "_1", "to").alias("to"), F.col("_3").isNotNull().alias("moved")), "joined")
        stage.drop("joined", keep_last=True)
        if cur.where("moved").isEmpty():
            return cur.select("part", F.col("to").alias("whole"))
        cur = cur.select("part", "to")


def basins(edges: DataFrame, seeds: DataFrame, a: str = "a", b: str = "b", weight: str = "w") -> DataFrame:
    """``(node, label)``: each node's seed (node, label) in the forest of least edges that joins every node to one seed: flooding from the seeds, lowest
    pass first. Edges are undirected; of equal weights the one with the smaller ends comes first. Nodes that no seed reaches have a null label.

    In rounds every part without a seed joins along its least edge, and parts that join are one; a part with a seed waits to be joined, so no two seeds
    meet. A round at least halves the parts without one. Picks are followed by pointer jumping; a part keeps the name of its seed's."""
    stage = Stage(edges.sparkSession, "basins")
    e = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("a"), F.col(b).alias("b"), F.struct(F.col(weight).alias("w"), F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).alias("w"))
    e = stage.put(e, "edges")
    of = e.select(F.col("a").alias("node")).unionByName(e.select(F.col("b").alias("node"))).unionByName(seeds.select("node")).distinct()
    of = stage.put(of.withColumn("part", F.col("node")), "of")
    labels = stage.put(seeds.select(F.col("node").alias("part"), "label"), "labels")
    while True:
        ends = e.select(F.col("a").alias("part"), F.col("b").alias("to"), "w").unionByName(e.select(F.col("b").alias("part"), F.col("a").alias("to"), "w"))
        pick = ends.join(labels.select("part"), "part", "left_anti").groupBy("part").agg(F.min(F.struct("w", "to")).alias("m")).select("part", F.col("m.to").alias("to"))
        pick = stage.put(pick, "pick")
        if pick.isEmpty():
            break
        joined = _led_to(stage, pick)
        now = lambda d, c: d.join(joined.withColumnRenamed("part", c), c, "left").withColumn(c, F.coalesce("whole", c)).drop("whole")  # noqa: B023,E731
        of = stage.put(now(of, "part"), "of")
        moved = now(now(e, "a"), "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w")
        e = stage.put(moved.groupBy("a", "b").agg(F.min("w").alias("w")), "edges")
        for name in ("of", "edges", "joined"):
            stage.drop(name, keep_last=True)
    return of.join(labels, "part", "left").select("node", "label")
