import random

from quorumlake.operators.graph import block_families, capped_clique_edges, connected_components, family_graph
from quorumlake.operators.ordering import global_rank


def groups(rows):
    out = {}
    for r in rows:
        out.setdefault(r.component, set()).add(r.node)
    assert all(min(v) == k for k, v in out.items())
    return sorted(map(sorted, out.values()))


def test_components_any_order(spark):
    edges = [("a", "b"), ("b", "c"), ("d", "e"), ("e", "d"), ("f", "f"), ("g", None)]
    for seed in range(2):
        random.Random(seed).shuffle(edges)
        df = spark.createDataFrame(edges, "src string, dst string")
        assert groups(connected_components(df).collect()) == [["a", "b", "c"], ["d", "e"]]


def test_components_long_path_and_empty(spark):
    path = list(range(60))
    random.Random(3).shuffle(path)
    df = spark.createDataFrame(list(zip(path, path[1:])), "src long, dst long")
    assert groups(connected_components(df).collect()) == [list(range(60))]
    assert connected_components(df.limit(0)).count() == 0


def test_settled_stars_leave_the_rounds(spark, monkeypatch):
    """Single stars are through before the first round, which sees no edge of them; the components of any graph stay the same."""
    from quorumlake.operators import graph as G

    seen, settled = [], G._settled

    def counted(stage, e):
        whole, rest = settled(stage, e)
        seen.append((whole.count(), rest.count()))
        return whole, rest

    monkeypatch.setattr(G, "_settled", counted)
    monkeypatch.setattr(G, "SETTLE", 0)
    stars = [(10 * k, 10 * k + i) for k in range(50) for i in (1, 2, 3)]
    chain = [(1000, 1001), (1001, 1002), (1003, 1002), (2000, 2005), (2001, 2005)]
    df = spark.createDataFrame(stars + chain, "src long, dst long")
    got = groups(connected_components(df).collect())
    assert seen[0] == (150, 5) and got == sorted([[10 * k + i for i in range(4)] for k in range(50)] + [[1000, 1001, 1002, 1003], [2000, 2001, 2005]])
    for seed in range(1):
        r = random.Random(seed)
        edges = [(r.randrange(300), r.randrange(300)) for _ in range(140)]
        of = {n: n for e in edges if e[0] != e[1] for n in e}
        for _ in of:
            for a, b in edges:
                if a != b:
                    of[a] = of[b] = min(of[a], of[b])
        assert {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()} == of


def test_capped_cliques(spark):
    rows = [("t1", 1), ("t2", 1), ("t2", 2), ("t2", 2)] + [("t8", i) for i in range(8)] + [("t9", i) for i in range(20, 29)]
    got = capped_clique_edges(spark.createDataFrame(rows, "g string, p long"), ["g"], "p")
    pairs = {(r.src, r.dst) for r in got.collect()}
    assert pairs == {(a, b) for a in range(8) for b in range(a + 1, 8)}


def test_global_rank(spark):
    df = spark.range(1000).selectExpr("(id * 37) % 1000 as k")
    got = {r.k: r["rank"] for r in global_rank(df, ["k"], partitions=7).collect()}
    assert got == {k: k + 1 for k in range(1000)}


def test_block_families_make_no_edges(spark):
    """Nodes and ties as by the edges, with repeats, persons on both sides, two relations and members without an id; no plan of nodes meets the two sides."""
    from pyspark.sql import functions as F

    r = random.Random(4)
    a = [("fg"[i % 2], i % 6, i) for i in range(30)] + [("f", 0, 0), ("f", 2, None)]
    b = [("fg"[i % 2], i % 6, i, r.choice("xy")) for i in range(10, 60)] + [("f", 2, 8, "x"), ("f", 2, 8, "z"), ("g", 7, 777, "x"), ("f", None, 5, "x")]
    one, other = spark.createDataFrame(a, "family string, k int, id int"), spark.createDataFrame(b, "family string, k int, id int, rel string")
    persons = spark.createDataFrame([(i, f"n{i}", i % 5) for i in range(0, 60, 2)], "id int, name string, wins int")
    nodes, edges = block_families(one, other, persons, ["k"])
    e = one.withColumnRenamed("id", "a").join(other.withColumnRenamed("id", "b"), ["family", "k"])
    want, kept = family_graph(e, persons)
    ties = kept.select("family", F.explode(F.array("a", "b")).alias("id")).groupBy("family", "id").agg(F.count("*").alias("ties"))
    assert sorted(map(tuple, nodes.collect()), key=repr) == sorted(map(tuple, want.join(ties, ["family", "id"]).select(nodes.columns).collect()), key=repr)
    assert sorted(map(tuple, edges.collect())) == sorted(map(tuple, kept.collect()))
    many = spark.range(100_000).selectExpr("'f' as family", "1 as k", "cast(id as int) as id", "'x' as rel")
    assert block_families(many, many, persons, ["k"])[0].agg(F.sum("ties")).first()[0] == 2 * 100_000 * 99_999  # 10^10 edges
