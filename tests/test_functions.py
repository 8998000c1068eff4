import pytest
from pyspark.sql import functions as F

from quorumlake.functions import extract as X
from quorumlake.functions import similarity as S
from quorumlake.functions import textnorm as N


@pytest.fixture(scope="module")
def val(spark):
    def get(**cols):
        df = spark.createDataFrame([tuple(cols["row"])], cols["schema"])
        return df.select(cols["expr"].alias("v")).first().v

    return lambda expr, schema="x int", row=(1,): get(expr=expr, schema=schema, row=row)


def test_names(val):
    f = lambda s: val(N.name_forms(F.col("s")), "s string", (s,))
    assert f("Kayan Mohd. Doe").squash == f("Kayan Muhammad Doe").squash == "kayanmuhammaddoe"
    r = f("Dr. Atta-ur-Rahman  X Qazí")
    assert (r.full, r.core, r.distinct) == ("dr atta ur rehman x qazi", "atta ur rehman qazi", "atta" + "ur" + "rehman" + "qazi")
    assert f(None).full == ""
    assert val(N.strip_accents(F.col("s")), "s string", ("Éàñ Ç̧ Åb Ёж",)) == "Ean C Ab Еж"


def test_districts_and_titles(val):
    d = lambda s: val(N.district_base(F.col("s")), "s string", (s,))
    assert d("Dera Ghazi Khan-II (Old)") == "dg khan" and d("Alpha-cum-Beta-IV") == "alpha cum beta" and d(None) == ""
    assert val(N.seat_units(F.col("s"), {"Bta": "Beta"}), "s string", ("Alpha-Cum-Bta-cum-Alpha-II",)) == ["Alpha", "Beta"]
    assert val(N.seat_title(F.col("s")), "s string", ("GE NA-12 - Alpha-I Detail Result",)) == "Alpha-I"
    vocab = F.array(F.lit("alpha"), F.lit("alpha beta"))
    got = val(N.greedy_segments(F.split(F.col("s"), " "), vocab), "s string", ("alpha beta gamma alpha",))
    assert [(r.phrase, r.known) for r in got] == [("alpha beta", True), ("gamma", False), ("alpha", True)]
    assert val(N.greedy_segments(F.array().cast("array<string>"), vocab)) == []
    r = val(N.normalised_title(F.col("s"), vocab, ["seat"]), "s string", ("Alpha Beta-cum-Alpha Gamma seat-III",))
    assert (r.title, r.unknown) == ("Alpha Beta-Cum-Alpha 3", 1)


def test_party_and_small_functions(val):
    p = lambda s: val(N.party(F.col("s"), {"ppp": "PPP"}), "s string", (s,))
    assert [p(x) for x in (" ppp ", "", None, "New ")] == ["PPP", "IND", "IND", "New"]
    rules = [("pml-q", 0, 2001, "OLD"), ("pml-q", 2002, 9999, "NEW")]
    y = lambda n: val(N.party_by_year(F.lit("PML-Q"), F.lit(n), rules, F.lit("?")))
    assert (y(1990), y(2002)) == ("OLD", "NEW")
    v = lambda s: val(N.vote_literal(F.col("s")), "s string", (s,))
    assert [v(x) for x in ("1,234", "9", "00", "1.000.000", "12a", None)] == [1234, None, None, None, None, None]
    assert val(N.last_real_party(F.lit("A|IND|B||IND"))) == "B" and val(N.last_real_party(F.lit("IND"))) is None
    assert val(N.shown(F.lit(1234))) == "1,234" and val(N.shown(F.lit(None).cast("int"))) == "—"
    assert val(N.pipe_split(F.lit("a||b"))) == ["a", "b"] and val(N.pipe_split(F.lit(None).cast("string"))) == []
    assert val(N.evidence(F.lit("sq"), F.lit(True), F.lit(14), F.lit(18))) == "sq+dL14 GAP18"
    assert abs(val(N.planar_km(F.lit(1.0), F.lit(0.0), F.lit(60.0))) - 55.66) < 0.01
    assert val(N.seat_number(F.lit("NA-12"))) == 12


def lcs_ratio(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return 100.0 if not a + b else 200.0 * t[-1][-1] / (len(a) + len(b))


def test_similarity(spark):
    pairs = [("kitten", "sitting"), ("", ""), ("a", ""), ("abc", "abc"), ("banana", "ananab"), ("xyz", "abc"), ("muhammadkhan", "mohammadkhan")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", S.indel_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [round(r.r, 6) for r in got] == [round(lcs_ratio(*p), 6) for p in pairs]
    assert round(got[0].r, 2) == 61.54
    one = spark.createDataFrame([("abc", "abc"), ("abc", "abd"), ("abc", "xyz")], "a string, b string")
    assert [r.v for r in one.select(S.within_edits(F.col("a"), F.col("b")).alias("v")).collect()] == [True, True, False]
    t = spark.createDataFrame([("b a", "a b")], "a string, b string")
    assert t.select(S.token_sort_ratio(F.col("a"), F.col("b")).alias("v")).first().v == 100.0
    s = spark.createDataFrame([(["a", "b", "c"], ["a", "b", "c", "khan"]), (["a", "b"], ["a", "b", "khan"]), (["a", "b", "c"], ["a", "b", "d"])], "a array<string>, b array<string>")
    assert [r.v for r in s.select(S.differ_by(F.col("a"), F.col("b"), ["khan"]).alias("v")).collect()] == [True, False, False]


def rows(val, expr, text):
    return [(r.name, r.party, r.votes) for r in val(expr, "s string", (text,))]


def test_page_rows(val):
    pipe = "x\n| **Candidate Name** | **Party** | Votes |\n|:--|---|---|\n| **A B** | P | 1,234 |\n| C | indpendent | 99 |\n| Total | | 1,333 |\n"
    assert rows(val, X.pipe_rows(F.col("s")), pipe) == [("A B", "P", 1234), ("C", "Independent", 99)]
    assert rows(val, X.pipe_rows(F.col("s")), "| Sole Person | P |\n| Other Person | Q |") == [("Sole Person", "", None)]
    assert rows(val, X.pipe_rows(F.col("s")), "no table") == []
    assert rows(val, X.pipe_rows(F.col("s")), "| Candidate Name | Party | Votes |\n| A B | P | 1,000,000 |\n| C D | P | 99 |\n| E F | P |") == [("A B", "", None), ("C D", "", 99)]
    plain = "Intro\nCandidate Name\nParty Name\nVotes\nA B\nP\n1,234\nC D\nQ\n77\nTotal\n1\n2\nE\nR\n88"
    assert rows(val, X.page_rows(F.col("s")), plain) == [("A B", "P", 1234), ("C D", "Q", 77)]
    assert rows(val, X.page_rows(F.col("s")), "Candidate Name\nVotes\nA B\n55") == [("A B", "", 55)]
    html = "<TABLE><tr><th>Name</th><td>x</td></tr><tr><td><b>A&nbsp;B</b></td><td>P &amp; Q</td><td>1.234</td></tr><tr><td>Total</td><td>z</td><td>99</td></tr></TABLE><title> T <i>x</i></title>"
    assert rows(val, X.html_rows(F.col("s")), html) == [("A B", "P & Q", 1234)]
    assert val(X.page_title(F.col("s")), "s string", (html,)) == "T x"


def test_quantiles_of_groups_with_ties_and_nulls(spark):
    import numpy as np

    from quorumlake.operators.quality import quantiles

    groups = {"a": [1.0] * 70 + [2.0, 3.5], "b": [4.0], None: [float(x * x % 101) for x in range(300)], "none": []}
    rows = [(g, v) for g, vs in groups.items() for v in [*vs, None]]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.g: (r.q0, r.q33, r.q50, r.q100, r.rms) for r in quantiles(df, "v", [0.0, 0.33, 0.5, 1.0], ["g"]).collect()}
        whole = quantiles(df, "v", [0.9]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(got) == {"a", "b", None}
    for g, mine in got.items():
        v = np.array(groups[g])
        np.testing.assert_allclose(mine, [*np.quantile(v, [0, 0.33, 0.5, 1]), np.sqrt((v * v).mean())], rtol=1e-12)
    every = np.concatenate([np.array(v) for v in groups.values()])
    np.testing.assert_allclose([whole[0].q90, whole[0].rms], [np.quantile(every, 0.9), np.sqrt((every * every).mean())])


def test_overlaps_with_a_least_number(spark):
    """The rare items of each set find all pairs with so many in common, whatever is frequent; nulls and repeats count for nothing."""
    import random

    r = random.Random(5)
    sets = {k: {r.randrange(25) for _ in range(r.randint(0, 12))} | ({99} if k % 3 else set()) for k in range(40)}
    rows = [(k, i) for k, s in sets.items() for i in s] + [(1, None), *[(2, i) for i in sets[2]]]
    df = spark.createDataFrame(rows, "k int, i int")
    for least in (1, 2, 4):
        got = {(x.a, x.b): (x.shared, round(x.iou, 9)) for x in S.overlaps(df, "k", "i", least).collect()}
        assert got == {(a, b): (n, round(n / len(sets[a] | sets[b]), 9)) for a in sets for b in sets if a < b and (n := len(sets[a] & sets[b])) >= least}


def test_overlaps_carry_no_sets_with_pairs(spark, monkeypatch):
    """Pairs are counted where a key's partners lie: what is staged is no larger than the sets. Items of very many keys are counted, too, alone and with others."""
    import random

    from quorumlake.plans import staging

    tables, put = {}, staging.Stage.put
    monkeypatch.setattr(staging.Stage, "put", lambda self, df, name: tables.setdefault(name, put(self, df, name)))
    r = random.Random(7)
    sets = {k: {r.randrange(40) for _ in range(12)} | {i for i in range(100, 106) if r.random() < 0.5} for k in range(50)}
    df = spark.createDataFrame([(k, i) for k, s in sets.items() for i in s], "k int, i int")
    want = lambda least: {(a, b): n for a in sets for b in sets if a < b and (n := len(sets[a] & sets[b])) >= least}
    for most in (4096, 20, 5):
        monkeypatch.setattr(S, "HEAVY", most)
        tables.clear()
        assert {(x.a, x.b): x.shared for x in S.overlaps(df, "k", "i", 4).collect()} == want(4)
        assert "sets" in tables and (most < 4096 or "hot" not in tables)
    monkeypatch.setattr(S, "HEAVY", 4096)
    plan = S._counted(df, [])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan and plan.count("Exchange hashpartitioning(a") + plan.count("Exchange hashpartitioning(i") == 2
