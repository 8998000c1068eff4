"""Contests over orders and customers: a nation's orders of a year are the votes of its customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlake.functions import textnorm
from quorumlake.functions.textnorm import recode
from quorumlake.operators import contest as C
from quorumlake.plans.registry import Tables, query

CAND = """cand AS (
  SELECT year(o_orderdate)::INT AS year, c_nationkey AS seat, c_custkey AS candidate, c_mktsegment AS party, COUNT(*) AS votes
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
RANKED = CAND + """, ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY year, seat ORDER BY votes DESC, candidate) AS rk,
         SUM(votes) OVER (PARTITION BY year, seat) AS total, LEAD(votes) OVER (PARTITION BY year, seat ORDER BY votes DESC, candidate) AS nxt
  FROM cand)"""
CONTEST = ["year", "seat"]


def candidacies(t: Tables) -> DataFrame:
    """(year, seat, candidate, party, votes). Orders are summed by customer and year before the join."""
    per = t.orders.groupBy(F.year("o_orderdate").alias("year"), "o_custkey").agg(F.count("*").alias("votes"))
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("seat"), F.col("c_mktsegment").alias("party"))
    return per.join(c, per["o_custkey"] == c["c_custkey"]).select("year", "seat", F.col("c_custkey").alias("candidate"), "party", "votes")


@query(f"WITH {RANKED} SELECT year, seat, candidate, party, votes, rk::BIGINT AS rank FROM ranked WHERE rk <= 6")
def contest_topk(t):
    top = C.top_k(candidacies(t), CONTEST, "votes", ["candidate"], 6)
    return top.withColumn("rank", F.col("rank").cast("long"))


@query(f"""WITH {RANKED} SELECT year, seat, candidate AS winner, party AS winner_party, votes AS winner_votes, nxt AS runner_up_votes,
  total::BIGINT AS total_votes, round(100.0 * votes / total, 1) AS winner_share, round(100.0 * (votes - nxt) / total, 1) AS margin FROM ranked WHERE rk = 1""")
def contest_winner_margin(t):
    r = C.results(candidacies(t), CONTEST, "candidate", "party", "votes", ["candidate"])
    return r.select(*CONTEST, "winner", "winner_party", "winner_votes", "runner_up_votes", "total_votes", "winner_share", "margin")


@query(f"""WITH {RANKED} SELECT year, COUNT(*) AS seats, COUNT(*) FILTER (round(100.0 * (votes - nxt) / total, 1) < 2) AS tight,
  SUM(n)::BIGINT AS candidates FROM ranked JOIN (SELECT year, seat, COUNT(*) AS n FROM cand GROUP BY ALL) USING (year, seat) WHERE rk = 1 GROUP BY year""")
def contest_headlines(t):
    r = C.results(candidacies(t), CONTEST, "candidate", "party", "votes", ["candidate"])
    return r.groupBy("year").agg(F.count("*").alias("seats"), F.count_if(F.col("margin") < 2).alias("tight"), F.sum("n_candidates").alias("candidates"))


@query(f"WITH {RANKED} SELECT year, party, COUNT(*) AS seats FROM ranked WHERE rk = 1 GROUP BY ALL")
def contest_tally(t):
    return C.top_k(candidacies(t), CONTEST, "votes", ["candidate"], 1).groupBy("year", "party").agg(F.count("*").alias("seats"))


@query(f"""WITH {RANKED}, tally AS (SELECT year, party, COUNT(*) AS seats FROM ranked WHERE rk = 1 GROUP BY ALL)
SELECT year, party, seats, (SUM(seats) OVER w - seats)::BIGINT AS "start", (SUM(seats) OVER w)::BIGINT AS "end" FROM tally
WINDOW w AS (PARTITION BY year ORDER BY seats DESC, party ROWS UNBOUNDED PRECEDING)""")
def tally_layout(t):
    return C.running_layout(contest_tally(t), [F.desc("seats"), "party"], "seats", ["year"]).select("year", "party", "seats", "start", "end")


SHARES = CAND + """, shares AS (SELECT year, party, round(100.0 * SUM(votes) / SUM(SUM(votes)) OVER (PARTITION BY year), 2) AS share FROM cand GROUP BY year, party)"""


def shares(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    s = candidacies(t).groupBy("year", "party").agg(F.sum("votes").alias("v"))
    return s.select("year", "party", F.round(F.lit(100.0) * F.col("v") / F.sum("v").over(Window.partitionBy("year")), 2).alias("share"))


@query(f"WITH {SHARES} SELECT year, party, share FROM shares")
def vote_shares(t):
    return shares(t)


@query(f"""WITH {SHARES}, link(new, old) AS (VALUES ('MACHINERY', 'FURNITURE')),
base AS (SELECT year + 1 AS year, COALESCE(new, party) AS party, SUM(share) AS b FROM shares LEFT JOIN link ON party = old GROUP BY ALL),
lim AS (SELECT MIN(year) AS lo, MAX(year) AS hi FROM shares),
d AS (SELECT COALESCE(s.year, base.year) AS year, COALESCE(s.party, base.party) AS party, round(COALESCE(share, 0) - COALESCE(b, 0), 2) AS swing
  FROM shares s FULL JOIN base ON s.year = base.year AND s.party = base.party)
SELECT year, party, swing, rk::BIGINT AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY year ORDER BY abs(swing) DESC, party) AS rk FROM d, lim WHERE year > lo AND year <= hi) WHERE rk <= 2""")
def vote_share_swing(t):
    from pyspark.sql import Window

    link = t.spark.createDataFrame([("MACHINERY", "FURNITURE")], "new string, old string")
    d = C.swings(shares(t), "year", "party", "share", link).withColumn("swing", F.round("swing", 2))
    w = Window.partitionBy("year").orderBy(F.abs("swing").desc(), "party")
    return d.withColumn("rank", F.row_number().over(w).cast("long")).where("rank <= 2").select("year", "party", "swing", "rank")


@query("""SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def dedupe_keep_first(t):
    d = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return C.keep_first(d, ["o_custkey", "o_orderstatus"], ["o_orderkey"])


@query("""WITH c AS (SELECT l_suppkey, l_returnflag, COUNT(*) AS n, MIN(l_orderkey * 8 + l_linenumber)::BIGINT AS first_seen FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_returnflag, n, first_seen FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY n DESC, first_seen) AS rn FROM c) WHERE rn = 1""")
def mode_first_seen(t):
    d = t.lineitem.select("l_suppkey", "l_returnflag", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"))
    m = C.mode_first(d, ["l_suppkey"], "l_returnflag", "pos")
    first = d.groupBy("l_suppkey", "l_returnflag").agg(F.min("pos").alias("first_seen"))
    return m.join(first, ["l_suppkey", "l_returnflag"]).select("l_suppkey", "l_returnflag", "n", "first_seen")


@query("""WITH c AS (SELECT l_suppkey, l_linestatus || l_returnflag AS v, COUNT(*) AS n, SUM(l_quantity::DECIMAL(18,2)) AS m FROM lineitem GROUP BY ALL),
x AS (SELECT *, MAX(n) OVER (PARTITION BY l_suppkey) AS mx, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY n DESC, m DESC, v) AS rn FROM c)
SELECT l_suppkey, v, n, (SELECT COUNT(*) FROM c WHERE c.l_suppkey = x.l_suppkey AND c.n = x.mx) > 1 AS tied FROM x WHERE rn = 1""")
def contest_mode_tiebreak(t):
    d = t.lineitem.select("l_suppkey", F.concat("l_linestatus", "l_returnflag").alias("v"), F.col("l_quantity").cast("decimal(18,2)").alias("q"))
    return C.mode_tiebreak(d, ["l_suppkey"], "v", "q").select("l_suppkey", "v", "n", "tied")


@query("""SELECT l_suppkey, round((SUM(l_discount::DECIMAL(18,4) * l_quantity::DECIMAL(18,4)) FILTER (l_returnflag <> 'R'))::DOUBLE
  / (SUM(l_quantity::DECIMAL(18,4)) FILTER (l_returnflag <> 'R'))::DOUBLE, 6) AS mean FROM lineitem GROUP BY l_suppkey""")
def weighted_mean_turnout(t):
    value = F.when(F.col("l_returnflag") != "R", F.col("l_discount"))
    return t.lineitem.groupBy("l_suppkey").agg(F.round(C.weighted_mean(value, F.col("l_quantity")), 6).alias("mean"))


@query("""WITH r AS (SELECT o_custkey % 50 AS unit, CASE WHEN o_custkey % 50 < 20 AND o_orderstatus = 'F' THEN o_orderkey % 1000 END AS reg,
  CASE WHEN o_custkey % 50 < 40 THEN 1 + o_orderkey % 90 END AS wv, 10.0 + o_orderkey % 80 AS ws FROM orders)
SELECT unit, COALESCE(SUM(reg)::DOUBLE, SUM(round(wv * 100.0 / ws)), 100000.0 * COUNT(*)) AS electorate FROM r GROUP BY unit""")
def electorate_fallback(t):
    u = F.col("o_custkey") % 50
    r = t.orders.select(
        u.alias("unit"), F.when((u < 20) & (F.col("o_orderstatus") == "F"), F.col("o_orderkey") % 1000).alias("reg"),
        F.when(u < 40, 1 + F.col("o_orderkey") % 90).alias("wv"), (F.lit(10.0) + F.col("o_orderkey") % 80).alias("ws"),
    )
    return C.electorate(r, ["unit"], F.col("reg"), F.col("wv"), F.col("ws"))


@query(f"""WITH {RANKED} SELECT year, seat, string_agg(candidate || ':' || votes, ';' ORDER BY rk) AS cands FROM ranked WHERE rk <= 3 GROUP BY ALL""")
def results_document(t):
    """Nested candidates, shown flat: ``candidate:votes`` of the first three."""
    d = C.candidates_array(candidacies(t), CONTEST, "votes", ["candidate"], {"n": "candidate", "v": "votes"}, 3)
    return d.select(*CONTEST, F.array_join(F.transform("cands", lambda x: F.concat_ws(":", x["n"].cast("string"), x["v"].cast("string"))), ";").alias("cands"))


@query("""SELECT p_brand, CASE p_brand WHEN 'Brand#11' THEN 'Alpha' WHEN 'Brand#22' THEN 'Beta' ELSE p_brand END AS brand,
  CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END AS bucket, COUNT(*) AS n FROM part GROUP BY ALL""")
def recode_and_bucket(t):
    bucket = textnorm.bucket(F.col("p_size"), [10, 30], ["small", "medium", "large"])
    brand = recode(F.col("p_brand"), {"Brand#11": "Alpha", "Brand#22": "Beta"})
    return t.part.groupBy("p_brand", brand.alias("brand"), bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderpriority AS label, CASE WHEN lower(trim(o_orderpriority)) = '1-urgent' AND year(o_orderdate) < 1995 THEN 'U-old'
  WHEN lower(trim(o_orderpriority)) = '1-urgent' THEN 'U-new' ELSE 'other' END AS code, COUNT(*) AS n FROM orders GROUP BY ALL""")
def range_recode(t):
    from quorumlake.functions.textnorm import party_by_year

    code = party_by_year(F.col("o_orderpriority"), F.year("o_orderdate"), [("1-urgent", 0, 1994, "U-old"), ("1-urgent", 1995, 9999, "U-new")], F.lit("other"))
    return t.orders.groupBy(F.col("o_orderpriority").alias("label"), code.alias("code")).agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN source IN ('src1', 'src2') THEN 'low' WHEN starts_with(source, 'src0') OR starts_with(source, 'src3') THEN 'high' ELSE 'medium' END AS confidence,
  COUNT(*) AS n FROM documents GROUP BY ALL""")
def confidence_class(t):
    c = textnorm.confidence(F.col("source"), ["src1", "src2"], ["src0", "src3"])
    return t.documents.groupBy(c.alias("confidence")).agg(F.count("*").alias("n"))


@query("""SELECT d.doc_id, quality, (ROW_NUMBER() OVER (ORDER BY quality ASC NULLS LAST, d.doc_id))::BIGINT AS up,
  (ROW_NUMBER() OVER (ORDER BY quality DESC NULLS FIRST, d.doc_id))::BIGINT AS down FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def null_ordering(t):
    """Positions in either direction: missing values last ascending, first descending."""
    from quorumlake.operators.ordering import global_rank

    d = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    up = global_rank(d, [C.asc("quality"), F.col("doc_id")], "up")
    return global_rank(up, [C.desc("quality"), F.col("doc_id")], "down").select("doc_id", "quality", "up", "down")


@query("""SELECT s_suppkey, (ROW_NUMBER() OVER (PARTITION BY s_nationkey ORDER BY regexp_extract(s_name, '([0-9]+)$', 1)::BIGINT))::BIGINT AS pos FROM supplier""")
def natural_order(t):
    """Ids that end in a number, in the order of the number."""
    from pyspark.sql import Window

    n = textnorm.natural_number(F.col("s_name"))
    return t.supplier.select("s_suppkey", F.row_number().over(Window.partitionBy("s_nationkey").orderBy(n)).cast("long").alias("pos"))


@query(f"""WITH {CAND} SELECT p.year, p.seat, p.party, tier FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY seat ORDER BY tier, year) AS rn FROM (
  SELECT seat, year, party, CASE WHEN year = 1996 THEN 0 WHEN year = 1997 THEN 1 ELSE 2 END AS tier FROM cand WHERE votes >= 4 AND (year IN (1996, 1997) OR year < 1995)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY seat, year ORDER BY candidate) = 1)) p WHERE rn = 1""")
def priority_join(t):
    """A seat's row from the first year that has one: 1996, else 1997, else the earliest before 1995."""
    c = candidacies(t).where("votes >= 4")
    c = C.keep_first(c, ["seat", "year"], ["candidate"]).select("year", "seat", "party")
    return C.priority([c.where("year = 1996"), c.where("year = 1997"), c.where("year < 1995")], ["seat"], ["year"]).select("year", "seat", "party", "tier")


@query("""WITH s AS (SELECT s_nationkey AS k, s_suppkey, ROW_NUMBER() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS o FROM supplier),
c AS (SELECT c_nationkey AS k, c_custkey, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS o FROM customer)
SELECT k, o::BIGINT AS ordinal, s_suppkey, c_custkey FROM s JOIN c USING (k, o)""")
def ordinal_pairing(t):
    s = t.supplier.select(F.col("s_nationkey").alias("k"), "s_suppkey")
    c = t.customer.select(F.col("c_nationkey").alias("k"), "c_custkey", "c_acctbal")
    p = C.ordinal_pairs(s, c, ["k"], ["s_suppkey"], [F.desc("c_acctbal"), "c_custkey"])
    return p.select("k", F.col("ordinal").cast("long").alias("ordinal"), "s_suppkey", "c_custkey")


@query(f"""WITH {RANKED}, g AS (SELECT year, CASE WHEN party IN ('AUTOMOBILE', 'MACHINERY') THEN 'industry' ELSE 'home' END AS grp, party, votes FROM cand)
SELECT year, grp AS "group", party, SUM(votes)::BIGINT AS votes FROM g GROUP BY ROLLUP(year, grp, party) HAVING year IS NOT NULL""")
def group_rollup(t):
    """Votes of a year, its groups of parties and their parties, in one rollup."""
    grp = F.when(F.col("party").isin("AUTOMOBILE", "MACHINERY"), "industry").otherwise("home")
    c = candidacies(t).withColumn("group", grp)
    return c.rollup("year", "group", "party").agg(F.sum("votes").alias("votes")).where("year is not null")


@query(f"""WITH {RANKED}, e AS (SELECT year, seat, party FROM ranked WHERE rk = 1), f AS (SELECT year, seat, party FROM ranked WHERE rk = 2)
SELECT e.year, COUNT(*) AS checked, COUNT(*) FILTER (e.party = f.party) AS agree, round(100.0 * COUNT(*) FILTER (e.party = f.party) / COUNT(*), 1) AS rate
FROM e JOIN f USING (year, seat) GROUP BY e.year""")
def agreement_by_year(t):
    r = C.results(candidacies(t), CONTEST, "candidate", "party", "votes", ["candidate"]).where("runner_up is not null")
    same = F.col("winner_party") == F.col("runner_up_party")
    return r.groupBy("year").agg(F.count("*").alias("checked"), F.count_if(same).alias("agree"), F.round(100.0 * F.count_if(same) / F.count("*"), 1).alias("rate"))
