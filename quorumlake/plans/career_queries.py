"""Careers over candidacies and events, and linkage over customers, parts and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.functions import similarity as S
from quorumlake.operators import career as K
from quorumlake.operators import contest as C
from quorumlake.operators import graph as G
from quorumlake.operators import linkage as L
from quorumlake.plans.contest_queries import CAND, CONTEST, RANKED, candidacies
from quorumlake.plans.registry import Tables, query

STEPS = """steps AS (SELECT user_id, event_type AS p, LEAD(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS q FROM events)"""


def event_steps(t: Tables) -> DataFrame:
    return K.steps(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"], ["event_type"])


@query(f"WITH {STEPS} SELECT p AS from_type, q AS to_type, COUNT(*) AS n FROM steps WHERE q IS NOT NULL GROUP BY ALL")
def transition_counts(t):
    return K.transitions(event_steps(t), ["event_type", "next_event_type"]).toDF("from_type", "to_type", "n")


@query(f"""WITH {STEPS} SELECT p AS event_type, COUNT(*) FILTER (p = q) AS stayed, COUNT(*) AS total, round(COUNT(*) FILTER (p = q) / COUNT(*)::DOUBLE, 3) AS rate
FROM steps WHERE q IS NOT NULL AND p <> 'signup' AND q <> 'signup' GROUP BY p HAVING COUNT(*) >= 30""")
def retention(t):
    return K.retention(event_steps(t), "event_type", "next_event_type", ["event_type"], 30, "signup")


@query(f"""WITH {RANKED}, best AS (SELECT candidate, year, rk FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY candidate, year ORDER BY (rk > 1), rk, seat) AS rn FROM ranked) WHERE rn = 1)
SELECT candidate, year, rk::BIGINT AS rank, rk = 1 AS won FROM best""")
def best_row_per_person_year(t):
    r = C.ranked(candidacies(t), CONTEST, "votes", ["candidate"])
    b = K.best_rows(r.withColumn("rank", F.col("rank").cast("string")), "candidate", "year", F.col("rank") == "1", "rank", ["seat"])
    return b.select("candidate", "year", F.col("rank").cast("long").alias("rank"), (F.col("rank") == "1").alias("won"))


WON = RANKED + """, w AS (SELECT candidate AS person, year, rk <= 5 AS won FROM ranked),
n AS (SELECT *, LEAD(year) OVER p AS ny, LEAD(won) OVER p AS nw, MIN(year) OVER (PARTITION BY person) AS f FROM w WINDOW p AS (PARTITION BY person ORDER BY year))"""


def seats_won(t: Tables) -> DataFrame:
    """(person, year, won): one of the first five of a contest has won."""
    r = C.ranked(candidacies(t), CONTEST, "votes", ["candidate"])
    return r.select(F.col("candidate").alias("person"), "year", (F.col("rank") <= 5).alias("won"))


@query(f"""WITH {WON} SELECT year, COUNT(*) AS winners, COUNT(*) FILTER (ny = year + 1) AS ran_again, COUNT(*) FILTER (ny = year + 1 AND nw) AS won_again,
  COUNT(*) FILTER (f = year) AS newcomers, round(COUNT(*) FILTER (ny = year + 1 AND nw) / GREATEST(COUNT(*) FILTER (ny = year + 1), 1)::DOUBLE, 3) AS rate FROM n WHERE won GROUP BY year""")
def turnover(t):
    return K.turnover(seats_won(t), "person", "year", "won")


@query(f"""WITH {WON}, cal AS (SELECT DISTINCT year, DENSE_RANK() OVER (ORDER BY year) AS no FROM w WHERE year <> 1995),
s AS (SELECT person, no, LEAD(no) OVER (PARTITION BY person ORDER BY year) AS nn FROM w JOIN cal USING (year))
SELECT (nn - no = 1) AS adjacent, COUNT(*) AS n FROM s WHERE nn IS NOT NULL GROUP BY ALL""")
def adjacent_period_filter(t):
    """Steps between neighbouring polls of a calendar in which 1995 had none."""
    rows = seats_won(t)
    years = [r.year for r in rows.select("year").distinct().where("year <> 1995").collect()]  # a row a poll
    cal = t.spark.createDataFrame([(y, i + 1) for i, y in enumerate(sorted(years))], "year int, period_no int")
    s = K.steps(K.with_period(rows, cal, "year"), "person", ["year"], ["period_no"])
    return s.groupBy((F.col("next_period_no") - F.col("period_no") == 1).alias("adjacent")).agg(F.count("*").alias("n"))


@query(f"WITH {STEPS} SELECT user_id, COUNT(*) AS switches FROM steps WHERE q IS NOT NULL AND p <> q GROUP BY user_id ORDER BY switches DESC, user_id LIMIT 40")
def serial_switchers(t):
    return K.switches(event_steps(t), "user_id", "event_type", "next_event_type").orderBy(F.desc("switches"), "user_id").limit(40)


@query("""SELECT user_id, COUNT(*) AS n, COUNT(DISTINCT event_type) AS kinds, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS kind_list,
  MIN(ts) AS first_ts, MAX(ts) AS last_ts, arg_min(event_type, (ts, event_id)) AS first_kind FROM events GROUP BY user_id""")
def longest_careers(t):
    c = K.spans(t.events, "user_id", "ts", ["event_id"], "event_type")
    return c.select(
        "user_id", "n", F.size("kinds").cast("long").alias("kinds"), F.array_join("kinds", "|").alias("kind_list"),
        F.col("first").alias("first_ts"), F.col("last").alias("last_ts"), F.col("first_value").alias("first_kind"),
    )


@query("SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS n FROM events GROUP BY ALL HAVING COUNT(*) > 1")
def multi_seat(t):
    """Several rows of a person in one period."""
    return K.multi_seat(t.events.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")), ["user_id", "day"])


@query(f"""WITH {WON}, p AS (SELECT ranked.seat, w.person, COUNT(*) AS k FROM w JOIN ranked ON ranked.candidate = w.person AND ranked.year = w.year WHERE won GROUP BY ALL)
SELECT seat, SUM(k)::BIGINT AS wins, COUNT(*) AS winners, round(SUM(CASE WHEN k >= 2 THEN k ELSE 0 END) / SUM(k)::DOUBLE, 3) AS held_by_2,
  round(SUM(CASE WHEN k >= 3 THEN k ELSE 0 END) / SUM(k)::DOUBLE, 3) AS held_by_3 FROM p GROUP BY seat""")
def persistence(t):
    r = C.ranked(candidacies(t), CONTEST, "votes", ["candidate"]).where("rank <= 5")
    return K.persistence(r, ["seat"], "candidate")


@query(f"""WITH {CAND}, x AS (SELECT party AS person, seat % 5 AS district, year FROM cand WHERE votes >= 4)
SELECT person, COUNT(*) AS wins, string_agg(DISTINCT district::VARCHAR, '|' ORDER BY district::VARCHAR) AS districts FROM x GROUP BY person HAVING COUNT(*) >= 2 AND COUNT(DISTINCT district) >= 2""")
def seat_moves(t):
    x = candidacies(t).where("votes >= 4").select(F.col("party").alias("person"), (F.col("seat") % 5).cast("string").alias("district"))
    return K.seat_moves(x, "person", "district").withColumn("districts", F.array_join("districts", "|"))


# ---------------------------------------------------------------- linkage


@query("""WITH b AS (SELECT c_custkey, c_nationkey AS k1, c_mktsegment AS k2, replace(c_name, '#', '') AS nm FROM customer),
sz AS (SELECT k1, k2 FROM b GROUP BY ALL HAVING COUNT(*) BETWEEN 2 AND 400)
SELECT a.c_custkey AS a, b.c_custkey AS b FROM b a JOIN b ON a.k1 = b.k1 AND a.k2 = b.k2 AND a.c_custkey < b.c_custkey JOIN sz ON sz.k1 = a.k1 AND sz.k2 = a.k2
WHERE levenshtein(a.nm, b.nm) <= 1""")
def block_pairs(t):
    """Pairs inside blocks of nation and segment whose names are one edit apart."""
    b = t.customer.select(F.col("c_custkey").alias("id"), F.lit("t").alias("kind"), F.concat_ws("|", "c_nationkey", "c_mktsegment").alias("key"))
    names = t.customer.select(F.col("c_custkey").alias("id"), F.replace("c_name", F.lit("#"), F.lit("")).alias("nm"))
    p = L.block_pairs(b, "id", cap=400, uncapped=())
    p = p.join(names.select(F.col("id").alias("a"), F.col("nm").alias("na")), "a").join(names.select(F.col("id").alias("b"), F.col("nm").alias("nb")), "b")
    return p.where(S.within_edits(F.col("na"), F.col("nb"))).select("a", "b")


@query("""SELECT token, COUNT(DISTINCT doc_id) AS df FROM (SELECT doc_id, UNNEST(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents) GROUP BY token HAVING COUNT(DISTINCT doc_id) <= 60""")
def token_df(t):
    d = t.documents.select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)).alias("tokens"))
    return L.token_frequency(d, "doc_id", "tokens").where("df <= 60")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_orderkey AS o, (l_partkey * 1000000 + l_suppkey) * 100 + l_quantity::INT AS s FROM lineitem), m AS (SELECT o, MIN(s) AS s FROM e GROUP BY o),
p AS MATERIALIZED (SELECT e.s AS x, m.s AS y FROM e JOIN m USING (o) WHERE e.s <> m.s UNION SELECT m.s, e.s FROM e JOIN m USING (o) WHERE e.s <> m.s),
r(n, c) AS (SELECT x, x FROM p UNION SELECT r.n, p.y FROM r JOIN p ON p.x = r.c)
SELECT n AS node, LEAST(n, MIN(c)) AS component FROM r GROUP BY n""")
def components(t):
    """Parts of a supplier, by quantity, that were ordered together, directly or through others."""
    e = t.lineitem.select("l_orderkey", ((F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")) * 100 + F.col("l_quantity").cast("int")).alias("id"))
    e = e.repartition("l_orderkey").distinct()  # an order is few rows: dealt once, its smallest one and its edges need no other shuffle
    return G.connected_components(L.star_edges(e, ["l_orderkey"], "id"))


@query("""WITH m AS (SELECT DISTINCT p_brand AS tok, p_size AS dist, p_partkey AS person FROM part), z AS (SELECT tok, dist FROM m GROUP BY ALL HAVING COUNT(*) BETWEEN 2 AND 8)
SELECT DISTINCT a.person AS src, b.person AS dst FROM m a JOIN m b ON a.tok = b.tok AND a.dist = b.dist AND a.person < b.person JOIN z ON z.tok = a.tok AND z.dist = a.dist""")
def capped_cliques(t):
    return G.capped_clique_edges(t.part, ["p_brand", "p_size"], "p_partkey")


@query("""WITH r(rule_no, person_id, year, district, merge_into) AS (VALUES (1, '3', 1995, NULL, NULL), (2, '3', NULL, 'BUILDING', '7'), (3, '5', NULL, NULL, 'X5')),
d AS (SELECT c_custkey AS row_id, c_nationkey::VARCHAR AS person, 1992 + c_custkey % 7 AS year, c_mktsegment AS district FROM customer),
h AS (SELECT d.row_id, COALESCE(r.merge_into, 'PX' || lpad(r.rule_no::VARCHAR, 3, '0')) AS p, ROW_NUMBER() OVER (PARTITION BY d.row_id ORDER BY rule_no DESC) AS rn
  FROM d JOIN r ON r.person_id = d.person AND (r.year IS NULL OR r.year = d.year) AND (r.district IS NULL OR r.district = d.district)),
s AS (SELECT d.row_id, COALESCE(h.p, d.person) AS person FROM d LEFT JOIN h ON h.row_id = d.row_id AND rn = 1)
SELECT row_id, CASE WHEN person IN ('9', '10', 'PX001') THEN '10' WHEN person IN ('11', '12') THEN '11' ELSE person END AS person FROM s""")
def override_split_merge(t):
    rules = t.spark.createDataFrame(
        [(1, "3", 1995, None, None, None, None), (2, "3", None, "BUILDING", None, None, "7"), (3, "5", None, None, None, None, "X5")],
        "rule_no int, person_id string, year int, district string, district_contains string, name_contains string, merge_into string",
    )
    d = t.customer.select(
        F.col("c_custkey").alias("row_id"), F.col("c_nationkey").cast("string").alias("person"), (1992 + F.col("c_custkey") % 7).cast("int").alias("year"),
        F.col("c_mktsegment").alias("district"), F.col("c_name").alias("core"),
    )
    merges = t.spark.createDataFrame([(["9", "10"],), (["PX001", "10"],), (["12", "11"],)], "ids array<string>")
    return L.apply_merges(L.apply_splits(d, rules), merges).select("row_id", "person")


@query("""WITH s AS (SELECT l_orderkey AS cluster, l_suppkey AS person, COUNT(*) AS score FROM lineitem GROUP BY ALL), m AS (SELECT *, MAX(score) OVER (PARTITION BY cluster) AS b FROM s)
SELECT cluster, MIN(person) AS person, MIN(score) AS score FROM m WHERE score = b GROUP BY cluster HAVING COUNT(*) = 1""")
def ambiguity_reject(t):
    s = t.lineitem.groupBy(F.col("l_orderkey").alias("cluster"), F.col("l_suppkey").alias("person")).agg(F.count("*").alias("score"))
    return L.unambiguous(s)


@query("""WITH y AS (SELECT o_custkey AS k, MIN(year(o_orderdate)) AS lo, MAX(year(o_orderdate)) AS hi, COUNT(*) AS n FROM orders GROUP BY ALL),
x AS (SELECT c_custkey, (hi - lo) * 6 AS gap, c_mktsegment = 'BUILDING' AS sq, c_nationkey < 12 AS dist, n FROM customer JOIN y ON k = c_custkey)
SELECT c_custkey, CASE WHEN gap <= 10 THEN (sq AND (dist OR n >= 14)) OR dist WHEN gap <= 20 THEN sq AND dist AND n >= 10 WHEN gap <= 35 THEN sq AND dist AND n >= 10 AND c_custkey % 2 = 0
  ELSE FALSE END AS linked FROM x""")
def gap_match(t):
    y = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi"), F.count("*").alias("n"))
    x = t.customer.join(y, "c_custkey")
    sq, district = F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey") < 12
    linked = L.gap_evidence((F.col("hi") - F.col("lo")) * 6, sq, F.lit(True), district, F.col("n"), F.col("n"), F.col("c_custkey") % 2 == 0)
    return x.select("c_custkey", linked.alias("linked"))


@query("""WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS t FROM part), l AS (SELECT DISTINCT p_partkey AS person, UNNEST(list_slice(t, GREATEST(len(t) - 1, 1), len(t))) AS token FROM w),
f AS (SELECT tok FROM (SELECT p_partkey, UNNEST(t) AS tok FROM w) GROUP BY tok HAVING COUNT(DISTINCT p_partkey) <= 250)
SELECT person, token FROM l JOIN f ON tok = token WHERE len(token) >= 3 AND token <> 'green'""")
def surname_tokens(t):
    return L.surname_tokens(t.part.select("p_partkey", "p_name"), "p_partkey", "p_name", ["green"], most=250).withColumnRenamed("p_partkey", "person")


@query("""SELECT conv_id, turn, role, LAG(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before, (ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn))::BIGINT AS rank FROM conversations""")
def conversation_sequence(t):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return t.conversations.select("conv_id", "turn", "role", F.lag("role").over(w).alias("before"), F.row_number().over(w).cast("long").alias("rank"))
