"""Text extraction and normalisation over pages, documents, parts and events; set operations and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quorumlake.functions import extract as X
from quorumlake.functions import similarity as S
from quorumlake.functions import textnorm as N
from quorumlake.operators import contest as C
from quorumlake.operators import quality as Q
from quorumlake.operators.segment import greedy_segments
from quorumlake.plans.joins import join_dim
from quorumlake.plans.registry import query
from quorumlake.sources import sinks
from quorumlake.streaming import events as E


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', ' ', 'g'),
  '&nbsp;', ' '), '&amp;', '&'), '&#39;', ''''), '&quot;', '"'), '\s+', ' ', 'g')) AS title FROM pages""")
def title_clean(t):
    return t.pages.select("page_id", X.page_title(F.col("html")).alias("title"))


@query(r"""SELECT page_id, len(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>')) AS items, regexp_extract(html, '(?i)<html[^>]*lang="([a-z]+)"', 1) AS lang,
  len(regexp_extract_all(html, '(?is)<tr[^>]*>(.*?)</tr>')) AS table_rows FROM pages""")
def html_row_extract(t):
    """List items and table rows of a page, and its declared language."""
    n = lambda tag: F.size(F.regexp_extract_all("html", F.lit(rf"(?is)<{tag}[^>]*>(.*?)</{tag}>"), F.lit(1))).cast("long")
    return t.pages.select("page_id", n("li").alias("items"), F.regexp_extract("html", r'(?i)<html[^>]*lang="([a-z]+)"', 1).alias("lang"), n("tr").alias("table_rows"))


@query("""SELECT o_orderkey AS id, CASE WHEN o_custkey % 3 = 0 THEN 2 ELSE 1 END AS n_rows, 'C' || o_custkey AS first_name, CASE WHEN 10 + o_custkey * 7 < 1000000 THEN 10 + o_custkey * 7 END AS first_votes
  FROM orders""")
def pipe_table_rows(t):
    """Pipe tables made of order rows, parsed back: header, separator and total rows are not candidates."""
    c = F.col("o_custkey")
    row = lambda name, votes: F.concat(F.lit("| **"), name, F.lit("** | P | "), votes, F.lit(" |\n"))
    text = F.concat(
        F.lit("| Candidate Name | Party | Votes |\n|---|---|---|\n"), row(F.concat(F.lit("C"), c), F.format_number(10 + c * 7, 0)),
        F.when(c % 3 == 0, row(F.concat(F.lit("D"), c), F.lit("99"))).otherwise(""), F.lit("| Total | | 100 |\n"),
    )
    d = t.orders.select("o_orderkey", X.page_rows(text).alias("r"))
    return d.select(F.col("o_orderkey").alias("id"), F.size("r").alias("n_rows"), F.col("r")[0]["name"].alias("first_name"), F.col("r")[0]["votes"].alias("first_votes"))


@query("SELECT event_type, COUNT(*) AS n, SUM(json_extract_string(props, '$.k')::BIGINT)::BIGINT AS k_sum, COUNT(json_extract_string(props, '$.none')) AS missing FROM events GROUP BY event_type")
def json_props(t):
    m = F.from_json("props", "map<string,string>")
    d = t.events.select("event_type", F.try_element_at(m, F.lit("k")).cast("long").alias("k"), F.try_element_at(m, F.lit("none")).alias("x"))
    return d.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("k_sum"), F.count("x").alias("missing"))


@query(r"""WITH f AS (SELECT * FROM (VALUES ('green', 'verde'), ('red', 'rojo')) AS v(a, b)),
w AS (SELECT p_partkey, list_filter(string_split(trim(regexp_replace(lower(strip_accents(p_name || ' #é-Dr. X ' || p_partkey)), '[^a-z]+', ' ', 'g')), ' '), lambda x: x <> '') AS t FROM part),
x AS (SELECT p_partkey, list_transform(t, lambda x: CASE x WHEN 'green' THEN 'verde' WHEN 'red' THEN 'rojo' ELSE x END) AS t FROM w)
SELECT p_partkey, array_to_string(t, ' ') AS full_name, array_to_string(list_filter(t, lambda x: len(x) > 1 AND x <> 'dr'), '') AS squash FROM x""")
def name_normalise(t):
    raw = F.concat("p_name", F.lit(" #é-Dr. X "), "p_partkey")
    n = N.name_forms(raw, honorifics=["dr"], token_fix={"green": "verde", "red": "rojo"})
    return t.part.select("p_partkey", n["full"].alias("full_name"), n["squash"].alias("squash"))


@query(r"""WITH s AS (SELECT o_orderkey, 'Dera Ghazi Khan-' || CASE o_orderkey % 3 WHEN 0 THEN 'II' WHEN 1 THEN 'IV' ELSE 'cum-Rajan' END || ' (Old ' || o_orderpriority || ')' AS n FROM orders),
r AS (SELECT o_orderkey, regexp_replace(replace(replace(regexp_replace(lower(n), '\([^)]*\)', ' ', 'g'), '-', ' '), 'cum', ' cum '), '[^a-z\s]', ' ', 'g') AS n FROM s)
SELECT o_orderkey, replace(array_to_string(list_filter(string_split(trim(regexp_replace(n, '\s+', ' ', 'g')), ' '), lambda x: x NOT IN ('i', 'ii', 'iii', 'iv', 'v')), ' '), 'dera ghazi khan', 'dg khan') AS district FROM r""")
def district_base(t):
    suffix = F.when(F.col("o_orderkey") % 3 == 0, "II").when(F.col("o_orderkey") % 3 == 1, "IV").otherwise("cum-Rajan")
    name = F.concat(F.lit("Dera Ghazi Khan-"), suffix, F.lit(" (Old "), "o_orderpriority", F.lit(")"))
    return t.orders.select("o_orderkey", N.district_base(name).alias("district"))


#: Brand names and the like of a vocabulary: the words of part names, and pairs of them, besides some of the documents' own.
PHRASES = ["the", "of the", "in the", "and", "and the", "the of", "de la", "la", "la de", "der", "die", "und die", "der und"]


@query(rf"""WITH v AS (SELECT DISTINCT lower(p_name) AS p FROM part UNION SELECT UNNEST({PHRASES!r})),
a AS (SELECT string_agg(p, '|' ORDER BY len(string_split(p, ' ')) DESC, p) AS alt FROM v WHERE regexp_full_match(p, '[a-z]+( [a-z]+)*') AND len(string_split(p, ' ')) <= 4),
d AS (SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '\p{{L}}+'), ' ') || ' ' AS s FROM documents),
x AS (SELECT doc_id, regexp_extract_all(CASE WHEN s = ' ' THEN '' ELSE s END, '(?:' || alt || ') |[^ ]+ ') AS m, list_transform(regexp_extract_all(CASE WHEN s = ' ' THEN '' ELSE s END, '((?:' || alt || ') )|[^ ]+ ', 1), lambda p: trim(p)) AS k FROM d, a)
SELECT doc_id, array_to_string(list_filter(k, lambda p: p <> ''), '|') AS phrases, len(m) - len(list_filter(k, lambda p: p <> '')) AS unknown FROM x""")
def greedy_segment(t):
    """Documents' words cut into the phrases of a vocabulary, longest first."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    names = t.part.select(F.lower("p_name").alias("phrase")).unionByName(t.spark.createDataFrame([(p,) for p in PHRASES], "phrase string"))
    names = names.where(F.col("phrase").rlike("^[a-z]+( [a-z]+)*$") & (F.size(F.split("phrase", " ")) <= 4))
    d = t.documents.select("doc_id", F.coalesce(words, F.array().cast("array<string>")).alias("words"))
    found = greedy_segments(d, names, "doc_id").groupBy("doc_id")
    found = found.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "phrase"))), lambda x: x["phrase"]), "|").alias("phrases"), F.sum("n").alias("n"))
    out = d.select("doc_id", F.size("words").cast("long").alias("all")).join(found, "doc_id", "left")
    return out.select("doc_id", F.coalesce("phrases", F.lit("")).alias("phrases"), (F.col("all") - F.coalesce("n", F.lit(0))).alias("unknown"))


@query(r"""WITH w AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z]{8,}')) AS t FROM documents), b AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z]{8,}')) AS t FROM benchmark),
x AS (SELECT DISTINCT doc_id, UNNEST(t) AS tok FROM w), y AS (SELECT DISTINCT item_id, UNNEST(t) AS tok FROM b), z AS (SELECT doc_id, item_id, COUNT(*) AS shared FROM x JOIN y USING (tok) GROUP BY ALL)
SELECT doc_id, item_id, shared, round(shared / (len(w.t) + len(b.t) - shared)::DOUBLE, 6) AS jaccard FROM z JOIN w USING (doc_id) JOIN b USING (item_id) WHERE shared >= 5""")
def benchmark_overlap(t):
    """Shared long tokens of documents and benchmark items, found through the items' tokens, which are measured and sent to the documents."""
    tokens = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{8,}"), F.lit(0)))
    d = t.documents.select("doc_id", tokens(F.col("text")).alias("dt"))
    b = t.benchmark.select("item_id", tokens(F.col("text")).alias("bt"))
    x = d.select("doc_id", F.size("dt").alias("n"), F.explode("dt").alias("tok"))
    y = b.select("item_id", F.size("bt").alias("m"), F.explode("bt").alias("tok"))
    z = join_dim(x, y, "tok", "inner").groupBy("doc_id", "item_id", "n", "m").agg(F.count("*").alias("shared")).where("shared >= 5")
    return z.select("doc_id", "item_id", "shared", F.round(F.col("shared") / (F.col("n") + F.col("m") - F.col("shared")), 6).alias("jaccard"))


@query("""WITH a AS (SELECT DISTINCT p_partkey AS k FROM part), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49)
SELECT 'difference' AS op, k FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'intersection', k FROM (SELECT k FROM a INTERSECT SELECT k FROM b)
UNION ALL SELECT 'union', k FROM (SELECT k FROM a UNION SELECT k FROM b)""")
def set_ops(t):
    a = t.part.select(F.col("p_partkey").alias("k"))
    b = t.lineitem.where("l_returnflag = 'R' and l_quantity > 49").select(F.col("l_partkey").alias("k"))
    named = lambda n, d: d.select(F.lit(n).alias("op"), "k")
    return named("difference", a.subtract(b)).unionByName(named("intersection", a.intersect(b))).unionByName(named("union", a.union(b).distinct()))


@query("SELECT i::BIGINT AS o_custkey FROM range(1, (SELECT MAX(c_custkey) + 1 FROM customer)) r(i) WHERE i NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def gap_list(t):
    high = t.customer.agg(F.max("c_custkey")).first()[0]
    return Q.gaps(t.orders.where("o_orderstatus = 'P'"), "o_custkey", 1, high)


@query("SELECT n_name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0)")
def coverage_anti(t):
    claimed = t.supplier.where("s_acctbal < 0").select(F.col("s_nationkey").alias("n_nationkey"))
    return Q.unclaimed(t.nation, claimed, "n_nationkey").join(t.nation, "n_nationkey").select("n_name")


@query("""SELECT COUNT(*) AS checked, COUNT(*) FILTER (quality = 1 - toxic) AS agree, round(100.0 * COUNT(*) FILTER (quality = 1 - toxic) / COUNT(*), 1) AS rate FROM labels JOIN documents USING (doc_id)""")
def agreement_rate(t):
    a = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id")
    return Q.agreement(a, t.labels.select("doc_id", (1 - F.col("toxic")).alias("clean")), ["doc_id"], "quality", "clean")


@query("""SELECT flag, COUNT(*) AS n FROM (SELECT CASE WHEN NOT (l_quantity <= 45) THEN 'quantity' END AS a, CASE WHEN NOT (l_discount + l_tax <= 0.15) THEN 'rate' END AS b FROM lineitem) x,
  LATERAL (SELECT UNNEST([a, b]) AS flag) WHERE flag IS NOT NULL GROUP BY flag""")
def quality_flags(t):
    """Rows that fail a check are flagged, not dropped."""
    f = Q.flags({"quantity": F.col("l_quantity") <= 45, "rate": F.col("l_discount") + F.col("l_tax") <= 0.15})
    return t.lineitem.select(F.explode(f).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@query("""SELECT event_type, round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75, round(quantile_cont(value, 0.9), 6) AS q90, round(sqrt(AVG(value * value)), 6) AS rms FROM events GROUP BY event_type""")
def quantiles(t):
    q = Q.quantiles(t.events, "value", [0.5, 0.75, 0.9], ["event_type"])
    return q.select("event_type", *[F.round(c, 6).alias(c) for c in ("q50", "q75", "q90", "rms")])


@query("""SELECT p_partkey, CASE WHEN p_size > 40 THEN NULL WHEN p_partkey % 10 = 0 THEN 'new' || p_partkey ELSE p_brand END AS p_brand, p_size FROM part WHERE p_size <= 40 OR p_partkey % 10 <> 0
  UNION ALL SELECT p_partkey, NULL, p_size FROM part WHERE FALSE""")
def layer_upsert(t):
    """Brands replaced by a newer layer's, missing values included."""
    layer = t.part.where("p_size <= 40 or p_partkey % 10 <> 0").select("p_partkey", "p_brand", "p_size")
    new = t.part.where("p_partkey % 10 = 0 or p_size > 40").select("p_partkey", F.when(F.col("p_size") <= 40, F.concat(F.lit("new"), "p_partkey")).alias("p_brand"))
    return sinks.upsert(layer, new, "p_partkey")


@query("SELECT r_name, string_agg(n_nationkey || '=' || n_name, ';' ORDER BY n_nationkey) AS document FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def nested_document(t):
    """Region, its nations as a map by key; shown flat."""
    d = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    n = sinks.nested(d, "r_name", "n_nationkey", ["n_name"])
    entries = F.array_sort(F.map_entries("document"))
    return n.select("r_name", F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"]["n_name"])), ";").alias("document"))


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, COUNT(*) AS n FROM events GROUP BY ALL")
def tumbling_window(t):
    """The streaming extension's windows, on a bounded table."""
    return E.tumbling(t.events, "1 day").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""WITH m AS (SELECT user_id, ts, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
g AS (SELECT *, SUM(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM m) SELECT user_id, MIN(ts) AS start, MAX(ts) + INTERVAL 6 HOUR AS "end", COUNT(*) AS n FROM g GROUP BY user_id, s""")
def session_windows(t):
    s = E.sessions(t.events, "6 hours")
    return s.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def last_write_wins(t):
    return E.last_wins(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@query("""SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'red') ORDER BY p_partkey LIMIT 40""")
def name_search(t):
    """First 40 parts whose name contains a text."""
    return t.part.where(F.contains(F.lower("p_name"), F.lit("red"))).orderBy("p_partkey").limit(40).select("p_partkey", "p_name")


@query("""WITH k AS (SELECT p_brand, list_sort(list_distinct(list(p_type))) AS types FROM part GROUP BY p_brand)
SELECT a.p_brand AS a, b.p_brand AS b, round(len(list_intersect(a.types, b.types)) / len(list_distinct(list_concat(a.types, b.types)))::DOUBLE, 6) AS iou FROM k a JOIN k b ON a.p_brand < b.p_brand WHERE len(list_intersect(a.types, b.types)) > 0""")
def set_iou(t):
    """Overlap of the type sets of brands that have a type in common, found through the types."""
    return S.overlaps(t.part, "p_brand", "p_type").select("a", "b", F.round("iou", 6).alias("iou"))


@query("SELECT c_custkey, c_mktsegment, c_acctbal FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn = 1")
def keep_largest(t):
    return C.keep_first(t.customer.select("c_custkey", "c_mktsegment", "c_acctbal"), ["c_mktsegment"], [F.desc("c_acctbal"), "c_custkey"])


@query("""WITH d AS (SELECT DISTINCT o_custkey AS k, l_partkey AS i FROM orders JOIN lineitem ON l_orderkey = o_orderkey), n AS (SELECT k, COUNT(*) AS n FROM d GROUP BY k),
m AS (SELECT x.k AS a, y.k AS b, COUNT(*) AS shared FROM d x JOIN d y ON x.i = y.i AND x.k < y.k GROUP BY ALL HAVING COUNT(*) >= 4)
SELECT a, b, shared, round(shared / (x.n + y.n - shared)::DOUBLE, 6) AS iou FROM m JOIN n x ON x.k = a JOIN n y ON y.k = b""")
def common_parts(t):
    """Customers who bought four parts and more in common."""
    d = t.lineitem.select("l_orderkey", "l_partkey").join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    return S.overlaps(d, "o_custkey", "l_partkey", least=4).select("a", "b", "shared", F.round("iou", 6).alias("iou"))
