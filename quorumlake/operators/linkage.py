"""Record linkage: blocks, pairs, predicates, persons, overrides.

Pairs arise only inside blocks: an equi join on exploded keys, never a product. A block over the cap is left
out, which is part of the method, except for the kinds that must not be capped: of those the large
ones give the pairs alone that the predicate can accept (``candidates``). The cheap
tests of the predicate come first; the edit similarity runs on what those leave open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.functions import similarity as S
from quorumlake.functions.textnorm import FILLERS, normalised_title
from quorumlake.operators.contest import mode_first
from quorumlake.operators.graph import connected_components
from quorumlake.operators.ordering import global_rank
from quorumlake.operators.simjoin import similar_rows
from quorumlake.plans.joins import join_dim, spread
from quorumlake.plans.staging import Scope, Stage


def token_frequency(df: DataFrame, id_col: str, tokens: str, unique: bool = True) -> DataFrame:
    """``(token, df)``: in how many records a token occurs. A row is a record and counts a token once, so counts are
    summed up before the only shuffle; where rows repeat an id, ``unique`` false counts them once."""
    each = df.select(id_col, F.explode(F.array_distinct(tokens)).alias("token"))
    return (each if unique else each.distinct()).groupBy("token").agg(F.count("*").alias("df"))


def resolved_titles(df: DataFrame, raw: str, vocabulary: list[str], junk: list[str]) -> DataFrame:
    """``df`` with ``title`` and ``unknown`` of ``normalised_title``: each distinct title is resolved once, dealt over all cores, and rows get theirs by a join. A null
    title has null ones."""
    with Scope(df.sparkSession) as made:
        each = spread(df.select(raw).where(F.col(raw).isNotNull()).distinct(), raw)
        s = F.explode(F.array(normalised_title(F.col(raw), F.array(*map(F.lit, vocabulary)), junk))).alias("_t")  # made once
        each = each.select(raw, s).select(raw, F.col("_t.title").alias("title"), F.col("_t.unknown").cast("int").alias("unknown"))
        each = Stage(df.sparkSession, "titles").put(each, "titles")
        made.keep(each)
    return join_dim(df, each, raw)


def rare_tokens(df: DataFrame, id_col: str, tokens: str, most: int = 60, longer_than: int = 2, name: str = "rare") -> DataFrame:
    """Adds the array of a record's tokens that at most ``most`` records have."""
    each = df.select(id_col, F.explode(F.array_distinct(tokens)).alias("token")).where(F.length("token") > longer_than)
    freq = each.groupBy("token").agg(F.count("*").alias("_df")).where(F.col("_df") <= most)
    kept = each.join(freq, "token").groupBy(id_col).agg(F.array_sort(F.collect_set("token")).alias(name))
    return df.join(kept, id_col, "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))


def blocks(df: DataFrame, id_col: str, least_distinct: int = 8) -> DataFrame:
    """``(id, kind, key)``: district d, rare tokens t, squash s, distinct x. Empty districts make no block:
    no predicate could join their rows by district."""
    b = lambda k, c: F.struct(F.lit(k).alias("kind"), c.alias("key"))
    keys = F.concat(
        F.array(b("d", F.nullif(F.col("district"), F.lit(""))), b("s", F.nullif(F.col("squash"), F.lit(""))), b("x", F.when(F.length("distinct") >= least_distinct, F.col("distinct")))),
        F.transform("rare", lambda t: b("t", t)),
    )
    return df.select(id_col, F.explode(keys).alias("b")).select(id_col, "b.kind", "b.key").where("key is not null")


def block_pairs(keys: DataFrame, id_col: str, cap: int = 400, uncapped: tuple[str, ...] = ("d",)) -> DataFrame:
    """Distinct ``(a, b)``, a < b, that share a block of 2 to ``cap`` rows, or any block of an uncapped kind."""
    sizes = keys.groupBy("kind", "key").agg(F.count("*").alias("_n")).where((F.col("_n") > 1) & ((F.col("_n") <= cap) | F.col("kind").isin(list(uncapped))))
    kept = keys.join(sizes.drop("_n"), ["kind", "key"])
    a, b = kept.select("kind", "key", F.col(id_col).alias("a")), kept.select("kind", "key", F.col(id_col).alias("b"))
    return a.join(b, ["kind", "key"]).where("a < b").select("a", "b").distinct()


def candidates(df: DataFrame, id_col: str, held: int = 400, cap: int = 400, fillers: list[str] = FILLERS) -> DataFrame:
    """Distinct ``(a, b)``, a < b, with every pair that ``matches`` can find among the pairs of ``block_pairs``.

    Districts of up to ``held`` rows give all their pairs. In larger ones rows meet by what an alternative of the predicate needs: similar
    squashed names, similar names without their commonest parts, similar sorted words, or the same words but for fillers. The
    matches are the same whatever ``held`` is.
    """
    keys = blocks(df, id_col)
    sizes = keys.where("kind = 'd'").groupBy("key").agg(F.count("*").alias("_n")).where(F.col("_n") > held)
    if sizes.isEmpty():
        return block_pairs(keys, id_col, cap)
    pairs = block_pairs(join_dim(keys.where("kind = 'd'"), sizes.select("key"), "key", "left_anti").select(keys.columns).unionByName(keys.where("kind <> 'd'")), id_col, cap)
    hot = join_dim(df, sizes.select(F.col("key").alias("district")), "district", "left_semi")
    words = F.filter(F.split("core", " "), lambda t: t != "")
    rest = F.array_except(words, F.array(*map(F.lit, fillers))) if fillers else F.array_distinct(words)
    hot = hot.select(id_col, "district", "squash", "distinct", F.array_join(F.array_sort(words), " ").alias("sorted"), F.array_join(F.array_sort(rest), " ").alias("plain"))
    found = [
        similar_rows(hot, id_col, "district", "squash", 93, edits=1, edits_from=10),
        similar_rows(hot.where(F.length("distinct") >= 8), id_col, "district", "distinct", 95),
        similar_rows(hot, id_col, "district", "sorted", 93),
        similar_rows(hot, id_col, "district", "plain", 100),
    ]
    for more in found:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def _sides(pairs: DataFrame, df: DataFrame, id_col: str) -> DataFrame:
    for side in "ab":
        d = df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])
        pairs = pairs.join(d, F.col(side) == F.col(f"{side}_{id_col}"))
    return pairs


def arms(modern: bool = True, fillers: list[str] = FILLERS) -> list[tuple[str, Column]]:
    """The alternatives of the match predicate, cheapest first, over columns a_ and b_ of squash, distinct,
    core, district, province, rare. The left side is the earlier row."""
    c = F.col
    same_district = (c("a_district") == c("b_district")) & (c("a_district") != "")
    same_province = (c("a_province") != "") & (F.left("a_province", F.lit(4)) == F.left("b_province", F.lit(4)))
    rare = F.arrays_overlap("a_rare", "b_rare")
    ls, ld = F.length("a_squash"), F.length("a_distinct")
    wide = lambda n: (same_province & (n >= 12)) if modern else F.lit(False)
    sim = lambda least: (S.indel_ratio(c("a_squash"), c("b_squash"), least) >= least) | (S.token_sort_ratio(c("a_core"), c("b_core"), least) >= least)
    tokens = lambda x: F.filter(F.split(x, " "), lambda t: t != "")
    found = [
        ("squash", (c("a_squash") == c("b_squash")) & (same_district | wide(ls) | (ls >= 16))),
        ("distinct", (c("a_distinct") == c("b_distinct")) & (ld >= 8) & (same_district | wide(ld) | (ld >= 16))),
        ("one_edit", same_district & (ls >= 10) & S.within_edits(c("a_squash"), c("b_squash"))),
        ("filler", same_district & S.differ_by(tokens(c("a_core")), tokens(c("b_core")), fillers)),
        ("sim93", same_district & sim(93)),
        ("sim96", ((same_province & rare) if modern else rare) & sim(96)),
    ]
    if modern:
        close = S.indel_ratio(c("a_distinct"), c("b_distinct"), 95) >= 95
        found.append(("distinct95", (ld >= 10) & (same_district | (same_province & rare)) & close))
    return found


def matches(df: DataFrame, pairs: DataFrame, id_col: str, modern: bool = True, same_year: bool = False, year: str = "year", fillers: list[str] = FILLERS) -> DataFrame:
    """``(a, b, arm)`` of the pairs that match, with the first alternative that holds. With ``same_year`` two
    rows of one year match only as several seats of one candidate."""
    full = _sides(pairs, df, id_col)
    arm = None
    for name, test in arms(modern, fillers):
        arm = F.when(test, name) if arm is None else arm.when(test, name)
    if same_year:
        arm = F.when(F.col(f"a_{year}") == F.col(f"b_{year}"), F.when(same_year_seats(), "same_year")).otherwise(arm)
    return full.withColumn("arm", arm).where("arm is not null").select("a", "b", "arm")


def same_year_seats(independent: str = "IND") -> Column:
    """Rows of one year are one candidate in several seats: equal squash, another seat, and the same real
    party, or a long name with a rare token in common."""
    c = F.col
    party = (c("a_party") == c("b_party")) & (c("a_party") != independent)
    return (c("a_na") != c("b_na")) & (c("a_squash") == c("b_squash")) & (party | ((F.length("a_squash") >= 14) & F.arrays_overlap("a_rare", "b_rare")))


def star_edges(df: DataFrame, group: list[str], id_col: str) -> DataFrame:
    """Edges from each row of a group to its smallest: the same components as all pairs, linear in size."""
    low = df.groupBy(*group).agg(F.min(id_col).alias("dst"))
    return df.join(low, group).where(F.col(id_col) != F.col("dst")).select(F.col(id_col).alias("src"), "dst")


def persons(df: DataFrame, edges: DataFrame, id_col: str, curated: DataFrame | None = None) -> DataFrame:
    """``df`` with ``person``: the component of a row's edges, or the curated group that takes it out of its component."""
    found = connected_components(edges).select(F.col("node").alias(id_col), F.col("component").cast("string").alias("person"))
    out = df.join(found, id_col, "left").withColumn("person", F.coalesce("person", F.col(id_col).cast("string")))
    if curated is not None:
        out = out.join(curated.select(id_col, F.col("group").alias("_g")), id_col, "left").withColumn("person", F.coalesce("_g", "person")).drop("_g")
    return out


def person_table(df: DataFrame, person: str = "person", won: Column | None = None, year: str = "year", name: str = "name_raw", pos: str = "pos") -> DataFrame:
    """A row a person: canonical name (commonest among wins if there are any, else among all; first seen of
    equals), counts, and sorted sets of years, parties and districts without blanks."""
    won = F.col("outcome") == "Win" if won is None else won
    d = df.withColumn("_won", F.coalesce(won, F.lit(False)))
    pool = d.withColumn("_any", F.max("_won").over(Window.partitionBy(person))).where(F.col("_won") | ~F.col("_any"))
    canonical = mode_first(pool, [person], name, pos).select(person, F.col(name).alias("canonical_name"))
    sets = lambda c: F.array_sort(F.collect_set(F.nullif(c, F.lit(""))))
    agg = d.groupBy(person).agg(
        F.count("*").alias("n_candidacies"), F.count_if("_won").alias("n_wins"), F.countDistinct(F.when(F.col("_won"), F.col(year))).alias("n_win_years"),
        F.array_sort(F.collect_set(year)).alias("years"), sets("party").alias("parties"), sets("district").alias("districts"),
    )
    return agg.join(canonical, person)


def apply_splits(df: DataFrame, rules: DataFrame, person: str = "person", name: str = "core") -> DataFrame:
    """Rows that a rule selects leave their person for ``merge_into`` or a fresh id ``PX<rule>``.

    A rule names a person and any of year, district, district_contains, name_contains; missing fields
    match all. Of several rules for a row the last wins. ``rules`` has rule_no besides; it is curated, so small.
    """
    r = rules.select(*[F.col(c).alias(f"r_{c}") for c in rules.columns])
    hit = (
        (F.col("r_person_id") == F.col(person))
        & (F.col("r_year").isNull() | (F.col("r_year") == F.col("year")))
        & (F.col("r_district").isNull() | (F.col("r_district") == F.col("district")))
        & (F.col("r_district_contains").isNull() | F.contains("district", "r_district_contains"))
        & (F.col("r_name_contains").isNull() | F.contains(name, "r_name_contains"))
    )
    w = Window.partitionBy("_row").orderBy(F.desc("r_rule_no"))
    d = df.withColumn("_row", F.monotonically_increasing_id()).join(r, hit, "left")
    d = d.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    fresh = F.coalesce("r_merge_into", F.format_string("PX%03d", F.col("r_rule_no").cast("int")))
    return d.withColumn(person, F.when(F.col("r_rule_no").isNotNull(), fresh).otherwise(F.col(person))).select(*df.columns)


def apply_merges(df: DataFrame, groups: DataFrame, person: str = "person") -> DataFrame:
    """Persons named together in a row's ``ids`` become one, named by the smallest of all they connect."""
    edges = groups.select(F.explode("ids").alias("src"), F.col("ids").getItem(0).alias("dst"))
    found = connected_components(edges).withColumnRenamed("node", person)
    return join_dim(df, found, person).withColumn(person, F.coalesce("component", person)).drop("component").select(*df.columns)


def cluster_scores(clusters: DataFrame, spine: DataFrame) -> DataFrame:
    """``(cluster, person, score)``: 2 for each row of the person with a squash of the cluster, 1 for each with a
    distinct form of it of 8 or more letters. Both have squashes and distincts as rows (id, squash, distinct)."""
    def hits(col: str, weight: int, least: int) -> DataFrame:
        a = clusters.where(F.length(col) >= least).select("cluster", F.col(col).alias("k")).distinct()
        return a.join(spine.select("person", F.col(col).alias("k")), "k").select("cluster", "person", F.lit(weight).alias("w"))

    return hits("squash", 2, 1).unionByName(hits("distinct", 1, 8)).groupBy("cluster", "person").agg(F.sum("w").alias("score"))


def best_persons(clusters: DataFrame, spine: DataFrame) -> DataFrame:
    """``unambiguous(cluster_scores(clusters, spine))`` as (cluster, person, score), without its pairs: clusters of the same forms score alike, and so do persons of
    the same rows, so one of each stands for all, and a person whose rows another one has too is ambiguous. What is scored grows with the pairs of different
    such sets that have a form in common."""
    with Scope(clusters.sparkSession) as made:
        stage = Stage(clusters.sparkSession, "scores")
        long_ = F.when(F.length("distinct") >= 8, F.col("distinct"))
        some = F.when(F.length("squash") >= 1, F.col("squash"))
        c = clusters.groupBy("cluster").agg(F.array_sort(F.collect_set(some)).alias("_s"), F.array_sort(F.collect_set(long_)).alias("_d"))
        c = stage.put(c, "clusters")
        kinds = c.groupBy("_s", "_d").agg(F.min("cluster").alias("_kind"))
        kinds = stage.put(kinds, "kinds")
        p = spine.where("person is not null").groupBy("person").agg(F.array_sort(F.collect_list(some)).alias("_s"), F.array_sort(F.collect_list(long_)).alias("_d"))
        p = stage.put(p.groupBy("_s", "_d").agg(F.min("person").alias("person"), F.count("*").alias("_n")), "persons")
        made.keep(c, kinds, p)
    rows = lambda d, key, name: d.select(F.col(key).alias(name), F.explode("_s").alias("squash"), F.lit(None).cast("string").alias("distinct")).unionByName(
        d.select(F.col(key).alias(name), F.lit(None).cast("string").alias("squash"), F.explode("_d").alias("distinct"))
    )
    scored = cluster_scores(rows(kinds, "_kind", "cluster"), rows(p, "person", "person")).join(p.select("person", "_n"), "person")
    best = scored.groupBy("cluster", "score").agg(F.sum("_n").alias("_n"), F.min("person").alias("person")).groupBy("cluster").agg(F.max(F.struct("score", "_n", "person")).alias("_b"))
    best = best.where("_b._n = 1").select(F.col("cluster").alias("_kind"), "_b.person", "_b.score")
    return c.join(kinds.join(best, "_kind").drop("_kind"), ["_s", "_d"]).select("cluster", "person", "score")


def gap_evidence(gap: Column, squash: Column, distinct: Column, district: Column, squash_length: Column, distinct_length: Column, rare: Column) -> Column:
    """Whether evidence suffices for a gap of years: up to 10, 20 and 35, and never beyond."""
    far = squash & district & (distinct_length >= 10)
    return (
        F.when(gap <= 10, (squash & (district | (squash_length >= 14))) | (distinct & district))
        .when(gap <= 20, far).when(gap <= 35, far & rare).otherwise(False)
    )


def unambiguous(candidates: DataFrame, cluster: str = "cluster", score: str = "score") -> DataFrame:
    """The best candidate of each cluster; none where two share the best score."""
    w = Window.partitionBy(cluster)
    best = candidates.withColumn("_best", F.max(score).over(w)).where(F.col(score) == F.col("_best")).drop("_best")
    return best.withColumn("_n", F.count("*").over(w)).where("_n = 1").drop("_n")


def surname_tokens(df: DataFrame, person: str, core: str, stop: list[str] = (), most: int = 120) -> DataFrame:
    """``(person, token)``: last or last but one token of a name, no stop word, of three letters or more,
    borne by at most ``most`` persons anywhere in their names."""
    t = df.select(person, F.filter(F.split(core, " "), lambda x: x != "").alias("_t"))
    last = t.select(person, F.explode(F.when(F.size("_t") > 1, F.slice("_t", -2, 2)).otherwise(F.col("_t"))).alias("token")).distinct()
    borne = t.select(person, F.explode("_t").alias("token")).groupBy("token").agg(F.countDistinct(person).alias("_f")).where(F.col("_f") <= most)
    return last.where((F.length("token") >= 3) & ~F.col("token").isin(list(stop))).join(borne, "token").select(person, "token")


def fresh_ids(clusters: DataFrame, cluster: str, prefix: str = "H", digits: int = 4) -> DataFrame:
    """``clusters`` with ``person``: ids H0001, H0002, .. in the order of the clusters, for those that no person was found for."""
    ranked = global_rank(clusters, [F.col(cluster)], "_no")
    return ranked.withColumn("person", F.concat(F.lit(prefix), F.lpad(F.col("_no").cast("string"), digits, "0"))).drop("_no")


def probes(persons_: DataFrame, names: list[str], column: str) -> DataFrame:
    """``(probe, n, example)``: how many rows hold each text, none included, and the first of them."""
    asked = persons_.sparkSession.createDataFrame([(n,) for n in names], "probe string")
    hits = persons_.select(F.explode(F.filter(F.array(*map(F.lit, names)), lambda p: F.contains(F.col(column), p))).alias("probe"), F.col(column).alias("_c"))
    found = hits.groupBy("probe").agg(F.count("*").alias("n"), F.min("_c").alias("example"))
    return asked.join(found, "probe", "left").select("probe", F.coalesce("n", F.lit(0)).alias("n"), "example")
