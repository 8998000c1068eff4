"""Segmentation of texts against a vocabulary table, longest match first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.plans.joins import join_dim
from quorumlake.plans.staging import Scope, Stage


def greedy_segments(texts: DataFrame, vocabulary: DataFrame, id_col: str, words: str = "words", phrase: str = "phrase", longest: int = 4) -> DataFrame:
    """``(id, pos, n, phrase)``: the segments of each text's array of words that are phrases of ``vocabulary``, of up to ``longest`` words joined by
    a space: from the left, the longest phrase that begins at a word is taken, else the word is passed. A text without any has no row; ids are unique.

    Words that begin a phrase are found first, by the phrases' few first words; only runs from these (a null word begins none) are made and meet the vocabulary in a join
    (either table is sent to the texts if it is measured as small). A match that no earlier one reaches into is
    taken for certain; only where matches overlap does it depend on those before, and there pointers to the next possible match
    are followed by doubling, a join a round over all texts, as many as the logarithm of the longest chain of overlaps."""
    with Scope(texts.sparkSession) as made:
        stage = Stage(texts.sparkSession, "segments")
        n, w = F.size(words), F.col(words)
        known = vocabulary.select(F.col(phrase).alias("phrase")).where("phrase is not null").distinct()
        known = stage.put(known, "known")
        head = lambda c: F.substring_index(c, " ", 1)
        begins = F.transform(w, lambda x, i: F.struct(i.alias("pos"), head(x).alias("head"), F.slice(w, i + 1, longest).alias("next")))
        at = texts.where(n > 0).select(id_col, F.explode(begins).alias("_b")).select(id_col, "_b.*")
        at = join_dim(at, known.select(head("phrase").alias("head")).distinct(), "head", "left_semi")
        runs = F.array(*[F.when(F.size("next") >= k, F.struct(F.lit(k).alias("n"), F.array_join(F.slice("next", 1, k), " ").alias("phrase"))) for k in range(1, longest + 1)])
        d = at.select(id_col, "pos", F.explode(F.filter(runs, lambda r: r.isNotNull())).alias("_r")).select(id_col, "pos", "_r.*")
        hits = join_dim(d, known, "phrase", "left_semi").groupBy(id_col, "pos").agg(F.max(F.struct("n", "phrase")).alias("_m")).select(id_col, "pos", "_m.*")
        by = Window.partitionBy(id_col).orderBy("pos")
        reach = F.max(F.col("pos") + F.col("n")).over(by.rowsBetween(Window.unboundedPreceding, -1))
        hits = hits.withColumn("sure", F.coalesce(reach <= F.col("pos"), F.lit(True)))
        after = F.coalesce(*[F.when(F.col("n") == k, F.min(F.struct("pos", "sure")).over(by.rangeBetween(k, Window.unboundedFollowing))) for k in range(1, longest + 1)])
        hits = hits.withColumn("_nxt", after).withColumn("nxt", F.when(~F.col("_nxt.sure"), F.col("_nxt.pos"))).drop("_nxt")
        hits = stage.put(hits, "hits")
        made.keep(hits)
        chained = stage.put(hits.where("nxt is not null or not sure").select(id_col, "pos", "nxt", F.col("sure").alias("on")), "chains")
        while not chained.where("nxt is not null").isEmpty():
            to = chained.where("on and nxt is not null").select(id_col, F.col("nxt").alias("pos"), F.lit(True).alias("_hit")).distinct()
            jump = chained.select(id_col, F.col("pos").alias("nxt"), F.col("nxt").alias("_then"))
            chained = chained.join(to, [id_col, "pos"], "left").join(jump, [id_col, "nxt"], "left")
            chained = stage.put(chained.select(id_col, "pos", F.col("_then").alias("nxt"), (F.col("on") | F.coalesce("_hit", F.lit(False))).alias("on")), "chains")
            stage.drop("chains", keep_last=True)
        made.keep(chained)
    late = chained.where("on").select(id_col, "pos", F.lit(True).alias("_on"))
    return hits.join(late, [id_col, "pos"], "left").where("sure or _on").select(id_col, "pos", "n", "phrase")
