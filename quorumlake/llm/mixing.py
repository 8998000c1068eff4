"""Mixing sources to target weights: hash-random keys, range buckets per source, distributed prefix
sums of token counts, a cut at each source's exact budget, and repeated epochs.

Scale: no window ever spans a source. A document's key is a hash, so equal slices of the key space
are equal shares of any source; the window runs inside (source, slice) and a table of slice totals
(sources x slices rows) gives each slice its offset. Only slim rows (id, source, size) are shuffled.
A slice that is far too large, because many rows repeat an id, is range-sorted by row and its sums are taken
over the ranges.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.operators.ordering import global_prefix, global_rank
from quorumlake.plans.joins import join_dim
from quorumlake.plans.staging import Scope, Stage

#: Rows of a (source, slice) that one window may hold; more are summed up over ranges.
HELD = 100_000


def word_count(text: Column) -> Column:
    """Maximal runs of characters outside [\\x20\\x09-\\x0D]; 0 for null or empty text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], share: float, cap: float) -> DataFrame:
    """``sizes`` (source, source_size) -> with ``weight`` and ``target``.

    The i-th source by code point (null last) has weight ``weights[i % len]``. The sources share
    ``share`` times all words by weight; none gets over ``cap`` times its size, and the excess goes
    to the others by weight until none is above. The driver holds two sums a round, no sources.
    """
    ranked = global_rank(sizes, [F.col("source").asc_nulls_last()], "rank")
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = Stage(sizes.sparkSession, "mix").put(ranked.select("source", "source_size", w.alias("weight")), "sources")
    full = F.col("source_size") * F.lit(cap)
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, n_full = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > full
        a = ranked.agg(
            F.sum(F.when(over, F.col("source_size")).otherwise(0)).alias("done"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("w"),
            F.count_if(over).alias("n"),
        ).first()
        if a.n == n_full or not a.w:
            break
        n_full, level = a.n, (share * total - cap * a.done) / a.w
    target = F.least(F.col("weight") * F.lit(float(level)), full.cast("double"))
    return ranked.withColumn("target", target)


def random_key(id_col: str, seed: str, text: Column | None = None) -> Column:
    """Hex digest of the seed and the id: a key that any rerun and any engine gives again. A null id has the
    digest of the text's hash instead, so that rows without id spread over the slices."""
    instead = F.lit("") if text is None else F.concat(F.lit("text:"), F.xxhash64(text).cast("string"))
    return F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), instead)))


ORDER = ["_key", "_id", "size", "_row"]


def _prefixed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_upto``, the words of its (source, slice) up to each row."""
    w = Window.partitionBy("source", "_slice").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_upto", F.sum("size").over(w))


def _split_prefixed(rows: DataFrame) -> DataFrame:
    """The same by a range sort of all rows, in which a (source, slice) lies together: their prefix sums, less
    that at which the row's slice begins."""
    summed = Stage(rows.sparkSession, "mix").put(global_prefix(rows, ["source", *ORDER], "size", "_upto"), "summed")
    begins = summed.groupBy(F.struct("source", "_slice").alias("_of")).agg(F.min(F.col("_upto") - F.col("size")).alias("_begin"))
    out = join_dim(summed.withColumn("_of", F.struct("source", "_slice")), begins, "_of", "inner")
    return out.withColumn("_upto", F.col("_upto") - F.col("_begin")).drop("_of", "_begin")


def mix(
    docs: DataFrame,
    weights: list[int] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix-1:",
    id_col: str = "doc_id",
    size: Column | None = None,
    row_col: str | None = None,
    held: int = HELD,
) -> DataFrame:
    """``(id, source, size, source_size, target, taken)``: words that the mix takes of each document.

    A source's budget is its target rounded down; all its documents are taken as often as whole
    epochs fit, then in the order of their random keys until the budget ends, the last of them in part.
    Defined cases: null text has size 0; a null source is a source of its own; repeated ids count
    as separate rows, ordered by key (of a null id: its text's), then id, then size (equal rows are interchangeable), then by
    ``row_col``, a unique column that is kept in the result if given, or by a number of the row; a slice that such rows
    take beyond ``held`` is split, with the same result; a mix
    without words takes 0 everywhere; an empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    size = word_count(F.col("text")) if size is None else size
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    key = random_key(id_col, seed, F.col("text") if "text" in docs.columns else None)
    slim = docs.select(row.alias("_row"), F.col(id_col).alias("_id"), F.col("source").cast("string").alias("source"), size.alias("size"), key.alias("_key"))
    with Scope(spark) as made:
        stage = Stage(spark, "mix")
        slim = stage.put(slim, "sizes")
        n = slim.count()
        digits = max(1, min(5, math.ceil(math.log(max(1, n / 500), 16))))  # slices of at most some 500 documents
        sliced = slim.withColumn("_slice", F.substring("_key", 1, digits))
        totals = stage.put(sliced.groupBy("source", "_slice").agg(F.sum("size").alias("_words"), F.count("*").alias("_n")), "slices")
        targets = source_targets(totals.groupBy("source").agg(F.sum("_words").alias("source_size")), list(weights), share, cap)
        before = Window.partitionBy("source").orderBy("_slice")
        offsets = totals.select("source", "_slice", (F.sum("_words").over(before) - F.col("_words")).alias("_offset"))
        offsets = offsets.alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select("o.*", "source_size", "target")
        offsets = stage.put(offsets, "offsets")
        made.keep(slim, offsets)
        hot = totals.where(F.col("_n") > max(held, 20 * n // 16**digits)).select(F.struct("source", "_slice").alias("_of"))
        if hot.isEmpty():
            prefixed = _prefixed(sliced)
        else:
            hot = stage.put(hot, "hot")
            marked = sliced.withColumn("_of", F.struct("source", "_slice"))
            split = stage.put(_split_prefixed(join_dim(marked, hot, "_of", "inner").drop("_of")), "split")
            made.keep(hot, split)
            prefixed = _prefixed(join_dim(marked, hot, "_of", "left_anti").drop("_of")).unionByName(split)
    same = F.col("p.source").eqNullSafe(F.col("o.source")) & (F.col("p._slice") == F.col("o._slice"))
    joined = prefixed.alias("p").join(offsets.alias("o"), same).select("p.*", "_offset", "source_size", "target")
    budget = F.floor("target")
    epochs = F.coalesce(F.try_divide(budget, F.col("source_size")).cast("long"), F.lit(0).cast("long"))
    rest = budget - epochs * F.col("source_size")
    start = F.col("_offset") + F.col("_upto") - F.col("size")
    part = F.least(F.greatest(rest - start, F.lit(0)), F.col("size"))
    taken = (epochs * F.col("size") + part).cast("long")
    kept = [F.col("_row").alias(row_col)] if row_col else []
    return joined.select(*kept, F.col("_id").alias(id_col), "source", "size", "source_size", "target", taken.alias("taken"))


def _unused(df: DataFrame, name: str) -> str:
    """``name``, longer by underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def apply_mix(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` as the mix takes them: a row an epoch, none where nothing is taken, and the
    document at its source's cut shortened to the words that still fit. Needs unique ids without null (see ``mixed_rows``
    for any others); a null or empty text is never taken; all columns of ``docs`` are kept, whatever their names."""
    cols = [f"`{c}`" for c in docs.columns]
    size, taken, pos, copy, keep = (_unused(docs, c) for c in ("_size", "_taken", "_pos", "_copy", "_words"))
    m = mixed.select(F.col(id_col), F.col("size").alias(size), F.col("taken").alias(taken)).where(F.col(taken) > 0)
    d = docs.join(m, id_col)
    d = d.select("*", F.posexplode(F.expr(f"sequence(0L, ({taken} - 1) div {size})")).alias(pos, copy))
    words = F.least(F.col(taken) - F.col(copy) * F.col(size), F.col(size))
    head = F.expr(rf"array_join(slice(regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+', 0), 1, cast({keep} as int)), '')")
    d = d.withColumn(keep, words)
    text = F.when(F.col(keep) < F.col(size), head).otherwise(F.col("text"))
    out = {"`text`": text.alias("text")}
    if "n_chars" in docs.columns:
        out["`n_chars`"] = F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return d.select(*[out.get(c, F.col(c)) for c in cols])


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """``docs`` as their mix takes them, whatever their ids: rows with a null or repeated id are rows of
    their own. Rows are told apart by a key made once and staged with them."""
    row = _unused(docs, "_mix_row")
    rows = Stage(docs.sparkSession, "mix").put(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    return apply_mix(rows, mix(rows, row_col=row, **how), row).select(*[f"`{c}`" for c in docs.columns])
