"""SimHash document fingerprints and permuted block tables, in DataFrame functions alone.

Terms are words; each votes with its weight for or against every bit of its hash. Two bits share one
64-bit sum (the weight of the terms that set bit i below, of those that set bit i + 32 above), so the
fingerprint of a text is one hash aggregation over its exploded words with 33 sums. Where the rows
already lie by a bucket, as in ``edited_fingerprints``, that aggregation needs no shuffle of its own.

Sums are taken by pieces of 2^22 words first, so that no half of a sum overflows however long a text is.

Scale: texts move once, by a bucket of some 128 neighbours in id order; a bucket is a window, so
its size is set by the number of rows and not by the ids' distribution (see ``with_next``).
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.operators.ordering import global_rank
from quorumlake.plans.joins import join_dim
from quorumlake.plans.staging import Stage

WORD_BREAK = r"[\x20\x09-\x0D]++"
LOW = 0xFFFFFFFF
#: A piece has 2^PIECE words: at most 144 of weight each, under 2^32 together.
PIECE = 22


def length_weight(term: Column) -> Column:
    """Weight of a term: the square of its length in code points, up to 12: short words tell texts apart the least."""
    n = F.least(F.length(term), F.lit(12)).cast("long")
    return n * n


def simhash(rows: DataFrame, keys: list[str], text: str = "text", weight=length_weight) -> DataFrame:
    """``(keys, fingerprint bigint)`` of each distinct ``keys``; equal texts give equal fingerprints.

    Null, empty and blank texts have fingerprint 0. A tie of the votes leaves the bit 0.
    """
    words = F.posexplode_outer(F.split(F.lower(F.col(text)), WORD_BREAK)).alias("_at", "_t")
    terms = rows.select(*keys, words).select(
        *keys, F.shiftright(F.coalesce("_at", F.lit(0)), PIECE).alias("_piece"), F.xxhash64("_t").alias("_h"), F.when(F.col("_t").isNull(), 0).otherwise(weight(F.col("_t"))).cast("long").alias("_w")
    )
    both = F.lit((1 << 32) | 1)
    sums = [F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(both) * F.col("_w")).alias(f"_s{i}") for i in range(32)]
    pieces = terms.groupBy(*keys, "_piece").agg(F.sum("_w").alias("_all"), *sums)
    halves = [F.col(f"_s{i % 32}").bitwiseAND(F.lit(LOW)) if i < 32 else F.shiftrightunsigned(f"_s{i % 32}", 32) for i in range(64)]
    voted = pieces.groupBy(*keys).agg(F.sum("_all").alias("_all"), *[F.sum(h).alias(f"_b{i}") for i, h in enumerate(halves)])
    bits = []
    for i in range(64):
        bit = 1 << i if i < 63 else -(1 << 63)
        bits.append(F.when(F.col(f"_b{i}") * 2 > F.col("_all"), F.lit(bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return voted.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of the 64 bits that agree."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def with_next(docs: DataFrame, id_col: str, text: str, per_bucket: int = 128) -> DataFrame:
    """``(_bucket, _rn, id, text, _next, _guest)``: each row with the text of the next one by ascending
    id, after the last the first; rows lie by ``_bucket``. A bucket also holds, last and marked
    ``_guest``, the first row of the next bucket, so no other row needs a look outside.

    If the ids fill equal slices of their range evenly (counted), the slices are the buckets and
    texts move once. Otherwise ranks of the ids are the measure, and a join by id precedes.
    Rows that repeat an id are ordered by text. Null ids must have been taken out before.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text).alias("_text"))
    n, low, high = d.agg(F.count("*"), F.min("_id"), F.max("_id")).first()
    n_buckets = max(1, math.ceil(n / per_bucket))
    width = max(1, ((high or 0) - (low or 0) + n_buckets) // n_buckets)
    slot = F.expr(f"(_id - {low or 0}L) div {width}L")
    counts = Stage(spark, "next").put(d.groupBy(slot.alias("_bucket")).agg(F.count("*").alias("n"), F.min("_id").alias("_id")), "slots")
    full, most, last = counts.agg(F.count("*"), F.max("n"), F.max("_bucket")).first()
    if n == 0 or (full == last + 1 and most <= 16 * per_bucket):
        placed = d.withColumn("_bucket", slot)
        n_buckets = full or 1
        firsts = counts.select("_id", "_bucket")
    else:
        ids = d.select("_id").distinct()
        ranked = Stage(spark, "next").put(global_rank(ids, ["_id"]), "ranks")
        ranked = ranked.select("_id", F.expr(f"(rank - 1) div {per_bucket}L").alias("_bucket"), ((F.col("rank") - 1) % per_bucket == 0).alias("_first"))
        placed = d.join(ranked.drop("_first"), "_id")
        firsts = ranked.where("_first").select("_id", "_bucket")
        n_buckets = max(1, math.ceil(ids.count() / per_bucket))
    guests = join_dim(d, firsts, "_id", "inner").select("_id", "_text", F.expr(f"(_bucket + {n_buckets - 1}L) % {n_buckets}L").alias("_bucket"))
    rows = placed.select("_id", "_text", "_bucket", F.lit(False).alias("_guest")).unionByName(guests.withColumn("_guest", F.lit(True)))
    w = Window.partitionBy("_bucket").orderBy("_guest", "_id", "_text")
    return rows.select("*", F.row_number().over(w).alias("_rn"), F.lead("_text").over(w).alias("_next"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each whole text and of its edited text: the last floor(n/2) of its n code
    points give way to the first as many (or all) of the next document by ascending id.

    Returns ``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next)``, fingerprints as bigint. Defined cases: null text counts as empty; rows that
    repeat an id follow one another by text; a null id has no next document (its edited text
    keeps the first half); one row alone is its own next; an empty table gives no rows.
    """
    clean = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    chained = with_next(clean.where(F.col(id_col).isNotNull()), id_col, "_t")
    lost = clean.where(F.col(id_col).isNull()).select(F.col("_t").alias("_text"))
    lost = lost.select(
        F.lit(None).cast("long").alias("_id"), "_text", F.xxhash64("_text").alias("_bucket"), F.lit(False).alias("_guest"),
        F.monotonically_increasing_id().alias("_rn"), F.lit("").alias("_next"),
    )
    if not lost.isEmpty():
        chained = chained.select("_id", "_text", "_bucket", "_guest", F.col("_rn").cast("long"), "_next").unionByName(lost)
    n = F.length("_text").cast("long")
    half = F.expr("cast(length(_text) div 2 as int)")
    edited = F.concat(F.left("_text", F.length("_text") - half), F.left(F.coalesce("_next", F.lit("")), half))
    rows = chained.select("_bucket", "_rn", "_guest", "_id", n.alias("n_chars"), "_text", edited.alias("_edited"))
    keys = ["_bucket", "_rn", "_guest", "_id", "n_chars"]
    kinds = F.when(F.col("_guest"), F.array(F.struct(F.lit("").alias("sha"), F.col("_text").alias("text")))).otherwise(
        F.array(
            F.struct(F.lit("").alias("sha"), F.col("_text").alias("text")),
            F.struct(F.sha2(F.encode("_edited", "UTF-8"), 256).alias("sha"), F.col("_edited").alias("text")),
        )
    )
    both = rows.select(*keys, F.explode(kinds).alias("_k")).select(*keys, F.col("_k.sha").alias("_sha"), F.col("_k.text").alias("_text"))
    prints = simhash(both, [*keys, "_sha"], "_text")
    plain = F.col("_sha") == ""
    pairs = prints.groupBy(*keys).agg(
        F.max(F.when(~plain, F.col("_sha"))).alias("edited_sha256"),
        F.max(F.when(plain, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(~plain, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    w = Window.partitionBy("_bucket").orderBy("_rn")
    out = pairs.withColumn("_after", F.lead("fingerprint").over(w)).where(~F.col("_guest"))
    after = F.when(F.col("_id").isNull(), F.lit(0).cast("long")).otherwise(F.col("_after"))
    return out.select(
        F.col("_id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), after).alias("near_next"),
    )


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks of the permuted tables: each choice of ``blocks - radius`` of the ``blocks`` nearly equal runs
    of bits. Fingerprints within ``radius`` bits agree on all bits of at least one mask."""
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    run = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(run, blocks - radius)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def within_radius(queries: DataFrame, table: DataFrame, radius: int = 3, blocks: int = 5, fingerprint: str = "fingerprint") -> DataFrame:
    """``(query, found, distance)``: for each distinct fingerprint of ``queries`` all distinct
    fingerprints of ``table`` within ``radius`` bits, itself included; each pair once.

    Both sides go to one table a mask, keyed by the masked bits; a pair that agrees on several
    masks counts at the first. Null fingerprints find nothing.
    """
    masks = [signed(m) for m in block_masks(radius, blocks)]

    def tables(df: DataFrame, name: str) -> DataFrame:
        d = df.select(F.col(fingerprint).alias(name)).where(F.col(name).isNotNull()).distinct()
        keys = F.array(*[F.col(name).bitwiseAND(F.lit(m).cast("long")) for m in masks])
        return d.select(name, F.posexplode(keys).alias("_table", "_key"))

    x = F.col("query").bitwiseXOR(F.col("found"))
    first = F.coalesce(*[F.when(x.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(i)) for i, m in enumerate(masks)])
    q, t = tables(queries, "query"), tables(table, "found")
    same = (q["_table"] == t["_table"]) & (q["_key"] == t["_key"]) & (F.bit_count(x) <= radius) & (first == q["_table"])
    return q.join(t, same).select("query", "found", F.bit_count(x).alias("distance"))


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
