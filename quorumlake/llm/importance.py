"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

A document's importance is the likelihood ratio of its words and word pairs under a target model and
under the model of the whole corpus. Adding Gumbel noise, drawn from a hash of the id, and taking
the k largest keys samples k documents without replacement in proportion to importance.

Scale: two passes over the texts. The first leaves counts by bucket, summed on each executor before the
shuffle; a fixed number of buckets reaches the driver. Raw counts cover all rows; the target model is
fitted on about ``most_target`` labelled rows (all if fewer), those with the smallest hashes of their ids. The k-th key is
found by a distributed sort of slim rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlake.llm import textbytes
from quorumlake.operators.ordering import global_rank
from quorumlake.plans.joins import join_dim

BITS = 16


def fit(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", most_target: int = 20_000, smooth: float = 1.0) -> np.ndarray:
    """log(p_target / p_raw) by bucket. ``target`` has the ids of target rows; null texts count as empty."""
    ids = target.select(F.col(id_col).alias("_id")).where("_id is not null").distinct()
    share = most_target / max(1, ids.count())
    picked = ids.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 32)) / F.lit(float(1 << 32)) < share)  # some most_target ids
    rows = join_dim(docs.select(F.col(id_col).alias("_id"), F.col(text).alias("t")), picked.withColumn("_hit", F.lit(True)), "_id")
    rows = rows.select(F.col("_hit").isNotNull().alias("hit"), "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), np.int64)
        for b in batches:
            hit = b.column(0).to_numpy(zero_copy_only=False)
            for row, data, offsets in textbytes.slices(b.column(1)):
                codes, at = textbytes.word_ngrams(data, offsets, BITS)
                seen[0] += np.bincount(codes, minlength=1 << BITS)
                if hit[row : row + len(offsets) - 1].any():
                    mine = hit[row + np.searchsorted(offsets, at, "right") - 1]
                    seen[1] += np.bincount(codes[mine], minlength=1 << BITS)
        code = np.nonzero(seen[0])[0]
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(seen[0][code]), pa.array(seen[1][code])], ["c", "raw", "target"])

    total = rows.mapInArrow(count, "c bigint, raw bigint, target bigint").groupBy("c").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    counts = np.zeros((2, 1 << BITS))
    counts[:, total["c"].to_numpy()] = [total["raw"].to_numpy(), total["target"].to_numpy()]
    raw = (counts[0] + smooth) / (counts[0] + smooth).sum()
    target_p = (counts[1] + smooth * raw * len(raw)) / (counts[1].sum() + smooth * len(raw))  # unseen buckets fall back to the corpus
    return np.log(target_p / raw).astype(np.float32)


def gumbel(ids: np.ndarray, seed: str) -> np.ndarray:
    """Standard Gumbel noise of each id, the same at every run."""
    u = [int.from_bytes(hashlib.blake2b(f"{seed}{i}".encode(), digest_size=8).digest(), "little") for i in ids.tolist()]
    return -np.log(-np.log((np.array(u, np.float64) + 0.5) / 2.0**64))


def keys(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text: str = "text", seed: str = "resample-1:", most_grams: int | None = None) -> DataFrame:
    """``(id, n_grams, log_weight, key)``: the sum of the log ratios of a text's n-grams, and that plus the noise. With
    ``most_grams`` the n-grams of a text count as so many at most, which tempers the weights of long texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, s = [np.zeros(0)], [np.zeros(0)]
            for _, data, offsets in textbytes.slices(b.column(1)):
                codes, at = textbytes.word_ngrams(data, offsets, BITS)
                n.append(textbytes.sum_by_text(np.ones(len(codes), np.float32), at, offsets))
                s.append(textbytes.sum_by_text(ratio[codes], at, offsets))
            n, s = np.concatenate(n), np.concatenate(s)
            w = s if most_grams is None else s * np.minimum(1, most_grams / np.maximum(n, 1))
            ids = b.column(0).fill_null(-1).to_numpy()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n.astype(np.int64)), pa.array(w), pa.array(w + gumbel(ids, seed))], ["id", "n_grams", "log_weight", "key"])

    got = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t")).mapInArrow(run, "id bigint, n_grams bigint, log_weight double, key double")
    return got.withColumnRenamed("id", id_col)


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", quality: str = "quality", share: float | None = None, **how) -> DataFrame:
    """Every row's ``(id, n_grams, log_weight, key, rank, keep)``; ``keep`` marks the k largest keys.

    k is ``share`` of all rows; by default the share of labelled rows whose quality is 1. Defined cases:
    null and empty texts have weight 0; a label without id labels nothing; equal keys rank by id; rows that repeat an id share their noise
    and count one by one; null ids rank last of equals; without labels all rows are kept; an empty
    table gives no rows. Other columns are ignored.
    """
    if share is None:
        good, n = labels.where(F.col(quality).isNotNull()).agg(F.count_if(F.col(quality) == 1), F.count("*")).first()
        share = good / n if n else 1.0
    ratio = fit(docs, labels.where(F.col(quality) == 1), id_col, text)
    ranked = global_rank(keys(docs, ratio, id_col, text, **how), [F.col("key").desc(), F.col(id_col).asc_nulls_last()])
    return ranked.withColumn("keep", F.col("rank") <= F.lit(round(share * docs.count())))
