"""The corpus pipeline: five stages, each an operator of the training-data subpackage over all its
predecessor kept. ``run`` applies them to ``documents``; each stage's rows are written as Parquet to the
shared folder and read again, so a lost executor costs a stage at most.

Every stage takes nulls in any column, empty and very long texts, repeated rows and ids, empty tables and columns of
any other names, which it hands on; what it does with them is said at each.

No SQL oracle: language scores, surrogates and tokens are not expressible in SQL; the tests hold
the stages against brute-force versions instead.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlake.llm import bpe, language_id, mixing, near_dedup, pii
from quorumlake.llm.queries import TOKENS, pii_key
from quorumlake.plans.shipping import ship
from quorumlake.plans.staging import Stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an accepted language; those without letters, in none or in doubt go.

    Null and empty texts have no language and go, unless another row of their id stays; rows that repeat an id stay
    or go together; rows with a null id stay; a null ``lang`` or ``source`` is missing evidence. Of languages that are equally
    likely the first by name counts."""
    ship(spark)
    return language_id.accepted(docs, language_id.documents(docs))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group whose five-word shingles are similar by 0.8 or more.

    Null, empty and blank texts are equal to one another, so one of them stays; texts of under five words are one
    shingle; rows that repeat an id stay or go together; rows with a null id stay and are nobody's smallest."""
    return near_dedup.keep_one_similar(docs, width=5, least=0.8)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data and secrets replaced by surrogates; ``n_chars`` follows.

    A null text stays null, an empty one empty; equal entities get equal surrogates in all rows, repeated rows and
    rows with a null id included."""
    return pii.anonymise(docs, pii_key(spark)).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the one at its source's cut in part.

    Null and empty texts have no words and are never taken; a null source is a source of its own; rows with a null or
    repeated id are rows of their own, ordered by a hash of the text where there is no id; equal keys go by id, size, row."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and digests of them and of the bytes they decode to.

    A null text counts as empty and has no tokens; repeated rows are encoded one by one; ids are handed on as they are."""
    path, pattern = public_tokenizers.path(TOKENS), public_tokenizers.PATTERN
    both = bpe.encode(docs, path, pattern, keep=["doc_id", "source", "lang"], back=True)
    return both.select("doc_id", "source", "lang", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", dedup),
    ("PII surrogates", surrogates),
    ("source mix", mix),
    ("byte-level BPE", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stage = Stage(spark, "pipeline")
    for i, (_, step) in enumerate(STAGES):
        docs = stage.put(step(spark, docs, sf_dir), str(i))
        if i:
            stage.drop(str(i - 1))
    return docs
