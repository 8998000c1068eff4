"""Language identification by Bayesian evidence fusion.

Log-likelihoods of a text's byte trigrams are combined with the likelihood of its declared markup
language and of its address suffix, and with a prior of its host that is smoothed
hierarchically: the corpus, the domain, the host. The likelihoods of the declarations and the priors
are counts of grouped aggregation over all rows, by the languages their texts alone speak for.

Scale: one pass over the texts leaves a slim table (id, declarations, scores), written once; all
aggregations and joins run on that. Only the trigram model is fitted on a bounded sample of labelled
rows: about ``per_language`` rows of each language, those with the smallest hashes of their ids. It has two halves, by
another bit of that hash; a row is scored by the half that was fitted without it, so its own label counts but once, as its declaration.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumlake.llm import textbytes
from quorumlake.plans.joins import join_dim
from quorumlake.plans.staging import Stage

BITS = 16
#: The class of text that no language explains better than chance.
NONE = "und"
#: Log factor of its uniform model: between a language's unseen trigrams (0.1) and its seen ones.
NONE_LOG = -1.8


@dataclass
class TrigramModel:
    languages: list[str]
    #: float32 [languages + 1, 2 * 2^BITS], the halves one after the other; the last row is the uniform model of NONE
    logp: np.ndarray

    def scores(self, data: np.ndarray, offsets: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams and log-likelihoods [texts, languages + 1] of each text, by the model of the half that it is not in."""
        codes, at = textbytes.trigrams(data, offsets, BITS)
        n = np.diff(np.searchsorted(at, offsets))
        codes += np.repeat((1 - half.astype(np.int64)) << BITS, n)
        return n, np.stack([textbytes.sum_by_text(row[codes], at, offsets) for row in self.logp], 1)


def half_of(id_col: str) -> Column:
    """0 or 1, by a bit of the id's hash that the sample's bound does not look at."""
    return F.shiftright(F.xxhash64(id_col), 40).bitwiseAND(F.lit(1)).cast("int")


def fit(docs: DataFrame, languages: list[str], label: str = "lang", id_col: str = "doc_id", text: str = "text", per_language: int = 4000) -> TrigramModel:
    """Trigram model of labelled rows; without any it is uniform. Of a language with n rows those are taken whose
    id's hash falls in the first ``per_language`` / n of its range: about ``per_language``, or all if there are fewer."""
    known = docs.where(F.col(label).isin(languages))
    n = {r[0]: r[1] for r in known.groupBy(label).agg(F.count("*")).collect()}  # a row a language
    drawn = F.pmod(F.xxhash64(id_col), F.lit(1 << 32)) / F.lit(float(1 << 32))
    least = F.coalesce(*[F.when(F.col(label) == x, F.lit(per_language / n[x])) for x in n], F.lit(0.0))
    number = F.array_position(F.array(*map(F.lit, languages)), F.col(label)).cast("int") - 1
    sample = known.where(drawn < least).select((number + half_of(id_col) * len(languages)).alias("l"), F.col(text).alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2 * len(languages), 1 << BITS), np.int64)
        for b in batches:
            label_of = b.column(0).to_numpy()
            for row, data, offsets in textbytes.slices(b.column(1)):
                codes, at = textbytes.trigrams(data, offsets, BITS)
                of = label_of[row + np.searchsorted(offsets, at, "right") - 1]
                np.add.at(seen, (of, codes), 1)
        of, code = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), pa.array(code, pa.int64()), pa.array(seen[of, code])], ["l", "c", "n"])

    total = sample.mapInArrow(count, "l bigint, c bigint, n bigint").groupBy("l", "c").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full((2 * len(languages), 1 << BITS), 1e-9)
    counts[total["l"].to_numpy(), total["c"].to_numpy()] += total["n"].to_numpy()
    logp = np.log(0.9 * counts / counts.sum(1, keepdims=True) + 0.1 / (1 << BITS))
    chance = np.full((1, 2 << BITS), -BITS * np.log(2.0) + NONE_LOG)
    halves = logp.reshape(2, len(languages), 1 << BITS).transpose(1, 0, 2).reshape(len(languages), 2 << BITS)
    return TrigramModel(list(languages), np.concatenate([halves, chance]).astype(np.float32))


def score(rows: DataFrame, model: TrigramModel, text: str) -> DataFrame:
    """``rows`` with ``n_grams bigint`` and ``ll array<double>`` in place of ``_half`` and ``text``."""
    keep = [c for c in rows.columns if c not in (text, "_half")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grams, likely = [], []
            half = b.column(b.num_columns - 2).to_numpy()
            for row, data, offsets in textbytes.slices(b.column(b.num_columns - 1)):
                n, ll = model.scores(data, offsets, half[row : row + len(offsets) - 1])
                grams.append(n)
                likely.append(ll)
            n = np.concatenate(grams) if grams else np.zeros(0)
            ll = np.concatenate(likely) if likely else np.zeros((0, len(model.logp)))
            cells = pa.FixedSizeListArray.from_arrays(pa.array(ll.ravel()), ll.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(n.astype(np.int64)), cells], [*keep, "n_grams", "ll"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, "_half", text).mapInArrow(run, f"{schema}, n_grams bigint, ll array<double>")


def _softmax(x: Column) -> Column:
    e = F.transform(x, lambda v: F.exp(v - F.array_max(x)))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def _smoothed(counts: list[Column], prior: list[Column], strength: float) -> Column:
    total = sum(counts, F.lit(0))
    return F.array(*[(c + F.lit(strength) * p) / (total + F.lit(strength)) for c, p in zip(counts, prior)])


def identify(
    docs: DataFrame,
    model: TrigramModel,
    id_col: str = "doc_id",
    text: str = "text",
    declared: Column | None = None,
    suffix: Column | None = None,
    domain: Column | None = None,
    host: Column | None = None,
    least_posterior: float = 0.5,
    strength: float = 20.0,
    most_grams: int = 200,
) -> DataFrame:
    """``(id, language, posterior, n_grams, declared, keep)`` of every row.

    Text evidence counts as that of at most ``most_grams`` independent trigrams. A missing piece of evidence
    (null, or not given) contributes nothing. ``keep`` is false where the text has no trigram (three bytes
    around a letter), where no language beats chance, or where the posterior is under ``least_posterior``.
    Of languages of equal posterior the first in the model's order counts.
    Defined cases: null and empty texts are ``und`` with posterior 1 and not kept; rows that repeat an
    id are judged one by one; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    names = [*model.languages, NONE]
    blank = F.lit(None).cast("string")
    of = lambda c: blank if c is None else F.lower(c.cast("string"))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.regexp_extract(of(declared), "^[a-z]{2,3}", 0).alias("_declared") if declared is not None else blank.alias("_declared"),
        of(suffix).alias("_suffix"), of(domain).alias("_domain"), of(host).alias("_host"), half_of(id_col).alias("_half"), F.col(text).alias("_text"),
    )
    stage = Stage(spark, "language")
    scored = score(rows, model, "_text")
    share = F.when(F.col("n_grams") > most_grams, F.lit(float(most_grams)) / F.col("n_grams")).otherwise(1.0)
    scored = scored.select("_id", F.nullif("_declared", F.lit("")).alias("_declared"), "_suffix", "_domain", "_host", "n_grams", F.transform("ll", lambda x: x * share).alias("ll"))
    scored = scored.withColumn("_own", F.when(F.col("n_grams") > 0, F.array_position("ll", F.array_max("ll"))).otherwise(len(names)).cast("int"))
    scored = stage.put(scored, "scored")
    each = [F.count_if(F.col("_own") == i + 1) for i in range(len(names))]
    n = [F.col(f"n{i}") for i in range(len(names))]

    def counts(*keys: str) -> DataFrame:
        return scored.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(*[c.alias(f"n{i}") for i, c in enumerate(each)])

    whole = scored.agg(*each).first()
    top = [F.lit((c + 1.0) / (sum(whole) + len(names))) for c in whole]

    def likelihood(key: str, name: str) -> DataFrame:
        """log P(declaration | language), with one made-up row of each declaration spread by the corpus."""
        return counts(key).select(key, F.array(*[F.log((a + p) / F.lit(w + 1.0)) for a, p, w in zip(n, top, whole)]).alias(name))

    fused = scored
    for key, name in (("_declared", "_ld"), ("_suffix", "_ls")):
        fused = join_dim(fused, stage.put(likelihood(key, name), name), key)
    domains = stage.put(counts("_domain").select("_domain", _smoothed(n, top, strength).alias("_pd")), "domains")
    hosts = join_dim(counts("_host", "_domain"), domains, "_domain")
    above = [F.coalesce(F.get("_pd", F.lit(i)), p) for i, p in enumerate(top)]
    hosts = stage.put(hosts.select(F.col("_host").alias("_hh"), F.col("_domain").alias("_hd"), _smoothed(n, above, strength).alias("_ph")), "hosts")
    few = hosts.limit(200_001).count() <= 200_000
    at_host = (F.col("_host") == F.col("_hh")) & F.col("_domain").eqNullSafe(F.col("_hd"))
    fused = fused.join(F.broadcast(hosts) if few else hosts, at_host, "left")
    total = F.array(
        *[
            F.get("ll", F.lit(i)) + F.coalesce(F.get("_ld", F.lit(i)), F.lit(0.0)) + F.coalesce(F.get("_ls", F.lit(i)), F.lit(0.0)) + F.log(F.coalesce(F.get("_ph", F.lit(i)), p))
            for i, p in enumerate(top)
        ]
    )
    fused = fused.withColumn("_p", _softmax(total))
    best = F.array_position("_p", F.array_max("_p")).cast("int")
    language = F.when(F.col("n_grams") > 0, F.element_at(F.array(*map(F.lit, names)), best)).otherwise(NONE)
    posterior = F.when(F.col("n_grams") > 0, F.array_max("_p")).otherwise(1.0)
    return fused.select(
        F.col("_id").alias(id_col), language.alias("language"), posterior.alias("posterior"), "n_grams", F.col("_declared").alias("declared"),
        ((language != NONE) & (posterior >= least_posterior)).alias("keep"),
    )


def documents(docs: DataFrame, languages: list[str] = ("de", "en", "es", "fr")) -> DataFrame:
    """Documents: declared by ``lang``, hosted by ``source``; they have no address."""
    model = fit(docs, list(languages))
    return identify(docs, model, declared=F.col("lang"), host=F.col("source"))


def accepted(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` but for the ids of which no row is kept; rows without id stay."""
    gone = found.groupBy(id_col).agg(F.max("keep").alias("_kept")).where("not _kept").select(id_col)
    gone = Stage(docs.sparkSession, "language").put(gone, "rejected")
    return join_dim(docs, gone, id_col, "left_anti")


#: Public suffixes of two labels under which names are registered; a run over real pages passes the whole list.
TWO_PART_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "edu.au", "co.nz", "co.za", "co.in", "co.jp", "ne.jp", "or.jp", "ac.jp",
    "com.br", "com.ar", "com.mx", "com.co", "com.pe", "com.ve", "com.es", "org.es", "gob.es", "gob.mx", "asso.fr", "gouv.fr", "com.fr", "co.at", "or.at",
)


def address(host: Column, suffixes: tuple[str, ...] = TWO_PART_SUFFIXES) -> tuple[Column, Column]:
    """``(suffix, domain)`` of a host: the suffix is one of ``suffixes`` or the last label, the domain that and the label
    before it. A number address, a host of one label, or one that is a suffix itself has no domain; a number address has no suffix."""
    host = F.rtrim(host, F.lit("."))
    number = host.rlike(r"^[0-9.]+$") | host.contains(":") | host.startswith("[")
    labels = F.size(F.split(host, r"\."))
    two = F.substring_index(host, ".", -2)
    long = two.isin(list(suffixes)) if suffixes else F.lit(False)
    suffix = F.when(long, two).otherwise(F.substring_index(host, ".", -1))
    domain = F.when(long, F.when(labels > 2, F.substring_index(host, ".", -3))).otherwise(F.when(labels > 1, two))
    return F.when(~number, suffix), F.when(~number, domain)


def pages(table: DataFrame, model: TrigramModel, suffixes: tuple[str, ...] = TWO_PART_SUFFIXES) -> DataFrame:
    """Web pages: declared by ``<html lang>``, with the suffix, domain and host of their address."""
    host = F.nullif(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?(\[[^\]/]*\]|[^/:?#]+)", 1)), F.lit(""))
    declared = F.nullif(F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z-]+)", 1), F.lit(""))
    plain = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^>]*+>|&[a-zA-Z#0-9]+;", " ")
    rows = table.select("page_id", plain.alias("text"), declared.alias("d"), host.alias("h"))
    suffix, domain = address(F.col("h"), suffixes)
    return identify(rows, model, "page_id", declared=F.col("d"), suffix=suffix, domain=domain, host=F.col("h"))
