"""Language of web pages by Bayesian fusion of four kinds of evidence.

* the page's text: likelihood under hashed byte trigrams of each language, counted on labelled documents;
* the language that the markup declares;
* the suffix of its address: last label of the host, and a first path folder of two letters;
* its host: a prior from the other pages of the host, smoothed by its domain's, which is smoothed by that
  of all pages.

The text alone first gives every page a posterior. Grouped sums of these posteriors then give the host,
domain and overall priors and the probability of each declaration and suffix in each language, so the
tables need no labels of pages. A page's own posterior is taken out of its host's and domain's sums.
Last, the logarithms are added up.

The trigrams are counted on the ``TRAIN_ROWS`` documents with the smallest hash of their id. Side tables
have a row per host, domain, declaration and suffix and are joined by key; a hot host's pages may be
split, since the other side has one row.

Defined cases: null or empty html has no text, null urls no host: the other evidence decides; without
labelled documents the language is null; ties go to the first language by code point.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.llm.common import per_batch
from abacist.llm.url_filter import host_of, path_of
from abacist.session import materialise

TRAIN_ROWS = 4000
BUCKETS = 1 << 16
TRIGRAMS = 60.0
"""Weight of a text in trigrams: neighbours overlap, so long texts must not count in full."""
HOST_WEIGHT = 5.0
DOMAIN_WEIGHT = 20.0
EVIDENCE_WEIGHT = 1.0


def trigrams(text: str | None) -> np.ndarray:
    codes = np.frombuffer(f" {text or ''} ".lower().encode(), "u1").astype("u4")
    if len(codes) < 3:
        return np.empty(0, "i8")
    mixed = (codes[:-2] * np.uint32(0x9E3779B1)) ^ (codes[1:-1] * np.uint32(0x85EBCA77)) ^ (codes[2:] * np.uint32(0xC2B2AE3D))
    return ((mixed ^ (mixed >> np.uint32(15))) % np.uint32(BUCKETS)).astype("i8")


def fit(documents: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log-probabilities (bucket, language)."""
    mark = F.xxhash64("doc_id")
    labelled = documents.where(F.col("lang").isNotNull())
    edge = labelled.select(mark.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    if edge is None:
        return [], np.zeros((BUCKETS, 0))

    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                totals.setdefault(lang, np.zeros(BUCKETS, "i8"))
                totals[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": counts[at]})

    counted = labelled.where(mark <= edge).select("lang", "text").mapInPandas(run, "lang string, bucket long, n long")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r.lang for r in table})
    counts = np.full((BUCKETS, len(langs)), 0.5)
    for r in table:
        counts[r.bucket, langs.index(r.lang)] += r.n
    return langs, np.log(counts / counts.sum(axis=0))


def text_of(html: Column) -> Column:
    body = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(body, r"<[^>]*>|&[a-z]+;", " ")


def declared_in(html: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"""(?i)<html[^>]*?\slang\s*=\s*["']?([a-z]{2,3})""", 1))


def identify(pages: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """(page_id, lang, confidence, text_lang, declared, suffix, host) of every page."""
    host = host_of(F.col("url"))
    suffix = F.concat(F.regexp_extract(host, r"([^.]*)$", 1), F.lit("/"), F.regexp_extract(path_of(F.col("url")), r"^/([a-z]{2})(?:/|$)", 1))
    rows = pages.select("page_id", host.alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
                        suffix.alias("suffix"), declared_in(F.col("html")).alias("declared"), text_of(F.col("html")).alias("text"))
    if not langs:
        none = F.lit(None).cast("string")
        return rows.select("page_id", none.alias("lang"), F.lit(None).cast("double").alias("confidence"), none.alias("text_lang"), "declared", "suffix", "host")
    model = pages.sparkSession.sparkContext.broadcast(table.astype("f4"))  # BUCKETS x languages

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        likely = np.zeros((len(batch), len(langs)))
        for i, text in enumerate(batch["text"]):
            found = trigrams(text)
            if len(found) > 2 and text.strip():
                likely[i] = model.value[found].mean(axis=0) * min(len(found), TRIGRAMS)
        share = np.exp(likely - likely.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        return batch.drop(columns="text").assign(likely=list(likely), share=list(share))

    scored = materialise(per_batch(rows, run, "page_id long, host string, domain string, suffix string, declared string, "
                                              "likely array<double>, share array<double>"))
    span = range(len(langs))

    def sums(name: str) -> DataFrame:
        return scored.groupBy(F.col(name).alias(f"k_{name}")).agg(
            F.array(*[F.sum(F.col("share")[i]) for i in span]).alias(f"s_{name}"))

    total = scored.agg(*[F.sum(F.col("share")[i]).alias(f"t{i}") for i in span]).first()
    count = np.array([t or 0.0 for t in total]) + EVIDENCE_WEIGHT
    base = count / count.sum()
    joined = scored
    for name in ("host", "domain", "suffix", "declared"):
        joined = joined.join(sums(name), F.col(name) == F.col(f"k_{name}"), "left")
    others = lambda name, i: F.greatest(F.col(f"s_{name}")[i] - F.col("share")[i], F.lit(0.0))

    def added(name: str) -> Column:
        out = others(name, 0)
        for i in span[1:]:
            out = out + others(name, i)
        return out

    n_domain, n_host = added("domain"), added("host")
    joined = joined.withColumn("domain_prior", F.array(*[
        (others("domain", i) + DOMAIN_WEIGHT * float(base[i])) / (n_domain + DOMAIN_WEIGHT) for i in span]))
    joined = joined.withColumn("host_prior", F.array(*[
        (others("host", i) + HOST_WEIGHT * F.col("domain_prior")[i]) / (n_host + HOST_WEIGHT) for i in span]))
    evidence = [
        F.log(F.col("host_prior")[i]) + F.col("likely")[i]
        + sum(F.log((others(name, i) + EVIDENCE_WEIGHT) / float(count[i] + EVIDENCE_WEIGHT)) for name in ("suffix", "declared"))
        for i in span]
    joined = joined.withColumn("score", F.array(*evidence)).withColumn("top", F.array_max("score"))
    mass = F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    names = F.array(*[F.lit(x) for x in langs])
    best = F.element_at(names, F.array_position("score", F.col("top")).cast("int"))
    by_text = F.element_at(names, F.array_position("share", F.array_max("share")).cast("int"))
    return joined.select("page_id", best.alias("lang"), F.round(1 / mass, 6).alias("confidence"), by_text.alias("text_lang"),
                         "declared", "suffix", "host")
