"""Language ID by Bayesian fusion of text likelihoods with markup, address and host evidence.

Four kinds of evidence meet in a posterior over the known languages and "und", none of them:

* text: hashed byte trigrams, multinomial likelihoods learned from all rows that declare a known
  language; "und" is uniform.  A text's mean log-likelihood counts as ``n / (1 + n / TEXT_WEIGHT)`` of
  n trigrams, as they are not independent;
* the declared language of the markup, P(declared | language);
* the address suffix, P(suffix | language);
* the host, P(language | host), smoothed towards its site, and that towards all rows.

The last three come from grouped counts of the texts' best languages over all rows.

Defined results: null evidence counts as a value of its own; a text of fewer than three bytes says
nothing, and the rest decides; ties go to the language named first; repeated rows get equal
results; an empty table gives no rows; columns that are not asked for are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.llm.shared import stage
from leafmill.llm.words import _FOLD, _bytes, slices

LANGUAGES = ("en", "de", "fr", "es")
BUCKET_BITS = 15
TEXT_WEIGHT = 100.0
STRENGTH = 20.0
LEAST_POSTERIOR = 0.5
_SLICE = 1 << 20
UND = "und"


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram codes by byte position, and each text's first position and number of trigrams."""
    raw, bounds = _bytes(texts)
    low = _FOLD[raw].astype(np.uint32)
    low[(raw < 33)] = 32
    code = np.zeros(len(raw) + 1, np.int64)
    if len(raw) > 2:
        packed = (low[:-2] | (low[1:-1] << np.uint32(8)) | (low[2:] << np.uint32(16))) * np.uint32(2654435761)
        code[: len(raw) - 2] = packed >> np.uint32(32 - BUCKET_BITS)
    return code, bounds, np.maximum(np.diff(bounds) - 2, 0)


def trigram_counts(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
    """(languages, buckets) counts over all rows whose ``declared`` is known; a table of fixed size."""
    buckets = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(languages) * buckets, np.int64)
        for batch in batches:
            for piece in slices(batch, "text", _SLICE):
                code, bounds, sizes = _codes(piece.column("text"))
                which = np.array([languages.index(x) if x in languages else -1 for x in piece.column("declared").to_pylist()])
                own = np.flatnonzero((which >= 0) & (sizes > 0))
                if len(own):
                    spans = np.repeat(bounds[own] - np.concatenate(([0], np.cumsum(sizes[own])[:-1])), sizes[own])
                    at = np.arange(int(sizes[own].sum())) + spans
                    seen += np.bincount(np.repeat(which[own], sizes[own]) * buckets + code[at], minlength=len(seen))
        for k in np.flatnonzero(seen.reshape(len(languages), -1).any(1)):
            yield pa.record_batch({"lang": pa.array([k], pa.int32()),
                                   "counts": pa.array([seen[k * buckets: (k + 1) * buckets].tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column("lang").to_pylist(), batch.column("counts")):
                own = np.frombuffer(blob.as_buffer(), np.int64)
                sums[k] = sums[k] + own if k in sums else own.copy()
        for k, own in sums.items():
            yield pa.record_batch({"lang": pa.array([k], pa.int32()), "counts": pa.array([own.tobytes()], pa.binary())})

    shape = "lang int, counts binary"
    # a first sum over groups of tasks, then one per language
    some = rows.select("text", "declared").mapInArrow(count, shape)
    summed = (some.withColumn("_group", F.spark_partition_id() % 64).repartition(16, "lang", "_group").select("lang", "counts")
              .mapInArrow(add, shape).repartition(len(languages), "lang").mapInArrow(add, shape).collect())
    out = np.zeros((len(languages), buckets), np.int64)
    for row in summed:
        out[row["lang"]] = np.frombuffer(row["counts"], np.int64)
    return out


def log_likelihoods(counts: np.ndarray) -> np.ndarray:
    """(buckets, languages + 1): log P(trigram | language), the last column uniform."""
    smooth = counts + 0.01
    known = np.log(smooth / smooth.sum(1, keepdims=True))
    return np.concatenate((known, np.full((1, counts.shape[1]), -np.log(counts.shape[1]))), 0).T.astype(np.float32).copy()


def text_evidence(rows: DataFrame, table: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` columns of rows and ``evidence``: tempered log-likelihoods of all languages and und."""
    shipped = rows.sparkSession.sparkContext.broadcast(table)
    shape = rows.select(*keep).schema.add("evidence", T.ArrayType(T.DoubleType()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logp = shipped.value
        for batch in batches:
            for piece in slices(batch, "text", _SLICE):
                code, bounds, sizes = _codes(piece.column("text"))
                mean = np.empty((piece.num_rows, logp.shape[1]))
                for k in range(logp.shape[1]):
                    sums = np.concatenate(([0.0], np.cumsum(logp[code, k], dtype=np.float64)))
                    mean[:, k] = sums[bounds[:-1] + sizes] - sums[bounds[:-1]]
                mean *= (1.0 / (1.0 + sizes / TEXT_WEIGHT))[:, None]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(piece.num_rows + 1) * logp.shape[1], pa.int32()), pa.array(mean.ravel()))
                yield pa.RecordBatch.from_arrays([piece.column(c) for c in keep] + [lists], [*keep, "evidence"])

    return rows.select(*keep, "text").mapInArrow(score, shape)


def _counts_by(best: DataFrame, key: str, n: int) -> DataFrame:
    counts = F.array(*[F.sum((F.col("best") == k).cast("long")).cast("double") for k in range(n)])
    return best.groupBy(key).agg(counts.alias("counts"))


def _plus(a: Column, b: Column, n: int, f) -> Column:
    return F.array(*[f(a[k], b[k]) for k in range(n)])


def _log_given(best: DataFrame, key: str, totals: list[float]) -> DataFrame:
    """key -> log P(key | language): counts smoothed towards the key's share of all rows."""
    n, everything = len(totals), max(sum(totals), 1.0)
    counts = _counts_by(best, key, n)
    share = F.aggregate("counts", F.lit(0.0), lambda a, x: a + x) / everything
    return counts.select(key, F.array(*[F.log((F.col("counts")[k] + STRENGTH * share) / (totals[k] + STRENGTH))
                                        for k in range(n)]).alias(f"log_{key}"))


def _log_host(best: DataFrame, totals: list[float]) -> DataFrame:
    """host -> log P(language | host), smoothed towards site and all rows."""
    n = len(totals)
    everything = sum(totals) + n
    overall = F.array(*[F.lit((t + 1.0) / everything) for t in totals])
    size = F.aggregate("counts", F.lit(0.0), lambda a, x: a + x)

    def smoothed(counts: DataFrame, above: Column, out: str) -> DataFrame:
        return counts.withColumn(out, _plus(F.col("counts"), above, n, lambda c, p: c + STRENGTH * p)).withColumn(
            out, F.transform(out, lambda x: x / (size + STRENGTH)))

    sites = smoothed(_counts_by(best, "site", n), overall, "p_site").select("site", "p_site")
    hosts = (best.groupBy("host", "site").agg(F.array(*[F.sum((F.col("best") == k).cast("long")).cast("double") for k in range(n)])
                                              .alias("counts")))
    return smoothed(hosts.join(sites, "site"), F.col("p_site"), "p_host").select(
        "host", "site", F.transform("p_host", lambda p: F.log(p)).alias("log_host"))


def identify(rows: DataFrame, keep: list[str], languages: tuple[str, ...] = LANGUAGES, least: float = LEAST_POSTERIOR,
             learn_from: DataFrame | None = None) -> DataFrame:
    """``keep`` columns, lang, posterior, text_lang and rejected for rows (text, declared, suffix, host, site).

    Text likelihoods are learned from ``learn_from`` (text, declared), or else from the rows.
    A row is rejected if its best language is "und" or its posterior is below ``least``.
    """
    names = (*languages, UND)
    n = len(names)
    own = [F.coalesce(F.col(c), F.lit("")).alias(f"_lid_{c}") for c in ("declared", "suffix", "host", "site")]
    rows = rows.select(*keep, "text", *own)
    train = rows.withColumnRenamed("_lid_declared", "declared") if learn_from is None else learn_from
    table = log_likelihoods(trigram_counts(train, languages))
    inner = [f"_lid_{c}" for c in ("declared", "suffix", "host", "site")]
    scored = text_evidence(rows, table, [*keep, *inner])
    scored = stage(scored.withColumn("_lid_best", F.array_position("evidence", F.array_max("evidence")).cast("int") - 1), "langid-text")
    best = scored.select(*[F.col(c).alias(c[5:]) for c in inner], F.col("_lid_best").alias("best"))
    seen = {r["best"]: float(r["n"]) for r in best.groupBy("best").agg(F.count("*").alias("n")).collect()}
    totals = [seen.get(k, 0.0) for k in range(n)]
    facts = [_log_given(best, "declared", totals), _log_given(best, "suffix", totals), _log_host(best, totals)]
    fused = scored
    for fact in facts:
        keys = [c for c in fact.columns if not c.startswith("log_")]
        renamed = fact.select(*[F.col(c).alias(f"_lid_{c}") for c in keys], F.col(fact.columns[-1]).alias("_lid_" + fact.columns[-1]))
        fused = fused.join(renamed, [f"_lid_{c}" for c in keys], "left")
    total = F.array(*[F.col("evidence")[k] + sum((F.col(f"_lid_log_{c}")[k] for c in ("declared", "suffix", "host")), F.lit(0.0))
                      for k in range(n)])
    top = F.array_max("_lid_total")
    share = F.lit(1.0) / F.aggregate("_lid_total", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("_lid_total")))
    label = F.array(*map(F.lit, names))
    return (
        fused.withColumn("_lid_total", total)
        .withColumn("lang", label[F.array_position("_lid_total", top).cast("int") - 1])
        .withColumn("posterior", share).withColumn("text_lang", label[F.col("_lid_best")])
        .withColumn("rejected", (F.col("lang") == UND) | (F.col("posterior") < least))
        .select(*keep, "lang", "posterior", "text_lang", "rejected")
    )


def of_documents(docs: DataFrame) -> DataFrame:
    """Evidence columns of ``documents``: lang is declared, source stands for the host."""
    return docs.withColumns({"declared": F.col("lang"), "suffix": F.lit(None).cast("string"),
                             "host": F.col("source"), "site": F.lit(None).cast("string")})


def of_pages(pages: DataFrame) -> DataFrame:
    """Evidence columns of ``pages``: text without tags, the html element's lang, suffix and host of the url.

    The suffix is a language-like first path segment where there is one, else the host's last label.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[a-zA-Z]+://(?:[^/@]*@)?([^/:?#]*)", 1))
    segment = F.regexp_extract(F.coalesce("url", F.lit("")), "^[a-zA-Z]+://[^/]*/([a-zA-Z]{2})(?:[/?#]|$)", 1)
    text = F.regexp_replace(F.coalesce("html", F.lit("")), "(?is)<(script|style)\\b[^>]*+>.*?</\\1\\s*+>|<!--.*?-->|<[^>]*+>", " ")
    declared = F.substring(F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), "(?is)<html\\b[^>]*?\\blang\\s*+=\\s*+[\"']?([a-z]+)", 1)), 1, 2)
    return pages.withColumns({
        "text": text, "declared": F.when(declared != "", declared),
        "suffix": F.lower(F.when(segment != "", segment).otherwise(F.substring_index(host, ".", -1))),
        "host": host, "site": F.substring_index(host, ".", -2),
    })
