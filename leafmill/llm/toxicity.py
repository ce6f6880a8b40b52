"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is learned: units are whole words and their first 4 to 9 bytes, A-Z lower-cased; a unit
enters if documents labelled toxic hold it far more often than others (log-odds), and enough of them do.  Features
of a whole text are lexicon densities, nearness of lexicon words to second-person words, rates of
capitals, punctuation, runs of one character, and obfuscation (a digit or symbol between two letters).

Labelled rows are dealt to three parts, each label evenly, by a hash of the id.  The features of a part come from a
lexicon of the other two, and a model of trees per part is fitted on the other two, so that its chances of the part's own rows, on
which the calibration is fitted, are of rows it has not seen.  A document's features come from the lexicon of all
parts, its chance is the models' mean.  This holds at every size, so that few labels serve every step.  At most TRAIN_ROWS
labelled rows are used, those of the smallest hashes, and at most LEXICON_UNITS units, those of the largest odds; these are
the documented bounds of the sample.
All documents are scored, each as a whole, without shuffling their texts.

Defined results: null and empty texts have all features 0 and get the score of such a row; of
labels that repeat an id the largest counts, null labels are skipped; a null id counts as the text ""
when rows are held out; repeated rows are scored alike; with rows of one label only, each row's score is
the share of label 1 (0 without labels); a part whose other parts hold one label only gets no model, and if
there is no other part, one model is fitted and calibrated on all rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.shared import stage
from leafmill.llm.words import _bytes, slices, strings, words

TRAIN_ROWS = 30_000
PREFIXES = (4, 5, 6, 7, 8, 9)
LEAST_DOCS, LEAST_SHARE, LEAST_ODDS, STRONG_ODDS = 3, 0.015, 1.8, 3.0
LEXICON_UNITS = 20_000
NEAR_WORDS = 5
TREES, DEPTH, LEAST_LEAF, FOLDS = 30, 4, 3, 3
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te ti toi ton ta tes vous votre usted ustedes tus"
FEATURES = ("log_words", "lexicon", "strong", "highest", "log_hits", "second_person", "near_share", "near_density",
            "capitals", "exclaims", "questions", "punctuation", "runs", "obfuscated", "digits")

_CLASS = np.zeros(256, np.uint8)  # 1 lower or non-ASCII letter, 2 capital, 3 digit, 4 other sign, 0 white space
_CLASS[33:127] = 4
_CLASS[48:58] = 3
_CLASS[65:91] = 2
_CLASS[97:123] = 1
_CLASS[128:] = 1


def _units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words, units) hashes, and where each text's words begin."""
    whole, begin, heads = words(texts, PREFIXES)
    return np.concatenate((whole[:, None], heads), 1), begin


def learn_lexicon(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Units and their log-odds from (text, toxic) rows."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                units, begin = _units(piece.column("text"))
                own = [np.unique(units[a:b]) for a, b in zip(begin[:-1], begin[1:])]
                sizes = [len(x) for x in own]
                flat = np.concatenate(own) if own else np.zeros(0, np.uint64)
                toxic = np.repeat(piece.column("toxic").to_numpy(zero_copy_only=False), sizes)
                keep = flat != 0
                yield pa.record_batch({"unit": pa.array(flat[keep].view(np.int64)), "toxic": pa.array(toxic[keep].astype(np.int64))})

    total = labelled.agg(F.sum("toxic").alias("a"), F.count("*").alias("n")).first()
    a, b = total["a"] or 0, (total["n"] or 0) - (total["a"] or 0)
    odds = (F.log((F.col("a") + 0.5) / (a + 1.0)) - F.log((F.col("n") - F.col("a") + 0.5) / (b + 1.0)))
    rows = (
        labelled.select("text", "toxic").mapInArrow(held, "unit long, toxic long")
        .groupBy("unit").agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
        .where(F.col("a") >= max(LEAST_DOCS, LEAST_SHARE * a)).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc("odds"), "unit").limit(LEXICON_UNITS).collect())
    units = np.array([r["unit"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(units)
    return units[order], np.array([r["odds"] for r in rows], float)[order]


def _features(texts: pa.Array, lexicon: np.ndarray, odds: np.ndarray, second: np.ndarray) -> np.ndarray:
    units, begin = _units(texts)
    n = len(texts)
    out = np.zeros((n, len(FEATURES)))
    counts = np.diff(begin)
    worth = np.zeros(len(units))
    if len(lexicon) and len(units):
        for j in range(units.shape[1]):
            at = np.minimum(np.searchsorted(lexicon, units[:, j]), len(lexicon) - 1)
            worth = np.maximum(worth, np.where(lexicon[at] == units[:, j], odds[at], 0.0))
    you = np.isin(units[:, 0], second)
    # distance to the nearest second-person word, never across texts
    row = np.repeat(np.arange(n), counts)
    where_you, hits = np.flatnonzero(you), np.flatnonzero(worth > 0)
    near = np.zeros(len(hits), bool)
    if len(where_you) and len(hits):
        after = np.searchsorted(where_you, hits)
        for pick in (np.minimum(after, len(where_you) - 1), np.maximum(after - 1, 0)):
            other = where_you[pick]
            near |= (np.abs(other - hits) <= NEAR_WORDS) & (row[other] == row[hits])

    def per_text(values: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(row if at is None else row[at], values, n)

    size = np.maximum(counts, 1)
    n_hits = per_text(np.ones(len(hits)), hits)
    out[:, 0] = np.log1p(counts)
    out[:, 1] = per_text(worth) / size
    out[:, 2] = per_text((worth >= STRONG_ODDS).astype(float)) / size
    if len(units):
        np.maximum.at(out[:, 3], row, worth)
    out[:, 4] = np.log1p(n_hits)
    out[:, 5] = per_text(you.astype(float)) / size
    out[:, 6] = per_text(near.astype(float), hits) / np.maximum(n_hits, 1)
    out[:, 7] = per_text(near.astype(float), hits) / size

    raw, bounds = _bytes(texts)
    kind = _CLASS[raw]
    letter = (kind == 1) | (kind == 2)
    between = np.zeros(len(raw), bool)
    repeat = np.zeros(len(raw), bool)
    if len(raw) > 2:
        between[1:-1] = (kind[1:-1] >= 3) & letter[:-2] & letter[2:]
        repeat[2:] = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & (kind[2:] > 0)

    def rate(mask: np.ndarray, over: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(over, 1)

    letters = rate(letter, np.ones(n))
    signs = np.diff(bounds)
    out[:, 8] = rate(kind == 2, letters)
    out[:, 9] = rate(raw == 33, size)
    out[:, 10] = rate(raw == 63, size)
    out[:, 11] = rate(kind == 4, signs)
    out[:, 12] = rate(repeat, size)
    out[:, 13] = rate(between, size)
    out[:, 14] = rate(kind == 3, signs)
    return out


def with_features(docs: DataFrame, keep: list[str], lexicon: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``keep`` columns and ``features`` of whole texts."""
    second = words(strings([SECOND_PERSON]))[0]
    shipped = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, odds = shipped.value
        for batch in batches:
            for piece in slices(batch, "text"):
                made = _features(piece.column("text"), units, odds, second)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1) * made.shape[1], pa.int32()), pa.array(made.ravel()))
                yield pa.RecordBatch.from_arrays([piece.column(c) for c in keep] + [lists], [*keep, "features"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, "text").mapInArrow(run, f"{shape}, features array<double>")


def _folds(train: DataFrame) -> DataFrame:
    """(label, part, vector): features of each part with a lexicon of the other parts, as a stage table."""
    rows = None
    for part in range(FOLDS):
        own = with_features(train.where(F.col("part") == part), ["toxic", "part"], learn_lexicon(train.where(F.col("part") != part)))
        rows = own if rows is None else rows.union(own)
    return stage(rows, "toxicity-features").select(F.col("toxic").cast("double").alias("label"), "part", array_to_vector("features").alias("vector"))


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, score) of all ``docs`` (doc_id, text), learned from ``labels`` (doc_id, toxic) of their own ids."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = (labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    # at most train_rows ids, so they may be sent to all tasks; parts take turns within each label
    turn = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id", F.lit("part")), "doc_id"))
    dealt = stage(chosen.withColumn("part", turn % FOLDS), "toxicity-labels")
    train = stage(docs.join(F.broadcast(dealt), "doc_id").select("doc_id", "text", "toxic", "part"), "toxicity-train")
    held = {(r["toxic"], r["part"]) for r in train.select("toxic", "part").distinct().collect()}
    if len({toxic for toxic, _ in held}) < 2:
        mean = train.agg(F.avg("toxic")).first()[0] or 0.0
        return docs.select("doc_id", F.lit(float(mean)).alias("score"))
    folds = _folds(train)
    chance = F.element_at(vector_to_array("probability"), 2)
    learner = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, minInstancesPerNode=LEAST_LEAF,
                            stepSize=0.2, seed=1)
    # the other parts of a label's single row hold one label only
    able = [p for p in sorted({p for _, p in held}) if len({toxic for toxic, q in held if q != p}) == 2]
    models = [learner.fit(folds.where(F.col("part") != p)) for p in able] or [learner.fit(folds)]
    late = None
    for trees, unseen in zip(models, [F.col("part") == p for p in able] or [F.lit(True)]):
        own = trees.transform(folds.where(unseen)).select("label", chance.alias("raw"))
        late = own if late is None else late.union(own)
    steps = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="level").fit(late)
    scored = with_features(docs, ["doc_id"], learn_lexicon(train)).withColumn("vector", array_to_vector("features"))
    raw = F.lit(0.0)
    for k, trees in enumerate(models):
        scored = (trees.setProbabilityCol("probability").transform(scored).withColumn(f"raw{k}", chance)
                  .drop("rawPrediction", "probability", "prediction"))
        raw = raw + F.col(f"raw{k}")
    scored = steps.transform(scored.select("doc_id", (raw / len(models)).alias("raw")))
    # the trees' own order stays visible within a level of the calibration
    return scored.select("doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.999 * F.col("level") + 0.001 * F.col("raw"))).alias("score"))
