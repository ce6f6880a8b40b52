"""Registered queries of this subpackage: each applies one operator to its whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import (
    ann, chat, decontaminate, dialogue, langid, lines, lm, mixing, ngram_join, quality, toxicity, warc, whitening,
)
from leafmill.llm.shared import stage, table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(table(spark, sf_dir, "documents"))


def _remainder(n: int) -> Column:
    """crc32 of the id as text, mod n; a null id counts as the text ""."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % n


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(_remainder(3) != 1)
    scored = toxicity.score(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def turn_log(turns: DataFrame) -> DataFrame:
    """The event log of turns (conv_id, turn, role, text), as a stage table since it deals message ids.

    Each turn is opened, gets a draft that an edit or a regeneration voids, and streams its text in three parts;
    every fourth is followed by a message that is retracted.  A turn without a number has no order of
    events and is logged whole.
    """
    text, own = F.coalesce("text", F.lit("")), F.col("own")
    part = F.ceil(F.length(text) / 3).cast("int")
    first, second = F.substring(text, F.lit(1), part), F.substring(text, part + 1, part)
    third = F.substring(text, 2 * part + 1, F.length(text))
    edited, void = own % 2 == 0, F.lit(None).cast("string")

    def event(step: int | None, kind: str | Column, text: Column, role: Column = void, message: Column = own) -> Column:
        seq = F.col("turn").cast("long") if step is None else F.col("turn").cast("long") * 16 + step
        return F.struct(seq.alias("seq"), (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
                        message.cast("long").alias("message"), role.alias("role"), text.alias("text"))

    streamed = [event(0, "open", void, F.col("role")), event(1, "delta", F.concat(F.lit("draft "), F.substring(text, 1, 8))),
                event(2, F.when(edited, "edit").otherwise("regenerate"), F.when(edited, first)),
                event(3, "delta", F.when(edited, "").otherwise(first)), event(4, "delta", second), event(5, "delta", third)]
    gone = [event(6, "open", void, F.col("role"), -1 - own), event(7, "delta", F.lit("gone"), message=-1 - own), event(8, "retract", void, message=-1 - own)]
    whole = F.array(event(None, "message", F.col("text"), F.col("role"), F.lit(None)))
    events = F.when(F.col("turn").isNull(), whole).when(own % 4 == 0, F.array(*streamed, *gone)).otherwise(F.array(*streamed))
    log = turns.withColumn("own", F.monotonically_increasing_id()).select("conv_id", F.explode(events).alias("event"))
    return stage(log.select("conv_id", "event.*"), "chat-log")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns are logged as streamed events; conversation -7 holds control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], turns.schema)
    return chat.read_back(chat.format_chats(turn_log(turns.union(extra))))


def op4_warc_zstandard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder, model = lm.train(docs.where(_remainder(7) != 2))
    scored = lm.score(docs, folder, model)
    return scored.select("doc_id", (_remainder(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages; texts of both are judged by what documents declare."""
    docs = langid.of_documents(table(spark, sf_dir, "documents")).withColumn("page_id", F.lit(None).cast("long"))
    pages = langid.of_pages(table(spark, sf_dir, "pages")).withColumn("doc_id", F.lit(None).cast("long"))
    columns = ["doc_id", "page_id", "text", "declared", "suffix", "host", "site"]
    return langid.identify(docs.select(columns).union(pages.select(columns)), ["doc_id", "page_id"],
                           learn_from=docs.select("text", "declared"))


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(ann.build_index(vectors, k=20), vectors.where("vec_id % 20 = 0"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(table(spark, sf_dir, "documents")).taken
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "kept")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) damaged by a checksum of conversation and turn: dropped, emptied, cut, repeated, or said by the user."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind, role, text = F.crc32(name) % 20, F.coalesce("role", blank), F.coalesce("text", blank)
    return turns.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return dialogue.digests(damaged(turns), turns.select("conv_id"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(whitening.grid(table(spark, sf_dir, "embeddings")))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_toxicity, op3_chat_formatting, op4_warc_zstandard, op5_kneser_ney, op6_line_dedup,
    op7_language_id, op8_permutation_index, op9_benchmark_decontamination, op10_source_mixing,
    op11_quality_rules, op12_conversation_repair, op13_embedding_whitening,
)}
