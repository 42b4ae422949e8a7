"""The registered queries of the training-data operators: each reads its whole table and returns its whole result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, html, neardup, passages, quality, repeats, secrets, shard
from .common import local_rows, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), window=10).select("doc_id", "contamination")
    c = "contamination"
    return found.select(
        "doc_id",
        f"{c}.n_words",
        f"{c}.n_hit",
        F.size(f"{c}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{c}.items", ","), 256).alias("items_sha256"),
        (F.col(f"{c}.n_hit") > 0).alias("contaminated"),
    )


def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard.assign(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs).select("doc_id", "secrets")
    base = [r.kind for r in secrets.BASE]

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    return found.select(
        "doc_id", *[count(k) for k in base], F.sha2(told(F.filter("secrets", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), told(F.col("secrets")).alias("spans")
    )


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_passages(table(spark, sf_dir, "documents"), length=50)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    cutoffs = quality.calibrate(docs, table(spark, sf_dir, "labels"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.judge(docs, cutoffs).select("doc_id", *[f"quality.{n}" for n in names])


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded=True).select("doc_id", "bpe")
    return coded.select(
        "doc_id",
        (F.octet_length("bpe.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("bpe.ids", 256).alias("ids_sha256"),
        F.sha2(F.col("bpe.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = local_rows(spark, [(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    chats = chat.chat_format(chat.from_turn_rows(rows.unionByName(more))).select("conv_id", "chat")
    turn = F.transform("read.turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chat.chat_read(chats).select(
        "conv_id",
        "read.n_turns",
        F.sha2(F.array_join(turn, ""), 256).alias("turns_sha256"),
        F.char_length("read.loss").cast("long").alias("loss_chars"),
        F.sha2("read.loss", 256).alias("loss_sha256"),
        F.char_length("chat.formatted").cast("long").alias("formatted_chars"),
    )


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_passages(table(spark, sf_dir, "documents"), length=50)


QUERIES = {
    f.__name__: f for f in (op1_decontaminate, op2_shard, op3_neardup, op4_secrets, op5_repeats, op6_quality, op7_bpe, op8_chat, op9_html, op10_passages)
}
