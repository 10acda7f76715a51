"""Registered queries of the operators (``opN_name``) and of the pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from vigil.llm import bpe, brown, chat, decontam, divergence, linedup, neardup, quality, secrets, substrings, toxicity, trie, warc
from vigil.llm.common import table
from vigil.llm.oracle import ORACLE  # noqa: F401


def op1_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode(table(spark, sf_dir, "documents"), ranks, decoded="decoded")
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linedup.line_dedup(docs).select("doc_id", "n_lines", "n_repeats", "n_near",
                                           F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op3_quality(spark, sf_dir):
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    return quality.quality(table(spark, sf_dir, "documents"), trusted)


def op4_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    return (toxicity.score(docs, *model)
            .select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")))


def op5_suffixes(spark, sf_dir):
    made = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_decontam(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", F.size("matches").cast("long").alias("n_items"),
                        F.concat_ws(",", F.transform(F.array_sort("matches.item_id"), lambda i: i.cast("string"))).alias("item_ids"),
                        F.array_max("matches.similarity").alias("similarity"),
                        (F.size("matches") > 0).alias("contaminated"))


def op7_neardup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op8_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_secrets(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return (secrets.scan(table(spark, sf_dir, "documents"), ranks)
            .select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"),
                    "spans", "n_random"))


def op10_chat(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    said = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return chat.digests(chat.windows(turns.unionByName(own), ranks)).drop("n_windows")


def op11_codes(spark, sf_dir):
    return trie.digest(trie.compress(table(spark, sf_dir, "embeddings")))


def op12_brown(spark, sf_dir):
    return brown.score(table(spark, sf_dir, "documents"))


def op13_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_lines": op2_lines,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_suffixes": op5_suffixes,
    "op6_decontam": op6_decontam,
    "op7_neardup": op7_neardup,
    "op8_warc": op8_warc,
    "op9_secrets": op9_secrets,
    "op10_chat": op10_chat,
    "op11_codes": op11_codes,
    "op12_brown": op12_brown,
    "op13_divergence": op13_divergence,
}
