"""The corpus pipeline: quality rules, line dedup, near-duplicate removal,
benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All stages but the last
return the columns of ``documents``; ``n_chars`` follows the text.

Defined cases, of every stage: columns other than doc_id and text travel as one
packed column and come back as they were, whatever their names. A null or empty
text has no words and no lines: the quality rules reject it; where it is let in,
the later stages keep it. Very long texts are worked on whole. A null or
repeated doc_id is a row like others, equal rows are near duplicates of each
other, ties among these go to the smallest doc_id and then to a hash of the row.
An empty table stays empty; without trusted labels every likelihood ratio is 1.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import bpe, decontam, linedup, neardup, quality
from vigil.llm.common import prepare, salted_join, table, written


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns as one, which no column of an operator can clash with."""
    rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others(docs))]
    return docs.select("doc_id", "text", F.struct(*rest, F.lit(0).alias("end")).alias("_rest"))


def others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ("doc_id", "text")]


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` of ``packed(docs)`` with the columns of ``docs``."""
    place = {c: f"_rest.c{i}" for i, c in enumerate(others(docs))}
    return rows.select(*[F.col(place[c]).alias(c) if c in place else F.col(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the likelihood ratio go."""
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    rows = packed(docs)
    return unpacked(quality.quality(rows, trusted, keep=rows.columns).filter("kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and near-repeated lines go; a document that loses its last
    line goes too (one that had no line stays)."""
    made = linedup.line_dedup(packed(docs))
    left = F.col("n_lines") - F.col("n_repeats") - F.col("n_near")
    out = unpacked(made.filter((left > 0) | (F.col("n_lines") == 0)), docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8)
    the row with the smallest doc_id stays (null comes last). Rows are told apart
    by a number of their own, so a null or repeated doc_id is a row like others."""
    prepare(spark)
    # Numbers are fixed by the table; the order of rows that share a doc_id by their contents.
    rows = written(packed(docs).withColumn("_row", F.monotonically_increasing_id()), "near-rows")
    found = neardup.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text", "_rest").alias("tie"), "_row")
    placed = written(rows.select("_row", order.alias("place"))
                     .join(found.select(F.col("doc_id").alias("_row"), "component_id").hint("merge"), "_row"), "near-places")
    first = (placed.groupBy("component_id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("component_id", F.col("first._row").alias("first")))
    gone = salted_join(placed.select("_row", "component_id"), first, "component_id", "inner").filter("_row <> first").select("_row")
    return unpacked(rows.join(gone.hint("merge"), "_row", "left_anti"), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    made = decontam.decontaminate(packed(docs), table(spark, sf_dir, "benchmark"))
    return unpacked(made.filter(F.size("matches") == 0), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and what they decode to."""
    coded = bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), decoded="decoded")
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("encode", encode)]

#: Hashes, signatures and edit distances are not SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
