"""The pN_ queries over the whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftloom.llm import chunking, defects, groups, labeller, mojibake, overlap, packing, sampling, tokens, twins
from draftloom.session import table


def p3_sample(spark: SparkSession, d: str) -> DataFrame:
    """A tenth of the pairs of each source (in any spelling), at least one of each, fed batch by batch.

    The values and thresholds are kept in a store of the shared folder that is
    named by the table's path: a later run over the grown table consults it.
    """
    return _sample(spark, d, 1)


def p3_tenth(spark: SparkSession, d: str) -> DataFrame:
    """The same with the rate alone: a tenth of each source, none where the source is small."""
    return _sample(spark, d, 0)


def _sample(spark: SparkSession, d: str, least: int) -> DataFrame:
    rows = table(spark, d, "pairs").select("pair_id", "source", "ingest_batch")
    at = sampling.named_store(spark, f"p3-least{least}", f"{d.rstrip('/')}/pairs.parquet")
    out = sampling.sample_by_batches(rows, "pair_id", groups.post_key(F.col("source")), "ingest_batch", at, least=least)
    return out.select(F.col("id").alias("pair_id"), F.col("stratum").alias("source"), "u", "threshold", "first_batch")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return groups.related_sources(table(spark, d, "pairs").select("source"), table(spark, d, "posts"))


def p5_splits(spark: SparkSession, d: str) -> DataFrame:
    """Every pair with its group and split."""
    return groups.grouped_split(table(spark, d, "pairs").select("pair_id", "source"), table(spark, d, "posts"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The ids that the cutter returns pieces of."""
    return chunking.split_oversized(table(spark, d, "targets"), "target_id", "text").filter("piece_index = 0").select("target_id")


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    return chunking.split_oversized(table(spark, d, "targets"), "target_id", "text")


def p6_rejoined(spark: SparkSession, d: str) -> DataFrame:
    """Every oversized text, joined from its pieces without their overlaps."""
    return chunking.rejoined(p6_pieces(spark, d), "target_id")


def p6_targets(spark: SparkSession, d: str) -> DataFrame:
    """All targets within the limit, chunk_index and chunk_total put right."""
    return chunking.rechunk_targets(table(spark, d, "targets"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p3_sample": p3_sample,
    "p3_tenth": p3_tenth,
    "p5_found": p5_found,
    "p5_splits": p5_splits,
    "p6_found": p6_found,
    "p6_pieces": p6_pieces,
    "p6_rejoined": p6_rejoined,
    "p6_targets": p6_targets,
}

SQL: dict[str, str] = {
    "p6_found": "SELECT DISTINCT target_id FROM targets WHERE length(text) > 8000",
    "p6_rejoined": "SELECT DISTINCT target_id, text FROM targets WHERE length(text) > 8000",
    "p7_decoded": "SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents",
} | twins.SQL


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"), "doc_id", "text")


def p7_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text, decoded from its ids again."""
    back = tokens.decode(tokens.encode(table(spark, d, "documents"), "doc_id", "text"), "ids", out="text")
    return back.select("doc_id", "text")


QUERIES |= {"p7_ids": p7_ids, "p7_decoded": p7_decoded}


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.garbled(table(spark, d, "documents")).select("doc_id")


def p9_repaired(spark: SparkSession, d: str) -> DataFrame:
    """The affected documents with their chain, posterior and restored text."""
    return mojibake.repaired(table(spark, d, "documents"))


QUERIES |= {"p9_found": p9_found, "p9_repaired": p9_repaired}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "pairs")
    a = defects.flag_defects(pairs, "pairs", "pair_id", defects.turn(F.col("messages"), "user"), defects.turn(F.col("messages"), "assistant"), F.col("context"))
    asked = table(spark, d, "targets").groupBy("target_id").agg(F.max("text").alias("asked"), F.max("context").alias("heading"))
    outputs = table(spark, d, "gen_outputs").select("output_id", "target_id", "text").join(asked, "target_id", "left")
    b = defects.flag_defects(outputs, "gen_outputs", "output_id", F.col("asked"), F.col("text"), F.col("heading"))
    return a.unionByName(b)


QUERIES |= {"p2_found": p2_found}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    targets, pairs = table(spark, d, "targets"), table(spark, d, "pairs")
    said = F.transform(F.filter("messages", lambda m: m["role"].isin("user", "assistant")), lambda m: m["content"])
    a = labeller.families(targets, "target_id", F.array("text")).withColumn("rec_table", F.lit("targets"))
    b = labeller.families(pairs, "pair_id", said).withColumn("rec_table", F.lit("pairs"))
    return a.unionByName(b).select("rec_table", "rec_id", "family")


def p1_clean_targets(spark: SparkSession, d: str) -> DataFrame:
    """Every target once, with its clean text and the blocks of it."""
    once = table(spark, d, "targets").groupBy("target_id").agg(F.max("text").alias("text"))
    return labeller.cleaned(once, "target_id", F.lit("text"), F.col("text"))


def p1_clean_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Every user and assistant content of the pairs, clean, once a pair and role."""
    m = table(spark, d, "pairs").select("pair_id", F.explode("messages").alias("m")).filter(F.col("m.role") != "system")
    return labeller.cleaned(m, "pair_id", F.col("m.role"), F.col("m.content")).dropDuplicates(["rec_id", "field"])


QUERIES |= {"p1_found": p1_found, "p1_clean_targets": p1_clean_targets, "p1_clean_pairs": p1_clean_pairs}


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlapping_ids(table(spark, d, "pairs"))


def p4_counts(spark: SparkSession, d: str) -> DataFrame:
    """The overlaps per split and source."""
    return overlap.overlap_counts(table(spark, d, "pairs"))


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every body with its class of equal texts and its number of overlaps."""
    return overlap.overlap_classes(table(spark, d, "pairs"))


QUERIES |= {"p4_found": p4_found, "p4_counts": p4_counts, "p4_classes": p4_classes}


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """How full each container is."""
    return packing.container_fill(packing.pack_documents(table(spark, d, "documents")))


QUERIES |= {"p8_packed": p8_packed, "p8_containers": p8_containers}
