"""The registered queries of this subpackage: each runs its operator over the whole tables of a directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import load, one_per_key
from . import chunking, formatting_copies, linkage, lookalikes, mixing, scan_noise, sentences, tokenize

#: Stands between the levels of a path where they are handled as one text; it can't stand in a level that is text.
BETWEEN = "\x1f"


def _readings(spark: SparkSession, directory: str) -> DataFrame:
    """record_id, field and text of every field that problem 2 names, the levels of a path joined."""
    rows = load(spark, directory, "classification_rows")
    fields = rows.select("row_id", F.explode(F.array(F.struct(F.lit("path_levels").alias("field"), F.array_join("path_levels", BETWEEN).alias("text")), F.struct(F.lit("evidence_quote").alias("field"), F.col("evidence_quote").alias("text")))).alias("x"))
    fields = fields.select(F.col("row_id").alias("record_id"), "x.field", "x.text")
    return fields.union(load(spark, directory, "chunks").select(F.col("chunk_id").alias("record_id"), F.lit("text").alias("field"), "text"))


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    return scan_noise.defects(load(spark, directory, "document_pages"))


def p1_repaired(spark: SparkSession, directory: str) -> DataFrame:
    return scan_noise.repaired(load(spark, directory, "document_pages"))


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    texts = _readings(spark, directory)
    counts = lookalikes.vocabulary(texts)
    forms = lookalikes.canonical(texts.where(lookalikes.suspicious(F.col("text"))), "text", counts, keep=("record_id", "field"))
    return forms.where("text <> canonical").select("record_id", "field").distinct()


def p2_canonical(spark: SparkSession, directory: str) -> DataFrame:
    texts = _readings(spark, directory)
    counts = lookalikes.vocabulary(texts)
    changed = lookalikes.canonical(texts.where(lookalikes.suspicious(F.col("text"))), "text", counts, keep=("record_id", "field"))
    plain = texts.where(~F.coalesce(lookalikes.suspicious(F.col("text")), F.lit(False)))
    forms = plain.select("record_id", "field", F.col("text").alias("canonical")).union(changed.select("record_id", "field", "canonical"))
    return forms.groupBy("record_id", "field").agg(F.any_value("canonical").alias("canonical"))


def p4_links(spark: SparkSession, directory: str) -> DataFrame:
    return linkage.links(load(spark, directory, "classification_rows"), load(spark, directory, "rule_table_matches"))


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    return p4_links(spark, directory).select("row_id", "match_id")


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    return formatting_copies.copies(load(spark, directory, "classification_rows"))


def p5_collapsed(spark: SparkSession, directory: str) -> DataFrame:
    return formatting_copies.collapsed(load(spark, directory, "classification_rows"))


def p6_pieces(spark: SparkSession, directory: str) -> DataFrame:
    def cut(table: str, key: str, text: str, limit: int, overlap: int) -> DataFrame:
        oversized = load(spark, directory, table).select(key, text).where(F.length(text) > limit)
        return chunking.chunked(one_per_key(oversized, key), key, text, limit, overlap)

    return cut("source_documents", "doc_id", "raw_text", 5000, 200).union(cut("chunks", "chunk_id", "text", 1200, 120))


def p6_found(spark: SparkSession, directory: str) -> DataFrame:
    return p6_pieces(spark, directory).select("item_id", "field").distinct()


def p7_ids(spark: SparkSession, directory: str) -> DataFrame:
    return tokenize.encode_column(load(spark, directory, "documents"))


def p8_corpus(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.mixed(load(spark, directory, "documents"), load(spark, directory, "mix_targets"))[0]


def p8_report(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.mixed(load(spark, directory, "documents"), load(spark, directory, "mix_targets"))[1]


def p9_found(spark: SparkSession, directory: str) -> DataFrame:
    return sentences.sentence_spans(load(spark, directory, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"p6_found": "SELECT DISTINCT doc_id AS item_id, 'raw_text' AS field FROM source_documents WHERE length(raw_text) > 5000 UNION ALL SELECT DISTINCT chunk_id, 'text' FROM chunks WHERE length(text) > 1200"}
