"""Registered queries on packed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.packed import split_values
from ..sources.tables import load


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    elements = load(spark, directory, "part_16")
    rows = load(spark, directory, "classification_rows")
    fields = elements.select(F.col("element_code").alias("record_id"), F.explode(F.array(F.struct(F.lit("allowed_values").alias("field"), F.array("allowed_values").alias("items")), F.struct(F.lit("value_domain_refs").alias("field"), F.col("value_domain_refs").alias("items")))).alias("x")).select("record_id", "x.field", "x.items")
    paths = rows.select(F.col("row_id").alias("record_id"), F.lit("path_levels").alias("field"), F.col("path_levels").alias("items"))
    return split_values(fields.union(paths), {"allowed_values": "list", "value_domain_refs": "references", "path_levels": "path"})


def queries() -> dict:
    return {"p3_found": p3_found}
