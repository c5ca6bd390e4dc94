"""Documents that arrive in a folder, chunked as they come; each file is taken once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as X


def arriving(spark: SparkSession, folder: str, files_at_once: int = 100) -> DataFrame:
    return spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_at_once).load(folder).select(F.col("value").alias("raw_text"), F.col("_metadata.file_path").alias("file_path"))


def signal_counts(documents: DataFrame) -> DataFrame:
    """Lines of each structure kind so far."""
    lines = documents.select(F.explode(X.lines(F.col("raw_text"))).alias("line"))
    return lines.groupBy(F.coalesce(X.structure_signal(F.col("line"))["kind"], F.lit("none")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def windowed_arrivals(rows: DataFrame, late: str = "2 days", size: str = "1 day") -> DataFrame:
    """Rows by arrival window and standard, with a watermark for late ones. rows: arrived_at, standard_name."""
    return rows.withWatermark("arrived_at", late).groupBy(F.window("arrived_at", size), "standard_name").agg(F.count(F.lit(1)).alias("n"))


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
