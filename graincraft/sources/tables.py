"""Readers for keyed parquet tables and the shared folder for materialised steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def one_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key. Rows delivered twice are equal, so any of them will do; rows with a null in their key stay one per content."""
    known = " and ".join(f"`{k}` is not null" for k in keys)
    return df.where(known).dropDuplicates(list(keys)).union(df.where(f"not ({known})").dropDuplicates())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share. Only a local session without one (as in tests) gets a temporary folder; a cluster has to name it."""
    at = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="graincraft_")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def materialise(df: DataFrame, label: str = "step") -> DataFrame:
    """Write df to the shared folder and read it back, so that its lineage ends there and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}_{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
