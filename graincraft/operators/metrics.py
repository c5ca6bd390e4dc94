"""Measures of a run: checkpoints, confusion of signals, risks with their first example, categories with examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(records: DataFrame, key: str = "batch_index", order: str = "line_no") -> DataFrame:
    """The last record of each batch."""
    last = records.groupBy(key).agg(F.max(order).alias(order))
    return records.join(last, [key, order], "left_semi")


def checkpoint_metrics(records: DataFrame) -> DataFrame:
    """One line: batches, completed ones, rows, seconds, the slowest, and whether 1..n or 0..n-1 are all there."""
    t = latest(records.where("batch_index is not null"))
    seconds = F.coalesce("elapsed_seconds", F.lit(0.0))
    one = t.agg(F.max(F.coalesce("batch_count", F.lit(0))).alias("batch_count"), F.count(F.lit(1)).alias("completed"), F.count_if((F.col("batch_index") >= 1) & (F.col("batch_index") <= F.col("batch_count"))).alias("from_one"), F.count_if((F.col("batch_index") >= 0) & (F.col("batch_index") < F.col("batch_count"))).alias("from_zero"), F.sum(F.coalesce("n_rows", F.lit(0))).alias("total_rows"), F.round(F.sum(seconds), 3).alias("total_seconds"))
    slowest = [str(r["batch_index"]) for r in t.orderBy(seconds.desc(), "batch_index").select("batch_index").limit(3).collect()]
    n = F.col("batch_count")
    # of a run whose records agree on the number of batches, all are there if as many different ones lie within 1..n, or 0..n-1
    ok = (n > 0) & ((F.col("from_one") == n) | (F.col("from_zero") == n))
    return one.select("batch_count", F.col("completed").cast("int").alias("completed"), "total_rows", "total_seconds", F.lit(",".join(slowest)).alias("slowest"), F.coalesce(ok, F.lit(False)).alias("appears_complete"))


def confusion(cases: DataFrame, expected: str, actual: str) -> DataFrame:
    """expected, cases, hits and recall of each kind; null means no kind."""
    e, a = F.coalesce(expected, F.lit("none")), F.coalesce(actual, F.lit("none"))
    return cases.groupBy(e.alias("expected")).agg(F.count(F.lit(1)).alias("cases"), F.count_if(e == a).alias("hits")).withColumn("recall", F.col("hits") / F.col("cases"))


def first_examples(df: DataFrame, rules: dict[str, Column], key: str, order: str) -> DataFrame:
    """risk, n and the first key for each rule that some row breaks."""
    hits = F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())), lambda x: x.isNotNull())
    t = df.select(key, order, F.explode(hits).alias("risk"))
    return t.groupBy("risk").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(order, key))[key].alias("first"))


def top_categories(df: DataFrame, category: str, key: str, examples: int = 5, top: int = 12) -> DataFrame:
    """The commonest categories, a report, with the first few keys of each."""
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), category).limit(top)
    w = Window.partitionBy(category).orderBy(key)
    some = df.withColumn("k", F.row_number().over(w)).where(F.col("k") <= examples).groupBy(category).agg(F.array_join(F.array_sort(F.collect_list(key)), ",").alias("examples"))
    return counts.join(some, category, "left")
