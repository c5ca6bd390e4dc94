"""Registered queries on runs: contexts, checkpoints, risks, extraction, upserts, late arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fuzzy
from ..functions import text as X
from ..operators import context as C
from ..operators import extract as E
from ..operators import lines as L
from ..operators import metrics as M
from ..operators import rows as R
from ..sources.tables import load, one_per_key
from .registry import query
from .row_queries import BASE, ROWS, STRIP
from .text_queries import CHUNKS, LINES


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(load(spark, d, "source_documents"), "doc_id")


@query()
def context_units(spark: SparkSession, d: str) -> DataFrame:
    return C.units(_documents(spark, d)).withColumn("path_hint", F.array_join("path_hint", " / "))


@query(f"WITH {CHUNKS}, {LINES} SELECT chunk_id, (line_no - 1) // 5 AS slot, min(line_no) AS line_start, max(line_no) AS line_end, string_agg(line, chr(10) ORDER BY line_no) AS text FROM lines WHERE {STRIP('line')} <> '' GROUP BY 1, 2")
def context_windows(spark: SparkSession, d: str) -> DataFrame:
    t = L.explode_lines(one_per_key(load(spark, d, "chunks"), "chunk_id"), "text", ("chunk_id",))
    return C.windows(t, "chunk_id").select("chunk_id", F.col("window").cast("bigint").alias("slot"), *(F.col(c).cast("bigint").alias(c) for c in ("line_start", "line_end")), "text")


@query()
def context_packs(spark: SparkSession, d: str) -> DataFrame:
    rows = R.one_per_row(load(spark, d, "classification_rows"))
    of = one_per_key(load(spark, d, "chunks"), "chunk_id").select("chunk_id", "doc_id")
    refs = rows.select("row_id", "path_levels", "data_range_examples", F.explode(F.array_distinct(F.transform("evidence_refs", lambda r: r["chunk_id"]))).alias("chunk_id")).join(of, "chunk_id").drop("chunk_id").distinct()
    return C.packs(refs, C.units(_documents(spark, d)))


_CHECK = "c AS (SELECT event_id % 10 AS batch_index, 10 AS batch_count, event_id AS line_no, event_id % 7 AS n_rows, (event_id % 1000) / 8.0 AS elapsed_seconds FROM events), l AS (SELECT * FROM c WHERE (batch_index, line_no) IN (SELECT (batch_index, max(line_no)) FROM c GROUP BY batch_index))"


@query(f"WITH {_CHECK} SELECT max(batch_count) AS batch_count, count(*) AS completed, sum(n_rows) AS total_rows, round(sum(elapsed_seconds), 3)::DOUBLE AS total_seconds, (SELECT string_agg(batch_index, ',' ORDER BY elapsed_seconds DESC, batch_index) FROM (SELECT * FROM l ORDER BY elapsed_seconds DESC, batch_index LIMIT 3)) AS slowest, count(*) = 10 AS appears_complete FROM l")
def checkpoint_metrics(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "events").select((F.col("event_id") % 10).cast("int").alias("batch_index"), F.lit(10).alias("batch_count"), F.col("event_id").alias("line_no"), (F.col("event_id") % 7).alias("n_rows"), (F.col("event_id") % 1000 / 8).alias("elapsed_seconds"))
    return M.checkpoint_metrics(t).withColumns({"batch_count": F.col("batch_count").cast("bigint"), "completed": F.col("completed").cast("bigint")})


@query(f"WITH {ROWS}, k AS (SELECT coalesce(evidence_status, 'none') AS expected, coalesce(support_level, 'none') AS actual FROM rows_once) SELECT expected, count(*) AS cases, count(*) FILTER (WHERE expected = actual) AS hits, count(*) FILTER (WHERE expected = actual) / count(*) AS recall FROM k GROUP BY 1")
def signal_confusion(spark: SparkSession, d: str) -> DataFrame:
    return M.confusion(R.one_per_row(load(spark, d, "classification_rows")), "evidence_status", "support_level")


@query(
    f"""WITH {ROWS}, r AS (SELECT row_id, ord, unnest([CASE WHEN len(coalesce(path_levels, [])) = 0 THEN 'no_path' END, CASE WHEN recommended_grade IS NULL THEN 'no_grade' END, CASE WHEN coalesce(confidence, 0) < 0.5 THEN 'unsure' END, CASE WHEN coalesce(description, '') = '' THEN 'no_description' END]) AS risk FROM rows_once)
 SELECT risk, count(*) AS n, min_by(row_id, ord) AS first FROM r WHERE risk IS NOT NULL GROUP BY 1"""
)
def risk_signals(spark: SparkSession, d: str) -> DataFrame:
    t = R.one_per_row(load(spark, d, "classification_rows"))
    rules = {"no_path": F.coalesce(F.size("path_levels"), F.lit(0)) <= 0, "no_grade": F.col("recommended_grade").isNull(), "unsure": F.coalesce("confidence", F.lit(0.0)) < 0.5, "no_description": F.coalesce("description", F.lit("")) == ""}
    return M.first_examples(t, rules, "row_id", "ord")


@query(f"WITH {ROWS}, x AS (SELECT coalesce(review_reason, '') AS review_reason, row_id, row_number() OVER (PARTITION BY coalesce(review_reason, '') ORDER BY row_id) AS k FROM rows_once), n AS (SELECT review_reason, count(*) AS n FROM x GROUP BY 1 ORDER BY n DESC, review_reason LIMIT 12) SELECT n.review_reason, n, string_agg(row_id, ',' ORDER BY row_id) AS examples FROM n JOIN x ON n.review_reason = x.review_reason WHERE k <= 5 GROUP BY 1, 2")
def failure_categories(spark: SparkSession, d: str) -> DataFrame:
    t = R.one_per_row(load(spark, d, "classification_rows")).select(F.coalesce("review_reason", F.lit("")).alias("review_reason"), "row_id")
    return M.top_categories(t, "review_reason", "row_id")


@query()
def extracted_table_rows(spark: SparkSession, d: str) -> DataFrame:
    """The extraction plan over the chunks: batches by budget, the rule-based extractor, typed rows."""
    t = one_per_key(load(spark, d, "chunks"), "chunk_id").select("doc_id", F.col("chunk_id").alias("segment_id"), F.coalesce("text", F.lit("")).alias("text"))
    batched = L.batches(t, "doc_id", ["segment_id"], F.length("text"), 7000)
    named = batched.select(F.concat_ws("#", "doc_id", "batch").alias("batch"), "segment_id", "text")
    return E.typed_rows(E.extracted(named)).withColumn("levels", F.array_join("levels", " / "))


@query(
    f"""{BASE}, g AS (SELECT array_to_string(reference_path, ' / ') AS path, min(match_id) AS id, count(DISTINCT match_id) AS n FROM rule_table_matches WHERE len(coalesce(reference_path, [])) > 0 GROUP BY 1),
 p AS (SELECT path, min(row_id) AS row_id FROM pathed GROUP BY 1)
 SELECT coalesce(p.path, g.path) AS path, row_id, CASE WHEN n = 1 THEN id END AS match_id, CASE WHEN p.path IS NULL THEN 'added' WHEN n = 1 THEN 'updated' WHEN n > 1 THEN 'ambiguous' ELSE 'kept' END AS outcome FROM p FULL JOIN g ON p.path = g.path"""
)
def library_upsert(spark: SparkSession, d: str) -> DataFrame:
    a = R.with_path(R.one_per_row(load(spark, d, "classification_rows"))).groupBy("path").agg(F.min("row_id").alias("row_id"))
    b = load(spark, d, "rule_table_matches").where("size(reference_path) > 0").groupBy(F.array_join("reference_path", " / ").alias("path")).agg(F.min("match_id").alias("id"), F.count_distinct("match_id").alias("n"))
    t = a.withColumn("here", F.lit(True)).join(b, "path", "full_outer")
    outcome = F.when(F.col("here").isNull(), "added").when(F.col("n") == 1, "updated").when(F.col("n") > 1, "ambiguous").otherwise("kept")
    return t.select("path", "row_id", F.when(F.col("n") == 1, F.col("id")).alias("match_id"), outcome.alias("outcome"))


@query(f"WITH {ROWS} SELECT date_trunc('day', arrived_at)::TIMESTAMP AS day, count(*) AS n, count(*) FILTER (WHERE arrived_at > extracted_at + INTERVAL 2 DAY) AS late FROM rows_once GROUP BY 1")
def arrivals_by_day(spark: SparkSession, d: str) -> DataFrame:
    t = R.one_per_row(load(spark, d, "classification_rows"))
    return t.groupBy(F.date_trunc("day", "arrived_at").cast("timestamp_ntz").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("arrived_at") > F.col("extracted_at") + F.expr("interval 2 days")).alias("late"))


@query()
def fuzzy_terms_in_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Each row's leaf held against the text of its own evidence chunks, loosely."""
    rows = R.with_path(R.one_per_row(load(spark, d, "classification_rows")))
    texts = one_per_key(load(spark, d, "chunks"), "chunk_id").select("chunk_id", "text")
    t = rows.select("row_id", F.try_element_at("levels", F.lit(-1)).alias("leaf"), F.explode(F.array_distinct(F.transform("evidence_refs", lambda r: r["chunk_id"]))).alias("chunk_id")).join(texts, "chunk_id")
    return t.select("row_id", "chunk_id", fuzzy.holds_loosely("text", "leaf").alias("held"), F.round(fuzzy.best_line_ratio("text", "leaf"), 4).alias("ratio"))


@query("SELECT event_id, event_id AS k, event_id % 2 = 0 AS ok FROM events")
def lenient_json(spark: SparkSession, d: str) -> DataFrame:
    """Objects read back from noisy text around them."""
    t = load(spark, d, "events").select("event_id", F.concat(F.lit("answer: ```json\n"), F.to_json(F.struct(F.col("event_id").alias("k"), (F.col("event_id") % 2 == 0).alias("ok"))), F.lit("\n``` end")).alias("raw"))
    o = F.from_json(X.json_object(F.col("raw")), "k bigint, ok boolean")
    return t.select("event_id", o["k"].alias("k"), o["ok"].alias("ok"))
