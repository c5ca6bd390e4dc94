"""Registered queries on evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import evidence as V
from ..operators import lines as L
from ..operators import rows as R
from ..sources.tables import load, one_per_key
from .registry import query
from .row_queries import BASE, COMPACT, ROWS, STRIP
from .text_queries import CHUNKS


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return R.one_per_row(load(spark, d, "classification_rows"))


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(load(spark, d, "chunks"), "chunk_id")


@query(
    f"""WITH {ROWS}, {CHUNKS}, i AS (SELECT row_id, u.chunk_id, min(u.pos) AS ord FROM (SELECT row_id, unnest(list_transform(range(1, len(evidence_refs) + 1), lambda n: {{'pos': n - 1, 'chunk_id': evidence_refs[n].chunk_id}})) AS u FROM rows_once) WHERE u.chunk_id IS NOT NULL GROUP BY 1, 2)
 SELECT row_id, ord, 'ev_' || left(sha1(c.chunk_id || '||classification_row||' || coalesce(text, '')), 12) AS evidence_id, c.chunk_id, CASE WHEN source_method = 'ocr' THEN 0.68 ELSE 0.9 END::DOUBLE AS relevance_score FROM i JOIN chunks_once c ON i.chunk_id = c.chunk_id"""
)
def evidence_references(spark: SparkSession, d: str) -> DataFrame:
    wanted = _rows(spark, d).select("row_id", F.transform("evidence_refs", lambda r: r["chunk_id"]).alias("chunk_ids"))
    return V.references(wanted, _chunks(spark, d)).select("row_id", F.col("ord").cast("bigint").alias("ord"), "evidence_id", "chunk_id", "relevance_score")


@query(f"WITH {CHUNKS} SELECT chunk_id, CASE WHEN position % 3 = 0 THEN 'table_like' ELSE 'normal' END AS block_signal, coalesce(position % 3 = 1, false) AS signal_review FROM chunks_once")
def chunks_with_signals(spark: SparkSession, d: str) -> DataFrame:
    t = _chunks(spark, d)
    p = F.col("position") % 3
    signals = t.where(p < 2).select("chunk_id", F.lit(1).alias("ord"), F.when(p == 0, "table_like").otherwise("odd").alias("block_signal"))
    return V.with_signals(t, signals).select("chunk_id", "block_signal", "signal_review")


def _label(c: str) -> str:
    return f"regexp_replace(regexp_replace({COMPACT('coalesce(' + c + ', chr(32))')}, '[，,。；;：:、/\\\\|（）()〈〉<>《》\"''“”‘’\\[\\]【】.\\-—－_]+', '', 'g'), '[0-9]+', '', 'g')"


@query(
    f"""{BASE}, k AS (SELECT row_id, levels, list_filter(list_transform(levels, lambda x: {_label('x')}), lambda x: x <> '') AS labels, {_label('evidence_quote')} AS quote, {_label('description')} AS told, {_label("array_to_string(levels, '')")} AS whole,
 coalesce(regexp_matches({COMPACT('evidence_quote')}, '{V.GRADE_TERMS}') AND regexp_matches({COMPACT('evidence_quote')}, '{V.THRESHOLD_TERMS}'), false) AS general, regexp_matches(regexp_replace({COMPACT('levels[len(levels)]')}, '[“"'']', '', 'g'), '^[0-9]{{3,4}}其他$') AND len(list_filter(coalesce(data_range_examples, []), lambda x: NOT list_contains(['', '-', '—', '－', '一'], {COMPACT("coalesce(x, '')")}))) = 0 AS fallback FROM pathed), r AS (SELECT row_id, CASE WHEN told <> '' AND list_contains(labels, told) THEN 'repeats_label' WHEN quote <> '' AND (list_contains(labels, quote) OR len(labels) > 0 AND quote = whole) THEN 'label_only_quote' WHEN general THEN 'general_grading_rule' WHEN fallback THEN 'fallback_leaf' END AS reason FROM k)
 SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY 1"""
)
def description_policy(spark: SparkSession, d: str) -> DataFrame:
    return V.description_policy(_rows(spark, d)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""{BASE}, x AS (SELECT row_id, 'description' AS role, levels[len(levels)] AS text FROM pathed UNION ALL SELECT row_id, 'description', description_evidence_quote FROM pathed
 UNION ALL SELECT row_id, 'grading', coalesce(grade_evidence_quote, CASE WHEN regexp_matches(evidence_quote, '{X.GRADE_OR_RISK}') THEN evidence_quote END) FROM pathed
 UNION ALL SELECT row_id, CASE WHEN coalesce(regexp_matches(r.text, '{X.GRADE_OR_RISK}'), false) THEN 'excluded' ELSE 'description' END, r.text FROM (SELECT row_id, unnest(evidence_refs) AS r FROM pathed) y)
 SELECT row_id, role, min(text) AS text FROM x WHERE text IS NOT NULL AND text <> '' GROUP BY row_id, role, {COMPACT('text')}"""
)
def evidence_packs(spark: SparkSession, d: str) -> DataFrame:
    return V.evidence_pack(_rows(spark, d))


@query()
def segment_structure(spark: SparkSession, d: str) -> DataFrame:
    return V.segment_report(L.segments(_chunks(spark, d), 1200)).select("chunk_id", "segment", "content_type", "flattened_lines", "reviewable")


@query(
    f"""WITH {CHUNKS} SELECT content, count(*) AS n FROM (SELECT CASE WHEN (contains(c, '数据范围及示例') AND contains(c, '影响程度') AND contains(c, '数据级别')) OR (contains(t, '分类分级表') AND contains(t, '数据级别')) THEN 'classification_grading_table'
 WHEN (contains(c, '类') AND contains(c, '项') AND contains(c, '目')) OR contains(t, '分类目录') THEN 'classification_catalog' WHEN regexp_matches(t, '分类工作|分级工作|按照第[0-9]+章|参考附录|指南') THEN 'rule_guidance' ELSE 'unknown' END AS content FROM (SELECT t, {COMPACT('t')} AS c FROM (SELECT coalesce(text, '') AS t FROM chunks_once))) GROUP BY 1"""
)
def content_types(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).groupBy(V.content_type(F.col("text")).alias("content")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {CHUNKS}, s AS (SELECT chunk_id, list_filter(list_transform(string_split(coalesce(section_title, ''), '/'), lambda x: {STRIP('x')}), lambda x: x <> '') AS l FROM chunks_once), u AS (SELECT chunk_id, n, l[n] AS p FROM (SELECT chunk_id, l, unnest(range(1, len(l) + 1)) AS n FROM s)),
 k AS (SELECT chunk_id, n, CASE WHEN regexp_matches(p, '(?i)^附\\s*录\\s*[A-ZＡ-Ｚ]\\s*$') THEN 'appendix_heading' WHEN regexp_matches(p, '(?i)^(?:续\\s*表\\s*[A-ZＡ-Ｚ]\\s*\\.?\\s*[0-9]+|表\\s*[A-ZＡ-Ｚ]\\s*\\.?\\s*[0-9]+\\s*[（(]\\s*续\\s*[）)]).+') THEN 'continued_table_title' WHEN regexp_matches(p, '(?i)^表\\s*[A-ZＡ-Ｚ]\\s*\\.?\\s*[0-9]+(?:\\s*[（(]\\s*续\\s*[）)])?\\s+.+') THEN 'table_title' WHEN regexp_matches(p, '^[一-鿿]{{2,20}}分类\\s*$') THEN 'classification_title' END AS kind, p FROM u), t AS (SELECT chunk_id, n, kind, CASE WHEN kind = 'appendix_heading' THEN '附录 ' || upper(translate(regexp_extract(p, '(?i)^附\\s*录\\s*([A-ZＡ-Ｚ])', 1), '{X.FULL_WIDTH}', '{X.HALF_WIDTH}')) ELSE regexp_replace(p, '\\s+', ' ', 'g') END AS title FROM k)
 SELECT s.chunk_id, coalesce(arg_max(title, n) FILTER (WHERE kind = 'appendix_heading'), '') AS appendix_heading, coalesce(arg_max(title, n) FILTER (WHERE kind = 'classification_title'), '') AS classification_title, coalesce(arg_max(title, n) FILTER (WHERE kind IN ('table_title', 'continued_table_title')), '') AS table_title, '' AS hierarchy_header FROM s LEFT JOIN t ON s.chunk_id = t.chunk_id GROUP BY 1"""
)
def section_contexts(spark: SparkSession, d: str) -> DataFrame:
    c = V.structure_context(F.col("section_title"), F.lit(""))
    return _chunks(spark, d).select("chunk_id", c.alias("c")).select("chunk_id", "c.*")


@query(f"WITH {ROWS} SELECT row_id, length({COMPACT('coalesce(description, chr(32))')}) AS visible FROM rows_once")
def visible_lengths(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).select("row_id", F.coalesce(X.visible_length(F.col("description")), F.lit(0)).cast("bigint").alias("visible"))
