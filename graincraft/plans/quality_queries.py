"""Registered queries on answers, roles, gates, eval measures and suggestions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import answers as A
from ..operators import quality as Q
from ..operators import rows as R
from ..sources.tables import load, one_per_key
from .registry import query
from .row_queries import _LINKS, _VALIDATION, BASE, LEVELS, ROWS, STRIP, _checked, _current, _library, _rows
from .text_queries import CHUNKS, LINES


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(load(spark, d, "chunks"), "chunk_id")


@query(
    f"""WITH {ROWS}, {CHUNKS}, s AS (SELECT row_id, ord, list_filter(list_transform(coalesce(path_levels, []), lambda x: {STRIP("coalesce(x, '')")}), lambda x: x <> '') AS lv, {STRIP("coalesce(description, '')")} AS told, {STRIP("coalesce(description_source, '')")} AS src, {STRIP("coalesce(support_level, '')")} AS sup, CASE WHEN coalesce(recommended_grade, '') <> '' THEN {STRIP('recommended_grade')} END AS grade, needs_review, coalesce(confidence, 0.65) AS conf,
 len(list_intersect(list_distinct(list_transform(coalesce(evidence_refs, []), lambda r: r.chunk_id)), (SELECT list(chunk_id) FROM chunks_once))) AS refs FROM rows_once), r AS (SELECT *, CASE WHEN told IN ('', '{X.INSUFFICIENT}') THEN 'insufficient' WHEN src IN ('quoted', 'summarized', 'insufficient') THEN src ELSE 'summarized' END AS source, CASE WHEN sup IN ('explicit', 'structural', 'weak') THEN sup ELSE 'weak' END AS support, least(greatest(round(conf, 3), 0), 1) AS sure FROM s WHERE len(lv) > 0),
 f AS (SELECT *, array_to_string(lv, ' / ') || '|' || coalesce(grade, '') AS fp, row_number() OVER (PARTITION BY array_to_string(lv, ' / ') || '|' || coalesce(grade, '') ORDER BY (refs > 0) DESC, CASE source WHEN 'quoted' THEN 2 WHEN 'summarized' THEN 1 ELSE 0 END DESC, CASE support WHEN 'explicit' THEN 2 WHEN 'structural' THEN 1 ELSE 0 END DESC, sure DESC, row_id) AS k FROM r)
 SELECT 'row_' || left(sha1(fp), 12) AS row_id, array_to_string(lv, ' / ') AS path, grade AS recommended_grade, source AS description_source, support AS support_level, sure AS confidence, (source = 'insufficient' OR refs = 0 OR support <> 'explicit' OR grade IS NULL OR coalesce(needs_review, false)) AS needs_review FROM f WHERE k = 1"""
)
def rows_from_answers(spark: SparkSession, d: str) -> DataFrame:
    """Each row's fields as an extractor would answer them, read back, coerced and deduplicated."""
    t = _rows(spark, d)
    item = F.struct("path_levels", "recommended_grade", "description", "description_source", "support_level", F.transform("evidence_refs", lambda r: r["chunk_id"]).alias("evidence_chunk_ids"), "data_range_examples", "needs_review", "review_reason", "confidence")
    answers = t.select(F.col("row_id").alias("answer_id"), F.concat(F.lit("```json\n"), F.to_json(F.struct(F.array(item).alias("classification_rows"))), F.lit("\n```")).alias("answer"))
    return A.rows(answers, _chunks(spark, d)).select("row_id", F.array_join("path_levels", " / ").alias("path"), "recommended_grade", "description_source", "support_level", "confidence", "needs_review")


@query(
    f"""WITH {ROWS}, {LEVELS} SELECT row_id, CASE WHEN {STRIP("coalesce(row_role, '')")} IN ('structural_heading', 'definition_term', 'grading_criterion') THEN {STRIP('row_role')} WHEN regexp_matches(levels[1], '{Q.TERM_WORDS}') OR regexp_matches(coalesce(review_reason, ''), '{Q.TERM_REASONS}') THEN 'definition_term'
 WHEN coalesce(description_source = 'insufficient', false) AND coalesce(recommended_grade, '') = '' AND len(coalesce(data_range_examples, [])) = 0 AND (regexp_matches(coalesce(review_reason, ''), '{Q.TITLE_REASONS}') AND path IN (SELECT array_to_string(levels[1:n], ' / ') FROM (SELECT levels, unnest(range(1, len(levels))) AS n FROM pathed)) OR coalesce(support_level = 'structural', false) AND regexp_matches(coalesce(review_reason, ''), '{Q.TITLE_REASONS}|{Q.FRAGMENT_REASONS}')) THEN 'structural_heading' ELSE 'classification_detail' END AS role FROM pathed"""
)
def row_roles(spark: SparkSession, d: str) -> DataFrame:
    return Q.roles(_rows(spark, d)).select("row_id", "role")


@query(f"WITH {ROWS}, c AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE description_source = 'quoted') AS quoted, count(*) FILTER (WHERE description_source = 'insufficient') AS insufficient, 0::BIGINT AS prefilled FROM rows_once) SELECT *, array_to_string(list_filter([CASE WHEN n_rows < 3000 THEN 'classification_rows_below_min' END, CASE WHEN quoted < 2000 THEN 'quoted_descriptions_below_min' END, CASE WHEN insufficient > 100 THEN 'insufficient_descriptions_above_max' END, CASE WHEN prefilled < 1 THEN 'reference_prefilled_rows_below_min' END], lambda x: x IS NOT NULL), ',') AS reasons, 'degraded' AS status FROM c")
def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    return Q.gate(_rows(spark, d), 3000, 2000, 100, 1)


_REFS = "coalesce(evidence_refs, [])"
_REF_TEXT = f"array_to_string(list_transform({_REFS}, lambda r: coalesce(r.text, '')), chr(10))"
_LEVELS_IN = lambda names: f"len(list_filter(levels, lambda x: x IN ({', '.join(chr(39) + n + chr(39) for n in names)}))) > 0"
_TABLE = lambda c: f"(regexp_matches({c}, '附 ?录') AND contains({c}, '表'))"


@query(
    f"""{_VALIDATION}, {LEVELS.replace('pathed AS', 'pathed0 AS')}, e AS (SELECT *, array_to_string(levels, ' / ') AS p FROM levelled), m AS (SELECT count(*) AS rows, count(DISTINCT nullif(p, '')) AS unique_paths, count(*) FILTER (WHERE p <> '') - count(DISTINCT nullif(p, '')) AS duplicate_paths, count(*) FILTER (WHERE needs_review) AS needs_review,
 count(*) FILTER (WHERE {STRIP("coalesce(evidence_quote, '')")} = '') AS missing_quote, count(*) FILTER (WHERE len({_REFS}) = 0) AS missing_refs, count(*) FILTER (WHERE {_LEVELS_IN(Q.HEADER_LEVELS)}) AS header_as_path, count(*) FILTER (WHERE {_LEVELS_IN(Q.GENERIC_LEVELS)} OR len(list_filter(levels, lambda x: length(x) <= 1 AND NOT regexp_matches(x, '^[\\x00-\\x7F]*$'))) >= 2) AS generic_fragment,
 count(*) FILTER (WHERE len(list_filter({_REFS}, lambda r: coalesce(r.section_title, '') <> '' AND {_TABLE("coalesce(r.text, '')")} AND NOT {_TABLE("coalesce(r.section_title, '')")})) > 0) AS stale_section, count(*) FILTER (WHERE {_TABLE(_REF_TEXT)}) AS appendix_table, count(*) FILTER (WHERE contains({_REF_TEXT}, '（续）')) AS continued_table FROM e)
 SELECT metric, n FROM (UNPIVOT m ON COLUMNS(*) INTO NAME metric VALUE n) UNION ALL SELECT 'issues_' || severity, count(*) FROM issues GROUP BY 1"""
)
def eval_quality(spark: SparkSession, d: str) -> DataFrame:
    return Q.eval_metrics(_rows(spark, d), _checked(spark, d))


@query(
    f"""{_LINKS}, b AS (SELECT * FROM links WHERE rank = 1), u AS (SELECT reference_id, count(*) AS uses FROM b GROUP BY 1), t AS (SELECT b.reference_id, current_id, score, CASE WHEN uses >= 3 THEN 'broad' WHEN score >= 0.85 THEN 'strong' END AS tier FROM b JOIN u ON b.reference_id = u.reference_id),
 ml AS (SELECT match_id AS reference_id, list_filter(list_transform(coalesce(reference_path, []), lambda x: {STRIP("coalesce(x, '')")}), lambda x: x <> '') AS lv FROM (SELECT DISTINCT ON (match_id) * FROM rule_table_matches))
 SELECT reference_id, current_id, score, tier FROM t WHERE tier IS NOT NULL UNION ALL SELECT reference_id, NULL, NULL, CASE WHEN len(lv) = 0 OR len(lv) = 1 AND regexp_replace(lv[1], '\\s', '', 'g') IN ('预案', '方案', '资源管理服务') OR contains(array_to_string(lv, ''), '{Q.GARBLED}') OR regexp_matches(array_to_string(lv, ' / '), '[0-9]+(?:\\.[0-9]+)?\\s+[0-9]+') THEN 'low_quality' ELSE 'missing' END FROM ml WHERE reference_id NOT IN (SELECT reference_id FROM links WHERE rank <= 3)"""
)
def reference_suggestions(spark: SparkSession, d: str) -> DataFrame:
    library = one_per_key(load(spark, d, "rule_table_matches"), "match_id").select(F.col("match_id").alias("reference_id"), X.clean_levels(F.col("reference_path")).alias("levels"))
    return Q.suggestions(R.term_links(_current(spark, d), _library(spark, d), told=False), library)


@query(f"WITH {CHUNKS}, {LINES}, h AS (SELECT chunk_id, line_no, regexp_replace(regexp_replace(regexp_replace({STRIP('line')}, '^#{{1,6}}\\s+', ''), '^[一二三四五六七八九十]+[、.．]\\s*', ''), '^[0-9]+(?:\\.[0-9]+)*[、.．]\\s*', '') AS title FROM lines WHERE regexp_matches({STRIP('line')}, '^#{{1,6}}\\s+\\S+|^[一二三四五六七八九十]+[、.．]\\s*\\S+|^[0-9]+(?:\\.[0-9]+)*[、.．]\\s*\\S+')) SELECT chunk_id, line_no, {STRIP('title')} AS title FROM h")
def marked_headings(spark: SparkSession, d: str) -> DataFrame:
    """Lines that are headings by their marks alone, with their titles."""
    from ..operators import lines as L

    t = L.explode_lines(_chunks(spark, d), "text", ("chunk_id",))
    return t.where(X.is_heading(F.col("line")) & ~F.coalesce(X.structure_signal(F.col("line"))["kind"].isin(*X.HEADING_KINDS), F.lit(False))).select("chunk_id", F.col("line_no").cast("bigint").alias("line_no"), X.heading_title(F.col("line")).alias("title"))
