"""Registered queries on classification rows and the tables they meet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.terms import row_terms
from ..operators import grounding as G
from ..operators import rows as R
from ..sources.tables import load, one_per_key
from .registry import SQL, query

#: SQL pieces. WS: the white space of functions.text, for a dialect whose own class is ASCII only.
WS = r"[\s\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1c}-\x{1f}\x{85}]"
STRIP = lambda c: f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"
COMPACT = lambda c: f"regexp_replace({c}, '{WS}+', '', 'g')"
ROWS = "rows_once AS (SELECT * FROM classification_rows WHERE ord IN (SELECT min(ord) FROM classification_rows GROUP BY row_id))"
LEVELS = f"levelled AS (SELECT *, list_filter(list_transform(coalesce(path_levels, []), lambda x: {STRIP('coalesce(x, chr(0))')}), lambda x: x <> '' AND x <> chr(0)) AS levels FROM rows_once), pathed AS (SELECT *, array_to_string(levels, ' / ') AS path FROM levelled WHERE len(levels) > 0)"
BASE = f"WITH {ROWS}, {LEVELS}"


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return R.one_per_row(load(spark, d, "classification_rows"))


@query(f"{BASE} SELECT row_id, path, ord FROM pathed WHERE ord IN (SELECT min(ord) FROM pathed GROUP BY path, recommended_grade)")
def rows_first_wins(spark: SparkSession, d: str) -> DataFrame:
    return R.first_wins(R.with_path(_rows(spark, d)), "path", "recommended_grade").select("row_id", "path", "ord")


_RANK = "(CASE WHEN len(coalesce(evidence_refs, [])) > 0 THEN 1 ELSE 0 END) DESC, CASE description_source WHEN 'quoted' THEN 3 WHEN 'summarized' THEN 2 WHEN 'insufficient' THEN 1 ELSE 0 END DESC, CASE support_level WHEN 'explicit' THEN 3 WHEN 'structural' THEN 2 WHEN 'weak' THEN 1 ELSE 0 END DESC, coalesce(confidence, 0) DESC, ord"


@query(f"{BASE} SELECT row_id, path FROM (SELECT *, row_number() OVER (PARTITION BY path, recommended_grade ORDER BY {_RANK}) AS rn FROM pathed) WHERE rn = 1")
def rows_best_of_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return R.best_of(R.with_path(_rows(spark, d)), "path", "recommended_grade").select("row_id", "path")


@query(
    f"""{BASE}, d AS (SELECT path, description, min(ord) AS o FROM pathed WHERE description IS NOT NULL AND description <> '' GROUP BY 1, 2),
 dd AS (SELECT path, string_agg(description, '；' ORDER BY o, description) AS description FROM d GROUP BY 1),
 e AS (SELECT path, ex, min(ord) AS o FROM (SELECT path, ord, unnest(data_range_examples) AS ex FROM pathed) GROUP BY 1, 2),
 ee AS (SELECT path, string_agg(ex, '；' ORDER BY o, ex) AS examples FROM e GROUP BY 1),
 b AS (SELECT path, count(*) AS n_rows, max(TRY_CAST(nullif(regexp_extract(coalesce(recommended_grade, ''), '([0-9]+)\\s*级', 1), '') AS INTEGER)) AS grade, min(confidence) AS confidence, bool_or(needs_review) AS needs_review FROM pathed GROUP BY 1)
 SELECT b.path, n_rows, grade, confidence, needs_review, description, examples FROM b LEFT JOIN dd ON b.path = dd.path LEFT JOIN ee ON b.path = ee.path"""
)
def rows_merged_by_path(spark: SparkSession, d: str) -> DataFrame:
    return R.merged(_rows(spark, d)).select("path", "n_rows", "grade", "confidence", "needs_review", "description", "examples")


@query(f"{BASE} SELECT row_id, path FROM pathed p WHERE path IN (SELECT array_to_string(levels[1:n], ' / ') FROM (SELECT levels, unnest(range(1, len(levels))) AS n FROM pathed))")
def rows_parent_titles(spark: SparkSession, d: str) -> DataFrame:
    return R.strict_prefix_of_other(_rows(spark, d)).select("row_id", "path")


_NODES = f"{BASE}, x AS (SELECT levels[1:n] AS p, n, n = len(levels) AS leaf, confidence, needs_review, status, ord, recommended_grade FROM (SELECT *, unnest(range(1, len(levels) + 1)) AS n FROM pathed)), nodes AS (SELECT array_to_string(p, ' / ') AS path, max(n) AS level, any_value(p) AS p, count(*) AS n_rows, min(CASE WHEN confidence > 0 THEN confidence END) AS confidence, bool_or(coalesce(needs_review, false)) AS needs_review, bool_and(coalesce(status = 'supported', false)) AS ok, max_by(recommended_grade, CASE WHEN leaf THEN ord END) AS grade FROM x GROUP BY 1)"


@query(f"{_NODES} SELECT 'node_' || left(sha1(path), 12) AS node_id, CASE WHEN level > 1 THEN 'node_' || left(sha1(array_to_string(p[1:level - 1], ' / ')), 12) END AS parent_id, path, level, n_rows, confidence, needs_review, CASE WHEN ok THEN 'supported' ELSE 'proposed' END AS status FROM nodes")
def tree_nodes(spark: SparkSession, d: str) -> DataFrame:
    return R.tree(_rows(spark, d)).select("node_id", "parent_id", "path", F.col("level").cast("bigint").alias("level"), "n_rows", "confidence", "needs_review", "status")


@query(f"{BASE} SELECT max(len(levels)) AS depth, count(*) AS n_rows, count(DISTINCT path) AS n_paths FROM pathed")
def tree_depth(spark: SparkSession, d: str) -> DataFrame:
    return R.with_path(_rows(spark, d)).agg(F.max(F.size("levels")).cast("bigint").alias("depth"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("path").alias("n_paths"))


def _current(spark: SparkSession, d: str) -> DataFrame:
    t = _rows(spark, d)
    return t.select(F.col("row_id").alias("current_id"), row_terms(F.col("path_levels"), F.col("data_range_examples"), F.col("description"), F.col("description_source")).alias("terms"))


def _library(spark: SparkSession, d: str) -> DataFrame:
    t = one_per_key(load(spark, d, "rule_table_matches"), "match_id")
    return t.select(F.col("match_id").alias("reference_id"), row_terms(F.col("reference_path"), F.col("shared_terms"), F.lit(""), F.lit("")).alias("terms"))


_BARE = lambda c: f"regexp_replace(regexp_replace({COMPACT(c)}, '^[A-Za-z]?[）)、.．]?', ''), '^[0-9]+(?:[.．][0-9]+)*', '')"
_STOPS = "[" + ", ".join(f"'{x}'" for x in X.STOP_TERMS) + "]"
_BREAKS = X.TERM_BREAKS.replace("'", "''")
_GOOD = lambda c: f"list_filter({c}, lambda y: length(y) >= 2 AND NOT list_contains({_STOPS}, y))"


def _terms(c: str) -> str:
    """SQL: the terms of a text, as functions.text.terms has them."""
    base = _BARE(f"coalesce({c}, '')")
    parts = f"list_transform(regexp_split_to_array({base}, '{_BREAKS}'), lambda z: {_BARE('z')})"
    return f"CASE WHEN {base} IN ('', '{X.INSUFFICIENT}') THEN [] ELSE {_GOOD(f'list_concat({parts}, CASE WHEN length({base}) <= 12 THEN [{base}] ELSE [] END)')} END"


def _row_terms(levels: str, examples: str, told: str = "[]") -> str:
    each = f"flatten(list_transform(list_concat(coalesce({levels}, []), coalesce({examples}, [])), lambda v: {_terms('v')}))"
    return f"list_distinct(list_concat({each}, {told}))"


_CUR = f"cur AS (SELECT row_id AS current_id, {_row_terms('path_levels', 'data_range_examples', 'CASE WHEN coalesce(description_source, chr(32)) <> ' + chr(39) + 'insufficient' + chr(39) + ' THEN ' + _terms('description') + ' ELSE [] END')} AS t FROM rows_once)"
_LIB = f"lib AS (SELECT match_id AS reference_id, {_row_terms('reference_path', 'shared_terms')} AS t FROM (SELECT DISTINCT ON (match_id) * FROM rule_table_matches))"
_LINKS = f"""WITH {ROWS}, {_CUR}, {_LIB}, ct AS (SELECT current_id, len(t) AS n1, unnest(t) AS term FROM cur), lt AS (SELECT reference_id, len(t) AS n2, unnest(t) AS term FROM lib),
 pr AS (SELECT current_id, reference_id, count(*) AS s, any_value(n1) AS n1, any_value(n2) AS n2, list(ct.term) AS terms FROM ct JOIN lt ON ct.term = lt.term GROUP BY 1, 2),
 sc AS (SELECT current_id, reference_id, round(0.75 * s / least(n1, n2) + 0.25 * s / (n1 + n2 - s), 4) AS score, array_to_string(list_transform(list_sort(list_transform(terms, lambda x: {{'n': -length(x), 't': x}}))[1:8], lambda e: e.t), '|') AS shared FROM pr),
 links AS (SELECT current_id, reference_id, score, shared, row_number() OVER (PARTITION BY current_id ORDER BY score DESC, reference_id) AS rank FROM sc WHERE score >= 0.5)"""


@query(f"{_LINKS} SELECT current_id, reference_id, score, shared, rank FROM links WHERE rank <= 3")
def term_links_topk(spark: SparkSession, d: str) -> DataFrame:
    return R.term_links(_current(spark, d), _library(spark, d)).withColumn("rank", F.col("rank").cast("bigint"))


@query(f"{_LINKS}, b AS (SELECT * FROM links WHERE rank = 1), u AS (SELECT reference_id, count(*) AS uses FROM b GROUP BY 1) SELECT current_id, b.reference_id, score, uses, CASE WHEN uses >= 3 THEN 'broad' WHEN score >= 0.85 THEN 'strong' ELSE 'other' END AS tier FROM b JOIN u ON b.reference_id = u.reference_id")
def match_tiers(spark: SparkSession, d: str) -> DataFrame:
    return R.tiers(R.term_links(_current(spark, d), _library(spark, d), top=1, told=False))


@query(f"{_LINKS} SELECT reference_id FROM lib WHERE reference_id NOT IN (SELECT reference_id FROM links WHERE rank <= 3)")
def missing_references(spark: SparkSession, d: str) -> DataFrame:
    return R.unlinked(_library(spark, d), R.linked(_current(spark, d), _library(spark, d))).select("reference_id")


@query(f"{_LINKS}, b AS (SELECT current_id, max(score) AS best FROM links WHERE rank <= 3 GROUP BY 1) SELECT current_id, best FROM b ORDER BY best DESC, current_id LIMIT 20")
def best_links(spark: SparkSession, d: str) -> DataFrame:
    """The twenty rows with the best links, a report."""
    return R.best_linked(R.term_links(_current(spark, d), _library(spark, d), top=1, told=False), 20)


def _leveled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    a = R.with_path(_rows(spark, d)).select(F.col("row_id").alias("id"), "levels")
    b = one_per_key(load(spark, d, "rule_table_matches"), "match_id").select(F.col("match_id").alias("id"), X.clean_levels(F.col("reference_path")).alias("levels")).where("size(levels) > 0")
    return a, b


_KEY = lambda c: f"regexp_replace(regexp_replace(regexp_replace({COMPACT('translate(' + c + ', chr(65294) || chr(65288) || chr(65289), chr(46) || chr(40) || chr(41))')}, '^[A-Za-z]?[、.)）.．]+', ''), '^[0-9]+(?:[.．][0-9]+)*', ''), '^[、.)）.．:：\\-]+|[、.)）.．:：\\-]+$', '', 'g')"
_KEYED = lambda name, source, key, levels: f"{name} AS (SELECT {key} AS id, list_filter(list_transform({levels}, lambda x: {_KEY('x')}), lambda x: x <> '') AS k, replace(regexp_extract(array_to_string({levels}, ' '), '[0-9]+(?:[.．][0-9]+)+'), '．', '.') AS code FROM {source})"


@query(
    f"""{BASE}, m AS (SELECT DISTINCT ON (match_id) * FROM rule_table_matches), ml AS (SELECT match_id, list_filter(list_transform(coalesce(reference_path, []), lambda x: {STRIP("coalesce(x, '')")}), lambda x: x <> '') AS levels FROM m),
 {_KEYED('a', 'pathed', 'row_id', 'levels')}, {_KEYED('b', 'ml', 'match_id', 'levels')}, p AS (SELECT a.id AS current_id, b.id AS reference_id, CASE WHEN a.k = b.k THEN 1.0
 WHEN a.code <> '' AND a.code = b.code AND a.k[len(a.k)] = b.k[len(b.k)] THEN 0.97 WHEN len(a.k) > 1 AND len(b.k) > 1 AND a.k[len(a.k) - 1:] = b.k[len(b.k) - 1:] AND (ends_with(array_to_string(a.k, '/'), '/' || array_to_string(b.k, '/')) OR ends_with(array_to_string(b.k, '/'), '/' || array_to_string(a.k, '/'))) THEN 0.94 END::DOUBLE AS score FROM a JOIN b ON a.k[len(a.k)] = b.k[len(b.k)] WHERE len(a.k) > 0),
 r AS (SELECT *, row_number() OVER (PARTITION BY current_id ORDER BY score DESC, reference_id) AS n FROM p WHERE score IS NOT NULL)
 SELECT current_id, reference_id, CASE score WHEN 1.0 THEN 'exact_path' WHEN 0.97 THEN 'code_and_leaf' ELSE 'parent_and_leaf' END AS match_type, score FROM r WHERE n = 1"""
)
def strong_match_cascade(spark: SparkSession, d: str) -> DataFrame:
    return R.cascade(*_leveled(spark, d))


_GOLD = lambda c: f"regexp_replace({COMPACT('replace(replace(' + c + ', chr(65288), chr(40)), chr(65289), chr(41))')}, '^[A-Z][、.]?', '')"
_GOLD_LEVEL = lambda c: f"CASE WHEN regexp_matches({_GOLD(c)}, '^[0-9]+(?:周岁|岁)') THEN {_GOLD(c)} ELSE regexp_replace({_GOLD(c)}, '^[0-9]+[、.]?', '') END"
_COMPARED = f"""{BASE}, g AS (SELECT ord, status, array_to_string(list_filter(list_transform(levels, lambda x: {_GOLD_LEVEL('x')}), lambda x: x <> ''), '/') AS path_key, {COMPACT("replace(coalesce(recommended_grade, ''), '一般数据', '')")} AS grade FROM pathed),
 a AS (SELECT path_key, arg_max(grade, ord) AS generated_grade FROM g WHERE status = 'proposed' AND path_key <> '' GROUP BY 1), b AS (SELECT path_key, arg_max(grade, ord) AS gold_grade FROM g WHERE status = 'accepted' AND path_key <> '' GROUP BY 1),
 cmp AS (SELECT coalesce(a.path_key, b.path_key) AS path_key, CASE WHEN a.path_key IS NULL THEN 'missing' WHEN b.path_key IS NULL THEN 'extra' ELSE 'matched' END AS outcome, generated_grade, gold_grade, CASE WHEN a.path_key IS NOT NULL AND b.path_key IS NOT NULL THEN generated_grade = gold_grade END AS same_grade FROM a FULL JOIN b ON a.path_key = b.path_key)"""


@query(f"{_COMPARED} SELECT * FROM cmp")
def gold_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Proposed rows against the accepted ones, by path and grade."""
    t = R.with_path(_rows(spark, d))
    return R.compared(t.where("status = 'proposed'"), t.where("status = 'accepted'"))


@query(
    f"""{_COMPARED}, n AS (SELECT count(*) FILTER (WHERE outcome = 'matched') AS m, count(*) FILTER (WHERE outcome = 'missing') AS x, count(*) FILTER (WHERE outcome = 'extra') AS e, count(*) FILTER (WHERE same_grade) AS y, count(*) FILTER (WHERE NOT same_grade) AS z FROM cmp)
 SELECT m + e AS generated_rows, m + x AS reference_rows, m AS matched_paths, round(m * 100 / greatest(m + x, 1), 2)::DOUBLE AS coverage_pct, x AS missing_paths, e AS extra_paths, y AS grade_matches, z AS grade_mismatches, round(y * 100 / greatest(m, 1), 2)::DOUBLE AS grade_accuracy_pct FROM n"""
)
def gold_comparison_summary(spark: SparkSession, d: str) -> DataFrame:
    return R.comparison_summary(gold_comparison(spark, d))


@query(
    """WITH n AS (SELECT element_code, min(element_name) AS element_name FROM part_16 WHERE element_code IS NOT NULL GROUP BY 1),
 r AS (SELECT DISTINCT row_id, unnest(data_element_refs) AS element_code FROM classification_rows)
 SELECT row_id, r.element_code, element_name, n.element_code IS NOT NULL AS found FROM r LEFT JOIN n ON r.element_code = n.element_code"""
)
def element_mapping(spark: SparkSession, d: str) -> DataFrame:
    return R.named_elements(_rows(spark, d), load(spark, d, "part_16"))


@query(
    f"""{BASE}, c AS (SELECT row_id, path, levels, recommended_grade, list_distinct(list_filter(list_transform(coalesce(evidence_refs, []), lambda x: x.chunk_id), lambda x: x IS NOT NULL)) AS chunks FROM pathed),
 l AS (SELECT row_id AS receiver, chunk, array_to_string(levels[n:], ' / ') AS path FROM (SELECT *, unnest(range(2, len(levels) + 1)) AS n FROM (SELECT *, unnest(chunks) AS chunk FROM c WHERE recommended_grade IS NULL))),
 s AS (SELECT row_id AS donor, path, unnest(chunks) AS chunk FROM c WHERE recommended_grade IS NOT NULL),
 p AS (SELECT DISTINCT donor, receiver FROM s JOIN l ON s.path = l.path AND s.chunk = l.chunk)
 SELECT min(receiver) AS receiver, donor FROM p GROUP BY donor HAVING count(*) = 1"""
)
def suffix_grade_donations(spark: SparkSession, d: str) -> DataFrame:
    return R.donations(_rows(spark, d))


_PARTS = lambda c: f"list_filter(list_transform(string_split(coalesce({c}, ''), '；'), lambda x: {STRIP('x')}), lambda x: x <> '')"
_TEXTS = f"list_transform(coalesce(evidence_refs, []), lambda r: {COMPACT(chr(99) + 'oalesce(r.text, ' + chr(39) * 2 + ')')})"


@query(f"WITH {ROWS}, q AS (SELECT row_id, {_PARTS('evidence_quote')} AS p, {_TEXTS} AS t FROM rows_once) SELECT row_id, len(p) AS parts, len(list_filter(p, lambda y: len(list_filter(t, lambda z: contains(z, {COMPACT('y')}))) = 0)) = 0 AS grounded FROM q")
def quote_grounding(spark: SparkSession, d: str) -> DataFrame:
    return R.grounded(_rows(spark, d)).select("row_id", F.col("parts").cast("bigint").alias("parts"), "grounded")


def _checked(spark: SparkSession, d: str) -> DataFrame:
    texts = G.corpus(one_per_key(load(spark, d, "source_documents"), "doc_id"), one_per_key(load(spark, d, "document_pages"), "doc_id", "page_number"))
    return G.issues(_rows(spark, d), texts)


_QUOTED = lambda c, where: f"len(list_filter({_PARTS(c)}, lambda p: NOT contains({where}, {COMPACT('p')}))) > 0"
_NO = lambda c: f"coalesce({c}, '') = ''"
_HAS = lambda text, part: f"(contains(coalesce({text}, ''), {part}) OR contains({COMPACT(f'coalesce({text}, chr(32))')}, {COMPACT(part)}))"
_MARKLESS = lambda c: f"translate({COMPACT(c)}, '{G.LEVEL_MARKS}', '')"
_TELL = lambda rule, extra="": f"{{'rule': '{rule}', 'problem': '{G.PROBLEMS[rule][2]}'{extra}}}"
_KINDS = "(VALUES " + ", ".join(f"('{r}', '{k}', '{s}')" for r, (k, s, _) in G.PROBLEMS.items()) + ") AS kinds(rule, issue_type, severity)"
_VALIDATION = f"""WITH {ROWS}, corp AS (SELECT string_agg({COMPACT('t')}, '') AS whole FROM (SELECT raw_text AS t FROM (SELECT DISTINCT ON (doc_id) raw_text FROM source_documents) UNION ALL SELECT text FROM (SELECT DISTINCT ON (doc_id, page_number) text FROM document_pages)) WHERE t IS NOT NULL), corpus AS (SELECT whole, translate(whole, '{G.LEVEL_MARKS}', '') AS bare FROM corp),
 b AS (SELECT *, list_filter(coalesce(path_levels, []), lambda x: x IS NOT NULL) AS lv, {_TEXTS} AS texts, coalesce(support_level, 'None') AS sup, coalesce(description_source, 'None') AS src FROM rows_once), t AS (SELECT *, array_to_string(lv, ' / ') AS path, array_to_string(texts, '') AS alltext, coalesce(evidence_status = 'reference_only' AND inclusion_status = 'review_candidate', false) AS skipped FROM b), tt AS (SELECT *, CASE WHEN path = '' THEN row_id ELSE path END AS target FROM t),
 lev AS (SELECT DISTINCT level FROM (SELECT unnest(lv) AS level FROM t WHERE NOT skipped) WHERE level <> ''), absent AS (SELECT level FROM lev, corpus WHERE CASE WHEN {_MARKLESS('level')} = '' THEN NOT contains(whole, {COMPACT('level')}) ELSE NOT contains(bare, {_MARKLESS('level')}) END),
 f AS (SELECT row_id, target, unnest([CASE WHEN len(coalesce(evidence_refs, [])) = 0 THEN {_TELL('no evidence')} END, CASE WHEN {_NO('evidence_quote')} THEN {_TELL('no quote')} END,
 CASE WHEN {_QUOTED('evidence_quote', "CASE WHEN alltext <> '' THEN alltext ELSE whole END")} THEN {_TELL('quote not in evidence')} END,
 CASE WHEN len(list_filter({_PARTS('grade_evidence_quote')}, lambda p: len(list_filter(texts, lambda z: contains(z, {COMPACT('p')}))) = 0)) > 0 THEN {_TELL('grade quote not in evidence')} END,
 CASE WHEN sup NOT IN ('explicit', 'structural', 'weak') THEN {_TELL('support level', ' || sup')} END,
 CASE WHEN src NOT IN ('quoted', 'summarized', 'insufficient', 'reference_library', 'classification_standard_excel') THEN {_TELL('description source', ' || src')} END,
 CASE WHEN src = 'insufficient' AND coalesce(description, '') <> '{X.INSUFFICIENT}' THEN {_TELL('insufficient wording')} END,
 CASE WHEN src NOT IN ('insufficient', 'reference_library', 'classification_standard_excel') AND {_NO('description_evidence_quote')} AND ({_NO('description')} OR NOT {_HAS('evidence_quote', 'description')}) THEN {_TELL('description without quote')} END,
 CASE WHEN {_QUOTED('description_evidence_quote', "CASE WHEN alltext <> '' THEN alltext ELSE whole END")} THEN {_TELL('description quote not in evidence')} END,
 CASE WHEN NOT {_NO('recommended_grade')} AND NOT {_HAS('evidence_quote', 'recommended_grade')} AND NOT {_HAS('grade_evidence_quote', 'recommended_grade')} THEN {_TELL('grade not in quotes', ' || recommended_grade')} END,
 CASE WHEN sup IN ('structural', 'weak') AND NOT coalesce(needs_review, false) THEN {_TELL('review flag')} END]) AS i FROM tt, corpus WHERE NOT skipped),
 a AS (SELECT row_id, target, i.rule AS rule, i.problem AS problem FROM f WHERE i IS NOT NULL UNION ALL SELECT row_id, target, 'empty path', '{G.PROBLEMS["empty path"][2]}' FROM tt WHERE len(lv) = 0
 UNION ALL SELECT row_id, target, 'path seen before', '{G.PROBLEMS["path seen before"][2]}' FROM (SELECT *, min(ord) OVER (PARTITION BY path) AS o FROM tt) WHERE ord > o
 UNION ALL SELECT row_id, target, 'level not in documents', '{G.PROBLEMS["level not in documents"][2]}' || level FROM (SELECT row_id, target, unnest(lv) AS level FROM tt WHERE NOT skipped) u WHERE level IN (SELECT level FROM absent)),
 issues AS (SELECT 'issue_' || left(sha1(issue_type || '||' || target || '||' || problem), 12) AS issue_id, row_id, a.rule, issue_type, severity, problem FROM a JOIN {_KINDS} ON a.rule = kinds.rule)"""


@query(f"{_VALIDATION} SELECT * FROM issues")
def validation_issues(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d)


@query(f"{_VALIDATION} SELECT rule, issue_type, severity, count(*) AS n, min(row_id) AS first_row FROM issues GROUP BY 1, 2, 3")
def issues_by_problem(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).groupBy("rule", "issue_type", "severity").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_row"))


@query(
    f"""{BASE}, k AS (SELECT *, {STRIP("coalesce(description, '')")} AS t, levels[len(levels)] AS leaf FROM pathed), w AS (SELECT row_id,
 CASE WHEN t = '' OR t = '{X.INSUFFICIENT}' OR coalesce(description_source, '') = 'insufficient' THEN 'insufficient' ELSE array_to_string(list_filter([CASE WHEN {COMPACT('t')} = {COMPACT('leaf')} THEN 'equals_leaf' END, CASE WHEN coalesce(list_contains(data_range_examples, t), false) THEN 'duplicates_example' END, CASE WHEN length(t) <= 4 AND NOT regexp_matches(t, '[。；;，,]') THEN 'too_short' END], lambda x: x IS NOT NULL), '|') END AS flags,
 (CASE WHEN recommended_grade IS NOT NULL THEN 100 ELSE 0 END) + (CASE WHEN len(coalesce(data_range_examples, [])) > 0 THEN 10 ELSE 0 END) + len(levels) AS priority FROM k)
 SELECT row_id, flags, priority FROM w WHERE flags <> ''"""
)
def weak_descriptions(spark: SparkSession, d: str) -> DataFrame:
    return R.weak_descriptions(_rows(spark, d)).select("row_id", "flags", F.col("priority").cast("bigint").alias("priority"))


@query(SQL["weak_descriptions"].replace("WHERE flags <> ''", "WHERE flags <> '' ORDER BY priority DESC, row_id LIMIT 20"))
def weak_descriptions_top(spark: SparkSession, d: str) -> DataFrame:
    """The twenty weak rows of highest priority, a report."""
    return weak_descriptions(spark, d).orderBy(F.desc("priority"), "row_id").limit(20)


_EOL = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
_ENDS = "regexp_matches(b, '^表[A-Z]?[0-9]') OR starts_with(b, '附录') OR b IN ('数据分类 数据分级', '类 项 目 数据范围及示例 数据加工程度 影响对象 影响程度 数据级别') OR regexp_matches(b, '^[0-9]{3}\\S+')"


@query(
    f"""{BASE}, dc AS (SELECT DISTINCT ON (doc_id) doc_id, raw_text FROM source_documents), pt AS (SELECT doc_id, string_split(regexp_replace(raw_text, '{_EOL}', chr(10), 'g'), chr(10)) AS p FROM dc WHERE coalesce(raw_text, '') <> ''), tp AS (SELECT doc_id, CASE WHEN p[len(p)] = '' THEN p[1:len(p) - 1] ELSE p END AS p FROM pt),
 ln AS (SELECT doc_id, n, p[n] AS line, {STRIP('p[n]')} AS b, len(p) AS total FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS n FROM tp)), fl AS (SELECT *, {_ENDS} AS ends FROM ln), nx AS (SELECT *, coalesce(min(CASE WHEN ends THEN n END) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - 1, total) AS stop FROM fl),
 sp AS (SELECT doc_id, 'table_row' AS kind, n AS a, stop AS z FROM nx WHERE regexp_matches(b, '^[0-9]{{3}}\\S+') UNION ALL SELECT doc_id, 'lines', n, least(n + 2, total) FROM ln WHERE (n - 1) % 3 = 0),
 un AS (SELECT sp.doc_id, 'txt_' || kind || '_' || a || '_' || z AS unit_id, a AS line_start, {STRIP("string_agg(line, chr(10) ORDER BY n)")} AS text FROM sp JOIN ln ON sp.doc_id = ln.doc_id AND n BETWEEN a AND z AND b <> '' GROUP BY 1, 2, 3), ub AS (SELECT *, {COMPACT('text')} AS bare FROM un WHERE text <> ''),
 tm AS (SELECT row_id, evidence_refs, list_distinct(list_filter(list_transform(list_concat(levels, coalesce(data_range_examples, []), [processing_degree, impact_object, impact_degree, recommended_grade]), lambda x: {STRIP('x')}), lambda x: x IS NOT NULL AND x <> '')) AS terms FROM pathed),
 wt AS (SELECT DISTINCT row_id, terms, doc_id FROM (SELECT row_id, terms, unnest(list_distinct(list_transform(coalesce(evidence_refs, []), lambda r: r.chunk_id))) AS chunk_id FROM tm) x JOIN (SELECT DISTINCT ON (chunk_id) chunk_id, doc_id FROM chunks) c ON x.chunk_id = c.chunk_id),
 sc AS (SELECT row_id, wt.doc_id, unit_id, line_start, list_sum(list_transform(terms, lambda x: CASE WHEN contains(text, x) THEN CASE WHEN length(x) >= 4 THEN 5 ELSE 3 END WHEN {COMPACT('x')} <> '' AND contains(bare, {COMPACT('x')}) THEN 3 ELSE 0 END))::BIGINT AS score FROM wt JOIN ub ON wt.doc_id = ub.doc_id),
 rk AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, line_start, starts_with(unit_id, 'txt_table_row') DESC, doc_id) AS rank FROM sc WHERE score > 0) SELECT row_id, doc_id, unit_id, line_start, score, rank FROM rk WHERE rank <= 5"""
)
def row_contexts(spark: SparkSession, d: str) -> DataFrame:
    return R.contexts(_rows(spark, d), one_per_key(load(spark, d, "chunks"), "chunk_id"), one_per_key(load(spark, d, "source_documents"), "doc_id")).withColumns({c: F.col(c).cast("bigint") for c in ("line_start", "score", "rank")})


@query(
    f"WITH {ROWS} SELECT description_source, support_level, row_role, count(*) AS n, grouping(description_source) AS g1, grouping(support_level) AS g2, grouping(row_role) AS g3 FROM rows_once GROUP BY GROUPING SETS ((description_source), (support_level), (row_role), ())"
)
def run_quality(spark: SparkSession, d: str) -> DataFrame:
    t = _rows(spark, d)
    a, b, c = F.col("description_source"), F.col("support_level"), F.col("row_role")
    return t.groupingSets([[a], [b], [c], []], a, b, c).agg(F.count(F.lit(1)).alias("n"), F.grouping("description_source").cast("bigint").alias("g1"), F.grouping("support_level").cast("bigint").alias("g2"), F.grouping("row_role").cast("bigint").alias("g3"))


@query(
    f"""{BASE} SELECT count(*) AS n_rows, count(DISTINCT path) AS unique_paths, count(*) - count(DISTINCT path) AS duplicate_rows, count(*) FILTER (WHERE needs_review) AS review_rows, count(*) FILTER (WHERE recommended_grade IS NULL) AS ungraded_rows, count(*) FILTER (WHERE len(coalesce(evidence_refs, [])) = 0) AS unreferenced_rows FROM pathed"""
)
def table_quality(spark: SparkSession, d: str) -> DataFrame:
    t = R.with_path(_rows(spark, d))
    return t.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("path").alias("unique_paths"), (F.count(F.lit(1)) - F.count_distinct("path")).alias("duplicate_rows"), F.count_if("needs_review").alias("review_rows"), F.count_if(F.col("recommended_grade").isNull()).alias("ungraded_rows"), F.count_if(F.coalesce(F.size("evidence_refs"), F.lit(0)) <= 0).alias("unreferenced_rows"))


@query(
    f"""{BASE}, s AS (SELECT coalesce(evidence_refs[1].section_title, '') AS section, needs_review, levels FROM pathed)
 SELECT section, grouping(section) AS total, count(*) AS n, count(*) FILTER (WHERE needs_review) AS review, count(*) FILTER (WHERE len(list_filter(levels, lambda x: regexp_matches(x, '^[0-9]+(\\s*[.．]\\s*[0-9]+)*$'))) > 0) AS numeric_levels FROM s GROUP BY GROUPING SETS ((section), ())"""
)
def structure_by_section(spark: SparkSession, d: str) -> DataFrame:
    t = R.with_path(_rows(spark, d)).select(F.coalesce(F.get("evidence_refs", F.lit(0))["section_title"], F.lit("")).alias("section"), "needs_review", F.exists("levels", lambda x: x.rlike(r"^[0-9]+(\s*[.．]\s*[0-9]+)*$")).alias("numeric"))
    return t.groupingSets([[F.col("section")], []], F.col("section")).agg(F.grouping("section").cast("bigint").alias("total"), F.count(F.lit(1)).alias("n"), F.count_if("needs_review").alias("review"), F.count_if("numeric").alias("numeric_levels"))


@query(
    f"""WITH {ROWS}, g AS (SELECT regexp_matches(coalesce(description, ''), '{X.GRADE_OR_RISK}') OR regexp_matches(coalesce(evidence_quote, ''), '{X.GRADE_OR_RISK}') AS risky, standard_name FROM rows_once) SELECT standard_name, count(*) FILTER (WHERE risky) AS risky, count(*) AS n FROM g GROUP BY 1"""
)
def risk_wording_by_standard(spark: SparkSession, d: str) -> DataFrame:
    t = _rows(spark, d).select("standard_name", (X.grade_or_risk(F.col("description")) | X.grade_or_risk(F.col("evidence_quote"))).alias("risky"))
    return t.groupBy("standard_name").agg(F.count_if("risky").alias("risky"), F.count(F.lit(1)).alias("n"))


@query(
    f"""{BASE}, x AS (SELECT standard_name, row_id, path, confidence, ord, row_number() OVER (PARTITION BY standard_name ORDER BY confidence, ord) AS k FROM pathed WHERE needs_review) SELECT standard_name, row_id, path, k FROM x WHERE k <= 5"""
)
def review_examples(spark: SparkSession, d: str) -> DataFrame:
    """Five examples of each standard, a report: the least sure rows that ask for review."""
    from pyspark.sql import Window

    t = R.with_path(_rows(spark, d)).where("needs_review")
    w = Window.partitionBy("standard_name").orderBy(F.asc_nulls_last("confidence"), "ord")
    return t.withColumn("k", F.row_number().over(w)).where("k <= 5").select("standard_name", "row_id", "path", F.col("k").cast("bigint").alias("k"))


@query(
    f"""WITH {ROWS} SELECT row_id, 'row_' || left(sha1(array_to_string(list_filter(coalesce(path_levels, []), lambda x: x IS NOT NULL), ' / ') || '|' || coalesce(recommended_grade, '')), 12) AS stable_id, least(greatest(round(coalesce(confidence, 0), 3), 0), 1) AS confidence FROM rows_once"""
)
def row_ids(spark: SparkSession, d: str) -> DataFrame:
    t = _rows(spark, d)
    path = F.array_join(F.coalesce("path_levels", F.array().cast("array<string>")), " / ")
    return t.select("row_id", X.stable_id("row", F.concat(path, F.lit("|"), F.coalesce("recommended_grade", F.lit("")))).alias("stable_id"), X.confidence(F.coalesce("confidence", F.lit(0.0))).alias("confidence"))
