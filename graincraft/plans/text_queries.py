"""Registered queries on documents, pages and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fuzzy
from ..functions import text as X
from ..operators import lines as L
from ..sources.tables import load, one_per_key
from .registry import query
from .row_queries import COMPACT, STRIP, WS

EOL = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
_SPLIT = lambda c: f"string_split(regexp_replace({c}, '{EOL}', chr(10), 'g'), chr(10))"
CHUNKS = "chunks_once AS (SELECT DISTINCT ON (chunk_id) * FROM chunks)"
LINES = f"parts AS (SELECT chunk_id, {_SPLIT('text')} AS p FROM chunks_once WHERE text IS NOT NULL), trimmed AS (SELECT chunk_id, CASE WHEN p[len(p)] = '' THEN p[1:len(p) - 1] ELSE p END AS p FROM parts), lines AS (SELECT chunk_id, n AS line_no, regexp_replace(p[n], '{WS}+$', '') AS line FROM (SELECT chunk_id, p, unnest(range(1, len(p) + 1)) AS n FROM trimmed))"


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(load(spark, d, "chunks"), "chunk_id")


@query(f"WITH {CHUNKS}, {LINES} SELECT chunk_id, line_no, line FROM lines")
def chunk_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.explode_lines(_chunks(spark, d), "text", ("chunk_id",)).withColumn("line_no", F.col("line_no").cast("bigint"))


@query(f"WITH {CHUNKS}, {LINES} SELECT least(length(line) // 20, 20) AS bucket, count(*) AS n FROM lines GROUP BY 1")
def line_length_histogram(spark: SparkSession, d: str) -> DataFrame:
    return L.explode_lines(_chunks(spark, d), "text", ("chunk_id",)).groupBy(F.least(F.floor(F.length("line") / 20), F.lit(20)).cast("bigint").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CHUNKS}, {LINES} SELECT chunk_id, line_no, left(line, 77) || '...' AS preview FROM lines WHERE length(line) > 80")
def long_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.high_risk(L.explode_lines(_chunks(spark, d), "text", ("chunk_id",)), 80).select("chunk_id", F.col("line_no").cast("bigint").alias("line_no"), "preview")


@query(
    f"""WITH {CHUNKS}, s AS (SELECT chunk_id, source_method, {STRIP("coalesce(text, '')")} AS t FROM chunks_once), b AS (SELECT *, {COMPACT('t')} AS c FROM s),
 r AS (SELECT *, list_filter(list_transform({_SPLIT('t')}, lambda x: {STRIP('x')}), lambda x: x <> '') AS l FROM b),
 g AS (SELECT source_method, CASE WHEN t = '' THEN 'possible_noise' WHEN length(regexp_replace(c, '[^一-鿿\\p{{L}}\\p{{N}}]', '', 'g')) / length(c) < 0.35 THEN 'possible_noise'
 WHEN len(l) >= 2 AND len(list_filter(l, lambda x: regexp_matches(x, '\\t|\\||\\s{{2,}}'))) >= greatest(1, len(l) // 2) THEN 'table_like' WHEN source_method = 'ocr' AND length(t) <= 30 THEN 'short_ocr'
 WHEN length(t) <= 40 AND (regexp_matches(t, '^[0-9一二三四五六七八九十]+[.、．]?\\s*\\S+') OR NOT regexp_matches(t, '[。；;：:，,]')) THEN 'heading_only' ELSE 'normal' END AS signal FROM r)
 SELECT source_method, signal, count(*) AS n FROM g GROUP BY 1, 2"""
)
def chunk_signal_counts(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).groupBy("source_method", X.chunk_signal(F.col("text"), F.col("source_method")).alias("signal")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {CHUNKS}, {LINES}, s AS (SELECT {STRIP('line')} AS t FROM lines), k AS (SELECT CASE WHEN regexp_matches(t, '(?i)^附\\s*录\\s*[A-ZＡ-Ｚ]\\s*$') THEN 'appendix_heading'
 WHEN regexp_matches(t, '(?i)^(?:续\\s*表\\s*[A-ZＡ-Ｚ]\\s*\\.?\\s*[0-9]+|表\\s*[A-ZＡ-Ｚ]\\s*\\.?\\s*[0-9]+\\s*[（(]\\s*续\\s*[）)]).+') THEN 'continued_table_title'
 WHEN regexp_matches(t, '(?i)^表\\s*[A-ZＡ-Ｚ]\\s*\\.?\\s*[0-9]+(?:\\s*[（(]\\s*续\\s*[）)])?\\s+.+') THEN 'table_title' WHEN regexp_matches(t, '^[一-鿿]{{2,20}}分类\\s*$') THEN 'classification_title'
 WHEN regexp_matches(t, '类(?:（[^）]+）|\\([^)]*\\))?\\s+项(?:（[^）]+）|\\([^)]*\\))?\\s+目|资源属性\\s+类.*项.*目') THEN 'hierarchy_header'
 WHEN regexp_matches(t, '^[0-9]{{1,2}}[、.．]\\s*[^\\s].{{0,30}}$') AND NOT regexp_matches(t, '\\s+[0-9]{{1,3}}(?:\\s|$)') THEN 'not_appendix_body' END AS kind FROM s)
 SELECT kind, count(*) AS n FROM k GROUP BY 1"""
)
def structure_signal_counts(spark: SparkSession, d: str) -> DataFrame:
    t = L.explode_lines(_chunks(spark, d), "text", ("chunk_id",))
    return t.groupBy(X.structure_signal(F.col("line"))["kind"].alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CHUNKS} SELECT source_method, doc_id, count(*) AS n, count(DISTINCT doc_id) AS docs, grouping(source_method) AS g1, grouping(doc_id) AS g2 FROM chunks_once GROUP BY GROUPING SETS ((source_method), (doc_id), ())")
def evidence_index(spark: SparkSession, d: str) -> DataFrame:
    t = _chunks(spark, d)
    a, b = F.col("source_method"), F.col("doc_id")
    return t.withColumn("x", b).groupingSets([[a], [b], []], a, b).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("x").alias("docs"), F.grouping("source_method").cast("bigint").alias("g1"), F.grouping("doc_id").cast("bigint").alias("g2"))


@query(f"WITH {CHUNKS} SELECT doc_id, string_agg(chunk_id, '|' ORDER BY position, chunk_id) AS chunk_ids FROM chunks_once GROUP BY 1")
def chunk_ids_by_document(spark: SparkSession, d: str) -> DataFrame:
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "chunk_id"))), lambda x: x["chunk_id"]), "|")
    return _chunks(spark, d).groupBy("doc_id").agg(ids.alias("chunk_ids"))


@query(f"WITH {CHUNKS}, {LINES} SELECT regexp_matches(line, '^\\s*(?:[-－—–]\\s*[0-9]{{1,4}}\\s*[-－—–]|[0-9]{{1,4}})\\s*$') AS noise, count(*) AS n FROM lines GROUP BY 1")
def page_noise_counts(spark: SparkSession, d: str) -> DataFrame:
    return L.explode_lines(_chunks(spark, d), "text", ("chunk_id",)).groupBy(F.col("line").rlike(L.PAGE_NOISE).alias("noise")).agg(F.count(F.lit(1)).alias("n"))


@query()
def cleaned_lines(spark: SparkSession, d: str) -> DataFrame:
    docs = one_per_key(load(spark, d, "source_documents"), "doc_id")
    return L.clean_lines(L.explode_lines(docs, "raw_text", ("doc_id",)))


_T = STRIP("line")
_SIGNAL = f"""CASE WHEN regexp_matches(t, '(?i)^附\\s*录\\s*[A-ZＡ-Ｚ]\\s*$') THEN 1 WHEN regexp_matches(t, '(?i)^(?:续\\s*表\\s*[A-ZＡ-Ｚ]\\s*\\.?\\s*[0-9]+|表\\s*[A-ZＡ-Ｚ]\\s*\\.?\\s*[0-9]+\\s*[（(]\\s*续\\s*[）)]).+|^表\\s*[A-ZＡ-Ｚ]\\s*\\.?\\s*[0-9]+(?:\\s*[（(]\\s*续\\s*[）)])?\\s+.+') THEN 3 WHEN regexp_matches(t, '^[一-鿿]{{2,20}}分类\\s*$') THEN 2 END"""
_MARKED = r"^#{1,6}\s+\S+|^[一二三四五六七八九十]+[、.．]\s*\S+|^[0-9]+(?:\.[0-9]+)*[、.．]\s*\S+"


@query(
    f"""WITH pg AS (SELECT DISTINCT ON (doc_id, page_number) doc_id, coalesce(page_number, 0) AS page, text FROM document_pages), pp AS (SELECT doc_id, page, {_SPLIT('text')} AS p FROM pg WHERE text IS NOT NULL AND text <> ''), tr AS (SELECT doc_id, page, CASE WHEN p[len(p)] = '' THEN p[1:len(p) - 1] ELSE p END AS p FROM pp),
 ln AS (SELECT doc_id, page, n AS line_no, regexp_replace(p[n], '{WS}+$', '') AS line FROM (SELECT doc_id, page, p, unnest(range(1, len(p) + 1)) AS n FROM tr)), st AS (SELECT *, {_T} AS t FROM ln), sg AS (SELECT *, {_SIGNAL} AS signal FROM st),
 kd AS (SELECT *, CASE WHEN line = '' THEN 'blank' WHEN signal IS NOT NULL OR regexp_matches(t, '{_MARKED}') THEN 'heading' WHEN regexp_matches(line, '^\\s*(?:[-*+]|[0-9]+[.)、．])\\s+\\S+') THEN 'list' ELSE 'text' END AS kind, row_number() OVER (PARTITION BY doc_id ORDER BY page, line_no) AS seq FROM sg),
 tt AS (SELECT *, CASE WHEN kind = 'heading' THEN coalesce(signal, 1) END AS level, CASE WHEN signal = 1 THEN '附录 ' || upper(translate(regexp_extract(t, '(?i)^附\\s*录\\s*([A-ZＡ-Ｚ])', 1), '{X.FULL_WIDTH}', '{X.HALF_WIDTH}')) WHEN signal IS NOT NULL THEN regexp_replace(t, '{WS}+', ' ', 'g') ELSE trim(regexp_replace(regexp_replace(regexp_replace(t, '^#{{1,6}}\\s+', ''), '^[一二三四五六七八九十]+[、.．]\\s*', ''), '^[0-9]+(?:\\.[0-9]+)*[、.．]\\s*', '')) END AS title FROM kd),
 hh AS (SELECT *, {', '.join(f"last_value(CASE WHEN level = {k} THEN {{'seq': seq, 'title': title}} END IGNORE NULLS) OVER w AS h{k}" for k in (1, 2, 3))}, lag(kind) OVER (PARTITION BY doc_id, page ORDER BY line_no) AS before FROM tt WINDOW w AS (PARTITION BY doc_id ORDER BY page, line_no ROWS UNBOUNDED PRECEDING)),
 se AS (SELECT *, array_to_string(list_filter([h1.title, CASE WHEN h2.seq > coalesce(h1.seq, 0) THEN h2.title END, CASE WHEN h3.seq > greatest(coalesce(h1.seq, 0), coalesce(h2.seq, 0)) THEN h3.title END], lambda x: x IS NOT NULL), ' / ') AS section, before IS NULL OR kind = 'heading' OR before <> kind OR before = 'heading' AS cut FROM hh),
 bl AS (SELECT *, sum(cut::INTEGER) OVER (PARTITION BY doc_id ORDER BY page, line_no ROWS UNBOUNDED PRECEDING) AS block FROM se), gr AS (SELECT doc_id, page, block, min(line_no) AS line_start, max(line_no) AS line_end, arg_min(section, line_no) AS section, string_agg(line, chr(10) ORDER BY line_no) AS text FROM bl WHERE kind <> 'blank' GROUP BY 1, 2, 3)
 SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY page, block) AS position, nullif(page, 0) AS page_number, CASE WHEN section <> '' THEN section WHEN page > 0 THEN 'Page ' || page ELSE '未命名章节' END AS section_title, line_start, line_end, text FROM gr"""
)
def page_chunks(spark: SparkSession, d: str) -> DataFrame:
    return L.chunk(one_per_key(load(spark, d, "document_pages"), "doc_id", "page_number")).withColumns({c: F.col(c).cast("bigint") for c in ("position", "line_start", "line_end")})


@query()
def table_segments(spark: SparkSession, d: str) -> DataFrame:
    t = _chunks(spark, d)
    wide = X.chunk_signal(F.col("text"), F.col("source_method")) == "table_like"
    return L.segments(t.where(wide | (F.length("text") > 900)), 900)


def _batches_sql(most: int, budget: int) -> str:
    closes = f"(w.items >= {most} OR w.total + o.n > {budget} OR o.n > {budget} OR w.total > {budget})"
    return f"""WITH RECURSIVE {CHUNKS}, o AS (SELECT doc_id, chunk_id, coalesce(length(text), 0) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY position, chunk_id) AS k FROM chunks_once),
 w AS (SELECT doc_id, chunk_id, k, 0 AS batch, n AS total, 1 AS items FROM o WHERE k = 1 UNION ALL SELECT o.doc_id, o.chunk_id, o.k, CASE WHEN {closes} THEN w.batch + 1 ELSE w.batch END, CASE WHEN {closes} THEN o.n ELSE w.total + o.n END, CASE WHEN {closes} THEN 1 ELSE w.items + 1 END FROM w JOIN o ON o.doc_id = w.doc_id AND o.k = w.k + 1)
 SELECT doc_id, chunk_id, batch FROM w"""


@query(_batches_sql(5, 2000))
def claim_batches(spark: SparkSession, d: str) -> DataFrame:
    """Five chunks or two thousand characters at most, a longer chunk alone, in the order of their places in the document."""
    t = _chunks(spark, d).select("doc_id", "position", "chunk_id", F.coalesce(F.length("text"), F.lit(0)).alias("n"))
    return L.batches(t, "doc_id", ["position", "chunk_id"], F.col("n"), 2000, 5).select("doc_id", "chunk_id", "batch")


@query(f"WITH {CHUNKS} SELECT doc_id, chunk_id, (row_number() OVER (PARTITION BY doc_id ORDER BY position, chunk_id) - 1) // 3 AS batch FROM chunks_once")
def fixed_batches(spark: SparkSession, d: str) -> DataFrame:
    t = _chunks(spark, d).select("doc_id", "position", "chunk_id", F.lit(0).alias("n"))
    return L.batches(t, "doc_id", ["position", "chunk_id"], F.col("n"), 0, 3).select("doc_id", "chunk_id", F.col("batch").cast("bigint").alias("batch"))


@query(f"WITH {CHUNKS} SELECT doc_id, sha1(string_agg(chunk_id || chr(1) || coalesce(text, ''), chr(2) ORDER BY position, chunk_id)) AS signature FROM chunks_once GROUP BY 1")
def batch_signatures(spark: SparkSession, d: str) -> DataFrame:
    """What a document's chunks are known by, so that a second run skips those that are done."""
    return L.signature(_chunks(spark, d), ["doc_id"], ["position", "chunk_id"], "chunk_id", "text", between="\x01", apart="\x02")


@query(
    f"""WITH {CHUNKS}, {LINES}, c AS (SELECT chunk_id, line_no, list_transform(regexp_extract_all(line, '[0-9]+(?:\\s*[.．]\\s*[0-9]+)+'), lambda x: replace(regexp_replace(x, '\\s+', '', 'g'), '．', '.')) AS l FROM lines), u AS (SELECT chunk_id, line_no, list_filter(l, lambda x, i: list_position(l, x) = i) AS codes FROM c)
 SELECT chunk_id, line_no, array_to_string(codes, '|') AS codes, len(list_filter(codes, lambda a: len(list_filter(codes, lambda b: starts_with(b, a || '.'))) > 0)) > 0 AS flattened FROM u WHERE len(codes) > 1"""
)
def flattened_rows(spark: SparkSession, d: str) -> DataFrame:
    t = L.explode_lines(_chunks(spark, d), "text", ("chunk_id",))
    return t.where(F.size(X.dotted_codes(F.col("line"))) > 1).select("chunk_id", F.col("line_no").cast("bigint").alias("line_no"), F.array_join(X.dotted_codes(F.col("line")), "|").alias("codes"), X.flattened_hint(F.col("line")).alias("flattened"))


@query("SELECT lang, count(*) AS n, sum(length(text)) AS chars, count(*) FILTER (WHERE text IS NULL OR text = '') AS empty FROM documents GROUP BY 1")
def documents_by_language(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"), F.count_if(F.col("text").isNull() | (F.col("text") == "")).alias("empty"))


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE text IS NOT NULL AND text <> '' GROUP BY text HAVING count(*) > 1")
def equal_documents(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").where("text is not null and text <> ''").groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("doc_id", "copies")


@query("SELECT source_part, count(DISTINCT element_code) AS elements, count(DISTINCT CASE WHEN coalesce(trim(allowed_values), '') = '' THEN element_code END) AS without_values FROM part_16 GROUP BY 1")
def element_parts(spark: SparkSession, d: str) -> DataFrame:
    blank = F.coalesce(F.trim("allowed_values"), F.lit("")) == ""
    return load(spark, d, "part_16").groupBy("source_part").agg(F.count_distinct("element_code").alias("elements"), F.count_distinct(F.when(blank, F.col("element_code"))).alias("without_values"))


@query()
def keyword_search(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that speak of registration or sharing, all of them, best first by score and position.

    A term scores 1 in the text and 0.6 in the title; one not in the text a quarter of its best ratio with a line. Null
    texts and titles count as empty; equals in score and position go by chunk_id.
    """
    t = _chunks(spark, d).withColumns({c: F.coalesce(c, F.lit("")) for c in ("text", "section_title")})
    text, title = F.lower("text"), F.lower("section_title")
    score = F.lit(0.0)
    for w in ("登记", "共享", "sharing"):
        near = fuzzy.best_line_ratio("text", F.when(~text.contains(w), w))
        score = score + text.contains(w).cast("double") + 0.6 * title.contains(w).cast("double") + F.when(text.contains(w), 0.0).otherwise(0.25 * near)
    return t.select("chunk_id", "position", score.alias("score")).where("score >= 0.45").orderBy(F.desc("score"), "position", "chunk_id").select("chunk_id", "score")
