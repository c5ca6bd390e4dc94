"""Rows, claims and grades from the JSON of an extractor's answers: untyped fields are coerced, unknown values replaced, evidence looked up.

An answer that holds no JSON object, or one without the expected array, gives nothing; an item that isn't an object or lacks
its name is left out; fields of another type count as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

# Accepted values, defaults and reasons for review.
CLAIM_TYPES = ("definition", "inclusion", "exclusion", "hierarchy", "classification_principle", "grade_definition", "grade_mapping", "rule_phrase", "insufficient_evidence")
CLAIM_SUPPORT = ("explicit", "structural", "inferred", "weak", "ocr")
ROW_SUPPORT = ("explicit", "structural", "weak")
ROW_SOURCES = ("quoted", "summarized", "insufficient")
ROW_ROLES = ("classification_detail", "definition_term", "structural_heading", "grading_criterion")
NO_DESCRIPTION = "当前文档未提供该分类项的说明或范围描述。"
NO_ROW_EVIDENCE = "分类行缺少有效证据引用。"
NO_GRADE_EVIDENCE = "分级定义缺少有效证据引用。"
NO_GRADE_DEFINITION = "分级定义缺少明确释义。"
FROM_SCAN = "证据来自 OCR，需要人工核验识别结果。"

ROW_TEXTS = ("description_evidence_quote", "evidence_quote", "processing_degree", "impact_object", "impact_degree", "grade_evidence_quote")
_ROW = "path_levels array<string>, recommended_grade string, description string, description_source string, support_level string, evidence_chunk_ids array<string>, data_range_examples array<string>, needs_review string, review_reason string, status string, row_role string, confidence string, " + ", ".join(f"{c} string" for c in ROW_TEXTS)
_CLAIM = "claim_id string, claim_type string, subject string, predicate string, object string, value string, evidence_quote string, support_level string, evidence_chunk_ids array<string>, needs_review string, review_reason string, confidence string, status string"
_GRADE = "grade_name string, definition string, criteria array<string>, evidence_chunk_ids array<string>, needs_review string, review_reason string, confidence string, status string"


def _items(answers: DataFrame, key: str, fields: str) -> DataFrame:
    """answer_id, position and the fields of each object in the array key of an answer. answers: answer_id, answer."""
    struct = ", ".join(f"{n}: {t}" for n, t in (x.split(" ", 1) for x in fields.split(", ")))
    whole = F.from_json(X.json_object(F.col("answer")), f"{key} array<struct<{struct}>>")
    return answers.select("answer_id", F.posexplode(whole[key]).alias("position", "i")).where("i is not null").select("answer_id", "position", "i.*")


def _text(c: str) -> Column:
    return X.strip(F.coalesce(F.col(c), F.lit("")))


def _list(c: str) -> Column:
    return F.filter(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: X.strip(F.coalesce(x, F.lit("")))), lambda x: x != "")


def _flag(default: Column) -> Column:
    return F.coalesce(X.parse_bool(F.col("needs_review")), default)


def _sure(default: Column) -> Column:
    given = F.expr("try_cast(confidence as double)")
    return F.when(given.isNull() | F.isnan(given), default).otherwise(X.confidence(given))


def _with_evidence(items: DataFrame, chunks: DataFrame) -> DataFrame:
    """items with n_refs and from_scan: how many different known chunks an item names, and whether one is recognised text."""
    named = items.select("answer_id", "position", F.explode(F.array_distinct(F.coalesce("evidence_chunk_ids", F.array().cast("array<string>")))).alias("chunk_id"))
    known = named.join(chunks.select("chunk_id", "source_method"), "chunk_id").groupBy("answer_id", "position").agg(F.count(F.lit(1)).alias("n_refs"), F.max(F.col("source_method") == "ocr").alias("from_scan"), F.array_sort(F.collect_set("chunk_id")).alias("chunk_ids"))
    t = items.join(known, ["answer_id", "position"], "left")
    return t.withColumns({"n_refs": F.coalesce("n_refs", F.lit(0)).cast("int"), "from_scan": F.coalesce("from_scan", F.lit(False)), "chunk_ids": F.coalesce("chunk_ids", F.array().cast("array<string>"))})


def _first_best(df: DataFrame, key: str, rank: list[Column]) -> DataFrame:
    """The best row of each key, the first of equals, by answer and position."""
    best = F.struct(*(r.alias(f"r{i}") for i, r in enumerate(rank)), F.struct(F.col("answer_id").alias("a"), F.col("position").alias("p")).alias("at"))
    top = df.withColumn("__b", best).groupBy(key).agg(F.min("__b")["at"].alias("at")).select(F.col("at.a").alias("answer_id"), F.col("at.p").alias("position"))
    return df.join(top, ["answer_id", "position"], "left_semi")


def rows(answers: DataFrame, chunks: DataFrame) -> DataFrame:
    """Classification rows, the best of each path and grade: with evidence, by source of its description, support and confidence."""
    t = _with_evidence(_items(answers, "classification_rows", _ROW), chunks).withColumn("levels", _list("path_levels")).where("size(levels) > 0")
    told, grade = _text("description"), F.col("recommended_grade")
    none = (told == "") | (told == X.INSUFFICIENT)
    given = _text("description_source")
    source = F.when(none, "insufficient").when(given.isin(*ROW_SOURCES), given).otherwise("summarized")
    support = F.when(_text("support_level").isin(*ROW_SUPPORT), _text("support_level")).otherwise("weak")
    t = t.withColumns({"grade": F.when(F.coalesce(grade, F.lit("")) != "", X.strip(grade)), "source": source, "support": support, "path": F.array_join("levels", " / ")})
    t = t.withColumn("told", F.when(F.col("source") == "insufficient", X.INSUFFICIENT).otherwise(told))
    review = (F.col("source") == "insufficient") | (F.col("n_refs") == 0) | F.col("support").isin("structural", "weak") | F.col("grade").isNull() | _flag(F.lit(False))
    reason = F.when(_text("review_reason") != "", _text("review_reason")).when(F.col("source") == "insufficient", NO_DESCRIPTION).when(F.col("n_refs") == 0, NO_ROW_EVIDENCE).otherwise("")
    status = F.when(F.coalesce("status", F.lit("")) != "", F.col("status")).otherwise(F.when(F.col("review"), "proposed").otherwise("evidence_supported"))
    t = t.withColumns({"review": review, "reason": reason}).withColumn("told_status", status)
    t = t.withColumns({"final_status": F.when(F.col("review") & (F.col("told_status") != "insufficient_evidence"), "proposed").otherwise(F.col("told_status")), "sure": _sure(F.lit(0.65)), "fingerprint": F.concat("path", F.lit("|"), F.coalesce("grade", F.lit("")))})
    order = lambda c, *best: F.coalesce(F.element_at(F.create_map(*(F.lit(x) for k, v in enumerate(best) for x in (v, -k))), F.col(c)), F.lit(0))
    best = _first_best(t, "fingerprint", [-(F.col("n_refs") > 0).cast("int"), order("source", "insufficient", "summarized", "quoted"), order("support", "weak", "structural", "explicit"), -F.col("sure")])
    role = F.when(_text("row_role").isin(*ROW_ROLES), _text("row_role")).otherwise("classification_detail")
    return best.select(X.stable_id("row", F.col("fingerprint")).alias("row_id"), F.col("levels").alias("path_levels"), role.alias("row_role"), F.col("grade").alias("recommended_grade"), F.col("told").alias("description"), F.col("source").alias("description_source"), *(_text(c).alias(c) for c in ROW_TEXTS), "chunk_ids", _list("data_range_examples").alias("data_range_examples"), F.col("support").alias("support_level"), F.col("sure").alias("confidence"), F.col("review").alias("needs_review"), F.col("reason").alias("review_reason"), F.col("final_status").alias("status"))


def claims(answers: DataFrame, chunks: DataFrame) -> DataFrame:
    """Claims, the first of each type, subject, predicate, object and value; those from recognised text are to be reviewed."""
    parts = ("claim_type", "subject", "predicate", "object", "value")
    t = _items(answers, "claims", _CLAIM).withColumns({c: _text(c) for c in parts}).where(F.col("claim_type").isin(*CLAIM_TYPES) & (F.col("subject") != ""))
    t = t.withColumn("fingerprint", F.concat_ws("|", *parts))
    t = _with_evidence(_first_best(t, "fingerprint", [F.lit(0)]), chunks)
    given = F.lower(_text("support_level"))
    support = F.when(F.col("from_scan"), "ocr").when(given.isin(*CLAIM_SUPPORT), given).otherwise("weak")
    t = t.withColumn("support", support)
    t = t.withColumn("review", F.col("from_scan") | F.col("support").isin("inferred", "weak", "ocr") | _flag(F.col("n_refs") == 0))
    reason = F.when(_text("review_reason") != "", _text("review_reason")).when(F.col("from_scan"), FROM_SCAN).otherwise("")
    named = F.when(_text("claim_id") != "", _text("claim_id")).otherwise(X.stable_id("claim", F.col("fingerprint")))
    status = F.when(F.coalesce("status", F.lit("")) != "", F.col("status")).when(F.col("review"), "proposed").otherwise("evidence_supported")
    return t.select(named.alias("claim_id"), *parts, _text("evidence_quote").alias("evidence_quote"), F.col("support").alias("support_level"), "chunk_ids", _sure(F.when(F.col("from_scan"), 0.55).otherwise(0.65)).alias("confidence"), F.col("review").alias("needs_review"), reason.alias("review_reason"), status.alias("status"))


def grades(answers: DataFrame, chunks: DataFrame) -> DataFrame:
    """Definitions of grades, the best of each name: with evidence, with a definition, by criteria and confidence."""
    t = _with_evidence(_items(answers, "grade_definitions", _GRADE), chunks).withColumns({"name": _text("grade_name"), "told": _text("definition"), "rules": _list("criteria"), "sure": _sure(F.lit(0.65))}).where("name <> ''")
    bare, mute = F.col("n_refs") == 0, F.col("told") == ""
    first = _flag(bare | mute)
    status = F.when(F.coalesce("status", F.lit("")) != "", F.col("status")).when(first, "proposed").otherwise("evidence_supported")
    reason = F.when(_text("review_reason") != "", _text("review_reason")).when(bare, NO_GRADE_EVIDENCE).when(mute, NO_GRADE_DEFINITION).otherwise("")
    t = t.withColumns({"review": first | bare | mute, "reason": reason, "final": F.when((bare | mute) & (status == "evidence_supported"), "proposed").otherwise(status)})
    best = _first_best(t, "name", [-(~bare).cast("int"), -(~mute).cast("int"), -F.size("rules"), -F.col("sure")])
    return best.select(X.stable_id("grade", F.col("name")).alias("grade_id"), F.col("name").alias("grade_name"), F.col("told").alias("definition"), F.col("rules").alias("criteria"), "chunk_ids", F.col("sure").alias("confidence"), F.col("review").alias("needs_review"), F.col("reason").alias("review_reason"), F.col("final").alias("status"))
