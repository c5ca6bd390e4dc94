"""Checks that rows are grounded in their evidence and in the documents' text.

Needles (levels of paths, parts of quotes) are looked up in the corpus by multi-pattern matching: the distinct needles are
dealt into blocks of a bounded number, each block becomes an automaton that is sent to the workers, and every text is read
once for each block. What a text holds comes back as distinct needles, so no text and no pair of needle and text is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.tables import materialise

#: Needles of one automaton. A broadcast of it is bounded by this number times the longest needle; more needles take more passes.
BLOCK = 100_000

# Marks that levels are matched without, accepted values, sources of library descriptions, wordings of the problems.
LEVEL_MARKS = "、,，.．:：;；-—－_()（）[]【】"
SUPPORT_LEVELS = ("explicit", "structural", "weak")
LIBRARY_SOURCES = ("reference_library", "classification_standard_excel")
DESCRIPTION_SOURCES = ("quoted", "summarized", "insufficient", *LIBRARY_SOURCES)
PROBLEMS = {
    "no rows": ("missing_classification_rows", "high", "未抽取到 classification_rows，无法生成分类分级表。"),
    "empty path": ("schema_contract_violation", "high", "分类行缺少 path_levels。"),
    "path seen before": ("duplicated_path", "medium", "发现重复分类路径。"),
    "level not in documents": ("hardcoded_or_ungrounded_content", "high", "分类层级未出现在输入文档中："),
    "no evidence": ("unsupported_generation", "high", "分类行缺少证据引用。"),
    "no quote": ("weak_trace", "medium", "分类行缺少 evidence_quote。"),
    "quote not in evidence": ("hardcoded_or_ungrounded_content", "high", "分类行 evidence_quote 未出现在引用证据或原文中。"),
    "grade quote not in evidence": ("hardcoded_or_ungrounded_content", "high", "grade_evidence_quote 未出现在引用证据或原文中。"),
    "support level": ("schema_contract_violation", "high", "不允许的 support_level："),
    "description source": ("schema_contract_violation", "high", "不允许的 description_source："),
    "insufficient wording": ("schema_contract_violation", "medium", "证据不足说明未使用统一文案。"),
    "description without quote": ("weak_trace", "medium", "分类说明缺少 description_evidence_quote。"),
    "description quote not in evidence": ("hardcoded_or_ungrounded_content", "high", "description_evidence_quote 未出现在引用证据或原文中。"),
    "grade not in quotes": ("hardcoded_or_ungrounded_content", "medium", "推荐分级未出现在该行证据中："),
    "review flag": ("schema_contract_violation", "medium", "结构推断或弱证据行没有标记 needs_review。"),
}


def bare_level(c: Column) -> Column:
    """A level without white space and marks; one of nothing else keeps its marks."""
    bare = F.translate(X.compact(c), LEVEL_MARKS, "")
    return F.when(bare == "", X.compact(c)).otherwise(bare)


def quote_parts(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "；"), X.strip), lambda x: x != "")


def held(needles: DataFrame, texts: DataFrame, block: int = BLOCK) -> DataFrame:
    """needle of those that stand in a text. needles: needle, distinct and not empty; texts: text, as it is to be searched."""
    kept = materialise(needles.select("needle").distinct().where("needle <> ''"), "needles")
    blocks = -(-kept.count() // block)
    if not blocks:
        return kept
    out = None
    for k in range(blocks):
        words = [r["needle"] for r in kept.where(F.pmod(F.xxhash64("needle"), F.lit(blocks)) == k).collect()]
        found = _matching(texts, words)
        out = found if out is None else out.union(found)
    return out.distinct()


def _matching(texts: DataFrame, words: list[str]) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for w in shared.value:
            automaton.add_word(w, w)
        automaton.make_automaton()
        seen: set[str] = set()
        for batch in batches:
            fresh: set[str] = set()
            for t in batch.column(0).to_pylist():
                if t and len(automaton):
                    fresh.update(w for _, w in automaton.iter(t) if w not in seen)
            seen |= fresh
            if fresh:
                yield pa.RecordBatch.from_arrays([pa.array(sorted(fresh), pa.string())], names=["needle"])

    return texts.select("text").mapInArrow(run, "needle string")


def _without(needles: DataFrame, column: str, found: DataFrame) -> DataFrame:
    return needles.join(found, needles[column] == found["needle"], "left_anti")


def corpus(documents: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """text of all documents and of all pages."""
    texts = documents.select(F.col("raw_text").alias("text"))
    return texts if pages is None else texts.union(pages.select("text"))


def _issue(df: DataFrame, name: str, extra: Column | None = None) -> DataFrame:
    kind, severity, told = PROBLEMS[name]
    problem = F.lit(told) if extra is None else F.concat(F.lit(told), extra)
    return df.select("row_id", "target", F.lit(kind).alias("issue_type"), F.lit(severity).alias("severity"), F.lit(name).alias("rule"), problem.alias("problem"))


def issues(df: DataFrame, texts: DataFrame) -> DataFrame:
    """issue_id, row_id, rule, issue_type, severity and problem of each rule that a row breaks; of an empty table one issue, without a row_id.

    df: rows with ord, one for each row_id; texts: text of the documents and pages. Rows that only a library backs and that
    wait for review are checked for their path alone. A text that spans two documents' ends holds nothing; null levels don't count.
    """
    none = F.array().cast("array<string>")
    refs = F.coalesce("evidence_refs", F.array().cast(df.schema["evidence_refs"].dataType))
    levels = F.filter(F.coalesce("path_levels", none), lambda x: x.isNotNull())
    path = F.array_join("levels", " / ")
    bare_texts = F.transform(refs, lambda r: X.compact(F.coalesce(r["text"], F.lit(""))))
    t = df.withColumn("levels", levels).withColumns({"path": path, "target": F.when(path == "", F.col("row_id")).otherwise(path), "bare_texts": bare_texts, "n_refs": F.size(refs)})
    t = materialise(t.withColumn("all_text", F.array_join("bare_texts", "")).drop("evidence_refs"), "checked")
    blank = lambda c: F.coalesce(F.col(c) == "", F.lit(True))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    told = F.coalesce(F.col("support_level"), F.lit("None"))
    source = F.coalesce(F.col("description_source"), F.lit("None"))
    checked = ~F.coalesce((F.col("evidence_status") == "reference_only") & (F.col("inclusion_status") == "review_candidate"), F.lit(False))
    inside = lambda c: F.forall(quote_parts(F.col(c)), lambda p: F.col("all_text").contains(X.compact(p)))
    in_one = F.forall(quote_parts(F.col("grade_evidence_quote")), lambda p: F.exists("bare_texts", lambda x: x.contains(X.compact(p))))
    curated = F.lit(False)
    if {"reference_maturity", "reference_prefilled_fields"} <= set(df.columns):
        both = F.array_contains("reference_prefilled_fields", "path_levels") & F.array_contains("reference_prefilled_fields", "description")
        curated = F.coalesce((F.col("content_source") == "reference_library") & (F.col("reference_maturity") == "curated") & (F.col("description_source") == "classification_standard_excel") & both, F.lit(False))
    grounded = F.col("levels")
    if "reference_prefilled_fields" in df.columns:
        given = (F.col("content_source") == "reference_library") & F.array_contains("reference_prefilled_fields", "path_levels") & (F.size("original_path_levels") > 0)
        grounded = F.when(F.coalesce(given, F.lit(False)), F.col("original_path_levels")).otherwise(F.col("levels"))
    rules: dict[str, tuple[Column, Column | None]] = {
        "no evidence": (F.col("n_refs") == 0, None),
        "no quote": (blank("evidence_quote"), None),
        "quote not in evidence": ((F.col("all_text") != "") & ~inside("evidence_quote"), None),
        "grade quote not in evidence": (~blank("grade_evidence_quote") & ~in_one, None),
        "support level": (~told.isin(*SUPPORT_LEVELS), told),
        "description source": (~source.isin(*DESCRIPTION_SOURCES), source),
        "insufficient wording": ((source == "insufficient") & (text("description") != X.INSUFFICIENT), None),
        "description without quote": (~source.isin("insufficient", *LIBRARY_SOURCES) & blank("description_evidence_quote") & (blank("description") | ~X.contains_compact(text("evidence_quote"), text("description"))), None),
        "description quote not in evidence": ((F.col("all_text") != "") & ~inside("description_evidence_quote"), None),
        "grade not in quotes": (~blank("recommended_grade") & ~X.contains_compact(text("evidence_quote"), text("recommended_grade")) & ~X.contains_compact(text("grade_evidence_quote"), text("recommended_grade")), text("recommended_grade")),
        "review flag": (told.isin("structural", "weak") & ~F.coalesce("needs_review", F.lit(False)) & ~curated, None),
    }
    hits = []
    for name, (broken, extra) in rules.items():
        kind, severity, problem = PROBLEMS[name]
        full = F.lit(problem) if extra is None else F.concat(F.lit(problem), extra)
        hits.append(F.when(checked & broken, F.struct(F.lit(kind).alias("issue_type"), F.lit(severity).alias("severity"), F.lit(name).alias("rule"), full.alias("problem"))))
    plain = t.select("row_id", "target", F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("i")).select("row_id", "target", "i.*")
    first = t.groupBy("path").agg(F.min("ord").alias("first"))
    again = t.join(first, "path").where("ord > first")
    # what has to stand in the corpus: levels without marks, and parts of quotes of rows without evidence texts
    checked_rows = t.where(checked)
    wanted = checked_rows.select("row_id", "target", F.explode(grounded).alias("level")).where("level is not null and level <> ''").withColumn("bare", bare_level(F.col("level")))
    bare_corpus = texts.where("text is not null").select(F.translate(X.compact(F.col("text")), LEVEL_MARKS, "").alias("text"), X.compact(F.col("text")).alias("whole"))
    marks_only = F.translate("needle", LEVEL_MARKS, "") == ""
    needles = wanted.select(F.col("bare").alias("needle")).distinct()
    found = held(needles.where(~marks_only), bare_corpus).union(held(needles.where(marks_only), bare_corpus.select(F.col("whole").alias("text"))))
    strange = _without(wanted, "bare", found)
    parts = checked_rows.where("all_text = ''").select("row_id", "target", F.explode(F.array(*(F.struct(F.lit(rule).alias("rule"), F.transform(quote_parts(F.col(c)), X.compact).alias("parts")) for rule, c in (("quote not in evidence", "evidence_quote"), ("description quote not in evidence", "description_evidence_quote"))))).alias("q")).select("row_id", "target", "q.rule", F.explode("q.parts").alias("part"))
    unquoted = _without(parts, "part", held(parts.select(F.col("part").alias("needle")).distinct(), bare_corpus.select(F.col("whole").alias("text")))).select("row_id", "target", "rule").distinct()
    out = plain.union(_issue(t.where("size(levels) = 0"), "empty path")).union(_issue(again, "path seen before")).union(_issue(strange, "level not in documents", F.col("level")))
    for rule in ("quote not in evidence", "description quote not in evidence"):
        out = out.union(_issue(unquoted.where(F.col("rule") == rule), rule))
    if df.isEmpty():
        kind, severity, told_ = PROBLEMS["no rows"]
        out = out.union(df.sparkSession.createDataFrame([(None, "classification_rows", kind, severity, "no rows", told_)], "row_id string, target string, issue_type string, severity string, rule string, problem string"))
    return out.select(X.stable_id("issue", F.col("issue_type"), F.col("target"), F.col("problem")).alias("issue_id"), "row_id", "rule", "issue_type", "severity", "problem")
