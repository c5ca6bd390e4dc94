"""Quality of rows and runs: roles, gates, eval measures, signal scores, suggestions from libraries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from . import rows as R

# Words that tell a row's role, levels that are table headers, generic and garbled library paths.
TERM_WORDS = "术语|定义"
TERM_REASONS = "术语定义条目|术语定义/注释条目|原文为术语定义段落"
TITLE_REASONS = "仅含分类标题|仅含分类编号|仅含当前层级编号|仅包含分类层级标题"
FRAGMENT_REASONS = "孤立短语|分级判定因素片段|疑似表格表头|文本断裂"
NON_DETAIL = ("structural_heading", "definition_term", "grading_criterion")
HEADER_LEVELS = ("类", "项", "目")
GENERIC_LEVELS = (*HEADER_LEVELS, "编码", "标识符", "数据元", "项目", "占位", "名称", "代码", "类别", "序号", "说明")
GENERIC_PATHS = ("预案", "方案", "资源管理服务")
GARBLED = "技资管理"


def _has(c: str, pattern: str) -> Column:
    return F.coalesce(F.col(c).rlike(pattern), F.lit(False))


def roles(df: DataFrame) -> DataFrame:
    """Rows with role: the one they have if it is no detail, else that of a term, of a heading (a title above other rows, or a fragment), or a detail.

    A title above others is found by joining the rows' paths with the beginnings of all paths, so no row is compared with all.
    """
    t = R.with_path(df)
    above = R.strict_prefix_of_other(df).select("row_id").distinct().withColumn("above", F.lit(True))
    thin = F.coalesce(F.col("description_source") == "insufficient", F.lit(False)) & (F.coalesce("recommended_grade", F.lit("")) == "") & (F.coalesce(F.size("data_range_examples"), F.lit(0)) <= 0)
    term = F.get("levels", F.lit(0)).rlike(TERM_WORDS) | _has("review_reason", TERM_REASONS)
    title = thin & _has("review_reason", TITLE_REASONS) & F.coalesce("above", F.lit(False))
    fragment = thin & F.coalesce(F.col("support_level") == "structural", F.lit(False)) & _has("review_reason", f"{TITLE_REASONS}|{FRAGMENT_REASONS}")
    own = X.strip(F.coalesce("row_role", F.lit("")))
    role = F.when(own.isin(*NON_DETAIL), own).when(term, "definition_term").when(title | fragment, "structural_heading").otherwise("classification_detail")
    return t.join(above, "row_id", "left").withColumn("role", role).drop("above")


def details(df: DataFrame) -> DataFrame:
    return roles(df).where("role = 'classification_detail'")


def gate(df: DataFrame, min_rows: int | None = None, min_quoted: int | None = None, max_insufficient: int | None = None, min_prefilled: int | None = None) -> DataFrame:
    """One line: the counts that thresholds are held against, the codes of those that fail in order, and passed or degraded."""
    prefilled = F.count_if(F.size("reference_prefilled_fields") > 0) if "reference_prefilled_fields" in df.columns else F.lit(0).cast("bigint")
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("description_source") == "quoted").alias("quoted"), F.count_if(F.col("description_source") == "insufficient").alias("insufficient"), prefilled.alias("prefilled"))
    below = lambda c, least, code: F.when(F.col(c) < least, code) if least is not None else F.lit(None).cast("string")
    above = F.when(F.col("insufficient") > max_insufficient, "insufficient_descriptions_above_max") if max_insufficient is not None else F.lit(None).cast("string")
    reasons = F.filter(F.array(below("n_rows", min_rows, "classification_rows_below_min"), below("quoted", min_quoted, "quoted_descriptions_below_min"), above, below("prefilled", min_prefilled, "reference_prefilled_rows_below_min")), lambda x: x.isNotNull())
    return one.select("*", F.array_join(reasons, ",").alias("reasons"), F.when(F.size(reasons) > 0, "degraded").otherwise("passed").alias("status"))


def header_as_path(levels: Column) -> Column:
    return F.exists(levels, lambda x: x.isin(*HEADER_LEVELS))


def generic_fragment(levels: Column) -> Column:
    """Whether a path holds a column's name, or two single characters that aren't ASCII."""
    single = F.size(F.filter(levels, lambda x: (F.length(x) <= 1) & ~x.rlike(r"^[\x00-\x7F]*$")))
    return F.exists(levels, lambda x: x.isin(*GENERIC_LEVELS)) | (single >= 2)


def stale_section(refs: Column) -> Column:
    """Whether a reference quotes an appendix's table while its section title names none."""
    table = lambda c: c.rlike("附 ?录") & c.contains("表")
    text = lambda r, f: F.coalesce(r[f], F.lit(""))
    return F.coalesce(F.exists(refs, lambda r: (text(r, "section_title") != "") & table(text(r, "text")) & ~table(text(r, "section_title"))), F.lit(False))


def eval_metrics(df: DataFrame, issues: DataFrame) -> DataFrame:
    """metric and n of the rows' paths, reviews and missing evidence, of path faults, and of issues by severity."""
    t = df.withColumn("levels", X.clean_levels(F.col("path_levels"))).withColumn("path", F.array_join("levels", " / "))
    refs = F.coalesce("evidence_refs", F.array().cast(df.schema["evidence_refs"].dataType))
    text = F.array_join(F.transform(refs, lambda r: F.coalesce(r["text"], F.lit(""))), "\n")
    counts = {
        "rows": F.count(F.lit(1)),
        "unique_paths": F.count_distinct(F.when(F.col("path") != "", F.col("path"))),
        "duplicate_paths": F.count_if(F.col("path") != "") - F.count_distinct(F.when(F.col("path") != "", F.col("path"))),
        "needs_review": F.count_if("needs_review"),
        "missing_quote": F.count_if(X.strip(F.coalesce("evidence_quote", F.lit(""))) == ""),
        "missing_refs": F.count_if(F.size(refs) == 0),
        "header_as_path": F.count_if(header_as_path(F.col("levels"))),
        "generic_fragment": F.count_if(generic_fragment(F.col("levels"))),
        "stale_section": F.count_if(stale_section(refs)),
        "appendix_table": F.count_if(text.rlike("附 ?录") & text.contains("表")),
        "continued_table": F.count_if(text.contains("（续）")),
    }
    one = t.agg(*(c.alias(k) for k, c in counts.items()))
    wide = one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), F.col(k).alias("n")) for k in counts))).alias("x")).select("x.*")
    return wide.union(issues.groupBy(F.concat(F.lit("issues_"), F.lower(F.coalesce("severity", F.lit("unknown")))).alias("metric")).agg(F.count(F.lit(1)).alias("n")))


def scored_signals(cases: DataFrame) -> DataFrame:
    """Cases with the kind and title found and outcome: matched, false_positive, false_negative, kind_mismatch or title_mismatch. cases: line, expected_kind, expected_title."""
    t = cases.withColumn("s", X.structure_signal(F.col("line"))).withColumns({"actual_kind": F.col("s.kind"), "actual_title": F.col("s.title")}).drop("s")
    kind = F.col("actual_kind").eqNullSafe(F.col("expected_kind"))
    title = F.col("expected_title").isNull() | F.coalesce(F.col("actual_title") == F.col("expected_title"), F.lit(False))
    outcome = F.when(kind & title, "matched").when(F.col("expected_kind").isNull() & F.col("actual_kind").isNotNull(), "false_positive").when(F.col("expected_kind").isNotNull() & F.col("actual_kind").isNull(), "false_negative").when(~kind, "kind_mismatch").otherwise("title_mismatch")
    return t.withColumn("outcome", outcome).withColumn("title_differs", ~title)


def signal_scores(cases: DataFrame) -> DataFrame:
    """One line: total, counts by outcome and accuracy."""
    t = scored_signals(cases)
    kinds = ("matched", "false_positive", "false_negative", "kind_mismatch")
    n = F.count(F.lit(1))
    return t.agg(n.alias("total"), *(F.count_if(F.col("outcome") == k).alias(k) for k in kinds), F.count_if("title_differs").alias("title_mismatch"), F.when(n > 0, F.round(F.count_if(F.col("outcome") == "matched") / n, 3)).otherwise(0.0).alias("accuracy"))


def low_quality_reference(levels: Column) -> Column:
    """A library path too thin or garbled to suggest."""
    bare = X.compact(F.array_join(levels, " / "))
    return (F.size(levels) == 0) | (F.size(levels) == 1) & bare.isin(*GENERIC_PATHS) | bare.contains(GARBLED) | F.array_join(levels, " / ").rlike(r"[0-9]+(?:\.[0-9]+)?\s+[0-9]+")


def suggestions(links: DataFrame, library: DataFrame) -> DataFrame:
    """reference_id, current_id, score and tier: strong and broad links of rows, and of the library's unlinked rows whether they are missing or of low quality.

    library: reference_id, levels.
    """
    linked = R.tiers(links).where("tier <> 'other'").select("reference_id", "current_id", "score", "tier")
    rest = R.unlinked(library, links).select("reference_id", F.lit(None).cast("string").alias("current_id"), F.lit(None).cast("double").alias("score"), F.when(low_quality_reference(F.col("levels")), "low_quality").otherwise("missing").alias("tier"))
    return linked.union(rest)
