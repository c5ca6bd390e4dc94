"""Writers: rule tables as JSON and Markdown, trees, suggestion and quality reports, append-only checkpoints.

Tables are written by the executors; only reports of a bounded number of lines are rendered as text.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Profiles that export everything, names of levels, columns of the Markdown table behind the path.
FULL_PROFILES = ("audit", "debug", "full")
LEVEL_FIGURES = "一二三四五六七八九十"
TABLE_COLUMNS = "推荐分级 分类说明 数据范围及示例 数据加工程度 影响对象 影响程度 证据强度 行来源 内容来源 纳入状态 证据状态 原始路径 预填字段 需复核 复核原因".split()
NO_TABLE = "证据不足，无法从当前文档确定分类分级明细。"


def cell(c: Column) -> Column:
    """A value as it may stand in a Markdown table."""
    return F.replace(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit("<br>"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def markdown_lines(df: DataFrame, levels: str, columns: list[str], depth: int | None = None) -> DataFrame:
    """ord and line of a Markdown table whose path is spread to as many columns as the deepest path has. df has a column ord."""
    n = depth or max(1, df.agg(F.max(F.size(levels))).first()[0] or 1)
    heads = [*(f"level {i + 1}" for i in range(n)), *columns]
    cells = [*(cell(F.get(levels, F.lit(i))) for i in range(n)), *(cell(F.col(c)) for c in columns)]
    body = df.select("ord", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    head = df.sparkSession.createDataFrame([(-2, "| " + " | ".join(heads) + " |"), (-1, "|" + " --- |" * len(heads))], "ord bigint, line string")
    return head.union(body.select(F.col("ord").cast("bigint"), "line"))


def tree_lines(nodes: DataFrame) -> DataFrame:
    """path and line of a tree, to be read in the order of levels: two blanks for each level, name, grade."""
    name = F.try_element_at(F.split("path", " / "), F.lit(-1))
    return nodes.select(F.split("path", " / ").alias("levels"), F.concat(F.repeat(F.lit("  "), F.col("level").cast("int") - 1), F.lit("- "), name, F.coalesce(F.concat(F.lit(" ["), "grade", F.lit("]")), F.lit(""))).alias("line"))


def write_lines(df: DataFrame, path: str, *order: str) -> None:
    """Lines in order, as text files whose names sort as their lines do."""
    df.orderBy(*order).select("line").write.mode("overwrite").text(path)


def append_checkpoint(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def dead_letters(results: DataFrame, path: str) -> None:
    """The failed items with their errors, beside the results."""
    results.where("error is not null").write.mode("append").json(path)


def promote(df: DataFrame, folder: str, name: str, source_type: str = "curated", description: str = "") -> None:
    """A rule table into the library: its own subfolder of folder with the rows and their metadata, as sources.files.library reads them.

    Other libraries stay as they are. An empty table is refused. No reuse policy is written, so readers take the default.
    """
    if df.isEmpty():
        raise ValueError("an empty rule table can't be promoted")
    at = f"{folder.rstrip('/')}/{name}"
    spark = df.sparkSession
    df.write.mode("overwrite").json(f"{at}/rule_table")
    spark.createDataFrame([(name, source_type, description)], "name string, source_type string, description string").coalesce(1).write.mode("overwrite").json(f"{at}/metadata")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text as one file, put in place when it is whole, so that a reader never sees half of it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at, part = hadoop.Path(path), hadoop.Path(path + ".part")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(part, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    fs.delete(at, True)
    if not fs.rename(part, at):
        raise OSError(f"{part} can't be renamed to {at}")


def remove(spark: SparkSession, path: str) -> None:
    """A file or folder of an earlier run, if there is one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def level_name(i: int) -> str:
    return f"{LEVEL_FIGURES[i - 1]}级分类" if 1 <= i <= len(LEVEL_FIGURES) else f"第{i}级分类"


def table_markdown(rows: DataFrame, depth: int = 0) -> DataFrame:
    """ord and line of the rule table: a column for each level of the deepest path, or of depth if that is more, and the fixed columns. Rows in the order of ord."""
    none = F.array().cast("array<string>")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("")
    joined = lambda c, by: F.array_join(F.coalesce(F.col(c), none), by) if c in rows.columns else F.lit("")
    t = rows.withColumn("levels", F.coalesce("path_levels", none))
    n = max(depth, t.agg(F.max(F.size("levels"))).first()[0] or 0)
    fixed = [text("recommended_grade"), text("description"), joined("data_range_examples", "；"), *(text(c) for c in ("processing_degree", "impact_object", "impact_degree", "support_level", "row_source", "content_source", "inclusion_status", "evidence_status")), joined("original_path_levels", " / "), joined("reference_prefilled_fields", "；"), F.when(F.coalesce("needs_review", F.lit(False)), "yes").otherwise("no"), text("review_reason")]
    cells = [*(F.coalesce(F.get("levels", F.lit(i)), F.lit("")) for i in range(n)), *fixed]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *(cell(c) for c in cells)), F.lit(" |"))
    heads = [*(level_name(i + 1) for i in range(n)), *TABLE_COLUMNS]
    top = ["# Candidate Classification Table", "", "> This is a candidate output. It requires human review before use.", ""]
    top += [NO_TABLE] if rows.isEmpty() else ["| " + " | ".join(heads) + " |", "| " + " | ".join(["---"] * len(heads)) + " |"]
    head = rows.sparkSession.createDataFrame([(i - len(top), x) for i, x in enumerate(top)], "ord bigint, line string")
    return head.union(t.select(F.col("ord").cast("bigint"), line.alias("line")))


def quality_markdown(gate: DataFrame, groups: DataFrame) -> str:
    """A run's quality as text: its status, the counts, the reasons, and the rows by each category. gate: one line; groups: category, value, n, a few dozen lines."""
    one = gate.first().asDict()
    lines = ["# Run Quality", "", f"- Status: {one['status']}", *(f"- {k}: {v}" for k, v in one.items() if k not in ("status", "reasons"))]
    lines += ["", "## Reasons", "", *([f"- {r}" for r in one["reasons"].split(",") if r] or ["- none"])]
    for r in groups.orderBy("category", F.asc_nulls_first("value")).collect():
        lines += [] if f"## {r['category']}" in lines else ["", f"## {r['category']}", ""]
        lines.append(f"- {r['value']}: {r['n']}")
    return "\n".join(lines) + "\n"


def report_json(content: dict) -> str:
    """A report as JSON with sorted keys; numbers that JSON has no form for are refused."""
    def checked(x: object) -> object:
        if isinstance(x, float) and not math.isfinite(x):
            raise ValueError(f"{x} has no form in JSON")
        return x

    def walk(x: object) -> object:
        return {k: walk(v) for k, v in x.items()} if isinstance(x, dict) else [walk(v) for v in x] if isinstance(x, list | tuple) else checked(x)

    return json.dumps(walk(content), ensure_ascii=False, sort_keys=True, indent=2) + "\n"


def review_lines(rows: DataFrame, issues: DataFrame, most: int = 30) -> DataFrame:
    """part, k and line of a review report: issues of high severity first, then rows that ask for review; most of each, in order."""
    high = F.when(F.col("severity") == "high", 0).when(F.col("severity") == "medium", 1).otherwise(2)
    first = issues.select(high.alias("s"), "issue_id", F.concat(F.lit("- ["), "severity", F.lit("] "), F.coalesce("row_id", F.lit("-")), F.lit(": "), "problem").alias("line")).orderBy("s", "issue_id").limit(most).select(F.lit("issues").alias("part"), F.struct(F.col("s"), F.col("issue_id").alias("o")).alias("k"), "line")
    second = rows.where("needs_review").select(F.lit(0).alias("s"), F.lpad(F.col("ord").cast("string"), 20, "0").alias("o"), F.concat(F.lit("- "), F.array_join("path_levels", " / "), F.lit(": "), F.coalesce("review_reason", F.lit(""))).alias("line")).orderBy("o").limit(most).select(F.lit("rows").alias("part"), F.struct("s", "o").alias("k"), "line")
    return first.union(second)


def export(rows: DataFrame, nodes: DataFrame, issues: DataFrame, gate: DataFrame, path: str, profile: str = "deliverable") -> list[str]:
    """A run's results in a folder: the table and the tree as JSON and Markdown and the run's quality; with a full profile the issues and the review report too.

    What an earlier run of a fuller profile left there is removed. The names of what was written are returned.
    """
    path, spark = path.rstrip("/"), rows.sparkSession
    write_json(rows, f"{path}/rule_table.json")
    write_json(nodes, f"{path}/rule_tree.json")
    write_lines(table_markdown(rows), f"{path}/rule_table.md", "ord")
    write_lines(tree_lines(nodes), f"{path}/rule_tree.md", "levels")
    write_text(spark, f"{path}/run_quality.json", report_json(gate.first().asDict()))
    written = ["rule_table.json", "rule_tree.json", "rule_table.md", "rule_tree.md", "run_quality.json"]
    if profile.strip().lower() in FULL_PROFILES:
        write_json(issues, f"{path}/validation_issues.json")
        write_lines(review_lines(rows, issues), f"{path}/review_report.md", "part", "k")
        return [*written, "validation_issues.json", "review_report.md"]
    for name in ("validation_issues.json", "review_report.md"):
        remove(spark, f"{path}/{name}")
    return written


def element_library(elements: DataFrame, path: str) -> dict[str, int]:
    """Elements in a folder for each part, whatever was there replaced, and a manifest with the number of elements of each part and of all. elements: part and the fields of sources.files.elements."""
    path, spark = path.rstrip("/"), elements.sparkSession
    elements.write.mode("overwrite").partitionBy("part").json(f"{path}/parts")
    counts = {r["part"]: r["n"] for r in elements.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()}
    write_text(spark, f"{path}/manifest.json", report_json({"library_type": "data_element_library", "parts": [{"part": k, "element_count": n} for k, n in counts.items()], "total_elements": sum(counts.values())}))
    return counts


def write_cleaned(lines: DataFrame, path: str) -> None:
    """Cleaned lines as text, a folder for each document, and beside them the lines to look at. lines: doc_id, line_no, source_start, source_end, transform, text."""
    from .operators.lines import high_risk

    path = path.rstrip("/")
    lines.select("doc_id", "line_no", F.col("text").alias("value")).repartition("doc_id").sortWithinPartitions("doc_id", "line_no").select("doc_id", "value").write.mode("overwrite").partitionBy("doc_id").text(f"{path}/text")
    high_risk(lines).select("doc_id", "line_no", "source_start", "source_end", "transform", "preview").write.mode("overwrite").json(f"{path}/review")


def write_traces(traces: DataFrame, path: str) -> None:
    """What each step said, a folder for each step. traces: step, ord, text."""
    named = F.regexp_replace("step", r"[^\p{L}\p{N}_-]+", "_")
    traces.select(named.alias("step"), "ord", F.col("text").alias("value")).repartition("step").sortWithinPartitions("step", "ord").select("step", "value").write.mode("overwrite").partitionBy("step").text(path)


def suggestion_markdown(found: DataFrame, most: int = 50) -> str:
    """The suggestions of each tier as text, most of each tier. found: as quality.suggestions."""
    from pyspark.sql import Window

    w = Window.partitionBy("tier").orderBy(F.desc_nulls_last("score"), "reference_id", "current_id")
    t = found.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most).orderBy("tier", "k").collect()
    lines = ["# Reference Suggestions"]
    for tier in ("strong", "broad", "missing", "low_quality"):
        lines += ["", f"## {tier}", "", *([f"- {r['reference_id']}" + (f" <- {r['current_id']} ({r['score']})" if r["current_id"] else "") for r in t if r["tier"] == tier] or ["- none"])]
    return "\n".join(lines) + "\n"
