"""Evidence around rows and segments: references from chunk ids, signals with defaults, structure context, description policy, evidence packs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .rows import with_path

# Signals of blocks, scores of references, markers of empty data ranges, terms of general grading rules.
BLOCK_SIGNALS = ("table_like", "hierarchy_like", "grade_legend", "prose_rule", "normal", "possible_noise")
OCR_CAP = 0.68
EMPTY_RANGES = ("", "-", "—", "－", "一")
GRADE_TERMS = "核心数据|重要数据|一般数据|敏感个人信息|个人信息"
THRESHOLD_TERMS = "万人|及以上|特定群体|特定区域|国家安全|公共健康"


def references(wanted: DataFrame, chunks: DataFrame, used_for: str = "classification_row", score: float = 0.9) -> DataFrame:
    """row_id, ord, evidence_id, chunk_id, doc_name, section_title, text and relevance_score of each known chunk a row names, the first time only.

    wanted: row_id and chunk_ids. Unknown ids are dropped; a reference to recognised text is capped.
    """
    ids = wanted.select("row_id", F.posexplode("chunk_ids").alias("pos", "chunk_id")).where("chunk_id is not null").groupBy("row_id", "chunk_id").agg(F.min("pos").alias("ord"))
    known = ids.join(chunks.select("chunk_id", "doc_name", "section_title", "text", "source_method"), "chunk_id")
    capped = F.when(F.col("source_method") == "ocr", F.least(F.lit(score), F.lit(OCR_CAP))).otherwise(F.lit(score))
    return known.select("row_id", "ord", X.stable_id("ev", F.col("chunk_id"), F.lit(used_for), F.coalesce("text", F.lit(""))).alias("evidence_id"), "chunk_id", "doc_name", "section_title", "text", X.confidence(capped).alias("relevance_score"))


def with_signals(chunks: DataFrame, signals: DataFrame) -> DataFrame:
    """Each chunk with its block signal; one that none is given for, or an unknown one, is normal and, if unknown, to be reviewed. The last of several counts.

    signals: chunk_id, ord, block_signal.
    """
    last = signals.groupBy("chunk_id").agg(F.max(F.struct("ord", "block_signal"))["block_signal"].alias("given"))
    known = F.col("given").isin(*BLOCK_SIGNALS)
    return chunks.join(last, "chunk_id", "left").withColumns({"block_signal": F.when(known, F.col("given")).otherwise("normal"), "signal_review": F.coalesce(~known, F.lit(False))}).drop("given")


def structure_context(section: Column, header: Column) -> Column:
    """The appendix, classification and table named in a section title, the last of each, and the hierarchy header."""
    parts = F.transform(F.filter(F.transform(F.split(F.coalesce(section, F.lit("")), "/"), X.strip), lambda x: x != ""), X.structure_signal)

    def last(found: Column, *kinds: str) -> Column:
        hits = F.filter(found, lambda s: s.isNotNull() & s["kind"].isin(*kinds))
        return F.when(F.size(hits) > 0, F.try_element_at(hits, F.lit(-1))["title"]).otherwise("")

    head = X.structure_signal(F.coalesce(header, F.lit("")))
    hierarchy = F.when(head["kind"] == "hierarchy_header", head["title"]).otherwise("")
    return X.let(parts, lambda p: F.struct(last(p, "appendix_heading").alias("appendix_heading"), last(p, "classification_title").alias("classification_title"), last(p, "table_title", "continued_table_title").alias("table_title"), hierarchy.alias("hierarchy_header")))


def content_type(text: Column) -> Column:
    """What a table holds: grading, a catalogue, guidance on rules, or unknown."""

    def judged(x: Column) -> Column:
        t, bare = x["t"], x["bare"]
        holds = lambda c, *words: F.forall(F.array(*map(F.lit, words)), lambda w: c.contains(w))
        grading = holds(bare, "数据范围及示例", "影响程度", "数据级别") | holds(t, "分类分级表", "数据级别")
        catalogue = holds(bare, "类", "项", "目") | t.contains("分类目录")
        return F.when(grading, "classification_grading_table").when(catalogue, "classification_catalog").when(t.rlike(r"分类工作|分级工作|按照第[0-9]+章|参考附录|指南"), "rule_guidance").otherwise("unknown")

    return X.let(X.let(F.coalesce(text, F.lit("")), lambda t: F.struct(t.alias("t"), X.compact(t).alias("bare"))), judged)


def segment_report(segments: DataFrame) -> DataFrame:
    """Each segment with its content type, flattened lines and whether it needs a look. segments: as of lines.segments."""
    flat = F.size(F.filter(F.split("text", "\n"), X.flattened_hint))
    kind = content_type(F.concat_ws("\n", "header_text", "text"))
    t = segments.withColumns({"content_type": kind, "flattened_lines": flat})
    return t.withColumn("reviewable", (F.col("header_text") == "") | (F.col("content_type") == "unknown") | (F.col("flattened_lines") > 0))


# Fixed value: the marks that labels are compared without.
LABEL_MARKS = r"[，,。；;：:、/\\|（）()〈〉<>《》\"'“”‘’\[\]【】.\-—－_]+"


def clean_label(c: Column) -> Column:
    """A label without white space, marks and numbers."""
    bare = F.regexp_replace(X.compact(F.coalesce(c, F.lit(""))), LABEL_MARKS, "")
    return F.regexp_replace(bare, r"[0-9]+", "")


def description_policy(df: DataFrame) -> DataFrame:
    """row_id and reason of each row whose description can't stand: it repeats a label, its quote is only labels, its quote is a general grading rule, or the leaf is a catch-all without examples."""
    t = with_path(df)
    labels = F.filter(F.transform("levels", clean_label), lambda x: x != "")
    quote, told = clean_label(F.col("evidence_quote")), clean_label(F.col("description"))
    only = (quote != "") & (F.array_contains(labels, quote) | (F.size(labels) > 0) & (quote == clean_label(F.array_join("levels", ""))))
    bare_quote = X.compact(F.coalesce("evidence_quote", F.lit("")))
    general = bare_quote.rlike(GRADE_TERMS) & bare_quote.rlike(THRESHOLD_TERMS)
    examples = F.exists(F.coalesce("data_range_examples", F.array().cast("array<string>")), lambda x: ~X.compact(F.coalesce(x, F.lit(""))).isin(*EMPTY_RANGES))
    fallback = F.regexp_replace(X.compact(F.try_element_at("levels", F.lit(-1))), "[“\"']", "").rlike("^[0-9]{3,4}其他$") & ~examples
    reason = F.when((told != "") & F.array_contains(labels, told), "repeats_label").when(only, "label_only_quote").when(general, "general_grading_rule").when(fallback, "fallback_leaf")
    return t.select("row_id", reason.alias("reason")).where("reason is not null")


def evidence_pack(df: DataFrame) -> DataFrame:
    """row_id, role and text of what speaks for a row's description, for its grade, and what is kept out of descriptions, each text once for each role."""
    t = with_path(df)

    def branch(role: str, c: Column) -> DataFrame:
        return t.select("row_id", F.lit(role).alias("role"), c.alias("text")).where("text is not null and text <> ''")

    refs = t.select("row_id", F.explode("evidence_refs").alias("r")).select("row_id", F.when(X.grade_or_risk(F.col("r.text")), "excluded").otherwise("description").alias("role"), F.col("r.text").alias("text")).where("text is not null and text <> ''")
    grade = F.coalesce("grade_evidence_quote", F.when(X.grade_or_risk(F.col("evidence_quote")), F.col("evidence_quote")))
    packed = branch("description", F.try_element_at("levels", F.lit(-1))).union(branch("description", F.col("description_evidence_quote"))).union(branch("grading", grade)).union(refs)
    return packed.groupBy("row_id", "role", X.compact(F.col("text")).alias("bare")).agg(F.min("text").alias("text")).select("row_id", "role", "text")


def flattened_pack(packs: DataFrame, most: int = 5) -> DataFrame:
    """The contexts a row is shown: its best table rows, definitions and siblings in this order, each text once. packs: row_id, kind, rank, text."""
    place = F.when(F.col("kind") == "table_row_unit", 0).when(F.col("kind") == "definition_unit", 1).otherwise(2)
    once = packs.where("kind <> 'negative_unit'").groupBy("row_id", X.compact(F.col("text")).alias("bare")).agg(F.min(F.struct(place.alias("place"), "rank", "text")).alias("m"))
    w = Window.partitionBy("row_id").orderBy("m.place", "m.rank", "m.text")
    return once.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most).select("row_id", "k", F.col("m.text").alias("text"))
