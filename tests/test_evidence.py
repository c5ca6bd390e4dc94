from graincraft.operators import evidence as V
from pyspark.sql import functions as F

CHUNKS = "chunk_id string, doc_name string, section_title string, text string, source_method string, row_id string"
ROWS = "row_id string, path_levels array<string>, description string, description_evidence_quote string, evidence_quote string, grade_evidence_quote string, data_range_examples array<string>, evidence_refs array<struct<chunk_id string, text string>>"


def test_references_keep_the_first_and_cap_recognised_text(spark):
    chunks = spark.createDataFrame([("c1", "d", None, "甲", "text", "x"), ("c2", "d", None, None, "ocr", "x")], CHUNKS)
    wanted = spark.createDataFrame([("r", ["c2", "c1", "c2", "gone", None]), ("s", None)], "row_id string, chunk_ids array<string>")
    out = sorted((r.ord, r.chunk_id, r.relevance_score) for r in V.references(wanted, chunks).collect())
    assert out == [(0, "c2", 0.68), (1, "c1", 0.9)]


def test_signals_default_to_normal(spark):
    chunks = spark.createDataFrame([("c1",), ("c2",), ("c3",)], "chunk_id string")
    signals = spark.createDataFrame([("c1", 1, "normal"), ("c1", 2, "table_like"), ("c2", 1, "odd")], "chunk_id string, ord int, block_signal string")
    out = {r.chunk_id: (r.block_signal, r.signal_review) for r in V.with_signals(chunks, signals).collect()}
    assert out == {"c1": ("table_like", False), "c2": ("normal", True), "c3": ("normal", False)}


def test_structure_context_takes_the_last_of_each(spark):
    df = spark.createDataFrame([("附录 A / 健康数据分类 / 表 B.1 甲 / 表 B.2 乙", "类  项  目"), (None, None)], "s string, h string")
    a, b = [r.c for r in df.select(V.structure_context(F.col("s"), F.col("h")).alias("c")).collect()]
    assert tuple(a) == ("附录 A", "健康数据分类", "表 B.2 乙", "类 项 目") and tuple(b) == ("", "", "", "")


def rows(spark, *items):
    base = dict(row_id="r", path_levels=["0101 姓名"], description="说明文字", description_evidence_quote=None, evidence_quote="长的引用。", grade_evidence_quote=None, data_range_examples=None, evidence_refs=[])
    return spark.createDataFrame([tuple((base | x)[k.split()[0]] for k in ("row_id path_levels description description_evidence_quote evidence_quote grade_evidence_quote data_range_examples evidence_refs".split())) for x in items], ROWS)


def test_description_policy(spark):
    t = rows(spark, dict(row_id="a", description="姓名。"), dict(row_id="b", evidence_quote="0101 姓名"), dict(row_id="c", evidence_quote="一般数据涉及10万人及以上"), dict(row_id="d", path_levels=["0199其他"]), dict(row_id="e"), dict(row_id="f", path_levels=[]))
    assert {r.row_id: r.reason for r in V.description_policy(t).collect()} == {"a": "repeats_label", "b": "label_only_quote", "c": "general_grading_rule", "d": "fallback_leaf"}


def test_evidence_pack_keeps_each_text_once(spark):
    t = rows(spark, dict(evidence_refs=[("c", "甲 乙"), ("c", "甲乙"), ("c", "数据级别2级"), ("c", None)], grade_evidence_quote="2级"), dict(row_id="x", path_levels=None))
    assert sorted((r.role, r.text) for r in V.evidence_pack(t).collect()) == [("description", "0101 姓名"), ("description", "甲 乙"), ("excluded", "数据级别2级"), ("grading", "2级")]


def test_empty_tables(spark):
    assert V.description_policy(rows(spark)).count() == V.evidence_pack(rows(spark)).count() == 0
