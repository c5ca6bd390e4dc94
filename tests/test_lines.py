from graincraft.operators import context as C
from graincraft.operators import extract as E
from graincraft.operators import lines as L
from graincraft.operators import metrics as M
from graincraft.functions import fuzzy
from graincraft.functions import text as X
from pyspark.sql import functions as F


def test_explode_counts_lines_of_any_end(spark):
    df = spark.createDataFrame([("a", "x\r\ny\rz\n"), ("b", ""), ("c", None)], "doc_id string, text string")
    assert [(r.doc_id, r.line_no, r.line) for r in L.explode_lines(df).orderBy("doc_id", "line_no").collect()] == [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "z")]


def test_clean_drops_noise_and_merges(spark):
    df = spark.createDataFrame([("d", "甲\n乙\n- 3 -\n0101 姓名 说明\n续写\n末行。")], "doc_id string, text string")
    out = [(r.source_start, r.source_end, r["transform"], r.text) for r in L.clean_lines(L.explode_lines(df)).orderBy("line_no").collect()]
    assert out == [(1, 2, "merge_single_char", "甲乙"), (4, 6, "merge_wrapped_row", "0101 姓名 说明 续写 末行。")]


def test_structure_signals(spark):
    df = spark.createDataFrame([("附 录 Ａ",), ("表 B.2 分类",), ("续表 B.2 分类",), ("健康数据分类",), ("1. 总则",), ("正文。",)], "line string")
    assert [r.k for r in df.select(X.structure_signal(F.col("line"))["kind"].alias("k")).collect()] == ["appendix_heading", "table_title", "continued_table_title", "classification_title", "not_appendix_body", None]


def test_sections_follow_headings(spark):
    df = spark.createDataFrame([("d", 1, "附录 A\n健康数据分类\n正文一。\n\n正文二。\n- 项"), ("d", 2, "附录 B\n末段。")], "doc_id string, page_number int, text string")
    out = [(r.position, r.section_title, r.text) for r in L.chunk(df).orderBy("position").collect()]
    assert out == [(1, "附录 A", "附录 A"), (2, "附录 A / 健康数据分类", "健康数据分类"), (3, "附录 A / 健康数据分类", "正文一。"), (4, "附录 A / 健康数据分类", "正文二。"), (5, "附录 A / 健康数据分类", "- 项"), (6, "附录 B", "附录 B"), (7, "附录 B", "末段。")]


def test_batches_close_before_the_budget(spark):
    sizes = [40, 40, 40, 150, 10, 90]
    df = spark.createDataFrame([("g", i, n) for i, n in enumerate(sizes)], "g string, i int, n int")
    out = [r.batch for r in L.batches(df, "g", ["i"], F.col("n"), 100).orderBy("i").collect()]
    assert out == L.cut_by_count_and_budget(sizes, 9, 100) == [0, 0, 1, 2, 3, 3]


def test_batches_close_by_count_and_leave_a_larger_item_alone(spark):
    assert L.cut_by_count_and_budget([10, 10, 10, 500, 10], 2, 100) == [0, 0, 1, 2, 3]
    assert L.cut_by_count_and_budget([10, 500, 7], 2, 0) == [0, 0, 1]
    assert L.cut_by_count_and_budget([], 2, 100) == []
    df = spark.createDataFrame([("g", None, "b", None), ("g", None, "a", 3), (None, 1, "c", 4)], "g string, p int, i string, n int")
    assert sorted((r.i, r.batch) for r in L.batches(df, "g", ["p", "i"], F.col("n"), 100).collect()) == [("a", 0), ("b", 0), ("c", 0)]


def test_headings_and_list_lines(spark):
    lines = ["## 总则", "一．目的", "二. 范围", "3、术语", "3 术语", "1.2.3. 数据", "附 录 Ａ", "正文", "- 项", "+ 项", "1. 项", "2) 项", "（1）项"]
    t = spark.createDataFrame([(x,) for x in lines], "line string")
    out = t.select("line", X.is_heading(F.col("line")).alias("h"), X.heading_title(F.col("line")).alias("t"), X.is_list_line(F.col("line")).alias("l")).collect()
    assert [r.line for r in out if r.h] == ["## 总则", "一．目的", "二. 范围", "3、术语", "1.2.3. 数据", "附 录 Ａ", "1. 项"]
    assert [r.t for r in out if r.h] == ["总则", "目的", "范围", "术语", "数据", "附录 A", "项"]
    assert [r.line for r in out if r.l] == ["- 项", "+ 项", "1. 项", "2) 项"]


def test_segments_carry_the_header(spark):
    df = spark.createDataFrame([("c", "引言\n类  项  目\n" + "甲" * 30 + "\n乙")], "chunk_id string, text string")
    out = [(r.segment, r.header_text, r.text) for r in L.segments(df, 20).orderBy("segment").collect()]
    assert out == [(0, "", "引言"), (1, "类 项 目", "甲" * 20), (2, "类 项 目", "甲" * 10 + "\n乙")]


def test_flattened_hint(spark):
    df = spark.createDataFrame([("1.2 甲 1.2.3 乙",), ("1.2 甲 1.3 乙",)], "line string")
    assert [r.x for r in df.select(X.flattened_hint(F.col("line")).alias("x")).collect()] == [True, False]


def test_extraction_retries_and_dead_letters(spark):
    df = spark.createDataFrame([("b", "s1", "| 甲 | 乙 | 2级 |"), ("b", "s2", "坏")], "batch string, segment_id string, text string")

    def moody(segments):
        return "no" if len(segments) > 1 or segments[0][1] == "坏" else E.table_rows(segments)

    out = {r.segment_id: (r.levels, r.grade, r.error) for r in E.extracted(df, moody).collect()}
    assert out == {"s1": (["甲", "乙"], "2级", None), "s2": ([], None, "no JSON object")}


def test_resume_extracts_only_what_changed(spark):
    df = spark.createDataFrame([("1", "s1", "a|b|c"), ("2", "s2", "d|e|f")], "batch string, segment_id string, text string")
    cache = L.signature(df.where("batch = '1'"), ["batch"], "segment_id", "segment_id", "text").drop("batch")
    fresh, kept = E.resumed(df, cache)
    assert [r.segment_id for r in fresh.collect()] == ["s2"] and kept.count() == 1


def test_checkpoint_metrics(spark):
    df = spark.createDataFrame([(1, 1, 2, 3, 1.5), (1, 2, 2, 4, 4.0), (2, 3, 2, 5, 5.0), (None, 4, 2, 9, 1.0)], "batch_index int, line_no int, batch_count int, n_rows int, elapsed_seconds double")
    r = M.checkpoint_metrics(df).collect()[0]
    assert (r.completed, r.total_rows, r.total_seconds, r.slowest, r.appears_complete) == (2, 9, 9.0, "2,1", True)


def test_fuzzy(spark):
    df = spark.createDataFrame([("患者 的 姓 名", "患者姓名"), ("甲", "乙"), (None, "")], "t string, n string")
    assert [r.x for r in df.select(fuzzy.holds_loosely("t", "n").alias("x")).collect()] == [True, False, False]


def test_cleaner_keeps_headings_and_splits_what_is_glued(spark):
    text = "1 范围\n正文\n001 患者信息\n续行。\n2 术语和定义\nA、基础资源 1 人员 其余\n交通等3 法律法规 01 条文"
    t = L.explode_lines(spark.createDataFrame([("d", text)], "doc_id string, raw_text string"), "raw_text", ("doc_id",))
    out = [(r.source_start, r.source_end, r.transform, r.text) for r in L.clean_lines(t).orderBy("line_no").collect()]
    assert out == [
        (1, 1, "preserve", "1 范围"),
        (2, 2, "preserve", "正文"),
        (3, 4, "merge_wrapped_row", "001 患者信息 续行。"),
        (5, 5, "preserve", "2 术语和定义"),
        (6, 6, "split_glued_heading", "A、基础资源"),
        (6, 6, "split_glued_heading", "1 人员 其余"),
        (7, 7, "split_glued_heading", "交通等"),
        (7, 7, "split_glued_heading", "3 法律法规 01 条文"),
    ]
