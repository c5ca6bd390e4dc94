import json

import pytest

from graincraft import sinks
from graincraft.sources import files, tables
from graincraft.streaming import ingest


def test_checkpoints_keep_broken_lines_as_data(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"batch_index": 1, "rows": ["a", "b"], "elapsed_seconds": 2.5}\n\nbroken\n{"batch_index": 2, "row_count": 7}\n')
    out = [(r.line_no, r.batch_index, r.n_rows, r.corrupt) for r in files.checkpoints(spark, str(tmp_path / "c.jsonl")).orderBy("line_no").collect()]
    assert out == [(1, 1, 2, False), (3, None, 0, True), (4, 2, 7, False)]


def test_rule_table_takes_either_key(spark, tmp_path):
    for name, key in (("a", "rows"), ("b", "classification_rows")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "rule_table.json").write_text(json.dumps({key: [{"row_id": name, "path_levels": ["x"], "unknown": 1}]}))
        (tmp_path / name / "metadata.json").write_text(json.dumps({"name": name.upper(), "source_type": "t"}))
    out = sorted((r.row_id, r.name, r.reuse_policy) for r in files.library(spark, str(tmp_path)).collect())
    assert out == [("a", "A", "assist"), ("b", "B", "assist")]


def test_text_documents_refuse_other_files(spark, tmp_path):
    (tmp_path / "a.md").write_text("# 一")
    assert [r.raw_text for r in files.text_documents(spark, str(tmp_path / "a.md")).collect()] == ["# 一"]
    with pytest.raises(ValueError):
        files.text_documents(spark, "a.pdf")


def test_elements(spark):
    text = "HX/T 1.2—2020\n数据元标识符 DE01.02.003.00\n数据元名称 姓名\n定义 一个\n名称\n表示格式 A..50\n数据元允许值 HX/T 364.3 CV01.02.003\n数据元标识符 DE01.02.004.00\n数据元名称 年龄\n"
    out = files.elements(spark.createDataFrame([(text,)], "raw_text string")).collect()
    assert [(r.element_code, r.element_name, r.definition, r.display_format, r.value_domain_refs) for r in out] == [("DE01.02.003.00", "姓名", "一个 名称", "A..50", ["HX/T 364.3:CV01.02.003"]), ("DE01.02.004.00", "年龄", "", "", [])]


def test_markdown_spreads_the_path(spark, tmp_path):
    df = spark.createDataFrame([(0, ["a", "b|c"], "x\ny"), (1, ["d"], None)], "ord int, levels array<string>, note string")
    sinks.write_lines(sinks.markdown_lines(df, "levels", ["note"]), str(tmp_path / "t"), "ord")
    lines = "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*"))).splitlines()
    assert lines == ["| level 1 | level 2 | note |", "| --- | --- | --- |", "| a | b\\|c | x<br>y |", "| d |  |  |"]


def test_promotion_adds_a_library_and_leaves_the_others(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.promote(spark.createDataFrame([], "row_id string"), str(tmp_path), "none")
    for name in ("one", "two"):
        sinks.promote(spark.createDataFrame([(name, ["x"])], "row_id string, path_levels array<string>"), str(tmp_path), name)
    (tmp_path / "three").mkdir()
    assert sorted((r.row_id, r.name, r.reuse_policy) for r in files.library(spark, str(tmp_path)).collect()) == [("one", "one", "assist"), ("two", "two", "assist")]
    (tmp_path / "three" / "metadata.json").write_text("{}")
    with pytest.raises(ValueError):
        files.library(spark, str(tmp_path))


def test_no_library(spark, tmp_path):
    assert files.library(spark, str(tmp_path / "none")).count() == 0


def test_null_keys_stay_one_per_content(spark):
    t = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 3), (None, 3)], "k string, v int")
    assert sorted(r.v for r in tables.one_per_key(t, "k").collect()) == [1, 2, 3]


def test_stream_counts_arriving_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("附录 A\n正文。\n")
    q = ingest.signal_counts(ingest.arriving(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("arrived").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.kind: r.n for r in spark.table("arrived").collect()} == {"appendix_heading": 1, "none": 1}
