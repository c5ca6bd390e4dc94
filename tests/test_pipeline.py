import json

import pytest

from graincraft import pipeline, sinks
from graincraft.sources import files


def lines_of(folder):
    return "".join(p.read_text() for p in sorted(folder.glob("part-*"))).splitlines()


def test_a_run_from_text_to_tables(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("# 目录\n\n| 基础资源 | 患者信息 | 2级 |\n| 基础资源 | 医师信息 | 3级 |\n")
    out = tmp_path / "out"
    assert "review_report.md" in pipeline.main([str(tmp_path / "in" / "*.md"), str(out), "--profile", "full"])
    table = lines_of(out / "rule_table.md")
    assert table[4].startswith("| 一级分类 | 二级分类 | 推荐分级 |") and len(table) == 8
    assert lines_of(out / "rule_tree.md") == ["- 基础资源", "  - 医师信息 [3级]", "  - 患者信息 [2级]"]
    assert json.loads((out / "run_quality.json").read_text())["status"] == "passed"
    assert [json.loads(x)["status"] for x in lines_of(out / "trace.json")] == ["success"] * 3
    assert "review_report.md" not in pipeline.main([str(tmp_path / "in" / "*.md"), str(out)]) and not (out / "review_report.md").exists()


def test_a_failing_step_is_traced(spark):
    trace = pipeline.Trace()
    with pytest.raises(ZeroDivisionError):
        pipeline.run({}, {"bad": lambda s: 1 / 0}, trace)
    assert [(s["step"], s["status"]) for s in trace.steps] == [("bad", "failed")]


def test_reports_refuse_what_json_cannot_hold():
    with pytest.raises(ValueError):
        sinks.report_json({"a": [float("nan")]})
    assert sinks.report_json({"b": 1, "a": "二"}) == '{\n  "a": "二",\n  "b": 1\n}\n'


def test_an_empty_table_says_so(spark):
    rows = spark.createDataFrame([], "ord int, path_levels array<string>, needs_review boolean")
    assert [r.line for r in sinks.table_markdown(rows).orderBy("ord").collect()][-1] == sinks.NO_TABLE


def test_element_parts(spark, tmp_path):
    entry = "数据元标识符 DE01.02.00{0}.00\n数据元名称 名{0}\n"
    for n in (1, 2):
        (tmp_path / f"p{n}.txt").write_text(f"HX/T 363.{n}—2023\n" + entry.format(n))
    found = files.element_files(spark, str(tmp_path / "p*.txt"))
    assert sinks.element_library(found, str(tmp_path / "lib")) == {"1": 1, "2": 1}
    assert json.loads((tmp_path / "lib" / "manifest.json").read_text())["total_elements"] == 2
    assert sorted((r.element_code, r.element_name, r.part) for r in files.element_lookup(spark, str(tmp_path / "lib")).collect()) == [("DE01.02.001.00", "名1", "1"), ("DE01.02.002.00", "名2", "2")]
    (tmp_path / "p3.txt").write_text("HX/T 363.1—2023\n")
    with pytest.raises(ValueError):
        files.element_files(spark, str(tmp_path / "p*.txt"))


def test_saved_run_and_specs(spark, tmp_path):
    (tmp_path / "checkpoints").mkdir()
    for n in ("rule_table.json", "my_row_x_checkpoint_1.jsonl", "checkpoints/evidence_claims.jsonl", "checkpoints/evidence_checkpoint.jsonl"):
        (tmp_path / n).write_text("{}")
    found = files.saved_run(spark, str(tmp_path))
    assert {k: v.removeprefix(str(tmp_path) + "/") for k, v in found.items()} == {"table": "rule_table.json", "rows": "my_row_x_checkpoint_1.jsonl", "evidence": "checkpoints/evidence_checkpoint.jsonl"}
    assert files.saved_run(spark, str(tmp_path / "none")) == {}
    assert files.reference_spec("s3://a:b:curated:名") == ("s3://a:b", "curated", "名")
    with pytest.raises(ValueError):
        files.reference_spec("a:b")


def test_cleaned_text_and_traces(spark, tmp_path):
    lines = spark.createDataFrame([("d", 2, 2, 6, "merge_wrapped_row", "二"), ("d", 1, 1, 1, "preserve", "一")], "doc_id string, line_no int, source_start int, source_end int, transform string, text string")
    sinks.write_cleaned(lines, str(tmp_path / "c"))
    assert lines_of(tmp_path / "c" / "text" / "doc_id=d") == ["一", "二"] and len(lines_of(tmp_path / "c" / "review")) == 1
    sinks.write_traces(spark.createDataFrame([("a/b", 1, "x")], "step string, ord int, text string"), str(tmp_path / "t"))
    assert lines_of(tmp_path / "t" / "step=a_b") == ["x"]
