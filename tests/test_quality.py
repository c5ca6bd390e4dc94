from graincraft.operators import quality as Q
from graincraft.operators import rows as R

ROW = "row_id string, ord int, path_levels array<string>, row_role string, review_reason string, description_source string, recommended_grade string, data_range_examples array<string>, support_level string, needs_review boolean, evidence_quote string, evidence_refs array<struct<text:string,section_title:string>>"


def table(spark, *rows):
    names = [x.split()[0] for x in ROW.split(", ")]
    return spark.createDataFrame([tuple({"row_id": f"r{i}", "ord": i, **r}.get(n) for n in names) for i, r in enumerate(rows)], ROW)


def test_roles(spark):
    thin = dict(description_source="insufficient")
    t = table(spark, dict(path_levels=["甲", "乙"]), dict(path_levels=["甲"], review_reason="仅含分类标题", **thin), dict(path_levels=["丙"], review_reason="仅含分类标题", **thin), dict(path_levels=["丁"], review_reason="文本断裂", support_level="structural", **thin), dict(path_levels=["术语"]), dict(path_levels=["戊"], row_role="grading_criterion"), dict(path_levels=None))
    assert {r.row_id: r.role for r in Q.roles(t).collect()} == {"r0": "classification_detail", "r1": "structural_heading", "r2": "classification_detail", "r3": "structural_heading", "r4": "definition_term", "r5": "grading_criterion"}


def test_gate_names_its_reasons_in_order(spark):
    t = table(spark, dict(description_source="insufficient"), dict(description_source="quoted"))
    assert Q.gate(t, 3, 2, 0, 1).first().reasons == "classification_rows_below_min,quoted_descriptions_below_min,insufficient_descriptions_above_max,reference_prefilled_rows_below_min"
    assert Q.gate(t).first().status == "passed" and Q.gate(t.where("false"), 1).first().status == "degraded"


def test_eval_metrics(spark):
    t = table(spark, dict(path_levels=["项目", "占位"], evidence_refs=[("附录 A 表 1", "总则")]), dict(path_levels=["甲"], needs_review=True, evidence_quote="x", evidence_refs=[("（续）", None)]), dict(path_levels=["甲"]), dict(path_levels=None))
    issues = spark.createDataFrame([("High",), ("high",), (None,)], "severity string")
    got = {r.metric: r.n for r in Q.eval_metrics(t, issues).collect()}
    assert got == {"rows": 4, "unique_paths": 2, "duplicate_paths": 1, "needs_review": 1, "missing_quote": 3, "missing_refs": 2, "header_as_path": 0, "generic_fragment": 1, "stale_section": 1, "appendix_table": 1, "continued_table": 1, "issues_high": 2, "issues_unknown": 1}


def test_signal_scores(spark):
    cases = spark.createDataFrame([("附录 A", "appendix_heading", "附录 A"), ("正文。", None, None), ("附录 B", None, None), ("正文。", "table_title", None), ("附录 C", "table_title", None)], "line string, expected_kind string, expected_title string")
    r = Q.signal_scores(cases).first()
    assert (r.total, r.matched, r.false_positive, r.false_negative, r.kind_mismatch, r.title_mismatch, r.accuracy) == (5, 2, 1, 1, 1, 0, 0.4)


def test_suggestions(spark):
    links = spark.createDataFrame([("c1", "l1", 0.9, "x", 1), ("c2", "l2", 0.6, "x", 1)], "current_id string, reference_id string, score double, shared string, rank int")
    library = spark.createDataFrame([("l1", ["甲"]), ("l2", ["乙"]), ("l3", ["丙", "丁"]), ("l4", ["预案"]), ("l5", [])], "reference_id string, levels array<string>")
    assert sorted((r.reference_id, r.tier) for r in Q.suggestions(links, library).collect()) == [("l1", "strong"), ("l3", "missing"), ("l4", "low_quality"), ("l5", "low_quality")]


def test_suggestions_read_links_that_are_made_once(spark):
    a = spark.createDataFrame([(f"a{i}", ["k", "x"]) for i in range(2)], "current_id string, terms array<string>")
    b = spark.createDataFrame([("b0", ["k", "x"]), ("b1", ["z"])], "reference_id string, terms array<string>")
    library = spark.createDataFrame([("b0", ["k", "x"]), ("b1", ["预案"])], "reference_id string, levels array<string>")
    out = Q.suggestions(R.term_links(a, b), library)
    assert sorted((r.reference_id, r.current_id or "", r.tier) for r in out.collect()) == [("b0", "a0", "strong"), ("b0", "a1", "strong"), ("b1", "", "low_quality")]
    assert out._jdf.queryExecution().analyzed().toString().count("Join ") == 2


def test_suggestions_need_no_more_pairs_of_sets_than_rows(spark, monkeypatch):
    written = {}

    def spied(df, label="step", real=R.materialise):
        written.setdefault(label, []).append(real(df, label))
        return written[label][-1]

    monkeypatch.setattr(R, "materialise", spied)
    a = spark.createDataFrame([("a", ["k", "x"])], "current_id string, terms array<string>")
    b = spark.createDataFrame([(f"b{i:02}", ["k", "x", f"y{i}"]) for i in range(20)] + [("b99", ["k", "x"])] + [(f"c{i:02}", ["k", "x", "z", f"z{i}"]) for i in range(20)], "reference_id string, terms array<string>")
    # sets are told apart by terms that both sides have
    more = spark.createDataFrame([(f"m{i}", [f"y{i}", f"z{i}", *(f"m{i}_{k}" for k in range(9))]) for i in range(20)], "current_id string, terms array<string>")
    out = Q.suggestions(R.term_links(a.union(more), b, told=False), b.withColumnRenamed("terms", "levels"))
    assert [(r.reference_id, r.current_id, r.tier) for r in out.where("current_id is not null").collect()] == [("b99", "a", "strong")]
    assert out.where("current_id is null").count() == 38
    assert [df.count() for df in written["links_pairs"]] == [3]
    assert written["links"][0].columns == ["current_id", "reference_id", "score", "rank"]
