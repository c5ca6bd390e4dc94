from graincraft.operators import grounding as G

SCHEMA = "row_id string, ord int, path_levels array<string>, original_path_levels array<string>, recommended_grade string, description string, description_source string, description_evidence_quote string, evidence_quote string, evidence_refs array<struct<text:string>>, grade_evidence_quote string, support_level string, needs_review boolean, evidence_status string, inclusion_status string"
GOOD = dict(path_levels=["甲", "乙"], recommended_grade="2级", description="说明", description_source="quoted", description_evidence_quote="说明", evidence_quote="甲乙 2级", evidence_refs=[("甲 乙2级，说明",)], support_level="explicit", needs_review=False)


def found(spark, *rows, texts=("甲、乙。", "别处")):
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    data = [tuple({"row_id": f"r{i}", "ord": i, **r}.get(n) for n in names) for i, r in enumerate(rows)]
    out = G.issues(spark.createDataFrame(data, SCHEMA), spark.createDataFrame([(t,) for t in texts], "text string"))
    return sorted((r.row_id or "", r.rule) for r in out.collect())


def test_a_grounded_row_breaks_nothing(spark):
    assert found(spark, GOOD) == []


def test_no_rows(spark):
    assert found(spark) == [("", "no rows")]


def test_an_empty_row_breaks_the_rules_on_what_is_missing(spark):
    assert found(spark, dict(support_level="?")) == [("r0", x) for x in ("description source", "description without quote", "empty path", "no evidence", "no quote", "support level")]


def test_each_strange_level_is_an_issue(spark):
    assert found(spark, GOOD | dict(path_levels=["甲", "丙", "丁", "（）"])) == [("r0", "level not in documents")] * 3
    assert found(spark, GOOD | dict(path_levels=["甲-乙", " 甲 "])) == []


def test_a_path_seen_before_and_rows_that_wait_for_review(spark):
    waiting = GOOD | dict(path_levels=["无"], evidence_refs=None, evidence_status="reference_only", inclusion_status="review_candidate")
    assert found(spark, waiting, waiting) == [("r1", "path seen before")]


def test_quotes_without_references_are_looked_up_in_the_documents(spark):
    bare = GOOD | dict(evidence_refs=[], evidence_quote="甲；2级", description_evidence_quote="别 处")
    assert found(spark, bare) == [("r0", "no evidence"), ("r0", "quote not in evidence")]


def test_parts_of_a_quote_may_lie_in_several_references_but_not_those_of_a_grade(spark):
    row = GOOD | dict(evidence_refs=[("甲乙",), ("2级说明",)], evidence_quote="甲乙2级", grade_evidence_quote="乙2级")
    assert found(spark, row) == [("r0", "grade quote not in evidence")]


def test_blocks_of_needles_find_the_same(spark):
    needles = spark.createDataFrame([(x,) for x in ("甲乙", "乙丙", "丁", "戊己", "")], "needle string")
    texts = spark.createDataFrame([("甲乙丙",), (None,), ("戊 己丁",)], "text string")
    assert sorted(r.needle for r in G.held(needles, texts, 2).collect()) == sorted(r.needle for r in G.held(needles, texts).collect()) == ["丁", "乙丙", "甲乙"]
