import json

from graincraft.operators import answers as A
from graincraft.functions import text as X

CHUNKS = "chunk_id string, source_method string"


def read(spark, operator, key, *items, raw=None):
    text = raw if raw is not None else "note\n```json\n" + json.dumps({key: list(items)}, ensure_ascii=False) + "\n```"
    answers = spark.createDataFrame([("a", text), ("b", None), ("c", "no json")], "answer_id string, answer string")
    return operator(answers, spark.createDataFrame([("c1", "text"), ("c2", "ocr")], CHUNKS)).collect()


def test_rows_are_coerced_and_the_best_of_a_path_and_grade_kept(spark):
    weak = {"path_levels": [" 甲 ", "", 7], "recommended_grade": "2级", "description": "说明", "description_source": "odd", "support_level": "odd", "confidence": "x"}
    good = weak | {"evidence_chunk_ids": ["c1", "c1", "zz"], "support_level": "explicit", "description_source": "quoted", "confidence": 1.7, "row_role": "odd", "needs_review": "no"}
    out = read(spark, A.rows, "classification_rows", weak, good, {"path_levels": []}, {"path_levels": ["乙"], "description": None})
    got = {r.path_levels[0]: r for r in out}
    assert got.keys() == {"甲", "乙"} and got["甲"].path_levels == ["甲", "7"]
    a, b = got["甲"], got["乙"]
    assert (a.description_source, a.support_level, a.confidence, a.needs_review, a.status, a.chunk_ids, a.row_role) == ("quoted", "explicit", 1.0, False, "evidence_supported", ["c1"], "classification_detail")
    assert (b.description, b.description_source, b.needs_review, b.review_reason, b.status, b.confidence) == (X.INSUFFICIENT, "insufficient", True, A.NO_DESCRIPTION, "proposed", 0.65)


def test_claims_once_each_and_scans_to_be_reviewed(spark):
    c = {"claim_type": "definition", "subject": "甲", "value": "x", "support_level": "Explicit", "evidence_chunk_ids": ["c1"], "needs_review": False}
    out = read(spark, A.claims, "claims", c, c | {"evidence_quote": "later"}, c | {"claim_type": "odd"}, c | {"subject": " "}, c | {"subject": "乙", "evidence_chunk_ids": ["c2"]})
    got = {r.subject: r for r in out}
    assert got.keys() == {"甲", "乙"}
    assert (got["甲"].support_level, got["甲"].evidence_quote, got["甲"].needs_review, got["甲"].status) == ("explicit", "", False, "evidence_supported")
    assert (got["乙"].support_level, got["乙"].review_reason, got["乙"].confidence, got["乙"].status) == ("ocr", A.FROM_SCAN, 0.55, "proposed")


def test_grades_the_best_of_each_name(spark):
    g = {"grade_name": "1级", "definition": "", "criteria": ["a", " ", "b"]}
    out = read(spark, A.grades, "grade_definitions", g, g | {"definition": "低", "evidence_chunk_ids": ["c1"]}, {"definition": "无名"}, {"grade_name": "2级", "status": "evidence_supported", "definition": "x"})
    got = {r.grade_name: (r.definition, r.criteria, r.needs_review, r.review_reason, r.status) for r in out}
    assert got == {"1级": ("低", ["a", "b"], False, "", "evidence_supported"), "2级": ("x", [], True, A.NO_GRADE_EVIDENCE, "proposed")}


def test_answers_that_hold_nothing(spark):
    assert read(spark, A.rows, "classification_rows", raw='{"classification_rows": "none"}') == []
    assert read(spark, A.claims, "claims", raw='{"claims": [1, null, "x"]}') == []
