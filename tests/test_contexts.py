from graincraft.operators import rows as R


def test_units_of_the_whole_document_top_five(spark):
    text = "\n".join(["引言", "", "说明"] + ["101门诊 数据", "明细", "表A1"] + ["门 诊"] * 3 + ["门诊登记"] * 12)
    rows = spark.createDataFrame(
        [("a", ["资源", "门诊"], None, [("c1",)], None, None, None, "三级"), ("b", ["资源", "门诊"], None, None, None, None, None, None), ("c", ["无"], [], [("c1",), ("c2",)], None, None, None, None)],
        "row_id string, path_levels array<string>, data_range_examples array<string>, evidence_refs array<struct<chunk_id:string>>, processing_degree string, impact_object string, impact_degree string, recommended_grade string",
    )
    chunks = spark.createDataFrame([("c1", "d1"), ("c2", "d1")], "chunk_id string, doc_id string")
    documents = spark.createDataFrame([("d1", text), ("d2", "门诊"), ("d3", None)], "doc_id string, raw_text string")
    out = [(r.row_id, r.doc_id, r.unit_id, r.score) for r in R.contexts(rows, chunks, documents).orderBy("row_id", "rank").collect()]
    assert out == [("a", "d1", u, 3) for u in ("txt_table_row_4_5", "txt_lines_4_6", "txt_lines_7_9", "txt_lines_10_12", "txt_lines_13_15")]
