from graincraft.operators import context as C


def units(spark, *lines):
    t = spark.createDataFrame([("d", "\n".join(lines)), ("e", None), ("f", "")], "doc_id string, raw_text string")
    return [(r.kind.removesuffix("_unit"), r.text, r.line_start, r.line_end, r.table_title, r.path_hint) for r in C.units(t).orderBy("line_start", "kind").collect()]


def test_rows_take_their_lines_and_siblings_a_group(spark):
    out = units(spark, "表A.1 目录", "基础数据：指登记的数据", "01基础资源", "01人员", "001患者 姓名", "续行", "002医师", "影响程度 一般", "003药品")
    assert out == [
        ("title", "表A.1 目录", 1, 1, "表A.1 目录", []),
        ("definition", "基础数据：指登记的数据", 2, 2, "表A.1 目录", []),
        ("sibling_group", "001患者 姓名\n续行\n002医师", 5, 7, "表A.1 目录", ["01基础资源", "01人员"]),
        ("table_row", "001患者 姓名\n续行", 5, 6, "表A.1 目录", ["01基础资源", "01人员", "001患者"]),
        ("table_row", "002医师", 7, 7, "表A.1 目录", ["01基础资源", "01人员", "002医师"]),
        ("negative", "影响程度 一般", 8, 8, "表A.1 目录", []),
        ("table_row", "003药品", 9, 9, "表A.1 目录", ["01基础资源", "01人员", "003药品"]),
    ]


def test_a_group_that_a_title_ends_carries_that_title(spark):
    out = units(spark, "1资源 01人员 001甲", "", "002乙", "表B.1 其后", "重要数据")
    assert [x for x in out if x[0] == "sibling_group"] == [("sibling_group", "001甲\n002乙", 1, 3, "表B.1 其后", ["1资源", "01人员"])]
    assert out[-1] == ("negative", "重要数据", 5, 5, "表B.1 其后", [])


def test_years_are_no_codes_and_nothing_gives_nothing(spark):
    assert units(spark, "2020年 数据", "正文。", "重要数据 续") == [("negative", "重要数据 续", 3, 3, "", [])]


def test_packs_rank_by_code_name_terms_and_resource_type(spark):
    found = spark.createDataFrame(
        [("d", "table_row_unit", "001患者姓名", 3, "表A 基础资源"), ("d", "table_row_unit", "002患者姓名表", 4, "表A"), ("d", "definition_unit", "基础资源类数据：登记", 1, ""), ("d", "definition_unit", "开展数据分类工作：甲", 2, ""), ("d", "negative_unit", "重要数据", 9, "")],
        "doc_id string, kind string, text string, line_start int, table_title string",
    )
    rows = spark.createDataFrame([("r", ["人员", "001患者姓名"], None, "d"), ("n", None, None, "d")], "row_id string, path_levels array<string>, data_range_examples array<string>, doc_id string")
    out = [(r.kind, r.line_start, r.score, r["rank"]) for r in C.packs(rows, found).orderBy("kind", "rank").collect()]
    assert out == [("definition_unit", 1, 51, 1), ("definition_unit", 2, -17, 2), ("negative_unit", 9, 0, 1), ("table_row_unit", 3, 160, 1), ("table_row_unit", 4, 66, 2)]
