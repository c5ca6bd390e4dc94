from graincraft.llm import formatting_copies as C

SCHEMA = "row_id string, path_levels array<string>, description string, digest string, ord int"


def pairs(spark, rows):
    df = spark.createDataFrame([(i, p, d, "clash", n) for n, (i, p, d) in enumerate(rows)], SCHEMA)
    return sorted((r.row_id_a, r.row_id_b) for r in C.copies(df).collect())


def test_formatting_is_no_difference(spark):
    rows = [
        ("r1", ["医疗 资源", "Blood-Bank"], "责任部门：血库；用途：绩效；年增量：3.5万条"),
        ("r2", ["“医疗资源”", "BLOOD BANK"], "用途 = 绩效 | 年增量 = 3.5万条 | 责任部门 = 血库."),
        ("r3", ["医·疗资源", "blood bank"], "年增量:3.5万条\n责任部门:血库\n用途:绩效"),
        ("r4", ["医疗资源", "Blood Bank"], "责任部门：血库；用途：绩效；年增量：35万条"),
        ("r5", ["医疗资源Blood Bank"], "责任部门：血库；用途：绩效；年增量：3.5万条"),
        ("r2", ["“医疗资源”", "BLOOD BANK"], "用途 = 绩效 | 年增量 = 3.5万条 | 责任部门 = 血库."),
    ]
    assert pairs(spark, rows) == [("r1", "r2"), ("r1", "r3")]


def test_order_of_prose_and_levels_counts(spark):
    assert pairs(spark, [("a", ["x", "y"], "甲，乙"), ("b", ["y", "x"], "甲，乙"), ("c", ["x", "y"], "乙，甲")]) == []


def test_nulls_and_blanks(spark):
    assert pairs(spark, [("a", None, None), ("b", [], " "), ("c", [None], None), ("d", ["x"], None)]) == [("a", "b")]
    assert pairs(spark, []) == []


def test_a_large_group_and_counts(spark):
    df = spark.range(3000).selectExpr("concat('r', lpad(id, 5, '0')) as row_id", "array('甲', if(id < 2000, '乙', cast(id as string))) as path_levels", "'说明' as description")
    out = {r.row_id: r.n_copies for r in C.collapsed(df).where("n_copies > 1").collect()}
    assert out == {"r00000": 2000} and C.collapsed(df).count() == 1001
