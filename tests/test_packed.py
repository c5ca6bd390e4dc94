import pytest

from graincraft.operators.packed import parses, split_values, unquoted

KINDS = {"allowed_values": "list", "value_domain_refs": "references", "path_levels": "path"}


def values(spark, rows):
    df = spark.createDataFrame(rows, "record_id string, field string, items array<string>")
    out = {}
    for r in split_values(df, KINDS).orderBy("record_id", "field", "pos").collect():
        out.setdefault((r.record_id, r.field), []).append((r.pos, r.value))
    return {k: [v for _, v in x] for k, x in out.items()}


@pytest.mark.parametrize(
    "text, kind, fullest",
    [
        ("“甲、乙两类合并填写”", "list", ["甲、乙两类合并填写"]),
        ("≤1,200 mL", "list", ["≤1,200 mL"]),
        ("次/d，mg/L", "list", ["次/d", "mg/L"]),
        ("1=甲，，2=乙、3=Type A", "list", ["1=甲", "2=乙", "3=Type A"]),
        ("1.甲  2.乙  3.其他（含转院、转科）", "list", ["1.甲", "2.乙", "3.其他（含转院、转科）"]),
        ('"冷藏 ""2-8"""|乙', "list", ['冷藏 "2-8"', "乙"]),
        ("HX/T 964.1:CV1 HX/T 964.2:CV2", "references", ["HX/T 964.1:CV1", "HX/T 964.2:CV2"]),
        ("甲→乙 > '丙I>O'/丁、附件", "path", ["甲", "乙", "丙I>O", "丁、附件"]),
        ("（甲；乙）丙", "path", ["（甲；乙）丙"]),
        ("(甲；乙", "path", ["(甲", "乙"]),
    ],
)
def test_fullest_parse(text, kind, fullest):
    assert parses(text, kind)[-1][0] == fullest


def test_unquoted():
    assert unquoted("  “甲” ") == "甲"
    assert unquoted("“甲”和“乙”") == "“甲”和“乙”"
    assert unquoted('""') == ""


def test_whole_remark_stays(spark):
    rows = [(f"e{i}", "allowed_values", ["以万元为单位，保留 2 位小数"]) for i in range(20)] + [(f"f{i}", "allowed_values", [x]) for i, x in enumerate(["甲，乙", "乙，丙", "甲，丙，丁", "丁，甲", "乙，丁", "甲", "乙", "丙", "丁"] * 4)]
    found = values(spark, rows)
    assert found[("f0", "allowed_values")] == ["甲", "乙"]
    assert not any(k[0].startswith("e") for k in found)


def test_nulls_repeats_and_places(spark):
    rows = [("a", "path_levels", ["甲", "乙/丙", None, " "]), ("a", "path_levels", ["甲", "乙/丙", None, " "]), ("b", "path_levels", None), ("c", "allowed_values", [None]), ("d", "path_levels", []), ("e", "path_levels", ["乙"]), ("f", "path_levels", ["丙"])]
    assert values(spark, rows) == {("a", "path_levels"): ["甲", "乙", "丙"]}


def test_empty_table(spark):
    assert values(spark, []) == {}


def test_quotes_belong_to_the_dialect():
    found = parses("甲，“乙，丙”", "list")
    values = [v for v, *_ in found]
    assert values[0] == ["甲，“乙，丙”"] and values[-1] == ["甲", "乙，丙"] and ["甲", "“乙", "丙”"] in values
    bare = {tuple(v): n for v, _, _, n in found}
    assert bare["甲", "乙，丙"] == 0 and bare["甲", "“乙", "丙”"] == 2
    assert parses("“甲，乙”", "list")[-1][0] == ["甲，乙"]


def test_every_subset_of_marks_is_a_dialect():
    values = [v for v, *_ in parses("甲，乙、丙;丁|戊/己", "list")]
    assert len(values) == 2**5 and ["甲，乙", "丙;丁|戊/己"] in values and ["甲", "乙、丙", "丁|戊", "己"] in values
