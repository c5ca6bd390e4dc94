from graincraft.functions import text as X
from graincraft.functions.terms import row_terms
from pyspark.sql import functions as F

ODD = ["1.2 甲　乙、A）丙丙", "数据", None, "", "A.1x", "\U00020000\U00020001", "ab c,de；fg", "3.1", "１２数据", "、、", "，由，，由办负责。保存2.5年", "B、1.2.3病人 信息资源（测试）超过十二个字符的文本", "超过十二个字符的文本没有标点", X.INSUFFICIENT, "\x1c a\u3000\x85b", "x1", "类\u2003数据"]


def test_row_terms_are_those_of_the_column_functions(spark):
    t = spark.createDataFrame([([x], None, None, None) for x in ODD] + [(None, [x, "ab"], x, s) for x in ODD for s in ("insufficient", None)] + [(None, None, None, ""), (ODD, ODD, "ab、cd", "quoted")], "levels array<string>, examples array<string>, description string, source string")
    texts = F.concat(F.coalesce("levels", F.array()), F.coalesce("examples", F.array()), F.when(F.coalesce("source", F.lit("")) != "insufficient", F.array("description")).otherwise(F.array()))
    wanted = F.array_sort(F.array_distinct(F.flatten(F.transform(texts, X.terms))))
    assert t.select(F.array_sort(row_terms("levels", "examples", "description", "source")).alias("found"), wanted.alias("wanted")).where("not (found <=> wanted)").collect() == []
