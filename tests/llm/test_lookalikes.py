import pytest
from pyspark.sql import functions as F

from graincraft.llm import lookalikes as L

COUNTS = {"CRM": 90, "HIS": 80, "Records": 70, "Журнал": 60, "カルテ": 50, "人口": 40, "口腔": 40, "二维": 30, "力保": 30, "人力": 30, "a": 20, "IT": 9}
ONE = L.Canonicaliser(COUNTS)


@pytest.mark.parametrize(
    "text, form",
    [
        ("СRМ工单", "CRM工单"),
        ("НІЅ接口", "HIS接口"),
        ("Reсоrds", "Records"),
        ("ＣＴ １级", "CT 1级"),
        ("naïve", "naïve"),
        ("学校​类﻿", "学校类"),
        ("Drug Supply", "Drug Supply"),
        ("⼈⼝", "人口"),
        ("ｶﾙﾃ", "カルテ"),
        ("住院人ロ", "住院人口"),
        ("ニ维码", "二维码"),
        ("人カ保障", "人力保障"),
    ],
)
def test_cases(text, form):
    assert ONE(text) == form
    assert ONE(form) == form


@pytest.mark.parametrize("text", ["Журнал登记", "カルテ", "α-胎蛋白", "Résumé", "序号①", "甲，乙：丙！", "a–b—c", "tab\there\n", "क्‍ष", "👨‍👩‍👧", "می‌خواهم", "", None])
def test_not_cases(text):
    assert ONE(text) == text


def test_suspicious_agrees_with_the_canonicaliser(spark):
    texts = [c + x for c in ("甲", "a") for x in ("­", "　", "́", "ｶ", "理", "⼈", "С", "ο", "ロ", "ɡ", "\U0001d400")]
    df = spark.createDataFrame([(t,) for t in texts + ["plain 文字，。", None]], "text string")
    assert [r.s for r in df.select(L.suspicious(F.col("text")).alias("s")).collect()] == [True] * len(texts) + [False, None]


def test_trie_takes_the_commoner_spelling():
    trie = L.Trie({"CT": 5, "СТ": 2})
    assert trie.canonical("СT") == "CT" and trie.canonical("C​T") == "CT" and trie.canonical("CX") is None


def test_vocabulary_counts_over_all_texts(spark):
    df = spark.createDataFrame([("人口 Records",)] * 3 + [(None,), ("once",)], "text string")
    assert L.vocabulary(df) == {"Records": 3, "人口": 3}
