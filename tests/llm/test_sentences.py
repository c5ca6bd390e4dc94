import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from graincraft.llm.sentences import sentence_spans, spans

CASES = [
    ("en", ["See Sec. 5.2 and circular No. 29 for details.", "Dr. A. Smith left at 6.30 a.m. on Tuesday.", "The list has admissions, etc.", "It ended!"]),
    ("en", ['The notice reads: "Do not share. Ever."', '"Register first. Review afterwards," says the note.', "The clerk paused... then went on."]),
    ("de", ["Ab dem 24. März sind Daten zu melden.", "„Bitte erst prüfen. Dann freigeben.“ steht auf jedem Formular.", "Listen, z. B. aus der Ambulanz, gelten als Stufe 3.", "Es gilt § 26 Abs. 3 S. 1 der Ordnung."]),
    ("fr", ["M. Vaudrelin valide les dossiers.", "Le taux reste sous 4,4 %.", "La note précise : « Vérifiez. Puis signez. »", "Voir l’annexe B.", "Peut-on transmettre ?"]),
    ("hi", ["डॉ. की अनुमति के बिना न भेजें!", "नियम 8.8 के अनुसार है।"]),
    ("ar", ["كتب المدقق «راجع أولا. ثم وقع.» على الغلاف.", "هل يجوز؟"]),
    ("ko", ["안내문에는 “확인한다. 이후 서명한다.”라고 적혀 있다.", "처방은 제29.5조에 따라 분류한다."]),
]


@pytest.mark.parametrize("lang, sentences", CASES)
def test_spaced_scripts(lang, sentences):
    text = " ".join(sentences)
    assert [text[a:b] for a, b in spans(text)] == sentences


@pytest.mark.parametrize(
    "sentences",
    [
        ["处长答复：“已登记。未经审核不得共享。”", "二审通过！", "真的吗？！", "完整率为80.6%，误差小。"],
        ["负责人强调“要核对！”后，随即整改。", "『登记。预警登记。』两栏均须填写。"],
        ["「非公開です。」", "担当者は「確認した。問題はない。」と記録する。", "台帳……などを保管する。"],
        ["（一）甲；（二）乙（含补录件。见附录G）按4级管理。", "（10）分类目录修订。"],
    ],
)
def test_scripts_without_spaces(sentences):
    text = "".join(sentences)
    assert [text[a:b] for a, b in spans(text)] == sentences


def test_lines_and_headings():
    text = "　总则\n\n17. 第一句没有\n断开。\r\n\r\n2.1 Begriffe\n\nEnds here.\nNext one\n"
    assert [text[a:b] for a, b in spans(text)] == ["总则", "17. 第一句没有\n断开。", "2.1 Begriffe", "Ends here.", "Next one"]


def test_thai_spaces():
    text = "อัตราไม่เกินร้อยละ 3.9 ของทั้งหมด ผู้ดูแลระบบ HIS ตรวจสอบสิทธิ์ ห้ามส่งออก"
    assert [text[a:b] for a, b in spans(text)] == ["อัตราไม่เกินร้อยละ 3.9 ของทั้งหมด", "ผู้ดูแลระบบ HIS ตรวจสอบสิทธิ์", "ห้ามส่งออก"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB. 。“”\"(（)）\n!?1ก ู", max_size=60))
def test_every_character_lies_in_one_sentence(text):
    found = spans(text)
    assert all(a < b and not text[a].isspace() and not text[b - 1].isspace() for a, b in found)
    assert all(x[1] <= y[0] for x, y in zip(found, found[1:]))
    assert "".join(re.sub(r"\s", "", text[a:b]) for a, b in found) == re.sub(r"\s", "", text)


def test_nulls_and_long_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, "字。" * 50_000)], "doc_id bigint, text string")
    assert {r.doc_id: r["count"] for r in sentence_spans(df).groupBy("doc_id").count().collect()} == {4: 50_000}


def cut(text):
    return [text[a:b] for a, b in spans(text)]


def test_words_that_are_abbreviations_elsewhere_end_sentences():
    assert cut("He said no. Then he left.") == ["He said no.", "Then he left."]
    assert cut("We like art. Then we left.") == ["We like art.", "Then we left."]
    assert cut("The value is max. Next we test.") == ["The value is max.", "Next we test."]
    assert cut("See No. 5 and Art. 3. It is the end.") == ["See No. 5 and Art. 3.", "It is the end."]
    assert cut("Der Wert ist max. 5 und die Zahl bzw. Menge. Das ist Nr. 3.") == ["Der Wert ist max. 5 und die Zahl bzw. Menge.", "Das ist Nr. 3."]


def test_terminals_of_other_scripts():
    assert len(cut("ကျွန်တော် စာဖတ်တယ်။ သူ သွားတယ်။")) == 2
    assert len(cut("ሰላም ነው። እንዴት ነህ፧ ደህና።")) == 3
    assert len(cut("ߒ ߓߘߊ߫ ߞߊ߬߹ ߊ߬ ߕߊ߯ߊ")) == len(cut("ܫܠܡܐ܀ ܐܢܐ")) == len(cut("𑀓𑀔𑁇 𑀓𑁇")) == 2


def test_a_label_far_from_its_letter():
    word = "x" * 200
    assert cut(f"{word} Annex {' ' * 60}B. Then the rest.") == [f"{word} Annex {' ' * 60}B.", "Then the rest."]
