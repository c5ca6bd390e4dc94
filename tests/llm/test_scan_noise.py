import random

import pytest

from graincraft.llm import scan_noise as S

BODY = ["审计处应当每月对处方开展核对，并将结果报药学部备案。", "病历的保存期限为3年，自住院业务办结之日起计算。", "下列资料列入目录：口腔库存；统计记录。", "急诊人口用于质量评价时，是否需要脱敏？", "The catalogue lists admissions, discharges and transfers.", "A cost-benefit assessment accompanies the evidence-based justification.", "Administrative correspondence follows the harmonised methodology."]


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return S.Model(["\n".join(rng.choices(BODY, k=12)) for _ in range(120)])


def test_misread_characters_are_found_and_mended(model):
    text = "处方甩于评价。" + BODY[1].replace("存", "荐").replace("住院", "住阮") + BODY[6].replace("harmonised", "harm0nised") + " 统□记录"
    found = {(c, y) for _, c, y in model.read(text)}
    assert {("荐", "存"), ("阮", "院"), ("0", "o"), ("□", "计")} <= found


def test_clean_text_stays(model):
    for t in BODY:
        assert model.read(t) == []


def test_held_out_accuracy(model):
    rng = random.Random(9)
    right = wrong = missed = 0
    back = {y: c for c, ys in S.MISREAD_HAN.items() for y in ys}
    for _ in range(200):
        t = rng.choice(BODY[:4])
        places = [i for i, x in enumerate(t) if x in back]
        i = rng.choice(places)
        noisy = t[:i] + back[t[i]] + t[i + 1 :]
        found = {p: y for p, _, y in model.read(noisy)}
        right += found.get(i) == t[i]
        missed += i not in found
        wrong += len(set(found) - {i})
    assert right >= 180 and wrong <= 10


def test_hyphens(model):
    assert model.broken("the harmo-", "nised methodology") and model.broken("corres¬", "pondence")
    assert model.broken("A cost-", "benefit assessment") is False and model.broken("plain", "x") is None


@pytest.mark.parametrize("line, out", [("— 4 —", ("dash", 4)), ("第 lO 页", ("page", 10)), ("Page 3 of 9", ("of", 3)), ("vii", ("roman", 7)), ("·l2·", ("dot", 12)), ("  15 ", ("bare", 15)), ("合计", None), ("3.1", None)])
def test_page_numbers(line, out):
    assert S.page_number(line) == out


def test_pages(spark):
    rng = random.Random(4)
    rows = []
    for p in range(1, 7):
        lines = [f"HX/T 721-2013 Finance Scope    {p + 3}" if p != 3 else "HX/T 721-2□13 Finance Scope    6", *rng.choices(BODY, k=8)]
        if p == 2:
            lines[-1:] = ["病历的保荐期限为3年，自住院业务办结之日起计算。"]
        if p == 4:
            lines += ["120"]
        if p == 5:
            lines[1] = "合计"
        rows.append(("d", p, "ocr", "\n".join(lines)))
    rows += [("d", 2, "ocr", rows[1][3]), ("e", None, "text", BODY[0]), ("f", 1, "ocr", None), ("g", 1, None, "")]
    rows += [(f"t{i}", 1, "pdf_text", "\n".join(rng.choices(BODY, k=10))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id string, page_number int, source_method string, text string")
    out = sorted((r.page_number, r.line_no, r.defect) for r in S.defects(df).where("doc_id = 'd'").collect())
    assert out == [(1, 1, "header"), (2, 1, "header"), (2, 9, "char"), (3, 1, "header"), (4, 1, "header"), (5, 1, "header"), (6, 1, "header")]
    fixed = {(r.doc_id, r.page_number): r.text for r in S.repaired(df).where("doc_id < 'h'").collect()}
    assert "保存期限" in fixed[("d", 2)] and "HX/T" not in fixed[("d", 2)] and fixed[("f", 1)] is None and fixed[("g", 1)] == "" and fixed[("e", None)] == BODY[0]


def test_words_compounds_and_triples_are_of_all_pages(spark, monkeypatch):
    monkeypatch.setattr(S, "TRAINING_PAGES", 2)
    pages = [("d", i, "\n".join(["第一章", *BODY, f"well-{'abcdefghij'[i]}nown Word{'abcdefghij'[i]} 甲乙{chr(0x4E00 + i)}丙", *BODY, f"{'abcdefghij'[i]}x-ray"]), "pdf_text") for i in range(10)]
    df = spark.createDataFrame(pages + pages[:1], "doc_id string, page_number int, text string, source_method string")
    m = S.trained(S._pages(df))
    assert all(m.words[f"word{c}"] == 1 and f"{c}x" in m.compounds for c in "abcdefghij") and m.words["admissions"] == 20
    whole = S.Model.counted([S._body(t) for _, _, t, _ in pages])
    assert m.words == whole["word"] and m.triples == {k: n for k, n in whole["triple"].items() if n > 1}
