from graincraft.llm import linkage as L

ROWS = "row_id string, path_levels array<string>, data_range_examples array<string>"
RECORDS = "match_id string, reference_path array<string>, shared_terms array<string>, score double"
PATHS = [(d, f, u, o, e) for d in ("医疗服务", "公共卫生", "健康档案", "科研教学", "财务运营") for f in ("质量控制", "资源调度", "标准规范") for u in ("中医", "口腔", "儿科", "产科") for o in ("处方", "病历归集", "耗材审核") for e in ("变更信息", "变更记录", "基本信息")]


def tables(spark, records):
    rows = [(f"r{i:03}", [d + "资源", d + f, u + o, e], ["患者日期"]) for i, (d, f, u, o, e) in enumerate(PATHS) if i % 7 in (1, 6)]
    return spark.createDataFrame(rows, ROWS), spark.createDataFrame(records, RECORDS), {tuple(r[1]): r[0] for r in rows}


def test_order_and_numbers(spark):
    fill = [(f"f{i}", [d + "资源", d + f, u + o, e], None, 0.5) for i, (d, f, u, o, e) in enumerate(PATHS)]
    records = fill + [
        ("a", ["7.1 医疗服务类数据", "7.2 医疗服务资源调度", "7.3 中医处方", "7.4 变更信息"], ["中医"], None),
        ("b", ["变更记录", "儿科病历归集", "公共卫生标准规范", "公共卫生"], None, 0.9),
        ("d", ["健康档案质量控制", "口腔病历", "变更记录"], [], 0.9),
        ("e", None, None, None),
        ("f", [None, " "], ["x"], 1.0),
    ]
    rows, recs, of = tables(spark, records)
    out = {r.match_id: (r.row_id, r.confidence) for r in L.links(rows, recs).collect()}
    assert out["a"][0] == of[("医疗服务资源", "医疗服务资源调度", "中医处方", "变更信息")]
    assert out["b"][0] == of[("公共卫生资源", "公共卫生标准规范", "儿科病历归集", "变更记录")]
    assert not {"d", "e", "f"} & out.keys() and all(0.5 <= c <= 1 for _, c in out.values())
    present = {f"f{i}" for i in range(len(PATHS)) if i % 7 in (1, 6)}
    assert {k for k in out if k[0] == "f"} == present


def test_no_records(spark):
    rows, recs, _ = tables(spark, [])
    assert L.links(rows, recs).count() == 0


def test_slip():
    assert L._slip("abcd", "abdc") and L._slip("abd", "abcd") and L._slip("abcd", "acd") and not L._slip("abcd", "abxy") and not L._slip("abcd", "axcd")


def test_slips_amid_a_short_tail_that_another_domain_has(spark):
    heads = [(d, f) for d in ("医疗服务", "公共卫生", "健康档案") for f in ("质量控制", "资源调度", "标准规范")]
    names = [chr(0x5000 + 7 * i) + chr(0x5001 + 7 * i) + chr(0x5002 + 7 * i) for i in range(90)]
    rows = [(f"r{i:02}", [heads[i % 9][0] + "资源", "".join(heads[i % 9]), n, "变更记录"], None) for i, n in enumerate(names)]
    # the next domain has the same tails, the last ten without their third character
    rows += [(f"s{i:02}", [heads[(i + 3) % 9][0] + "资源", "".join(heads[(i + 3) % 9]), n[:2] if i > 79 else n, "变更记录"], None) for i, n in enumerate(names)]
    # some records lack the third character, some have the first two exchanged
    records = [(f"m{i:02}", ["".join(heads[i % 9]), n[:2] if i > 79 else n[1] + n[0] + n[2] if i < 10 else n, "变更记录"], None, 0.9) for i, n in enumerate(names)]
    recs = spark.createDataFrame(records, RECORDS)
    out = {r.match_id: r.row_id for r in L.links(spark.createDataFrame(rows, ROWS), recs).collect()}
    assert out == {r[0]: f"r{r[0][1:]}" for r in records}


def test_other_wordings_are_learned_from_the_records(spark):
    plain = [(f"r{i:03}", [d + "资源", d + f, u + o, e], [f"例{i}", "患者日期"]) for i, (d, f, u, o, e) in enumerate(PATHS)]
    heads = [(f"h{i:03}", [p[0].replace("医疗服务", "诊疗服务"), p[1].replace("医疗", "诊疗"), *p[2:]], x[:1], 0.8) for i, (_, p, x) in enumerate(plain)]
    other = lambda x: x.replace("病历", "病案").replace("变更", "变动")
    tails = [(f"t{i:03}", [*p[:2], other(p[2]), other(p[3])], [*x[:1], p[2][2:], p[3]], 0.8) for i, (_, p, x) in enumerate(plain)]
    both = [("b", ["诊疗服务资源", "诊疗服务质量控制", "口腔病案归集", "基本信息"], None, 0.8), ("n", ["诊疗服务资源", "诊疗服务质量控制", "口腔影像归集", "基本信息"], None, 0.8)]
    out = {r.match_id: (r.row_id, r.confidence) for r in L.links(spark.createDataFrame(plain, ROWS), spark.createDataFrame(heads + tails + both, RECORDS)).collect()}
    of = {tuple(p): r for r, p, _ in plain}
    assert all(out[k][0] == "r" + k[1:] for k in out if k[0] in "ht") and len(out) == 2 * len(plain) + 1
    assert out["b"][0] == of[("医疗服务资源", "医疗服务质量控制", "口腔病历归集", "基本信息")]


def test_agreement_never_lowers_the_posterior():
    chance = [{0: 0.05, 1: 0.01, 2: 0.94}, {0: 0.05, 1: 0.1, 2: 0.85}, {0: 1e-4, 1: 1e-5}]
    patterns = [((0, 0, 0), 500), ((0, 1, 0), 60), ((2, 0, 0), 300), ((2, 2, 0), 9000), ((0, 2, 0), 400), ((0, 0, 1), 30), ((2, 2, 1), 100)]
    post = L._fitted(patterns, chance, 1e8)
    assert post[0, 0, 0] >= post[0, 1, 0] >= post[0, 2, 0] >= post[2, 2, 0] and post[0, 0, 0] > 0.9 and post[2, 0, 0] < 0.1 and post[0, 2, 0] < 0.1


def test_words_are_no_part_of_the_plan(spark):
    texts = spark.createDataFrame([("甲乙丙1",), ("甲乙",), ("无",), ("甲乙",)], "s string")
    held = L._holding(texts, ["甲乙", "乙丙", "丁戊", *(f"词{i}" for i in range(5000))])
    assert {r.a: r.n for r in held.collect()} == {"甲乙": 3, "乙丙": 1}
    assert len(held._jdf.queryExecution().analyzed().toString()) < 10_000


def test_spans_vote_on_the_workers(spark):
    # 甲药房 holds a better span of its term and has no vote; of what stands for 丙检 the commoner is chosen
    pairs = spark.createDataFrame([("甲药", "乙药", 9, 10), ("甲药房", "乙药", 8, 10), ("丙检", "丁检", 5, 5), ("丙检", "戊检", 4, 5)], "a string, w string, n bigint, na bigint")
    assert L._voted(pairs) == {"甲药": "乙药", "丙检": "丁检"}
