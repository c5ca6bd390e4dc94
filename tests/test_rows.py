from graincraft.functions import text as X
from graincraft.operators import rows as R
from pyspark.sql import functions as F

SCHEMA = "row_id string, path_levels array<string>, recommended_grade string, description string, description_source string, description_evidence_quote string, evidence_quote string, grade_evidence_quote string, evidence_refs array<struct<chunk_id string, text string>>, data_range_examples array<string>, support_level string, confidence double, needs_review boolean, status string, ord bigint"


def table(spark, *rows):
    base = dict(row_id=None, path_levels=None, recommended_grade=None, description=None, description_source="quoted", description_evidence_quote=None, evidence_quote=None, grade_evidence_quote=None, evidence_refs=[], data_range_examples=None, support_level="explicit", confidence=0.5, needs_review=False, status="supported", ord=0)
    names = [f.split()[0] for f in "row_id path_levels recommended_grade description description_source description_evidence_quote evidence_quote grade_evidence_quote evidence_refs data_range_examples support_level confidence needs_review status ord".split()]
    return spark.createDataFrame([tuple((base | dict(ord=i) | r)[n] for n in names) for i, r in enumerate(rows)], SCHEMA)


def test_one_per_row_keeps_the_first_delivery(spark):
    t = table(spark, dict(row_id="a", description="1", ord=5), dict(row_id="a", description="1", ord=2), dict(row_id="b", ord=1))
    assert sorted((r.row_id, r.ord) for r in R.one_per_row(t).collect()) == [("a", 2), ("b", 1)]


def test_best_of_prefers_evidence_then_the_earlier(spark):
    t = R.with_path(table(spark, dict(row_id="a", path_levels=["x"]), dict(row_id="b", path_levels=["x"], evidence_refs=[("c", "t")]), dict(row_id="c", path_levels=["x"], evidence_refs=[("c", "t")])))
    assert [r.row_id for r in R.best_of(t, "path").collect()] == ["b"]


def test_merge_joins_in_order_without_repeats(spark):
    t = table(spark, dict(row_id="a", path_levels=["x"], description="一", recommended_grade="2级", data_range_examples=["m", "n"]), dict(row_id="b", path_levels=[" x "], description="二", recommended_grade="第4级", data_range_examples=["n"]), dict(row_id="c", path_levels=["x"], description="一", needs_review=True))
    r = R.merged(t).collect()[0]
    assert (r.path, r.n_rows, r.grade, r.description, r.examples, r.needs_review) == ("x", 3, 4, "一；二", "m；n", True)


def test_parent_titles(spark):
    t = table(spark, dict(row_id="a", path_levels=["x"]), dict(row_id="b", path_levels=["x", "y"]), dict(row_id="c", path_levels=["xx"]))
    assert [r.row_id for r in R.strict_prefix_of_other(t).collect()] == ["a"]


def test_tree_has_every_prefix_and_its_parent(spark):
    t = table(spark, dict(row_id="a", path_levels=["x", "y"], confidence=0.0), dict(row_id="b", path_levels=["x", "z"], confidence=0.4, needs_review=True, status="proposed", recommended_grade="2级"), dict(row_id="c", path_levels=None))
    nodes = {r.path: r for r in R.tree(t).collect()}
    assert set(nodes) == {"x", "x / y", "x / z"}
    assert nodes["x"].parent_id is None and nodes["x / z"].parent_id == nodes["x"].node_id
    assert (nodes["x"].confidence, nodes["x"].needs_review, nodes["x"].status) == (0.4, True, "proposed")
    assert nodes["x / y"].status == "supported" and nodes["x / z"].grade == "2级"


def brute_links(a, b, least, top):
    out = []
    for i, x in a.items():
        found = []
        for j, y in b.items():
            s = len(set(x) & set(y))
            if s:
                score = round(0.75 * s / min(len(x), len(y)) + 0.25 * s / len(set(x) | set(y)), 4)
                if score >= least:
                    found.append((-score, j))
        out += [(i, j, -s) for s, j in sorted(found)[:top]]
    return sorted(out)


def test_term_links_equal_brute_force(spark):
    import random

    rng = random.Random(1)
    words = [f"w{i}" for i in range(30)]
    a = {f"a{i}": sorted(set(rng.choices(words, k=rng.randint(1, 6)))) for i in range(60)} | {"empty": []}
    b = {f"b{i:02}": sorted(set(rng.choices(words, k=rng.randint(1, 6)))) for i in range(40)}
    links = R.term_links(spark.createDataFrame(list(a.items()), "current_id string, terms array<string>"), spark.createDataFrame(list(b.items()), "reference_id string, terms array<string>"))
    found, wanted = {(r.current_id, r.reference_id): r.score for r in links.collect()}, {(i, j): s for i, j, s in brute_links(a, b, 0.5, 3)}
    assert found.keys() == wanted.keys() and all(abs(found[k] - wanted[k]) < 2e-4 for k in found)


def test_term_links_write_only_pairs_that_reach_the_least_score(spark, monkeypatch):
    written = {}

    def spied(df, label="step", real=R.materialise):
        out = real(df, label)
        written.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(R, "materialise", spied)
    # two hot terms are in every set, which isn't enough; one pair of sets shares four
    a = spark.createDataFrame([(f"a{i}", ["hot1", "hot2", f"x{i % 3}", *(f"a{i}_{k}" for k in range(3))]) for i in range(50)] + [("a", ["hot1", "hot2", "x1", "x2", "r"])], "current_id string, terms array<string>")
    b = spark.createDataFrame([(f"b{i}", ["hot1", "hot2", f"x{i % 3}x", *(f"b{i}_{k}" for k in range(3))]) for i in range(50)] + [("b", ["hot1", "hot2", "x1", "x2", "q"])], "reference_id string, terms array<string>")
    found = [(x.current_id, x.reference_id, x.shared, x["rank"]) for x in R.term_links(a, b).collect() if x.current_id == "a"]
    assert found == [("a", "b", "hot1|hot2|x1|x2", 1)]
    # besides that one, the sets a* with x1 and those with x2 share three terms with b's, and each kind is one set by what both sides have
    assert written["links_pairs"] == [3]


def joins(df):
    return df._jdf.queryExecution().analyzed().toString().count("Join ")


def small_links(spark):
    a = spark.createDataFrame([(f"a{i}", ["k", f"x{i % 2}"]) for i in range(5)], "current_id string, terms array<string>")
    b = spark.createDataFrame([("b0", ["k", "x0"]), ("b1", ["k", "x1", "y"]), ("b2", ["k", "z"]), ("b3", [])], "reference_id string, terms array<string>")
    return a, b


def test_best_links_read_links_that_are_made_once(spark):
    best = R.best_linked(R.term_links(*small_links(spark)), 4)
    assert [tuple(r) for r in best.collect()] == [("a0", 1.0), ("a2", 1.0), ("a4", 1.0), ("a1", 0.9167)]
    assert joins(best) == 0


def test_missing_references_by_blocks_of_the_library(spark, monkeypatch):
    monkeypatch.setattr(R, "KEY_BLOCK", 2)
    monkeypatch.setattr(R, "TERM_BLOCK", 1)
    a, b = small_links(spark)
    missing = R.unlinked(b, R.term_links(a, b))
    assert sorted(r.reference_id for r in missing.collect()) == ["b2", "b3"]
    assert joins(missing) == 1


def test_tiers_read_links_that_are_made_once(spark):
    tiers = R.tiers(R.term_links(*small_links(spark)))
    assert sorted((r.current_id, r.reference_id, r.uses, r.tier) for r in tiers.collect()) == [("a0", "b0", 3, "broad"), ("a1", "b1", 2, "strong"), ("a2", "b0", 3, "broad"), ("a3", "b1", 2, "strong"), ("a4", "b0", 3, "broad")]
    assert joins(tiers) == 1


def spied(monkeypatch, name):
    """The arguments and results of the calls of an operator's function from now on."""
    calls = []

    def spy(*args, real=getattr(R, name)):
        calls.append((args, real(*args)))
        return calls[-1][1]

    monkeypatch.setattr(R, name, spy)
    return calls


def test_best_links_need_one_link_of_a_row_and_no_words(spark, monkeypatch):
    made = spied(monkeypatch, "materialise")
    best = R.best_linked(R.term_links(*small_links(spark), top=1, told=False), 4)
    assert [tuple(r) for r in best.collect()] == [("a0", 1.0), ("a2", 1.0), ("a4", 1.0), ("a1", 0.9167)]
    out = {label: df for (_, label), df in made}
    assert out["links"].columns == ["current_id", "reference_id", "score", "rank"] and out["links_pairs"].columns == ["sa", "sb", "score"]
    assert out["links_pairs"].count() == 2


def test_missing_references_pass_over_rows_as_often_as_each_side_needs(spark, monkeypatch):
    # two rarest terms of a library set with four make three keys, all its terms six
    a = spark.createDataFrame([(f"a{i}", [f"x{i}", f"y{i}", f"z{i}", f"u{i}"]) for i in range(4)], "current_id string, terms array<string>")
    b = spark.createDataFrame([(f"b{i}", [f"x{i}", f"y{i}", f"z{i}", f"u{i}"]) for i in range(4)] + [("b9", ["x1", "x2", "x3", "x0"])], "reference_id string, terms array<string>")
    monkeypatch.setattr(R, "KEY_BLOCK", 15)
    met, made = spied(monkeypatch, "_met"), spied(monkeypatch, "materialise")
    missing = R.unlinked(b, R.linked(a, b))
    assert [r.reference_id for r in missing.collect()] == ["b9"]
    assert sorted(args[2] for args, _ in met) == ["a", "a", "b"]
    assert "links" not in {label for (_, label), _ in made}


def test_tiers_need_the_best_pair_of_a_set_alone(spark, monkeypatch):
    made = spied(monkeypatch, "materialise")
    a, b = small_links(spark)
    b = b.union(spark.createDataFrame([(f"c{i}", ["k", "x0", f"v{i}"]) for i in range(3)] + [("a9", ["k", "x0"])], b.schema))
    a = a.union(spark.createDataFrame([(f"m{i}", [f"v{i}", *(f"m{i}_{k}" for k in range(9))]) for i in range(3)], a.schema))
    tiers = R.tiers(R.term_links(a, b, top=1, told=False))
    assert sorted((r.current_id, r.reference_id, r.uses, r.tier) for r in tiers.collect() if r.current_id[0] == "a") == [("a0", "a9", 3, "broad"), ("a1", "b1", 2, "strong"), ("a2", "a9", 3, "broad"), ("a3", "b1", 2, "strong"), ("a4", "a9", 3, "broad")]
    pairs = [df for (_, label), df in made if label == "links_pairs"]
    assert len(pairs) == 1 and pairs[0].count() == pairs[0].select("sa").distinct().count()


def test_cascade_prefers_the_stronger_match(spark):
    a = spark.createDataFrame([("1", ["甲", "乙"]), ("2", ["1.2 丙"]), ("3", ["子", "丑", "寅"]), ("4", ["无"])], "id string, levels array<string>")
    b = spark.createDataFrame([("p", ["甲", "乙"]), ("q", ["别的", "1.2 丙"]), ("r", ["丑", "寅"]), ("s", ["甲", "乙"])], "id string, levels array<string>")
    assert sorted((r.current_id, r.reference_id, r.match_type) for r in R.cascade(a, b).collect()) == [("1", "p", "exact_path"), ("2", "q", "code_and_leaf"), ("3", "r", "parent_and_leaf")]


def test_donation_needs_a_shared_chunk_and_one_receiver(spark):
    t = table(spark, dict(row_id="long", path_levels=["x", "y"], evidence_refs=[("c1", "")]), dict(row_id="short", path_levels=["y"], recommended_grade="2级", evidence_refs=[("c1", "")]), dict(row_id="other", path_levels=["y"], recommended_grade="2级", evidence_refs=[("c9", "")]))
    assert [(r.receiver, r.donor) for r in R.donations(t).collect()] == [("long", "short")]


def test_grounding_ignores_white_space(spark):
    t = table(spark, dict(row_id="a", evidence_quote="甲 乙；丙", evidence_refs=[("c", "x甲乙y"), ("c", "丙")]), dict(row_id="b", evidence_quote="丁", evidence_refs=[("c", "甲")]))
    assert {r.row_id: r.grounded for r in R.grounded(t).collect()} == {"a": True, "b": False}


def test_terms(spark):
    t = spark.createDataFrame([("数据，患者 姓名、ID",), (None,), ("",), (X.INSUFFICIENT,)], "t string")
    assert [sorted(r.x) for r in t.select(X.terms(F.col("t")).alias("x")).collect()] == [["患者姓名", "数据，患者姓名、ID"], [], [], []]


def test_terms_lose_their_codes(spark):
    t = spark.createDataFrame([("1.2患者信息、A）诊疗记录",), ("3.1",)], "t string")
    assert [sorted(r.x) for r in t.select(X.terms(F.col("t")).alias("x")).collect()] == [["患者信息", "患者信息、A）诊疗记录", "诊疗记录"], []]


def test_cascade_by_alias(spark):
    a = spark.createDataFrame([("1", ["甲", "2、乙"]), ("2", ["丙"])], "id string, levels array<string>")
    b = spark.createDataFrame([("p", ["丁"], ["乙", None]), ("q", ["戊"], None)], "id string, levels array<string>, aliases array<string>")
    assert [(r.current_id, r.reference_id, r.match_type, r.score) for r in R.cascade(a, b).collect()] == [("1", "p", "exact_alias", 0.92)]


def test_gold_comparison(spark):
    rows = "levels array<string>, recommended_grade string, ord int"
    made = spark.createDataFrame([(["A、甲", "1乙"], "一般数据2级", 1), (["丙"], None, 2), (["12岁以下"], "1级", 3)], rows)
    gold = spark.createDataFrame([(["甲", "乙"], "9级", 1), (["甲", "乙"], "2 级", 2), (["岁以下"], "1级", 3)], rows)
    out = {r.path_key: (r.outcome, r.same_grade) for r in R.compared(made, gold).collect()}
    assert out == {"甲/乙": ("matched", True), "丙": ("extra", None), "12岁以下": ("extra", None), "岁以下": ("missing", None)}
    one = R.comparison_summary(R.compared(made, gold)).first()
    assert (one.generated_rows, one.reference_rows, one.coverage_pct, one.grade_matches, one.grade_accuracy_pct) == (3, 2, 50.0, 1, 100.0)
