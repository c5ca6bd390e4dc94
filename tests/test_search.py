from difflib import SequenceMatcher

from graincraft.plans import run_queries, text_queries

CHUNKS = "chunk_id string, doc_id string, text string, section_title string, position int, source_method string"
TERMS = ("登记", "共享", "sharing")


def scored(text, title):
    score = 0.0
    for w in TERMS:
        score += (w in text.lower()) + 0.6 * (w in title.lower())
        if w not in text.lower():
            score += max(SequenceMatcher(None, w, x.lower()).ratio() for x in text.splitlines() or [text]) * 0.25
    return score


def test_all_chunks_that_speak_of_a_term_or_nearly(spark, tmp_path):
    rows = [(f"c{i:02}", "d", "登记", "", 99 - i, "text") for i in range(60)]
    rows += [("n1", "d", "Data Sharing", "", 1, "text"), ("n2", "d", "登 记\n共 享\nsharin", "", 2, "text"), ("n3", "d", None, "SHARING", 3, "text"), ("n4", "d", "x", None, 4, "text"), ("n5", "d", "shared", "", 5, "text")]
    spark.createDataFrame(rows, CHUNKS).write.parquet(f"{tmp_path}/chunks.parquet")
    out = [(r.chunk_id, r.score) for r in text_queries.keyword_search(spark, str(tmp_path)).collect()]
    wanted = sorted((-s, r[4], r[0]) for r in rows if (s := scored(r[2] or "", r[3] or "")) >= 0.45)
    assert [k for k, _ in out] == [k for *_, k in wanted] and len(out) == 63
    assert all(abs(s + w[0]) < 1e-9 for (_, s), w in zip(out, wanted))


def test_the_last_line_of_a_long_text_counts(spark, tmp_path):
    spark.createDataFrame([("c", "d", "\n".join(["x" * 50_001] * 20 + ["登记"]), "", 1, "text")], CHUNKS).write.parquet(f"{tmp_path}/chunks.parquet")
    spark.createDataFrame([("r", 1, ["资源", "登记"], [("c",)])], "row_id string, ord bigint, path_levels array<string>, evidence_refs array<struct<chunk_id:string>>").write.parquet(f"{tmp_path}/classification_rows.parquet")
    assert run_queries.fuzzy_terms_in_chunks(spark, str(tmp_path)).first().ratio == 1.0
