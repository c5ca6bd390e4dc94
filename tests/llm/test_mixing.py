from pyspark.sql import functions as F

from graincraft.llm import mixing as M


def sizes(spark, rows):
    return spark.createDataFrame(rows, "source string, doc_id bigint, n_tokens bigint").withColumn("h", M._hash("doc_id"))


def test_thresholds_equal_the_sorted_way(spark):
    import random

    rng = random.Random(2)
    rows = [(s, i + k * 1000, rng.randint(0, 50)) for k, s in enumerate("ab") for i in range(300)]
    df = sizes(spark, rows)
    below = M._thresholds(df.select("source", "h", "n_tokens"), {"a": 2000.0, "b": 7.0})
    for s, want in (("a", 2000), ("b", 7)):
        total, taken = 0, 0
        for r in df.where(F.col("source") == s).orderBy("h").collect():
            if total + r.n_tokens > want:
                break
            total, taken = total + r.n_tokens, taken + 1
        got = df.where((F.col("source") == s) & (F.col("h") < below[s])).agg(F.count("*"), F.sum("n_tokens")).first()
        assert (got[0], got[1] or 0) == (taken, total)


def test_shares_caps_and_missing_sources(spark):
    docs = spark.createDataFrame([(i, "word " * 20, "big") for i in range(200)] + [(1000 + i, "word " * 20, "small") for i in range(10)] + [(2000, "x", None), (2001, None, "big"), (2002, "x", "other")], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 3), ("gone", 0.2, 2)], "source string, target_share double, max_repeats int")
    used, report = M.mixed(docs, targets)
    r = {x.source: x for x in report.collect()}
    assert r["small"].uses == 30 and r["gone"].tokens == 0 and abs(r["big"].actual_share - 0.625) < 0.02
    assert used.groupBy("source").agg(F.max("repeats")).collect() and used.where("repeats > 3").count() == 0
    assert used.where("source = 'other' or source is null").count() == 0


def test_no_documents(spark):
    used, report = M.mixed(spark.createDataFrame([], "doc_id bigint, text string, source string"), spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int"))
    assert used.count() == 0 and report.collect()[0].actual_share == 0.0
