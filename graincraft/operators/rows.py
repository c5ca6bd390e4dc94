"""Operators on classification rows: duplicates, merges, prefixes, trees, links, comparisons, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.tables import materialise
from .grounding import quote_parts

SUPPORT = {"explicit": 3, "structural": 2, "weak": 1}
SOURCES = {"quoted": 3, "summarized": 2, "insufficient": 1}


def _rank(column: str, table: dict[str, int]) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), F.col(column)), F.lit(0))


def one_per_row(df: DataFrame) -> DataFrame:
    """The first delivery of each row_id."""
    first = df.groupBy("row_id").agg(F.min("ord").alias("ord"))
    return df.join(first, ["row_id", "ord"], "left_semi")


def with_path(df: DataFrame) -> DataFrame:
    """Rows with a path, its levels stripped, and its text."""
    return df.withColumn("levels", X.clean_levels(F.col("path_levels"))).where("size(levels) > 0").withColumn("path", F.array_join("levels", " / "))


def first_wins(df: DataFrame, *keys: str) -> DataFrame:
    """The row of least ord for each key."""
    first = df.groupBy(*keys).agg(F.min("ord").alias("ord"))
    return df.join(first.select("ord"), "ord", "left_semi")


def best_of(df: DataFrame, *keys: str) -> DataFrame:
    """The best row for each key: with evidence, by source of its description, support and confidence; the earlier of equals."""
    best = F.struct((F.size(F.coalesce("evidence_refs", F.array())) > 0).cast("int").alias("a"), _rank("description_source", SOURCES).alias("b"), _rank("support_level", SUPPORT).alias("c"), F.coalesce("confidence", F.lit(0.0)).alias("d"), (-F.col("ord")).alias("e"))
    top = df.withColumn("__r", best).groupBy(*keys).agg((-F.max("__r")["e"]).alias("ord"))
    return df.join(top.select("ord"), "ord", "left_semi")


def merged(df: DataFrame) -> DataFrame:
    """One row for each path: texts joined in order without repeats, examples united in order, the highest grade, the lowest confidence, review if any asks for it.

    A path's group is folded from its distinct values, each kept once with its first ord before the shuffle, so copies don't grow it.
    """
    t = with_path(df)
    text = t.groupBy("path", "description").agg(F.min("ord").alias("ord")).where("description is not null and description <> ''").groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "description"))), lambda x: x["description"]), "；").alias("description"))
    examples = t.select("path", "ord", F.explode("data_range_examples").alias("example")).groupBy("path", "example").agg(F.min("ord").alias("ord")).groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "example"))), lambda x: x["example"]), "；").alias("examples"))
    base = t.groupBy("path").agg(F.count(F.lit(1)).alias("n_rows"), F.max(X.grade_rank(F.col("recommended_grade"))).alias("grade"), F.min("confidence").alias("confidence"), F.bool_or("needs_review").alias("needs_review"))
    return base.join(text, "path", "left").join(examples, "path", "left")


def strict_prefix_of_other(df: DataFrame) -> DataFrame:
    """Paths that are the beginning of another row's path."""
    t = with_path(df)
    prefixes = t.where("size(levels) > 1").select(F.explode(F.transform(F.sequence(F.lit(1), F.size("levels") - 1), lambda n: F.array_join(F.slice("levels", F.lit(1), n), " / "))).alias("path"))
    return t.join(prefixes.distinct(), "path", "left_semi")


def tree(df: DataFrame) -> DataFrame:
    """One node for each path and each of its beginnings: parent, level, rows below, least confidence above 0, review if any, status."""
    t = with_path(df).select("levels", "confidence", "needs_review", "status", "ord", "recommended_grade")
    nodes = t.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("levels")), lambda n: F.struct(F.slice("levels", F.lit(1), n).alias("p"), (n == F.size("levels")).alias("leaf")))).alias("x"), "confidence", "needs_review", "status", "ord", "recommended_grade").select("x.p", "x.leaf", "confidence", "needs_review", "status", "ord", "recommended_grade")
    path = F.array_join("p", " / ")
    out = nodes.groupBy(path.alias("path")).agg(F.max(F.size("p")).alias("level"), F.any_value("p").alias("p"), F.count(F.lit(1)).alias("n_rows"), F.min(F.when(F.col("confidence") > 0, F.col("confidence"))).alias("confidence"), F.bool_or(F.coalesce("needs_review", F.lit(False))).alias("needs_review"), F.bool_and(F.coalesce(F.col("status") == "supported", F.lit(False))).alias("supported"), F.max(F.when(F.col("leaf"), F.struct("ord", "recommended_grade")))["recommended_grade"].alias("grade"))
    parent = F.array_join(F.slice("p", F.lit(1), F.col("level") - 1), " / ")
    return out.select(X.stable_id("node", F.col("path")).alias("node_id"), F.when(F.col("level") > 1, X.stable_id("node", parent)).alias("parent_id"), "path", "level", "n_rows", "confidence", "needs_review", F.when(F.col("supported"), "supported").otherwise("proposed").alias("status"), "grade")


#: Key rows of library sets that are sent to the executors at once; more take more passes over the current sets.
KEY_BLOCK = 500_000
#: Terms of both sides that are sent to the executors; more are joined by shuffle.
TERM_BLOCK = 500_000


def _link_score(shared: Column, n: Column, m: Column) -> Column:
    """The score of two sets of n and m terms by the number of terms they share."""
    return F.round(0.75 * shared / F.least(n, m) + 0.25 * shared / (n + m - shared), 4)


def _fewest(n: Column, least: float) -> Column:
    """The fewest shared terms with which a set of n terms can reach least, the other being at least as large."""
    return F.coalesce(F.array_min(F.filter(F.sequence(F.lit(1), n), lambda s: 0.75 * s / n + 0.25 * s / (2 * n - s) >= least - 1e-4)), n + 1)


def _term_keys(sets: DataFrame, terms: Column, pairs: Column, singles: Column) -> DataFrame:
    """sets with t1, t2 and their key for every two of the terms, and with a term as both where singles holds. Rows leave one by one, no set's pairs are held together."""
    one = sets.select("*", F.posexplode(terms).alias("i", "t1"))
    seconds = F.slice(terms, F.when(singles, F.col("i") + 1).otherwise(F.col("i") + 2), F.when(pairs, F.size(terms)).otherwise(F.lit(1)))
    return one.select(*sets.columns, "t1", F.explode(seconds).alias("t2")).withColumn("key", F.xxhash64("t1", "t2"))


def _met(x: DataFrame, y: DataFrame, small: str, order: Column, least: float) -> DataFrame:
    """sa, sb, the library set's least id, score and the ids of the shared terms of the pairs that reach least, each pair by its first key alone. small: the side of the smaller set, a or b. y, the library's side, is broadcast."""
    # a mark that one set has and the other lacks is a term that they don't share, so most pairs are told apart without their terms
    most = F.size(f"r{small}") - F.bit_count(F.col(f"marks_{small}").bitwiseAND(F.bitwise_not("marks_b" if small == "a" else "marks_a")))
    able = (most > 0) & (_link_score(most, F.col("na"), F.col("nb")) >= least)
    both = x.join(F.broadcast(y.select("key", "sb", "nb", "rb", "id_b", "marks_b", "fewest_b")), "key").where(order & able)
    t = both.select("sa", "sb", "id_b", "na", "nb", "t1", "t2", F.col(f"fewest_{small}").alias("fewest"), F.array_intersect("ra", "rb").alias("ids"))
    first = (F.get("ids", F.lit(0)) == F.col("t1")) & (F.get("ids", F.when(F.col("fewest") > 1, 1).otherwise(0)) == F.col("t2"))
    return t.withColumn("score", _link_score(F.size("ids"), F.col("na"), F.col("nb"))).where(first & (F.col("score") >= least)).select("sa", "sb", "id_b", "score", "ids")


def _best_sets(current: DataFrame, library: DataFrame, least: float, top: int, ids: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The current rows' sets (s, id), the terms by id, and the top library rows of each current set (sa, reference_id, score, rank, with ids those of the shared terms).

    Distinct sets are compared, not rows, and of a set only the terms that the other side has too. These are ordered by rarity.
    To reach least, a pair has to share so many terms of the smaller set that the first two of those shared are among its few
    rarest; so the pairs of its rarest terms are looked up among the other side's pairs of terms (its rarest terms alone, if one
    shared term is enough). The library's keys are broadcast in blocks of a bounded size, so pairs of sets that don't reach least
    are neither shuffled nor written, and of those that do each current set's top ones of each block.
    """
    # all rows are written, as a condition on the terms would be moved before the current rows are sorted out and have them made twice
    a = materialise(current.select(F.monotonically_increasing_id().alias("row"), F.col("current_id").alias("id"), "terms"), "links_a")
    b = materialise(library.select(F.monotonically_increasing_id().alias("row"), F.col("reference_id").alias("id"), "terms"), "links_b")
    ta, tb = (x.select("row", "id", F.size("terms").alias("n"), F.explode("terms").alias("t")) for x in (a, b))
    in_a, in_b = ta.groupBy("t").agg(F.count(F.lit(1)).alias("x")), tb.groupBy("t").agg(F.count(F.lit(1)).alias("y"))
    # ids in order of rarity
    terms = materialise(in_a.join(in_b, "t").orderBy(F.col("x") + F.col("y"), "t").select("t", F.monotonically_increasing_id().alias("term")), "links_terms")
    known = F.broadcast(terms) if terms.count() <= TERM_BLOCK else terms

    def reduced(side: DataFrame, label: str) -> DataFrame:
        """id, its set's key, the number of all its terms and the ids of those that both sides have."""
        sets = side.join(known, "t").groupBy("row", "id", "n").agg(F.array_sort(F.collect_list("term")).alias("r"))
        return materialise(sets.select("id", F.xxhash64("n", "r").alias("s"), "n", "r"), label)

    ra, rb = reduced(ta, "links_sets_a"), reduced(tb, "links_sets_b")

    def distinct(side: DataFrame, x: str) -> DataFrame:
        marks = F.aggregate("r", F.lit(0).cast("bigint"), lambda m, t: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(t), F.lit(64)).cast("int"))))
        # the least of structs: null comes first, as in the order of the links
        least_id = [F.min(F.struct("id"))["id"].alias("id_b")] if x == "b" else []
        once = side.groupBy("s").agg(F.any_value("n").alias("n"), F.any_value("r").alias("r"), *least_id)
        return materialise(once.select(F.col("s").alias(f"s{x}"), F.col("n").alias(f"n{x}"), F.col("r").alias(f"r{x}"), *once.columns[3:], marks.alias(f"marks_{x}"), _fewest(F.col("n"), least).alias(f"fewest_{x}")), f"links_once_{x}")

    da, db = distinct(ra, "a"), distinct(rb, "b")
    # of a set's terms in order of rarity, so many are its rarest
    rare = lambda x: F.size(f"r{x}") - F.col(f"fewest_{x}") + F.least(F.col(f"fewest_{x}"), F.lit(2))

    def rarest(sets: DataFrame, x: str) -> DataFrame:
        few, r = F.col(f"fewest_{x}"), f"r{x}"
        return _term_keys(sets.where(F.size(r) >= few), F.slice(r, F.lit(1), rare(x)), few > 1, few <= 1)

    # a term alone is a key only if one shared term is enough for a set of the other side
    lone = lambda x: F.coalesce(F.bool_or(F.col(f"fewest_{x}") <= 1), F.lit(False))
    lone_a = da.agg(lone("a")).first()[0]
    n, k = F.size("rb").cast("bigint"), rare("b").cast("bigint")
    rare_keys = F.when(F.size("rb") < F.col("fewest_b"), 0).when(F.col("fewest_b") > 1, k * (k - 1) / 2).otherwise(k)
    all_keys = n * (n - 1) / 2 + (n if lone_a else 0)
    *keys, lone_b = db.agg(F.coalesce(F.sum(rare_keys), F.lit(0)), F.coalesce(F.sum(all_keys), F.lit(0)), lone("b")).first()
    # the passes over the current sets are of very different cost, so each has as few blocks as its own keys need
    rare_blocks, all_blocks = (max(1, -(-int(x) // KEY_BLOCK)) for x in keys)
    block = lambda i, of: db.where(F.pmod(F.xxhash64("sb"), F.lit(of)) == i)
    found = None
    for i in range(max(rare_blocks, all_blocks)):
        met = []
        if i < rare_blocks:
            met.append(_met(_term_keys(da, F.col("ra"), F.lit(True), F.lit(lone_b)), rarest(block(i, rare_blocks), "b"), "b", F.col("nb") <= F.col("na"), least))
        if i < all_blocks:
            met.append(_met(rarest(da, "a"), _term_keys(block(i, all_blocks), F.col("rb"), F.lit(True), F.lit(lone_a)), "a", F.col("na") < F.col("nb"), least))
        pairs = met[0] if len(met) == 1 else met[0].union(met[1])
        # pairs grow with the product of both sides; the first rows in order are of the first sets in order, so no more sets than rows are wanted
        pairs = pairs if ids else pairs.drop("ids")
        ahead = F.row_number().over(Window.partitionBy("sa").orderBy(F.desc("score"), "id_b", "sb"))
        pairs = materialise(pairs.withColumn("k", ahead).where(F.col("k") <= top).drop("k", "id_b"), "links_pairs")
        found = pairs if found is None else found.union(pairs)
    # of each set the first ids in order are enough for the top
    refs = rb.select(F.col("s").alias("sb"), F.col("id").alias("reference_id"))
    first = refs.withColumn("k", F.row_number().over(Window.partitionBy("sb").orderBy("reference_id"))).where(F.col("k") <= top).select("sb", "reference_id")
    order = Window.partitionBy("sa").orderBy(F.desc("score"), "reference_id")
    return ra.select("s", "id"), known, found.join(first, "sb").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).drop("sb")


def term_links(current: DataFrame, library: DataFrame, least: float = 0.5, top: int = 3, told: bool = True) -> DataFrame:
    """current_id, reference_id, score, shared, rank: the top library sets of terms for each current one, by overlap.

    current: current_id, terms; library: reference_id, terms. told: with shared, the longest terms of those shared.
    """
    rows, terms, best = _best_sets(current, library, least, top, told)
    if told:
        words = best.select("sa", "reference_id", "score", "rank", F.explode("ids").alias("term")).join(terms, "term").groupBy("sa", "reference_id", "score", "rank").agg(F.array_sort(F.collect_list(F.struct((-F.length("t")).alias("n"), "t"))).alias("w"))
        best = words.select("sa", "reference_id", "score", F.array_join(F.slice(F.transform("w", lambda e: e["t"]), 1, 8), "|").alias("shared"), "rank")
    out = rows.select(F.col("id").alias("current_id"), F.col("s").alias("sa")).join(best, "sa")
    # written, as callers read the links more than once
    return materialise(out.select("current_id", "reference_id", "score", *["shared"] * told, "rank"), "links")


def linked(current: DataFrame, library: DataFrame, least: float = 0.5, top: int = 3) -> DataFrame:
    """reference_id of term_links, which needs the sets' links alone."""
    return _best_sets(current, library, least, top, False)[2].select("reference_id").distinct()


def tiers(links: DataFrame, strong: float = 0.85, reused: int = 3) -> DataFrame:
    """current_id, reference_id, score and tier of each best link: broad if its library entry is the best of several, else strong or other."""
    best = links.where("rank = 1")
    uses = best.groupBy("reference_id").agg(F.count(F.lit(1)).alias("uses"))
    return best.join(uses, "reference_id").select("current_id", "reference_id", "score", "uses", F.when(F.col("uses") >= reused, "broad").when(F.col("score") >= strong, "strong").otherwise("other").alias("tier"))


def best_linked(links: DataFrame, most: int) -> DataFrame:
    """current_id and best score of the rows with the best links, a report; equals go by id."""
    return links.groupBy("current_id").agg(F.max("score").alias("best")).orderBy(F.desc("best"), "current_id").limit(most)


def unlinked(library: DataFrame, links: DataFrame) -> DataFrame:
    return library.join(links.select("reference_id").distinct(), "reference_id", "left_anti")


def cascade(current: DataFrame, library: DataFrame) -> DataFrame:
    """current_id, reference_id, match_type and score: by whole path, by code and leaf, by the last two levels with one path the other's end, by alias.

    current and library: id and levels, library also aliases if it has any. Of each path the least id stands for its copies
    on the library side, so a hot path joins once; ties go to the least id.
    """
    def keyed(df: DataFrame, name: str) -> DataFrame:
        levels = F.filter(F.transform("levels", X.level_key), lambda x: x != "")
        code = F.replace(F.regexp_extract(F.array_join("levels", " "), r"[0-9]+(?:[.．][0-9]+)+", 0), F.lit("．"), F.lit("."))
        return df.select(F.col("id").alias(name), levels.alias("k"), code.alias("code")).where("size(k) > 0")

    def keys(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        leaf = F.try_element_at("k", F.lit(-1))
        whole = df.select(name, F.array_join("k", "/").alias("key"))
        code = df.where("code <> ''").select(name, F.concat_ws("|", "code", leaf).alias("key"))
        ends = df.where("size(k) > 1").select(name, F.array_join(F.slice("k", -2, 2), "/").alias("key"), F.array_join("k", "/").alias("whole"))
        return whole, code, ends

    mine = keyed(current, "current_id")
    a, b = keys(mine, "current_id"), keys(keyed(library, "reference_id"), "reference_id")
    once = lambda df: df.groupBy("key").agg(F.min("reference_id").alias("reference_id"))
    told = lambda df, kind, score: df.select("current_id", "reference_id", F.lit(kind).alias("match_type"), F.lit(score).alias("score"))
    ends = a[2].join(b[2].groupBy("key", F.col("whole").alias("other")).agg(F.min("reference_id").alias("reference_id")), "key")
    suffix = F.col("whole").endswith(F.concat(F.lit("/"), "other")) | F.col("other").endswith(F.concat(F.lit("/"), "whole")) | (F.col("whole") == F.col("other"))
    found = told(a[0].join(once(b[0]), "key"), "exact_path", 1.0).union(told(a[1].join(once(b[1]), "key"), "code_and_leaf", 0.97)).union(told(ends.where(suffix), "parent_and_leaf", 0.94))
    if "aliases" in library.columns:
        aliases = library.select(F.col("id").alias("reference_id"), F.explode("aliases").alias("x")).select("reference_id", X.level_key(F.col("x")).alias("key")).where("key <> ''")
        leaves = mine.select("current_id", F.try_element_at("k", F.lit(-1)).alias("key"))
        found = found.union(told(leaves.join(once(aliases), "key"), "exact_alias", 0.92))
    best = F.min(F.struct((-F.col("score")).alias("s"), "reference_id", "match_type", "score"))
    return found.groupBy("current_id").agg(best.alias("b")).select("current_id", "b.reference_id", "b.match_type", "b.score")


def compared(generated: DataFrame, gold: DataFrame) -> DataFrame:
    """path_key, outcome (matched, missing, extra), the grades of either side and whether they agree, one line for each path.

    Both sides: levels, recommended_grade and ord; of several rows of a path the last counts. Paths are compared without
    numbering, grades without the word for ordinary data.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        key = X.gold_key(F.col("levels"))
        t = df.withColumn("k", key).where("size(k) > 0").select(F.array_join("k", "/").alias("path_key"), "ord", X.gold_grade(F.col("recommended_grade")).alias("g"))
        return t.groupBy("path_key").agg(F.max(F.struct("ord", "g"))["g"].alias(name), F.lit(True).alias(f"has_{name}"))

    t = side(generated, "generated_grade").join(side(gold, "gold_grade"), "path_key", "full_outer")
    outcome = F.when(F.col("has_generated_grade").isNull(), "missing").when(F.col("has_gold_grade").isNull(), "extra").otherwise("matched")
    return t.select("path_key", outcome.alias("outcome"), "generated_grade", "gold_grade", F.when(outcome == "matched", F.col("generated_grade") == F.col("gold_grade")).alias("same_grade"))


def comparison_summary(lines: DataFrame) -> DataFrame:
    """One line of counts and percentages over compared()'s lines."""
    n = {k: F.count_if(F.col("outcome") == k) for k in ("matched", "missing", "extra")}
    t = lines.agg(*(c.alias(k) for k, c in n.items()), F.count_if("same_grade").alias("grade_matches"), F.count_if(~F.col("same_grade")).alias("grade_mismatches"))
    pct = lambda a, b: F.round(a * 100 / F.greatest(b, F.lit(1)), 2)
    return t.select((F.col("matched") + F.col("extra")).alias("generated_rows"), (F.col("matched") + F.col("missing")).alias("reference_rows"), F.col("matched").alias("matched_paths"), pct(F.col("matched"), F.col("matched") + F.col("missing")).alias("coverage_pct"), F.col("missing").alias("missing_paths"), F.col("extra").alias("extra_paths"), "grade_matches", "grade_mismatches", pct(F.col("grade_matches"), F.col("matched")).alias("grade_accuracy_pct"))


def named_elements(rows: DataFrame, elements: DataFrame) -> DataFrame:
    """row_id, element_code, element_name and found for each element a row refers to."""
    names = elements.where("element_code is not null").groupBy("element_code").agg(F.min("element_name").alias("element_name"), F.lit(True).alias("known"))
    refs = rows.select("row_id", F.explode("data_element_refs").alias("element_code")).distinct()
    return refs.join(names, "element_code", "left").select("row_id", "element_code", "element_name", F.coalesce("known", F.lit(False)).alias("found"))


def donations(df: DataFrame) -> DataFrame:
    """receiver and donor: an ungraded row whose path ends with the whole path of a graded row from a shared chunk, if it is that row's only one."""
    t = with_path(df).withColumn("chunks", F.array_distinct(F.filter(F.transform(F.coalesce("evidence_refs", F.array().cast(df.schema["evidence_refs"].dataType)), lambda x: x["chunk_id"]), lambda x: x.isNotNull())))
    short = t.where("recommended_grade is not null").select(F.col("row_id").alias("donor"), "path", F.col("chunks").alias("c1"))
    long = t.where("recommended_grade is null and size(levels) > 1").select(F.col("row_id").alias("receiver"), F.col("chunks").alias("c2"), F.explode(F.transform(F.sequence(F.lit(2), F.size("levels")), lambda n: F.array_join(F.slice("levels", n, F.size("levels")), " / "))).alias("path"))
    # the chunk belongs to the key, so rows meet only where they share one
    pairs = short.withColumn("chunk", F.explode("c1")).join(long.withColumn("chunk", F.explode("c2")), ["path", "chunk"]).select("donor", "receiver").distinct()
    once = pairs.groupBy("donor").agg(F.count(F.lit(1)).alias("n"), F.min("receiver").alias("receiver")).where("n = 1")
    return once.select("receiver", "donor")


def grounded(df: DataFrame) -> DataFrame:
    """row_id, parts and grounded: whether each part of a row's quote stands in one of its references' texts."""
    texts = F.transform(F.coalesce("evidence_refs", F.array().cast(df.schema["evidence_refs"].dataType)), lambda r: X.compact(F.coalesce(r["text"], F.lit(""))))
    parts = quote_parts(F.col("evidence_quote"))
    return df.select("row_id", F.size(parts).alias("parts"), F.forall(parts, lambda p: F.exists(texts, lambda t: t.contains(X.compact(p)))).alias("grounded"))


def weak_descriptions(df: DataFrame) -> DataFrame:
    """row_id, flags and priority of the rows whose description says little."""
    leaf = F.try_element_at("levels", F.lit(-1))
    d = X.strip(F.coalesce("description", F.lit("")))
    insufficient = (d == "") | (d == X.INSUFFICIENT) | (F.coalesce("description_source", F.lit("")) == "insufficient")
    flags = F.when(insufficient, F.array(F.lit("insufficient"))).otherwise(F.filter(F.array(F.when(X.compact(d) == X.compact(leaf), "equals_leaf"), F.when(F.coalesce(F.array_contains("data_range_examples", d), F.lit(False)), "duplicates_example"), F.when((F.length(d) <= 4) & ~d.rlike("[。；;，,]"), "too_short")), lambda x: x.isNotNull()))
    priority = F.col("recommended_grade").isNotNull().cast("int") * 100 + (F.size(F.coalesce("data_range_examples", F.array())) > 0).cast("int") * 10 + F.size("levels")
    return with_path(df).select("row_id", F.array_join(flags, "|").alias("flags"), priority.alias("priority")).where("flags <> ''")


def contexts(rows: DataFrame, chunks: DataFrame, documents: DataFrame, top: int = 5) -> DataFrame:
    """row_id, doc_id, unit_id, line_start, score and rank: the units of the documents a row's evidence is from that hold most of its terms.

    All table rows and windows of lines of such a document count. A row knows its documents by its references alone: one
    without references to known chunks has no document and so no context.
    """
    from .context import line_units

    units = line_units(documents).withColumn("bare", X.compact(F.col("text")))
    none = F.array().cast("array<string>")
    told = F.concat("levels", F.coalesce("data_range_examples", none), F.array("processing_degree", "impact_object", "impact_degree", "recommended_grade"))
    terms = F.array_distinct(F.filter(F.transform(told, X.strip), lambda x: x.isNotNull() & (x != "")))
    wanted = with_path(rows).select("row_id", F.transform(terms, lambda x: F.named_struct(F.lit("t"), x, F.lit("b"), X.compact(x))).alias("terms"), F.explode(F.array_distinct(F.transform("evidence_refs", lambda r: r["chunk_id"]))).alias("chunk_id"))
    wanted = wanted.join(chunks.select("chunk_id", "doc_id"), "chunk_id").drop("chunk_id").dropDuplicates(["row_id", "doc_id"])
    score = F.aggregate("terms", F.lit(0), lambda acc, x: acc + F.when(F.col("text").contains(x["t"]), F.when(F.length(x["t"]) >= 4, 5).otherwise(3)).when((x["b"] != "") & F.col("bare").contains(x["b"]), 3).otherwise(0))
    scored = wanted.join(units, "doc_id").select("row_id", "doc_id", "unit_id", "line_start", score.alias("score")).where("score > 0")
    order = Window.partitionBy("row_id").orderBy(F.desc("score"), "line_start", F.desc(F.col("unit_id").startswith("txt_table_row")), "doc_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
