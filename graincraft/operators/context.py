"""Typed context units of a text and their retrieval for rows.

The lines of a document are told apart by patterns; titles, headings and group ends are carried forward with windows over
the document's lines, and a table row with its continuation lines is an island between two lines that end rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .rows import with_path

# What opens a definition, a heading of either depth, an item.
DEFINITION = r"(?i)^(?:[a-z]\)\s*)?[^\s：:]{2,30}(?:类数据|数据|分类)[：:].+"
PARENT = r"^[0-9]{1,2}\S{1,30}$"
CHILD = r"^[0-9]{2}\S{1,30}$"
ITEM = r"(?:^|\s)(?!19|20)([0-9]{3,4})(?=[^0-9\-—－])"
# Resource types, and what tells a definition of a process.
RESOURCE_TYPES = ("基础资源", "业务资源", "主题资源")
PROCESS = "实施数据分类|开展数据分类工作|按照第[0-9]+章"


def units(documents: DataFrame, text: str = "raw_text") -> DataFrame:
    """doc_id, kind, text, line_start, line_end, table_title and path_hint of the context units of each document; null texts have none.

    A title stands from its line on, for the group that it ends too. A line with an item code opens a row, which takes the
    lines up to the next title, definition, item, heading or blank line. Rows with no title, definition, heading or line on
    grades or risk between them are siblings; two or more make a group. Headings before a row's code, or on lines of their own, are its path.
    """
    lines = documents.select("doc_id", F.posexplode(X.lines(F.col(text))).alias("n", "x")).select("doc_id", (F.col("n") + 1).alias("n"), X.strip(F.col("x")).alias("x"))
    x = F.col("x")
    item_at = F.regexp_instr(x, F.lit(ITEM))
    kind = F.when(x == "", "blank").when(x.startswith("表"), "title").when(x.rlike(DEFINITION), "definition").when(item_at > 0, "item").when(x.rlike(r"^[0-9]{1,2}\S"), "heading").when(X.grade_or_risk(x), "risk").otherwise("other")
    ends = F.col("kind").isin("blank", "title", "definition", "item") | x.rlike(PARENT) | X.grade_or_risk(x) & x.startswith("影响程度")
    order = Window.partitionBy("doc_id").orderBy("n")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(so_far)
    t = lines.withColumn("kind", kind).withColumn("ends", ends)
    t = t.withColumns({"island": F.sum(F.col("ends").cast("int")).over(so_far), "opened": last(F.when(F.col("ends"), F.col("kind")))})
    # lines that a row takes are nothing else
    t = t.withColumn("event", F.when(F.col("ends") | (F.coalesce("opened", F.lit("")) != "item"), F.col("kind")))
    before = F.split(X.strip(F.left(x, item_at - 1)), rf"{X.WS}+")
    one, two = F.try_element_at(before, F.lit(-1)), F.try_element_at(before, F.lit(-2))
    named = F.when(F.col("event") == "item", F.when((F.size(before) > 1) & two.rlike(PARENT) & one.rlike(CHILD), F.struct(two.alias("first"), one.alias("second"), F.lit(False).alias("child"))).when((F.size(before) == 1) & one.rlike(PARENT), F.struct(F.when(~one.rlike(CHILD), one).alias("first"), F.when(one.rlike(CHILD), one).alias("second"), one.rlike(CHILD).alias("child"))))
    own = F.when((F.col("event") == "heading") & x.rlike(PARENT), F.struct(F.when(~x.rlike(CHILD), x).alias("first"), F.when(x.rlike(CHILD), x).alias("second"), x.rlike(CHILD).alias("child")))
    t = t.withColumn("named", F.coalesce(named, own))
    # a heading of the second depth before any other stands for the first
    t = t.withColumn("nth", F.count("named").over(so_far))
    alone = (F.col("nth") == 1) & F.col("named.child")
    t = t.withColumn("named", F.when(F.col("named").isNotNull(), F.struct(F.when(alone, F.col("named.second")).otherwise(F.col("named.first")).alias("first"), F.when(~alone, F.col("named.second")).alias("second"))))
    t = t.withColumns({"first": last(F.col("named.first")), "second": last(F.col("named"))["second"], "table_title": F.coalesce(last(F.when(F.col("event") == "title", x)), F.lit("")), "grp": F.sum(F.col("event").isin("title", "definition", "heading", "risk").cast("int")).over(so_far)})
    t = t.withColumn("grp", F.coalesce("grp", F.lit(0)))
    none = F.array().cast("array<string>")
    singles = t.where(F.col("event").isin("title", "definition", "risk")).select("doc_id", F.when(F.col("event") == "risk", "negative_unit").otherwise(F.concat("event", F.lit("_unit"))).alias("kind"), x.alias("text"), F.col("n").alias("line_start"), F.col("n").alias("line_end"), "table_title", none.alias("path_hint"))
    begun = X.strip(F.substring(x, F.greatest(item_at, F.lit(1)), F.length(x)))
    taken = t.where(F.coalesce("opened", F.lit("")) == "item").select("doc_id", "island", "n", F.when(F.col("event") == "item", begun).otherwise(x).alias("x"), "table_title", "grp", F.filter(F.array("first", "second", F.get(F.split(begun, rf"{X.WS}+"), F.lit(0))), lambda h: h.isNotNull()).alias("path_hint"))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", c))), lambda e: e[c]), "\n")
    rows = taken.groupBy("doc_id", "island").agg(joined("x").alias("text"), F.max("n").alias("line_end"), F.min(F.struct("n", "table_title", "grp", "path_hint")).alias("f")).select("doc_id", F.col("f.n").alias("n"), "text", "line_end", "f.table_title", "f.grp", "f.path_hint")
    ending = t.where(F.col("event") == "title").select("doc_id", (F.col("grp") - 1).alias("grp"), F.col("x").alias("closing"))
    groups = rows.groupBy("doc_id", "grp").agg(joined("text").alias("text"), F.count(F.lit(1)).alias("k"), F.min(F.struct("n", "table_title", "path_hint")).alias("f"), F.max("n").alias("line_end")).where("k > 1").join(ending, ["doc_id", "grp"], "left")
    hint = F.slice("f.path_hint", F.lit(1), F.size("f.path_hint") - 1)
    siblings = groups.select("doc_id", F.lit("sibling_group_unit").alias("kind"), "text", F.col("f.n").alias("line_start"), "line_end", F.coalesce("closing", "f.table_title").alias("table_title"), hint.alias("path_hint"))
    return singles.union(rows.select("doc_id", F.lit("table_row_unit").alias("kind"), "text", F.col("n").alias("line_start"), "line_end", "table_title", "path_hint")).union(siblings)


# What ends a row of a table besides the next row's code.
HEADERS = ("数据分类 数据分级", "类 项 目 数据范围及示例 数据加工程度 影响对象 影响程度 数据级别")
CODE = re.compile(r"\d{3}\S+")
TABLE = re.compile(r"表[A-Z]?\d")


def line_units(documents: DataFrame, text: str = "raw_text", size: int = 3) -> DataFrame:
    """doc_id, unit_id, line_start, line_end and text of each document's table rows and of its windows of size lines."""
    schema = "doc_id string, unit_id string, line_start int, line_end int, text string"

    def read(t: str) -> Iterator[tuple[str, int, int, str]]:
        lines = t.splitlines()
        bare = [x.strip() for x in lines]
        ends = [bool(TABLE.match(x)) or x.startswith("附录") or x in HEADERS or bool(CODE.match(x)) for x in bare]
        spans = [("table_row", i, next((k for k in range(i + 1, len(lines)) if ends[k]), len(lines))) for i, x in enumerate(bare) if CODE.match(x)]
        spans += [("lines", i, min(i + size, len(lines))) for i in range(0, len(lines), size)]
        for kind, i, k in spans:
            if whole := "\n".join(x for x in lines[i:k] if x.strip()).strip():
                yield f"txt_{kind}_{i + 1}_{k}", i + 1, k, whole

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(d, *u) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column(text).to_pylist()) for u in read(t or "")]
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([u[i] for u in found], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in schema.split(", ")])

    return documents.select("doc_id", text).mapInArrow(run, schema)


def windows(lines: DataFrame, key: str = "doc_id", size: int = 5) -> DataFrame:
    """Tumbling windows of size lines, blank ones left out of their text."""
    t = lines.where(X.strip(F.col("line")) != "").withColumn("window", F.floor((F.col("line_no") - 1) / size).cast("int"))
    return t.groupBy(key, "window").agg(F.min("line_no").alias("line_start"), F.max("line_no").alias("line_end"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("text"))


WEIGHTS = {"table_row_unit": 6, "definition_unit": 3, "sibling_group_unit": 4}


def _resource_types(text: Column) -> Column:
    return F.filter(F.array(*map(F.lit, RESOURCE_TYPES)), lambda r: text.contains(r))


def packs(rows: DataFrame, found: DataFrame, tops: dict[str, int] | None = None) -> DataFrame:
    """row_id, doc_id, kind, line_start, score and rank: the best units of each kind in the documents a row's evidence is from.

    rows: row_id, path_levels, data_range_examples and doc_id, one line for each document of a row. Definitions count more
    where they name a resource type of the row's path or of the title over its best table row, and less where they tell a
    process. Lines on grades or risk are what is kept out of a description, in order of their lines.
    """
    tops = tops or {"table_row_unit": 5, "definition_unit": 2, "sibling_group_unit": 2, "negative_unit": 5}
    none = F.array().cast("array<string>")
    leaf = X.code_and_name(F.try_element_at("levels", F.lit(-1)))
    t = with_path(rows).withColumn("l", leaf).withColumns({"leaf": X.compact(F.try_element_at("levels", F.lit(-1))), "name": X.compact(F.col("l.name")), "code": F.col("l.code"), "types": _resource_types(F.array_join("levels", " ")), "terms": F.array_distinct(F.filter(F.transform(F.concat("levels", F.coalesce("data_range_examples", none)), lambda x: X.compact(F.coalesce(x, F.lit("")))), lambda x: x != ""))})
    told = found.withColumns({"bare": X.compact(F.col("text")), "row_code": F.regexp_extract(X.strip(F.col("text")), ITEM, 1)})
    j = t.select("row_id", "doc_id", "leaf", "name", "code", "types", "terms").join(told, "doc_id")
    weight = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in WEIGHTS.items() for x in kv)), F.col("kind")), F.lit(0))
    hit = lambda c, n: F.when(c, n).otherwise(0)
    defines = F.col("kind") == "definition_unit"
    score = hit(F.col("bare").contains(F.col("leaf")), 80) + hit((F.col("name") != "") & F.col("bare").contains(F.col("name")), 60) + hit((F.col("code") != "") & (F.col("code") == F.col("row_code")), 10) + weight
    score = score + F.aggregate("terms", F.lit(0), lambda a, x: a + F.when(F.col("bare").contains(x), F.when(F.length(x) >= 4, 4).otherwise(2)).otherwise(0))
    score = score + hit(defines & F.col("text").rlike("(?:" + "|".join(RESOURCE_TYPES) + ")类数据"), 8) - hit(defines & F.col("text").rlike(PROCESS), 20)
    limit = F.element_at(F.create_map(*(F.lit(x) for kv in tops.items() for x in kv)), F.col("kind"))
    scored = j.withColumn("score", score).where(limit.isNotNull())
    plain = scored.where("kind <> 'definition_unit'").where("score > 0 or kind = 'negative_unit'").select("row_id", "doc_id", "kind", "line_start", "score", "table_title")
    best = F.struct((-F.col("score")).alias("s"), "line_start", "doc_id", "table_title")
    over = plain.where("kind = 'table_row_unit'").groupBy("row_id").agg(F.min(best)["table_title"].alias("over"))
    types = F.array_union("types", _resource_types(F.coalesce("over", F.lit(""))))
    more = F.size(F.filter(types, lambda r: F.col("text").contains(r))) * 40
    defined = scored.where(defines).join(over, "row_id", "left").select("row_id", "doc_id", "kind", "line_start", (F.col("score") + more).alias("score"), "table_title")
    place = F.when(F.col("kind") == "negative_unit", 0).otherwise(-F.col("score"))
    w = Window.partitionBy("row_id", "kind").orderBy(place, "line_start", "doc_id")
    return plain.union(defined).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit).select("row_id", "doc_id", "kind", "line_start", "score", "rank")
