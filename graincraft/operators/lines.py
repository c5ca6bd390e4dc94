"""Operators on the lines of texts: explode, clean with lineage, chunk into sections, segment tables, batch by budget."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X


def explode_lines(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, line_no (from 1) and line of each line."""
    return df.select(*keep, F.posexplode(X.lines(F.col(text))).alias("pos", "line")).select(*keep, (F.col("pos") + 1).alias("line_no"), F.regexp_replace("line", rf"{X.WS}+$", "").alias("line"))


def high_risk(lines: DataFrame, most: int = 180, merged: int = 4) -> DataFrame:
    """Lines longer than most, or put together from merged source lines or more where lines know theirs, with a preview."""
    many = F.col("source_end") - F.col("source_start") + 1 >= merged if {"source_start", "source_end"} <= set(lines.columns) else F.lit(False)
    text = F.col("text") if "text" in lines.columns else F.col("line")
    return lines.where((F.length(text) > most) | many).withColumn("preview", X.preview(text, most))


# What marks a page number, a row's start and a structure line.
PAGE_NOISE = r"^\s*(?:[-－—–]\s*[0-9]{1,4}\s*[-－—–]|[0-9]{1,4})\s*$"
SINGLE_HAN = r"^[㐀-䶿一-鿿豈-﫿]$"
ROW_START = r"^\s*[0-9]{3,4}(?:\s|$)|^\s*[0-9]+(?:[.．][0-9]+)+(?:\s|$)|^\s*[0-9]{1,2}\s+\S.{2,}\s+[0-9]{1,3}(?:\s|$)"
POLICY_HEADING = r"^\s*[0-9]{1,2}\s+[㐀-䶿一-鿿豈-﫿A-Za-z][^0-9]{0,24}$"
LETTER_CATEGORY = r"^\s*[A-Z]、\S+"
GLUED_LETTER = r"^([A-Z]、\S+)\s+([1-9][0-9]?\s+\S.+)$"
GLUED = r"(?<=[㐀-䶿一-鿿豈-﫿])\s*[—-]?\s*([1-9][0-9]?\s+[㐀-䶿一-鿿豈-﫿][^0-9\s]{1,12})(?=\s+[0-9]{2}\s)"


def _islands(df: DataFrame, key: str, starts: Column) -> DataFrame:
    """With island: the number of starts up to each line, in line order within key."""
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("island", F.sum(starts.cast("int")).over(w))


def clean_lines(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, line_no, source_start, source_end, transform and text: page numbers dropped, runs of single Han characters and wrapped rows merged, glued headings split.

    The window runs within one document, whose lines are bounded by its text.
    """
    w = Window.partitionBy(key).orderBy("line_no")
    t = lines.select(key, "line_no", "line").withColumns({"noise": F.col("line").rlike(PAGE_NOISE), "single": X.strip(F.col("line")).rlike(SINGLE_HAN)})
    t = t.withColumn("before", F.coalesce(F.lag("single").over(w), F.lit(False)))
    runs = _islands(t, key, ~(F.col("single") & F.col("before"))).where(~F.col("noise"))
    merged = runs.groupBy(key, "island").agg(F.min("line_no").alias("source_start"), F.max("line_no").alias("source_end"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "").alias("line"))
    merged = merged.withColumnRenamed("source_start", "line_no").withColumn("first_kind", F.when(F.col("source_end") > F.col("line_no"), "merge_single_char").otherwise("preserve"))
    bare = X.strip(F.col("line"))
    policy = bare.rlike(POLICY_HEADING)
    begins = bare.rlike(ROW_START) & ~policy
    structure = X.structure_signal(F.col("line")).isNotNull() | bare.rlike(LETTER_CATEGORY)
    rows = _islands(merged.drop("island").withColumn("row_like", begins), key, begins | policy | structure | (bare == ""))
    head = F.first("row_like").over(Window.partitionBy(key, "island").orderBy("line_no"))
    rows = rows.withColumn("part", F.when(head, F.lit(0)).otherwise(F.col("line_no")))
    joined = rows.groupBy(key, "island", "part").agg(F.min("line_no").alias("source_start"), F.max("source_end").alias("source_end"), F.count(F.lit(1)).alias("n"), F.min_by("first_kind", "line_no").alias("kind"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x, k: F.when(k == 0, x["line"]).otherwise(X.strip(x["line"]))), " ").alias("text"))
    joined = joined.withColumn("transform", F.when(F.col("n") > 1, "merge_wrapped_row").otherwise(F.col("kind")))
    bare = X.strip(F.col("text"))
    numbered = F.split(F.regexp_replace(bare, GLUED, "\u0001$1"), "\u0001")
    lettered = F.array(F.regexp_extract(bare, GLUED_LETTER, 1), F.regexp_extract(bare, GLUED_LETTER, 2))
    cut = F.when(bare.rlike(GLUED_LETTER), lettered).otherwise(F.filter(F.transform(numbered, X.strip), lambda x: x != ""))
    pieces = F.when(F.size(cut) > 1, cut).otherwise(F.array("text"))
    out = joined.withColumn("transform", F.when(F.size(pieces) > 1, "split_glued_heading").otherwise(F.col("transform"))).select(key, "source_start", "source_end", "transform", F.posexplode(pieces).alias("k", "text"))
    return out.withColumn("line_no", F.row_number().over(Window.partitionBy(key).orderBy("source_start", "k"))).select(key, "line_no", "source_start", "source_end", "transform", "text")


def chunk(pages: DataFrame) -> DataFrame:
    """doc_id, position, page_number, section_title, line_start, line_end and text: pages cut at headings, blank lines and changes between list and text.

    The section title is the chain of the headings in force, one of each level; a heading ends those of its own and deeper levels.
    """
    src = pages.select("doc_id", F.coalesce("page_number", F.lit(0)).alias("page"), "text")
    t = explode_lines(src, "text", ("doc_id", "page"))
    head = X.is_heading(F.col("line"))
    t = t.withColumns({"kind": F.when(F.col("line") == "", "blank").when(head, "heading").when(X.is_list_line(F.col("line")), "list").otherwise("text"), "level": F.when(head, X.heading_level(F.col("line")))})
    order = Window.partitionBy("doc_id").orderBy("page", "line_no")
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("at", F.row_number().over(order))
    for k in (1, 2, 3):
        t = t.withColumn(f"h{k}", F.last(F.when(F.col("level") == k, F.struct("at", X.heading_title(F.col("line")).alias("title"))), ignorenulls=True).over(run))
    valid = [F.col("h1.title"), F.when(F.col("h2.at") > F.coalesce("h1.at", F.lit(0)), F.col("h2.title")), F.when(F.col("h3.at") > F.greatest(F.coalesce("h1.at", F.lit(0)), F.coalesce("h2.at", F.lit(0))), F.col("h3.title"))]
    t = t.withColumn("section", F.concat_ws(" / ", *valid))
    before = F.lag("kind").over(Window.partitionBy("doc_id", "page").orderBy("line_no"))
    cut = before.isNull() | (F.col("kind") == "heading") | (before != F.col("kind")) | (before == "heading")
    t = t.withColumn("block", F.sum(F.coalesce(cut, F.lit(True)).cast("int")).over(run)).where("kind <> 'blank'")
    blocks = t.groupBy("doc_id", "page", "block").agg(F.min("line_no").alias("line_start"), F.max("line_no").alias("line_end"), F.min_by("section", "line_no").alias("section"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("text"))
    title = F.when(F.col("section") != "", F.col("section")).when(F.col("page") > 0, F.concat(F.lit("Page "), F.col("page"))).otherwise("未命名章节")
    return blocks.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "block")).alias("position"), F.nullif("page", F.lit(0)).alias("page_number"), title.alias("section_title"), "line_start", "line_end", "text")


def segments(chunks: DataFrame, budget: int = 5000, key: str = "chunk_id") -> DataFrame:
    """key, segment, header_text, line_start, line_end and text of each chunk cut before header lines and within a budget of characters.

    A header line begins a segment and is carried as header_text of all that follow; leading blank lines are dropped; a line beyond the budget is cut.
    """
    schema = f"{key} string, segment int, header_text string, line_start int, line_end int, text string"

    def pieces(text: str) -> list[tuple[str, int, int, str]]:
        import re

        out: list[tuple[str, int, int, str]] = []
        header, current, size, first = "", [], 0, 1

        def flush(last: int) -> None:
            nonlocal current, size
            if any(x.strip() for x in current):
                out.append((header, first, last, "\n".join(current)))
            current, size = [], 0

        rows = text.split("\n")
        for i, row in enumerate(rows, 1):
            if re.search(r"类\s+项\s+目|资源属性\s+类", row):
                flush(i - 1)
                header = re.sub(r"\s+", " ", row.strip())
                continue
            if not current and not row.strip():
                continue
            if current and size + 1 + len(row) > budget:
                flush(i - 1)
            for a in range(0, max(1, len(row)), budget):
                part = row[a : a + budget]
                if current and size + 1 + len(part) > budget:
                    flush(i)
                if not current:
                    first = i
                current.append(part)
                size += len(part) + (1 if size else 0)
        flush(len(rows))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for k, t in zip(batch.column(key).to_pylist(), batch.column("text").to_pylist()):
                for n, piece in enumerate(pieces(t or "")):
                    for c, v in zip(cols, (k, n, *piece)):
                        c.append(v)
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in schema.split(", ")])

    return chunks.select(key, "text").mapInArrow(run, schema)


def cut_by_count_and_budget(lengths: list[int], most: int, budget: int) -> list[int]:
    """The batch of each item, greedily: closed at most items, or when the next would exceed the budget; a larger item stands alone. Without a budget the count alone closes."""
    out, n, items, total = [], 0, 0, 0
    most, budget = max(1, most), max(0, budget)
    for x in lengths:
        over = budget > 0 and x > budget
        if items and (items >= most or budget > 0 and total + x > budget or over):
            n, items, total = n + 1, 0, 0
        out.append(n)
        items, total = items + 1, total + x
        if over:
            n, items, total = n + 1, 0, 0
    return out


def batches(df: DataFrame, group: str, order: list[str], size: Column, budget: int = 6000, most: int = 1 << 30) -> DataFrame:
    """df with batch: its items put together in order until their number or the budget is reached, within each group.

    What is gathered of a group is its items' order and size alone. order tells a group's items apart; null sizes count as 0.
    """
    fields = [df.schema[group], *(df.schema[c] for c in order)]
    items = df.select(group, *order, F.coalesce(size.cast("long"), F.lit(0)).alias("__n"))
    packed = items.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(*order, "__n"))).alias("x"))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            lists = batch.column("x")
            flat, at = lists.flatten(), lists.offsets.to_pylist()
            sizes = flat.field("__n").to_pylist()
            cut = [b for a, z in zip(at, at[1:]) for b in cut_by_count_and_budget(sizes[a - at[0] : z - at[0]], most, budget)]
            keys = batch.column(group).take(pa.array([k for k, (a, z) in enumerate(zip(at, at[1:])) for _ in range(z - a)], pa.int32()))
            yield pa.RecordBatch.from_arrays([keys, *(flat.field(c) for c in order), pa.array(cut, pa.int32())], names=[group, *order, "batch"])

    schema = T.StructType([*fields, T.StructField("batch", T.IntegerType())])
    cut = packed.mapInArrow(run, schema)
    same = F.lit(True)
    for c in (group, *order):
        same = same & df[c].eqNullSafe(cut[c])
    return df.join(cut, same).select(*(df[c] for c in df.columns), cut["batch"])


def signature(df: DataFrame, group: list[str], order: str | list[str], *parts: str, between: str = "\x00", apart: str = "\x00") -> DataFrame:
    """group and the digest of its rows in order, each row's parts put together with between, rows with apart; nulls count as empty."""
    orders = [order] if isinstance(order, str) else order
    one = F.concat_ws(between, *(F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts))
    rows = F.array_sort(F.collect_list(F.struct(*(F.col(o).alias(f"o{i}") for i, o in enumerate(orders)), one.alias("t"))))
    return df.groupBy(*group).agg(F.sha1(F.array_join(F.transform(rows, lambda x: x["t"]), apart)).alias("signature"))


def to_do(work: DataFrame, cache: DataFrame, *keys: str) -> DataFrame:
    """The work that the cache doesn't hold yet."""
    return work.join(cache.select(*keys).distinct(), list(keys), "left_anti")
