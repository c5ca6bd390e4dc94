"""Extraction of rows from segments behind a replaceable table function, with a cache, retries and a dead letter.

An extractor turns a batch of segments into rows of text fields. The rule-based one reads Markdown and piped tables; the
replay one answers from stored responses; another may call a service. Results are kept by the batch's signature, so a
second run extracts only what has changed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .lines import signature, to_do

Extractor = Callable[[list[tuple[str, str]]], str]
RESULT = "batch string, segment_id string, position int, levels array<string>, grade string, error string"


def table_rows(segments: list[tuple[str, str]]) -> str:
    """The rows of the piped tables in the segments, and of lines that begin with a code and end with a grade, as JSON; a cell of digits and the word for grade is the grade."""
    out = []
    for name, text in segments:
        for line in (text or "").splitlines():
            line = line.strip()
            if line.count("|") >= 2:
                cells = [c.strip() for c in line.strip("|").split("|")]
                if all(re.fullmatch(r":?-+:?", c) for c in cells):
                    continue
            elif re.match(r"\d{2,4}\s+\S.*(?:\d级|level ?\d)$", line):
                cells = re.split(r"\s{2,}|\t" if "  " in line else r"\s+", line)[1:]
            else:
                continue
            grade = next((c for c in cells if re.fullmatch(r"第?\d级|level ?\d", c)), None)
            levels = [c for c in cells if c and c != grade]
            if levels:
                out.append({"segment_id": name, "levels": levels, "grade": grade})
    return json.dumps({"rows": out}, ensure_ascii=False)


def replay(stored: dict[str, str]) -> Extractor:
    """Answers by the first segment's id; an unknown one gets an answer that isn't JSON."""
    return lambda segments: stored.get(segments[0][0], "no answer stored")


def parsed(answer: str) -> list[dict]:
    """The rows of an answer; a ValueError if it holds no JSON object with an array of rows."""
    m = re.search(r"\{.*\}", answer or "", re.S)
    if not m:
        raise ValueError("no JSON object")
    rows = json.loads(m[0]).get("rows")
    if not isinstance(rows, list):
        raise ValueError("rows is not an array")
    return [r for r in rows if isinstance(r, dict)]


def run_batch(segments: list[tuple[str, str]], extractor: Extractor, attempts: int = 2) -> list[tuple]:
    """segment_id, position, levels, grade and error of a batch: tried again, then segment by segment; a failing segment gives its error."""
    why = ""
    for _ in range(attempts):
        try:
            rows = parsed(extractor(segments))
            return [(r.get("segment_id") or segments[0][0], n, [str(x) for x in r.get("levels") or []], r.get("grade"), None) for n, r in enumerate(rows)]
        except (ValueError, TypeError) as e:
            why = str(e)
    if len(segments) > 1:
        return [x for s in segments for x in run_batch([s], extractor, attempts)]
    return [(segments[0][0], 0, [], None, why)]


def extracted(segments: DataFrame, extractor: Extractor = table_rows) -> DataFrame:
    """batch, segment_id, position, levels, grade and error. segments: batch, segment_id and text; a batch is bounded by its budget."""

    def run(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in groups:
            rows = [(b, *r) for b, items in zip(g["batch"], g["items"]) for r in run_batch([(x["segment_id"], x["text"]) for x in items], extractor)]
            yield pd.DataFrame(rows, columns=["batch", "segment_id", "position", "levels", "grade", "error"])

    packed = segments.groupBy(F.col("batch").cast("string").alias("batch")).agg(F.array_sort(F.collect_list(F.struct("segment_id", "text"))).alias("items"))
    return packed.mapInPandas(run, RESULT)


def resumed(segments: DataFrame, cache: DataFrame, extractor: Extractor = table_rows) -> tuple[DataFrame, DataFrame]:
    """Results of the batches whose signature the cache lacks, and the cached results of the others."""
    signed = signature(segments, ["batch"], "segment_id", "segment_id", "text")
    work = to_do(signed, cache, "signature")
    fresh = extracted(segments.join(work.select("batch"), "batch", "left_semi"), extractor).join(signed.withColumn("batch", F.col("batch").cast("string")), "batch")
    return fresh, cache.join(signed.select("signature"), "signature", "left_semi")


def typed_rows(results: DataFrame) -> DataFrame:
    """Rows with a path, a stable id and a flag for review where the grade is missing."""
    t = results.where("error is null").withColumn("levels", X.clean_levels(F.col("levels"))).where("size(levels) > 0")
    path = F.array_join("levels", " / ")
    return t.select(X.stable_id("row", F.concat(path, F.lit("|"), F.coalesce("grade", F.lit("")))).alias("row_id"), "segment_id", "position", "levels", path.alias("path"), "grade", F.col("grade").isNull().alias("needs_review"))
