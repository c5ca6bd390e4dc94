"""A run of named steps over one state of tables, with a trace of each step, and the command that runs the whole plan.

    python -m graincraft.pipeline DOCUMENTS OUT [--profile full]

reads text files, chunks them, extracts the rows of their tables by rule, normalises and checks them, and writes the results.
"""

from __future__ import annotations

import argparse
import os
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks
from .functions import text as X
from .operators import extract as E
from .operators import grounding as G
from .operators import lines as L
from .operators import quality as Q
from .operators import rows as R
from .sources import files
from .sources.tables import materialise

State = dict[str, DataFrame]
Step = Callable[[State], State]


@dataclass
class Trace:
    """What the steps did: name, status, seconds and the error of one that failed."""

    steps: list[dict] = field(default_factory=list)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, s["step"], s["status"], s["seconds"], s["error"]) for i, s in enumerate(self.steps)], "ord int, step string, status string, seconds double, error string")


def run(state: State, steps: dict[str, Step], trace: Trace) -> State:
    """The state after all steps in order; what a step adds is materialised. A failing step is traced and ends the run."""
    for name, step in steps.items():
        began = time.time()
        try:
            added = {k: materialise(v, name) for k, v in step(state).items()}
        except Exception as e:
            trace.steps.append({"step": name, "status": "failed", "seconds": round(time.time() - began, 3), "error": str(e)[:500]})
            raise
        state = state | added
        trace.steps.append({"step": name, "status": "success", "seconds": round(time.time() - began, 3), "error": None})
    return state


def _chunks(state: State) -> State:
    pages = state["documents"].select("doc_id", F.lit(None).cast("int").alias("page_number"), F.col("raw_text").alias("text"))
    return {"chunks": L.chunk(pages).withColumn("chunk_id", X.stable_id("chunk", F.col("doc_id"), F.col("position").cast("string")))}


def _rows(extractor: E.Extractor) -> Step:
    def step(state: State) -> State:
        chunks = state["chunks"].select("doc_id", "chunk_id", F.col("position").alias("place"), "text")
        segments = L.segments(chunks).select(F.col("chunk_id"), F.concat_ws("#", "chunk_id", "segment").alias("segment_id"), "text").join(chunks.select("chunk_id", "doc_id", "place"), "chunk_id")
        cut = L.batches(segments, "doc_id", ["segment_id"], F.length("text"), 7000).withColumn("batch", F.concat_ws("#", "doc_id", "batch"))
        found = E.extracted(cut.select("batch", "segment_id", "text"), extractor)
        typed = E.typed_rows(found).join(segments.select("segment_id", "chunk_id", "doc_id", "place", F.col("text").alias("segment_text")), "segment_id")
        ref = F.struct("chunk_id", F.lit(None).cast("string").alias("section_title"), F.col("segment_text").alias("text"))
        blank = {c: F.lit(None).cast("string") for c in ("description", "description_source", "description_evidence_quote", "evidence_quote", "grade_evidence_quote", "processing_degree", "impact_object", "impact_degree", "review_reason", "row_role", "evidence_status", "inclusion_status", "status")}
        t = typed.select("row_id", F.col("levels").alias("path_levels"), F.col("grade").alias("recommended_grade"), F.array(ref).alias("evidence_refs"), F.col("levels").alias("original_path_levels"), F.array().cast("array<string>").alias("data_range_examples"), F.lit("explicit").alias("support_level"), F.lit(0.65).cast("double").alias("confidence"), "needs_review", (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) * F.lit(1 << 42) + F.col("place") * F.lit(1 << 16) + F.col("position")).alias("ord")).withColumns(blank)
        return {"rows": R.one_per_row(t)}

    return step


def _checked(state: State) -> State:
    details = Q.details(state["rows"]).drop("levels", "path", "role")
    return {"details": details, "issues": G.issues(details, G.corpus(state["documents"])), "nodes": R.tree(details), "failed": state["rows"].where("false").select("row_id")}


def plan(extractor: E.Extractor = E.table_rows) -> dict[str, Step]:
    return {"chunk": _chunks, "extract": _rows(extractor), "check": _checked}


def main(arguments: list[str] | None = None) -> list[str]:
    p = argparse.ArgumentParser(description="Classification tables from text documents")
    p.add_argument("documents", help="folder, file or glob of .txt and .md files")
    p.add_argument("out")
    p.add_argument("--profile", default=os.environ.get("EXPORT_PROFILE", "deliverable"))
    a = p.parse_args(arguments)
    from .session import session, ship

    spark = SparkSession.getActiveSession() or session()
    ship(spark)
    trace = Trace()
    state = run({"documents": files.text_documents(spark, a.documents)}, plan(), trace)
    gate = Q.gate(state["details"], *(int(os.environ[k]) if os.environ.get(k, "").isdigit() else None for k in ("RUN_QUALITY_MIN_ROWS", "RUN_QUALITY_MIN_QUOTED_DESCRIPTIONS", "RUN_QUALITY_MAX_INSUFFICIENT_DESCRIPTIONS", "RUN_QUALITY_MIN_REFERENCE_PREFILLED_ROWS")))
    written = sinks.export(state["details"], state["nodes"], state["issues"], gate, a.out, a.profile)
    sinks.write_json(trace.table(spark), f"{a.out.rstrip('/')}/trace.json")
    return written


if __name__ == "__main__":
    main()
