"""Readers for text files, rule tables, libraries, checkpoints and element catalogues. Broken records become data, not failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X

ROW = "row_id string, path_levels array<string>, recommended_grade string, description string, description_source string, evidence_quote string, data_range_examples array<string>, data_element_refs array<string>, support_level string, confidence double, needs_review boolean, status string"
SUFFIXES = (".txt", ".md")


def text_documents(spark: SparkSession, *paths: str) -> DataFrame:
    """doc_id (a digest of the path), doc_name, file_path and raw_text, one document a file. Paths, and files that a glob finds, of other suffixes are refused."""
    wrong = [p for p in paths if not p.lower().endswith(SUFFIXES) and "*" not in p]
    if wrong:
        raise ValueError(f"not a text file: {', '.join(wrong)}")
    t = spark.read.text(list(paths), wholetext=True).select(F.col("value").alias("raw_text"), F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("doc_name"))
    known = F.lower("doc_name").rlike(r"\.(?:txt|md)$")
    checked = F.when(known, F.col("raw_text")).otherwise(F.raise_error(F.concat(F.lit("not a text file: "), "file_path")))
    return t.select(X.stable_id("doc", F.col("file_path")).alias("doc_id"), "doc_name", "file_path", checked.alias("raw_text"))


def rule_table(spark: SparkSession, *paths: str) -> DataFrame:
    """The rows of rule tables: those of classification_rows, else of rows. Unknown keys are dropped, records that aren't objects left out."""
    t = spark.read.schema(f"classification_rows array<struct<{_fields()}>>, rows array<struct<{_fields()}>>").option("multiLine", True).json(list(paths))
    return t.select(F.col("_metadata.file_path").alias("file_path"), F.explode(F.coalesce("classification_rows", "rows")).alias("r")).where("r is not null").select("file_path", "r.*")


def _fields() -> str:
    return ", ".join(f"{n}: {t}" for n, t in (x.split(" ", 1) for x in ROW.split(", ")))


def _folder(spark: SparkSession, at: str) -> list[str]:
    """The names of the subfolders and files of a folder, in order; none if it doesn't exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(path)) if fs.exists(path) else []


def library(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every library in the folder's subfolders, each with the metadata beside them.

    A subfolder holds rule_table.json and metadata.json, or folders rule_table and metadata as sinks.promote writes them. One
    with neither is passed over, one with only one of the two is an error.
    """
    folder = folder.rstrip("/")
    files: dict[bool, list[str]] = {True: [], False: []}
    metas: list[str] = []
    for name in _folder(spark, folder):
        inside = set(_folder(spark, f"{folder}/{name}"))
        table, meta = inside & {"rule_table.json", "rule_table"}, inside & {"metadata.json", "metadata"}
        if bool(table) != bool(meta):
            raise ValueError(f"{folder}/{name} has only one of rule table and metadata")
        if table:
            one = min(table)
            files[one == "rule_table"].append(f"{folder}/{name}/{one}")
            metas.append(f"{folder}/{name}/{min(meta)}")
    at = F.regexp_extract(F.replace(F.col("file_path"), F.lit("file:/"), F.lit("/")), rf"/([^/]+)/(?:rule_table|metadata)(?:\.json|/[^/]*)$", 1)
    none = spark.createDataFrame([], "file_path string, " + ROW)
    whole = rule_table(spark, *files[False]) if files[False] else none
    written = spark.read.schema(ROW).json(files[True]).select(F.col("_metadata.file_path").alias("file_path"), "*") if files[True] else none
    rows = whole.unionByName(written).withColumn("folder", at)
    if not metas:
        return rows.selectExpr("*", "cast(null as string) as name", "cast(null as string) as source_type", "cast(null as string) as reuse_policy", "cast(null as string) as reference_trust_level")
    meta = spark.read.schema("name string, source_type string, reuse_policy string, reference_trust_level string").option("multiLine", True).json(metas).select("*", F.col("_metadata.file_path").alias("file_path")).withColumn("folder", at)
    meta = meta.select("folder", "name", "source_type", F.coalesce("reuse_policy", F.lit("assist")).alias("reuse_policy"), F.coalesce("reference_trust_level", F.lit("auxiliary")).alias("reference_trust_level"))
    return rows.join(meta, "folder")


def checkpoints(spark: SparkSession, *paths: str, signature: str | None = None) -> DataFrame:
    """file_path, line_no, batch_index, batch_count, n_rows, elapsed_seconds, signature and corrupt of each line that isn't blank, of the signature if one is given.

    Files are read by lines, so a long file is many tasks; line_no is the line's place in its file by its byte block and rises with it.
    """
    t = spark.read.text(list(paths), lineSep="\n").select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), F.col("value").alias("line")).where(X.strip(F.col("line")) != "")
    fields = "batch_index int, batch_count int, elapsed_seconds double, signature string, row_count int, rows array<string>, classification_rows array<string>, _corrupt string"
    r = F.from_json("line", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    size = F.coalesce(F.when(r["classification_rows"].isNotNull(), F.size(r["classification_rows"])), F.when(r["rows"].isNotNull(), F.size(r["rows"])), r["row_count"], F.lit(0))
    out = t.select("file_path", (F.col("block") * F.lit(1 << 33) + F.pmod("n", F.lit(1 << 33)) + 1).alias("line_no"), r["batch_index"].alias("batch_index"), r["batch_count"].alias("batch_count"), size.alias("n_rows"), r["elapsed_seconds"].alias("elapsed_seconds"), r["signature"].alias("signature"), r["_corrupt"].isNotNull().alias("corrupt"))
    return out.where(F.col("signature") == signature) if signature else out


# Labels of an element's fields, in the order they are written.
ELEMENT_FIELDS = {"element_name": "数据元名称", "definition": "定义", "data_type": "数据元值的数据类型", "display_format": "表示格式", "allowed_values": "数据元允许值"}
ELEMENT_ID = r"DE[0-9]{2}\.[0-9]{2}\.[0-9]{3}\.[0-9]{2}"


def _behind_first(parts: Column) -> Column:
    return F.slice(parts, F.lit(2), F.size(parts))


def elements(df: DataFrame, text: str = "raw_text") -> DataFrame:
    """element_code, the fields by their labels, and value_domain_refs of each entry in catalogue texts."""
    clean = F.regexp_replace(F.regexp_replace(F.col(text), r"\r\n?", "\n"), r"(?m)^\s*(?:[A-Z]+/T\s+[0-9]+\.[0-9]+—[0-9]{4}|[IVX]+|[0-9]+)\s*\n", "")
    entries = df.select(F.explode(_behind_first(F.split(clean, rf"(?m)^数据元标识符\s+(?={ELEMENT_ID})"))).alias("body"))
    labels = "|".join(ELEMENT_FIELDS.values())
    fields = [F.trim(F.regexp_replace(F.regexp_extract("body", rf"(?s)(?:^|\n){v}\s*(.*?)(?=\n(?:{labels})|\z)", 1), r"\s+", " ")).alias(k) for k, v in ELEMENT_FIELDS.items()]
    t = entries.select(F.regexp_extract("body", rf"^({ELEMENT_ID})", 1).alias("element_code"), *fields)
    part, code = (F.regexp_extract_all("allowed_values", F.lit(r"([A-Z]+/T)\s+([0-9]+\.[0-9]+)\s+(CV[0-9]{2}\.[0-9]{2}\.[0-9]{3})"), F.lit(i)) for i in (2, 3))
    kind = F.regexp_extract_all("allowed_values", F.lit(r"([A-Z]+/T)\s+([0-9]+\.[0-9]+)\s+(CV[0-9]{2}\.[0-9]{2}\.[0-9]{3})"), F.lit(1))
    return t.withColumn("value_domain_refs", F.zip_with(F.zip_with(kind, part, lambda a, b: F.concat(a, F.lit(" "), b)), code, lambda a, b: F.concat(a, F.lit(":"), b)))


def element_files(spark: SparkSession, *paths: str) -> DataFrame:
    """part and the elements of each catalogue file; the part is the number behind the standard's name. Two files of one part are an error, files without a part are passed over."""
    t = spark.read.text(list(paths), wholetext=True).select(F.col("value").alias("raw_text"), F.col("_metadata.file_path").alias("source_path"))
    t = t.withColumn("part", F.regexp_extract("raw_text", r"[A-Z]{2}/T\s*[0-9]+\.([0-9]+)\s*[—-]\s*[0-9]{4}", 1)).where("part <> ''")
    twice = t.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("source_path")).alias("files")).where("n > 1").orderBy("part").first()
    if twice:
        raise ValueError(f"part {twice['part']} is in {', '.join(twice['files'])}")
    out = None
    for p in sorted(r["part"] for r in t.select("part").collect()):
        one = elements(t.where(F.col("part") == p)).withColumn("part", F.lit(p))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no catalogue part found")
    return out


def element_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """element_code, element_name and part of an element library as sinks.element_library writes it; of an element in several parts the last part's counts."""
    t = spark.read.schema("element_code string, element_name string, part string").json(f"{folder.rstrip('/')}/parts").where("element_code is not null")
    return t.groupBy("element_code").agg(F.max(F.struct("part", "element_name")).alias("m")).select("element_code", "m.element_name", "m.part")


def reference_spec(spec: str) -> tuple[str, str, str]:
    """Path, type and name of a library named as path:type:name; the path may hold colons."""
    parts = spec.rsplit(":", 2)
    if len(parts) != 3 or not all(x.strip() for x in parts):
        raise ValueError(f"not path:type:name: {spec}")
    return parts[0], parts[1], parts[2]


# Where a saved run keeps its checkpoints, the first that exists counts, and patterns for runs that keep them elsewhere.
CHECKPOINTS = {
    "rows": (("classification_row_batches", "row_checkpoint", "classification_rows_checkpoint", "classification_rows"), ("row*checkpoint", "classification*row")),
    "evidence": (("evidence_claim_batches", "evidence_checkpoint", "evidence_claims_checkpoint", "evidence_claims"), ("evidence*checkpoint", "evidence*claim")),
    "blocks": (("block_signal_batches", "block_checkpoint", "document_blocks_checkpoint", "document_blocks"), ("block*checkpoint", "document*block")),
}


def saved_run(spark: SparkSession, folder: str) -> dict[str, str]:
    """The files of a saved run by what they hold: table, tree, report, checkpoints, debug files and traces. What isn't there has no entry."""
    from fnmatch import fnmatchcase

    folder = folder.rstrip("/")
    top, inner = _folder(spark, folder), _folder(spark, f"{folder}/checkpoints")
    out = {k: f"{folder}/{n}" for k, n in (("table", "rule_table.json"), ("tree", "rule_tree.json"), ("report", "review_report.md"), ("debug", "debug"), ("traces", "traces")) if n in top}
    for kind, (names, patterns) in CHECKPOINTS.items():
        exact = [f"{folder}/checkpoints/{n}.jsonl" for n in names if f"{n}.jsonl" in inner] + [f"{folder}/{n}.jsonl" for n in names if f"{n}.jsonl" in top]
        loose = [f"{folder}/{sub}{n}" for sub, found in (("", top), ("checkpoints/", inner)) for n in found for p in patterns if fnmatchcase(n, f"*{p}*.jsonl")]
        if exact or loose:
            out[kind] = (exact or sorted(loose))[0]
    return out


def failed_batches(spark: SparkSession, folder: str) -> DataFrame:
    """file_name and text of the dead letters of failed row batches."""
    return spark.read.option("pathGlobFilter", "failed_row_batch_*.txt").text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))
