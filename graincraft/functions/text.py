"""Column functions on text: white space, labels, terms, keys, ids, coercions. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space and line ends as the rows were written with, stop terms, the sentinel of a missing description.
WS = r"[\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\x1c-\x1f\x85]"
EOL = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
STOP_TERMS = ["", "数据", "分类", "分级", "信息", "资源", "其他", "类数据", "数据库"]
INSUFFICIENT = "证据不足，无法从当前文档确定"
TERM_BREAKS = r"[，,。；;：:、/\\|（）()《》〈〉<>【】\[\]\"'“”‘’]+"
FULL_WIDTH = "".join(map(chr, [*range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)]))
HALF_WIDTH = "".join(chr(c - 0xFEE0) for c in map(ord, FULL_WIDTH))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{WS}+|{WS}+$", "")


def compact(c: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(c, rf"{WS}+", "")


def one_space(c: Column) -> Column:
    return F.regexp_replace(strip(c), rf"{WS}+", " ")


def lines(c: Column) -> Column:
    """The lines of a text; a last empty line doesn't count, and an empty text has none."""
    ends = F.regexp_replace(F.regexp_replace(c, EOL, "\n"), r"\n\z", "")
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(ends, "\n"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once for a row, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def stable_id(prefix: str, *parts: Column, separator: str = "||") -> Column:
    return F.concat(F.lit(prefix + "_"), F.left(F.sha1(F.concat_ws(separator, *parts)), F.lit(12)))


def preview(c: Column, most: int = 180) -> Column:
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most - 3)), F.lit("..."))).otherwise(c)


def _begins_han(c: Column) -> Column:
    return (c >= "\u3400") & (c < "\ua000")


def _uncoded(c: Column) -> Column:
    # what begins with a Han character has neither letter nor code
    bare = F.regexp_replace(F.regexp_replace(c, r"^[A-Za-z]?[）)、.．]?", ""), r"^[0-9]+(?:[.．][0-9]+)*", "")
    return F.when(_begins_han(c), c).otherwise(bare)


def bare_term(c: Column) -> Column:
    """A text without white space and without the letter and the code it begins with."""
    return let(let(c, lambda t: F.when(t.rlike(WS), compact(t)).otherwise(t)), _uncoded)


def terms(c: Column) -> Column:
    """Distinct terms of two characters or more that are no stop terms, and the whole text if it is short."""
    good = lambda x: (F.length(x) >= 2) & ~x.isin(*STOP_TERMS)
    none = F.array().cast("array<string>")

    def found(text: Column) -> Column:
        # a pattern is compiled anew for each text that it splits, a single mark isn't; what stands between two breaks is too short
        pieces = F.split(F.regexp_replace(text, TERM_BREAKS, ","), ",")
        parts = F.filter(F.transform(pieces, _uncoded), good)
        whole = F.when(F.length(text) <= 12, F.filter(F.array(text), good)).otherwise(none)
        # a text without breaks that is as it stands its only part
        one = F.when(good(text), F.array(text)).otherwise(none)
        return F.when((text == "") | (text == INSUFFICIENT), none).when(_begins_han(text) & ~text.rlike(TERM_BREAKS), one).otherwise(F.array_distinct(F.concat(parts, whole)))

    return let(bare_term(F.coalesce(c, F.lit(""))), found)


def clean_levels(c: Column) -> Column:
    """A path without blank levels, each stripped."""
    return F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: strip(F.coalesce(x, F.lit("")))), lambda x: x != "")


def level_key(c: Column) -> Column:
    """A level without white space, leading letter or code, and edge punctuation; full-width stops and brackets as ASCII."""
    t = compact(F.translate(F.coalesce(c, F.lit("")), "．（）", ".()"))
    t = F.regexp_replace(F.regexp_replace(t, r"^[A-Za-z]?[、.)）.．]+", ""), r"^[0-9]+(?:[.．][0-9]+)*", "")
    return F.regexp_replace(t, r"^[、.)）.．:：\-]+|[、.)）.．:：\-]+$", "")


def gold_level(c: Column, bare_marks: bool = True) -> Column:
    """A level as gold tables are compared by: ASCII brackets, no white space, no leading letter or number; ages keep theirs.

    bare_marks: a letter or number is dropped without a mark behind it too.
    """
    mark = "[、.]?" if bare_marks else "[、.]"
    t = compact(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("（"), F.lit("(")), F.lit("）"), F.lit(")")))
    t = F.regexp_replace(t, f"^[A-Z]{mark}", "")
    return F.when(t.rlike("^[0-9]+(?:周岁|岁)"), t).otherwise(F.regexp_replace(t, f"^[0-9]+{mark}", ""))


def gold_key(levels: Column, bare_marks: bool = True) -> Column:
    none = F.array().cast("array<string>")
    return F.filter(F.transform(F.coalesce(levels, none), lambda x: gold_level(x, bare_marks)), lambda x: x != "")


def gold_grade(c: Column) -> Column:
    return compact(F.replace(F.coalesce(c, F.lit("")), F.lit("一般数据"), F.lit("")))


def path_key(levels: Column) -> Column:
    return F.array_join(F.transform(levels, level_key), "/")


def code_of(c: Column) -> Column:
    """The dotted code at a text's start, or the empty string."""
    return F.regexp_replace(F.regexp_extract(c, r"^\s*([0-9]+(?:\s*[.．]\s*[0-9]+)*)", 1), r"\s|．", "")


def grade_rank(c: Column) -> Column:
    """The first whole number before the word for grade."""
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"([0-9]+)\s*级", 1), F.lit("")).cast("int")


def contains_compact(text: Column, part: Column) -> Column:
    """Whether part stands in text, as it is or without white space; an empty part stands in every text."""
    return F.coalesce(text.contains(part) | compact(text).contains(compact(part)), F.lit(False))


def confidence(c: Column) -> Column:
    return F.round(F.least(F.greatest(F.nanvl(c.cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(1.0)), 3)


def parse_bool(c: Column) -> Column:
    t = F.lower(strip(c.cast("string")))
    return F.when(t.isin("true", "1", "yes", "y", "是"), True).when(t.isin("false", "0", "no", "n", "否", ""), False)


def json_object(c: Column) -> Column:
    """The JSON object in a noisy text: what a fence encloses, else from the first brace to the last."""
    fenced = F.regexp_extract(c, r"(?s)```(?:json)?\s*(\{.*\})\s*```", 1)
    return F.when(fenced != "", fenced).otherwise(F.nullif(F.regexp_extract(c, r"(?s)\{.*\}", 0), F.lit("")))


def visible_length(c: Column) -> Column:
    return F.length(compact(c))


def chunk_signal(text: Column, method: Column) -> Column:
    """possible_noise, table_like, short_ocr, heading_only or normal."""
    def judged(x: Column) -> Column:
        t, bare, rows, marked = x["t"], x["bare"], x["rows"], x["marked"]
        useful = F.length(F.regexp_replace(bare, r"[^一-鿿\p{L}\p{N}]", ""))
        table = (rows >= 2) & (marked >= F.greatest(F.lit(1), F.floor(rows / 2)))
        heading = (F.length(t) <= 40) & (t.rlike(r"^[0-9一二三四五六七八九十]+[.、．]?\s*\S+") | ~t.rlike("[。；;：:，,]"))
        return F.when(t == "", "possible_noise").when(useful / F.length(bare) < 0.35, "possible_noise").when(table, "table_like").when((method == "ocr") & (F.length(t) <= 30), "short_ocr").when(heading, "heading_only").otherwise("normal")

    def measured(t: Column) -> Column:
        full = lambda y: F.length(strip(y)) > 0
        parts = F.filter(lines(t), full)
        return let(parts, lambda r: F.struct(t.alias("t"), compact(t).alias("bare"), F.size(r).alias("rows"), F.size(F.filter(r, lambda y: strip(y).rlike(r"\t|\||\s{2,}"))).alias("marked")))

    return let(let(strip(F.coalesce(text, F.lit(""))), measured), judged)


# The patterns of structure lines, by kind, in order of priority.
STRUCTURE = [
    ("appendix_heading", r"(?iu)^附\s*录\s*[A-ZＡ-Ｚ]\s*$", 0.98),
    ("continued_table_title", r"(?iu)^(?:续\s*表\s*[A-ZＡ-Ｚ]\s*\.?\s*[0-9]+|表\s*[A-ZＡ-Ｚ]\s*\.?\s*[0-9]+\s*[（(]\s*续\s*[）)]).+", 0.95),
    ("table_title", r"(?iu)^表\s*[A-ZＡ-Ｚ]\s*\.?\s*[0-9]+(?:\s*[（(]\s*续\s*[）)])?\s+.+", 0.95),
    ("classification_title", r"^[一-鿿]{2,20}分类\s*$", 0.9),
    ("hierarchy_header", r"类(?:（[^）]+）|\([^)]*\))?\s+项(?:（[^）]+）|\([^)]*\))?\s+目(?:（[^）]+）|\([^)]*\))?|资源属性\s+类.*项.*目", 0.9),
    ("not_appendix_body", r"^[0-9]{1,2}[、.．]\s*[^\s].{0,30}$", 0.75),
]


def structure_signal(line: Column) -> Column:
    """kind, title and confidence of the structure a line shows, or null."""

    def judged(t: Column) -> Column:
        out = F.lit(None).cast("struct<kind:string,title:string,confidence:double>")
        for kind, pattern, sure in reversed(STRUCTURE):
            hit = t.rlike(pattern)
            if kind == "not_appendix_body":
                hit = hit & ~t.rlike(r"\s+[0-9]{1,3}(?:\s|$)")
            title = F.regexp_replace(t, rf"{WS}+", " ")
            if kind == "appendix_heading":
                title = F.concat(F.lit("附录 "), F.upper(F.translate(F.regexp_extract(t, r"(?iu)^附\s*录\s*([A-ZＡ-Ｚ])", 1), FULL_WIDTH, HALF_WIDTH)))
            out = F.when(hit, F.struct(F.lit(kind).alias("kind"), title.alias("title"), F.lit(sure).alias("confidence"))).otherwise(out)
        return out

    return let(strip(line), judged)


# Kinds of structure lines that are headings, marks of other headings, what begins a list line.
HEADING_KINDS = ("appendix_heading", "classification_title", "table_title", "continued_table_title")
HASH_HEADING, HAN_HEADING, NUMBER_HEADING = r"^#{1,6}\s+", r"^[一二三四五六七八九十]+[、.．]\s*", r"^[0-9]+(?:\.[0-9]+)*[、.．]\s*"
LIST_LINE = r"^\s*(?:[-*+]|[0-9]+[.)、．])\s+\S+"


def is_heading(line: Column) -> Column:
    t = strip(line)
    marked = t.rlike(HASH_HEADING + r"\S+") | t.rlike(HAN_HEADING + r"\S+") | t.rlike(NUMBER_HEADING + r"\S+")
    return F.coalesce(structure_signal(line)["kind"].isin(*HEADING_KINDS), F.lit(False)) | marked


def heading_title(line: Column) -> Column:
    """The title of a structure line, or a heading without its marks."""
    bare = strip(line)
    for marks in (HASH_HEADING, HAN_HEADING, NUMBER_HEADING):
        bare = F.regexp_replace(bare, marks, "")
    signal = structure_signal(line)
    return F.when(signal["kind"].isin(*HEADING_KINDS), signal["title"]).otherwise(strip(bare))


def heading_level(line: Column) -> Column:
    kind = structure_signal(line)["kind"]
    return F.when(kind == "classification_title", 2).when(kind.isin("table_title", "continued_table_title"), 3).otherwise(1)


def is_list_line(line: Column) -> Column:
    return line.rlike(LIST_LINE)


# What speaks of grades or risk, and the roles of table header fields.
GRADE_OR_RISK = "影响程度|数据级别|一般数据[0-9]级|重要数据|核心数据|严重危害|特别严重危害|泄露后"
FIELD_ROLES = {
    "classification_path": "类 项 目",
    "description_evidence": "数据范围及示例 数据范围 示例 分类说明",
    "grading_factor": "数据加工程度 影响对象 影响程度",
    "grade_result": "数据级别 推荐级别 推荐分级",
}


def grade_or_risk(c: Column) -> Column:
    return F.coalesce(c.rlike(GRADE_OR_RISK), F.lit(False))


def field_role(c: Column) -> Column:
    """The role of a table's column by its header."""
    roles = [F.lit(x) for role, names in FIELD_ROLES.items() for n in names.split() for x in (n, role)]
    return F.coalesce(F.element_at(F.create_map(*roles), compact(c)), F.lit("metadata_or_unknown"))


def code_and_name(c: Column) -> Column:
    """code and name of a label that begins with a code of three or four figures, else an empty code and the label."""
    t = strip(F.coalesce(c, F.lit("")))
    code = F.regexp_extract(t, r"^([0-9]{3,4})(?=[^0-9\-—－])", 1)
    name = F.regexp_replace(F.substring(t, F.length(code) + 1, F.length(t)), r"^[ “\"]+|[ “\"]+$", "")
    return F.struct(code.alias("code"), F.when(code == "", t).otherwise(name).alias("name"))


def dotted_codes(c: Column) -> Column:
    """Distinct dotted codes in a line, without white space and full-width stops."""
    raw = F.regexp_extract_all(c, F.lit(r"(?<![0-9])([0-9]+(?:\s*[.．]\s*[0-9]+)+)(?![0-9])"), F.lit(1))
    return F.array_distinct(F.transform(raw, lambda x: F.regexp_replace(F.regexp_replace(x, r"\s+", ""), "．", ".")))


def flattened_hint(line: Column) -> Column:
    """Whether a line holds two codes of which one is the other's ancestor."""
    codes = dotted_codes(line)
    return F.exists(codes, lambda a: F.exists(codes, lambda b: b.startswith(F.concat(a, F.lit(".")))))
