"""Several values packed in one string, one row for each value.

A dialect is the set of marks that separate, with the quotation marks protecting or being characters like any other. Every
string is parsed in each dialect its own marks allow, and the cheapest parse counts: each value costs its code length, -log2 of its share among
all values of the field (counted over the whole table, without the string's own places), a value not seen elsewhere its characters one by one; each
separation and each kind of mark in use costs a little, and a separating mark left bare inside a value costs more, as
its writer would have quoted it. Values with many figures are counted by their shape and pay for their figures.

Marks inside quotes or brackets, between two digits, within a unit of measure or a standard's name never separate. White
space separates only line from line, field from field at a tab, one item code from the next, or references from each other.

Defined results: null fields, null and blank strings have no values; a value keeps its item code, is trimmed, loses the
quotes that enclose it, and a doubled quote in it becomes single; empty items are dropped and not counted. An opening
mark without a partner is an ordinary character.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import re
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The marks by kind of field, the quotes and brackets that protect, units with a slash.
MARKS = {"list": ["，", ",", "、", "；", ";", "|", "/", "\t", "\n", "code"], "references": ["，", ",", "、", "；", ";", "|", "/", "\t", "\n", " "], "path": [">", "/", "→", "|", "｜", "；", ";", "\\"]}
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "「": "」", "『": "』", "＂": "＂"}
BRACKETS = {"(": ")", "（": "）", "[": "]", "［": "］", "{": "}", "【": "】", "《": "》", "〔": "〕"}
UNIT = r"(?<![A-Za-z])(?:[mkμµun]?(?:g|L|l|mol|m|IU|U|cal|J|Pa)|mmol|次|例|人|个|片|粒|支|元|cells)/(?:[mkd]?(?:L|l|g|m)|d|h|s|min|kg|次|天|日|周|月|年|人|例|μL|HP)(?![A-Za-z])"
STANDARD = r"[A-Z]{1,6}/[A-Z] ?\d|[A-Z]{2,6} \d"
ITEM_CODE = r"(?:\d{1,3}\s*[.:：=＝）)\-．、]|0\d )"

#: Bits: for a separation, for a kind of mark in use, for a value that must be spelled, for each of its characters, for a figure of a shape.
SEPARATION, KIND, SPELLED, CHARACTER, FIGURE = 2.0, 1.0, 8.0, 6.0, 3.3
#: Bits for a bare mark in a value, by kind of field: in paths and references it would have been quoted, in lists there are remarks.
BARE = {"list": 6.0, "references": 16.0, "path": 24.0}

_PROTECTED = re.compile(f"{UNIT}|{STANDARD}")
_CODE_SPACE = re.compile(rf"\s+(?={ITEM_CODE})")
_STARTS_CODED = re.compile(rf"\s*{ITEM_CODE}")
_CODE = re.compile(rf"^\s*{ITEM_CODE}\s*")
_TRIM = " \t\r\n　 "


def _marks(text: str, kind: str, quoting: bool = True) -> list[tuple[int, int, str]]:
    """Start, end and mark of each place that may separate."""
    allowed = MARKS[kind]
    free = bytearray(b"\x01" * len(text))
    for m in _PROTECTED.finditer(text):
        for i in range(*m.span()):
            free[i] = 0
    i, n = 0, len(text)
    fresh = True  # a quote opens only where a value begins
    while i < n:
        c = text[i]
        if quoting and c in QUOTES and (fresh or c not in "'\"＂"):
            end = QUOTES[c]
            j = text.find(end, i + 1)
            while j >= 0 and end == c and text[j + 1 : j + 2] == c:
                j = text.find(end, j + 2)
            if j >= 0:
                free[i : j + 1] = bytes(j + 1 - i)
                i = j + 1
                fresh = False
                continue
        if c in BRACKETS:
            depth, j = 1, i + 1
            while j < n and depth:
                depth += (text[j] == c) - (text[j] == BRACKETS[c])
                j += 1
            if not depth:
                free[i:j] = bytes(j - i)
                i = j
                fresh = False
                continue
        fresh = c in allowed or c.isspace() and fresh or c in "=：:" or bool(c == " ")
        i += 1
    out = []
    for i, c in enumerate(text):
        if free[i] and c in allowed and c != " ":
            if 0 < i < n - 1 and text[i - 1].isdigit() and text[i + 1].isdigit() and c in ",，/":
                continue
            out.append((i, i + 1, c))
    if "code" in allowed and _STARTS_CODED.match(text):
        out += [(*m.span(), "code") for m in _CODE_SPACE.finditer(text) if free[m.start()] and "\n" not in m[0] and "\t" not in m[0] and not (m.start() and text[m.start() - 1] in allowed)]
    if " " in allowed:
        out += [(*m.span(), " ") for m in re.finditer(r"[ 　]+", text) if all(free[m.start() : m.end()]) and m.start() and m.end() < n and text[m.start() - 1] not in allowed and text[m.end()] not in allowed]
    return sorted(out)


def unquoted(value: str, quoting: bool = True) -> str:
    """A value without white space around it and, if quotes protect, without those that enclose it."""
    v = value.strip(_TRIM)
    if quoting and len(v) > 1 and v[0] in QUOTES and v[-1] == QUOTES[v[0]]:
        q, inner = v[-1], v[1:-1]
        if v[0] == q:
            if inner.replace(q * 2, "").count(q) == 0:
                return inner.replace(q * 2, q).strip(_TRIM)
        else:
            depth = 1
            for c in inner:
                depth += (c == v[0]) - (c == q)
                if depth == 0:
                    return v
            return inner.strip(_TRIM)
    return v


def parses(text: str, kind: str) -> list[tuple[list[str], int, int, int]]:
    """Values, separations, kinds of marks and bare marks of a string in each of its dialects, the whole first."""
    quoted = _marks(text, kind)
    plain = _marks(text, kind, False) if any(q in text for q in QUOTES) else quoted
    # quotes that hold no mark change nothing; those that do count as bare marks where they are no quotes
    stray = 0 if plain == quoted else sum(c in QUOTES or c in QUOTES.values() for c in text)
    first: list[tuple[list[str], int, int, int]] = []
    out: list[tuple[list[str], int, int, int]] = []
    for quoting, marks in ((True, quoted), (False, plain)) if stray else ((True, quoted),):
        kinds = sorted({c for _, _, c in marks}, key=MARKS[kind].index)
        for d in (set(x) for n in range(len(kinds) + 1) for x in combinations(kinds, n)):
            at, values, cuts = 0, [], 0
            for a, b, c in marks:
                if c in d:
                    values.append(text[at:a])
                    at = b
                    cuts += 1
            values.append(text[at:])
            clean = [v for v in (unquoted(x, quoting) for x in values) if v]
            (out if quoting else first).append((clean, cuts, len(d), len(marks) - cuts + (0 if quoting else stray)))
    # the whole is the first, the fullest parse with quotes the last
    return [out[0], *first, *(out[1:] or out[: len(first)])]


def _symbol(value: Column) -> Column:
    """What a value is counted as: itself without its item code, or its shape if it has four figures or more."""
    v = F.regexp_replace(value, rf"^\s*{ITEM_CODE}\s*", "")
    v = F.when(v == "", value).otherwise(v)
    return F.when(F.regexp_count(v, F.lit("[0-9]")) >= 4, F.regexp_replace(v, "[0-9]", "9")).otherwise(v)


def _pattern(kind: str) -> str:
    plain = "".join(re.escape(m) for m in MARKS[kind] if m not in ("code", " "))
    return "[" + plain + "]" + (r"|\s[0-9]{1,3}" if "code" in MARKS[kind] else "") + (r"|[^\s]\s+[^\s]+\s+[^\s]" if " " in MARKS[kind] else "")


def split_values(fields: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """record_id, field, pos and value of all values of the fields in which at least one string holds two or more.

    fields: record_id, field and items, an array of strings; kinds: the kind of marks of each field.
    """
    kind_of = F.element_at(F.create_map(*(F.lit(x) for kv in kinds.items() for x in kv)), F.col("field"))
    marked = F.lit(False)
    for kind in set(kinds.values()):
        marked = marked | ((kind_of == kind) & F.col("item").rlike(_pattern(kind)))
    items = fields.select("record_id", "field", F.posexplode("items").alias("n", "item")).where("item is not null")
    # distinct strings with the number of their places; the marked ones are few and go on to the parser
    strings = items.groupBy("field", "item").agg(F.count(F.lit(1)).alias("times"))
    some = F.lit(False)
    for kind in set(kinds.values()):
        some = some | ((kind_of == kind) & F.exists("items", lambda x: x.rlike(_pattern(kind))))
    chosen = fields.where(some)
    places = chosen.select("record_id", "field", F.posexplode("items").alias("n", "item")).where("item is not null")
    texts = strings.where(marked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("field", "item", "times", "dialect", "values", "bits")}
            for f, s, t in zip(batch.column("field").to_pylist(), batch.column("item").to_pylist(), batch.column("times").to_pylist()):
                for n, (values, cuts, used, bare) in enumerate(parses(s, kinds[f])):
                    for k, v in zip(out, (f, s, t, n, values, SEPARATION * cuts + KIND * used + BARE[kinds[f]] * bare)):
                        out[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out["field"], pa.string()), pa.array(out["item"], pa.string()), pa.array(out["times"], pa.int64()), pa.array(out["dialect"], pa.int32()), pa.array(out["values"], pa.list_(pa.string())), pa.array(out["bits"], pa.float64())], names=list(out))

    schema = T.StructType([T.StructField("field", T.StringType()), T.StructField("item", T.StringType()), T.StructField("times", T.LongType()), T.StructField("dialect", T.IntegerType()), T.StructField("values", T.ArrayType(T.StringType())), T.StructField("bits", T.DoubleType())])
    parsed = texts.mapInArrow(run, schema)
    # counts: unmarked strings, the marked ones as wholes, and the values of their fullest parses
    ends = parsed.groupBy("field", "item").agg(F.max("times").alias("times"), F.max_by("values", "dialect").alias("fullest"), F.min_by("values", "dialect").alias("whole"))
    whole = F.when(F.size("fullest") > 1, F.concat("whole", "fullest")).otherwise(F.col("whole"))
    seen = strings.where(~marked).select("field", F.trim("item").alias("value"), "times").union(ends.select("field", F.explode(whole).alias("value"), "times"))
    counts = seen.groupBy("field", _symbol(F.col("value")).alias("symbol")).agg(F.sum("times").alias("c"))
    totals = counts.groupBy("field").agg(F.sum("c").alias("total"))
    pieces = parsed.select("field", "item", "dialect", "bits", "times", F.size("values").alias("k"), F.explode_outer("values").alias("value")).withColumn("symbol", _symbol(F.col("value")))
    spelled = F.lit(SPELLED) + F.lit(CHARACTER) * F.length("value")
    shaped = F.col("symbol") != F.regexp_replace("value", rf"^\s*{ITEM_CODE}\s*", "")
    # a string is no evidence for its own values: its places don't count for its parts, nor its first place for the whole
    own = F.when(F.col("k") == 1, 1).otherwise(F.col("times") * F.when(shaped, F.col("k")).otherwise(1))
    coded = F.log2(F.col("total") / F.greatest(F.col("c") - own, F.lit(1))) + F.when(shaped, FIGURE * F.regexp_count("value", F.lit("[0-9]"))).otherwise(0.0)
    length = F.when(F.col("value").isNull(), 0.0).when(F.col("c") > own, F.least(coded, spelled)).otherwise(spelled)
    costs = pieces.join(counts, ["field", "symbol"], "left").join(F.broadcast(totals), "field").groupBy("field", "item", "dialect").agg((F.sum(length) + F.first("bits")).alias("cost"))
    best = costs.groupBy("field", "item").agg(F.min(F.struct("cost", "dialect")).alias("b")).select("field", "item", F.col("b.dialect").alias("dialect"))
    chosen_parse = parsed.join(best, ["field", "item", "dialect"], "left_semi").select("field", "item", "values")
    with_values = places.join(chosen_parse, ["field", "item"], "left")
    alone = F.filter(F.array(plain_value(F.col("item"))), lambda x: x != "")
    whole_fields = with_values.select("record_id", "field", "n", F.coalesce("values", alone).alias("values"))
    packed = whole_fields.groupBy("record_id", "field").agg(F.array_sort(F.collect_set(F.struct("n", "values"))).alias("x")).where(F.exists("x", lambda e: F.size(e["values"]) > 1))
    return packed.select("record_id", "field", F.posexplode(F.flatten("x.values")).alias("pos", "value")).select("record_id", "field", (F.col("pos") + 1).cast("bigint").alias("pos"), "value")


def plain_value(item: Column) -> Column:
    """As unquoted(), for a string without a separating mark."""
    v = F.regexp_replace(item, r"^[\s　 ]+|[\s　 ]+$", "")
    for a, b in QUOTES.items():
        v = F.regexp_replace(v, rf"^{a}([^{b}]*[^{b}\s])\s*{b}$", "$1")
    return v
