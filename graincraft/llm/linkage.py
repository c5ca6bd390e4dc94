"""Records of two tables that stand for the same category, matched without a common key, each match with a confidence.

Paths of either side are brought to plain levels (numbering, marks and case dropped, look-alikes folded). A row's path gives
domain, facet and tail; its domains and facets are the heads that the levels of records are joined to, as they are or one
slip apart. The other library's words are learned, not stated. A record's terms are in the rows' words: a term that its text lacks is
counted with each span of the text, and a span whose records have the term far more often than others becomes a wording of
it. Heads are learned from records whose tail, read with these wordings, is a row's: where a level and a head of that tail's
rows agree in all but one span, the span and what stands for it are counted, and a pair that comes again and again, and far
more often than any other reading of the span, becomes a wording too.

Candidates come from three passes over all records: the whole tail as any of its readings; a reading against each tail with
one character taken out, either way round; and sorted characters. The last two find every slip. Each pair of a record and a
category is compared on domain, facet, tail, terms and score, and the counts of the agreement patterns (a small table)
feed expectation-maximisation of the levels' probabilities among matches; those among all other pairs are taken from the
fields' frequencies, as nearly all pairs of the two tables are none. The posterior of the pair's pattern is its confidence,
and decides alone. A record is given the category of highest posterior, and of that category's rows the one
that shares most terms with it, then the one with the smallest row_id.

Defined results: records and rows without a path, or with nothing but a domain, match nothing; null terms and scores are
levels of agreement of their own; a record at most one row; ties go to the smallest row_id.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.packed import parses
from ..sources.tables import materialise
from . import lookalikes

# What may stand behind the name of a domain and of a class.
DOMAIN_ENDS = ("资源", "类数据", "resources", "data")
CLASS_ENDS = ("类", "class")

#: A pair is a match from this posterior on.
THRESHOLD = 0.5
ROUNDS = 30
#: Probability that a match differs in domain or facet: a category differs if a level means something else, so only by misreading.
MISREAD = 0.001
#: A head needs so many categories; a wording so large a share of its span's texts, and so many times one more than the next best reading has.
LEAST_CATEGORIES, LEAST_SHARE, AHEAD = 2, 0.05, 2
#: A span stands for a term it lacks if so large a share of the records with the span have the term, and if so many by chance are less likely than one such pair among all that meet.
TOLD = 0.12
#: A wording of the other library is so much rarer among the rows' texts.
OWN = 0.25
#: Characters of a span that a wording may replace, with and without Han characters.
SPAN, LATIN_SPAN = 6, 12
#: A level with more places for rules than this is read with all of them at once.
PLACES = 10

_NUMBERS = re.compile(r"^[\s（(\[【]*\d{1,4}(?:\s*[.．、]\s*\d*)*\s*[)）\]】]?\s*[、.．:：]?\s*")
_MARKS = re.compile(r"[\W_]+")
_HAN = re.compile(r"[一-鿿]")
_LETTERS = re.compile(r"[^\W\d_一-鿿]{3}")
_IS_PLAIN = re.compile(r"[一-鿿a-z0-9]*")
_PACKED = re.compile(r"[>/→|｜；;\\]")
_ASIDE = re.compile(r"（[^）]*）$|\([^)]*\)$")


def plain(text: str) -> str:
    """A level without numbering, marks and case, look-alikes and accents folded."""
    if _IS_PLAIN.fullmatch(text):
        return text
    if (known := _plain.get(text)) is not None:
        return known
    t = unicodedata.normalize("NFKC", text)
    t = lookalikes._INVISIBLE.sub("", t)
    t = "".join(lookalikes.RADICALS.get(c, c) for c in t)
    words = []
    for run in re.split(r"([A-Za-zͰ-Ͽ]+|[Ѐ-ԯA-Za-z]+)", t):
        if run and all(c in lookalikes.TO_LATIN or c.isascii() for c in run) and run != "α":
            run = "".join(map(lookalikes.skeleton, run))
        words.append(run)
    t = "".join(words)
    t = lookalikes._KANA_RUN.sub(lambda m: "".join(lookalikes.KANA.get(c, c) for c in m[0]) if len(m[0]) == 1 else m[0], t)
    t = "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c)) if any(ord(c) < 0x250 and ord(c) > 0xBF for c in t) else t
    t = _MARKS.sub("", t).casefold().replace("α", "a")
    if len(_plain) > 50_000:
        _plain.clear()
    _plain[text] = t
    return t


_plain: dict[str, str] = {}


def _without(text: str, ends: tuple[str, ...]) -> str:
    for e in ends:
        if text.endswith(e) and len(text) > len(e):
            return text[: -len(e)]
    return text


def row_parts(path: list[str] | None) -> tuple[str, str, str] | None:
    """Domain, facet and tail of a row's path, or None."""
    levels: list[str] = []
    for s in path or []:
        if s is None:
            continue
        levels += parses(s, "path")[-1][0] if _PACKED.search(s) else [s]
    clean = [plain(_ASIDE.sub("", x) if x[-1:] in (")", "）") else x) for x in levels]
    clean = [x for x in clean if x]
    if len(clean) < 3:
        return None
    domain = _without(clean[0], DOMAIN_ENDS)
    facet = clean[1].removeprefix(domain)
    tail = "".join(_without(x, CLASS_ENDS) if i < len(clean) - 3 else x for i, x in enumerate(clean[2:]))
    return domain, facet, tail


def _slip(a: str, b: str) -> bool:
    """Whether a is b with two neighbours exchanged, or with one character lost or gained."""
    if a == b or abs(len(a) - len(b)) > 1:
        return a == b
    if len(a) == len(b):
        d = [i for i in range(len(a)) if a[i] != b[i]]
        return len(d) == 2 and d[1] == d[0] + 1 and a[d[0]] == b[d[1]] and a[d[1]] == b[d[0]]
    short, long = sorted((a, b), key=len)
    i = 0
    while i < len(short) and short[i] == long[i]:
        i += 1
    return short[i:] == long[i + 1 :]


def _rows(df: DataFrame) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("row_id", "domain", "facet", "tail")] + [T.StructField("examples", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[tuple, tuple | None] = {}
        for batch in batches:
            keep, parts = [], []
            for i, p in enumerate(batch.column("path_levels").to_pylist()):
                k = tuple(p or ())
                if k not in memo:
                    if len(memo) > 20_000:
                        memo.clear()
                    memo[k] = row_parts(p)
                if (x := memo[k]) is not None:
                    keep.append(i)
                    parts.append(x)
            at = pa.array(keep, pa.int32())
            cols = [pa.array([x[j] for x in parts], pa.string()) for j in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("row_id").take(at), *cols, batch.column("data_range_examples").take(at)], names=schema.names)

    return df.select("row_id", "path_levels", "data_range_examples").mapInArrow(run, schema)


def _slip_keys(tail: str, own: str, other: str) -> Column:
    """Keys that two tails one slip apart share: a tail as it is and the other with one character taken out, or the sorted characters.

    own and other name the sides, so that two tails that both lack a character don't meet.
    """
    t = F.col(tail)
    cut = F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.xxhash64(F.lit(other), F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t)))))
    return F.array_distinct(F.concat(F.array(F.xxhash64(F.lit(own), t), F.xxhash64(F.lit("s"), F.array_join(F.array_sort(F.split(t, "")), ""))), cut))


def _levels(df: DataFrame) -> DataFrame:
    """match_id, levels, terms, as they are and plain, and score of each record with a level."""
    schema = T.StructType([T.StructField("match_id", T.StringType()), T.StructField("levels", T.ArrayType(T.StringType())), T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("plain_terms", T.ArrayType(T.StringType())), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, levels = [], []
            for i, p in enumerate(batch.column("reference_path").to_pylist()):
                if x := [y for y in (plain(_NUMBERS.sub("", s)) for s in p or [] if s) if y]:
                    keep.append(i)
                    levels.append(x)
            at = pa.array(keep, pa.int32())
            terms = batch.column("shared_terms").take(at)
            plains = [[plain(x) for x in ts or [] if x] for ts in terms.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("match_id").take(at), pa.array(levels, pa.list_(pa.string())), terms, pa.array(plains, pa.list_(pa.string())), batch.column("score").take(at)], names=schema.names)

    return df.select("match_id", "reference_path", "shared_terms", "score").mapInArrow(run, schema)


class Rules:
    """Wordings of the other library and what stands for them here."""

    def __init__(self, pairs: dict[str, str]) -> None:
        self.pairs = pairs
        self.longest = max(map(len, pairs), default=0)
        self.firsts = {a[0] for a in pairs}

    def readings(self, s: str) -> list[str]:
        """The level as it is, and with every choice of its wordings replaced."""
        places = [(i, k) for i in range(len(s)) if s[i] in self.firsts for k in range(2, min(self.longest, len(s) - i) + 1) if s[i : i + k] in self.pairs]
        if not places:
            return [s]
        if len(places) > PLACES:
            return [s, self._all(s)]
        out = {s}
        chosen: list[tuple[tuple[int, int], ...]] = [()]
        for p in places:
            for c in list(chosen):
                if not c or c[-1][0] + c[-1][1] <= p[0]:
                    chosen.append((*c, p))
        for c in chosen:
            t, at = [], 0
            for i, k in c:
                t += [s[at:i], self.pairs[s[i : i + k]]]
                at = i + k
            out.add("".join([*t, s[at:]]))
        return sorted(out, key=lambda x: (x != s, x))

    def _all(self, s: str) -> str:
        out, i = [], 0
        while i < len(s):
            k = next((k for k in range(min(self.longest, len(s) - i), 0, -1) if s[i : i + k] in self.pairs), 0)
            out.append(self.pairs[s[i : i + k]] if k else s[i])
            i += k or 1
        return "".join(out)


def _read(strings: DataFrame, rules: Rules, ends: tuple[str, ...] = ()) -> DataFrame:
    """s and each reading of it, with and without the ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(s, r) for s in batch.column("s").to_pylist() for r in dict.fromkeys(z for x in rules.readings(s) for z in (x, _without(x, ends)))]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], names=["s", "reading"])

    return strings.select("s").mapInArrow(run, "s string, reading string")


def _swapped(a: str, b: str) -> Column:
    return (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, ""))) & (F.levenshtein(a, b, 2) == 2) & (F.length(a) == F.length(b))


def _slipped(a: str, b: str) -> Column:
    """Whether one text is the other with a character lost, gained, or exchanged with its neighbour."""
    return (F.abs(F.length(a) - F.length(b)) == 1) & (F.levenshtein(a, b, 1) == 1) | F.coalesce(_swapped(a, b), F.lit(False))


def _near(left: DataFrame, a: str, right: DataFrame, b: str) -> DataFrame:
    """The pairs of different texts that are one slip apart."""
    x = left.select(a).distinct().select(a, F.explode(_slip_keys(a, "record", "row")).alias("key"))
    y = right.select(b).distinct().select(b, F.explode(_slip_keys(b, "row", "record")).alias("key"))
    return x.join(y, "key").where(F.col(a) != F.col(b)).where(_slipped(a, b)).select(a, b).distinct()


def _heads(categories: DataFrame) -> DataFrame:
    """h, domain, facet (null for a domain alone) and n of the texts that name a domain, or a domain with a facet; of several meanings the commonest."""
    counts = categories.groupBy("domain", "facet").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_CATEGORIES)
    alone = counts.groupBy("domain").agg(F.sum("n").alias("n")).select(F.explode(F.array(F.col("domain"), *(F.concat("domain", F.lit(e)) for e in DOMAIN_ENDS))).alias("h"), "domain", F.lit(None).cast("string").alias("facet"), "n")
    both = counts.select(F.concat("domain", "facet").alias("h"), "domain", "facet", "n")
    return both.union(alone).groupBy("h").agg(F.max(F.struct("n", "domain", "facet")).alias("m")).select("h", "m.domain", "m.facet", "m.n")


def _resolved(wordings: DataFrame, heads: DataFrame, rules: Rules) -> DataFrame:
    """levels, r_domain, r_facet and r_tail of each wording, the levels that name heads joined to them as read, else one slip apart."""
    strings = wordings.select(F.explode("levels").alias("s")).distinct()
    read = materialise(_read(strings, rules, DOMAIN_ENDS), "p4levels")
    known = read.join(heads, F.col("reading") == F.col("h")).groupBy("s").agg(F.max(F.struct((F.col("reading") == F.col("s")).alias("same"), "n", "domain", "facet")).alias("m")).select("s", "m.domain", "m.facet")
    long = read.join(known, "s", "left_anti").where(F.length("reading") > 2)
    targets = heads.where(F.length("h") > 3)
    slips = long.join(_near(long, "reading", targets, "h"), "reading").join(heads, "h").groupBy("s").agg(F.max(F.struct("n", "domain", "facet")).alias("m")).select("s", "m.domain", "m.facet")
    found = known.union(slips)
    at = wordings.select("levels", F.posexplode("levels").alias("i", "s")).join(found, "s", "left")
    order = F.array_sort(F.collect_list(F.struct("i", "s", F.coalesce("domain", F.lit("")).alias("d"), F.col("facet").alias("f"))))
    t = at.groupBy("levels").agg(order.alias("x"))
    # two levels at most name heads, the first two
    index = F.transform(F.slice(F.filter("x", lambda e: e["d"] != ""), 1, 2), lambda e: e["i"])
    t = t.withColumn("heads", index)
    chosen = F.filter("x", lambda e: F.array_contains("heads", e["i"]))
    tail = F.transform(F.filter("x", lambda e: ~F.array_contains("heads", e["i"])), lambda e: e["s"])
    facets = F.filter(F.transform(chosen, lambda e: e["f"]), lambda f: f.isNotNull())
    t = t.select("levels", F.get(F.transform(chosen, lambda e: e["d"]), F.lit(0)).alias("r_domain"), F.get(facets, F.lit(0)).alias("r_facet"), tail.alias("tail"), ((F.size("heads") > 0) & (F.array_max("heads") == F.size("x") - 1) & (F.size("x") > 1)).alias("turned"))
    t = t.where("size(tail) > 0").withColumn("tail", F.when(F.col("turned"), F.reverse("tail")).otherwise(F.col("tail")))
    first = F.when(F.size("tail") > 2, _bare(F.get("tail", F.lit(0)), CLASS_ENDS)).otherwise(F.get("tail", F.lit(0)))
    return t.select("levels", "r_domain", "r_facet", F.concat(first, F.array_join(F.slice("tail", F.lit(2), F.size("tail")), "")).alias("r_tail"))


def _spans(pairs: DataFrame) -> DataFrame:
    """a, b and n: the spans in which the texts s and t of the pairs differ, as they are and with a character more on either side, and the number of different ids. pairs: id, s, t."""

    def one(s: str, t: str) -> Iterator[tuple[str, str]]:
        i = 0
        while i < min(len(s), len(t)) and s[i] == t[i]:
            i += 1
        j = 0
        while j < min(len(s), len(t)) - i and s[-1 - j] == t[-1 - j]:
            j += 1
        if i + j == 0 or s == t or _slip(s, t):
            return
        for x in (0, 1):
            for y in (0, 1):
                if x <= i and y <= j:
                    a, b = s[i - x : len(s) - j + y], t[i - x : len(t) - j + y]
                    if 2 <= len(a) <= (most := SPAN if _HAN.search(a + b) else LATIN_SPAN) and len(b) <= most:
                        yield a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, a, b) for i, s, t in zip(*(batch.column(c).to_pylist() for c in ("id", "s", "t"))) for a, b in one(s, t)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), *(pa.array([x[k] for x in out], pa.string()) for k in (1, 2))], names=["id", "a", "b"])

    return pairs.select("id", "s", "t").mapInArrow(run, "id bigint, a string, b string").distinct().groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def _learned(pairs: DataFrame, unread: DataFrame, own: DataFrame) -> dict[str, str]:
    """Wordings that are read one way far more often than any other. pairs: id, s, t; unread: id and s of all texts that the rules don't cover yet; own: s of the rows' texts."""
    spans = _spans(pairs).where(F.col("b") != "")
    best = spans.groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "b")), False), 1, 2).alias("x"))
    ahead = best.where(F.col("x")[0]["n"] >= AHEAD * (1 + F.coalesce(F.get("x", F.lit(1))["n"], F.lit(0)))).select("a", F.col("x")[0]["b"].alias("b"), F.col("x")[0]["n"].alias("n"))
    found = {r["a"]: (r["b"], r["n"]) for r in ahead.collect()}
    good = _foreign({a: b for a, (b, _) in found.items()}, unread.select("s"), own)
    if not good:
        return {}
    seen = {r["a"]: r["n"] for r in _holding(unread, sorted(good)).collect()}
    return {a: b for a, b in good.items() if found[a][1] >= LEAST_SHARE * seen.get(a, 0)}


def _automaton(words: list[str]):
    import ahocorasick

    out = ahocorasick.Automaton()
    for a in words:
        out.add_word(a, a)
    out.make_automaton()
    return out


def _holding(texts: DataFrame, words: list[str]) -> DataFrame:
    """a and n: each word that stands in a text s, and in how many. The words go to the workers and are no part of the plan, which they would fill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(words)
        for batch in batches:
            n: Counter[str] = Counter()
            for s in batch.column("s").to_pylist():
                n.update({a for _, a in automaton.iter(s)})
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["a", "n"])

    return texts.select("s").mapInArrow(run, "a string, n bigint").groupBy("a").agg(F.sum("n").alias("n"))


def _bare(c: Column, ends: tuple[str, ...]) -> Column:
    out = c
    for e in ends:
        out = F.when(c.endswith(e) & (F.length(c) > len(e)), F.left(c, F.length(c) - len(e))).otherwise(out)
    return out


def _splits() -> Column:
    """The ways to take one or two levels from either end as heads: t, the rest as one text in the order of a row, and h."""
    n = F.size("levels")
    ways = []
    for k in (1, 2):
        ways.append(F.struct(F.array_join(F.slice("levels", F.lit(k + 1), F.greatest(n - k, F.lit(0))), "").alias("t"), F.slice("levels", 1, k).alias("h")))
        ways.append(F.struct(F.array_join(F.reverse(F.slice("levels", F.lit(1), F.greatest(n - k, F.lit(0)))), "").alias("t"), F.slice("levels", F.greatest(n - k + 1, F.lit(1)), F.lit(k)).alias("h")))
    return F.array(*ways)


def _plain_term(x: Column) -> Column:
    return F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]+", "")


def _reduced(a: str, b: str) -> set[tuple[str, str]]:
    """Two wordings without what they share at their ends; where that leaves one character, with its neighbour on either side."""
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    need = max(0, 2 - (len(a) - i - j))
    cuts = [(i - x, j - (need - x)) for x in range(need + 1)]
    return {(a[x : len(a) - y], b[x : len(b) - y]) for x, y in cuts if x >= 0 and y >= 0}


def _taught(records: DataFrame, parsed: DataFrame, tails: DataFrame) -> dict[str, str]:
    """Wordings of the terms that the records' texts lack. Terms that are examples of rows say nothing on a path."""
    examples = parsed.select(F.explode("examples").alias("x")).select(_plain_term(F.col("x")).alias("w")).distinct()
    told = records.where("size(terms) > 0").withColumn("text", F.array_join("levels", "\x1f"))
    lacking = told.select("match_id", "text", F.explode(F.array_distinct("plain_terms")).alias("w")).where((F.length("w") > 1) & ~F.col("text").contains(F.col("w")))
    lacking = lacking.join(examples, "w", "left_anti").groupBy("match_id").agg(F.collect_set("w").alias("ws"))
    texts = told.select("match_id", "text").join(lacking, "match_id", "left").select("text", F.coalesce("ws", F.array().cast("array<string>")).alias("ws"))

    def spans(text: str) -> set[str]:
        out = {x[i : i + k] for x in text.split("\x1f") for k in range(2, SPAN + 1) for i in range(len(x) - k + 1)}
        if _HAN.search(text):  # words of letters amid Han characters are longer
            out |= {a for x in text.split("\x1f") for k in range(SPAN + 1, LATIN_SPAN + 1) for i in range(len(x) - k + 1) if _LETTERS.search(a := x[i : i + k])}
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans_n: Counter[str] = Counter()
            words_n: Counter[str] = Counter()
            pairs_n: Counter[tuple[str, str]] = Counter()
            for text, ws in zip(batch.column("text").to_pylist(), batch.column("ws").to_pylist()):
                found = spans(text)
                spans_n.update(found)
                words_n.update(ws)
                for w in ws:
                    pairs_n.update(zip(found, repeat(w)))
            a = [*spans_n, *repeat("", len(words_n) + 1), *(k[0] for k in pairs_n)]
            w = [*repeat("", len(spans_n)), *words_n, "", *(k[1] for k in pairs_n)]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(w, pa.string()), pa.array([*spans_n.values(), *words_n.values(), batch.num_rows, *pairs_n.values()], pa.int64())], names=["a", "w", "n"])

    counts = materialise(texts.mapInArrow(run, "a string, w string, n bigint").groupBy("a", "w").agg(F.sum("n").alias("n")).where("n > 1 or a = ''"), "p4spans")
    total, met = counts.agg(F.sum(F.when((F.col("a") == "") & (F.col("w") == ""), F.col("n"))), F.count_if((F.col("a") != "") & (F.col("w") != ""))).first()
    if not met:
        return {}
    pairs = counts.where("a <> '' and w <> ''").join(counts.where("w = '' and a <> ''").select("a", F.col("n").alias("na")), "a").join(counts.where("a = '' and w <> ''").select("w", F.col("n").alias("nw")), "w")
    chance = F.col("na") * F.col("nw") / F.lit(total)
    # the likelihood ratio of the count against chance has to beat the number of pairs there are
    surprise = F.col("n") * F.log(F.col("n") / chance) - (F.col("n") - chance)
    good = pairs.where((F.col("n") >= TOLD * F.col("na")) & (F.col("n") > chance) & (surprise >= math.log(max(2, met))))
    return _foreign(_voted(good.select("a", "w", "n", "na")), texts.select(F.explode(F.split("text", "\x1f")).alias("s")), tails.select(F.col("tail").alias("s")))


def _voted(pairs: DataFrame) -> dict[str, str]:
    """What stands for each span by half of its votes or more. pairs: a, w, n, na. Each term votes with its best spans of those that hold no other of them; only what is chosen goes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes: Counter[tuple[str, str]] = Counter()
            for w, spans in zip(batch.column("w").to_pylist(), batch.column("spans").to_pylist()):
                found = [(x["n"] * (x["n"] / x["na"]) ** 2 * (1.5 if x["a"][0] == w[0] else 1) * (1.5 if x["a"][-1] == w[-1] else 1), x["a"], x["n"]) for x in spans]
                kept: list[str] = []
                for _, a, n in sorted(found, key=lambda x: (-x[0], -len(x[1]), x[1])):
                    if not any(a in k or k in a for k in kept):
                        kept.append(a)
                        for x in _reduced(a, w):
                            votes[x] += n
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in votes], pa.string()), pa.array([x[1] for x in votes], pa.string()), pa.array(list(votes.values()), pa.int64())], names=["x", "y", "n"])

    spans = pairs.groupBy("w").agg(F.collect_list(F.struct("a", "n", "na")).alias("spans"))
    votes = spans.mapInArrow(run, "x string, y string, n bigint").groupBy("x", "y").agg(F.sum("n").alias("n"))
    chosen = votes.groupBy("x").agg(F.min(F.struct((-F.col("n")).alias("n"), "y")).alias("b"), F.sum("n").alias("all"))
    return {r["x"]: r["y"] for r in chosen.where((-F.col("b.n") >= 0.5 * F.col("all")) & (F.col("b.y") != "")).select("x", "b.y").collect()}


def _foreign(rules: dict[str, str], texts: DataFrame, own: DataFrame) -> dict[str, str]:
    """The rules whose wording is far rarer among the rows' texts than among the records'. Texts without Han characters are no evidence on a wording that stands for Han characters."""
    if not rules:
        return {}
    han = {a: bool(_HAN.search(b)) for a, b in rules.items()}
    words = sorted(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(words)
        for batch in batches:
            n: Counter[tuple[str, bool, str]] = Counter()
            for w, s in zip(batch.column("w").to_pylist(), batch.column("s").to_pylist()):
                h = bool(_HAN.search(s))
                n[(w, h, "")] += 1
                n.update((w, h, a) for a in {a for _, a in automaton.iter(s)} if han[a] == h)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in n], t) for k, t in enumerate((pa.string(), pa.bool_(), pa.string()))] + [pa.array(list(n.values()), pa.int64())], names=["w", "h", "a", "n"])

    both = texts.select(F.lit("record").alias("w"), "s").union(own.select(F.lit("row").alias("w"), "s"))
    seen = {(r["w"], r["h"], r["a"]): r["n"] for r in both.mapInArrow(run, "w string, h boolean, a string, n bigint").groupBy("w", "h", "a").agg(F.sum("n").alias("n")).collect()}
    rate = lambda w, a: seen.get((w, han[a], a), 0) / max(1, seen.get((w, han[a], ""), 0))
    good = {a: b for a, b in rules.items() if rate("row", a) <= OWN * rate("record", a)}
    # a longer span that a shorter rule reads the same way says nothing new
    return {a: b for a, b in good.items() if not any(a[i:j] in good and a[:i] + good[a[i:j]] + a[j:] == b for i in range(len(a)) for j in range(i + 2, len(a) + 1) if j - i < len(a))}


def _wordings(records: DataFrame, parsed: DataFrame, categories: DataFrame, tails: DataFrame) -> tuple[DataFrame, Rules]:
    """The wordings of the records, read with the rules learned from them."""
    heads = materialise(_heads(categories), "p4heads")
    known = _taught(records, parsed, tails)
    rules = Rules(known)
    # the levels beside a tail that is a row's, against the heads of that tail's rows; a record and a row only teach if they share a term
    beside = records.where("size(levels) > 1 and size(terms) > 0").select("terms", F.xxhash64("match_id").alias("id"), F.explode(_splits()).alias("x")).where("x.t <> ''").select("id", "terms", "x.t", F.explode("x.h").alias("h_"))
    strange = beside.join(heads, F.col("h_") == F.col("h"), "left_anti").withColumn("s", _bare(F.col("h_"), DOMAIN_ENDS)).select("id", "terms", "t", "s").distinct()
    anchored = _read(strange.select(F.col("t").alias("s")).distinct(), rules).join(tails, F.col("reading") == F.col("tail"), "left_semi").withColumnRenamed("s", "t")
    met = materialise(strange.join(anchored, "t").join(categories, F.col("reading") == F.col("tail")).select("id", "s", "domain", "facet", F.arrays_overlap("terms", "examples").alias("shared")), "p4beside")
    pairs = met.where("shared").select("id", "s", F.explode(F.array(F.when(F.length("s") <= F.length("domain") + 2, F.col("domain")), F.concat("domain", "facet"))).alias("t")).where("t is not null").distinct()
    more = _learned(pairs, met.select("id", "s").distinct(), heads.select(F.col("h").alias("s")))
    rules = Rules(more | known)
    return materialise(_resolved(records.select("levels").distinct(), heads, rules), "p4read"), rules


def _agreement(a: str, b: str) -> Column:
    return F.when(F.col(b).isNull(), 1).when(F.col(a) == F.col(b), 0).otherwise(2)


FIELDS = ["c_domain", "c_facet", "c_tail", "c_terms", "c_score"]


def _chances(records: DataFrame, categories: DataFrame) -> tuple[float, list[dict[int, float]], dict[int, float]]:
    """How many pairs there are, the probabilities that domain and facet of a random pair agree, are missing or differ, and those of the levels of the score."""

    def valued(df: DataFrame, side: int, **fields: Column) -> DataFrame:
        return df.select(F.explode(F.array(*(F.struct(F.lit(k).alias("field"), v.cast("string").alias("v")) for k, v in fields.items()))).alias("x")).select("x.field", "x.v", F.lit(side).alias("side"))

    both = valued(records, 0, domain=F.col("r_domain"), facet=F.col("r_facet"), score=F.col("c_score")).union(valued(categories, 1, domain=F.col("domain"), facet=F.col("facet")))
    counts = both.groupBy("field", "v").agg(F.count_if(F.col("side") == 0).alias("x"), F.count_if(F.col("side") == 1).alias("y"))
    sums = {r["field"]: r for r in counts.groupBy("field").agg(F.sum("x").alias("x"), F.sum("y").alias("y"), F.sum(F.when(F.col("v").isNotNull(), F.col("x").cast("double") * F.col("y"))).alias("same"), F.sum(F.when(F.col("v").isNull(), F.col("x"))).alias("none"), F.map_from_entries(F.collect_list(F.when(F.col("field") == "score", F.struct("v", "x")))).alias("levels")).collect()}
    out = []
    for f in ("domain", "facet"):
        same, none = (sums[f]["same"] or 0.0) / max(1.0, sums[f]["x"] * float(sums[f]["y"])), (sums[f]["none"] or 0) / max(1, sums[f]["x"])
        out.append({0: max(same, 1e-9), 1: max(none, 1e-9), 2: max(1 - same - none, 1e-9)})
    n = sums["score"]["x"]
    return float(n) * sums["domain"]["y"], out, {v: (sums["score"]["levels"].get(str(v), 0) + 0.5) / (n + 2) for v in (0, 1, 2, 3)}


def _fitted(patterns: list[tuple[tuple[int, ...], int]], chance: list[dict[int, float]], pairs: float) -> dict[tuple[int, ...], float]:
    """The posterior of a match for each agreement pattern, by expectation-maximisation of the levels among matches.

    chance: the probability of each level among pairs that are no match; pairs: how many pairs the two tables have. Level 1
    of a field that has a level 2 is a missing value, which says nothing: it is as likely among matches as among others.
    Two paths that agree in every level are of one category, so among other pairs that too takes a misreading.
    """
    fields = range(len(chance))

    def held(m: list[dict[int, float]]) -> list[dict[int, float]]:
        for f in fields:
            fixed = {1: chance[f][1]} if 2 in chance[f] else {}
            if f < 2:
                fixed[2] = MISREAD
            free = sum(v for k, v in m[f].items() if k not in fixed)
            m[f] = {k: fixed[k] if k in fixed else v / free * (1 - sum(fixed.values())) for k, v in m[f].items()}
        return m

    m = held([{v: (0.9 if v == 0 else 0.1 / max(1, len(c) - 1)) for v in c} for c in chance])
    prior = 1 / math.sqrt(max(4.0, pairs)) / 10
    post: dict[tuple[int, ...], float] = {}
    for _ in range(ROUNDS):
        for p, _n in patterns:
            a = math.log(prior) + sum(math.log(m[f][p[f]]) for f in fields)
            b = math.log(1 - prior) + sum(math.log(chance[f][p[f]]) for f in fields) + (math.log(MISREAD) if p[:3] == (0, 0, 0) else 0)
            post[p] = 1 / (1 + math.exp(max(-700, min(700, b - a))))
        w = sum(post[p] * n for p, n in patterns)
        prior = min(0.5, max(1e-12, w / pairs))
        m = held([{v: (sum(post[p] * n for p, n in patterns if p[f] == v) + 0.1) / (w + 0.1 * len(chance[f])) for v in chance[f]} for f in fields])
    return post


def links(rows: DataFrame, records: DataFrame) -> DataFrame:
    """row_id, match_id and confidence of each record that stands for a row's category."""
    parsed = materialise(_rows(rows), "p4rows")
    none = F.array().cast("array<string>")
    # one line for each category; copies of a category add nothing to the comparison
    categories = materialise(parsed.groupBy("domain", "facet", "tail").agg(F.array_distinct(F.flatten(F.collect_set(F.coalesce("examples", none)))).alias("examples")), "p4categories")
    known = materialise(_levels(records).dropDuplicates(["match_id"]), "p4records")
    tails = materialise(categories.select("tail").distinct(), "p4tails")
    read, rules = _wordings(known, parsed, categories, tails)
    signatures = read.select("r_tail").distinct()
    readings = materialise(_read(signatures.select(F.col("r_tail").alias("s")), rules), "p4readings")
    whole = readings.join(tails, F.col("reading") == F.col("tail")).select(F.col("s").alias("r_tail"), "tail", F.lit(0).alias("c_tail"))
    slips = readings.join(_near(readings, "reading", tails, "tail"), "reading").select(F.col("s").alias("r_tail"), "tail", F.lit(1).alias("c_tail"))
    near = materialise(whole.union(slips).groupBy("r_tail", "tail").agg(F.min("c_tail").alias("c_tail")), "p4near")
    c_score = F.when(F.col("score").isNull(), 1).when(F.col("score") >= 0.6, 0).when(F.col("score") >= 0.3, 2).otherwise(3)
    wanted = known.join(read, "levels").select("match_id", "terms", "plain_terms", c_score.alias("c_score"), "r_domain", "r_facet", "r_tail")
    met = wanted.join(near, "r_tail").join(categories, "tail")
    # terms that the tail holds agree because the tail does; the others are held against the examples
    others = F.filter(F.coalesce("terms", none), lambda x: ~F.col("tail").contains(_plain_term(x)))
    shared = F.size(F.array_intersect(others, "examples"))
    c_terms = F.when(F.size(others) == 0, 1).when(shared == F.size(F.array_distinct(others)), 0).when(shared > 0, 2).otherwise(3)
    compared = met.select("match_id", "domain", "facet", "tail", _agreement("domain", "r_domain").alias("c_domain"), _agreement("facet", "r_facet").alias("c_facet"), "c_tail", c_terms.alias("c_terms"), "c_score", "plain_terms", "terms")
    compared = materialise(compared, "p4pairs")
    patterns = [(tuple(r[c] for c in FIELDS), r["count"]) for r in compared.groupBy(*FIELDS).count().collect()]
    if not patterns:
        return rows.sparkSession.createDataFrame([], "row_id string, match_id string, confidence double")
    pairs, heads_chance, score_chance = _chances(wanted, categories)
    tail_chance = {k: max(1e-12, sum(n for p, n in patterns if p[2] == k) / pairs) for k in (0, 1)}
    # of terms, pairs that differ in the domain tell what chance does
    strangers = [(p, n) for p, n in patterns if p[0] == 2] or patterns
    total = sum(n for _, n in strangers)
    terms_chance = {v: (sum(n for p, n in strangers if p[3] == v) + 0.5) / (total + 2) for v in (0, 1, 2, 3)}
    chance = [*heads_chance, tail_chance, terms_chance, score_chance]
    post = _fitted(patterns, chance, pairs)
    code = sum((F.col(c) * 4**i for i, c in enumerate(FIELDS)), F.lit(0))
    posterior = F.element_at(F.create_map(*(F.lit(x) for p, v in post.items() for x in (sum(k * 4**i for i, k in enumerate(p)), v))), code)
    sure = compared.withColumn("confidence", posterior).where(F.col("confidence") >= THRESHOLD)
    # the records' terms choose among the rows of the categories that remain
    wanted_rows = parsed.join(sure.select("domain", "facet", "tail").distinct(), ["domain", "facet", "tail"], "left_semi")
    sets = wanted_rows.withColumn("examples", F.array_sort(F.array_distinct(F.coalesce("examples", none)))).groupBy("domain", "facet", "tail", "examples").agg(F.min("row_id").alias("row_id"))
    hits = F.when(F.col("terms").isNull(), 0).otherwise(F.size(F.array_intersect("terms", "examples")) + F.size(F.filter("plain_terms", lambda x: F.col("tail").contains(x))))
    chosen = sure.join(sets, ["domain", "facet", "tail"]).withColumn("hits", hits)
    best = chosen.groupBy("match_id").agg(F.min(F.struct((-F.col("confidence")).alias("doubt"), (-F.col("hits")).alias("misses"), "row_id")).alias("b"))
    return best.select(F.col("b.row_id").alias("row_id"), "match_id", (-F.col("b.doubt")).alias("confidence"))
