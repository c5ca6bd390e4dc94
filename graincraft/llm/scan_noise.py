"""Pages recovered from images, brought back to continuous paragraphs, and the defects found on the way.

Furniture is told by its place: the outermost lines of a page are compared with those of the document's other pages
(titles that recur, numbers that count up with the pages), and with the next page's first line, as a table's total may be
cut by the page end. What remains is body. Lines that end within a word are joined, or not, by an averaged perceptron on what the
corpus knows of the two halves, trained on words cut at random and compounds cut at their hyphen. The characters are read by another: at each place where a look-alike could have been misread it decides between keeping, replacing (or replacing
and deleting, where two characters were read for one) from the characters around, the counts of their triples and the
words they make. It is trained on clean pages into which misreadings are put at random, so it needs no labels.

Defined results: null and blank texts have no defect and stay; pages of no page number (documents without pages) have no
furniture and are not read for misread characters; a line has each kind of defect once at most. A page delivered twice is one page.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import materialise

# What is read, and what may stand on the page.
MISREAD_HAN = {"甩": "用", "珍": "诊", "埋": "理", "荐": "存", "入": "人", "阮": "院", "贵": "责", "母": "每", "纺": "统", "吏": "更", "糸": "系", "各": "务", "凳": "登", "邵": "部", "坪": "评", "娄": "类", "菅": "管", "讵": "记", "敷": "数", "掘": "据", "恨": "限", "寀": "案", "科": "料", "便": "使", "末": "未", "恩": "息", "己": "已", "曰": "日", "干": "于", "千": "干", "士": "土", "夭": "天", "侍": "待", "徽": "微", "析": "折", "侯": "候", "拔": "拨", "祥": "详", "复": "夏", "帐": "账", "竟": "竞", "崇": "祟", "薄": "簿", "晴": "睛", "治": "冶", "冼": "洗", "杳": "查", "汆": "余", "迸": "进", "间": "问", "闭": "闲", "沽": "估", "哀": "衰", "栗": "粟", "免": "兔", "师": "帅"}
MISREAD_LATIN = {"c": "e", "0": "o", "1": "l i", "9": "g", "b": "h", "vv": "w", "rn": "m", "cl": "d", "d": "cl", "m": "rn", "6": "b", "5": "s", "8": "B", "e": "c", "h": "b"}
UNREADABLE = "□�■▯"
LETTERS_FOR_FIGURES = "lIOo"
TOTALS = ("合计", "小计", "总计", "subtotal", "total")

#: Clean pages the editor is trained on, those of least hash; their text goes through the driver, some 1.5 MB.
TRAINING_PAGES = 1500
ROUNDS = 3
#: Surroundings whose reading a worker keeps; the store is emptied when full.
MEMO = 200_000
#: Share of the places where a misreading is possible that get one in training.
NOISE = 0.06

PAIRS: dict[str, list[str]] = {k: v.split() for k, v in {**MISREAD_HAN, **MISREAD_LATIN}.items()}
_HAN_CANDIDATE = re.compile("[" + "".join(MISREAD_HAN) + "]")
_LATIN_CANDIDATE = re.compile("|".join(map(re.escape, sorted(MISREAD_LATIN, key=len, reverse=True))))
_ASCII_TOKEN = re.compile(r"[A-Za-z0-9]+")
_LATIN = re.compile(r"[A-Za-z]")
_HYPHEN = re.compile(r"([^\W\d_]+)\s*([-¬­‐])\s*\Z")
#: What a line ends with if it ends within a word, and nothing.
_LINE_ENDS = ("-", "¬", "\u00ad", "‐")
_BROKEN_LINE = re.compile(r"[-¬\u00ad]\s*\n")
_FIRST_WORD = re.compile(r"\s*([^\W\d_]+)")
_FIGURES = r"[\dlIOo□�]"
_NUMBER = re.compile(rf"\s*(?:(?P<page>第\s*(?P<a>{_FIGURES}+)\s*页(?:\s*[/，,共]+\s*{_FIGURES}+\s*页?)?)|(?P<of>Page\s+(?P<b>{_FIGURES}+)(?:\s+of\s+{_FIGURES}+)?)|(?P<dash>[—–\-]+\s*(?P<c>{_FIGURES}+|[ivxl]+)\s*[—–\-]+)|(?P<dot>[·•.]\s*(?P<d>{_FIGURES}+|[ivxl]+)\s*[·•.])|(?P<bare>\d*{_FIGURES}\d*)|(?P<roman>[ivxl]+))\s*", re.I)
_WITH_NUMBER = re.compile(rf"^\s*{_FIGURES}+\s*[|｜]\s*(?=\S)|\s{{3,}}{_FIGURES}+\s*$")
_STANDARD = re.compile(r"^[A-Z.□�]{1,4}\s*[/.□�]\s*[A-Z.□�]\s*[\dlO□�.]{2,6}\s*[-—.□�]\s*[\dlO□�.]{2,5}\s+\S")
_CATALOGUE = re.compile(r"(?:目录|catalogue)$", re.I)
_SENTENCE_MARK = re.compile(r"[。；！？，：“”;!?]|[.,]\s|[.,]$|的值域")
#: What a running title of a standard never holds; a stop or comma may be a misread letter of it.
_BODY_MARK = re.compile(r"[。；！？：“”;!?]|的值域|第[\d.]+条")
_CAPITAL = re.compile(r"\b[A-ZÀ-Þ0-9]\w{3,}")
_LONG_WORD = re.compile(r"\b[^\W_]{4,}")
_KEY = re.compile(r"[\W\d_]+")


def roman(t: str) -> int:
    values = {"i": 1, "v": 5, "x": 10, "l": 50}
    n = [values[c] for c in t.lower()]
    return sum(-a if b > a else a for a, b in zip(n, [*n[1:], 0]))


def page_number(line: str) -> tuple[str, int] | None:
    """Style and value of a line that holds only a printed page number."""
    m = _NUMBER.fullmatch(line)
    if not m or len(line.strip()) > 24:
        return None
    style = m.lastgroup if m.lastgroup in ("bare", "roman") else next(k for k in ("page", "of", "dash", "dot", "bare", "roman") if m[k])
    text = m["a"] or m["b"] or m["c"] or m["d"] or m["bare"] or m["roman"]
    if re.fullmatch("[ivxl]+", text) and not re.fullmatch("l{1,3}", text):
        return ("roman" if style in ("bare", "roman") else style), roman(text)
    if style == "bare" and not any(c.isdigit() for c in text):
        return None
    if style == "roman":
        style = "bare"
    figures = text.translate(str.maketrans("lIOo□�", "110000"))
    return style, int(figures[:9])


def titled(line: str) -> bool:
    """Whether a line's words look like a title: written large, or few Han characters."""
    words = _LONG_WORD.findall(line)
    latin = [w for w in words if w[0].isascii()]
    return len(_CAPITAL.findall(line)) >= 0.7 * len(latin) if latin else len(line) <= 30


def title_key(line: str) -> str:
    """A running title without its number and marks."""
    return _KEY.sub("", _WITH_NUMBER.sub("", line)).casefold()


def outer(lines: list[str]) -> list[tuple[str, int]]:
    """Side and index of the page's outermost lines that aren't blank: two at the top, three at the bottom."""
    full = [i for i, x in enumerate(lines) if x.strip()]
    return [("top", i) for i in full[:2]] + [("bottom", i) for i in full[::-1][:3] if i not in full[:2]]


def near(a: str, b: str) -> bool:
    """Whether two keys are the same but for a misread character in six at most."""
    if a == b:
        return True
    if not a or not b or abs(len(a) - len(b)) > 2:
        return False
    most = 1 + min(len(a), len(b)) // 6
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] <= most


def is_title(line: str, titles: list[str]) -> bool:
    """Whether an outer line is a running title: of a standard, with a page number on it, of a catalogue, or one of the document's."""
    core = _WITH_NUMBER.sub("", line).strip()
    if len(core) > 70 or _BODY_MARK.search(core):
        return False
    if _STANDARD.match(core):
        return True
    key = title_key(line)
    if len(key) < 3:
        return False
    if titled(core) and any(near(key, t) for t in titles):
        return True
    if _SENTENCE_MARK.search(core):
        return False
    return bool(_WITH_NUMBER.search(line)) and len(key) >= 4 or bool(_CATALOGUE.search(core)) and len(key) >= 6


def furniture(lines: list[str], following: str, titles: list[str], styles: dict[str, int], offsets: set[tuple[str, int]], page: int) -> dict[int, str]:
    """Index and kind (header or page_number) of the page's lines that aren't body."""
    out: dict[int, str] = {}
    full = [i for i, x in enumerate(lines) if x.strip()]
    known = [s for s, n in styles.items() if n > 1]
    for side, order in (("bottom", full[::-1][:3]), ("top", full[:2])):
        for i in order:
            if i in out:
                continue
            line = lines[i]
            number = page_number(line)
            if number and "page_number" not in out.values():
                style, value = number
                inner = lines[i + 1] if i + 1 < len(lines) else following
                body = style == "bare" and (inner.strip().lower().startswith(TOTALS) or i == full[-1] and following.strip().lower().startswith(TOTALS))
                if style in ("page", "of", "dash", "dot"):
                    out[i] = "page_number"
                    continue
                if not body and (style, value - page) in offsets or not body and style in known and (style == "roman" or value - page < 40 and side == "bottom" and not any(s == style for s, _ in offsets)):
                    out[i] = "page_number"
                    continue
                if not body and side == "bottom" and i == full[-1] and len(full) > 1 and is_title(lines[full[-2]], titles):
                    out[i] = "page_number"
                    continue
                if not body and not known and side == "bottom" and i == full[-1] and (style == "roman" or 0 < value < 60):
                    out[i] = "page_number"
                    continue
                break
            if is_title(line, titles):
                out[i] = "header"
                continue
            break
    return out


class Model:
    """Words, compounds, triples and the weights of the character editor."""

    def __init__(self, texts: list[str], counts: dict[str, Counter[str]] | None = None, pages: int = 0) -> None:
        """texts: the perceptron's examples. counts: of all pages, as counted() has them; without them the examples are all there is."""
        counts = counts or self.counted(texts)
        self.words = counts["word"]
        self.longest = max(map(len, self.words), default=0)
        self.compounds = set(counts["compound"])
        self.triples = Counter({k: n for k, n in counts["triple"].items() if n > 1})
        # the perceptron sees a triple's rate, as on as many pages as its examples, so that it doesn't change with the corpus
        share = max(1, pages / max(1, len(texts)))
        self.levels = {k: min(6, math.ceil(n / share).bit_length()) for k, n in self.triples.items()}
        self.hyphened = counts["compound"]
        self.memo: dict[tuple, tuple[float, str]] = {}
        self.weights: dict[str, float] = {}
        self._train(texts)
        self.joins: dict[str, float] = {}
        self._train_joins(texts)

    @classmethod
    def counted(cls, texts: list[str]) -> dict[str, Counter[str]]:
        """How often the texts have each word, first part of a compound and triple."""
        words, compounds, triples = Counter(), Counter(), Counter()
        for t in texts:
            unbroken = re.sub(r"\S*[-¬\u00ad]\s*\n\s*\S*", " ", t) if _BROKEN_LINE.search(t) else t
            words.update(w.casefold() for w in re.findall(r"(?<![\w-])[A-Za-zÀ-ɏ]{2,}(?![\w-])", unbroken))
            compounds.update(w.casefold() for w in re.findall(r"(?<![\w-])([A-Za-z]+)-(?=[A-Za-z])", t))
            padded = "\x02" + re.sub(r"\d", "0", cls.flat(t)) + "\x03"
            triples.update(padded[i : i + 3] for i in range(len(padded) - 2))
        return {"word": words, "compound": compounds, "triple": triples}

    @staticmethod
    def flat(text: str) -> str:
        t = re.sub(r"([A-Za-z])[-¬­]\s*\n\s*(?=[a-z])", r"\1", text)
        t = re.sub(r"(?<=[A-Za-z,.;])\s*\n\s*(?=[A-Za-z])", " ", t)
        return re.sub(r"\s*\n\s*", "", t)

    def features(self, s: str, i: int, c: str, y: str) -> list[str]:
        j = i + len(c)
        left, right = s[max(0, i - 2) : i], s[j : j + 2]
        pair = c + ">" + y
        l1, r1 = left[-1:] or "\x02", right[:1] or "\x03"
        out = [pair, pair + "l" + l1, pair + "r" + r1, pair + "b" + l1 + r1, pair + "L" + left, pair + "R" + right]
        zero = re.sub(r"\d", "0", "\x02\x02" + left), re.sub(r"\d", "0", right + "\x03\x03")
        before, after = zero[0][-2:], zero[1][:2]
        cc, yy = ("0" if c.isdigit() else c), y
        gain = 0
        for n, (a, b) in enumerate(((before + cc, before + yy), (before[-1] + cc + after[0], before[-1] + yy + after[0]), (cc + after, yy + after))):
            p, q = self.levels.get(a[:3], 0), self.levels.get(b[:3], 0)
            gain += q - p
            out += [f"t{n}{p}", f"u{n}{q}", f"v{n}{max(-3, min(3, q - p))}"]
        out.append(f"g{max(-8, min(12, gain))}")
        if c.isascii():
            a, b = i, j
            while a > 0 and s[a - 1].isascii() and s[a - 1].isalnum():
                a -= 1
            while b < len(s) and s[b].isascii() and s[b].isalnum():
                b += 1
            word, other = s[a:b].casefold(), (s[a:i] + y + s[j:b]).casefold()
            k, m = self.words[word] > 0, self.words[other] > 0
            figures = all(x.isdigit() for x in word)
            out += [f"w{k}{m}", f"W{figures}{k}{m}{any(x.isdigit() for x in word)}", pair + f"w{k}{m}"]
        return out

    def score(self, s: str, i: int, c: str, y: str) -> float:
        w = self.weights
        return sum(w.get(f, 0.0) for f in self.features(s, i, c, y))

    def places(self, s: str) -> Iterator[tuple[int, str]]:
        """Where a character may be misread: Han with a look-alike, and in tokens of letters that are no known word."""
        for m in _HAN_CANDIDATE.finditer(s):
            yield m.start(), m[0]
        for token in _ASCII_TOKEN.finditer(s):
            if not _LATIN.search(token[0]) or self.words[token[0].casefold()] or len(token[0]) > self.longest + 1:
                continue  # no letters, a word, or more than any word
            for m in _LATIN_CANDIDATE.finditer(s, *token.span()):
                c, i = m[0], m.start()
                if not c.isdigit() or re.search(r"[a-z]", s[max(0, i - 1) : i] + s[i + 1 : i + 2]):
                    yield i, c

    def _train(self, texts: list[str]) -> None:
        rng = random.Random(7)
        back: dict[str, list[str]] = {}
        for c, ys in PAIRS.items():
            for y in ys:
                back.setdefault(y, []).append(c)
        examples = []
        for t in texts:
            s = self.flat(t)
            out: list[str] = []
            wrong: dict[int, str] = {}
            n = 0
            for x in s:
                if x in back and rng.random() < NOISE:
                    c = rng.choice(back[x])
                    if not c.isascii() or x.isascii():
                        wrong[n] = x
                        out.append(c)
                        n += len(c)
                        continue
                out.append(x)
                n += 1
            noisy = "".join(out)
            for i, c in self.places(noisy):
                for y in PAIRS[c]:
                    truth = wrong.get(i) == y
                    if truth or rng.random() < 0.35:
                        examples.append((self.features(noisy, i, c, y), truth))
        self.weights = self._averaged(examples, rng)

    @staticmethod
    def _averaged(examples: list[tuple[list[str], bool]], rng: random.Random) -> dict[str, float]:
        """The weights of an averaged perceptron over the examples."""
        w: dict[str, float] = {}
        total: dict[str, float] = {}
        step = 0
        for _ in range(ROUNDS):
            rng.shuffle(examples)
            for fs, truth in examples:
                step += 1
                guess = sum(w.get(f, 0.0) for f in fs) > 0
                if guess != truth:
                    d = 1.0 if truth else -1.0
                    for f in fs:
                        w[f] = w.get(f, 0.0) + d
                        total[f] = total.get(f, 0.0) + d * step
        return {f: v - total[f] / (step + 1) for f, v in w.items() if abs(v - total[f] / (step + 1)) > 1e-3}

    def join_features(self, a: str, b: str, own: int = 0) -> list[str]:
        """What speaks for and against joining two halves at a line's end. own: how often this very place is among the counts."""
        whole, first = self.words[a + b] > own, self.hyphened[a] > own
        left, right = self.words[a] > own, self.words[b] > own
        return ["bias", f"w{whole}", f"c{first}", f"w{whole}c{first}", f"c{first}l{left}r{right}", f"w{whole}l{left}r{right}"]

    def _train_joins(self, texts: list[str]) -> None:
        """Words cut at a random place are to be joined, compounds cut at their own hyphen are not."""
        rng = random.Random(11)
        examples: list[tuple[list[str], bool]] = []
        for t in texts:
            for m in re.finditer(r"(?<![\w-])([A-Za-z]+)-([a-z]+)", t):
                examples.append((self.join_features(m[1].casefold(), m[2].casefold(), 1), False))
            for w in re.findall(r"(?<![\w-])[A-Za-z]{5,}(?![\w-])", t):
                if rng.random() < 0.1:
                    k = rng.randint(2, len(w) - 2)
                    examples.append((self.join_features(w[:k].casefold(), w[k:].casefold(), 1), True))
        self.joins = self._averaged(examples, rng)

    def broken(self, line: str, following: str) -> bool | None:
        """Whether a line ends within a word broken only there; None if it doesn't end with a hyphen."""
        if line.rstrip()[-1:] not in _LINE_ENDS or not (m := _HYPHEN.search(line)):
            return None
        n = _FIRST_WORD.match(following)
        if m[2] in "¬­":
            return bool(n)
        if not n or not n[1][0].islower():
            return False
        a, b = m[1].casefold(), n[1].casefold()
        if not self.joins:
            return bool(self.words[a + b]) or a not in self.compounds
        return sum(self.joins.get(f, 0.0) for f in self.join_features(a, b)) > 0

    def joined(self, body: list[tuple[int, str]], following: str) -> tuple[str, list[int], set[int]]:
        """The body's text, for each of its characters the line it is from, and the lines that end within a word."""
        text: list[str] = []
        owner: list[int] = []
        hyphens: set[int] = set()
        for k, (i, line) in enumerate(body):
            after = body[k + 1][1] if k + 1 < len(body) else following
            core = line.rstrip()
            cut = self.broken(core, after)
            if cut:
                hyphens.add(i)
                core = _HYPHEN.sub(r"\1", core)
            glue = ""
            if not cut and core and (core[-1].isascii() and after[:1].isascii() and not core.endswith("-")):
                glue = " "
            piece = (core if k == 0 or text else core) + glue
            text.append(piece)
            owner += [i] * len(piece)
        return "".join(text), owner, hyphens

    def read(self, s: str) -> list[tuple[int, str, str]]:
        """Place, what stands there and what it should be, '' for an unreadable character that nothing fits."""
        out = []
        for m in re.finditer(f"[{UNREADABLE}]", s):
            i = m.start()
            best = max(((self.triples[a + y + b], y) for a, y, b in self._fill(s[max(0, i - 1) : i], s[i + 1 : i + 2])), default=(0, ""))
            out.append((i, m[0], best[1]))
        for i, c in self.places(s):
            scored = self._best(s, i, c)
            if scored[0] > 0:
                out.append((i, c, scored[1]))
        for m in re.finditer(rf"(?<![A-Za-z])(?=[\dlIOo]*\d)[\d]*[lIOo][\dlIOo]*(?![A-Za-z])", s):
            out += [(m.start() + k, x, {"l": "1", "I": "1", "O": "0", "o": "0"}[x]) for k, x in enumerate(m[0]) if x in LETTERS_FOR_FIGURES]
        return out

    def _best(self, s: str, i: int, c: str) -> tuple[float, str]:
        """The best replacement of a place and its score, which what stands around it decides, so that it is computed once for equal surroundings."""
        a, b = i, i + len(c)
        if c.isascii():
            while a > 0 and s[a - 1].isascii() and s[a - 1].isalnum():
                a -= 1
            while b < len(s) and s[b].isascii() and s[b].isalnum():
                b += 1
        a, b = max(0, a - 2), b + 2
        key = (s[a:b], i - a, c)
        if (known := self.memo.get(key)) is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            known = self.memo[key] = max((self.score(s, i, c, y), y) for y in PAIRS[c])
        return known

    def _fill(self, a: str, b: str) -> list[tuple[str, str, str]]:
        if not hasattr(self, "between"):
            self.between: dict[str, list[str]] = {}
            for t in self.triples:
                self.between.setdefault(t[0] + t[2], []).append(t[1])
        return [(a, y, b) for y in self.between.get(a + b, [])]


def _pages(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "page_number", "text", "source_method").dropDuplicates(["doc_id", "page_number"])


def _edges(pages: DataFrame) -> DataFrame:
    """key or style and value of the outer lines of each page."""
    schema = "doc_id string, page_number int, key string, style string, value int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for d, p, t in zip(batch.column("doc_id").to_pylist(), batch.column("page_number").to_pylist(), batch.column("text").to_pylist()):
                lines = (t or "").split("\n")
                for _, i in outer(lines):
                    number = page_number(lines[i])
                    key = title_key(lines[i])
                    core = _WITH_NUMBER.sub("", lines[i]).strip()
                    ok = not number and 3 <= len(key) and len(core) <= 70 and titled(core) and not _SENTENCE_MARK.search(core)
                    if number or ok:
                        for c, v in zip(out, (d, p, None if number else key, number and number[0], number and number[1])):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.string()), pa.array(out[3], pa.string()), pa.array(out[4], pa.int32())], names=["doc_id", "page_number", "key", "style", "value"])

    return pages.where("page_number is not null").select("doc_id", "page_number", "text").mapInArrow(run, schema)


def _inner_keys(pages: DataFrame) -> DataFrame:
    """Keys of short lines inside pages, such as section headings and parts of tables, with the number of documents that hold them."""
    lines = pages.select("doc_id", F.split("text", "\n").alias("x")).where("size(x) > 6").select("doc_id", F.explode(F.slice("x", F.lit(4), F.size("x") - 6)).alias("line")).where("length(trim(line)) between 2 and 30")
    return lines.select("doc_id", F.lower(F.regexp_replace("line", r"[^\p{L}]+", "")).alias("key")).where("length(key) >= 2").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("inside"))


def _document_facts(pages: DataFrame) -> DataFrame:
    """For each document its recurring titles, the styles of its page numbers and the offsets at which they count up."""
    edges = materialise(_edges(pages), "p1edges")
    keys = edges.where("key is not null").groupBy("doc_id", "key").agg(F.count_distinct("page_number").alias("n")).where("n > 1")
    # a title that lies within the pages of as many documents as have it at their edges is a heading or a table's; both counts grow with the corpus
    at_edges = keys.groupBy("key").agg(F.count(F.lit(1)).alias("documents"))
    keys = keys.join(at_edges.join(_inner_keys(pages), "key").where("inside >= documents").select("key"), "key", "left_anti")
    titles = keys.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "key"))).alias("x")).select("doc_id", F.col("x.key").alias("titles"))
    numbers = edges.where("style is not null").groupBy("doc_id", "style", (F.col("value") - F.col("page_number")).alias("offset")).agg(F.count_distinct("page_number").alias("n"))
    styles = numbers.groupBy("doc_id", "style").agg(F.sum("n").cast("int").alias("pages"), F.max(F.struct("n", "offset")).alias("top"))
    facts = styles.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("style", "pages"))).alias("styles"), F.collect_list(F.when(F.col("top.n") > 1, F.struct("style", F.col("top.offset").alias("offset")))).alias("offsets"))
    return titles.join(facts, "doc_id", "full_outer")


def _body(text: str) -> str:
    lines = text.split("\n")
    skip = {i for _, i in outer(lines) if page_number(lines[i]) or _WITH_NUMBER.search(lines[i]) or _STANDARD.match(lines[i].strip())}
    return "\n".join(x for i, x in enumerate(lines) if i not in skip)


def _counts(clean: DataFrame) -> DataFrame:
    """kind, key and n of the words, compounds and triples of all clean pages; a triple met once is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Model.counted([_body(t) for t in batch.column("text").to_pylist()])
            for kind, c in counts.items():
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["kind", "key", "n"])

    found = clean.select("text").mapInArrow(run, "kind string, key string, n bigint")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n")).where("kind <> 'triple' or n > 1")


def trained(pages: DataFrame) -> Model:
    """The editor: words, compounds and triples of all clean pages, those from a text layer; its perceptron trained on those of least hash."""
    clean = pages.where("source_method = 'pdf_text' and text is not null").select("doc_id", "page_number", "text")
    counts: dict[str, Counter[str]] = {"word": Counter(), "compound": Counter(), "triple": Counter()}
    for kind, key, n in _counts(clean).collect():
        counts[kind][key] = n
    sample = clean.orderBy(F.xxhash64("doc_id", "page_number"), "doc_id", "page_number").limit(TRAINING_PAGES)
    return Model([_body(r["text"]) for r in sample.collect()], counts, clean.count())


def _read(df: DataFrame, mode: str) -> DataFrame:
    """mode found: doc_id, page_number, line_no and defect; mode repaired: doc_id, page_number and the page's paragraphs."""
    pages = materialise(_pages(df), "p1pages")
    model = trained(pages)
    facts = _document_facts(pages)
    following = pages.where("page_number is not null").select("doc_id", (F.col("page_number") - 1).alias("page_number"), F.slice(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.trim(x) != ""), 1, 3).alias("following"))
    full = pages.join(following, ["doc_id", "page_number"], "left").join(facts, "doc_id", "left")
    if mode == "found":
        schema = "doc_id string, page_number bigint, line_no bigint, defect string"
    else:
        schema = "doc_id string, page_number bigint, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for r in batch.to_pylist():
                page, text = r["page_number"], r["text"]
                lines = (text or "").split("\n")
                titles = r["titles"] or []
                extra: dict[int, str] = {}
                head = ""
                if page is not None:
                    styles = dict(r["styles"] or [])
                    offsets = {(o["style"], o["offset"]) for o in r["offsets"] or [] if o}
                    nxt = r["following"] or []
                    extra = furniture(lines, nxt[0] if nxt else "", titles, styles, offsets, page)
                    while nxt and (page_number(nxt[0]) or is_title(nxt[0], titles)):
                        nxt = nxt[1:]
                    head = nxt[0] if nxt else ""
                body = [(i, x) for i, x in enumerate(lines) if i not in extra and x.strip()]
                joined, owner, hyphens = model.joined(body, head)
                wrong = model.read(joined)
                if mode == "found":
                    found = [(i, k) for i, k in extra.items()] + [(i, "hyphen") for i in hyphens] + [(i, "char") for i in {owner[p] for p, _, _ in wrong}]
                    for i, k in found:
                        for c, v in zip(out, (r["doc_id"], page, i + 1, k)):
                            c.append(v)
                else:
                    for c, v in zip(out, (r["doc_id"], page, None if text is None else model_repair(model, lines, extra, body, head, wrong, joined, owner))):
                        c.append(v)
            cols = [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64())]
            cols += [pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())] if mode == "found" else [pa.array(out[2], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in schema.split(", ")])

    return full.mapInArrow(run, schema)


def model_repair(model: Model, lines: list[str], extra: dict[int, str], body: list[tuple[int, str]], head: str, wrong: list[tuple[int, str, str]], joined: str, owner: list[int]) -> str:
    """The page's paragraphs: blank lines and headings stay apart, lines of a paragraph are joined, misread characters replaced."""
    chars = list(joined)
    for p, c, y in wrong:
        chars[p] = y or c
        for k in range(1, len(c)):
            chars[p + k] = ""
    blank_before = {i for i, _ in body if any(not lines[k].strip() for k in range(i - 1, i - 2, -1) if k >= 0)}
    out: list[str] = []
    last = None
    for ch, i in zip(chars, owner):
        if i != last and last is not None and i in blank_before:
            out.append("\n\n")
        out.append(ch)
        last = i
    return re.sub(r" +(?=\n|\Z)", "", "".join(out))


def defects(df: DataFrame) -> DataFrame:
    return _read(df, "found")


def repaired(df: DataFrame) -> DataFrame:
    return _read(df, "repaired")
