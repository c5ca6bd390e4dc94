"""One form for text that looks the same: full-width forms, detached accents, invisible characters, look-alike letters.

The words of the corpus are counted, and the commonest spellings that mix no scripts become a trie over skeletons: decomposed
characters, of which look-alikes share an edge. Every run of letters that holds a suspicious character walks the trie as it
stands through a weighted edit automaton: equal characters and look-alikes cost nothing, ignorable characters are passed at
no cost, anything else costs one and is beyond the bound, as what reads the same differs in nothing that costs. Of the
spellings a walk ends at, the commonest is the canonical one. A run that matches none, and all that isn't a run of letters,
is normalised character by character with the table.

Defined results: null stays null and an empty text empty; a text without a suspicious character is returned as it is;
full-width punctuation, dashes, tabs and line breaks, symbols and whole Greek, Cyrillic or kana words stay. Joiners stay
inside scripts and emoji that need them.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters that look the same in another script, by the Latin letter.
CYRILLIC = {"A": "А", "B": "В", "C": "С", "E": "Е", "H": "Н", "I": "ІӀ", "J": "Ј", "K": "К", "M": "М", "O": "О", "P": "Р", "S": "Ѕ", "T": "Т", "X": "Х", "Y": "ҮУ", "G": "Ԍ", "Q": "Ԛ", "W": "Ԝ", "a": "а", "c": "с", "d": "ԁ", "e": "е", "h": "һ", "i": "і", "j": "ј", "l": "ӏ", "o": "о", "p": "р", "q": "ԛ", "s": "ѕ", "v": "ѵ", "w": "ԝ", "x": "х", "y": "у"}
GREEK = {"A": "Α", "B": "Β", "E": "Ε", "H": "Η", "I": "Ι", "K": "Κ", "M": "Μ", "N": "Ν", "O": "Ο", "P": "Ρ", "T": "Τ", "X": "Χ", "Y": "Υ", "Z": "Ζ", "o": "ο", "v": "ν", "p": "ρ", "u": "υ", "i": "ι", "a": "α", "y": "γ", "x": "χ"}
LATIN = {"g": "ɡ", "a": "ɑ", "i": "ı", "l": "ǀ"}
#: Kana and the Han characters they look like.
KANA = {"エ": "工", "カ": "力", "ロ": "口", "ニ": "二", "タ": "夕", "ト": "卜", "ハ": "八", "オ": "才", "ミ": "三", "チ": "千", "ー": "一", "ヒ": "匕", "ヌ": "又", "ム": "厶"}
#: Radicals of the supplement, which compatibility decomposition leaves.
RADICALS = {"⺃": "乚", "⺅": "亻", "⺉": "刂", "⺌": "小", "⺍": "小", "⺒": "巳", "⺖": "忄", "⺗": "心", "⺘": "扌", "⺙": "攵", "⺛": "旡", "⺝": "月", "⺟": "母", "⺠": "民", "⺡": "氵", "⺣": "灬", "⺤": "爫", "⺦": "丬", "⺨": "犭", "⺩": "王", "⺪": "疋", "⺬": "示", "⺭": "礻", "⺮": "竹", "⺰": "纟", "⺱": "罓", "⺲": "罒", "⺶": "羊", "⺹": "耂", "⺼": "月", "⺽": "臼", "⺾": "艹", "⻀": "艹", "⻁": "虎", "⻂": "衤", "⻃": "覀", "⻄": "西", "⻅": "见", "⻆": "角", "⻈": "讠", "⻉": "贝", "⻋": "车", "⻌": "辶", "⻏": "阝", "⻐": "钅", "⻑": "長", "⻒": "镸", "⻓": "长", "⻔": "门", "⻖": "阝", "⻘": "青", "⻙": "韦", "⻚": "页", "⻛": "风", "⻜": "飞", "⻝": "食", "⻞": "飠", "⻟": "飠", "⻠": "饣", "⻢": "马", "⻣": "骨", "⻤": "鬼", "⻥": "鱼", "⻦": "鸟", "⻨": "麦", "⻩": "黄", "⻫": "斉", "⻬": "齐", "⻮": "齿", "⻰": "龙", "⻳": "龟"}
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u2064\u206a-\u206f\ufeff"
SPACES = "\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"

TO_LATIN = {x: a for table in (CYRILLIC, GREEK, LATIN) for a, xs in table.items() for x in xs}
#: Characters that can be a case at all, as the JVM writes the class.
SUSPICIOUS = rf"[{INVISIBLE}{SPACES}\u0300-\u036f\uff10-\uff19\uff21-\uff3a\uff41-\uff5a\uff66-\uff9f\uf900-\ufaff\u2f00-\u2fdf\u2e80-\u2eff\ufb00-\ufb06\u2100-\u214f\u0370-\u03ff\u0400-\u052f\u0250-\u02af\u0131\u30a0-\u30ff\u3099\u309a\u309b\u309c\x{{1d400}}-\x{{1d7ff}}\x{{2f800}}-\x{{2fa1f}}]"
_SUSPICIOUS = regex.compile(rf"[{INVISIBLE}{SPACES}\u0300-\u036f\uff10-\uff19\uff21-\uff3a\uff41-\uff5a\uff66-\uff9f\uf900-\ufaff\u2f00-\u2fdf\u2e80-\u2eff\ufb00-\ufb06\u2100-\u214f\u0370-\u03ff\u0400-\u052f\u0250-\u02af\u0131\u30a0-\u30ff\u3099-\u309c\U0001d400-\U0001d7ff\U0002f800-\U0002fa1f]")
_INVISIBLE = regex.compile(f"[{INVISIBLE}]")
_NEEDS_JOINER = regex.compile(r"[\p{Arabic}\p{Devanagari}\p{Bengali}\p{Tamil}\p{Telugu}\p{Kannada}\p{Malayalam}\p{Sinhala}\p{Khmer}\p{Myanmar}\p{Mongolian}\p{Extended_Pictographic}\ufe0f]")
_LETTERS = regex.compile(r"[\p{Latin}\p{Greek}\p{Cyrillic}]+")
_RUN = regex.compile(rf"[\p{{Latin}}\p{{Greek}}\p{{Cyrillic}}\U0001d400-\U0001d7ff][\p{{Latin}}\p{{Greek}}\p{{Cyrillic}}\p{{Mn}}\U0001d400-\U0001d7ff{INVISIBLE}]*")
_KANA_RUN = regex.compile(r"[\p{Katakana}ー]+")
#: What compatibility decomposition may be applied to, character by character; symbols such as circled digits are not in it.
_COMPATIBLE = regex.compile(r"[\uff10-\uff19\uff21-\uff3a\uff41-\uff5a\uff66-\uff9f\uf900-\ufaff\u2f00-\u2fdf\ufb00-\ufb06\u212a\u212b\u2126\u210e\U0001d400-\U0001d7ff\U0002f800-\U0002fa1f]+")
_HAN = regex.compile(r"\p{Han}")
_SPACE = regex.compile(f"[{SPACES}]")

#: Words of the vocabulary at most, the commonest; it is what the workers are sent, some 2 MB.
VOCABULARY = 50_000
LEAST_COUNT = 3
MAX_COST = 0


def skeleton(c: str) -> str:
    return TO_LATIN.get(c, c)


class Node:
    __slots__ = ("children", "spellings")

    def __init__(self) -> None:
        self.children: dict[str, Node] = {}
        self.spellings: list[tuple[int, str]] = []


class Trie:
    """Spellings with their counts under their skeletons."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.root = Node()
        for word, n in counts.items():
            node = self.root
            for c in parts(word):
                node = node.children.setdefault(c, Node())
            node.spellings.append((n, word))

    def canonical(self, word: str) -> str | None:
        """The commonest spelling the automaton reaches within MAX_COST, or None."""
        states: dict[int, tuple[Node, int]] = {id(self.root): (self.root, 0)}
        for c in word:
            if _ignorable(c):
                continue
            for part in parts(c):
                after: dict[int, tuple[Node, int]] = {}
                for node, cost in states.values():
                    if (step := node.children.get(part)) is not None:
                        _keep(after, step, cost)
                    if cost < MAX_COST:
                        for other in (node, *node.children.values()):
                            _keep(after, other, cost + 1)
                if not after:
                    return None
                states = after
        found = [(-cost, n, w) for node, cost in states.values() for n, w in node.spellings]
        return max(found)[2] if found else None


def parts(text: str) -> str:
    """The skeletons of a text's decomposed characters."""
    return "".join(map(skeleton, unicodedata.normalize("NFKD", text)))


def _keep(states: dict[int, tuple[Node, int]], node: Node, cost: int) -> None:
    if id(node) not in states or states[id(node)][1] > cost:
        states[id(node)] = (node, cost)


def _ignorable(c: str) -> bool:
    return bool(_INVISIBLE.match(c))


def _script(c: str) -> str:
    o = ord(c)
    return "G" if 0x370 <= o <= 0x3FF else "C" if 0x400 <= o <= 0x52F else "L"


class Canonicaliser:
    def __init__(self, counts: dict[str, int]) -> None:
        self.counts = counts
        self.trie = Trie({w: n for w, n in counts.items() if _LETTERS.fullmatch(w) and len({_script(c) for c in w}) == 1 and not _COMPATIBLE.search(w) and unicodedata.is_normalized("NFC", w)})
        self.memo: dict[str, str] = {}

    def word(self, w: str) -> str:
        """A run of letters in one spelling."""
        scripts = {_script(c) for c in w}
        if scripts == {"L"} and not any(c in TO_LATIN for c in w):
            return w
        plain = "".join(map(skeleton, w))
        if scripts == {"L"}:
            return plain if self.counts.get(w, 0) <= self.counts.get(plain, 0) or len(w) > 1 else w
        if len(scripts) > 1:
            if not any(_script(c) != "L" and c not in TO_LATIN for c in w):
                return plain
            # a letter of the other script without a Latin look-alike: the word is that script's
            own = "C" if "C" in scripts else "G"
            back = {a: x for a, x in (CYRILLIC if own == "C" else GREEK).items()}
            return "".join(back[c][0] if c in back and _script(c) == "L" else c for c in w)
        if all(c in TO_LATIN for c in w):  # all look-alikes: whole words of the other script stay if they are the commoner
            if len(w) == 1 and w.islower():
                return w
            return w if self.counts.get(w, 0) > self.counts.get(plain, 0) * 2 and self.counts.get(w, 0) >= 20 else plain
        return w

    def run(self, w: str) -> str:
        """A run of letters with the marks and invisible characters in it, as the trie spells it; one that it doesn't hold is left to the table."""
        scripts = {_script(c) for c in w if _LETTERS.match(c)}
        if not _SUSPICIOUS.search(w) or "L" not in scripts and len(scripts) == 1 and _LETTERS.fullmatch(w):
            return w  # a word of one other script is judged by its own count
        if len(parts(_INVISIBLE.sub("", w))) < 2:
            return w  # a letter alone says nothing of the word it could be
        best = self.trie.canonical(w)
        return w if best is None else best

    def kana(self, text: str) -> str:
        """Kana that stand in for the Han characters they look like: alone between Han, in a word commoner with Han."""

        def judge(m: regex.Match) -> str:
            run = m[0]
            if not all(c in KANA for c in run):
                return run
            a, b = m.start(), m.end()
            left, right = text[a - 1 : a], text[b : b + 1]
            if not (_HAN.match(left) or _HAN.match(right)):
                return run
            han = "".join(KANA[c] for c in run)
            around = max(self.counts.get(left + han[0], 0), self.counts.get(han[-1] + right, 0))
            if len(run) == 1:
                return han if around or run != "ー" else run
            return han if around > self.counts.get(run, 0) else run

        return _KANA_RUN.sub(judge, text)

    def __call__(self, text: str | None) -> str | None:
        if not text or not _SUSPICIOUS.search(text):
            return text
        if (known := self.memo.get(text)) is not None:
            return known
        t = _RUN.sub(lambda m: self.run(m[0]), text)
        t = _INVISIBLE.sub(lambda m: m[0] if m[0] in "\u200c\u200d" and m.start() and _NEEDS_JOINER.match(m.string[m.start() - 1]) else "", t)
        t = _SPACE.sub(" ", t)
        t = _COMPATIBLE.sub(lambda m: unicodedata.normalize("NFKC", m[0]), t)
        t = "".join(RADICALS.get(c, c) for c in t)
        t = unicodedata.normalize("NFC", t)
        t = _LETTERS.sub(lambda m: self.word(m[0]), t)
        t = self.kana(t)
        if len(text) < 80:
            if len(self.memo) > 50_000:
                self.memo.clear()
            self.memo[text] = t
        return t


def suspicious(text: Column) -> Column:
    """Whether a text holds a character that may be a look-alike; the rest needs no canonicaliser."""
    return text.rlike(SUSPICIOUS)


def vocabulary(texts: DataFrame, column: str = "text", bound: int = VOCABULARY) -> dict[str, int]:
    """Counts of the words of letters and of the pairs of Han characters with one that kana look like, over all texts; the bound commonest are returned."""
    han = "".join(KANA.values())
    pattern = rf"[\p{{IsLatin}}\p{{IsGreek}}\p{{IsCyrillic}}]+|[\p{{IsKatakana}}ー]+"
    pair = rf"(?=([{han}]\p{{IsHan}}|\p{{IsHan}}[{han}]))"
    words = texts.select(F.explode(F.concat(F.regexp_extract_all(column, F.lit(pattern), F.lit(0)), F.regexp_extract_all(column, F.lit(pair), F.lit(1)))).alias("w"))
    top = words.groupBy("w").count().where(F.col("count") >= LEAST_COUNT).orderBy(F.desc("count"), "w").limit(bound)
    return {r["w"]: r["count"] for r in top.collect()}


def canonical(df: DataFrame, column: str, counts: dict[str, int], out: str = "canonical", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of keep, the stored text and its canonical form, row by row without a shuffle."""
    fields = [df.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = Canonicaliser(counts)
        for batch in batches:
            texts = batch.column(column)
            forms = pa.array([one(t.as_py()) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), texts, forms], names=[*keep, column, out])

    return df.select(*keep, column).mapInArrow(run, T.StructType([*fields, df.schema[column], T.StructField(out, T.StringType())]))
