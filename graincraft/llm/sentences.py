"""Sentence units of texts in any script.

The text is cut at blank lines, paired quotation marks and brackets are found, and the marks with the Sentence_Terminal
property (or a full stop in one of its forms) outside all pairs are judged one by one: a full stop by the word before it
(abbreviations of the language that the paragraph, else the text, is told by; initials, item numbers, ordinals before a month), by what follows (lower case
goes on) and by its neighbours (figures, addresses); the others end the sentence at once, with the closing marks behind
them. A quotation ends the sentence if it holds the sentence's last mark and the text behind it begins anew. A text in
Thai is cut at its spaces, save beside figures and Latin words.

Defined results: null, empty and blank texts have no sentence. Marks without a partner in their paragraph count as
ordinary characters. Positions are code points of the stored text, start from 0, end exclusive. White space inside a
sentence stays in its span, and every other character lies in exactly one span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

STOPS = ".．"
#: All characters with the Sentence_Terminal property but full stops, whose sense their neighbours tell, and the vertical forms of some.
TERMINALS = "".join(c for c in regex.findall(r"\p{Sentence_Terminal}", "".join(map(chr, [*range(0x21, 0xD800), *range(0xE000, 0x20000)]))) if c not in STOPS) + "︒︕︖"
# Marks, abbreviations and names by language.
OPENING = "([{（［｛【〔〖《〈「『“‘«‹„‚｢"
CLOSING = ")]}）］｝】〕〗》〉」』”’»›｣"
PAIRS = {"(": ")", "[": "]", "{": "}", "（": "）", "［": "］", "｛": "｝", "【": "】", "〔": "〕", "〖": "〗", "《": "》", "〈": "〉", "「": "」", "『": "』", "“": "”", "‘": "’", "«": "»", "‹": "›", "„": "“”", "‚": "‘’", "｢": "｣"}
QUOTES = "「『“‘«‹„‚｢\""
TITLE_MARKS = "『《〈"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
#: Never at a sentence's end: a name or more of the sentence follows.
BEFORE_MORE = {
    "en": "Dr Mr Mrs Ms Prof St Sr Jr Gen Rev Hon cf vs viz approx ca e.g i.e al ed eds esp Co",
    "de": "Bsp bzw d.h Dr Hr Fr evtl ggf gem lt max min Mio Mrd Prof Std Str Tel u.a vgl z.B z zzgl inkl exkl sog u i.d.R o.g ca",
    "fr": "M MM Mme Mlle Dr Pr Me p.ex ex cf av bd St Ste tél éd par env",
    "hi": "डॉ श्री प्रो",
    "ar": "د أ م",
}
#: Not at a sentence's end before a figure, a Roman number or a single capital; else they are words like any other.
BEFORE_NUMBER = {
    "en": "No Nos Fig Figs Tab Sec Secs Art Arts Ch Vol Ver Vers pp p Eq Eqs Ref Refs App",
    "de": "Nr Nrn Abs Abb Art Bd Kap S Tab Ziff Ver No",
    "fr": "art arts chap fig p pp vol no réf Ver Nr",
    "hi": "सं क्र No Ver",
    "ar": "ص No Ver",
}
#: May stand at a sentence's end; it goes on with lower case.
AT_END = {"en": "etc Ltd Inc Corp p.m a.m Bros", "de": "usw etc ff f", "fr": "etc"}
#: Words that tell languages of Latin script apart.
TELLING = {
    "en": "the of and to in is are be for by with shall must this that it he she we they was which on at as not from",
    "de": "der die das und ist sind mit für von den dem des werden wird nicht ein eine zu im auf nach bei als auch",
    "fr": "le la les et des est sont pour par dans une un du de au aux ne pas sur que qui avec doit selon",
}
#: A capital letter behind these names a part, not a person.
LABELS = "annex annexe anlage appendix anhang attachment section part partie teil type class classe klasse category group groupe level schedule table figure option plan form version bloc block grade stufe niveau"
MONTHS = "Januar Februar März April Mai Juni Juli August September Oktober November Dezember Jänner"
DAYS = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday"

_LISTS = {"more": BEFORE_MORE, "number": BEFORE_NUMBER, "end": AT_END}


class Suppressions:
    """The abbreviations of some languages."""

    def __init__(self, *languages: str) -> None:
        self.more, self.number, self.end = ({w.casefold() for k in languages for w in table.get(k, "").split()} for table in _LISTS.values())


_OF = {k: Suppressions(k, "en") if k in ("hi", "ar") else Suppressions(k) for k in BEFORE_MORE}
_ALL = Suppressions(*BEFORE_MORE)
_TOLD = {w: k for k, ws in TELLING.items() for w in ws.split()}
_LATIN_WORD = re.compile(r"[A-Za-zÀ-ÿ]+")
_LABELS, _MONTHS, _DAYS = set(LABELS.split()), set(MONTHS.split()), set(DAYS.split())
_BLANK = re.compile(rf"(?:{LINE_BREAK})[^\S\n\r\x0b\x0c\x1c-\x1e\x85  ]*(?:{LINE_BREAK})\s*")
_MARK = re.compile(f"[{re.escape(STOPS + TERMINALS + OPENING + CLOSING)}\"]")
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")
#: The same for texts of the basic plane, for which it is far faster.
_PLAIN_MARK = re.compile(f"[{re.escape(''.join(c for c in STOPS + TERMINALS + OPENING + CLOSING if c < chr(0x10000)))}\"]")
_ITEM = re.compile(r"\s*[(（\[【]?(?:\d{1,4}(?:[.．]\d{1,3})*|[ivxIVX]{1,5}|[A-Za-z])[)）\]】]?[.．]?\Z")
_WORD_BEFORE = re.compile(r"(?<![^\W\d_])((?:[^\W\d_]\.)*[^\W\d_][\wऀ-ॿ]*)\Z")
_NEXT_WORD = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\s")
_THAI = re.compile(r"[฀-๿]")
_THAI_GAP = re.compile(r"\s+")
_END_MARKS = frozenset(STOPS + TERMINALS)
_CLOSERS = frozenset(CLOSING + '"')
_NUMBER_NEXT = re.compile(r"\s*(?:\d|[IVXLCivxlc]+\b|[A-Z]\b)")
_DEVANAGARI, _ARABIC = re.compile("[\u0900-\u097f]"), re.compile("[\u0600-\u06ff]")
_WORD_MARK = re.compile(r"[\w\u0900-\u097f]")
_HIRAGANA = re.compile(r"[ぁ-ゟ]")


def _pairs(text: str, start: int, end: int, mark: re.Pattern) -> dict[int, int]:
    """From each opening mark's place to that of its partner, outermost pairs only."""
    stack: list[tuple[int, str]] = []
    found: list[tuple[int, int]] = []
    for m in mark.finditer(text, start, end):
        c, i = m[0], m.start()
        if c == '"':
            if any(x == '"' for _, x in stack):
                while stack[-1][1] != '"':
                    stack.pop()
                found.append((stack.pop()[0], i))
            else:
                stack.append((i, '"'))
            continue
        if c in "”’“‘»›" or c in CLOSING:
            if c == "’" and i + 1 < end and text[i + 1].isalpha() and i > start and text[i - 1].isalpha():
                continue
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][1] != '"' and c in PAIRS[stack[k][1]]:
                    found.append((stack[k][0], i))
                    del stack[k:]
                    break
            else:
                if c in PAIRS:
                    stack.append((i, c))
            continue
        if c in PAIRS:
            stack.append((i, c))
    out: dict[int, int] = {}
    last = -1
    for a, b in sorted(found):
        if a > last:
            out[a] = last = b
    return out


def _language(text: str, start: int, end: int) -> Suppressions | None:
    """The abbreviations of the language that a stretch of text is told by, None if nothing tells."""
    seen = dict.fromkeys(TELLING, 0)
    for m in _LATIN_WORD.finditer(text, start, end):
        if (k := _TOLD.get(m[0].casefold())) is not None:
            seen[k] += 1
    if any(seen.values()):
        first, second = sorted(seen, key=seen.get, reverse=True)[:2]
        return _OF[first] if seen[first] > 1 and seen[first] >= 2 * seen[second] else None
    if _DEVANAGARI.search(text, start, end):
        return _OF["hi"]
    return _OF["ar"] if _ARABIC.search(text, start, end) else None


def _word(text: str, begin: int, at: int) -> re.Match | None:
    """The word before a place, however long."""
    i = at
    while i > begin and (text[i - 1] == "." or text[i - 1] == "_" or text[i - 1].isalnum() or _WORD_MARK.match(text[i - 1])):
        i -= 1
    return _WORD_BEFORE.search(text, i, at)


def _label(text: str, begin: int, at: int) -> str:
    """The word before a place, without what stands between."""
    while at > begin and (text[at - 1].isspace() or text[at - 1] in "’'"):
        at -= 1
    i = at
    while i > begin and text[i - 1].isalpha():
        i -= 1
    return text[i:at]


def _cjk_number(text: str, begin: int, at: int) -> bool:
    """Whether a number that a Han character or kana stands before ends at a place."""
    i = at
    while i > begin and text[i - 1].isdigit():
        i -= 1
    return i < at and i > begin and ("\u3040" <= text[i - 1] <= "\u30ff" or "\u4e00" <= text[i - 1] <= "\u9fff")


def _begins(text: str, at: int, end: int) -> str:
    """The next character that isn't white space, or ''."""
    while at < end and text[at].isspace():
        at += 1
    return text[at] if at < end else ""


def _stop_ends(text: str, begin: int, at: int, after: int, end: int, known: Suppressions) -> bool:
    """Whether the full stop at the place at ends the sentence that began at begin; after: behind the marks in a row."""
    if after < end and not text[after].isspace() and text[after] not in _CLOSERS:
        c = text[after]
        if c in ",;:，；：、/\\-_@=":
            return False
        if c.isdigit() or c.isascii() and c.isalpha():  # no space behind the stop: only a plain word before it and a new one behind it count
            word = _word(text, begin, at)
            return bool(word) and text[at - 1].isalpha() and word[1].casefold() not in known.more and not (word[1].casefold() in known.number and _NUMBER_NEXT.match(text, after)) and (len(word[1]) > 2 and not word[1].isupper() or word[1].casefold() in known.end) and (c.isdigit() or c.isupper()) and "." not in word[1][:-1]
        if text[at - 1 : at].isascii() and c.isalpha() and not text[at - 1 : at].isdigit():
            word = _word(text, begin, at)
            if word and (word[1].casefold() in known.more or word[1].casefold() in known.number):
                return False
    nxt = _begins(text, after, end)
    if nxt == "":
        return True
    if nxt.islower() or nxt in ",;:，；：、":
        return False
    if after - at > 1:  # several stops in a row
        return nxt.isupper() or not nxt.isalpha()
    if _ITEM.match(text, begin, at) and not text[begin:at].strip() == "":
        return False
    word = _word(text, begin, at)
    if word:
        w = word[1]
        low = w.casefold()
        if low in known.end:
            m = _NEXT_WORD.match(text, text.index(nxt, after))
            return not (m and m[0] in _DAYS)
        if len(w) == 1 and w.isupper() and w.isascii():
            if low in known.number and _NUMBER_NEXT.match(text, after):
                return False
            if _label(text, begin, word.start()).casefold() in _LABELS:
                return True
            return not (nxt.isupper() or nxt.isdigit())
        return not (low in known.more or low in known.number and _NUMBER_NEXT.match(text, after))
    if text[at - 1 : at].isdigit():
        m = _NEXT_WORD.match(text, text.index(nxt, after))
        if m and m[0] in _MONTHS:
            return False
        if nxt.isdigit() and "\n" in text[after : after + 3] and _cjk_number(text, begin, at):
            return False  # a decimal cut by a hard line end
    return True


def _quote_ends(text: str, begin: int, opened: int, closed: int, end: int) -> bool:
    """Whether the quotation from opened to closed, which ends with a mark of its own, ends the sentence."""
    nxt = _begins(text, closed + 1, end)
    if nxt == "":
        return True
    if nxt.islower() or nxt in _END_MARKS or nxt in ",;:，；：、" or nxt in CLOSING:
        return False
    spaced = closed + 1 < end and text[closed + 1].isspace()
    before = text[begin:opened].rstrip()
    if nxt.isupper() or before.endswith((":", "：")):
        return True
    first = not before or bool(_ITEM.match(before + "\n", 0, len(before)) and len(before) < 8)
    code = ord(nxt)
    if 0xAC00 <= code <= 0xD7A3 or 0x0900 <= code <= 0x097F:
        return spaced
    if 0x0600 <= code <= 0x06FF:
        return spaced and first
    if nxt.isalpha() and code >= 0x3040:
        return first and text[opened] not in TITLE_MARKS and not _HIRAGANA.match(nxt)
    return first or not nxt.isalpha()


def _thai_cuts(text: str, begin: int, end: int, inside: dict[int, int]) -> list[int]:
    """Places behind which a Thai sentence ends within begin and end."""
    cuts = []
    spans = sorted(inside.items())
    for m in _THAI_GAP.finditer(text, begin, end):
        a, b = m.span()
        if a == begin or b == end or any(x < a < y for x, y in spans):
            continue
        left, right = text[a - 1], text[b]
        if _THAI.match(left) and (_THAI.match(right) or right in QUOTES) or left in _CLOSERS and _THAI.match(right):
            cuts.append(a)
    return cuts


def spans(text: str | None) -> list[tuple[int, int]]:
    """Start and end of each sentence of a text."""
    out: list[tuple[int, int]] = []
    if not text:
        return out
    mark = _MARK if _ASTRAL.search(text) else _PLAIN_MARK
    at = 0
    blocks = []
    whole: Suppressions | None = None
    for m in _BLANK.finditer(text):
        blocks.append((at, m.start()))
        at = m.end()
    blocks.append((at, len(text)))
    for start, end in blocks:
        while start < end and text[start].isspace():
            start += 1
        while end > start and text[end - 1].isspace():
            end -= 1
        if start == end:
            continue
        known = None  # found where a full stop asks for it
        pairs = _pairs(text, start, end, mark)
        cuts: list[int] = []
        begin, i = start, start
        while m := mark.search(text, i, end):
            c, p = m[0], m.start()
            if (closed := pairs.get(p)) is not None:
                i = closed + 1
                last = text[closed - 1]
                k = closed - 1
                while last.isspace() and k > p:
                    k -= 1
                    last = text[k]
                if c in QUOTES and last in _END_MARKS and _quote_ends(text, begin, p, closed, end):
                    cuts.append(i)
                    begin = i
                continue
            i = p + 1
            if c not in _END_MARKS:
                continue
            while i < end and text[i] in _END_MARKS:
                i += 1
            if c in STOPS:
                if known is None:
                    if (known := _language(text, start, end)) is None:
                        whole = whole or _language(text, 0, len(text)) or _ALL
                        known = whole
                ends = all(x in STOPS for x in text[p:i]) and _stop_ends(text, begin, p, i, end, known) or any(x not in STOPS for x in text[p:i])
            else:
                ends = not (c.isascii() and i < end and text[i].isascii() and (text[i].islower() or text[i] in "=&/"))
            if not ends:
                continue
            while i < end and text[i] in _CLOSERS and i not in pairs:
                i += 1
            cuts.append(i)
            begin = i
        bounds = [start, *(c for c in cuts if c < end), end]
        if _THAI.search(text, start, end):
            bounds = sorted({*bounds, *(c for a, b in zip(bounds, bounds[1:]) for c in _thai_cuts(text, a, b, pairs))})
        for a, b in zip(bounds, bounds[1:]):
            while a < b and text[a].isspace():
                a += 1
            while b > a and text[b - 1].isspace():
                b -= 1
            if a < b:
                out.append((a, b))
    return out


def sentence_spans(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, start_char and end_char of each sentence of each row's text, row by row without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, starts, ends = [], [], []
            for n, t in enumerate(batch.column(text)):
                found = spans(t.as_py())
                index += [n] * len(found)
                starts += [a for a, _ in found]
                ends += [b for _, b in found]
            keys = batch.column(key).take(pa.array(index, pa.int32()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=[key, "start_char", "end_char"])

    return df.select(key, text).mapInArrow(run, T.StructType([df.schema[key], T.StructField("start_char", T.LongType()), T.StructField("end_char", T.LongType())]))
