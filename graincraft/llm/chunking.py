"""Texts cut under a size limit at natural boundaries, so that an edit changes neighbouring pieces only.

A landmark is a place where a rolling hash of the text around it falls below a threshold, so landmarks depend on nothing
but the characters near them. From the start of a piece the landmark of least hash between the minimum and the maximum
size is chosen and snapped to the nearest natural boundary in that window: a blank line, else a line break, else the end
of a sentence, else white space or a mark, else the landmark itself. The next piece begins the overlap before the cut, so
consecutive pieces share exactly that many characters.

Defined results: null and empty texts have no piece; a text within the limit is one piece. Sizes, offsets and overlaps
count code points. line_start and line_end count the lines of the stored text from 1; a line ends with its line feed.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Least share of the limit a piece has, save the last one.
MINIMUM = 0.5
#: Characters the rolling hash sees.
WINDOW = 16

_BLANK = re.compile(r"\n[^\S\n]*\n\s*")
_LINE = re.compile(r"\n")
_SENTENCE = re.compile(r"[。！？!?؟।．]+[”’」』）)\"]*\s*|[.]+[”’\")]*\s+")
_GAP = re.compile(r"[\s，、；：,;:]+")
_LEVELS = (_BLANK, _LINE, _SENTENCE, _GAP)


def _rolling(text: str) -> np.ndarray:
    """At each place, a hash of the WINDOW characters before it."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    h = np.zeros(len(codes) + 1, dtype=np.uint64)
    mult = np.uint64(0x9E3779B97F4A7C15)
    mixed = (codes + np.uint64(1)) * mult
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    acc = np.zeros(len(codes), dtype=np.uint64)
    for k in range(min(WINDOW, len(codes))):
        turned = (mixed << np.uint64(k + 1)) | (mixed >> np.uint64(63 - k))
        acc[k:] ^= turned[: len(codes) - k]
    h[1:] = acc * np.uint64(0x94D049BB133111EB)
    return h


def pieces(text: str | None, limit: int, overlap: int) -> list[tuple[int, int]]:
    """Start and end of each piece of a text."""
    if not text:
        return []
    n = len(text)
    if n <= limit:
        return [(0, n)]
    if not 0 <= overlap < limit * MINIMUM:
        raise ValueError("the overlap must be below the least size of a piece")
    least = int(limit * MINIMUM)
    hashes = _rolling(text)
    cuts_by_level = [[m.end() for m in level.finditer(text)] for level in _LEVELS]
    out = []
    start = 0
    while n - start > limit:
        low, high = start + max(least, overlap + 1), start + limit
        mark = low + int(np.argmin(hashes[low : high + 1]))
        cut = mark
        for cuts in cuts_by_level:
            i = bisect.bisect_left(cuts, mark)
            near = [c for c in cuts[max(0, i - 1) : i + 1] if low <= c <= high]
            if near:
                cut = min(near, key=lambda c: (abs(c - mark), c))
                break
        out.append((start, cut))
        start = cut - overlap
    out.append((start, n))
    return out


def chunked(df: DataFrame, key: str, text: str, limit: int, overlap: int, oversized_only: bool = True, field: str | None = None) -> DataFrame:
    """item_id, field, piece (from 0), start_char, end_char, line_start, line_end and text of each piece, row by row without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            size = 0
            for k, t in zip(batch.column(key), batch.column(text)):
                t = t.as_py()
                if t is None or oversized_only and len(t) <= limit:
                    continue
                breaks = [m.start() for m in _LINE.finditer(t)]
                for n, (a, b) in enumerate(pieces(t, limit, overlap)):
                    row = (k.as_py(), field or text, n, a, b, bisect.bisect_left(breaks, a) + 1, bisect.bisect_left(breaks, b - 1) + 1, t[a:b])
                    for c, v in zip(cols, row):
                        c.append(v)
                    size += b - a
                if size > 8_000_000:
                    yield _batch(cols)
                    cols, size = [[] for _ in range(8)], 0
            yield _batch(cols)

    return df.select(key, text).mapInArrow(run, SCHEMA)


SCHEMA = T.StructType([T.StructField(n, t()) for n, t in (("item_id", T.StringType), ("field", T.StringType), ("piece", T.IntegerType), ("start_char", T.LongType), ("end_char", T.LongType), ("line_start", T.IntegerType), ("line_end", T.IntegerType), ("text", T.StringType))])


def _batch(cols: list[list]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=SCHEMA.names)
