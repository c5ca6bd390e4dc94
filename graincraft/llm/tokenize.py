"""Byte-level byte-pair encoding of a text column with the ranks of a public tokenizer.

A text is split by the tokenizer's pattern, and each piece is encoded over a segment tree. The leaves hold the ranks of
adjacent pairs, every inner node the lower of its children, so the root tells the lowest rank and the walk down that
prefers the left child ends at its leftmost place. A merge changes three leaves at most, each updated in logarithmic
time, so even a piece of a million bytes takes n log n steps.

Defined results: null and empty texts have the empty list; characters outside the vocabulary fall back to bytes, so
every text has an encoding; unpaired surrogates can't occur in Spark strings. Special tokens' names are plain text.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The pattern byte_bpe_50k splits by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pieces kept in a worker's memory; the store is emptied when full, so its size is bounded whatever the corpus.
MEMO_PIECES = 60_000
#: Longer pieces seldom come again and are not kept.
MEMO_BYTES = 120
#: Ids that a worker gathers before it hands rows on.
IDS_AT_ONCE = 2_000_000
NONE = 1 << 30

_loaded: dict[str, "Encoder"] = {}


class Encoder:
    def __init__(self, path: str) -> None:
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pieces = regex.compile(PATTERN).findall
        self.memo: dict[str, list[int]] = {}

    def piece(self, data: bytes) -> list[int]:
        ranks = self.ranks
        if (whole := ranks.get(data)) is not None:
            return [whole]
        n = len(data)
        parts: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        half = 1 << (n - 1).bit_length()
        tree = [NONE] * (2 * half)
        get = ranks.get
        tree[half : half + n - 1] = [get(data[i : i + 2], NONE) for i in range(n - 1)]
        for i in range(half - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a <= b else b
        while (low := tree[1]) != NONE:
            i = 1
            while i < half:
                i += i
                if tree[i] != low:
                    i += 1
            i -= half
            j = after[i]
            parts[i] += parts[j]
            parts[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                changes = [(j, NONE), (i, get(parts[i] + parts[k], NONE))]
            else:
                changes = [(j, NONE), (i, NONE)]
            if (h := before[i]) >= 0:
                changes.append((h, get(parts[h] + parts[i], NONE)))
            for at, rank in changes:
                at += half
                if tree[at] == rank:
                    continue
                tree[at] = rank
                at >>= 1
                while at:
                    a, b = tree[2 * at], tree[2 * at + 1]
                    if b < a:
                        a = b
                    if tree[at] == a:
                        break
                    tree[at] = a
                    at >>= 1
        return [ranks[p] for p in parts if p is not None]

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        memo = self.memo
        for piece in self.pieces(text):
            ids = memo.get(piece)
            if ids is None:
                ids = self.piece(data := piece.encode("utf-8"))
                if len(data) <= MEMO_BYTES:
                    if len(memo) >= MEMO_PIECES:
                        memo.clear()
                    memo[piece] = ids
            out += ids
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for a rank file, read once per Python process."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def encode_column(df: DataFrame, text: str = "text", ids: str = "ids", ranks: str = DEFAULT_RANKS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of keep and the token ids of text, one row for each row of df, without a shuffle."""
    fields = [df.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks)
        for batch in batches:
            begin, offsets, flat = 0, [0], array("i")
            for n, t in enumerate(batch.column(text), 1):
                flat.extend(e.encode(t.as_py()))
                offsets.append(len(flat))
                if len(flat) >= IDS_AT_ONCE or n == batch.num_rows:
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(memoryview(flat), pa.int32()))
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(begin, n - begin) for c in keep), lists], names=[*keep, ids])
                    begin, offsets, flat = n, [0], array("i")

    return df.select(*keep, text).mapInArrow(run, T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def count_column(df: DataFrame, text: str = "text", out: str = "n_tokens", ranks: str = DEFAULT_RANKS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As encode_column, with the number of tokens only."""
    fields = [df.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks)
        for batch in batches:
            counts = pa.array([len(e.encode(t.as_py())) for t in batch.column(text)], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), counts], names=[*keep, out])

    return df.select(*keep, text).mapInArrow(run, T.StructType([*fields, T.StructField(out, T.LongType())]))
