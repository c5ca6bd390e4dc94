"""Fuzzy text measures that built-in functions lack, in Arrow batches."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _best(text: str, term: str) -> float:
    best = 0.0
    for x in map(str.lower, text.splitlines() or [text]):
        if not (n := len(term) + len(x)):
            return 1.0
        # no ratio is above that of all the term's characters that stand in the line
        if 2.0 * min(len(x), sum(c in x for c in term)) / n > best:
            best = max(best, SequenceMatcher(None, term, x).ratio())
    return best


@F.pandas_udf(T.DoubleType())
def best_line_ratio(text: pd.Series, term: pd.Series) -> pd.Series:
    """The highest matching-block ratio of a term with a line of a text; null texts count as empty."""
    return pd.Series([_best(t or "", (w or "").lower()) for t, w in zip(text, term)], dtype="float64")


@F.pandas_udf(T.BooleanType())
def holds_loosely(text: pd.Series, needle: pd.Series) -> pd.Series:
    """Whether a needle stands in a text without white space, or, up to 40 characters, as a subsequence within six times its length (80 at least)."""

    def one(t: str | None, n: str | None) -> bool:
        t, n = "".join((t or "").split()), "".join((n or "").split())
        if not n:
            return False
        if n in t:
            return True
        if len(n) > 40:
            return False
        at, first, last = 0, -1, -1
        for c in n:
            last = t.find(c, at)
            if last < 0:
                return False
            first = last if first < 0 else first
            at = last + 1
        return last - first <= max(80, 6 * len(n))

    return pd.Series([one(t, n) for t, n in zip(text, needle)])
