"""The terms of rows, in Arrow batches: built-in functions can tell them too (functions.text.terms), but take several times as long."""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import INSUFFICIENT, STOP_TERMS, TERM_BREAKS

_BREAKS = re.compile(TERM_BREAKS)
_LETTER, _CODE = re.compile("^[A-Za-z]?[）)、.．]?"), re.compile("^[0-9]+(?:[.．][0-9]+)*")
_STOPS = frozenset(STOP_TERMS)


def _uncoded(t: str) -> str:
    return t if "\u3400" <= t < "\ua000" else _CODE.sub("", _LETTER.sub("", t, count=1), count=1)


def terms_of(text: str) -> list[str]:
    """As functions.text.terms has them; a term may come twice."""
    text = _uncoded("".join(text.split()))
    if text == INSUFFICIENT:
        return []
    # a text without breaks that begins with a Han character is its only part; what is longer than 12 is no term as a whole
    parts = _BREAKS.split(text)
    found = [text] if len(parts) == 1 and "\u3400" <= text < "\ua000" else [*map(_uncoded, parts), *[text] * (len(text) <= 12)]
    return [t for t in found if len(t) >= 2 and t not in _STOPS]


_kept = lru_cache(maxsize=50_000)(terms_of)


def _told(lists: pa.Array) -> tuple[list[int], list[list[str]]]:
    """How many texts each list has, and the terms of all lists' texts."""
    texts = lists.flatten().fill_null("").dictionary_encode()
    once = [_kept(t) for t in texts.dictionary.to_pylist()]
    return pc.fill_null(pc.list_value_length(lists), 0).to_pylist(), [once[i] for i in texts.indices.to_pylist()]


@F.arrow_udf(T.ArrayType(T.StringType()))
def row_terms(levels: pa.Array, examples: pa.Array, description: pa.Array, source: pa.Array) -> pa.Array:
    """Distinct terms of a row's levels, examples and, unless its source is insufficient, its description."""
    (n_levels, by_level), (n_examples, by_example) = _told(levels), _told(examples)
    flat: list[str] = []
    ends, i, j = [0], 0, 0
    for n, m, d, s in zip(n_levels, n_examples, description.to_pylist(), source.to_pylist()):
        flat.extend(dict.fromkeys(chain(*by_level[i : i + n], *by_example[j : j + m], terms_of(d) if d and s != "insufficient" else ())))
        ends.append(len(flat))
        i, j = i + n, j + m
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.string()))
