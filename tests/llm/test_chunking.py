import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from graincraft.llm import chunking as C


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab 。.\n，𠮷", min_size=0, max_size=900))
def test_pieces_cover_within_the_limit(text):
    found = C.pieces(text, 100, 20)
    assert all(b - a <= 100 for a, b in found)
    assert all(x[1] - y[0] == 20 for x, y in zip(found, found[1:]))
    if text:
        assert found[0][0] == 0 and found[-1][1] == len(text)
        assert text[:0] + "".join(text[a if n == 0 else a + 20 : b] for n, (a, b) in enumerate(found)) == text


def test_cuts_prefer_blank_lines():
    text = "\n\n".join("句子" * 20 + "。" for _ in range(12))
    assert all(text[b - 2 : b] == "\n\n" for _, b in C.pieces(text, 120, 10)[:-1])


def test_an_edit_changes_neighbouring_pieces_only():
    rng = random.Random(5)
    text = "".join(rng.choice("的一是在不了有和人这。，\n") for _ in range(40_000))
    edited = text[:20_000] + "新加的字" + text[20_000:]
    before = {text[a:b] for a, b in C.pieces(text, 1000, 100)}
    after = [edited[a:b] for a, b in C.pieces(edited, 1000, 100)]
    assert sum(p not in before for p in after) < 12


def test_overlap_must_fit():
    with pytest.raises(ValueError):
        C.pieces("x" * 50, 20, 15)


def test_rows_lines_and_nulls(spark):
    text = "\n".join(f"第{i}行" for i in range(100))
    df = spark.createDataFrame([("a", text, 1), ("b", None, 2), ("c", "短", 3)], "k string, t string, piece int")
    out = C.chunked(df, "k", "t", 120, 10).orderBy("piece").collect()
    assert {r.item_id for r in out} == {"a"} and out[0].line_start == 1 and out[-1].line_end == 100
    for r in out:
        assert text[r.start_char : r.end_char] == r.text and r.line_start == text.count("\n", 0, r.start_char) + 1
