import base64
import os

import pytest

from graincraft.llm import tokenize as K

pytestmark = pytest.mark.skipif(not os.path.exists(K.DEFAULT_RANKS), reason="no rank file")
TEXTS = ["", "a", "Hello, world's end", "中文没有空格的一句话", "x" * 3000, "  two  spaces\n\n\tand tabs ", "<|endoftext|>", "🏥𠮷é", "ab" * 700, "1234567890" * 40, "　全角 空格", "don't we'll I'm"]


@pytest.fixture(scope="module")
def public():
    import tiktoken

    with open(K.DEFAULT_RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=K.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("text", TEXTS)
def test_equals_the_public_encoder(public, text):
    assert K.encoder(K.DEFAULT_RANKS).encode(text) == public.encode_ordinary(text)
    assert public.decode(K.encoder(K.DEFAULT_RANKS).encode(text)) == text


def test_random_bytes(public):
    import random

    rng = random.Random(3)
    for _ in range(60):
        t = "".join(rng.choice("aeinrst 中的一是在,.0é\n") for _ in range(rng.randint(1, 200)))
        assert K.encoder(K.DEFAULT_RANKS).encode(t) == public.encode_ordinary(t)


def test_column_keeps_rows_nulls_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "a", None), (3, "a", None)], "doc_id bigint, text string, ids string")
    out = sorted((r.doc_id, r.ids) for r in K.encode_column(df).collect())
    assert out == [(1, []), (2, []), (3, [64]), (3, [64])]
    assert K.encode_column(df.where("false")).count() == 0
    assert sorted(r.n_tokens for r in K.count_column(df).collect()) == [0, 0, 1, 1]
