import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegauge.llm import token_count as T

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole(text):
    return len(T.tokenizer(PATH).encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("text", ["x" * 1000, "é́ ́a" * 50, "日本語" * 300, "<|endoftext|> a<|startoftext|>" * 40, "A's 'll" * 50, "\x1c a \x85b" * 40, " \n\t" * 90, "a b" * 300, ""])
def test_spliced_is_whole(text):
    assert T.count_spliced(text, PATH, 64, 8) == whole(text) == T.PieceCounts(PATH).count([text.encode()])[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "Hello", "'s", " ", "\n", "é", "́", "日本", "1234", "--", "<|endoftext|>", " ", "ΑΣ", "İ"]), max_size=120))
def test_splice_any_text(parts):
    text = "".join(parts)
    assert T.count_spliced(text, PATH, 32, 4) == whole(text) == T.PieceCounts(PATH).count([text.encode()])[0]


def test_overlap_grows_without_spaces():
    text = "ab" * 500 + " end " + "cd" * 700
    assert T.count_spliced(text, PATH, 100, 4) == whole(text)


def test_query(spark, make, odd_rows):
    rng = random.Random(1)
    rows = [*odd_rows, (20, " ".join(rng.choice(["tide", "gauge", "Überfall", "x1"]) for _ in range(30_000)))]
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in T.count_tokens(make(rows), PATH, chunk=5_000, overlap=64).collect())
    want = sorted((r[0] or -1, len((r[1] or "").encode()), whole(r[1] or ""), whole(r[1] or "") > 2048) for r in rows)
    assert got == want
    assert T.count_tokens(make([]), PATH).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert T.count_tokens(make([]), PATH).count() == 0
