import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidegauge.llm import packing as P
from tidegauge.llm.queries import BYTE_BPE_SPECIAL, pack_documents

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def encoder():
    return P.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, tuple(BYTE_BPE_SPECIAL.items()))


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["<|endoftext|>", " ", "\n", "  ", "I'll", "日本", "é", "x" * 40, "123", "<|"]), max_size=20).map("".join)))
def test_ids_are_the_library_s(text):
    assert encoder().encode_to_numpy(text, allowed_special="all").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), max_size=4), st.integers(0, 20))
def test_fill_is_the_best(counts, capacity):
    got = P.fill(counts, capacity)
    assert all(n <= counts[k] for k, n in got.items())
    best = max(s for use in itertools.product(*[range(v + 1) for v in counts.values()]) if (s := sum(k * n for k, n in zip(counts, use))) <= capacity)
    assert sum(k * n for k, n in got.items()) == best


def test_plan_uses_every_length_once():
    rng = random.Random(2)
    counts = {k: rng.randint(1, 40) for k in rng.sample(range(1, 65), 30)}
    used = {}
    for pattern, times in P.plan(counts, 64):
        assert sum(k * n for k, n in pattern.items()) <= 64
        for k, n in pattern.items():
            used[k] = used.get(k, 0) + n * times
    assert used == counts
    assert P.plan({}, 64) == []


def check(rows, pieces):
    texts = sorted((LIBRARY.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows), key=len)
    by_place = sorted((r["sequence_id"], r["offset"], r["length"]) for r in pieces)
    for _, group in itertools.groupby(by_place, lambda r: r[0]):
        at = 0
        for _, offset, length in group:
            assert offset == at
            at += length
        assert at <= 2048
    assert {r[0] for r in by_place} == set(range(len({r[0] for r in by_place})))
    want = sorted((len(t), s, min(2048, len(t) - s), zlib.crc32(np.array(t[s : s + 2048], "<u4").tobytes())) for t in texts for s in range(0, len(t), 2048))
    assert want == sorted((r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]) for r in pieces)


def test_long_runs_are_encoded_by_the_library():
    for text in (" " * 1_000_000, "a" + " " * 3_000_000 + "b", "\n" * 1_000_000, "x" * 1_000_000, " <|endoftext|> " + "\t" * 1_000_000):
        got = P.ids_of(text, encoder(), public_tokenizers.path("byte_bpe_50k.json"))
        assert np.array_equal(got, LIBRARY.encode(text, add_special_tokens=False).ids)


def test_counts_of_tasks_are_not_broadcast(make):
    assert "Broadcast" not in pack_documents(make([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()


def test_query(spark, make, odd_rows):
    rng = random.Random(3)
    rows = [*odd_rows, *[(100 + i, "tide gauge " * rng.randint(0, 900)) for i in range(60)], *[(300 + i, "tie") for i in range(50)], (400, " " * 1_000_000)]
    check(rows, pack_documents(make(rows).repartition(5)).collect())
    assert pack_documents(make([])).count() == 0
