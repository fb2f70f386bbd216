import random
import zlib

import numpy as np

from tidegauge.llm import language_id as L


def test_bundle_is_the_sum_of_bound_vectors():
    text, dims = "Ab, c\nÉa", 64
    letters = [" ", "a", "b", " ", "c", " ", "é", "a", " "]
    want = np.zeros(dims)
    v = {c: L.letter_vector(ord(c), dims).astype(int) for c in set(letters)}
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        want += np.roll(v[a], 2) * np.roll(v[b], 1) * v[c]
    got = L.bundles([text, "", "123"], dims)
    assert np.allclose(got[0], want) and not got[1].any() and not got[2].any()


def test_wide_alphabets_agree():
    rng = random.Random(5)
    wide = "".join(chr(rng.randint(0x4E00, 0x4F00)) for _ in range(300))
    both = L.bundles(["some text", wide], 32)
    assert np.allclose(both[0], L.bundles(["some text"], 32)[0]) and np.allclose(both[1], L.bundles([wide], 32)[0])


def test_learns_and_leaves_out_the_held_out(spark, make, odd_rows):
    rng = random.Random(6)
    words = {"aa": "the and of that with".split(), "bb": "der und nicht über schön".split()}
    rows = [(i, " ".join(rng.choices(words[k], k=12)), k) for i in range(20, 140) for k in ["aa" if i % 3 else "bb"]]
    # a wrong label in the held-out fold must not matter
    rows = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else k) for i, t, k in rows]
    got = {r["doc_id"]: r for r in L.identify_held_out(make(rows), 256).collect()}
    for i, t, _ in rows:
        assert got[i]["lang_pred"] == ("aa" if i % 3 else "bb")
        assert 0 <= got[i]["score"] <= 1
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
    odd = L.identify_held_out(make([*odd_rows, *rows]), 256).collect()
    assert len(odd) == len(odd_rows) + len(rows)
    assert {r["lang_pred"] for r in odd if r["doc_id"] in (1, 2, 3, 10)} == {"und"}
    assert L.identify_held_out(make([])).count() == 0
    assert {r["lang_pred"] for r in L.identify_held_out(make([(1, "text", None)])).collect()} == {"und"}


def test_many_short_texts_of_many_letters_need_little_memory(spark):
    import subprocess
    import sys

    code = """
import random, resource
import pyarrow as pa
from tidegauge.llm import language_id as L
rng = random.Random(1)
texts = ["".join(chr(rng.randint(0x4E00, 0x4F00)) for _ in range(100)) for _ in range(3000)]
L.bundles(["warm up"], 1024)
L.letters()
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
n = 0
for rows, part in L.small_parts([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])], "text", 1 << 20):
    n += len(L.bundles(part, 64))
assert n == 3000
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    used = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=200).stdout)
    assert used < 300
