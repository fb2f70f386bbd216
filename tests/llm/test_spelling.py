"""Near words and forms against brute force over pairs of words."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from tidegauge.llm import spelling

from .words import sentence


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p:] == b[p + 1 :]


def brute(rows, length=5, least=3, one_in=97):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % one_in else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= least}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_odd_rows(make, odd_rows):
    rows = odd_rows + [(20 + i, "Zebrastripe ZEBRASTRIPE zebrastripe zebrstripe Éclairs éclairs Éclairs xÉclairsx", "en", "a", 1) for i in range(6)]
    assert rows_of(spelling.variants(make(rows))) == brute(rows)


def test_no_rows(make):
    assert rows_of(spelling.variants(make([]))) == []
    assert rows_of(spelling.variants(make([(1, None), (2, ""), (3, "a b c d e a b c d e a b c d e")]))) == []


@pytest.mark.parametrize("limit", [1, 30, spelling.LIST])
def test_windows_are_halved(make, limit):
    """Words of few letters, so that most have near words, whatever the size of a list."""
    rng = random.Random(1)
    rows = [(i, " ".join("".join(rng.choices("abé", k=rng.randint(4, 8))) for _ in range(300))) for i in range(12)]
    want = brute(rows, least=2)
    assert sum(r[4] > 0 for r in want) > 200
    assert rows_of(spelling.variants(make(rows), least=2, limit=limit)) == want


def test_all_words_of_one_prefix(make):
    """One prefix for all words, in a list far over the limit."""
    rng = random.Random(2)
    words = ["hotprefixhot" + "".join(rng.choices("abc", k=6)) for _ in range(400)]
    rows = [(i, " ".join(words[i % 7 :])) for i in range(6)]
    assert rows_of(spelling.variants(make(rows), limit=200)) == brute(rows)


def test_long_runs(make):
    rows = [(i, "y" * 50_000 + " " + "y" * 50_001 + " " + "y" * 49_999 + "z " + sentence(random.Random(i), 20)) for i in range(4)]
    got = [r for r in rows_of(spelling.variants(make(rows))) if len(r[0]) > 40_000]
    assert [(len(r[0]), r[3], r[4]) for r in got] == [(len(r[0]), r[3], r[4]) for r in brute(rows) if len(r[0]) > 40_000] and len(got) == 3


def test_chain_of_forms(make):
    """Each spelling leads to the next more frequent one."""
    chain = ["abcdefgh", "abcdefg", "abcdef", "abcde"]
    rows = [(1, " ".join(w for i, w in enumerate(chain) for _ in range(3 * 2**i)))]
    got = {r[0]: r for r in rows_of(spelling.variants(make(rows), one_in=1 << 40))}
    assert got["abcdefgh"][1:3] == ("abcdefg", "abcde") and got["abcde"][1:3] == (None, "abcde")


def test_scan_of_one_list():
    words = sorted({"".join(p) for k in (3, 4) for p in itertools.product("ab", repeat=k)})
    import numpy as np

    a, b = spelling.SortedLists(np.zeros(len(words), int), words).near()
    assert sorted((words[i], words[j]) for i, j in zip(a, b)) == sorted((x, y) for x in words for y in words if one_edit(x, y))
