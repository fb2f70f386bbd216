"""Fingerprints against a plain version that counts, sorts and hashes document by document."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from tidegauge.llm import fingerprints as fp

from .words import sentence


def plain_terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return set(re.findall("[0-9a-z\x80-\U0010ffff]+", low))


def plain_mark(text, df, n):
    found = plain_terms(text)
    own = sorted(t for t in found if df[hashlib.md5(t.encode()).digest()[:3]] and fp.LOW <= math.log(n / df[hashlib.md5(t.encode()).digest()[:3]]) <= fp.HIGH)
    if not own:
        return "--" + hashlib.md5(" ".join(sorted(found)).encode()).hexdigest()
    level = int(math.log2(len(own)))
    out = f"{level:02d}"
    for at in range(level, level + fp.LEVELS):
        for k in range(fp.LISTS):
            chosen = [t for t in own if int(hashlib.md5(t.encode()).hexdigest()[16:], 16) * fp.factor(k) % 2**64 < 2 ** (64 - at)]
            out += hashlib.md5(" ".join(chosen).encode()).hexdigest()[:4] if chosen else "...."
    return out


def brute(rows):
    """Rows in the order of their ids; rows of equal id must have equal texts."""
    rows = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    df = Counter(b for _, t in rows for b in {hashlib.md5(x.encode()).digest()[:3] for x in plain_terms(t)})
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = (plain_mark(t, df, len(rows)) for t in (text, edited, following))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows(make, odd_rows):
    assert rows_of(fp.fingerprint(make(odd_rows))) == brute(odd_rows)


@pytest.mark.parametrize("n", [0, 1, 2, 400])
def test_successors_over_ranges(make, n):
    rng = random.Random(n)
    rows = [(rng.randint(-(10**12), 10**12), sentence(rng, rng.randint(0, 60))) for _ in range(n)]
    assert rows_of(fp.fingerprint(make(rows))) == brute(rows)


def test_one_id_for_a_third(make):
    """Rows of one id, and rows without one, are cut into several ranges; each row still has one successor."""
    rng = random.Random(3)
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"{i} {sentence(rng, 5)}") for i in range(600)]
    df = make(rows).select("doc_id", "text")
    ranged = fp.ranges(df, 24).groupBy("_part").count().collect()
    assert max(r["count"] for r in ranged) < 100
    got = rows_of(fp.fingerprint(df))
    halves = Counter(hashlib.sha256((t[: len(t) - len(t) // 2] + u[: len(t) // 2]).encode()).hexdigest() for _, t in rows for _, u in rows)
    assert len(got) == len(rows) and all(halves[r[2]] for r in got)


def test_likeness_falls_with_the_share_of_changed_terms():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    mark = fp.Fingerprinter(b"\xff" * (1 << fp.BITS - 3))
    for size in (20, 200, 1500):
        base = rng.sample(words[:2000], size)
        marks = [mark(" ".join(base[: size - int(size * part)] + rng.sample(words[2000:], int(size * part)))) for part in (0, 0.05, 0.5, 1)]
        same, near, half, none = (fp.likeness(marks[0], m) for m in marks)
        assert same == 1 and 1 > near > half > none and none < 0.05 and near > 0.6


def test_equal_texts_and_half_edits_at_sf(spark):
    rows = fp.fingerprint(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    near = sum(r["near_edited"] > r["near_next"] for r in rows)
    assert near >= 0.95 * len(rows)
