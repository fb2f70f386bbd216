import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidegauge.llm import near_dup as N
from tidegauge.llm.components import components


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) or frozenset([tuple(words)])


def brute(rows, size):
    """(n_shingles, smallest reachable id) of each row, comparing all pairs."""
    sets = [shingles(t, size) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, *_) in enumerate(rows):
        groups[find(i)].append(d)
    lowest = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((d, len(sets[i]), lowest[find(i)]) for i, (d, *_) in enumerate(rows)), key=str)


def variants(rng, base, n, changes):
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(len(words)), changes):
            words[at] = "w%d" % rng.randint(0, 10**6)
        out.append(" ".join(words))
    return out


def corpus(rng):
    texts = []
    for size, n, changes in ((60, 25, 3), (200, 30, 9), (12, 10, 1), (400, 12, 24), (100, 40, 5)):
        base = ["v%d" % rng.randint(0, 10**6) for _ in range(size)]
        texts += variants(rng, base, n, changes)
    chain = ["c%d" % i for i in range(120)]
    for k in range(20):  # each links to its neighbours only
        texts.append(" ".join(chain[k * 4 : k * 4 + 60]))
    texts += [" ".join("u%d" % rng.randint(0, 10**6) for _ in range(rng.randint(1, 80))) for _ in range(60)]
    return [(i + 100, t) for i, t in enumerate(texts)]


def test_matches_brute_force(spark, make, odd_rows):
    rng = random.Random(9)
    rows = [*odd_rows, *corpus(rng)]
    for size in (2, 5):
        got = N.near_duplicates(make(rows).repartition(3), size).collect()
        assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows, size)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_links_off_the_pivots_are_found(spark, make, monkeypatch):
    """With one pivot most pairs of a loose group never meet in the first step."""
    monkeypatch.setattr(N, "PIVOTS", 1)
    monkeypatch.setattr(N, "BLOCK", 1200)
    monkeypatch.setattr(N, "CHUNK", 2400)
    rng = random.Random(10)
    base = ["v%d" % i for i in range(300)]
    rows = list(enumerate(variants(rng, base, 60, 17)))
    got = N.near_duplicates(make(rows), 2).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows, 2)


def test_one_row_of_each_group_stays(spark, make, odd_rows):
    docs = make(odd_rows)
    out = N.keep_one(docs)
    ids = [r["doc_id"] for r in out.collect()]
    assert out.columns == docs.columns and sorted(x for x in ids if x) == [1, 2, 3, 4, 5, 6, 8, 9, 10]
    assert N.near_duplicates(make([])).count() == 0 and N.keep_one(make([])).count() == 0
    alone = N.near_duplicates(make([(1, None), (2, ""), (3, " ")])).collect()
    assert all(r["kept"] and r["component_id"] == r["doc_id"] and r["n_shingles"] == 0 for r in alone)


def test_signature_share_estimates_similarity():
    data = " ".join("w%d" % i for i in range(400)).encode()
    other = " ".join("w%d" % i for i in range(40, 440)).encode()
    joined = np.frombuffer(data + other, np.uint8)
    runs, bounds = N.shingle_sets(joined, np.array([0, len(data), len(data) + len(other)]), 1)
    low = N.minima(runs, bounds)
    assert abs((low[0] == low[1]).mean() - 360 / 440) < 0.13


def test_components(spark):
    rng = random.Random(11)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(50)] + [(400, 401), (401, 400), (500, 500)] + [(rng.randint(1000, 1030), rng.randint(1000, 1030)) for _ in range(25)]
    root = {x: x for p in links for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if (root[a], root[b]) != (low, low):
                root[a] = root[b] = low
                changed = True
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: v for k, v in root.items() if any(k in p and p[0] != p[1] for p in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_of_very_long_texts_off_the_pivots_are_found(spark):
    """Minima of large sets are small numbers, equal in their first bits by chance: the first common bucket must be a real one."""
    rng = random.Random(21)
    texts = []
    for k in range(14):
        base = [f"p{k}w{i}" for i in range(60_000)]
        texts += [" ".join(base[:54_300]), " ".join(base[5_700:])]  # similar by 0.81
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    marks = N.stored(N.digest(docs, 2), "digest")
    classes = N.stored(marks.withColumn("cid", F.col("doc_id") + 10), "classes")
    every = classes.select(F.explode(F.arrays_zip(F.col("bands").alias("bucket"), F.sequence(F.lit(0), F.lit(N.BANDS - 1)).alias("band"))).alias("b"), "cid", "n_shingles").select("b.*", "cid", "n_shingles")
    # a third member in each bucket, the smallest, with another component and too small to be similar
    other = spark.createDataFrame([(-1, 1, classes.first()["sig"], [0] * N.BANDS, "x y")], "cid long, n_shingles long, sig binary, bands array<long>, text string")
    pivot = every.select("bucket", "band").distinct().select("bucket", F.col("band").cast("int").alias("band"), F.lit(-1).cast("long").alias("cid"), F.lit(1).cast("long").alias("n_shingles"))
    members = every.select("bucket", F.col("band").cast("int").alias("band"), "cid", "n_shingles").union(pivot)
    classes = classes.select("cid", "n_shingles", "sig", "bands").union(other.select("cid", "n_shingles", "sig", "bands"))
    all_texts = docs.select((F.col("doc_id") + 10).alias("cid"), "text").union(other.select("cid", "text"))
    roots = spark.createDataFrame([], "node long, root long")
    got = {tuple(sorted((r["a"], r["b"]))) for r in N._across(members, classes, all_texts, roots, 2, 80).collect()}
    assert got == {(2 * k + 10, 2 * k + 11) for k in range(14)}


def test_rows_without_an_id_stay(spark, make):
    """One row of each group, whatever ids its rows have."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    one, two, three, four = (" ".join(f"{w}{k}" for w in words) for k in range(4))
    rows = [(None, one), (None, two), (None, two), (5, three), (None, three), (6, four), (6, "another text under the same id"), (None, None), (None, ""), (7, ""), (7, "")]
    got = [(r["doc_id"], r["text"]) for r in N.keep_one(make(rows).repartition(3)).collect()]
    want = [(None, one), (None, two), (5, three), (6, four), (6, "another text under the same id"), (None, None), (None, ""), (7, "")]
    assert sorted(got, key=str) == sorted(want, key=str)
