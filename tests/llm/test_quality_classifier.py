import random
import zlib

import numpy as np
import pytest

from tidegauge.llm import quality_classifier as Q


def features(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    return Q.features(np.frombuffer(b"".join(raw), np.uint8), offsets, np.array([np.nan] * len(texts)))


def test_identity_equals_all_pairs():
    rng = np.random.default_rng(1)
    machine = Q.Machine(0.3, rng.normal(size=Q.BUCKETS + Q.STATS), rng.normal(size=(Q.BUCKETS + Q.STATS, 3)))
    bounds, at, values = features(["Some words and some more", "", "A!! B%% 12\nc c c c"])
    got = machine.margin(bounds, at, values)
    for i in range(3):
        a, x = at[bounds[i] : bounds[i + 1]], values[bounds[i] : bounds[i + 1]]
        want = 0.3 + sum(machine.linear[p] * q for p, q in zip(a, x))
        want += sum(machine.factors[a[j]] @ machine.factors[a[k]] * x[j] * x[k] for j in range(len(a)) for k in range(j))
        assert got[i] == pytest.approx(want)


def test_features_do_not_depend_on_the_slice():
    texts = ["Tide gauge, tide.", "", "   ", "ÉÉ #1\nx x", "last"]
    bounds, at, values = features(texts)
    for i, t in enumerate(texts):
        b, a, v = features([t])
        assert (at[bounds[i] : bounds[i + 1]] == a).all() and np.allclose(values[bounds[i] : bounds[i + 1]], v)


def corpus(n=360):
    rng = random.Random(13)
    docs, labels = [], []
    for i in range(100, 100 + n):
        good = i % 3 != 0
        words = ["".join(rng.choices("abcdefg", k=5)) for _ in range(30)]
        text = " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)
        docs.append((i, text, "en", "a", len(text)))
        labels.append((i, int(good) if zlib.crc32(str(i).encode()) % 3 != 1 else int(not good), 0))
    return docs, labels


def test_learns_and_leaves_out_the_held_out(spark, make, odd_rows):
    docs, labels = corpus()
    table = spark.createDataFrame([*labels, (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    got = Q.score_held_out(make([*docs, *odd_rows]), table).collect()
    assert len(got) == len(docs) + len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert sum(by_id[i]["predicted"] == int(i % 3 != 0) for i, *_ in docs) >= 0.98 * len(docs)
    assert all(by_id[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in docs)
    table_in = make([*docs, *odd_rows]).repartition(3)
    kept = Q.keep_good(table_in, table)
    assert kept.columns == table_in.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(r["doc_id"] or 0 for r in got if r["score"] >= 0.5)


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.score_held_out(make([]), none).count() == 0 and Q.keep_good(make([]), none).count() == 0
    assert {r["score"] for r in Q.score_held_out(make([(1, "x"), (2, None)]).drop("n_chars"), none).collect()} == {0.5}


def test_rows_with_one_id_count_once_in_the_sample(spark):
    from tidegauge.llm.common import labelled_sample

    docs = spark.createDataFrame([(1 + i % 2 * (i // 500), f"text {i}") for i in range(2000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(1, 40)], "doc_id long, quality long")
    for bound in (1, 3, 100):
        rows = labelled_sample(docs, labels, "quality", 3, 1, bound).collect()
        assert len(rows) == len({r["doc_id"] for r in rows}) <= bound
    again = labelled_sample(docs.repartition(5), labels, "quality", 3, 1, 100).collect()
    assert sorted(rows) == sorted(again)
