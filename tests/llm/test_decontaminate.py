import random

import numpy as np

from tidegauge.llm import decontaminate as D

from .words import sentence


def test_common_length_is_the_longest_common_subsequence():
    rng = random.Random(14)
    for _ in range(60):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert D.common_length(np.array(a, np.uint64), np.array(b, np.uint64)) == best[-1][-1]


def test_answer_is_what_follows_the_question():
    assert (D.item_of(1, "Where is it? On the hill").answer == D.words_of("on the hill")).all()
    assert (D.item_of(1, "Q: what Answer: Two pipes").answer == D.words_of("two pipes")).all()
    assert len(D.item_of(1, " ".join("abcdefghijklm")).answer) == 8


def plant(rng, item, changes):
    words = item.split()
    for at in rng.sample(range(len(words)), changes):
        words[at] = "zz%d" % rng.randint(0, 999)
    return " ".join(words)


def make_case():
    rng = random.Random(15)
    items = [(i, sentence(rng, rng.randint(9, 70))) for i in range(40)]
    docs, want = [], set()
    for d in range(200):
        text = sentence(rng, rng.randint(5, 400))
        if d % 4 == 0:
            for i in rng.sample(range(40), 2):
                planted = plant(rng, items[i][1], 0 if d % 8 else len(items[i][1].split()) // 6)
                text += " " + (planted.upper() if d % 3 else planted) + " " + sentence(rng, rng.randint(0, 60))
                want.add((d, i))
        docs.append((d, text))
    return items, docs, want


def test_finds_what_is_planted_and_nothing_else(spark, make, odd_rows):
    items, docs, want = make_case()
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, "the"), (None, "null id item with enough words to be found in it"), items[0]], "item_id long, text string")
    odd = [(None if r[0] is None else r[0] + 1000, *r[1:]) for r in odd_rows]
    table = make([*docs, *odd, docs[0]])
    rows = D.find(table, bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert got == want
    assert len(rows) == len(want) + sum(d == docs[0][0] for d, _ in want)
    in_slices = D.find(table, bench, slice_words=300)
    assert {(r["doc_id"], r["item_id"]) for r in in_slices.collect()} == want
    clean = D.keep_clean(table, bench)
    assert clean.columns == table.columns
    bad = {d for d, _ in want}
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(r[0]) for r in [*docs, *odd, docs[0]] if r[0] not in bad)


def test_paraphrase_needs_the_answer(spark, make):
    rng = random.Random(16)
    question, answer = sentence(rng, 20), sentence(rng, 6)
    item = f"{question}? {answer}"
    loose = plant(rng, question, 8)
    docs = [(1, f"{sentence(rng, 50)} {loose} {answer} {sentence(rng, 50)}"), (2, f"{sentence(rng, 50)} {loose} {sentence(rng, 56)}")]
    docs += [(i, sentence(rng, 100)) for i in range(3, 40)]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in D.find(make(docs), bench).collect()] == [(1, 7)]


def test_empty_tables(spark, make):
    bench = spark.createDataFrame([(1, sentence(random.Random(1), 20))], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find(make([]), bench).count() == 0 and D.find(make([(1, "x")]), none).count() == 0
    assert D.keep_clean(make([]), bench).count() == 0 and D.keep_clean(make([(1, None)]), none).count() == 1


def test_passage_in_a_third_of_all_documents(spark, make):
    """A leaked passage lifts the document frequency of its own words; it must not lose its weight by that."""
    rng = random.Random(18)
    items = [(i, sentence(rng, 24)) for i in range(12)]
    docs = []
    for d in range(240):
        head, tail = sentence(rng, rng.randint(20, 60)), sentence(rng, rng.randint(20, 60))
        docs.append((d, f"{head} {items[d % 4 // 3][1]} {tail}" if d % 3 == 0 else f"{head} {tail}"))
    want = {(d, d % 4 // 3) for d in range(0, 240, 3)}
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.find(make(docs), bench).collect()}
    # the same by the subsequence check alone
    brute = {(d, i) for d, t in docs for i, x in items if D.common_length(D.words_of(x), D.words_of(t)) >= 0.8 * len(x.split())}
    assert brute == want and got == want
    assert D.keep_clean(make(docs), bench).count() == 160


def test_words_in_most_documents_have_a_weight(spark, make):
    rng = random.Random(19)
    common = sentence(rng, 60).split()
    item = " ".join(rng.sample(common, 40))
    docs = [(d, " ".join(rng.sample(common, 60))) for d in range(60)] + [(100, item)]
    got = D.find(make(docs), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [r["doc_id"] for r in got] == [100]


def test_distinct_counts():
    rng = np.random.default_rng(3)
    for n in (1, 40, 3000, 100_000):
        hashes = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        row = np.zeros((1, D.REGISTERS), np.uint8)
        hashes = D.mix(hashes)
        np.maximum.at(row[0], (hashes % D.REGISTERS).astype(int), (53 - np.frexp((hashes >> np.uint64(12)).astype(float))[1]).astype(np.uint8))
        assert abs(D.distinct(row)[0] / n - 1) < 0.25
