import math

import pytest
from pyspark.sql import functions as F

from tidegauge.functions.text import tokens
from tidegauge.operators import evaluate, sets, similarity, text

# Fixed example: n-gram lines (text, count) and the totals they give.
LINES = """it was the best of|1
age of wisdom it was|1
best of times it was|1
it was the age of|2
it was the worst of|1
of times it was the|2
of wisdom it was the|1
the age of wisdom it|1
the best of times it|1
the worst of times it|1
times it was the age|1
times it was the worst|1
was the age of wisdom|1
was the best of times|1
was the age of foolishness|1
was the worst of times|1
wisdom it was the age|1
worst of times it was|1"""
TOTALS = {"was": 17, "of": 17, "the": 17, "it": 16, "times": 10, "age": 8, "worst": 5, "wisdom": 5, "best": 4, "foolishness": 1}
NEIGHBOURS = {"was": 9, "of": 9, "the": 9, "it": 8, "age": 7, "times": 7, "best": 5, "worst": 5, "wisdom": 5, "foolishness": 4}
STRIPES = {"worst": ["times"], "best": ["times"], "foolishness": ["age"], "age": ["foolishness", "times", "wisdom"],
           "wisdom": ["age"], "times": ["age", "best", "worst"]}


@pytest.fixture(scope="module")
def grams(spark):
    rows = [(a, int(n)) for a, n in (x.split("|") for x in LINES.splitlines())]
    return spark.createDataFrame(rows, "ngram string, n long").cache()


def test_weighted_words(grams):
    assert {r.word: r.n for r in text.weighted_words(grams).collect()} == TOTALS


def test_neighbour_counts(grams):
    assert {r.word: r.n_neighbours for r in text.neighbour_counts(grams).collect()} == NEIGHBOURS


def test_stripes(grams):
    vocab = text.vocabulary(grams, 10, 10)
    got = {r.term: r.stripe for r in text.stripes(text.stripe_edges(grams, vocab)).collect()}
    assert got == STRIPES


def test_vocabulary_ranks_and_basis(grams):
    rows = text.vocabulary(grams, 4, 2, ["it", "was"]).orderBy("rank").collect()
    assert [(r.word, r.rank, r.in_basis) for r in rows] == [("of", 0, 0), ("the", 1, 0), ("times", 2, 1), ("age", 3, 1)]


def test_stripe_similarity_against_brute_force(spark, grams):
    wide = {k: set(v) for k, v in STRIPES.items()}
    df = spark.createDataFrame([(k, sorted(v)) for k, v in wide.items()], "term string, stripe array<string>")
    for block in (1, 2, 100):
        rows = similarity.stripe_similarity(df, 50, len(wide), block).filter("end = 'top'").collect()
        got = {(r.a, r.b): (r.shared, r.cosine, r.jaccard, r.overlap, r.dice) for r in rows}
        want = {}
        for a in wide:
            for b in wide:
                s = len(wide[a] & wide[b])
                if a < b and s:
                    x, y = len(wide[a]), len(wide[b])
                    want[a, b] = (s, round(s / math.sqrt(x * y), 9), round(s / (x + y - s), 9), round(s / min(x, y), 9), round(2 * s / (x + y), 9))
        assert got == want


def test_ngrams_of_whole_texts(spark):
    df = spark.createDataFrame([("a b c d e f",), ("A b-c, d e",), ("too short",), (None,), ("",)], "text string")
    assert {r.ngram: r.n for r in text.ngrams(df, "text").collect()} == {"a b c d e": 2, "b c d e f": 1}


def test_tokens(spark):
    df = spark.createDataFrame([("By-the-bye, what became of Alice's 12 hats?!",), ("É été",), ("...",)], "t string")
    got = [r[0] for r in df.select(tokens(F.col("t"))).collect()]
    assert got == [["by", "the", "bye", "what", "became", "of", "alice", "s", "hats"], ["t"], []]


def test_word_count(spark):
    df = spark.createDataFrame([("This is a small test file. This file is for a test.",), ("This small test file has two small lines.",), ("",)], "t string")
    got = {r.word: r.n for r in text.word_count(df, "t").collect()}
    assert got["this"] == 3 and got["small"] == 3 and got["a"] == 2 and len(got) == 10
    halves = [text.word_count(df.filter(c), "t") for c in ("t like 'This is%'", "t not like 'This is%'")]
    assert {r.word: r.n for r in text.merge_counts(halves).collect()} == got


TRAIN = [("d1", 1, "Chinese Beijing Chinese"), ("d2", 1, "Chinese Chinese Shanghai"), ("d3", 1, "Chinese Macao"), ("d4", 0, "Tokyo Japan Chinese")]
TEST = [("d5", 1, "Chinese Chinese Chinese Tokyo Japan"), ("d6", 1, "Beijing Shanghai Trade"), ("d7", 0, "Japan Macao Tokyo"), ("d8", 0, "Tokyo Japan Trade")]
SCORES = {"d5": (-8.90668134, -8.10769031, 1), "d6": (-5.78074351, -4.17950237, 1), "d7": (-6.59167373, -7.51170688, 0), "d8": (-4.39444915, -5.56579673, 0)}


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, cls int, body string")


def test_naive_bayes_plain(spark):
    m = {r.word: r for r in text.train_naive_bayes(frame(spark, TRAIN), "body", "cls", 0.0).collect()}
    assert (m["chinese"].n1, m["chinese"].n0) == (5, 1)
    assert m["chinese"].p1 == 5 / 8 and m["chinese"].p0 == pytest.approx(1 / 3)
    assert m["tokyo"].p1 == 0 and m["beijing"].p1 == 1 / 8 and m["beijing"].prior1 == 0.75


def test_naive_bayes_smoothed_scores(spark):
    model = text.train_naive_bayes(frame(spark, TRAIN), "body", "cls", 1.0)
    p = {r.word: (r.p0, r.p1) for r in model.collect()}
    assert p["chinese"] == (pytest.approx(0.222222222222), pytest.approx(0.428571428571))
    assert p["macao"] == (pytest.approx(0.111111111111), pytest.approx(0.142857142857))
    scored = text.score_naive_bayes(frame(spark, TEST), model, "id", "body", "cls")
    for r in scored.collect():
        s0, s1, c = SCORES[r.id]
        assert (r.score0, r.score1, r.predicted) == (pytest.approx(s0), pytest.approx(s1), c)
    report = evaluate.confusion(scored, "cls", F.col("predicted") == 1).first()
    assert (report.tp, report.tn, report.fp, report.fn) == (2, 2, 0, 0)


def test_naive_bayes_document_without_known_words(spark):
    model = text.train_naive_bayes(frame(spark, TRAIN), "body", "cls", 1.0)
    r = text.score_naive_bayes(frame(spark, [("x", 1, "nothing known")]), model, "id", "body", "cls").first()
    assert (r.score0, r.score1, r.predicted) == (pytest.approx(math.log(0.25)), pytest.approx(math.log(0.75)), 1)


def test_top_words_per_class(spark):
    model = text.train_naive_bayes(frame(spark, TRAIN), "body", "cls", 1.0)
    rows = text.top_words_per_class(model, 2).collect()
    assert {(r["class"], r.place): r.word for r in rows} == {(0, 1): "chinese", (0, 2): "japan", (1, 1): "chinese", (1, 2): "beijing"}


def test_overlap(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "word string") for xs in ("abcd", "cdx"))
    assert tuple(sets.overlap(a, b, "word").first()) == (4, 2, 50.0)


DOCS = [("docA", "bright blue butterfly forget"), ("docB", "best forget bright sky"), ("docC", "blue sky bright sun"),
        ("docD", "under butterfly sky hangs"), ("docE", "forget blue butterfly")]


def brute_pairs(docs, k):
    s = {d: set(t.split()) for d, t in docs}
    out = [(a, b, len(s[a] & s[b]) / len(s[a] | s[b])) for a in s for b in s if a < b and s[a] & s[b]]
    return sorted(out, key=lambda p: (-round(p[2], 12), p[0], p[1]))[:k]


def pairs(spark, docs, k):
    df = spark.createDataFrame(docs, f"id {'long' if isinstance(docs[0][0], int) else 'string'}, text string")
    rows = similarity.top_document_pairs(df, "id", "text", k).collect()
    return sorted([(r.a, r.b, r.jaccard) for r in rows], key=lambda p: (-round(p[2], 12), p[0], p[1]))


def same(got, want):
    assert [p[:2] for p in got] == [p[:2] for p in want]
    assert [p[2] for p in got] == pytest.approx([p[2] for p in want])


@pytest.mark.parametrize("k", [1, 3, 10])
def test_document_pairs(spark, k):
    same(pairs(spark, DOCS, k), brute_pairs(DOCS, k))


def test_document_pairs_with_copies_and_repeats(spark):
    import random
    rng = random.Random(5)
    words = ["w" + chr(97 + i) * 2 for i in range(26)]
    docs = [(i, " ".join(rng.sample(words, rng.randint(1, 9)))) for i in range(40)]
    docs += [(100 + i, docs[i][1] + " " + docs[i][1]) for i in range(0, 12, 3)] + [(200 + i, docs[0][1]) for i in range(5)]
    for k in (4, 25, 60):
        same(pairs(spark, docs, k), brute_pairs(docs, k))


def test_postings(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "")], "id int, t string")
    got = {(r.word, r.id): (r.n_words, r.doc_freq) for r in text.postings(df, "id", "t").collect()}
    assert got == {("a", 1): (2, 1), ("b", 1): (2, 2), ("b", 2): (2, 2), ("c", 2): (2, 1)}


@pytest.mark.parametrize("seed, k", [(1, 5), (2, 40), (3, 400)])
def test_set_pairs_over_several_batches(spark, seed, k):
    """Few alike, frequent words in all sets, sets of very different sizes."""
    import random
    rng = random.Random(seed)
    common, rare = ["common" + c for c in "abcde"], ["w" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(500)]
    docs = [(i, " ".join(rng.sample(common, rng.randint(1, 5)) + rng.sample(rare, rng.choice([0, 2, 10, 60])))) for i in range(60)]
    docs += [(100 + i, docs[i][1] + " extra" + chr(97 + i)) for i in range(6)]
    got = similarity.top_set_pairs(spark.createDataFrame(docs, "id long, text string"), "id", "text", k).collect()
    first = {}
    for d, t in docs:
        first.setdefault(frozenset(t.split()), d)
    same([(r.a, r.b, r.jaccard) for r in got], brute_pairs([(d, " ".join(s)) for s, d in first.items()], k))


def test_queue_ends_at_the_last_of_the_best(spark, monkeypatch):
    """Pairs that are alike fill the list from the first places; no other place is met."""
    import random
    rng = random.Random(4)
    base = [["d" + chr(97 + d // 26) + chr(97 + d % 26) + chr(97 + i) for i in range(20)] for d in range(100)]
    docs = [(d, " ".join(ws + ["everywhere"])) for d, ws in enumerate(base)] + [(1000 + d, " ".join(ws[1:] + ["everywhere"])) for d, ws in enumerate(base)]
    lows, new_pairs = [], similarity._new_pairs
    monkeypatch.setattr(similarity, "_new_pairs", lambda o, low, *rest: lows.append(low) or new_pairs(o, low, *rest))
    rng.shuffle(docs)
    got = similarity.top_set_pairs(spark.createDataFrame(docs, "id long, text string"), "id", "text", 50).collect()
    assert all(r.b == r.a + 1000 for r in got) and min(lows) > 0.85 * similarity.STEPS


def test_next_batch_keeps_to_the_work_allowed():
    work = {10: 5, 9: 5, 8: 50, 7: 1}
    assert similarity.next_batch(work, 11, 1, 20) == 9
    assert similarity.next_batch(work, 9, 1, 20) == 8
    assert similarity.next_batch(work, 9, 1, 10**6) == 1
    assert similarity.next_batch(work, 11, 10, 10**6) == 10
