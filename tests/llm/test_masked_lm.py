import random

import numpy as np
import pytest

from tidegauge.llm import masked_lm as M


def corpus():
    rng = random.Random(17)
    follow = {w: rng.sample([f"w{k}" for k in range(40)], 2) for w in [f"w{k}" for k in range(40)]}
    rows = []
    for i in range(150):
        word, words = f"w{rng.randint(0, 39)}", []
        for _ in range(60):
            words.append(word)
            word = rng.choice(follow[word])
        rows.append((i + 100, " ".join(words)))
    return rows


def test_classes_cover_the_corpus(spark, make, odd_rows):
    rows = [*odd_rows, *corpus(), (1, "rare1 rare2 RARE2")]
    from collections import Counter
    counts = Counter(w for r in rows for w in (r[1] or "").encode().lower().split())
    got = M.learn_classes(make(rows))
    assert sum(got.sizes) == pytest.approx(M.ENDINGS + max(M.HEAD, 0) + len(counts) - len(got.hashes))
    assert got.shares.sum() == pytest.approx(1)
    assert len(got.hashes) == min(M.HEAD, len(counts))


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(2)
    network = M.Network(rng.normal(0, 0.3, (M.PLACES, M.CLASSES + 1, M.HIDDEN)), rng.normal(0, 0.3, (M.HIDDEN + 1, M.CLASSES)))
    context, target = rng.integers(0, M.CLASSES + 1, (7, M.PLACES)), rng.integers(0, M.CLASSES, 7)

    def loss():
        return -network.forward(context, target, np.empty((7, M.CLASSES)))[2].mean()

    state = [np.zeros_like(x) for x in (network.vectors, network.output)]
    keep = [x.copy() for x in (network.vectors, network.output)]
    M.train(network, state, context, target)  # with an empty state a step is RATE times the sign of the gradient, the state its square
    for value, old in zip((network.vectors, network.output), keep):
        value[...] = old
    for value, seen, place in ((network.vectors, state[0], (1, context[3, 1], 5)), (network.output, state[1], (4, target[2])), (network.output, state[1], (M.HIDDEN, target[0]))):
        at = value[place]
        value[place] = at + 1e-5
        up = loss()
        value[place] = at - 1e-5
        down = loss()
        value[place] = at
        assert ((up - down) / 2e-5) ** 2 == pytest.approx(seen[place], rel=1e-3, abs=1e-12)


def test_scores_are_log_probabilities(spark, make, odd_rows):
    """Sums against one word at a time, and a context that says something makes its words likelier."""
    rows = [*odd_rows, *corpus()]
    docs = make(rows).repartition(3)
    classes = M.learn_classes(docs)
    network = M.learn_network(docs, classes)
    got = {r["doc_id"]: r for r in M.score(docs, classes, network).collect()}
    text = rows[20][1]
    data = np.frombuffer(text.encode(), np.uint8)
    hashes, _, starts, ends = M.word_hashes(data, np.array([0, len(data)]))
    number = classes.of(data, hashes, starts, ends)
    padded = [M.CLASSES] * M.SIDE + number.tolist() + [M.CLASSES] * M.SIDE
    total = 0.0
    for i, c in enumerate(number):
        around = padded[i : i + M.SIDE] + padded[i + M.SIDE + 1 : i + 2 * M.SIDE + 1]
        hidden = np.tanh(sum(network.vectors[p][k] for p, k in enumerate(around)).astype(float))
        logits = hidden @ network.output[:-1] + network.output[-1]
        total += logits[c] - np.log(np.exp(logits).sum()) - np.log(classes.sizes[c])
    assert got[rows[20][0]]["log_prob"] == pytest.approx(total, rel=1e-4)
    shuffled = make([(i + 10_000, " ".join(random.Random(i).sample(t.split(), 60))) for i, t in corpus()])
    mixed = [r["mean_log_prob"] for r in M.score(shuffled, classes, network).collect()]
    assert np.mean([got[i]["mean_log_prob"] for i, _ in corpus()]) > np.mean(mixed) + 0.2
    assert got[1]["n_words"] == 0 and got[1]["log_prob"] == 0 and got[2]["perplexity"] is None
    assert len(M.score(docs, classes, network).collect()) == len(rows)


def test_empty_table(spark, make):
    assert M.score_corpus(make([])).count() == 0
    assert [r["n_words"] for r in M.score_corpus(make([(1, None), (2, "")])).collect()] == [0, 0]


def test_rare_words_have_probabilities_of_their_own(spark, make):
    """Words outside the most frequent ones against the counts of the corpus, one at a time; a word never seen is the least likely."""
    common = [f"c{k}x" for k in range(M.HEAD)]
    rare = {f"r{k}zz": k for k in range(1, 9)}
    docs = make([(1, " ".join(common * 20)), (2, " ".join(w for w, n in rare.items() for _ in range(n))), (None, "c1x r8zz")])
    classes = M.learn_classes(docs)
    network = M.learn_network(docs, classes)
    asked = [(10, "r8zz"), (11, "r1zz"), (12, "neverzz"), (13, "c5x"), (14, "r8zz r1zz neverzz r8zz"), (None, "r2zz"), (15, "")]
    counts = M.stored(M.count_words(docs), "words")
    rows = M.score(make(asked).repartition(2), classes, network, counts).collect()
    got = {r["doc_id"]: r["log_prob"] for r in rows}
    assert len(rows) == len(asked) and got[15] == 0
    tokens = sum(rare.values()) + 1
    chance = {w: (n + (w == "r8zz") + M.MORE) / (tokens + M.MORE * (len(rare) + 1)) for w, n in rare.items()}
    never = M.MORE / (tokens + M.MORE * (len(rare) + 1))
    assert sum(chance.values()) + never == pytest.approx(1)
    assert got[10] - got[11] == pytest.approx(np.log(chance["r8zz"] / chance["r1zz"]))  # the same class in the same context
    assert got[11] - got[12] == pytest.approx(np.log(chance["r1zz"] / never))
    four = M.score(make([(1, "r8zz r8zz r8zz r8zz")]), classes, network, counts).first()["log_prob"]
    assert got[14] - four == pytest.approx(np.log(chance["r1zz"] * never / chance["r8zz"] ** 2))
    whole = {r["doc_id"]: r for r in M.score_corpus(docs).collect()}
    assert whole[2]["n_words"] == 36 and None in whole


def test_powers_are_as_exact_as_the_products():
    x = np.linspace(-57, 57, 200_001).astype(np.float32)[None, :]
    got = x.copy()
    M.powers(got, np.empty((2, *x.shape), np.float32))
    assert np.abs(got.astype(float) * float(M.SCALE) / np.exp2(x.astype(float)) - 1).max() < 3e-6


@pytest.mark.parametrize("weight", [0.3, 9.0])
def test_single_precision_steps_like_double(weight):
    """Powers of two and factors in place of exponentials and biases; large weights take the other way, without overflow."""
    rng = np.random.default_rng(5)
    exact = M.Network(rng.normal(0, weight, (M.PLACES, M.CLASSES + 1, M.HIDDEN)), rng.normal(0, weight, (M.HIDDEN + 1, M.CLASSES)))
    quick = M.Network(exact.vectors.astype(np.float32), exact.output.astype(np.float32))
    assert quick.ready()[2] == (weight < 1) and not exact.ready()[2]
    n = M.PART + 9
    context, target = rng.integers(0, M.CLASSES + 1, (n, M.PLACES)), rng.integers(0, M.CLASSES, n)
    logs = [a.forward(context, target, np.empty((n, M.CLASSES), a.output.dtype))[2] for a in (exact, quick)]
    assert logs[1] == pytest.approx(logs[0], rel=1e-4, abs=1e-4)
    states = [[np.zeros_like(x) for x in (a.vectors, a.output)] for a in (exact, quick)]
    for a, state in zip((exact, quick), states):
        M.train(a, state, context, target)  # the state is the square of the gradient
    for a, b in zip(*states):
        assert np.sqrt(b) == pytest.approx(np.sqrt(a), rel=2e-3, abs=1e-4 * np.sqrt(a.max()))


def test_rows_add_up_by_place():
    rng = np.random.default_rng(6)
    for kind in (np.float32, np.float64):
        places, rows = rng.integers(0, 40, (700, 4)) + np.arange(4) * 40, rng.normal(0, 1, (700, M.HIDDEN)).astype(kind)
        want = np.zeros((160, M.HIDDEN))
        for p in range(4):
            np.add.at(want, places[:, p], rows)
        got = M.add_rows(places, rows, 160)
        assert got.dtype == kind and got == pytest.approx(want, abs=1e-4)


def test_head_words_that_share_a_slot():
    top = np.uint64(7) << np.uint64(48)
    hashes = np.array([3, top + np.uint64(1), top + np.uint64(9), top * np.uint64(2)], np.uint64)
    classes = M.Classes(hashes, np.array([2, 0, 3, 1]), *[np.ones(M.CLASSES)] * 3)
    data = np.frombuffer(b"ab", np.uint8)
    asked = np.append(hashes, [np.uint64(0), top, top + np.uint64(2), ~np.uint64(0)])
    got = classes.of(data, asked, np.zeros(8, int), np.full(8, 2))
    assert got.tolist() == [2, 0, 3, 1] + [M.HEAD + (ord("b") * 31 + ord("a")) % M.ENDINGS] * 4


def test_word_hashes_byte_by_byte():
    """Short and long words, empty texts, words at the edges of texts, against one byte after the other."""
    from tidegauge.llm import common as C
    rng = random.Random(8)
    texts = [b"", b"a", b" B ", b"x" * 15, b"x" * 16, b"x" * 17 + b" y", b"Long" * 900, b"\n\t", "d'\u00e9t\u00e9 a-b".encode(), *[bytes(rng.choice(b"abC \n.\xc3\xa9") for _ in range(80)) for _ in range(30)]]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    for letters in (False, True):
        table = (C._BYTE_LETTERS if letters else C._BYTE_LOWER).tolist()
        want = []
        for t in texts:
            parts = (bytes(32 if letters and C._MARKS[c] else c for c in t)).split()
            want.append([sum(table[c] * pow(int(C._BASE), k, 1 << 64) for k, c in enumerate(w)) % (1 << 64) for w in parts])
        hashes, first, starts, ends = C.word_hashes(np.frombuffer(b"".join(texts), np.uint8), offsets, letters)
        assert hashes.tolist() == C.mix(np.array([h for w in want for h in w], np.uint64)).tolist()
        assert np.diff(first).tolist() == [len(w) for w in want] and len(starts) == len(ends) == len(hashes)


def test_distinct_hashes_keep_their_endings():
    rng = np.random.default_rng(9)
    for near in (False, True):  # with hashes that differ in the last bits only
        known = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        known = np.append(known, known[:9] ^ np.uint64(5)) if near else known
        ending = rng.integers(0, M.ENDINGS, len(known))
        at = rng.integers(0, len(known), 4000)
        got = M.distinct(known[at], ending[at])
        want, first, n = np.unique(known[at], return_index=True, return_counts=True)
        assert got[0].tolist() == want.tolist() and got[1].tolist() == ending[at][first].tolist() and got[2].tolist() == n.tolist()
    assert [len(x) for x in M.distinct(np.zeros(0, np.uint64), np.zeros(0, np.int64))] == [0, 0, 0]
