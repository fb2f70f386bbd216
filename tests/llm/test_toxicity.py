import random
import zlib

import pytest

from tidegauge.llm import toxicity as X


@pytest.mark.parametrize("text, want", [("You IDIOT!", "you idiot"), ("1d10t", "idiot"), ("іdіоt", "idiot"), ("ｉｄｉｏｔ", "idiot"), ("id\u200bi\u00adot", "idiot"), ("p@thet1c $cum", "pathetic scum"),
                                        ("word$$$ x!!", "word x"), ("L0SER", "ioser"), ("", ""), ("naïve", "naive")])
def test_fold(text, want):
    assert X.fold(text).split() == want.split()


@pytest.mark.parametrize("words", ["각 간 가 감", "हिन्दी हन्दा हद", "กา กี กู ก", "كَتَب كُتُب كتب", "क़लम कलम"])
def test_other_scripts_keep_their_words_apart(words):
    import unicodedata

    folded = X.fold(words).split()
    assert len(folded) == len(set(folded)) == len(words.split())
    assert X.fold(unicodedata.normalize("NFD", words)) == X.fold(words)


def test_ligatures_and_empty_marks():
    assert X.fold("ﬁlth \u2764\ufe0f straße").split() == X.fold("filth straße").split()


def test_matches_whole_words_and_spares_phrases():
    lexicon = X.Lexicon({"idiot": 5.0, "ciown": 4.0}, ["ciown fish"])
    found = lexicon.automaton()

    def brute(text):
        words = X.fold(text).split()
        return [w for i, w in enumerate(words) if w in lexicon.words and not any(" ".join(words[k : k + 2]) in lexicon.exceptions for k in (i - 1, i) if k >= 0)]

    for text in ["an idiot and idiot, 1D1OT", "clown fish", "clown fish clown", "idiots clownfish", "idiot clown", "", "idiot"]:
        hits = brute(text)
        rate, n = X.rate(X.fold(text), found)
        assert n == len(hits)
        assert rate == pytest.approx(100 * sum(lexicon.words[w] for w in hits) / max(1, len(text.split())))


def corpus(n=400):
    rng = random.Random(12)
    docs, labels = [], []
    for i in range(100, 100 + n):
        words = [rng.choice("sea tide gauge level wave storm clown fish harbour".split()) for _ in range(40)]
        words = [w for k, w in enumerate(words) if w != "clown" or words[k + 1 : k + 2] == ["fish"]]
        toxic = i % 4 == 0
        if toxic:
            words[5:5] = [rng.choice(["moron", "M0R0N", "scum", "$cum"]), "and", "clown"]
        docs.append((i, " ".join(words), "en", "a"))
        labels.append((i, 1, int(toxic) if zlib.crc32(str(i).encode()) % 5 else 1 - int(toxic)))  # wrong labels in the held-out fold
    return docs, labels


def test_held_out_labels_are_not_used(spark, make, odd_rows):
    docs, labels = corpus()
    table = spark.createDataFrame([*labels, (None, 1, 1), (7, None, None), (101, 1, 0)], "doc_id long, quality int, toxic int")
    got = X.score_held_out(make([*docs, *odd_rows]), table).collect()
    assert len(got) == len(docs) + len(odd_rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, _, _, _ in docs:
        assert by_id[i]["predicted"] == int(i % 4 == 0)
        assert by_id[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert all(0 <= r["score"] <= 1 for r in got) and by_id[1]["predicted"] == by_id[2]["predicted"] == 0


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert X.score_held_out(make([]), none).count() == 0
    assert [round(r["score"], 6) for r in X.score_held_out(make([(1, "text"), (2, None)]), none).collect()] == [0.25, 0.25]
