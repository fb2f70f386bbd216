import gc
import os
import random
import time
from collections import Counter

import pyarrow as pa
import pytest

from tidegauge import session
from tidegauge.operators import blocks, similarity, text
from tidegauge.plans import words
from tidegauge.plans.registry import Tables


def texts(seed, n, size, vocabulary):
    """Texts of words of which some are frequent."""
    rng = random.Random(seed)
    known = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 8))) for _ in range(vocabulary)]
    return [" ".join(known[int(vocabulary * rng.random() ** 3)] for _ in range(size(rng))) for _ in range(n)]


def brute_lines(rows, size):
    return Counter(" ".join(w[i : i + size]) for w in (t.split() for t in rows) for i in range(len(w) - size + 1))


def brute_pairs(lines):
    return {(a, b) for x in lines for a in x.split(" ") for b in x.split(" ") if a < b}


def met(made):
    """The blocks of all chunks, as the task of all buckets gets them."""
    return pa.Table.from_batches(made).sort_by("bucket").combine_chunks().to_batches(max_chunksize=3)


@pytest.mark.parametrize("size, chunk", [(5, 7), (5, 10_000), (2, 50), (1, 50)])
def test_lines_and_pairs_over_chunks_against_brute_force(monkeypatch, size, chunk):
    monkeypatch.setattr(blocks, "CHUNK", chunk)
    monkeypatch.setattr(blocks, "PAIRS", 100)
    rows = texts(1, 40, lambda rng: rng.randint(0, 30), 60) + ["a a a a a a a a", "a a a a a b", "same line in many texts here", "x", ""] + ["same line in many texts here"] * 9
    lists = pa.array([t.split() for t in rows] + [None], pa.list_(pa.string()))
    batches = [pa.RecordBatch.from_arrays([lists.slice(i, 11)], ["_w"]) for i in range(0, len(lists), 11)]
    lines = [*blocks._lines(size)(met([*blocks._runs(size)(16)(batches)]))]
    got = [(r["ngram"], r["n"]) for b in lines for r in b.to_pylist()]
    assert len(got) == len({x for x, _ in got}) and dict(got) == brute_lines(rows, size)
    if size > 1:
        pairs = [(r["a"], r["b"]) for b in blocks._distinct(met([*blocks._pairs_of(16)(b.select(["ngram"]) for b in lines)])) for r in b.to_pylist()]
        assert len(pairs) == len({frozenset(p) for p in pairs}) and {tuple(sorted(p)) for p in pairs} == brute_pairs(brute_lines(rows, size))


def test_equal_keys_are_ordered_by_the_words(monkeypatch):
    """Two words with one hash have one order whatever order they come in."""
    monkeypatch.setattr(blocks, "_hashes", lambda words: blocks.np.zeros(len(words), blocks.np.uint64))
    for given in (["bb", "aa", "c"], ["aa", "c", "bb"]):
        rank, known, _ = blocks._ranked(pa.array(given))
        assert known.to_pylist() == ["c", "aa", "bb"] and [known[int(r)].as_py() for r in rank] == given


def written(df):
    """Bytes that the shuffles of ``df`` write."""
    df.collect()

    def walk(node):
        kind = node.getClass().getSimpleName()
        inner = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else []
        if kind != "ReusedExchangeExec":
            inner += [node.children().apply(i) for i in range(node.children().size())]
        own = node.metrics().get("shuffleBytesWritten")
        return (own.get().value() if kind == "ShuffleExchangeExec" and own.isDefined() else 0) + sum(map(walk, inner if kind != "ReusedExchangeExec" else []))

    return walk(df._jdf.queryExecution().executedPlan())


def kept(spark):
    """Bytes in the checkpoint folder."""
    top = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(top) for f in names)


def test_neighbours_write_less_than_four_times_the_text(spark):
    rows = texts(2, 300, lambda rng: 400, 3000)
    df = spark.createDataFrame([(t,) for t in rows], "text string").repartition(4).cache()
    df.count()
    counts = text.neighbour_counts(text.ngrams(df, "text"))
    assert written(counts) < 4 * sum(map(len, rows))
    want = Counter(w for p in brute_pairs(brute_lines(rows, 5)) for w in p)
    assert {r.word: r.n_neighbours for r in counts.collect()} == want


def test_ranking_overlap_writes_no_table_of_ngrams(spark, tmp_path):
    rows = texts(3, 300, lambda rng: 300, 2500)
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(rows)], "doc_id long, text string, lang string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")

    before = kept(spark)
    df = words.x15_ranking_overlap(Tables(spark, str(tmp_path)))
    size = written(df)
    assert kept(spark) <= before and size < 4 * sum(map(len, rows))
    lines = brute_lines(rows, 5)
    nbrs, freq = Counter(w for p in brute_pairs(lines) for w in p), Counter()
    for line, n in lines.items():
        for w in line.split():
            freq[w] += n
    a, b = ({w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:1000]} for c in (nbrs, freq))
    assert tuple(df.first()) == (1000, len(a & b), round(100 * len(a & b) / 1000, 6))


@pytest.mark.parametrize("search", [similarity.top_set_pairs, similarity.top_document_pairs])
def test_pairs_keep_no_copies_of_the_sets(spark, search):
    """What stays in the checkpoint folder is the words with their numbers and the best pairs."""
    rows = texts(4, 400, lambda rng: 300, 2000)
    df = spark.createDataFrame([*enumerate(rows)], "id long, text string").repartition(4)
    gc.collect()
    before = kept(spark)
    got = search(df, "id", "text", 20)
    assert kept(spark) - before < sum(map(len, rows)) / 2
    sets = [set(t.split()) for t in rows]
    want = sorted((-round(len(x & y) / len(x | y), 12), a, b) for a, x in enumerate(sets) for b, y in enumerate(sets) if a < b and x != y)[:20]
    assert sorted((-round(r.jaccard, 12), r.a, r.b) for r in got.collect()) == want


def test_compact_copies_go_with_their_shuffles(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    gc.collect()
    blocks_before, before = disk.getAllBlocks().size(), kept(spark)
    with session.compact(spark.range(100_000, numPartitions=4).repartition(8)) as copy:
        until = time.time() + 20
        while disk.getAllBlocks().size() > blocks_before and time.time() < until:
            time.sleep(0.1)
        assert disk.getAllBlocks().size() <= blocks_before and kept(spark) > before
        assert copy.count() == 100_000
    assert kept(spark) <= before and spark.conf.get(session.SHUFFLES_GO) == "false"
