"""The registered queries on the smallest test tables against plain Python."""

import zlib

import public_tokenizers
import pytest
from check_queries import compare, connect
from tokenizers import Tokenizer

from tidegauge.llm.queries import QUERIES, SQL

from .test_near_dup import brute as near_groups
from .test_packing import check as check_packing
from .test_quality_rules import brute as base_counts
from .test_url_filter import brute as rule_of

FOLDER = "/root/testdata/sf0.001"


def held(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: QUERIES[name](spark, FOLDER).collect()


def test_language_id(run, docs):
    got = {r["doc_id"]: r for r in run("op1_language_id")}
    assert set(got) == {d[0] for d in docs} and all(got[d[0]]["held_out"] == held(d[0], 4, 2) for d in docs)
    out = [d for d in docs if held(d[0], 4, 2)]
    assert sum(got[d[0]]["lang_pred"] == d[2] for d in out) >= 0.95 * len(out)


def test_quality_rules(run, docs):
    got = {r["doc_id"]: r for r in run("op2_quality_rules")}
    for d in docs:
        r = got[d[0]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base_counts(d[1])
        assert not (r["kept"] and r["base_failed"])


def test_near_duplicates(run, docs):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in run("op3_near_duplicates")), key=str)
    assert got == near_groups(docs, 2)


def test_masked_lm(run, docs):
    got = {r["doc_id"]: r for r in run("op4_masked_lm")}
    assert {k: r["n_words"] for k, r in got.items()} == {d[0]: len(d[1].encode().split()) for d in docs}
    assert all(r["log_prob"] < 0 or r["n_words"] == 0 for r in got.values())


def test_url_filter(spark, run):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = run("op5_url_filter")
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, allow = rule_of(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == ("allow" if (allow if rule else r["block_score"] < 0.5) else "block")


def test_decontamination(spark, run, docs):
    """Recall against all runs of five words shared by a document and an item."""
    items = {r["item_id"]: r["text"].lower().split() for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    want = set()
    for d in docs:
        words = d[1].lower().split()
        runs = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        want |= {(d[0], k) for k, w in items.items() if sum(tuple(w[i : i + 5]) in runs for i in range(len(w) - 4)) >= 0.7 * (len(w) - 4)}
    got = {(r["doc_id"], r["item_id"]) for r in run("op6_decontamination")}
    assert got == want and want


def test_token_counts(run, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d[0]: (len(d[1].encode()), len(library.encode(d[1], add_special_tokens=False).ids)) for d in docs}
    got = run("op7_token_counts")
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in got} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)


@pytest.mark.parametrize("name, label, folds, fold, least", [("op8_toxicity", "toxic", 5, 0, 0.85), ("op9_quality_classifier", "quality", 3, 1, 0.9)])
def test_classifiers(spark, run, docs, name, label, folds, fold, least):
    got = {r["doc_id"]: r for r in run(name)}
    assert set(got) == {d[0] for d in docs} and all(r["held_out"] == held(k, folds, fold) and r["predicted"] == int(r["score"] >= 0.5) for k, r in got.items())
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect() if r["doc_id"] in got and held(r["doc_id"], folds, fold)}
    assert sum(got[k]["predicted"] == v for k, v in labels.items()) >= least * len(labels)


def test_packing(run, docs):
    rows = run("op10_packing")
    check_packing(docs, rows)
    assert sum(r["length"] for r in rows) >= 0.97 * 2048 * len({r["sequence_id"] for r in rows})


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    problem, n, types = compare(spark, connect(FOLDER), name, FOLDER)
    assert problem is None and types == "" and n > 0
