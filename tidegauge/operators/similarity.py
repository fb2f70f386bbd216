"""Exact set similarity: best document pairs and all four scores on bounded stripes."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..session import compact, cut_lineage
from .ranking import global_rank
from .skew import attach
from .text import rows_of

#: Steps of the bound that the queue of prefixes is ordered by.
STEPS = 512
#: Steps of the queue whose work is counted at a time.
RANGE = 128
#: How much more work, in possible pairs, each batch of the queue may bring than the one before.
GROWTH = 8


def _ordered_sets(sets: DataFrame) -> DataFrame:
    """Words of every set as numbers, rarest first (ties by word): (rep, words, n).

    The rows go back to their sets one by one: lists of a task would be short where tasks are many.
    """
    rows = rows_of(sets, F.col("words"), "word", ["rep"])
    freq = rows.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    numbers = global_rank(freq, [F.asc("df"), F.asc("word")], "no").select("word", "no")
    numbered = attach(rows, numbers, ["word"]).select("rep", "no").repartition("rep")
    return numbered.groupBy("rep").agg(F.sort_array(F.collect_list("no")).alias("words")).withColumn("n", F.size("words"))


def _events(ordered: DataFrame, low: int) -> DataFrame:
    """One row per set and place: the word there, and the step of the bound that holds from this place on, if ``low`` or more.

    If the first word that two sets share is at place p of a set of n words, their Jaccard is at most (n - p) / n.
    """
    places = F.ceil(F.col("n") * F.lit((STEPS - low + 1) / STEPS)).cast("int")
    rows = ordered.select("rep", "n", F.posexplode(F.slice("words", F.lit(1), places)).alias("at", "word"))
    return rows.withColumn("step", F.ceil((F.col("n") - F.col("at")) / F.col("n") * STEPS).cast("int")).filter(F.col("step") >= low)


def _work(ordered: DataFrame, low: int) -> dict[int, int]:
    """How many pairs of places with the same word each step from ``low`` on adds to the higher ones."""
    by_word = _events(ordered, low).groupBy("word", "step").agg(F.count(F.lit(1)).alias("c"))
    above = F.sum("c").over(W.partitionBy("word").orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, -1))
    pairs = by_word.withColumn("more", F.col("c") * (F.col("c") - 1) / 2 + F.col("c") * F.coalesce(above, F.lit(0)))
    return {r["step"]: int(r["more"]) for r in pairs.groupBy("step").agg(F.sum("more").alias("more")).collect()}  # STEPS rows


def next_batch(work: dict[int, int], high: int, end: int, allowed: int) -> int:
    """The step down to which the queue is worked off: at least one step, then to ``end`` while the work is allowed."""
    low = high - 1
    done = work.get(low, 0)
    while low > end and done + work.get(low - 1, 0) <= allowed:
        low -= 1
        done += work.get(low, 0)
    return low


def _new_pairs(ordered: DataFrame, low: int, high: int, least: float, k: int) -> DataFrame:
    """The best ``k`` pairs of sets whose first shared word has the lower of its two steps in [low, high).

    Pairs below ``least`` are ruled out twice before any words are fetched: each shared place bounds what is still to come, and the
    number of shared words so far with the place of the last one bounds the whole. Candidates carry numbers
    only, and a frequent word is split by adaptive execution; the scores go straight into a bounded top-k.
    """
    live = _events(ordered, low).filter((F.col("n") - F.col("at")) / F.col("n") >= least - 1e-9)
    a, b = (live.select("word", *[F.col(c).alias(c + side) for c in ("rep", "n", "at", "step")]) for side in ("_a", "_b"))
    total = F.col("n_a") + F.col("n_b")

    def possible(shared: Column) -> Column:
        return shared >= F.lit(least) * (total - shared) - 1e-9

    to_come = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    met = a.join(b, "word").filter((F.col("rep_a") < F.col("rep_b")) & possible(to_come))
    pairs = met.groupBy("rep_a", "rep_b", "n_a", "n_b").agg(
        F.count(F.lit(1)).alias("so_far"), F.max("at_a").alias("at_a"), F.max("at_b").alias("at_b"), F.max(F.least("step_a", "step_b")).alias("first"))
    pairs = pairs.filter((F.col("first") < high) & possible(F.col("so_far") - 1 + to_come)).select("rep_a", "rep_b", "n_a", "n_b")
    for side in ("_a", "_b"):
        pairs = pairs.join(ordered.select(*[F.col(c).alias(c + side) for c in ("rep", "words")]), "rep" + side)
    found = pairs.withColumn("shared", F.size(F.array_intersect("words_a", "words_b")))
    scored = found.withColumn("jaccard", F.col("shared") / (total - F.col("shared")))
    return _best(scored.select("rep_a", "rep_b", "shared", "n_a", "n_b", "jaccard"), k)


def _best(pairs: DataFrame, k: int) -> DataFrame:
    return pairs.orderBy(F.desc(F.round("jaccard", 12)), "rep_a", "rep_b").limit(k)


def _set_groups(df: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """Documents with equal word sets as one row: the first ``k + 1`` ids, the words, and the first id as ``rep``."""
    sets = (
        df.select(F.col(doc_id).alias("id"), F.array_sort(F.array_distinct(tokens(F.col(text)))).alias("words"))
        .filter(F.size("words") > 0)
        .withColumn("sig", F.sha2(F.array_join("words", " "), 256))
    )
    first = F.row_number().over(W.partitionBy("sig").orderBy("id"))
    heads = sets.withColumn("_rn", first).filter(F.col("_rn") <= k + 1)
    groups = heads.groupBy("sig").agg(
        F.sort_array(F.collect_list("id")).alias("ids"), F.max_by("words", -F.col("_rn")).alias("words"))
    return groups.withColumn("rep", F.get("ids", F.lit(0)))


def _best_pairs(groups: DataFrame, k: int) -> DataFrame:
    """The best ``k`` pairs of different sets, exact.

    Prefixes of all sets grow word by word, rarest first, in the order of a bound on what a longer prefix can still bring. The
    queue is worked off in batches; a batch meets all places before it. Once ``k`` pairs are known, the score of
    the last one is the bound at which the queue ends, and what each later batch skips. The first batch may bring
    as many possible pairs as there are sets, each further one ``GROWTH`` times as many.
    """
    with compact(_ordered_sets(groups.select("rep", "words"))) as ordered:
        return _worked_off(ordered, k)


def _worked_off(ordered: DataFrame, k: int) -> DataFrame:
    best, high, least, work, allowed, counted = None, STEPS + 1, 0.0, {}, max(ordered.count(), k), STEPS + 1
    while best is None or (high > 1 and (high - 1) / STEPS >= least):
        end = max(math.floor(least * STEPS), 1)
        if high == counted:
            counted = max(high - RANGE, end)
            work = _work(ordered, counted)
        low = next_batch(work, high, max(counted, end), allowed)
        found = _new_pairs(ordered, low, high, least, k)
        best = cut_lineage(found if best is None else _best(best.union(found), k))
        scores = [r["jaccard"] for r in best.select("jaccard").collect()]  # k rows
        least = min(scores) if len(scores) == k else 0.0
        high, allowed = low, allowed * GROWTH
    return best


def top_set_pairs(df: DataFrame, doc_id: str, text: str, k: int = 10) -> DataFrame:
    """The ``k`` pairs of different word sets with the highest Jaccard, each set under its smallest document id."""
    with compact(_set_groups(df, doc_id, text, 0)) as groups:
        best = _best_pairs(groups, k)
    return best.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"), "shared", "jaccard")


def top_document_pairs(df: DataFrame, doc_id: str, text: str, k: int = 10) -> DataFrame:
    """The ``k`` document pairs with the highest Jaccard of distinct words; ties by ids.

    Equal word sets are handled as one, so a corpus with very many copies costs one set;
    of each set only the first ``k + 1`` ids can appear in the answer, and of its own pairs only the
    first ``k``. Different sets are searched only if copies do not fill the list.
    """
    with compact(_set_groups(df, doc_id, text, k)) as groups:
        return cut_lineage(_document_pairs(groups, k))


def _document_pairs(groups: DataFrame, k: int) -> DataFrame:
    m = F.size("ids")
    copies = cut_lineage(
        groups.filter(m > 1)
        .select(F.size("words").alias("n"), "ids", m.alias("m"), F.posexplode("ids").alias("p", "a"))
        .filter(F.col("p") * (F.col("m") - 1) - F.col("p") * (F.col("p") - 1) / 2 < k)  # pairs with a smaller first id
        .select("n", "a", F.explode(F.slice("ids", F.col("p") + 2, F.col("m"))).alias("b"))
        .select("a", "b", F.col("n").alias("shared"), F.lit(1.0).alias("jaccard"))
        .orderBy("a", "b").limit(k)
    )
    known = copies.count()
    if known >= k:
        return copies
    best = _best_pairs(groups, k)
    ids = groups.select(F.col("rep"), F.col("ids"))
    left, right = ids.toDF("rep_a", "ids_a"), ids.toDF("rep_b", "ids_b")
    members = (
        best.join(left, "rep_a").join(right, "rep_b")
        .select("shared", "jaccard", F.explode("ids_a").alias("x"), "ids_b")
        .select("shared", "jaccard", "x", F.explode("ids_b").alias("y"))
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "shared", "jaccard")
    )
    return copies.unionByName(members).orderBy(F.desc(F.round("jaccard", 12)), "a", "b").limit(k)


def set_scores(shared: Column, na: Column, nb: Column) -> dict[str, Column]:
    """Cosine, Jaccard, overlap and Dice of two sets."""
    return {
        "cosine": F.round(shared / (F.sqrt(na) * F.sqrt(nb)), 9),
        "jaccard": F.round(shared / (na + nb - shared), 9),
        "overlap": F.round(shared / F.least(na, nb), 9),
        "dice": F.round(2 * shared / (na + nb), 9),
    }


def _block_ends(n: int):
    """Both ends by cosine of the term pairs in one block pair, as a small dense product."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        i, j = key
        basis = {w: c for c, w in enumerate(sorted(set().union(*rows["stripe"].map(set))))}

        def matrix(part: pd.DataFrame) -> np.ndarray:
            m = np.zeros((len(part), len(basis)), dtype=np.float32)
            for r, stripe in enumerate(part["stripe"]):
                m[r, [basis[w] for w in stripe]] = 1.0
            return m

        left = rows[rows["block"] == i].sort_values("term", ignore_index=True)
        right = left if i == j else rows[rows["block"] == j].sort_values("term", ignore_index=True)
        a, b = matrix(left), matrix(right)
        shared = a @ b.T
        na, nb = a.sum(1).astype(float), b.sum(1).astype(float)
        mask = np.triu(shared > 0, 1) if i == j else shared > 0
        at, bt = np.nonzero(mask)
        s = shared[at, bt].astype(float)
        cosine = np.round(s / (np.sqrt(na[at]) * np.sqrt(nb[bt])), 9)
        out = pd.DataFrame({
            "x": left["term"].to_numpy()[at], "y": right["term"].to_numpy()[bt],
            "shared": s.astype("int64"), "nx": na[at].astype("int64"), "ny": nb[bt].astype("int64"), "cosine": cosine,
        })
        if len(out) > 2 * n:  # keep everything tied with the n-th value at either end
            hi = np.partition(cosine, len(cosine) - n)[len(cosine) - n]
            lo = np.partition(cosine, n - 1)[n - 1]
            out = out[(cosine >= hi) | (cosine <= lo)]
        swap = out["x"] > out["y"]
        for p, q in (("x", "y"), ("nx", "ny")):
            out.loc[swap, [p, q]] = out.loc[swap, [q, p]].to_numpy()
        ends = [out.sort_values(["cosine", "x", "y"], ascending=[up, True, True]).head(n) for up in (False, True)]
        return pd.concat(ends).drop_duplicates(["x", "y"])[["x", "y", "shared", "nx", "ny"]]

    return run


def stripe_similarity(stripes: DataFrame, n: int, max_terms: int, block_terms: int = 1250) -> DataFrame:
    """The ``n`` most and least similar term pairs (sharing at least one basis word), four scores.

    ``max_terms`` is the vocabulary size, a parameter, so the number of terms and the length
    of a stripe are bounded whatever the corpus. Terms are hashed into blocks; each pair of
    blocks is one task that multiplies two small 0/1 matrices and returns only its own ends.
    """
    blocks = max(1, math.ceil(max_terms / block_terms))
    home = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    spread = (
        stripes.withColumn("block", home).withColumn("_o", other)
        .select(F.least("block", "_o").alias("i"), F.greatest("block", "_o").alias("j"), "block", "term", "stripe")
    )
    local = spread.groupBy("i", "j").applyInPandas(
        _block_ends(n), "x string, y string, shared long, nx long, ny long")
    scored = local.select(F.col("x").alias("a"), F.col("y").alias("b"), "shared", "nx", "ny").withColumns(
        set_scores(F.col("shared"), F.col("nx"), F.col("ny")))
    scored = cut_lineage(scored.drop("nx", "ny"))
    top = scored.orderBy(F.desc("cosine"), "a", "b").limit(n).withColumn("end", F.lit("top"))
    bottom = scored.orderBy(F.asc("cosine"), "a", "b").limit(n).withColumn("end", F.lit("bottom"))
    return top.unionByName(bottom)
