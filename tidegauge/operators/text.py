"""Word statistics, n-gram co-occurrence and Naive Bayes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..functions.text import tokens
from ..session import cut_lineage
from .blocks import counted_lines, distinct_pairs
from .ranking import top_per_group
from .skew import attach

# Fixed list: the stop words removed before a vocabulary is ranked.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is
are was were be been being have has had having do does did doing a an the and but if or because as until
while of at by for with about against between into through during before after above below to from up
down in out on off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very should can now will just would
could may must one much it's can't won't don't shouldn't hasn't
""".split()


def rows_of(df: DataFrame, values: Column, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per array entry.

    The plain ``explode`` makes the optimiser test the array for emptiness before the scan's
    repartitioning, which would compute a costly array twice; the outer form does not.
    """
    return df.select(*keep, F.explode_outer(values).alias(name)).filter(F.col(name).isNotNull())


def word_rows(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per token."""
    return rows_of(df, tokens(F.col(text)), "word", keep)


def word_count(df: DataFrame, text: str) -> DataFrame:
    return word_rows(df, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_by_class(df: DataFrame, text: str, label: str) -> DataFrame:
    return word_rows(df, text, [label]).groupBy("word", label).agg(F.count(F.lit(1)).alias("n"))


def merge_counts(parts: Sequence[DataFrame]) -> DataFrame:
    """Add up partial word counts."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy("word").agg(F.sum("n").alias("n"))


def ngrams(df: DataFrame, text: str, size: int = 5) -> DataFrame:
    """Distinct word n-grams of whole texts with their number of occurrences.

    Neighbouring n-grams travel as one run of words in compressed blocks, see ``blocks``.
    """
    return counted_lines(df.select(tokens(F.col(text)).alias("_w")), size)


def weighted_words(grams: DataFrame) -> DataFrame:
    """Word totals over n-gram lines, each line weighted by its count."""
    one = rows_of(grams, F.split(F.lower("ngram"), " "), "word", ["n"])
    return one.groupBy("word").agg(F.sum("n").alias("n"))


def neighbour_pairs(grams: DataFrame) -> DataFrame:
    """Distinct unordered pairs of different words that share an n-gram.

    An n-gram has a fixed number of words, so a line gives at most ten pairs. They travel in compressed blocks, see ``blocks``.
    """
    pairs = distinct_pairs(grams.select(F.lower("ngram").alias("_w")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def neighbour_counts(grams: DataFrame) -> DataFrame:
    """Number of different words each word shares an n-gram with."""
    ends = neighbour_pairs(grams).select(F.explode(F.array("a", "b")).alias("word"))
    return ends.groupBy("word").agg(F.count(F.lit(1)).alias("n_neighbours"))


def vocabulary(grams: DataFrame, size: int, basis: int, stop_words: Sequence[str] = tuple(STOP_WORDS)) -> DataFrame:
    """The ``size`` most frequent words without stop words; the last ``basis`` ranks are the basis.

    Ranks are given to the cut list only, which has ``size`` rows whatever the corpus.
    """
    stop = grams.sparkSession.createDataFrame([(w,) for w in stop_words], "word string")
    kept = weighted_words(grams).join(stop, "word", "left_anti")
    order = [F.desc("n"), F.asc("word")]
    cut = kept.orderBy(*order).limit(size)
    ranked = cut.withColumn("rank", F.row_number().over(W.orderBy(*order)).cast("long") - 1)
    return ranked.withColumn("in_basis", (F.col("rank") >= size - basis).cast("int"))


def stripe_edges(grams: DataFrame, vocab: DataFrame) -> DataFrame:
    """Distinct (vocabulary word, basis word) pairs that share an n-gram.

    Basis words are few and rare, so lines are reduced to those that have one before the
    words beside it are looked at.
    """
    words = grams.select(F.array_distinct(F.split(F.lower("ngram"), " ")).alias("_w"))
    terms = vocab.select(F.col("word").alias("term"))
    basis = vocab.filter(F.col("in_basis") == 1).select(F.col("word").alias("basis"))
    b = rows_of(words, F.col("_w"), "basis", ["_w"]).join(basis, "basis", "left_semi")
    a = rows_of(b, F.col("_w"), "term", ["basis"]).filter(F.col("term") != F.col("basis")).distinct()
    return a.join(terms, "term", "left_semi").select("term", "basis")


def stripes(edges: DataFrame) -> DataFrame:
    """One row per term with its sorted basis words; a stripe is no longer than the basis."""
    return edges.groupBy("term").agg(F.sort_array(F.collect_list("basis")).alias("stripe"))


def postings(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Inverted index as rows: word, document, distinct words of the document, document frequency.

    Postings of a frequent word stay separate rows, so no word has to fit in one task.
    """
    sets = df.select(doc_id, F.array_distinct(tokens(F.col(text))).alias("_w"))
    sets = sets.withColumn("n_words", F.size("_w").cast("long"))
    rows = rows_of(sets, F.col("_w"), "word", [doc_id, "n_words"])
    frequency = rows.groupBy("word").agg(F.count(F.lit(1)).alias("doc_freq"))
    return attach(rows, frequency, ["word"])


def train_naive_bayes(df: DataFrame, text: str, label: str, smoothing: float) -> DataFrame:
    """Counts and conditional probabilities of every word in classes 0 and 1, priors attached.

    The counts are written once; totals, priors and scoring read that table, not the texts again.
    """
    one = F.col(label) == 1
    docs = df.filter(F.col(label).isin(0, 1))
    counts = word_rows(docs, text, [label]).groupBy("word").agg(
        F.count(F.when(~one, 1)).alias("n0"), F.count(F.when(one, 1)).alias("n1"))
    counts = cut_lineage(counts)
    sizes = counts.agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"), F.count(F.lit(1)).alias("v")).first()
    prior = docs.agg(F.avg(one.cast("double"))).first()[0]
    a, v = smoothing, sizes["v"] or 0

    def p(n: str, total: int | None) -> Column:
        return ratio(F.col(n) + F.lit(a), F.lit((total or 0) + a * v))

    return counts.select("word", "n0", "n1", p("n0", sizes["t0"]).alias("p0"), p("n1", sizes["t1"]).alias("p1"),
                         F.lit(1 - prior).alias("prior0"), F.lit(prior).alias("prior1"))


def score_naive_bayes(df: DataFrame, model: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """Log score of both classes and the better class (ties go to 1); unknown words are ignored."""
    words = word_rows(df, text, [doc_id]).groupBy(doc_id, "word").agg(F.count(F.lit(1)).alias("tf"))
    table = model.select("word", (F.col("n0") + F.col("n1")).alias("_n"), F.log("p0").alias("l0"), F.log("p1").alias("l1"))
    logs = attach(words, table, ["word"]).filter(F.col("_n").isNotNull())
    sums = logs.groupBy(doc_id).agg(F.sum(F.col("tf") * F.col("l0")).alias("s0"), F.sum(F.col("tf") * F.col("l1")).alias("s1"))
    prior = model.select("prior0", "prior1").limit(1).first()
    out = df.select(doc_id, label).join(sums, doc_id, "left")
    out = out.withColumns({
        "score0": F.coalesce("s0", F.lit(0.0)) + F.log(F.lit(prior["prior0"])),
        "score1": F.coalesce("s1", F.lit(0.0)) + F.log(F.lit(prior["prior1"])),
    })
    return out.select(doc_id, label, "score0", "score1",
                      F.when(F.col("score1") >= F.col("score0"), 1).otherwise(0).alias("predicted"))


def top_words_per_class(model: DataFrame, k: int) -> DataFrame:
    rows = F.array(F.struct(F.lit(0).alias("class"), F.col("p0").alias("p")),
                   F.struct(F.lit(1).alias("class"), F.col("p1").alias("p")))
    return top_per_group(model.select("word", F.inline(rows)), ["class"], [F.desc("p"), F.asc("word")], k)
