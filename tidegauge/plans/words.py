"""Word counts, n-gram co-occurrence, similarity and Naive Bayes on whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import hash_unit
from ..operators import evaluate, ranking, sets, similarity, text
from ..session import cut_lineage
from ..sources.tables import spread
from .registry import Tables, query
from .splits import rates_sql, unit

TOKENS = "regexp_extract_all(lower(text), '[a-z]+')"


def docs(t: Tables) -> DataFrame:
    return spread(t.documents.select("doc_id", "lang", "text"))


WORDS_SQL = f"words AS (SELECT doc_id, unnest({TOKENS}) AS word FROM documents)"
COUNTS_SQL = f"{WORDS_SQL}, counts AS (SELECT word, count(*) AS n FROM words GROUP BY word)"


@query("x1_word_count", f"WITH {COUNTS_SQL} SELECT word, n FROM counts")
def x1_word_count(t: Tables) -> DataFrame:
    return text.word_count(docs(t), "text")


@query("t8_merged_counts", f"WITH {COUNTS_SQL} SELECT word, n FROM counts")
def t8_merged_counts(t: Tables) -> DataFrame:
    """Partial counts per language, added up."""
    rows = docs(t)
    langs = [F.col("lang") == "en", F.col("lang") == "fr", ~F.col("lang").isin("en", "fr") | F.col("lang").isNull()]
    return text.merge_counts([text.word_count(rows.filter(c), "text") for c in langs])


@query("t2_both_ends", f"""
WITH {COUNTS_SQL}, a AS (SELECT *, 'top' AS "end", row_number() OVER (ORDER BY n DESC, word) AS place FROM counts),
     b AS (SELECT *, 'bottom' AS "end", row_number() OVER (ORDER BY n, word) AS place FROM counts)
SELECT * FROM a WHERE place <= 10 UNION ALL SELECT * FROM b WHERE place <= 10""")
def t2_both_ends(t: Tables) -> DataFrame:
    return ranking.both_ends(text.word_count(docs(t), "text"), "n", 10, "word")


def labelled(t: Tables) -> DataFrame:
    return docs(t).select("doc_id", "text").join(t.labels.select("doc_id", "quality"), "doc_id")


CLASSED_SQL = f"""labelled AS (SELECT doc_id, text, quality FROM documents JOIN labels USING (doc_id)),
     cw AS (SELECT doc_id, quality, unnest({TOKENS}) AS word FROM labelled),
     classed AS (SELECT word, quality, count(*) AS n FROM cw GROUP BY ALL)"""


@query("x2_word_count_by_class", f"WITH {CLASSED_SQL} SELECT word, quality, n FROM classed")
def x2_word_count_by_class(t: Tables) -> DataFrame:
    return text.word_count_by_class(labelled(t), "text", "quality")


@query("t3_top_per_class", f"WITH {CLASSED_SQL} SELECT word, quality, n, row_number() OVER (PARTITION BY quality ORDER BY n DESC, word) AS place FROM classed QUALIFY place <= 15")
def t3_top_per_class(t: Tables) -> DataFrame:
    counts = text.word_count_by_class(labelled(t), "text", "quality")
    return ranking.top_per_group(counts, ["quality"], [F.desc("n"), F.asc("word")], 15)


@query("t4_secondary_sort", f"WITH {CLASSED_SQL} SELECT word, quality, n FROM classed ORDER BY quality, n DESC, word")
def t4_secondary_sort(t: Tables) -> DataFrame:
    return text.word_count_by_class(labelled(t), "text", "quality").orderBy("quality", F.desc("n"), "word")


@query("t5_sort_inside_class", f"""WITH {CLASSED_SQL} SELECT word, quality, n, dense_rank() OVER (ORDER BY quality) - 1 AS partition,
       row_number() OVER (PARTITION BY quality ORDER BY n DESC, word) - 1 AS place FROM classed""")
def t5_sort_inside_class(t: Tables) -> DataFrame:
    counts = text.word_count_by_class(labelled(t), "text", "quality")
    return ranking.grouped_sort(counts, "quality", "n", [F.asc("word")])


@query("t7_global_rank", f"WITH {COUNTS_SQL} SELECT word, n, row_number() OVER (ORDER BY n DESC, word) - 1 AS rank FROM counts")
def t7_global_rank(t: Tables) -> DataFrame:
    return ranking.global_rank(text.word_count(docs(t), "text"), [F.desc("n"), F.asc("word")])


# ---- n-grams ---------------------------------------------------------------------------

GRAMS_SQL = f"""tok AS (SELECT {TOKENS} AS w FROM documents),
     grams AS (SELECT ngram, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))) AS ngram
               FROM tok WHERE len(w) >= 5) GROUP BY ngram)"""
LINE_SQL = f"{GRAMS_SQL}, gw AS (SELECT ngram, n, unnest(string_split(ngram, ' ')) AS word FROM grams)"
WEIGHTED_SQL = f"{LINE_SQL}, weighted AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM gw GROUP BY word)"
NEIGHBOURS_SQL = f"""{LINE_SQL}, dw AS (SELECT DISTINCT ngram, word FROM gw),
     pairs AS (SELECT DISTINCT a.word AS a, b.word AS b FROM dw a JOIN dw b ON a.ngram = b.ngram AND a.word <> b.word),
     neighbours AS (SELECT a AS word, count(*) AS n_neighbours FROM pairs GROUP BY a)"""


def grams(t: Tables) -> DataFrame:
    return text.ngrams(docs(t), "text", 5)


def stored_grams(t: Tables) -> DataFrame:
    """The n-gram table written once, for jobs that read it more than once."""
    return cut_lineage(grams(t))


@query("x3_weighted_words", f"WITH {WEIGHTED_SQL} SELECT word, n FROM weighted")
def x3_weighted_words(t: Tables) -> DataFrame:
    return text.weighted_words(grams(t))


@query("x3_vocabulary_summary", f"WITH {WEIGHTED_SQL} SELECT count(*) AS n_words, CAST(sum(n) AS BIGINT) AS n_total, max(n) AS most, min(n) AS least FROM weighted")
def x3_vocabulary_summary(t: Tables) -> DataFrame:
    return text.weighted_words(grams(t)).agg(F.count(F.lit(1)).alias("n_words"), F.sum("n").alias("n_total"),
                                             F.max("n").alias("most"), F.min("n").alias("least"))


@query("x4_neighbour_counts", f"WITH {NEIGHBOURS_SQL} SELECT word, n_neighbours FROM neighbours")
def x4_neighbour_counts(t: Tables) -> DataFrame:
    return text.neighbour_counts(grams(t))


N_VOCAB, N_BASIS = 10_000, 1_000
STOP_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in text.STOP_WORDS) + ")"
VOCAB_SQL = f"""{WEIGHTED_SQL}, vocab AS (SELECT word, n, rank, CASE WHEN rank >= {N_VOCAB - N_BASIS} THEN 1 ELSE 0 END AS in_basis
     FROM (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) - 1 AS rank FROM weighted WHERE word NOT IN {STOP_SQL}) WHERE rank < {N_VOCAB})"""
STRIPES_SQL = f"""{VOCAB_SQL}, dw AS (SELECT DISTINCT ngram, word FROM gw),
     edges AS (SELECT DISTINCT a.word AS term, b.word AS basis FROM dw a JOIN dw b ON a.ngram = b.ngram AND a.word <> b.word
               JOIN vocab va ON va.word = a.word JOIN vocab vb ON vb.word = b.word AND vb.in_basis = 1)"""


@query("x5_vocabulary", f"WITH {VOCAB_SQL} SELECT word, n, rank, in_basis FROM vocab")
def x5_vocabulary(t: Tables) -> DataFrame:
    return text.vocabulary(grams(t), N_VOCAB, N_BASIS)


@query("x6_stripes", f"WITH {STRIPES_SQL} SELECT term, list_sort(list(basis)) AS stripe FROM edges GROUP BY term")
def x6_stripes(t: Tables) -> DataFrame:
    g = stored_grams(t)
    return text.stripes(text.stripe_edges(g, text.vocabulary(g, N_VOCAB, N_BASIS)))


@query("x9_stripe_similarity", f"""
WITH {STRIPES_SQL}, size AS (SELECT term, count(*) AS n FROM edges GROUP BY term),
     s AS (SELECT a.term AS a, b.term AS b, count(*) AS shared FROM edges a JOIN edges b ON a.basis = b.basis AND a.term < b.term GROUP BY ALL),
     m AS (SELECT a, b, shared, round(shared / (sqrt(x.n) * sqrt(y.n)), 9) AS cosine, round(1.0 * shared / (x.n + y.n - shared), 9) AS jaccard,
                  round(1.0 * shared / least(x.n, y.n), 9) AS overlap, round(2.0 * shared / (x.n + y.n), 9) AS dice
           FROM s JOIN size x ON x.term = a JOIN size y ON y.term = b)
SELECT * FROM (SELECT *, 'top' AS "end" FROM m ORDER BY cosine DESC, a, b LIMIT 20)
UNION ALL SELECT * FROM (SELECT *, 'bottom' AS "end" FROM m ORDER BY cosine, a, b LIMIT 20)""")
def x9_stripe_similarity(t: Tables) -> DataFrame:
    return similarity.stripe_similarity(x6_stripes(t), 20, N_VOCAB)


@query("x15_ranking_overlap", f"""
WITH {NEIGHBOURS_SQL}, weighted AS (SELECT word, sum(n) AS n FROM gw GROUP BY word),
     a AS (SELECT word FROM neighbours ORDER BY n_neighbours DESC, word LIMIT 1000), b AS (SELECT word FROM weighted ORDER BY n DESC, word LIMIT 1000)
SELECT count(*) AS n_first, count(b.word) AS n_shared, round(100.0 * count(b.word) / count(*), 6) AS overlap_pct FROM a LEFT JOIN b USING (word)""")
def x15_ranking_overlap(t: Tables) -> DataFrame:
    """Share of the 1,000 words with most neighbours that are among the 1,000 most frequent.

    The n-gram table is not written: both lists read the blocks of one shuffle, a fraction of its size.
    """
    g = grams(t)
    most_nbrs = ranking.top_n(text.neighbour_counts(g), "n_neighbours", 1000, "word")
    most_freq = ranking.top_n(text.weighted_words(g), "n", 1000, "word")
    return sets.overlap(most_nbrs, most_freq, "word")


# ---- documents as word sets ------------------------------------------------------------

SETS_SQL = f"sets AS (SELECT DISTINCT doc_id, unnest({TOKENS}) AS word FROM documents), size AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id)"


@query("x7_inverted_index", f"WITH {SETS_SQL} SELECT word, doc_id, n AS n_words, count(*) OVER (PARTITION BY word) AS doc_freq FROM sets JOIN size USING (doc_id)")
def x7_inverted_index(t: Tables) -> DataFrame:
    return text.postings(docs(t), "doc_id", "text")


@query("x8_document_pairs", f"""
WITH {SETS_SQL}, p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sets a JOIN sets b ON a.word = b.word AND a.doc_id < b.doc_id GROUP BY ALL)
SELECT a, b, shared, round(1.0 * shared / (x.n + y.n - shared), 9) AS jaccard FROM p JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
ORDER BY 1.0 * shared / (x.n + y.n - shared) DESC, a, b LIMIT 150""")
def x8_document_pairs(t: Tables) -> DataFrame:
    """Most similar pairs; the list is longer than the number of exact copies at small scale."""
    out = similarity.top_document_pairs(docs(t), "doc_id", "text", 150)
    return out.select("a", "b", F.col("shared").cast("long").alias("shared"), F.round("jaccard", 9).alias("jaccard"))


# ---- Naive Bayes -----------------------------------------------------------------------

IN_TRAIN = unit("doc_id") + " < 0.8"


def parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = labelled(t)
    u = hash_unit(F.col("doc_id"))
    return rows.filter(u < 0.8), rows.filter(u >= 0.8)


def model_sql(smoothing: int) -> str:
    return f"""{CLASSED_SQL.replace('FROM labelled)', f'FROM labelled WHERE {IN_TRAIN})')},
     k AS (SELECT word, CAST(coalesce(sum(n) FILTER (quality = 0), 0) AS BIGINT) AS n0, CAST(coalesce(sum(n) FILTER (quality = 1), 0) AS BIGINT) AS n1 FROM classed GROUP BY word),
     z AS (SELECT sum(n0) AS t0, sum(n1) AS t1, count(*) AS v FROM k), pr AS (SELECT avg(quality) AS q FROM labelled WHERE {IN_TRAIN}),
     model AS (SELECT word, n0, n1, (n0 + {smoothing}) / CAST(t0 + {smoothing} * v AS DOUBLE) AS p0, (n1 + {smoothing}) / CAST(t1 + {smoothing} * v AS DOUBLE) AS p1,
                      1 - q AS prior0, q AS prior1 FROM k, z, pr)"""


def rounded_model(m: DataFrame) -> DataFrame:
    return m.select("word", "n0", "n1", *[F.round(c, 12).alias(c) for c in ("p0", "p1", "prior0", "prior1")])


SHOWN = "SELECT word, n0, n1, round(p0, 12) AS p0, round(p1, 12) AS p1, round(prior0, 12) AS prior0, round(prior1, 12) AS prior1 FROM model"


@query("x8_set_pairs", f"""
WITH reps AS (SELECT min(doc_id) AS doc_id, words FROM (SELECT doc_id, list_sort(list_distinct({TOKENS})) AS words FROM documents) WHERE len(words) > 0 GROUP BY words),
     sets AS (SELECT doc_id, unnest(words) AS word, len(words) AS n FROM reps),
     p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared FROM sets a JOIN sets b ON a.word = b.word AND a.doc_id < b.doc_id GROUP BY ALL)
SELECT a, b, shared, round(1.0 * shared / (na + nb - shared), 9) AS jaccard FROM p ORDER BY round(1.0 * shared / (na + nb - shared), 12) DESC, a, b LIMIT 50""")
def x8_set_pairs(t: Tables) -> DataFrame:
    """Most similar pairs of different sets, so that the search runs at every scale."""
    out = similarity.top_set_pairs(docs(t), "doc_id", "text", 50)
    return out.select("a", "b", F.col("shared").cast("long").alias("shared"), F.round("jaccard", 9).alias("jaccard"))


@query("x10_naive_bayes_plain", f"WITH {model_sql(0)} {SHOWN}")
def x10_naive_bayes_plain(t: Tables) -> DataFrame:
    return rounded_model(text.train_naive_bayes(parts(t)[0], "text", "quality", 0.0))


@query("x11_naive_bayes_smoothed", f"WITH {model_sql(1)} {SHOWN}")
def x11_naive_bayes_smoothed(t: Tables) -> DataFrame:
    return rounded_model(text.train_naive_bayes(parts(t)[0], "text", "quality", 1.0))


SCORES_SQL = f"""{model_sql(1)}, tw AS (SELECT doc_id, quality, unnest({TOKENS}) AS word FROM labelled WHERE NOT ({IN_TRAIN})),
     sums AS (SELECT doc_id, sum(ln(p0)) AS s0, sum(ln(p1)) AS s1 FROM tw JOIN model USING (word) GROUP BY doc_id),
     scores AS (SELECT l.doc_id, quality, coalesce(s0, 0) + ln(1 - q) AS score0, coalesce(s1, 0) + ln(q) AS score1
                FROM (SELECT * FROM labelled WHERE NOT ({IN_TRAIN})) l LEFT JOIN sums USING (doc_id), pr)"""


def scores(t: Tables) -> DataFrame:
    train, test = parts(t)
    return text.score_naive_bayes(test, text.train_naive_bayes(train, "text", "quality", 1.0), "doc_id", "text", "quality")


@query("x12_naive_bayes_scores", f"WITH {SCORES_SQL} SELECT doc_id, quality, round(score0, 6) AS score0, round(score1, 6) AS score1, CASE WHEN score1 >= score0 THEN 1 ELSE 0 END AS predicted FROM scores")
def x12_naive_bayes_scores(t: Tables) -> DataFrame:
    return scores(t).select("doc_id", "quality", F.round("score0", 6).alias("score0"), F.round("score1", 6).alias("score1"), "predicted")


@query("x13_classifier_report", f"""WITH {SCORES_SQL}, c AS (SELECT count(*) FILTER (score1 >= score0 AND quality = 1) AS tp, count(*) FILTER (score1 >= score0 AND quality = 0) AS fp,
  count(*) FILTER (score1 < score0 AND quality = 1) AS fn, count(*) FILTER (score1 < score0 AND quality = 0) AS tn FROM scores) """ + rates_sql("c"))
def x13_classifier_report(t: Tables) -> DataFrame:
    return evaluate.confusion(scores(t), "quality", F.col("predicted") == 1)


@query("x14_top_words_per_class", f"""WITH {model_sql(1)}, r AS (SELECT word, 0 AS class, p0 AS p FROM model UNION ALL SELECT word, 1, p1 FROM model)
SELECT word, class, round(p, 12) AS p, row_number() OVER (PARTITION BY class ORDER BY p DESC, word) AS place FROM r QUALIFY place <= 10""")
def x14_top_words_per_class(t: Tables) -> DataFrame:
    model = text.train_naive_bayes(parts(t)[0], "text", "quality", 1.0)
    return text.top_words_per_class(model, 10).withColumn("p", F.round("p", 12))
