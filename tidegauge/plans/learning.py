"""Feature preparation, models, searches and distributed descent."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import hash_unit, tokens
from ..operators import clean, descent, evaluate, grid, learn, perceptron, split, trees
from ..session import cut_lineage
from ..sources.tables import spread
from .registry import Tables, query
from .splits import labelled_orders, unit

# ---- prepared features -----------------------------------------------------------------


@query("l3_one_hot", """
WITH i AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS ix FROM orders GROUP BY o_orderpriority)
SELECT o_orderkey, CAST(ix AS DOUBLE) AS ix, CAST((SELECT count(*) FROM i) + 1 AS INTEGER) AS width FROM orders JOIN i USING (o_orderpriority)""")
def l3_one_hot(t: Tables) -> DataFrame:
    """Index by falling frequency and a one-hot vector with a slot for unseen values."""
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    hot = vector_to_array("o_orderpriority_oh")
    out = learn.fit(rows, learn.one_hot(["o_orderpriority"])).transform(rows)
    return out.select("o_orderkey", (F.array_position(hot, 1.0) - 1).cast("double").alias("ix"), F.size(hot).alias("width"))


@query("l4_scaled_groups", """
WITH s AS (SELECT quantile_disc(l_quantity, 0.5) AS md, quantile_disc(l_quantity, 0.75) - quantile_disc(l_quantity, 0.25) AS iqr, min(l_discount) AS lo, max(l_discount) AS hi,
                  avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS sd FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - md) / iqr, 7) AS q, round((l_discount - lo) / (hi - lo), 7) AS d, round((l_extendedprice - m) / sd, 7) AS p FROM lineitem, s""")
def l4_scaled_groups(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice")
    model = learn.fit(rows, learn.scaled_groups(["l_quantity"], ["l_discount"], ["l_extendedprice"]))
    v = vector_to_array("features")
    return model.transform(rows).select("l_orderkey", "l_linenumber", *[F.round(v[i], 7).alias(n) for i, n in enumerate("qdp")])


@query("l5_pca")
def l5_pca(t: Tables) -> DataFrame:
    rows = t.embeddings.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    out, _ = learn.pca_cut(rows, "v", 0.95)
    return out.select("vec_id", "label", F.size("components").alias("n_components"), "components")


CANDIDATES = ["l_linenumber", "l_discount", "l_tax", "l_extendedprice"]
BINS_SQL = "\nUNION ALL ".join(f"""SELECT '{c}' AS "column", CAST(least(floor((CAST({c} AS DOUBLE) - (SELECT min({c}) FROM lineitem)) / (SELECT max({c}) - min({c}) FROM lineitem) * 10), 9) AS INTEGER) AS bin,
       l_returnflag = 'R' AS y, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY ALL""" for c in CANDIDATES)


@query("a20_chi_square_selection", f"""
WITH o AS ({BINS_SQL}), x AS (SELECT *, sum(n) OVER (PARTITION BY "column", bin) AS r, sum(n) OVER (PARTITION BY "column", y) AS c, sum(n) OVER (PARTITION BY "column") AS t FROM o),
     s AS (SELECT "column", sum((n - r * c / t) * (n - r * c / t) / (r * c / t)) + any_value(t) - sum(r * c / t) AS chi2,
                  (count(DISTINCT bin) - 1) * (count(DISTINCT y) - 1) AS dof FROM x GROUP BY "column"),
     z AS (SELECT *, row_number() OVER (ORDER BY round((cbrt(chi2 / dof) - (1 - 2 / (9.0 * dof))) / sqrt(2 / (9.0 * dof)), 6) DESC, "column") AS place FROM s)
SELECT place, "column", round(chi2, 6) AS chi2, dof FROM z WHERE place <= 2""")
def a20_chi_square_selection(t: Tables) -> DataFrame:
    return learn.select_by_chi2(labelled_lines(t).select(*CANDIDATES, "late"), CANDIDATES, "late", 2)


# ---- classifiers on documents ----------------------------------------------------------

FEATURES = ["n_chars", "n_words", "n_unique", "mean_word", "unique_share"]


def documents(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Length statistics of labelled documents, split by a hash of the key."""
    words = spread(t.documents).join(t.labels, "doc_id").select("doc_id", F.col("quality").cast("double").alias("label"),
                                                        F.col("n_chars").cast("double").alias("n_chars"), tokens(F.col("text")).alias("w"))
    rows = words.select(
        "doc_id", "label", "n_chars", F.size("w").cast("double").alias("n_words"),
        F.size(F.array_distinct("w")).cast("double").alias("n_unique"),
        (F.length(F.array_join("w", "")) / F.greatest(F.size("w"), F.lit(1))).alias("mean_word"),
        (F.size(F.array_distinct("w")) / F.greatest(F.size("w"), F.lit(1))).alias("unique_share"))
    rows = cut_lineage(rows)  # a narrow table that every fitting pass reads again
    u = hash_unit(F.col("doc_id"), seed=3)
    return rows.filter(u < 0.7), rows.filter(u >= 0.7)


def prepared() -> list:
    return learn.scaled_groups(robust=["n_chars", "n_words", "n_unique"], minmax=["unique_share"], standard=["mean_word"])


def assembled() -> list:
    return [VectorAssembler(inputCols=FEATURES, outputCol="features")]


def predictions(t: Tables, stages: list) -> DataFrame:
    train, test = documents(t)
    out = learn.fit(train, stages).transform(test)
    return out.select("doc_id", "label", F.round(learn.positive_probability(), 6).alias("prob"), "prediction")


@query("l6_logistic_regression")
def l6_logistic_regression(t: Tables) -> DataFrame:
    """Elastic net with balanced class weights."""
    train, test = documents(t)
    weighted = split.class_weights(train, "label")
    out = learn.fit(weighted, [*prepared(), learn.logistic("label", weight="weight")]).transform(test)
    return out.select("doc_id", "label", F.round(learn.positive_probability(), 6).alias("prob"), "prediction")


@query("l7_random_forest")
def l7_random_forest(t: Tables) -> DataFrame:
    return predictions(t, [*assembled(), learn.forest("label")])


@query("l8_boosted_trees")
def l8_boosted_trees(t: Tables) -> DataFrame:
    return predictions(t, [*assembled(), learn.boosted("label", rounds=5)])


@query("l9_perceptron")
def l9_perceptron(t: Tables) -> DataFrame:
    return predictions(t, [*prepared(), learn.perceptron("label", [len(FEATURES), 6, 2])])


@query("l16_feature_importance")
def l16_feature_importance(t: Tables) -> DataFrame:
    train, _ = documents(t)
    model = learn.fit(train, [*assembled(), learn.forest("label")])
    return learn.importance_table(train, model.stages[-1], FEATURES)


@query("l15_early_stopping")
def l15_early_stopping(t: Tables) -> DataFrame:
    train, valid = (d.persist() for d in documents(t))
    tried = learn.early_stop(train, valid, [2, 4, 6, 8], [*assembled(), learn.boosted("label", rounds=8)], "label")
    train.unpersist(), valid.unpersist()
    return t.spark.createDataFrame(tried, "rounds int, auc_pr double, auc_roc double, is_best boolean").coalesce(1)


@query("l18_mean_ensemble")
def l18_mean_ensemble(t: Tables) -> DataFrame:
    train, test = documents(t)
    models = [learn.fit(train, [*prepared(), learn.logistic("label")]), learn.fit(train, [*assembled(), learn.forest("label", trees=10)]),
              learn.fit(train, [*prepared(), learn.perceptron("label", [len(FEATURES), 4, 2], rounds=15)])]
    return learn.mean_probability(test, models).select("doc_id", "label", F.round("prob", 6).alias("prob"))


# ---- models as tables ------------------------------------------------------------------

TOKENS = "regexp_extract_all(lower(text), '[a-z]+')"
CELLS_SQL = f"""w AS (SELECT doc_id, CAST(quality AS DOUBLE) AS label, n_chars, {TOKENS} AS w FROM documents JOIN labels USING (doc_id)),
     r AS MATERIALIZED (SELECT doc_id, label, {unit("doc_id", 3)} < 0.7 AS train,
       [CAST(n_chars AS DOUBLE), len(w), len(list_distinct(w)), length(array_to_string(w, '')) / greatest(len(w), 1), len(list_distinct(w)) / greatest(len(w), 1)] AS x FROM w),
     x AS MATERIALIZED (SELECT doc_id, label, train, unnest(range({len(FEATURES)})) AS f, coalesce(unnest(x), 0) AS x FROM r),
     cuts AS (SELECT DISTINCT f, unnest(quantile_disc(x, [i / 16.0 for i in range(1, 16)])) AS t FROM x WHERE train AND label IS NOT NULL GROUP BY f),
     bins AS MATERIALIZED (SELECT doc_id, x.f, count(t) AS bin FROM x LEFT JOIN cuts ON cuts.f = x.f AND t < x GROUP BY doc_id, x.f)"""


def levels_sql(name: str, depth: int, least: int, seed: int | None) -> str:
    """Tables that grow trees from ``{name}m`` (doc_id, tree, w, s) and end with ``{name}v`` (doc_id, tree, value)."""
    drawn = "" if seed is None else f" AND {unit("concat(tree, ':', node, ':', f)", seed)} < 0.6"
    parts = [f"{name}0 AS MATERIALIZED (SELECT doc_id, tree, 1 AS node FROM r, (SELECT DISTINCT tree FROM {name}m))"]
    for i in range(depth):
        parts.append(f"""{name}h{i} AS (SELECT tree, node, f, bin, sum(w) AS w, sum(s) AS s FROM {name}{i} JOIN {name}m USING (doc_id, tree) JOIN bins USING (doc_id) WHERE node >= {1 << i} AND w > 0 GROUP BY ALL),
{name}c{i} AS (SELECT tree, node, f, bin, CAST(sum(w) OVER a AS DOUBLE) AS lw, CAST(sum(s) OVER a AS DOUBLE) AS ls, CAST(sum(w) OVER b AS DOUBLE) AS w, CAST(sum(s) OVER b AS DOUBLE) AS s FROM {name}h{i}
   WINDOW a AS (PARTITION BY tree, node, f ORDER BY bin), b AS (PARTITION BY tree, node, f)),
{name}b{i} AS MATERIALIZED (SELECT tree, node, f, bin, ls * ls / lw + (s - ls) * (s - ls) / (w - lw) - s * s / w AS gain FROM {name}c{i} WHERE lw >= {least} AND w - lw >= {least}{drawn}
   QUALIFY gain > 1e-9 AND row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, f, bin) = 1),
{name}{i + 1} AS MATERIALIZED (SELECT a.doc_id, a.tree, CASE WHEN b.f IS NULL THEN a.node ELSE 2 * a.node + CAST(x.bin > b.bin AS INTEGER) END AS node
   FROM {name}{i} a LEFT JOIN {name}b{i} b ON b.tree = a.tree AND b.node = a.node LEFT JOIN bins x ON x.doc_id = a.doc_id AND x.f = b.f)""")
    parts.append(f"""{name}l AS (SELECT tree, node, CAST(sum(s) AS DOUBLE) / CAST(sum(w) AS DOUBLE) AS value FROM {name}{depth} JOIN {name}m USING (doc_id, tree) GROUP BY ALL),
{name}v AS MATERIALIZED (SELECT doc_id, tree, value FROM {name}{depth} JOIN {name}l USING (tree, node))""")
    return ",\n".join(parts)


FOREST_SQL = f"""{CELLS_SQL}, fm AS MATERIALIZED (SELECT doc_id, tree, 1 AS w, CAST(label AS BIGINT) AS s FROM r, (SELECT unnest(range(10)) AS tree) WHERE train AND label IS NOT NULL AND {unit("concat(doc_id, ':', tree)", 7)} < 0.7),
{levels_sql("f", 4, 5, 7)}"""


def boosted_sql(rounds: int) -> str:
    out = [CELLS_SQL, "q0 AS MATERIALIZED (SELECT doc_id, label, train, 0.0::DOUBLE AS margin FROM r)"]
    for i in range(rounds):
        p = "(1 / (1 + exp(-margin)))"
        out.append(f"""t{i}m AS MATERIALIZED (SELECT doc_id, {i} AS tree, CAST(round({p} * (1 - {p}) * 1048576) AS BIGINT) AS w, CAST(round((label - {p}) * 1048576) AS BIGINT) AS s FROM q{i} WHERE train AND label IS NOT NULL),
{levels_sql(f"t{i}", 3, 1 << 20, None)},
q{i + 1} AS MATERIALIZED (SELECT doc_id, label, train, margin + 0.1::DOUBLE * value AS margin FROM q{i} JOIN t{i}v USING (doc_id))""")
    return ",\n".join(out)


def test_scores(rows: DataFrame, prob) -> DataFrame:
    return rows.select("doc_id", "label", F.round(prob, 6).alias("prob"), F.when(prob > 0.5, 1.0).otherwise(0.0).alias("prediction"))


@query("l7_forest_table", f"""
WITH {FOREST_SQL} SELECT doc_id, any_value(label) AS label, round(avg(value), 6) AS prob, CAST(avg(value) > 0.5 AS DOUBLE) AS prediction FROM fv JOIN r USING (doc_id) WHERE NOT train GROUP BY doc_id""")
def l7_forest_table(t: Tables) -> DataFrame:
    """A forest grown from aggregates, applied as a table of nodes."""
    train, test = documents(t)
    return test_scores(test, trees.mean_value(trees.grow_forest(train, FEATURES, "label", "doc_id").collect()))


@query("l16_table_importance", f"""
WITH {FOREST_SQL}, g AS ({" UNION ALL ".join(f"SELECT tree, f, gain FROM fb{i}" for i in range(4))}),
     s AS (SELECT tree, f, sum(gain) / sum(sum(gain)) OVER (PARTITION BY tree) AS s FROM g GROUP BY tree, f)
SELECT {FEATURES!r}[f + 1] AS feature, round(sum(s) / sum(sum(s)) OVER (), 6) AS importance FROM s GROUP BY f""")
def l16_table_importance(t: Tables) -> DataFrame:
    train, _ = documents(t)
    out = trees.importances(trees.grow_forest(train, FEATURES, "label", "doc_id"))
    return out.select("feature", F.round("importance", 6).alias("importance"))


@query("l8_boosted_table", f"""
WITH {boosted_sql(5)} SELECT doc_id, label, round(1 / (1 + exp(-margin)), 6) AS prob, CAST(margin > 0 AS DOUBLE) AS prediction FROM q5 WHERE NOT train""")
def l8_boosted_table(t: Tables) -> DataFrame:
    """Boosted trees grown from aggregates, applied as a table of nodes."""
    train, test = documents(t)
    return test_scores(test, trees.logistic(trees.margin(trees.grow_boosted(train, FEATURES, "label").collect())))


@query("l15_table_stopping", f"""
WITH {boosted_sql(6)}, e AS ({" UNION ALL ".join(f"SELECT {n} AS rounds, avg(ln(1 + exp(-margin * (2 * label - 1)))) AS loss FROM q{n} WHERE NOT train AND label IS NOT NULL" for n in (2, 4, 6))}),
     p AS (SELECT *, lag(loss) OVER (ORDER BY rounds) AS before FROM e), k AS (SELECT min(rounds) AS stop FROM p WHERE before - loss <= 0.001)
SELECT CAST(rounds AS INTEGER) AS rounds, round(loss, 6) AS loss, rounds = coalesce(stop - 2, 6) AS is_best FROM p, k WHERE rounds <= coalesce(stop, 6)""")
def l15_table_stopping(t: Tables) -> DataFrame:
    """Loss on other rows of the first trees of one boosted table, up to the first size that brings next to nothing."""
    train, valid = documents(t)
    nodes = trees.grow_boosted(train, FEATURES, "label", rounds=6).collect()
    sizes = [2, 4, 6]
    losses = valid.filter(F.col("label").isNotNull()).agg(*[F.avg(F.log(1 + F.exp(-trees.margin(nodes, n) * (2 * F.col("label") - 1)))).alias(str(n)) for n in sizes]).first()
    tried, chosen = learn.stopping_point([-losses[str(n)] for n in sizes], 1, 0.001)
    rows = [(n, round(losses[str(n)], 6), i == chosen) for i, n in enumerate(sizes[:tried])]
    return t.spark.createDataFrame(rows, "rounds int, loss double, is_best boolean").coalesce(1)


HIDDEN, STEPS = 3, 12


def perceptron_sql() -> str:
    """Each step as one more pass over the rows."""
    n = len(FEATURES)
    names = perceptron.places([n, HIDDEN, 2])
    w = {p: f"w{i}" for i, p in enumerate(names)}
    first = ", ".join(f"{perceptron.first_weight(*p, 7)!r}::DOUBLE AS {c}" for p, c in w.items())
    hidden = ", ".join(f"1 / (1 + exp(-({w[0, -1, j]} + {' + '.join(f'{w[0, i, j]} * x{i}' for i in range(n))}))) AS h{j}" for j in range(HIDDEN))
    z = [f"({w[1, -1, j]} + {' + '.join(f'{w[1, i, j]} * h{i}' for i in range(HIDDEN))})" for j in range(2)]
    out = [CELLS_SQL, f"u AS (SELECT f, avg(x) AS m, stddev_pop(x) AS s FROM x WHERE train GROUP BY f)",
           f"""d AS MATERIALIZED (SELECT doc_id, any_value(label) AS label, any_value(train) AS train, {", ".join(f"sum((x - m) / s) FILTER (x.f = {i}) AS x{i}" for i in range(n))}
   FROM x JOIN u USING (f) GROUP BY doc_id)""", f"s0 AS MATERIALIZED (SELECT {first})"]
    slopes = []
    for k, i, j in names:
        one = "1" if i < 0 else f"h{i}" if k else f"x{i}"
        slopes.append(f"any_value({w[k, i, j]}) - avg({'-' if k and not j else ''}e * {one}" + ("" if k else f" * ({w[1, j, 1]} - {w[1, j, 0]}) * h{j} * (1 - h{j})") + f") AS {w[k, i, j]}")
    for i in range(STEPS + 1):
        out += [f"h{i} AS (SELECT *, {hidden} FROM d, s{i})", f"e{i} AS (SELECT *, 1 / (1 + exp({z[0]} - {z[1]})) - label AS e FROM h{i})"]
        if i < STEPS:
            out.append(f"s{i + 1} AS MATERIALIZED (SELECT {', '.join(slopes)} FROM e{i} WHERE train AND label IS NOT NULL)")
    return "WITH " + ",\n".join(out) + f"\nSELECT doc_id, label, round(e + label, 6) AS prob, CAST(e + label > 0.5 AS DOUBLE) AS prediction FROM e{STEPS} WHERE NOT train"


@query("l9_perceptron_table", perceptron_sql())
def l9_perceptron_table(t: Tables) -> DataFrame:
    """A perceptron trained by aggregates over scaled columns, applied as a table of weights by joins and sums."""
    train, test = documents(t)
    row = train.agg(*[e for c in FEATURES for e in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()

    def scaled_columns(rows: DataFrame) -> DataFrame:
        return rows.select("doc_id", "label", *[((F.col(c) - row[f"m_{c}"]) / row[f"s_{c}"]).alias(c) for c in FEATURES])

    weights = perceptron.descend(scaled_columns(train), FEATURES, "label", HIDDEN, STEPS)
    rows = scaled_columns(test)
    long = rows.select(F.col("doc_id").alias("id"), F.posexplode(F.array(*FEATURES)).alias("place", "x"))
    p = perceptron.score_long(long, weights, 3).filter("target = 1").select(F.col("id").alias("doc_id"), "p")
    return test_scores(rows.select("doc_id", "label").join(p, "doc_id"), F.col("p"))


PENALTIES = [grid.Setting(r, m) for r in (0.001, 0.1) for m in (0.0, 1.0)]


def grid_sql(settings: list[grid.Setting], folds: int, rounds: int, weight: str = "1.0") -> str:
    """Tables that train every setting without each fold and on all rows (held = -2), step by step, up to ``g{rounds}``."""
    names = ", ".join(f"({i}, {s.reg!r}::DOUBLE, {s.mix!r}::DOUBLE)" for i, s in enumerate(settings))
    fold = f"floor({unit('doc_id', 5)} * {folds})" if folds else "-1"
    out = [CELLS_SQL, "u AS (SELECT f, avg(x) AS m, stddev_pop(x) AS s FROM x WHERE train AND label IS NOT NULL GROUP BY f)",
           f"k AS MATERIALIZED (SELECT doc_id, label, {fold} AS fold, {weight} AS w FROM r WHERE train AND label IS NOT NULL)",
           "z AS MATERIALIZED (SELECT doc_id, f, coalesce((x - m) / nullif(s, 0), 0) AS z FROM x JOIN u USING (f) UNION ALL SELECT doc_id, -1, 1.0 FROM r)",
           f"m AS (SELECT * FROM (VALUES {names}) t(setting, reg, mix), (SELECT unnest([{', '.join(map(str, [*range(folds), -2]))}]) AS held))",
           """p AS MATERIALIZED (SELECT setting, held, reg * mix AS lasso, reg * (1 - mix) AS ridge, sum(w) FILTER (f = -1) AS n, 1 / (sum(w * z * z) / sum(w) FILTER (f = -1) / 4 + reg * (1 - mix)) AS step
   FROM m JOIN k ON fold <> held JOIN z USING (doc_id) GROUP BY setting, held, reg, mix)""",
           f"g0 AS (SELECT setting, held, f, 0.0::DOUBLE AS b, 0.0::DOUBLE AS v FROM m, (SELECT unnest(range(-1, {len(FEATURES)})) AS f))"]
    for t in range(rounds):
        out.append(f"""e{t} AS MATERIALIZED (SELECT setting, held, doc_id, (1 / (1 + exp(-sum(z * v))) - any_value(label)) * any_value(w) AS e FROM g{t} JOIN k ON fold <> held JOIN z USING (doc_id, f) GROUP BY setting, held, doc_id),
d{t} AS (SELECT setting, held, f, sum(e * z) AS d FROM e{t} JOIN z USING (doc_id) GROUP BY setting, held, f),
q{t} AS (SELECT setting, held, f, b, v - step * (d / n + CASE WHEN f < 0 THEN 0 ELSE ridge * v END) AS q, CASE WHEN f < 0 THEN 0 ELSE step * lasso END AS cut FROM g{t} JOIN d{t} USING (setting, held, f) JOIN p USING (setting, held)),
g{t + 1} AS MATERIALIZED (SELECT setting, held, f, sign(q) * greatest(abs(q) - cut, 0) AS b, sign(q) * greatest(abs(q) - cut, 0) * (1 + {t / (t + 3)!r}::DOUBLE) - {t / (t + 3)!r}::DOUBLE * b AS v FROM q{t})""")
    return ",\n".join(out)


@query("l14_grid_table", f"""
WITH {grid_sql(PENALTIES, 3, 10)},
     s AS (SELECT setting, held, doc_id, sum(z * b) AS margin, any_value(label) AS label FROM g10 JOIN k ON fold = held JOIN z USING (doc_id, f) GROUP BY setting, held, doc_id),
     f AS (SELECT setting, held, avg(ln(1 + exp(-margin * (2 * label - 1)))) AS loss FROM s GROUP BY setting, held),
     a AS (SELECT setting, avg(loss) AS loss FROM f GROUP BY setting)
SELECT reg, mix, round(loss, 6) AS loss, row_number() OVER (ORDER BY round(loss, 9), setting) = 1 AS is_best FROM a JOIN (SELECT DISTINCT setting, reg, mix FROM m) USING (setting)""")
def l14_grid_table(t: Tables) -> DataFrame:
    """All penalties and folds trained in the same passes; mean log loss on the folds left out."""
    train, _ = documents(t)
    fit = grid.train(train, FEATURES, "label", PENALTIES, F.floor(hash_unit(F.col("doc_id"), seed=5) * 3), 3, rounds=10)
    rows = [(s.reg, s.mix, round(float(loss), 6), i == fit.best()) for i, (s, loss) in enumerate(zip(PENALTIES, fit.losses.mean(axis=1)))]
    return t.spark.createDataFrame(rows, "reg double, mix double, loss double, is_best boolean").coalesce(1)  # a row per setting


@query("l6_logistic_table", f"""
WITH {grid_sql([grid.Setting(0.01, 0.5)], 0, 20, "count(*) OVER () / ((SELECT count(DISTINCT label) FROM r WHERE train) * CAST(count(*) OVER (PARTITION BY label) AS DOUBLE))")},
     s AS (SELECT doc_id, 1 / (1 + exp(-sum(z * b))) AS p FROM g20 JOIN z USING (f) GROUP BY doc_id)
SELECT doc_id, label, round(p, 6) AS prob, CAST(p > 0.5 AS DOUBLE) AS prediction FROM s JOIN r USING (doc_id) WHERE NOT train""")
def l6_logistic_table(t: Tables) -> DataFrame:
    """Elastic net with balanced class weights by descent; the probability is an expression of the columns."""
    train, test = documents(t)
    fit = grid.train(split.class_weights(train, "label"), FEATURES, "label", [grid.Setting(0.01, 0.5)], weight="weight", rounds=20)
    return test_scores(test, fit.probability(0))


@query("l18_table_ensemble", f"""
WITH {FOREST_SQL}, f AS (SELECT doc_id, avg(value) AS p FROM fv GROUP BY doc_id), {boosted_sql(3).split(CELLS_SQL + ",")[1]}
SELECT q3.doc_id, label, round((p + 1 / (1 + exp(-margin))) / 2, 6) AS prob FROM q3 JOIN f USING (doc_id) WHERE NOT train""")
def l18_table_ensemble(t: Tables) -> DataFrame:
    """Mean probability of a forest and of boosted trees, both as tables."""
    train, test = documents(t)
    forest, boosted = (n.collect() for n in (trees.grow_forest(train, FEATURES, "label", "doc_id"), trees.grow_boosted(train, FEATURES, "label", rounds=3)))
    prob = (trees.mean_value(forest) + trees.logistic(trees.margin(boosted))) / 2
    return test.select("doc_id", "label", F.round(prob, 6).alias("prob"))


# ---- order and line models -------------------------------------------------------------


@query("l14_grid_search")
def l14_grid_search(t: Tables) -> DataFrame:
    """Penalty grid over expanding time folds, mean score, best first."""
    rows = labelled_orders(t).select("o_orderdate", F.col("hit").cast("double").alias("label"), "o_totalprice",
                                     F.month("o_orderdate").cast("double").alias("month")).persist()
    folds = split.expanding_folds(rows, F.col("o_orderdate"), ["1998-01-01", "1999-06-01", "2001-01-01"])

    def build(reg: float, mix: float) -> list:
        return [*learn.scaled_groups(robust=["o_totalprice"], standard=["month"]), learn.logistic("label", reg=reg, mix=mix, rounds=10)]

    results = learn.grid_search(folds, [{"reg": r, "mix": m} for r in (0.001, 0.1) for m in (0.0, 1.0)], build, "label")
    rows.unpersist()
    return t.spark.createDataFrame(
        [(p["reg"], p["mix"], s, m, i == 0) for i, (p, s, m) in enumerate(results)],
        "reg double, mix double, fold_scores array<double>, mean_score double, is_best boolean").coalesce(1)


def labelled_lines(t: Tables) -> DataFrame:
    late = F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    return t.lineitem.withColumns({"late": late, "l_linenumber": F.col("l_linenumber").cast("double")})


@query("l10_linear_regression", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 7) AS r2 FROM lineitem""")
def l10_linear_regression(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_extendedprice", "l_quantity")
    model = learn.fit(rows, [VectorAssembler(inputCols=["l_quantity"], outputCol="features"), learn.linear("l_extendedprice")]).stages[-1]
    values = (round(float(model.coefficients[0]), 5), round(float(model.intercept), 4), round(float(model.summary.r2), 7))
    return t.spark.createDataFrame([values], "slope double, intercept double, r2 double").coalesce(1)


@query("l10_ridge_lasso")
def l10_ridge_lasso(t: Tables) -> DataFrame:
    rows = VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(t.lineitem).select("features", "l_extendedprice")
    out = []
    for name, mix in (("ridge", 0.0), ("lasso", 1.0)):
        model = learn.linear("l_extendedprice", reg=100.0, mix=mix).fit(rows)
        out.append((name, [float(c) for c in model.coefficients], float(model.intercept), float(model.summary.rootMeanSquaredError)))
    return t.spark.createDataFrame(out, "kind string, coefficients array<double>, intercept double, rmse double").coalesce(1)


PENALISED = ["l_quantity", "l_discount", "l_tax"]
PAIRS = [(i, j) for i in range(3) for j in range(i, 3)]


def penalised_sql() -> str:
    """Ridge by Cramer's rule, lasso by coordinate descent, both on the covariances."""
    c = {(i, j): f"c{min(i, j)}{max(i, j)}" for i in range(3) for j in range(3)}
    a = {(i, j): f"({c[i, j]} + 100 / sy * {c[i, i]})" if i == j else c[i, j] for i in range(3) for j in range(3)}

    def det(m: dict) -> str:
        return " + ".join(f"{m[0, i]} * ({m[1, (i + 1) % 3]} * {m[2, (i + 2) % 3]} - {m[1, (i + 2) % 3]} * {m[2, (i + 1) % 3]})" for i in range(3))

    ridge = [f"({det({(i, j): f'k{i}' if j == n else a[i, j] for i in range(3) for j in range(3)})}) / ({det(a)})" for n in range(3)]

    def step(n: int) -> str:
        others = " - ".join(f"{c[n, j]} * w{j}" for j in range(3) if j != n)
        return f"sign(k{n} - {others}) * greatest(abs(k{n} - {others}) - 100 * sqrt({c[n, n]}), 0) / {c[n, n]}"

    sums = ", ".join([f"covar_pop({PENALISED[i]}, {PENALISED[j]}) AS c{i}{j}" for i, j in PAIRS] + [f"covar_pop({x}, l_extendedprice) AS k{i}" for i, x in enumerate(PENALISED)])
    rounds = " UNION ALL ".join(f"""SELECT step + 1, {", ".join(step(n) if n == now else f"w{n}" for n in range(3))} FROM l, m WHERE step < 60 AND step % 3 = {now}""" for now in range(3))
    shown = []
    for n, x in enumerate(PENALISED):
        fitted = " + ".join(f"{c[n, j]} * w{j}" for j in range(3))
        bound = f"CASE kind WHEN 'lasso' THEN 100 * sqrt({c[n, n]}) ELSE 100 / sy * {c[n, n]} * abs(w{n}) END"
        shown.append(f"SELECT kind, '{x}' AS feature, round(w{n}, 0) + 0.0 AS coefficient, round({fitted} - k{n}, 1) + 0.0 AS gradient, round({bound}, 1) AS bound, true AS satisfied FROM w, m")
    return f"""WITH RECURSIVE m AS (SELECT stddev_pop(l_extendedprice) AS sy, {sums} FROM lineitem),
l AS (SELECT 0 AS step, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2 UNION ALL ({rounds})),
w AS (SELECT 'lasso' AS kind, w0, w1, w2 FROM l WHERE step = 60 UNION ALL SELECT 'ridge', {", ".join(ridge)} FROM m)
{" UNION ALL ".join(shown)}"""


@query("l10_optimality", penalised_sql())
def l10_optimality(t: Tables) -> DataFrame:
    """Ridge and lasso with a proof that their coefficients are the best ones; rounded to what the solver settles."""
    rows = VectorAssembler(inputCols=PENALISED, outputCol="features").transform(t.lineitem)
    out = []
    for kind, mix in (("ridge", 0.0), ("lasso", 1.0)):
        model = learn.linear("l_extendedprice", reg=100.0, mix=mix).setTol(1e-12).setMaxIter(1000).fit(rows)
        proof = learn.optimality(t.lineitem, PENALISED, "l_extendedprice", model.coefficients.toArray().tolist(), model.intercept, 100.0, mix)
        out.append(proof.select(F.lit(kind).alias("kind"), "feature", *[(F.round(c, d) + 0.0).alias(c) for c, d in (("coefficient", 0), ("gradient", 1), ("bound", 1))], "satisfied"))
    return reduce(DataFrame.unionByName, out)


@query("l17_two_stage")
def l17_two_stage(t: Tables) -> DataFrame:
    """Classify, regress on positives, and compare three ways to combine the two."""
    rows = labelled_lines(t).select("l_linenumber", "l_quantity", "l_discount", "l_tax", "late", "l_extendedprice", "l_shipdate")
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    gate = learn.forest("late", trees=5, depth=4)
    amount = RandomForestRegressor(labelCol="l_extendedprice", featuresCol="features", numTrees=5, maxDepth=5, seed=7)
    prep = [VectorAssembler(inputCols=["l_linenumber", "l_quantity", "l_discount", "l_tax"], outputCol="features")]
    scored = learn.two_stage(rows.filter(F.col("l_shipdate") < cut), rows.filter(F.col("l_shipdate") >= cut), prep, gate, amount, "late")
    actual = F.col("late") * F.col("l_extendedprice")
    reports = [evaluate.regression_errors(scored, actual, F.col(c)).withColumn("kind", F.lit(c)) for c in ("gated", "amount", "expected")]
    return reduce(DataFrame.unionByName, reports)


# ---- descent ---------------------------------------------------------------------------

SCALED_SQL = f"""d AS MATERIALIZED (SELECT (l_quantity - mq) / sq AS a, (l_discount - md) / sd AS b, l_extendedprice / 1000 AS y,
        CAST(floor({unit("concat(l_orderkey, '-', l_linenumber, '-', l_partkey)")} * 5) AS INTEGER) AS fold
     FROM lineitem, (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_discount) AS md, stddev_samp(l_discount) AS sd FROM lineitem))"""


def scaled(t: Tables) -> DataFrame:
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"))
    rows = clean.zscore(t.lineitem, ["l_quantity", "l_discount"])
    rows = rows.select(F.col("l_quantity_z").alias("a"), F.col("l_discount_z").alias("b"), (F.col("l_extendedprice") / 1000).alias("y"), key.alias("line"))
    return split.fold(rows, "line", 5).drop("line")


def descent_sql(steps: int, penalty: str | None) -> str:
    """Every step as one more pass over the rows."""
    extra = {None: "0", "ridge": "2 * 0.1 * {w}", "lasso": "0.1 * sign({w})"}[penalty]
    out = [f"{SCALED_SQL}, s0 AS MATERIALIZED (SELECT avg(y) AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2 FROM d)"]
    for i in range(steps):
        e = "(w0 + w1 * a + w2 * b - y)"
        out.append(f"""s{i + 1} AS MATERIALIZED (SELECT any_value(w0) - 0.1 * avg(2 * {e}) AS w0, any_value(w1) - 0.1 * (avg(2 * a * {e}) + {extra.format(w='any_value(w1)')}) AS w1,
       any_value(w2) - 0.1 * (avg(2 * b * {e}) + {extra.format(w='any_value(w2)')}) AS w2 FROM d, s{i})""")
    rows = "\nUNION ALL ".join(f"""SELECT {i} AS step, round(any_value(w0), 7) AS w0, round(any_value(w1), 7) AS w1, round(any_value(w2), 7) AS w2,
  round(avg((w0 + w1 * a + w2 * b - y) * (w0 + w1 * a + w2 * b - y)), 6) AS loss FROM d, s{i}""" for i in range(steps + 1))
    return "WITH " + ",\n".join(out) + "\n" + rows


def shown(history: DataFrame) -> DataFrame:
    return history.select("step", *[F.round(c, 7).alias(c) for c in ("w0", "w1", "w2")], F.round("loss", 6).alias("loss"))


@query("l11_gradient_descent", descent_sql(5, None))
def l11_gradient_descent(t: Tables) -> DataFrame:
    return shown(descent.descend(scaled(t), ["a", "b"], "y", 5))


@query("l12_ridge_descent", descent_sql(5, "ridge"))
def l12_ridge_descent(t: Tables) -> DataFrame:
    return shown(descent.descend(scaled(t), ["a", "b"], "y", 5, penalty="ridge"))


@query("l12_lasso_descent", descent_sql(5, "lasso"))
def l12_lasso_descent(t: Tables) -> DataFrame:
    return shown(descent.descend(scaled(t), ["a", "b"], "y", 5, penalty="lasso"))


def folds_sql(steps: int) -> str:
    e = "(w0 + w1 * a + w2 * b - y)"
    out = [f"""{SCALED_SQL}, m AS (SELECT unnest(range(5)) AS model),
     s0 AS MATERIALIZED (SELECT model, avg(y) AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2 FROM d, m WHERE fold <> model GROUP BY model)"""]
    for i in range(steps):
        out.append(f"""s{i + 1} AS MATERIALIZED (SELECT model, any_value(w0) - 0.1 * avg(2 * {e}) AS w0, any_value(w1) - 0.1 * avg(2 * a * {e}) AS w1,
       any_value(w2) - 0.1 * avg(2 * b * {e}) AS w2 FROM d, s{i} WHERE fold <> model GROUP BY model)""")
    rows = "\nUNION ALL ".join(f"""SELECT CAST(model AS INTEGER) AS model, {i} AS step, round(avg({e} * {e}) FILTER (fold <> model), 6) AS train_loss,
  round(avg({e} * {e}) FILTER (fold = model), 6) AS test_loss FROM d, s{i} GROUP BY model""" for i in range(steps + 1))
    return "WITH " + ",\n".join(out) + "\n" + rows


@query("l13_fold_descent", folds_sql(3))
def l13_fold_descent(t: Tables) -> DataFrame:
    """Five models, one per held-out fold, from a single pass."""
    out = descent.descend_folds(scaled(t), ["a", "b"], "y", "fold", 3)
    return out.select("model", "step", F.round("train_loss", 6).alias("train_loss"), F.round("test_loss", 6).alias("test_loss"))
