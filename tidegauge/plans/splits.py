"""Sampling, splits, class balance, target encoding and threshold evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import hash_unit
from ..operators import encode, evaluate, split
from .registry import Tables, query


def unit(key: str, seed: int = 0) -> str:
    """The hash draw as SQL."""
    return f"(CAST(concat('0x', substr(md5(concat({key}, ':{seed}')), 1, 8)) AS BIGINT) / 4294967296.0)"


@query("b1_bernoulli_sample", f"SELECT event_id, value FROM events WHERE {unit('event_id')} < 0.25")
def b1_bernoulli_sample(t: Tables) -> DataFrame:
    return split.bernoulli(t.events.select("event_id", "value"), "event_id", 0.25)


@query("b2_stratified_sample", f"SELECT doc_id, quality, toxic FROM labels WHERE {unit('doc_id')} < CASE quality WHEN 1 THEN 0.2 WHEN 0 THEN 0.9 ELSE 0 END")
def b2_stratified_sample(t: Tables) -> DataFrame:
    return split.stratified(t.labels, "doc_id", "quality", {1: 0.2, 0: 0.9})


@query("b3_exact_per_class", f"SELECT doc_id, quality, toxic FROM labels QUALIFY row_number() OVER (PARTITION BY quality ORDER BY {unit('doc_id')}, doc_id) <= 40")
def b3_exact_per_class(t: Tables) -> DataFrame:
    return split.exact_per_class(t.labels, "doc_id", "quality", 40)


LINE = "o_orderkey"
HIT = "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END"


def labelled_orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice",
                           F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("hit"))


@query("b4_undersample", f"""
WITH o AS (SELECT o_orderkey, {HIT} AS hit FROM orders), c AS (SELECT count(*) FILTER (hit = 1) AS p, count(*) FILTER (hit = 0) AS n FROM o)
SELECT o_orderkey, hit FROM o, c WHERE hit = 1 OR {unit('o_orderkey')} < (p * (1 - 0.4) / 0.4) / n""")
def b4_undersample(t: Tables) -> DataFrame:
    return split.undersample(labelled_orders(t), "o_orderkey", "hit", 0.4).select("o_orderkey", "hit")


LINE_KEY = "concat(l_orderkey, '-', l_linenumber, '-', l_partkey)"


def keyed_lines(t: Tables) -> DataFrame:
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"))
    return t.lineitem.withColumn("line", key)


@query("b5_random_split", f"SELECT {LINE_KEY} AS line, CASE WHEN {unit(LINE_KEY)} < 0.8 THEN 'train' ELSE 'test' END AS split FROM lineitem")
def b5_random_split(t: Tables) -> DataFrame:
    return split.hash_split(keyed_lines(t), "line", {"train": 0.8, "test": 0.2}).select("line", "split")


@query("b6_folds", f"SELECT {LINE_KEY} AS line, CAST(floor({unit(LINE_KEY)} * 5) AS INTEGER) AS fold FROM lineitem")
def b6_folds(t: Tables) -> DataFrame:
    return split.fold(keyed_lines(t), "line", 5).select("line", "fold")


SPLIT = "CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train' WHEN o_orderdate < TIMESTAMP '2000-06-01' THEN 'valid' ELSE 'test' END"


def split_orders(t: Tables) -> DataFrame:
    return split.time_split(labelled_orders(t), F.col("o_orderdate"), "1999-01-01", "2000-06-01")


@query("b7_time_split", f"SELECT o_orderkey, {SPLIT} AS split FROM orders")
def b7_time_split(t: Tables) -> DataFrame:
    return split_orders(t).select("o_orderkey", "split")


EDGES = ["1997-01-01", "1998-01-01", "1999-01-01", "2000-01-01", "2001-01-01"]


@query("b8_expanding_folds", "\nUNION ALL ".join(
    f"""SELECT {i} AS fold, count(*) FILTER (o_orderdate < TIMESTAMP '{a}') AS n_train, count(*) FILTER (o_orderdate >= TIMESTAMP '{a}' AND o_orderdate < TIMESTAMP '{b}') AS n_valid,
  round(avg({HIT}) FILTER (o_orderdate < TIMESTAMP '{a}'), 9) AS train_rate FROM orders"""
    for i, (a, b) in enumerate(zip(EDGES, EDGES[1:]))))
def b8_expanding_folds(t: Tables) -> DataFrame:
    out = None
    for i, (train, valid) in enumerate(split.expanding_folds(labelled_orders(t), F.col("o_orderdate"), EDGES)):
        both = train.withColumn("part", F.lit("t")).unionByName(valid.withColumn("part", F.lit("v")))
        row = both.agg(F.lit(i).alias("fold"), F.count(F.when(F.col("part") == "t", 1)).alias("n_train"),
                       F.count(F.when(F.col("part") == "v", 1)).alias("n_valid"),
                       F.round(F.avg(F.when(F.col("part") == "t", F.col("hit"))), 9).alias("train_rate"))
        out = row if out is None else out.unionByName(row)
    return out


@query("b9_split_ranges", f"""
SELECT *, CASE WHEN "first" <= lag("last") OVER (ORDER BY "first") THEN 1 ELSE 0 END AS overlaps
FROM (SELECT {SPLIT} AS split, count(*) AS n, min(o_orderdate) AS "first", max(o_orderdate) AS "last" FROM orders GROUP BY 1)""")
def b9_split_ranges(t: Tables) -> DataFrame:
    return split.split_ranges(split_orders(t), "o_orderdate")


@query("b10_class_weights", """
SELECT doc_id, quality, round((SELECT count(*) FROM labels) / (2.0 * count(*) OVER (PARTITION BY quality)), 9) AS weight FROM labels""")
def b10_class_weights(t: Tables) -> DataFrame:
    return split.class_weights(t.labels, "quality").select("doc_id", "quality", F.round("weight", 9).alias("weight"))


@query("b11_random_draw", f"SELECT doc_id, n_chars FROM documents ORDER BY {unit('doc_id')}, doc_id LIMIT 15")
def b11_random_draw(t: Tables) -> DataFrame:
    return split.draw(t.documents.select("doc_id", "n_chars"), "doc_id", 15)


# ---- target and frequency encoding -----------------------------------------------------

@query("l1_target_encoding", f"""
WITH o AS (SELECT o_orderkey, o_custkey, {HIT} AS hit, {SPLIT} AS split FROM orders), g AS (SELECT avg(hit) AS g FROM o WHERE split = 'train'),
     s AS (SELECT o_custkey, count(*) AS n, avg(hit) AS m FROM o WHERE split = 'train' GROUP BY o_custkey)
SELECT o_orderkey, split, round(coalesce((m * n + g * 100) / (n + 100), g), 9) AS encoded FROM o CROSS JOIN g LEFT JOIN s USING (o_custkey)""")
def l1_target_encoding(t: Tables) -> DataFrame:
    rows = split_orders(t)
    out = encode.target_encode(rows.filter(F.col("split") == "train"), rows, ["o_custkey"], "hit", 100.0)
    return out.select("o_orderkey", "split", F.round("o_custkey_te", 9).alias("encoded"))


@query("l2_frequency_encoding", "SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_partkey) AS l_partkey_n FROM lineitem")
def l2_frequency_encoding(t: Tables) -> DataFrame:
    return encode.frequency_encode(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey").drop("l_partkey")


# ---- evaluation ------------------------------------------------------------------------
# The score is the target-encoded rate of the customer, spread by a hash so that it has many values.

SCORED = f"""scored AS (SELECT o_orderkey, {HIT} AS hit, round(0.3 * {HIT} + 0.7 * {unit('o_orderkey', 5)}, 3) AS score FROM orders)"""


def scored(t: Tables) -> DataFrame:
    rows = labelled_orders(t)
    return rows.withColumn("score", F.round(0.3 * F.col("hit") + 0.7 * hash_unit(F.col("o_orderkey"), seed=5), 3))


def rates_sql(source: str, keys: str = "") -> str:
    """Rates from tp, fp, fn, tn; an empty ratio is 0."""
    p, r = "coalesce(1.0 * tp / nullif(tp + fp, 0), 0)", "coalesce(1.0 * tp / nullif(tp + fn, 0), 0)"

    def f(b: float) -> str:
        return f"round(coalesce({1 + b * b} * {p} * {r} / nullif({b * b} * {p} + {r}, 0), 0), 9)"

    return f"""SELECT {keys} tp, fp, fn, tn, round(coalesce(1.0 * (tp + tn) / nullif(tp + fp + fn + tn, 0), 0), 9) AS accuracy, round({p}, 9) AS "precision", round({r}, 9) AS recall,
  {f(0.5)} AS f0_5, {f(1.0)} AS f1, {f(2.0)} AS f2 FROM {source}"""


COUNTS = """count(*) FILTER (score >= {t} AND hit = 1) AS tp, count(*) FILTER (score >= {t} AND hit = 0) AS fp,
  count(*) FILTER (score < {t} AND hit = 1) AS fn, count(*) FILTER (score < {t} AND hit = 0) AS tn"""
GRID = [round(0.05 * i, 2) for i in range(1, 20)]


@query("e1_confusion", f"WITH {SCORED}, c AS (SELECT {COUNTS.format(t=0.5)} FROM scored) " + rates_sql("c"))
def e1_confusion(t: Tables) -> DataFrame:
    return evaluate.confusion(scored(t), "hit", F.col("score") >= 0.5)


@query("e2_threshold_sweep", f"WITH {SCORED}, c AS (SELECT CAST(t.threshold AS DOUBLE) AS threshold, {COUNTS.format(t='t.threshold')} FROM scored, (SELECT CAST(unnest({GRID}) AS DOUBLE) AS threshold) t GROUP BY t.threshold) " + rates_sql("c", "threshold,"))
def e2_threshold_sweep(t: Tables) -> DataFrame:
    return evaluate.threshold_sweep(scored(t), "hit", "score", GRID)


@query("e2_best_threshold", f"WITH {SCORED}, c AS (SELECT t.threshold, {COUNTS.format(t='t.threshold')} FROM scored, (SELECT CAST(unnest({GRID}) AS DOUBLE) AS threshold) t GROUP BY t.threshold), r AS ("
       + rates_sql("c", "threshold,") + ") SELECT threshold, f2 FROM r ORDER BY f2 DESC, threshold LIMIT 1")
def e2_best_threshold(t: Tables) -> DataFrame:
    sweep = evaluate.threshold_sweep(scored(t), "hit", "score", GRID)
    return evaluate.best_threshold(sweep, "f2").select("threshold", "f2")


@query("e3_auc", f"""
WITH {SCORED}, r AS (SELECT hit, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM scored),
     p AS (SELECT count(*) FILTER (hit = 1) AS p, count(*) FILTER (hit = 0) AS n FROM scored),
     v AS (SELECT score, count(*) FILTER (hit = 1) AS pos, count(*) AS rows_ FROM scored GROUP BY score),
     k AS (SELECT pos, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(rows_) OVER (ORDER BY score DESC) AS above FROM v)
SELECT round(((SELECT sum(rk) FROM r WHERE hit = 1) - p * (p + 1) / 2.0) / (p * n), 9) AS auc_roc,
       round((SELECT sum(pos * tp / above) FROM k) / p, 9) AS avg_precision, p AS n_pos, n AS n_neg FROM p""")
def e3_auc(t: Tables) -> DataFrame:
    return evaluate.auc(scored(t), "hit", "score")


PREDICTED = "l_quantity * 1500 + l_linenumber * 10"


def predicted() -> Column:
    return F.col("l_quantity") * 1500 + F.col("l_linenumber") * 10


@query("e5_regression_errors", f"""
SELECT count(*) AS n, round(avg(e * e), 2) AS mse, round(sqrt(avg(e * e)), 2) AS rmse, round(avg(abs(e)), 2) AS mae, round(1 - avg(e * e) / var_pop(l_extendedprice), 9) AS r2
FROM (SELECT l_extendedprice, l_extendedprice - ({PREDICTED}) AS e FROM lineitem)""")
def e5_regression_errors(t: Tables) -> DataFrame:
    return evaluate.regression_errors(t.lineitem, F.col("l_extendedprice"), predicted(), digits=2)


@query("e6_residuals", f"""
SELECT l_quantity AS actual, count(*) AS n, round(avg(l_quantity - l_extendedprice / 1500), 6) AS mean_residual, round(avg(abs(l_quantity - l_extendedprice / 1500)), 6) AS mean_abs_residual
FROM lineitem GROUP BY l_quantity""")
def e6_residuals(t: Tables) -> DataFrame:
    return evaluate.residuals_by_actual(t.lineitem, F.col("l_quantity"), F.col("l_extendedprice") / 1500)
