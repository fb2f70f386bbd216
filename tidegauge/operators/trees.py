"""Tree ensembles as tables: one row per node, whatever grew them.

A fitted Spark ML forest or boosted model becomes such a table (``node_table``), and ``grow_forest`` and ``grow_boosted``
make one from aggregates alone. Rows are scored by columns built from the table (``walk``), so a model needs
no library to be applied: any engine that can join can walk it.

Growing works level by level, for all trees of a forest in one pass: each row adds to one histogram cell per tree and feature, cells combine
map-side, and what reaches the driver is one best split per node. Values are cut at exact quantiles. The draws (which rows a tree sees, which
features a node may use) come from a hash of the key, and all sums are of whole numbers (gradients in steps of 2^-20),
so the same rows give the same trees in any order, on any cluster, and after a lost executor.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import hash_unit
from ..session import cut_lineage
from .quantiles import exact_quantiles

#: ``at_most``: rows with feature <= at_most go left; null features count as 0. A leaf has no feature.
NODES = "tree int, node int, feature string, at_most double, left int, right int, value double, weight double, gain double"
#: Gradients are whole multiples of one part in this many.
GRAIN = 1 << 20
ROOT = 1


def node_table(model, names: Sequence[str], path: str) -> DataFrame:
    """The nodes of a fitted Spark ML forest or boosted model, through its saved form at ``path``.

    A forest's leaf value is the share of the positive class. ``gain`` is the gain of the node times its weight of rows.
    """
    model.write().save(path)
    spark = SparkSession.getActiveSession()
    data = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
    if "Forest" in type(model).__name__ and getattr(model, "numClasses", 0) == 2:  # counts of both classes
        count = F.col("impurityStats")[0] + F.col("impurityStats")[1]
        value = F.col("impurityStats")[1] / count
    else:  # count, sum and sum of squares
        count, value = F.col("impurityStats")[0], F.col("prediction")
    inner = F.col("leftChild") >= 0
    feature = F.array(*[F.lit(n) for n in names])[F.col("split.featureIndex")]
    return data.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.when(inner, feature).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("at_most"), F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"), value.alias("value"), weights[F.col("treeID")].alias("weight"), F.when(inner, F.col("gain") * count).alias("gain"))


def _paths(nodes: Sequence, root: int, go_left: Callable[[object], Column], end: Callable[[object], Column]) -> Column:
    by_number = {n["node"]: n for n in nodes}

    def below(number: int) -> Column:
        n = by_number[number]
        return end(n) if n["feature"] is None else F.when(go_left(n), below(n["left"])).otherwise(below(n["right"]))

    return below(root)


def by_tree(nodes: Sequence) -> dict[int, list]:
    out: dict[int, list] = {}
    for n in nodes:
        out.setdefault(n["tree"], []).append(n)
    return dict(sorted(out.items()))


def walk(nodes: Sequence) -> dict[int, Column]:
    """For each tree the value that a row ends at. ``nodes`` are collected rows: a model has few, fixed by its parameters."""
    trees = by_tree(nodes)
    return {t: _paths(own, min(n["node"] for n in own), lambda n: F.coalesce(F.col(n["feature"]), F.lit(0.0)) <= F.lit(n["at_most"]), lambda n: F.lit(n["value"]))
            for t, own in trees.items()}


def _sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns, F.lit(0.0))


def mean_value(nodes: Sequence) -> Column:
    """A forest's probability."""
    ends = walk(nodes)
    return _sum(list(ends.values())) / len(ends)


def margin(nodes: Sequence, trees: int | None = None) -> Column:
    """Weighted sum of the first ``trees`` trees."""
    weight = {n["tree"]: n["weight"] for n in nodes}
    return _sum([F.lit(weight[t]) * c for i, (t, c) in enumerate(walk(nodes).items()) if trees is None or i < trees])


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def importances(nodes: DataFrame, per_tree: bool = True) -> DataFrame:
    """(feature, importance), summing to one: gains as shares of their tree, added up, or (boosted models) gains added up as they are."""
    gains = nodes.filter(F.col("feature").isNotNull()).groupBy("tree", "feature").agg(F.sum("gain").alias("g"))
    share = F.col("g") / F.sum("g").over(W.partitionBy("tree")) if per_tree else F.col("g")
    shares = gains.withColumn("s", share).groupBy("feature").agg(F.sum("s").alias("s"))
    return shares.select("feature", (F.col("s") / F.sum("s").over(W.partitionBy())).alias("importance"))  # one row per feature


def cut_points(rows: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    wanted = {f"{i}_{p}": (F.coalesce(F.col(c).cast("double"), F.lit(0.0)), p / bins) for i, c in enumerate(features) for p in range(1, bins)}
    found = exact_quantiles(rows, wanted)
    return {c: sorted({found[f"{i}_{p}"] for p in range(1, bins)} - {None}) for i, c in enumerate(features)}


def binned(rows: DataFrame, cuts: dict[str, list[float]], keep: Sequence[Column]) -> DataFrame:
    """The columns to keep, and ``_b<i>``: how many cut points of feature i lie below the value."""
    columns = []
    for i, (c, points) in enumerate(cuts.items()):
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        below = F.size(F.filter(F.array(*[F.lit(p) for p in points]), lambda p: p < x)) if points else F.lit(0)
        columns.append(below.alias(f"_b{i}"))
    return rows.select(*keep, *columns)


def _grow(rows: DataFrame, cuts: dict[str, list[float]], trees: dict[int, tuple[Column, Column]], depth: int, least: float, share: float, seed: int, weight: float) -> list[dict]:
    """Nodes of trees grown level by level; each tree has a column of whole weights and one of whole sums."""
    features, number = list(cuts), {c: i for i, c in enumerate(cuts)}
    first = rows.agg(*[F.sum(x).alias(f"{kind}{t}") for t, pair in trees.items() for kind, x in zip("ws", pair)]).first()
    nodes = {t: {ROOT: leaf(t, ROOT, first[f"w{t}"], first[f"s{t}"], weight)} for t in trees}
    for level in range(depth):
        places = {t: _paths(list(own.values()), ROOT, lambda n: F.col(f"_b{number[n['feature']]}") <= F.lit(n["bin"]), lambda n: F.lit(n["node"])) for t, own in nodes.items()}
        per_tree = F.explode(F.array(*[F.struct(F.lit(t).alias("tree"), places[t].alias("node"), w.alias("w"), s.alias("s")) for t, (w, s) in trees.items()])).alias("at")
        bins = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"_b{i}").alias("bin")) for i in range(len(features))])
        live = rows.select(per_tree, bins.alias("bins")).filter((F.col("at.w") > 0) & (F.col("at.node") >= 1 << level))
        cells = live.select("at.*", F.inline("bins")).groupBy("tree", "node", "feature", "bin").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
        found = best_splits(cells, least, share, seed).collect()  # at most 2^level rows per tree
        for r in found:
            t, n = r["tree"], r["node"]
            name = features[r["feature"]]
            nodes[t][n] |= {"feature": name, "bin": r["bin"], "at_most": cuts[name][r["bin"]], "left": 2 * n, "right": 2 * n + 1, "gain": r["gain"]}
            nodes[t][2 * n] = leaf(t, 2 * n, r["lw"], r["ls"], weight)
            nodes[t][2 * n + 1] = leaf(t, 2 * n + 1, r["rw"], r["rs"], weight)
        if not found:
            break
    return [n for own in nodes.values() for n in own.values()]


def leaf(tree: int, node: int, w: int | None, s: int | None, weight: float) -> dict:
    return {"tree": tree, "node": node, "feature": None, "at_most": None, "left": None, "right": None, "value": s / w if w else 0.0, "weight": weight, "gain": None}


def best_splits(cells: DataFrame, least: float, share: float, seed: int) -> DataFrame:
    """The split with the largest gain of each node; ties by feature, then bin."""
    up = W.partitionBy("tree", "node", "feature").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy("tree", "node", "feature")
    sides = cells.filter(hash_unit(F.col("tree"), F.col("node"), F.col("feature"), seed=seed) < share).select(
        "tree", "node", "feature", "bin", F.sum("w").over(up).alias("lw"), F.sum("s").over(up).alias("ls"), F.sum("w").over(whole).alias("w"), F.sum("s").over(whole).alias("s"))
    sides = sides.withColumns({"rw": F.col("w") - F.col("lw"), "rs": F.col("s") - F.col("ls")}).filter((F.col("lw") >= least) & (F.col("rw") >= least))

    def part(s: str, w: str) -> Column:
        x = F.col(s).cast("double")
        return x * x / F.col(w).cast("double")

    sides = sides.withColumn("gain", part("ls", "lw") + part("rs", "rw") - part("s", "w")).filter("gain > 1e-9")
    place = F.row_number().over(W.partitionBy("tree", "node").orderBy(F.desc("gain"), "feature", "bin"))
    return sides.withColumn("place", place).filter("place = 1")


def _table(spark: SparkSession, nodes: list[dict]) -> DataFrame:
    names = [c.split()[0] for c in NODES.split(", ")]
    return spark.createDataFrame([tuple(n[c] for c in names) for n in nodes], NODES).coalesce(1)


def grow_forest(rows: DataFrame, features: Sequence[str], label: str, key: str, trees: int = 10, depth: int = 4, bins: int = 16, least: int = 5,
                seen: float = 0.7, share: float = 0.6, seed: int = 7) -> DataFrame:
    """A forest on a label of 0 and 1: a tree sees the rows, a node the features, that a hash draws. Rows without a label are left out."""
    rows = rows.filter(F.col(label).isNotNull())
    cuts = cut_points(rows, features, bins)
    table = cut_lineage(binned(rows, cuts, [F.col(key).alias("_key"), F.col(label).cast("long").alias("_y")]))
    drawn = {t: (hash_unit(F.col("_key"), F.lit(t), seed=seed) < seen).cast("long") for t in range(trees)}
    nodes = _grow(table, cuts, {t: (w, w * F.col("_y")) for t, w in drawn.items()}, depth, least, share, seed, 1.0 / trees)
    return _table(rows.sparkSession, nodes)


def grow_boosted(rows: DataFrame, features: Sequence[str], label: str, rounds: int = 5, depth: int = 3, bins: int = 16, step: float = 0.1, least: float = 1.0) -> DataFrame:
    """Boosted trees for the logistic loss; each leaf takes one Newton step. ``least``: second derivatives in a leaf."""
    rows = rows.filter(F.col(label).isNotNull())
    cuts = cut_points(rows, features, bins)
    table = cut_lineage(binned(rows, cuts, [F.col(label).cast("double").alias("_y"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]]))
    nodes: list[dict] = []
    for t in range(rounds):
        p = logistic(margin(nodes))
        slope, curve = (F.round(x * GRAIN).cast("long") for x in (F.col("_y") - p, p * (1 - p)))
        known = cut_lineage(table.select("*", slope.alias("_g"), curve.alias("_h")))
        nodes += _grow(known, cuts, {t: (F.col("_h"), F.col("_g"))}, depth, least * GRAIN, 1.1, 0, step)
    return _table(rows.sparkSession, nodes)
