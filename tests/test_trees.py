"""Models as tables of nodes: the same scores and importances as the fitted model, and as another engine's walk."""

import random

import duckdb
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidegauge.operators import learn, trees

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    out = []
    for i in range(400):
        a, b, c = rng.random(), rng.gauss(0, 2), float(rng.randint(0, 4))
        out.append((i, a, b, c, float((a > 0.4) ^ (b > 1) if rng.random() < 0.9 else c > 2)))
    return spark.createDataFrame(out, "id long, a double, b double, c double, label double").repartition(3).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    made = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    return made, learn.forest("label", trees=4, depth=4).fit(made), learn.boosted("label", rounds=4).fit(made)


WALK = """
WITH RECURSIVE here AS (
  SELECT id, tree, min(node) AS node FROM obs, nodes GROUP BY ALL
  UNION ALL
  SELECT here.id, here.tree, CASE WHEN CASE n.feature WHEN 'a' THEN r.a WHEN 'b' THEN r.b ELSE r.c END <= n.at_most THEN n."left" ELSE n."right" END
  FROM here JOIN nodes n ON n.tree = here.tree AND n.node = here.node JOIN obs r ON r.id = here.id WHERE n.feature IS NOT NULL)
SELECT here.id, sum(n.weight * n.value) AS total, avg(n.value) AS mean FROM here JOIN nodes n ON n.tree = here.tree AND n.node = here.node WHERE n.feature IS NULL GROUP BY here.id"""


def other_engine(rows, nodes):
    con = duckdb.connect()
    con.register("obs", rows.toPandas())
    con.register("nodes", nodes.toPandas())
    return {i: (total, mean) for i, total, mean in con.sql(WALK).fetchall()}


def test_forest_table(spark, rows, fitted, tmp_path):
    made, forest, _ = fitted
    table = trees.node_table(forest, NAMES, str(tmp_path / "forest"))
    want = {r.id: r.p for r in forest.transform(made).select("id", learn.positive_probability().alias("p")).collect()}
    got = {r.id: r.p for r in rows.select("id", trees.mean_value(table.collect()).alias("p")).collect()}
    assert got == pytest.approx(want)
    assert {i: mean for i, (_, mean) in other_engine(rows, table).items()} == pytest.approx(want)


def test_boosted_table(spark, rows, fitted, tmp_path):
    made, _, boosted = fitted
    table = trees.node_table(boosted, NAMES, str(tmp_path / "boosted"))
    want = {r.id: r.p for r in boosted.transform(made).select("id", learn.positive_probability().alias("p")).collect()}
    got = {r.id: r.p for r in rows.select("id", trees.logistic(2 * trees.margin(table.collect())).alias("p")).collect()}
    assert got == pytest.approx(want)
    margins = {r.id: r.m for r in rows.select("id", trees.margin(table.collect()).alias("m")).collect()}
    assert {i: total for i, (total, _) in other_engine(rows, table).items()} == pytest.approx(margins)


@pytest.mark.parametrize("which", [1, 2])
def test_importances(rows, fitted, tmp_path, which):
    model = fitted[which]
    want = dict(zip(NAMES, model.featureImportances.toArray()))
    got = {r.feature: r.importance for r in trees.importances(trees.node_table(model, NAMES, str(tmp_path / "m")), per_tree=which == 1).collect()}
    assert got == pytest.approx({k: v for k, v in want.items() if v})


def test_grown_tables_walk_alike_and_learn(rows):
    for table, score in ((trees.grow_forest(rows, NAMES, "label", "id"), trees.mean_value), (trees.grow_boosted(rows, NAMES, "label", rounds=4, step=0.5), lambda n: trees.logistic(trees.margin(n)))):
        nodes = table.collect()
        got = rows.select("id", "label", score(nodes).alias("p")).collect()
        assert sum((r.p > 0.5) == (r.label == 1) for r in got) >= 0.85 * len(got)
        walked = other_engine(rows, table)
        sums = {r.id: r.m for r in rows.select("id", trees.margin(nodes).alias("m")).collect()}
        assert {i: total for i, (total, _) in walked.items()} == pytest.approx(sums)


def test_growth_does_not_depend_on_the_order_of_rows(rows):
    def table(df):
        return sorted(map(tuple, trees.grow_boosted(df, NAMES, "label", rounds=2).collect()), key=str)

    assert table(rows) == table(rows.orderBy(F.desc("a")).repartition(5))


def test_root_split_against_brute_force(rows):
    data = [tuple(r) for r in rows.select(*NAMES, "label").collect()]
    cuts = trees.cut_points(rows, NAMES, 8)
    best = None
    for i, c in enumerate(NAMES):
        for b, cut in enumerate(cuts[c]):
            left, right = ([r[3] for r in data if (r[i] <= cut) == side] for side in (True, False))
            if len(left) >= 5 and len(right) >= 5:
                gain = sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right) - sum(r[3] for r in data) ** 2 / len(data)
                best = max(best or (0, 0, 0), (gain, -i, -b))
    nodes = trees.grow_forest(rows, NAMES, "label", "id", trees=1, depth=1, bins=8, seen=1.1, share=1.1).collect()
    root = next(n for n in nodes if n.node == trees.ROOT)
    assert (root.feature, root.at_most) == (NAMES[-best[1]], cuts[NAMES[-best[1]]][-best[2]]) and root.gain == pytest.approx(best[0])


def test_odd_rows(spark):
    schema = "id long, a double, b double, c double, label double"
    empty = spark.createDataFrame([], schema)
    assert [tuple(n)[:3] for n in trees.grow_forest(empty, NAMES, "label", "id", trees=2).collect()] == [(0, 1, None), (1, 1, None)]
    odd = spark.createDataFrame([(None, None, 1.0, 2.0, 1.0), (1, float("nan"), 1.0, 2.0, None), (2, 3.0, None, 2.0, 0.0), (2, 3.0, None, 2.0, 0.0)], schema)
    nodes = trees.grow_forest(odd, NAMES, "label", "id", trees=2, least=1, seen=1.1, share=1.1).collect()
    got = odd.select("label", trees.mean_value(nodes).alias("p")).collect()
    assert all(r.p == r.label for r in got if r.label is not None) and all(0 <= r.p <= 1 for r in got)
    same = spark.createDataFrame([(i, 1.0, 1.0, 1.0, 1.0) for i in range(20)], schema)
    assert [(n.feature, n.value) for n in trees.grow_forest(same, NAMES, "label", "id", trees=1, seen=1.1).collect()] == [(None, 1.0)]
