import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from tidegauge.operators import descent, learn


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 2))
    y = 3 + 2 * x[:, 0] - x[:, 1] + rng.normal(size=300) * 0.1
    rows = [(int(i), float(a), float(b), float(t), int(i % 3), float(t > 3)) for i, ((a, b), t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, y double, fold int, label double").cache()


def design(data):
    pdf = data.toPandas()
    return np.column_stack([np.ones(len(pdf)), pdf.a, pdf.b]), pdf.y.to_numpy(), pdf.fold.to_numpy()


@pytest.mark.parametrize("penalty", [None, "ridge", "lasso"])
def test_descent_matches_row_by_row_steps(data, penalty):
    x, y, _ = design(data)
    w = np.array([y.mean(), 0, 0])
    for r in descent.descend(data, ["a", "b"], "y", 6, 0.1, penalty, 0.3).orderBy("step").collect():
        assert [r.w0, r.w1, r.w2] == pytest.approx(list(w))
        assert r.loss == pytest.approx(((x @ w - y) ** 2).mean())
        g = 2 * (x * (x @ w - y)[:, None]).mean(0)
        slope = np.array([0, w[1], w[2]])
        g = g + {None: 0, "ridge": 0.6 * slope, "lasso": 0.3 * np.sign(slope)}[penalty]
        w = w - 0.1 * g


def test_fold_descent_trains_on_other_folds(data):
    x, y, fold = design(data)
    got = {(r.model, r.step): (r.train_loss, r.test_loss) for r in descent.descend_folds(data, ["a", "b"], "y", "fold", 4).collect()}
    for k in range(3):
        tr = fold != k
        w = np.array([y[tr].mean(), 0, 0])
        for s in range(5):
            e = (x @ w - y) ** 2
            assert got[k, s] == (pytest.approx(e[tr].mean()), pytest.approx(e[~tr].mean()))
            w = w - 0.1 * 2 * (x[tr] * (x[tr] @ w - y[tr])[:, None]).mean(0)


def test_linear_models(data):
    x, y, _ = design(data)
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(data)
    m = learn.linear("y").fit(rows)
    w = np.linalg.lstsq(x, y, rcond=None)[0]
    assert [m.intercept, *m.coefficients] == pytest.approx(list(w))
    strong = learn.linear("y", reg=50.0, mix=1.0).fit(rows)
    assert list(strong.coefficients) == [0.0, 0.0] and strong.intercept == pytest.approx(y.mean())


def test_classifiers_learn_an_easy_rule(data):
    stages = learn.scaled_groups(standard=["a", "b"])
    for model in (learn.logistic("label", reg=0.001), learn.forest("label", trees=5), learn.boosted("label", rounds=3), learn.perceptron("label", [2, 4, 2])):
        out = learn.fit(data, [*stages, model]).transform(data)
        assert learn.area(out, "label", "areaUnderROC") > 0.9


def test_scalers_and_one_hot(spark):
    df = spark.createDataFrame([(1.0, 0.0, "x"), (2.0, 5.0, "x"), (3.0, 10.0, "y")], "a double, b double, c string")
    v = learn.fit(df, learn.scaled_groups(minmax=["b"], standard=["a"])).transform(df).select(vector_to_array("features")).collect()
    assert [list(r[0]) for r in v] == [[0.0, -1.0], [0.5, 0.0], [1.0, 1.0]]
    new = spark.createDataFrame([("x",), ("y",), ("new",)], "c string")
    hot = learn.fit(df, learn.one_hot(["c"])).transform(new).select(vector_to_array("c_oh")).collect()
    assert [list(r[0]).index(1.0) for r in hot] == [0, 1, 2]


def test_pca_keeps_enough_variance(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=200)
    df = spark.createDataFrame([(float(x), float(2 * x), float(n)) for x, n in zip(a, rng.normal(size=200) * 0.01)], "a double, b double, c double")
    out, kept = learn.pca_cut(VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(df), "v", 0.95)
    assert kept == 1 and len(out.first().components) == 1


def test_stopping_point():
    assert learn.stopping_point([0.5, 0.6, 0.6005, 0.6, 0.9], 2, 0.001) == (4, 1)
    assert learn.stopping_point([0.5, 0.4], 2, 0.001) == (2, 0)


def test_first_trees_are_the_smaller_model(data):
    prep = learn.VectorAssembler(inputCols=["a", "b"], outputCol="features")
    large = learn.fit(data, [prep, learn.boosted("label", rounds=6)])
    small = learn.fit(data, [prep, learn.boosted("label", rounds=3)])
    got = learn.margins(large.stages[-1], prep.transform(data), [3, 6])
    for model, column in ((small, "_m3"), (large, "_m6")):
        want = {r.id: r.m for r in model.transform(data).select("id", (learn.vector_to_array("rawPrediction")[1]).alias("m")).collect()}
        assert {r["id"]: r[column] for r in got.select("id", column).collect()} == pytest.approx(want)
    tried = learn.early_stop(data, data, [2, 4, 6], [prep, learn.boosted("label", rounds=6)], "label")
    assert [t[0] for t in tried][:1] == [2] and sum(t[3] for t in tried) == 1 and all(0.5 < t[1] <= 1 and 0.5 < t[2] <= 1 for t in tried)


def test_ensemble_is_the_mean(data):
    prep = learn.scaled_groups(standard=["a", "b"])
    models = [learn.fit(data, [*prep, learn.logistic("label", reg=r)]) for r in (0.01, 0.5)]
    got = {r.id: r.prob for r in learn.mean_probability(data, models).collect()}
    singles = [{r.id: r.p for r in m.transform(data).select("id", learn.positive_probability().alias("p")).collect()} for m in models]
    assert all(got[i] == pytest.approx((singles[0][i] + singles[1][i]) / 2) for i in got)


def test_chi_square_selection(spark):
    df = spark.createDataFrame([(float(i % 2), float(i % 3), float(i % 5), i % 2) for i in range(200)], "good double, f1 double, f2 double, y int")
    assert [r["column"] for r in learn.select_by_chi2(df, ["f1", "good", "f2"], "y", 1).collect()] == ["good"]


def test_two_stage_combinations(data):
    prep = [VectorAssembler(inputCols=["a", "b"], outputCol="features")]
    out = learn.two_stage(data, data, prep, learn.forest("label", trees=3), learn.linear("y"), "label")
    r = out.select("prob", "amount", "gated", "expected").collect()
    assert all(x.gated == (x.amount if x.prob > 0.5 else 0.0) and x.expected == pytest.approx(x.prob * x.amount) for x in r)


def test_importances(data):
    m = learn.fit(data, [VectorAssembler(inputCols=["a", "b"], outputCol="features"), learn.forest("label", trees=5)]).stages[-1]
    rows = learn.importance_table(data, m, ["a", "b"]).collect()
    assert [r.feature for r in rows] == ["a", "b"] and sum(r.importance for r in rows) == pytest.approx(1)


@pytest.mark.parametrize("mix", [0.0, 1.0])
def test_optimality_of_penalised_fits(spark, mix):
    """Satisfied at the fitted coefficients, not beside them."""
    import random
    rng = random.Random(6)
    data = [(a := rng.gauss(0, 1), b := rng.gauss(5, 3), rng.gauss(0, 1), 3 * a - b + rng.gauss(0, 1)) for _ in range(500)]
    df = spark.createDataFrame(data, "a double, b double, c double, y double")
    names = ["a", "b", "c"]
    made = VectorAssembler(inputCols=names, outputCol="features").transform(df)
    model = learn.linear("y", reg=0.3, mix=mix).setTol(1e-12).setMaxIter(1000).fit(made)
    found = model.coefficients.toArray().tolist()
    with_null = df.union(spark.createDataFrame([(None, 1.0, 1.0, 1.0)], df.schema))
    assert all(r.satisfied for r in learn.optimality(with_null, names, "y", found, model.intercept, 0.3, mix, 1e-4).collect())
    beside = learn.optimality(df, names, "y", [found[0] * 1.05, *found[1:]], model.intercept, 0.3, mix, 1e-4).collect()
    assert not beside[0].satisfied
    if mix:
        assert found[2] == 0 and abs(beside[2].gradient) <= beside[2].bound
