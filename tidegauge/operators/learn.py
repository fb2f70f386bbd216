"""Model training with Spark ML: feature preparation, fits, searches, ensembles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (
    PCA,
    MinMaxScaler,
    OneHotEncoder,
    RobustScaler,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage


def one_hot(columns: Sequence[str]) -> list:
    """Index then one-hot; values not seen in training get their own slot."""
    index = StringIndexer(inputCols=list(columns), outputCols=[c + "_ix" for c in columns], handleInvalid="keep",
                          stringOrderType="frequencyDesc")
    encode = OneHotEncoder(inputCols=[c + "_ix" for c in columns], outputCols=[c + "_oh" for c in columns],
                           handleInvalid="keep")
    return [index, encode]


def scaled_groups(robust: Sequence[str] = (), minmax: Sequence[str] = (), standard: Sequence[str] = ()) -> list:
    """Assemble and scale each group of columns its own way, then join them in ``features``."""
    stages, outputs = [], []
    scalers = (
        ("robust", robust, lambda i, o: RobustScaler(inputCol=i, outputCol=o, withCentering=True, relativeError=1e-4)),
        ("minmax", minmax, lambda i, o: MinMaxScaler(inputCol=i, outputCol=o)),
        ("standard", standard, lambda i, o: StandardScaler(inputCol=i, outputCol=o, withMean=True)),
    )
    for name, cols, make in scalers:
        if cols:
            raw, out = name + "_raw", name + "_scaled"
            stages += [VectorAssembler(inputCols=list(cols), outputCol=raw, handleInvalid="keep"), make(raw, out)]
            outputs.append(out)
    return [*stages, VectorAssembler(inputCols=outputs, outputCol="features", handleInvalid="keep")]


def select_by_chi2(df: DataFrame, columns: Sequence[str], label: str, top: int, bins: int = 10) -> DataFrame:
    """The ``top`` features by chi-square against the label: place, column, statistic, degrees of freedom.

    Values are scaled to [0, 1] and cut into equal bins, so continuous columns of any number of values can take part; nulls
    count as 0. Columns with different degrees of freedom are compared by the normal score of their statistic
    (Wilson and Hilferty), which orders them as their p-values do. A constant column or label has no
    statistic and comes last. All columns share one pass for the ranges and one for the counts.
    """
    x = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    row = df.agg(*[e for i, c in enumerate(columns) for e in (F.min(x[c]).alias(f"lo{i}"), F.max(x[c]).alias(f"hi{i}"))]).first()
    cells = []
    for i, c in enumerate(columns):
        low, high = row[f"lo{i}"], row[f"hi{i}"]
        scaled = F.lit(0.0) if low is None or low == high else (x[c] - F.lit(low)) / F.lit(high - low)
        cells.append(F.struct(F.lit(c).alias("column"), F.least(F.floor(scaled * bins), F.lit(bins - 1)).cast("int").alias("bin")))
    counts = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("y"), F.inline(F.array(*cells))).groupBy("column", "bin", "y").agg(F.count(F.lit(1)).cast("double").alias("n"))
    by_bin = counts.groupBy("column", "bin").agg(F.sum("n").alias("r"))
    by_label = counts.groupBy("column", "y").agg(F.sum("n").alias("c"))
    tables = counts.join(by_bin, ["column", "bin"]).join(by_label, ["column", "y"]).groupBy("column").agg(
        (F.sum("n") * (F.sum(F.col("n") * F.col("n") / (F.col("r") * F.col("c"))) - 1)).alias("chi2"),
        ((F.count_distinct("bin") - 1) * (F.count_distinct("y") - 1)).alias("dof"))
    d = F.col("dof").cast("double")
    score = F.when(d > 0, (F.cbrt(F.col("chi2") / d) - (1 - 2 / (9 * d))) / F.sqrt(2 / (9 * d)))
    best = tables.withColumn("score", F.round(score, 6)).orderBy(F.desc_nulls_last("score"), "column").limit(top)
    place = F.row_number().over(W.orderBy(F.desc_nulls_last("score"), "column"))  # top rows
    return best.select(place.cast("long").alias("place"), "column", F.round("chi2", 6).alias("chi2"), "dof")


def pca_cut(df: DataFrame, vector: str, share: float = 0.95) -> tuple[DataFrame, int]:
    """Principal components up to ``share`` of the variance, and how many that are."""
    width = len(df.select(vector).first()[0])
    model = PCA(k=width, inputCol=vector, outputCol="_pc").fit(df)
    explained = np.cumsum(model.explainedVariance.toArray())
    keep = int(min(np.searchsorted(explained, share - 1e-12) + 1, width))
    parts = F.slice(vector_to_array("_pc"), 1, keep)
    return model.transform(df).withColumn("components", parts).drop("_pc"), keep


def logistic(label: str, features: str = "features", reg: float = 0.01, mix: float = 0.5, rounds: int = 20,
             weight: str | None = None) -> LogisticRegression:
    lr = LogisticRegression(labelCol=label, featuresCol=features, regParam=reg, elasticNetParam=mix, maxIter=rounds)
    return lr.setWeightCol(weight) if weight else lr


def forest(label: str, features: str = "features", trees: int = 20, depth: int = 5, seed: int = 7) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth, seed=seed)


def boosted(label: str, features: str = "features", rounds: int = 10, depth: int = 3, step: float = 0.1,
            seed: int = 7) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol=features, maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed)


def perceptron(label: str, layers: Sequence[int], features: str = "features", rounds: int = 30,
               seed: int = 7) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, layers=list(layers), maxIter=rounds, seed=seed)


def linear(label: str, features: str = "features", reg: float = 0.0, mix: float = 0.0) -> LinearRegression:
    """Ordinary, ridge (mix 0) or lasso (mix 1) least squares."""
    return LinearRegression(labelCol=label, featuresCol=features, regParam=reg, elasticNetParam=mix,
                            solver="normal" if mix == 0 else "auto")


def optimality(df: DataFrame, columns: Sequence[str], label: str, coefficients: Sequence[float], intercept: float, reg: float, mix: float,
               tolerance: float = 1e-6) -> DataFrame:
    """Whether penalised least squares has its optimum at the given coefficients, from one aggregate over the rows.

    Per column: the gradient of half the mean squared error, the bound that the penalty allows it, and ``satisfied``. At the
    optimum a non-zero coefficient's gradient is minus the slope of its penalty, and a zero coefficient's is within the lasso part. Penalties
    are those of ``linear``: on columns of unit variance, and the ridge part divided by the deviation of the label. The
    tolerance is a share of the gradient at coefficients of zero. Rows with a null in any of the columns are left out.
    """
    rows = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)], F.col(label).cast("double").alias("_y")).dropna()
    x = [F.col(f"_x{i}") for i in range(len(columns))]
    error = F.lit(float(intercept)) - F.col("_y")
    for b, c in zip(coefficients, x):
        error = error + F.lit(float(b)) * c
    row = rows.agg(F.stddev_pop("_y").alias("sd"), *[e for i, c in enumerate(x) for e in (
        F.covar_pop(c, error).alias(f"g{i}"), F.covar_pop(c, "_y").alias(f"z{i}"), F.stddev_pop(c).alias(f"s{i}"))]).first()
    out = []
    for i, (name, b) in enumerate(zip(columns, coefficients)):
        gradient, start, sd = (row[f"{k}{i}"] or 0.0 for k in ("g", "z", "s"))
        lasso, ridge = reg * mix * sd, reg * (1 - mix) / row["sd"] * sd * sd * b if row["sd"] else 0.0
        slack = tolerance * max(abs(start), lasso)
        fine = abs(gradient) <= lasso + slack if b == 0 else abs(gradient + ridge + float(np.sign(b)) * lasso) <= slack
        out.append((name, float(b), float(gradient), float(lasso + abs(ridge)), bool(fine)))
    return df.sparkSession.createDataFrame(out, "feature string, coefficient double, gradient double, bound double, satisfied boolean").coalesce(1)


def fit(train: DataFrame, stages: Sequence[object]) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(train)


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(column).getItem(1)


def area(df: DataFrame, label: str, metric: str = "areaUnderPR") -> float:
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName=metric).evaluate(df)


def importance_table(df: DataFrame, model, names: Sequence[str]) -> DataFrame:
    """Feature importances of a fitted tree model, largest first."""
    pairs = sorted(zip(names, model.featureImportances.toArray()), key=lambda p: (-p[1], p[0]))
    return df.sparkSession.createDataFrame([(n, float(v)) for n, v in pairs], "feature string, importance double").coalesce(1)


def grid_search(
    folds: Sequence[tuple[DataFrame, DataFrame]], grid: Sequence[dict], build: Callable[..., Sequence[object]],
    label: str, metric: str = "areaUnderPR",
) -> list[tuple[dict, list[float], float]]:
    """Every setting on every fold; settings with their fold scores and mean, best first."""
    results = []
    for params in grid:
        scores = [area(fit(tr, build(**params)).transform(va), label, metric) for tr, va in folds]
        results.append((params, scores, float(np.mean(scores))))
    return sorted(results, key=lambda r: -r[2])


def margins(model, df: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Margin ``_m<n>`` of the first ``n`` trees of a boosted model, for each of ``sizes``."""
    total, out = F.lit(0.0), df
    for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights), 1):
        out = tree.setPredictionCol(f"_t{i}").transform(out)
        total = total + F.lit(float(weight)) * F.col(f"_t{i}")
        if i in sizes:
            out = out.withColumn(f"_m{i}", total)
    return out.drop(*[f"_t{i}" for i in range(1, len(model.trees) + 1)])


def stopping_point(scores: Sequence[float], patience: int, min_gain: float) -> tuple[int, int]:
    """How many scores are looked at, and which of them is chosen: the last that brought more than ``min_gain``."""
    chosen = 0
    for i, score in enumerate(scores):
        if score > scores[chosen] + min_gain:
            chosen = i
        if i - chosen >= patience:
            return i + 1, chosen
    return len(scores), chosen


def early_stop(
    train: DataFrame, valid: DataFrame, sizes: Sequence[int], stages: Sequence[object], label: str,
    patience: int = 2, min_gain: float = 0.001,
) -> list[tuple[int, float, float, bool]]:
    """One boosted model of the largest size; its first trees are the smaller models.

    Stops where ``patience`` sizes in a row bring less than ``min_gain`` of area under the precision-recall curve.
    Returns (size, AUC-PR, AUC-ROC, is_best) up to there; the last of ``stages`` is a boosted classifier.
    """
    model = fit(train, stages)
    scored = margins(model.stages[-1], PipelineModel(model.stages[:-1]).transform(valid), sizes)
    scored = cut_lineage(scored.select(F.col(label).cast("double").alias(label), *[f"_m{n}" for n in sizes]))
    areas = [[BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=f"_m{n}", metricName=m).evaluate(scored)
              for m in ("areaUnderPR", "areaUnderROC")] for n in sizes]
    tried, chosen = stopping_point([pr for pr, _ in areas], patience, min_gain)
    return [(n, pr, roc, i == chosen) for i, (n, (pr, roc)) in enumerate(zip(sizes, areas[:tried]))]


def two_stage(
    train: DataFrame, test: DataFrame, prepare: Sequence[object], classifier: Estimator, regressor: Estimator,
    label: str, threshold: float = 0.5,
) -> DataFrame:
    """Classify, then regress on positives; three ways to combine the two outputs."""
    prepared = fit(train, prepare)
    tr = prepared.transform(train)
    gate = classifier.fit(tr)
    amount = regressor.fit(tr.filter(F.col(label) == 1))
    scored = gate.transform(prepared.transform(test)).withColumn("prob", positive_probability())
    scored = amount.setPredictionCol("amount").transform(scored)
    return scored.withColumns({
        "gated": F.when(F.col("prob") > threshold, F.col("amount")).otherwise(F.lit(0.0)),
        "expected": F.col("prob") * F.col("amount"),
    })


def mean_probability(df: DataFrame, models: Sequence[PipelineModel]) -> DataFrame:
    """Average positive probability of several fitted models, applied row by row in one plan."""
    out, names = df, []
    for i, model in enumerate(models):
        before = out.columns
        out = model.transform(out).withColumn(f"_p{i}", positive_probability())
        out = out.select(*before, f"_p{i}")
        names.append(f"_p{i}")
    total = F.lit(0.0)
    for n in names:
        total = total + F.col(n)
    return out.withColumn("prob", total / len(names)).drop(*names)
