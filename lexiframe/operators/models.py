"""Classifiers, clustering and model search on Spark ML."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.tuning import CrossValidator
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TREE_DEPTH = 30


def assembled(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def logistic(c: float, n_rows: int, weight: str | None = None, features: str = "features", max_iter: int = 100):
    """Multinomial, L2 with inverse strength ``c``. The penalty is stated per row, hence ``n_rows``."""
    model = LogisticRegression(
        family="multinomial", regParam=1.0 / (c * n_rows), elasticNetParam=0.0, standardization=False,
        maxIter=max_iter, featuresCol=features,
    )
    return model.setWeightCol(weight) if weight else model


def random_forest(
    trees: int, depth: int | None, min_leaf: int = 1, weight: str | None = None, features: str = "features", seed: int = 42
):
    """``depth`` None means as deep as Spark grows a tree."""
    model = RandomForestClassifier(
        numTrees=trees, maxDepth=MAX_TREE_DEPTH if depth is None else depth, minInstancesPerNode=min_leaf,
        featuresCol=features, seed=seed,
    )
    return model.setWeightCol(weight) if weight else model


def boosting(rounds: int, depth: int, rate: float, subsample: float, features: str = "features", seed: int = 42):
    """One boosted ensemble per class, as Spark's boosting is binary."""
    trees = GBTClassifier(
        maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=subsample, featuresCol=features, seed=seed
    )
    return OneVsRest(classifier=trees, featuresCol=features, parallelism=4)


def linear_svm(c: float, n_rows: int, weight: str | None = None, features: str = "features", max_iter: int = 100):
    svc = LinearSVC(regParam=1.0 / (c * n_rows), standardization=False, maxIter=max_iter, featuresCol=features)
    rest = OneVsRest(classifier=svc, featuresCol=features, parallelism=4)
    return rest.setWeightCol(weight) if weight else rest


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Random Fourier features (Rahimi and Recht, 2007): inner products of the output approximate an RBF kernel.

    The projection is drawn from the seed, so it is the same in every task and needs no broadcast.
    """

    gamma = Param(Params._dummy(), "gamma", "kernel width: exp(-gamma * d^2)", TypeConverters.toFloat)
    components = Param(Params._dummy(), "components", "number of features", TypeConverters.toInt)

    def __init__(self, inputCol="features", outputCol="kernel", gamma=0.005, components=200, seed=42):
        super().__init__()
        self._setDefault(gamma=0.005, components=200)
        self._set(inputCol=inputCol, outputCol=outputCol, gamma=float(gamma), components=int(components), seed=int(seed))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        gamma, size = self.getOrDefault("gamma"), self.getOrDefault("components")
        seed = self.getOrDefault("seed")

        @F.pandas_udf("array<double>")
        def project(rows: pd.Series) -> pd.Series:
            if rows.empty:
                return pd.Series([], dtype=object)
            x = np.stack([np.asarray(r, dtype="float64") for r in rows])
            draw = np.random.default_rng(seed)
            w = draw.normal(0.0, np.sqrt(2.0 * gamma), (x.shape[1], size))
            b = draw.uniform(0.0, 2.0 * np.pi, size)
            return pd.Series(list(np.sqrt(2.0 / size) * np.cos(x @ w + b)))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(project(vector_to_array(self.getInputCol()))))


def scale_gamma(df: DataFrame, n_cols: int, features: str = "features") -> float:
    """1 / (columns * variance of all entries)."""
    entries = df.select(F.explode(vector_to_array(features)).alias("v"))
    variance = entries.agg(F.var_pop("v")).first()[0]
    return 1.0 / (n_cols * variance) if variance else 1.0 / n_cols


def rbf_svm(
    c: float, gamma: float, n_rows: int, components: int = 200, weight: str | None = None, features: str = "features",
    max_iter: int = 100, seed: int = 42,
) -> Pipeline:
    kernel = FourierFeatures(features, "kernel", gamma, components, seed)
    return Pipeline(stages=[kernel, linear_svm(c, n_rows, weight, "kernel", max_iter)])


def accuracy_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")


def grid_search(train: DataFrame, candidates: list[tuple[dict, object]], fold: str, n_folds: int, label: str = "label"):
    """Fit every candidate on all folds but one, score it on that one, and refit the best on all rows.

    ``candidates`` pairs a description with an estimator. Returns the fitted best model, its description and a
    list of ``(description, mean accuracy)``. Ties go to the earlier candidate; a single one is scored by folds like any.
    """
    # The stages of the pipeline are the searched parameter, so one validator tries any kinds of estimators
    # side by side and reads each fold once.
    pipeline = Pipeline(stages=[])
    search = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=[{pipeline.stages: [estimator]} for _, estimator in candidates],
        evaluator=accuracy_evaluator(label),
        numFolds=n_folds,
        foldCol=fold,
        parallelism=4,
    )
    fitted = search.fit(train)
    scores = [float(s) for s in fitted.avgMetrics]
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    return fitted.bestModel, candidates[best][0], [(about, s) for (about, _), s in zip(candidates, scores)]


def kmeans(train: DataFrame, k: int = 7, restarts: int = 10, features: str = "features", seed: int = 42) -> KMeansModel:
    """Best of several starts by the sum of squared distances."""
    fits = [
        KMeans(k=k, seed=seed + i, initMode="k-means||", featuresCol=features, predictionCol="cluster").fit(train)
        for i in range(restarts)
    ]
    return min(fits, key=lambda m: m.summary.trainingCost)


def centroids(df: DataFrame, by: str, vector: str = "vector", max_groups: int = 10_000) -> list[tuple[int, list[float]]]:
    """Mean vector per group, ordered by group. Refuses more groups than a model has clusters or classes."""
    long = df.select(by, F.posexplode(vector).alias("i", "v"))
    means = long.groupBy(by, "i").agg(F.avg("v").alias("m")).groupBy(by).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c")
    )
    rows = means.limit(max_groups + 1).collect()
    if len(rows) > max_groups:
        raise ValueError(f"more than {max_groups} groups in {by}")
    return sorted((r[by], list(r["c"])) for r in rows)


def nearest_centroid(
    vector: Column, centres: list[tuple[int, list[float]]], metric: str = "euclidean", digits: int | None = None
) -> Column:
    """Code of the nearest of the given centres; ties to the smaller code. Distances are rounded only if asked for."""
    listed = F.array(
        *[F.struct(F.lit(code).alias("code"), F.array(*[F.lit(float(v)) for v in c]).alias("c")) for code, c in centres]
    )

    def gap(centre: Column) -> Column:
        parts = F.zip_with(
            vector, centre["c"], lambda a, b: (a - b) * (a - b) if metric == "euclidean" else F.abs(a - b)
        )
        total = F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v)
        gap = F.sqrt(total) if metric == "euclidean" else total
        return F.struct((gap if digits is None else F.round(gap, digits)).alias("d"), centre["code"].alias("code"))

    return F.array_min(F.transform(listed, gap))["code"]


def centred_pca(k: int, features: str = "features", out: str = "pca") -> Pipeline:
    """Principal components of centred columns."""
    centre = StandardScaler(inputCol=features, outputCol=f"{out}_centred", withMean=True, withStd=False)
    return Pipeline(stages=[centre, PCA(k=k, inputCol=f"{out}_centred", outputCol=out)])


def explained_variance(df: DataFrame, k: int, features: str = "features") -> list[float]:
    return centred_pca(k, features).fit(df).stages[-1].explainedVariance.toArray().tolist()


# Parameter grids of the three training runs.
GRIDS = {
    "basic": {
        "logistic": {"c": [0.01, 0.1, 1.0, 10.0, 100.0]},
        "random_forest": {"trees": [100, 200], "depth": [None, 10, 20, 30]},
        "knn": {"k": [3, 5, 7, 11], "weights": ["uniform", "distance"]},
    },
    "svm": {"svm": {"c": [0.1, 1.0, 10.0], "kernel": ["linear", "rbf"]}},
    "full": {
        "logistic": {"c": [0.05, 0.1, 0.3]},
        "random_forest": {"trees": [50, 100], "depth": [5, 7], "min_leaf": [2, 3]},
        "knn": {"k": [3, 5, 7, 9], "weights": ["distance", "class"], "metric": ["cosine", "manhattan"]},
        "gradient_boosting": {"rounds": [50, 100], "depth": [2, 3], "rate": [0.01, 0.03], "subsample": [0.7, 0.8]},
        "svm": {"c": [0.1, 0.3, 0.5], "gamma": ["scale", 0.005]},
    },
}
