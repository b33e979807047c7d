"""Evaluation tables over ``(label, prediction)`` or ``(label, cluster)`` columns.

Everything is derived from one pre-aggregated count per (label, prediction) pair, which is as small as the
number of classes squared whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.session import lookup_join


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def pair_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def class_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(class, precision, recall, f1, support)``; a quotient without cases is 0."""
    pairs = pair_counts(df, label, prediction)
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("y").alias("class"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("tp"),
                         F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("tp"),
                         F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")),
            )
        )
    )
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])

    def share(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    return sums.select(
        "class",
        share(F.col("tp"), F.col("predicted")).alias("precision"),
        share(F.col("tp"), F.col("support")).alias("recall"),
        share(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "tp",
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Scores per class, then accuracy, macro average and support-weighted average."""
    scores = class_scores(df, label, prediction)
    metrics = ["precision", "recall", "f1"]
    per_class = scores.select(F.col("class").cast("string").alias("class"), *metrics, "support")
    total = F.sum("support")
    averages = scores.agg(
        F.struct(*[(F.sum("tp") / total).alias(m) for m in metrics], total.alias("support")).alias("accuracy"),
        F.struct(*[F.avg(m).alias(m) for m in metrics], total.alias("support")).alias("macro avg"),
        F.struct(
            *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in metrics], total.alias("support")
        ).alias("weighted avg"),
    )
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("class"), *[F.col(f"`{n}`")[m].alias(m) for m in (*metrics, "support")])
            for n in ("accuracy", "macro avg", "weighted avg")
        ]
    )
    return per_class.unionByName(averages.select(F.inline(rows)))


def class_f1(df: DataFrame, of_class, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return class_scores(df, label, prediction).filter(F.col("class") == F.lit(of_class)).select("class", "f1")


def _grid(pairs: DataFrame, y: Column, p: Column) -> DataFrame:
    """Every combination of the values seen on the two sides, from one row that holds both sets."""
    sets = pairs.agg(y.alias("ys"), p.alias("ps"))
    return sets.select(F.explode("ys").alias("y"), "ps").select("y", F.explode("ps").alias("p"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(y, p, n, share)`` over all classes seen on either side, with zeros; ``share`` is of the true class."""
    pairs = pair_counts(df, label, prediction)
    both = F.array_union(F.collect_set("y"), F.collect_set("p"))
    full = _grid(pairs, both, both).join(pairs, ["y", "p"], "left").fillna(0, subset=["n"])
    total = F.sum("n").over(Window.partitionBy("y"))
    return full.withColumn("share", F.coalesce(F.try_divide(F.col("n").cast("double"), total.cast("double")), F.lit(0.0)))


def contingency(df: DataFrame, label: str = "label", cluster: str = "cluster") -> DataFrame:
    """``(label, cluster, n)`` with zeros."""
    pairs = pair_counts(df, label, cluster)
    full = _grid(pairs, F.collect_set("y"), F.collect_set("p")).join(pairs, ["y", "p"], "left").fillna(0, subset=["n"])
    return full.select(F.col("y").alias(label), F.col("p").alias(cluster), "n")


def cluster_labels(
    df: DataFrame, n_clusters: int, label: str = "label", cluster: str = "cluster", fallback: str = "mode"
) -> DataFrame:
    """``(cluster, mapped)``: the most frequent label of each cluster, the smaller one on a tie.

    A cluster without rows gets the most frequent label overall, or -1 with ``fallback='none'``.
    """
    pairs = pair_counts(df, label, cluster)

    def modes(counts: DataFrame, by: str) -> DataFrame:
        order = Window.partitionBy(by).orderBy(F.desc("n"), "y")
        return counts.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") == 1)

    clusters = df.sparkSession.range(n_clusters).select(F.col("id").cast("int").alias(cluster))
    found = modes(pairs, "p").select(F.col("p").alias(cluster), F.col("y").alias("mapped"))
    if fallback == "none":
        return clusters.join(found, cluster, "left").select(cluster, F.coalesce("mapped", F.lit(-1)).alias("mapped"))
    overall = pairs.groupBy("y").agg(F.sum("n").alias("n")).withColumn("_one", F.lit(1))
    default = modes(overall, "_one").select("_one", F.col("y").alias("_default"))
    keyed = clusters.join(found, cluster, "left").withColumn("_one", F.lit(1)).join(default, "_one", "left")
    return keyed.select(cluster, F.coalesce("mapped", "_default").alias("mapped"))


def mapped_predictions(df: DataFrame, mapping: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Replace clusters by their labels; an unknown cluster becomes -1."""
    joined = lookup_join(df, mapping, cluster, "left")
    return joined.withColumn("prediction", F.coalesce("mapped", F.lit(-1))).drop("mapped")


def compare_models(predictions: dict[str, DataFrame], label: str = "label") -> DataFrame:
    """``(model, accuracy)``."""
    rows = [accuracy(df, label).select(F.lit(name).alias("model"), "accuracy") for name, df in predictions.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def best_model(comparison: DataFrame, without: tuple[str, ...] = ()) -> DataFrame:
    """Model of highest accuracy, the first by name on a tie."""
    return comparison.filter(~F.col("model").isin(list(without))).orderBy(F.desc("accuracy"), "model").limit(1)


def importance_table(model, names: list[str], top: int | None = 20):
    """``(feature, importance)`` of a tree model as rows of a list, most important first."""
    found = sorted(zip(names, model.featureImportances.toArray().tolist()), key=lambda t: (-t[1], t[0]))
    return found if top is None else found[:top]
