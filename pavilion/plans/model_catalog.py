"""Model queries of the catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavilion.functions.columns import round_doubles
from pavilion.operators import (
    buckets,
    classifiers,
    discriminant,
    importance,
    metrics,
    neighbours,
    trees,
    vectors,
)
from pavilion.operators.folds import FOLDS, fold_of, with_folds
from pavilion.plans import model_selection as ms
from pavilion.plans.catalog import ORDER, TRAIN_ROWS, cleaned, query
from pavilion.sources.schemas import DIFF_FEATURES, KEY_COLUMNS, RESPONSE

MODEL_COLUMNS = [c for c in KEY_COLUMNS if c != "id"] + DIFF_FEATURES


def _long_vectors(df: DataFrame, columns: list[str]) -> DataFrame:
    """Vectors as long rows (id, feature, value)."""
    wide = df.select("id", vector_to_array("features").alias("v"))
    named = wide.select("id", *[F.col("v")[i].alias(c) for i, c in enumerate(columns)])
    return named.unpivot(["id"], columns, "feature", "value")


def _embeddings(spark, folder) -> DataFrame:
    raw = spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet")
    named = raw.select(F.col("vec_id").alias("id"), F.col("label").cast("double"), "embedding")
    return with_folds(vectors.from_array(named, "embedding", ["id", "label"]))


@query("row_normalise")
def _row_normalise(spark, folder):
    scaled = ms.normalised(cleaned(spark, folder), MODEL_COLUMNS, ["id"])
    return round_doubles(_long_vectors(scaled, MODEL_COLUMNS))


@query("standardise")
def _standardise(spark, folder):
    raw = vectors.assemble(cleaned(spark, folder), MODEL_COLUMNS, ["id"])
    scaled = vectors.Standardiser.fit(raw).transform(raw)
    return round_doubles(_long_vectors(scaled, MODEL_COLUMNS))


def _components(spark, folder):
    raw = vectors.assemble(cleaned(spark, folder), MODEL_COLUMNS, ["id"])
    return ms.pca_features(raw, [raw])


@query("pca_variance")
def _pca_variance(spark, folder):
    parts, (scores,) = _components(spark, folder)
    return round_doubles(vectors.variance_table(scores, parts))


@query("pca_loadings")
def _pca_loadings(spark, folder):
    parts, (scores,) = _components(spark, folder)
    return round_doubles(vectors.loadings_table(scores, parts, MODEL_COLUMNS))


@query("pca_reconstruction")
def _pca_reconstruction(spark, folder):
    parts, (scores,) = _components(spark, folder)
    return round_doubles(vectors.rebuilt_correlation(scores, parts, MODEL_COLUMNS))


@query("fold_assignment")
def _fold_assignment(spark, folder):
    return cleaned(spark, folder).select("id", fold_of(F.col("id")).alias("fold"))


@query("lda_means")
def _lda_means(spark, folder):
    return round_doubles(discriminant.class_means(_embeddings(spark, folder)))


@query("lda_weights")
def _lda_weights(spark, folder):
    return round_doubles(discriminant.weighted_covariance(_embeddings(spark, folder)))


@query("lda_covariance")
def _lda_covariance(spark, folder):
    return round_doubles(discriminant.pooled_covariance(_embeddings(spark, folder)))


def _each_fold(spark, folder, fit_predict):
    """Predictions of every fold by a model of the other folds."""
    rows = _embeddings(spark, folder)
    parts = []
    for fold in range(FOLDS):
        train = rows.where(F.col("fold") != fold).drop("fold")
        parts.append(fit_predict(train, rows.where(F.col("fold") == fold).drop("fold")))
    return reduce(DataFrame.unionByName, parts)


@query("lda_predict")
def _lda_predict(spark, folder):
    scored = _each_fold(
        spark, folder, lambda train, test: discriminant.fit_predict(train, test, ["id", "label"])
    )
    return scored.select("id", F.col("label").cast("int"), F.col("yhat").cast("int"))


def _knn(spark, folder, strategy):
    scored = _each_fold(
        spark,
        folder,
        lambda train, test: neighbours.knn_predict(train, test, ["id"], strategy=strategy),
    )
    return scored.select("id", F.col("yhat").cast("int"))


@query("knn_predict")
def _knn_predict(spark, folder):
    return _knn(spark, folder, "auto")


@query("knn_predict_cells")
def _knn_predict_cells(spark, folder):
    return _knn(spark, folder, "cells")


@query("forest_importance")
def _forest_importance(spark, folder):
    ranked = importance.forest_importance(cleaned(spark, folder), DIFF_FEATURES, RESPONSE)
    return round_doubles(ranked.orderBy(F.desc("forest_importance"), "feature"))


def _rule_predictions(spark, folder) -> DataFrame:
    """A fixed rule as a model: the side with the better earlier win rate wins."""
    rule = F.col("AVG_Wins")
    return with_folds(cleaned(spark, folder)).select(
        F.lit("RULE").alias("model"),
        "fold",
        "id",
        F.col(RESPONSE).alias("y"),
        F.when(rule > 0, 1).otherwise(0).alias("yhat"),
        rule.alias("score"),
    )


@query("fold_metrics")
def _fold_metrics(spark, folder):
    return round_doubles(metrics.fold_metrics(_rule_predictions(spark, folder)))


@query("fold_metrics_ranged")
def _fold_metrics_ranged(spark, folder):
    return round_doubles(metrics.fold_metrics(_rule_predictions(spark, folder), "distributed"))


@query("fold_boxplot")
def _fold_boxplot(spark, folder):
    scores = metrics.fold_metrics(_rule_predictions(spark, folder))
    return round_doubles(metrics.fold_boxplot(scores))


_VALIDATIONS: dict[tuple[str, str, str], ms.CrossValidation] = {}


def _validation(spark, folder, features="normalised") -> ms.CrossValidation:
    """The prepared folds of a feature set, once per session; fits are kept by key."""
    key = (spark.sparkContext.applicationId, folder, features)
    if key not in _VALIDATIONS:
        rows = cleaned(spark, folder)
        _VALIDATIONS[key] = ms.CrossValidation(rows, MODEL_COLUMNS, RESPONSE, features)
    return _VALIDATIONS[key]


def _one_model(spark, folder, name):
    found = _validation(spark, folder).predictions({name: ms.MODELS[name]})
    return found.select("fold", "id", "y", "yhat")


def _all_models(spark, folder, features):
    return metrics.fold_metrics(_validation(spark, folder, features).predictions())


@query("cart_predict")
def _cart_predict(spark, folder):
    return _one_model(spark, folder, "CART")


@query("svm_kernel_error")
def _svm_kernel_error(spark, folder):
    """How far the kernel of the landmarks is from the kernel, between all held-out rows of each fold."""
    runs = _validation(spark, folder)
    rows = []
    for fold in range(FOLDS):
        train, test = runs.part(fold)
        landmarks = classifiers.svm_landmarks(train, classifiers.LANDMARKS, "id", 42)
        rows.append((fold, len(landmarks.points), *landmarks.error(test)))
    table = spark.createDataFrame(rows, "fold int, landmarks int, mean_error double, largest_error double")
    return round_doubles(table)


@query("rf_predict")
def _rf_predict(spark, folder):
    return _one_model(spark, folder, "RF")


@query("svm_predict")
def _svm_predict(spark, folder):
    return _one_model(spark, folder, "SVM")


_NETS: dict[tuple[str, str], ms.NetRun] = {}


def _net(spark, folder) -> ms.NetRun:
    """The held-out net, trained once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _NETS:
        _NETS[key] = ms.held_out_net(
            cleaned(spark, folder), MODEL_COLUMNS, RESPONSE, ORDER, TRAIN_ROWS
        )
    return _NETS[key]


@query("mlp_predict")
def _mlp_predict(spark, folder):
    return _net(spark, folder).predictions


@query("net_accuracy")
def _net_accuracy(spark, folder):
    return round_doubles(ms.accuracy(_net(spark, folder).predictions))


@query("net_history")
def _net_history(spark, folder):
    return round_doubles(_net(spark, folder).history)


FEATURE_SETS = ["normalised", "pca"]


def _both_sets(spark, folder, report):
    """A report on all models for each feature set, with the set's name."""
    frames = [
        report(_validation(spark, folder, features)).select(F.lit(features).alias("features"), "*")
        for features in FEATURE_SETS
    ]
    return round_doubles(metrics.union_all(frames))


@query("model_metrics")
def _model_metrics(spark, folder):
    """All models on row-normalised features: every fold."""
    return round_doubles(_all_models(spark, folder, "normalised"))


@query("model_metrics_pca")
def _model_metrics_pca(spark, folder):
    """All models on principal components: every fold."""
    return round_doubles(_all_models(spark, folder, "pca"))


@query("model_means")
def _model_means(spark, folder):
    def means(runs):
        return metrics.model_means(metrics.fold_metrics(runs.predictions()))

    return _both_sets(spark, folder, means)


@query("model_boxplot")
def _model_boxplot(spark, folder):
    def box(runs):
        return metrics.fold_boxplot(metrics.fold_metrics(runs.predictions()))

    return _both_sets(spark, folder, box)


@query("model_support")
def _model_support(spark, folder):
    """Predicted rows, actual wins, predicted wins and hits of every model and fold."""
    return _both_sets(spark, folder, lambda runs: metrics.fold_support(runs.predictions()))


@query("model_times")
def _model_times(spark, folder):
    """Seconds to fit and to score of every model and fold."""
    return _both_sets(spark, folder, lambda runs: runs.times())


def _cart_nodes(spark, folder, local_rows):
    rows = vectors.assemble(
        cleaned(spark, folder).withColumn("label", F.col(RESPONSE).cast("double")), DIFF_FEATURES, ["id", "label"]
    )
    model = trees.grow(rows, trees.Options(max_depth=3, local_rows=local_rows))
    names = F.array(*[F.lit(c) for c in DIFF_FEATURES])
    feature = F.when(F.col("feature").isNotNull(), F.element_at(names, F.col("feature") + 1))
    return round_doubles(trees.nodes(model).select("node", feature.alias("feature"), "threshold", "rows", "wins"))


@query("cart_nodes")
def _cart_nodes_in_memory(spark, folder):
    """All nodes of a tree of depth 3 that splits at exact values."""
    return _cart_nodes(spark, folder, trees.LOCAL_ROWS)


@query("cart_nodes_ranged")
def _cart_nodes_ranged(spark, folder):
    """The same by counts per bin over all executors, at every level."""
    return _cart_nodes(spark, folder, 0)


@query("cart_stump")
def _cart_stump(spark, folder):
    """The first split of a tree on equal-count buckets."""
    bucketed = buckets.with_equal_count_buckets(
        cleaned(spark, folder), DIFF_FEATURES, ORDER, prefix=""
    )
    return classifiers.best_split(bucketed, DIFF_FEATURES, RESPONSE)
