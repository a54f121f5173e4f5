"""Cross-validation of the match-winner models, and the held-out neural net."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavilion.functions.staging import free, is_written, kept_path, spread, stage
from pavilion.operators import classifiers, discriminant, neighbours, network, vectors
from pavilion.operators.folds import FOLDS, SEED, with_folds
from pavilion.operators.positions import chronological_split

FitPredict = Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame]
KEEP = ["id", "label"]
# Raised whenever the results of a model change, so that kept predictions are not used on.
CODE = 3
# Fits that run at the same time, the models that take longest, and those of which few folds
# are fitted at a time, because their steps keep lifted copies of all rows and run many jobs:
# two, and one where there are more than so many rows.
AT_ONCE = 3
SLOW = ("SVM", "RF")
ALONE = ("SVM",)
ALONE_ROWS = 200_000
PREDICTIONS = "model string, fold int, id long, y int, yhat int, score double"
TIMES = "model string, fold int, fit_seconds double, score_seconds double"

MODELS: Mapping[str, FitPredict] = {
    "LDA": discriminant.fit_predict,
    "KNN": neighbours.knn_predict,
    "CART": classifiers.tree_predict,
    "RF": classifiers.forest_predict,
    "SVM": classifiers.svm_predict,
}


def normalised(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Baseline features: rows scaled to length 1."""
    return vectors.normalise_rows(vectors.assemble(df, columns, keep))


def pca_features(
    fit_on: DataFrame, frames: Sequence[DataFrame]
) -> tuple[vectors.Components, list[DataFrame]]:
    """Standardise and rotate ``frames`` with scaler and components fitted on ``fit_on``."""
    parts = vectors.Components.fit(fit_on)
    return parts, [parts.transform(f) for f in frames]


class CrossValidation:
    """Fits of models on all folds of a table, each written once.

    The rows are written once, each fold in files of its own, and normalised folds are read from
    them; the components of a fold are written once for all models. Choosing a fold is part of
    no generated code, so the folds of a model share what was compiled. Fits do not depend on each
    other, so several run at once, each in a scheduler pool of its own. The predictions of a fit are written
    under a key of data, features, model, options and fold: what another query, or a run that
    broke off, has finished is read again. With ``features="pca"`` scaler and components are
    fitted on the training folds; ``fit_scope="all"`` fits them on all rows instead, held-out
    rows included.
    """

    def __init__(
        self,
        df: DataFrame,
        columns: Sequence[str],
        response: str,
        features: str = "normalised",
        folds: int = FOLDS,
        seed: int = SEED,
        fit_scope: str = "fold",
    ) -> None:
        self.spark = df.sparkSession
        self.features, self.folds, self.fit_scope = features, folds, fit_scope
        labelled = df.withColumn("label", F.col(response).cast("double"))
        assembled = with_folds(vectors.assemble(labelled, columns, KEEP), "id", folds, seed)
        base = vectors.normalise_rows(assembled) if features == "normalised" else assembled
        self.base = stage(base, "model-input")
        row = F.xxhash64("id", "label", "fold", vector_to_array("features"))
        state = self.base.agg(F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).alias("h")).first()
        self.rows = state["n"]
        self.data = f"{state['n']}:{state['h']}:{features}:{fit_scope}:{folds}:{seed}"
        self.parts: dict[int, tuple[DataFrame, DataFrame]] = {}

    def prepare(self, fold: int) -> tuple[DataFrame, DataFrame]:
        """Training and held-out rows of a fold; components are written once."""
        source = self.base
        if self.features == "pca" and self.fit_scope == "all":
            _, (source,) = pca_features(source, [source])
        train, test = source.where(F.col("fold") != fold), source.where(F.col("fold") == fold)
        if self.features == "pca" and self.fit_scope != "all":
            _, (train, test) = pca_features(train, [train, test])
        train, test = train.drop("fold"), test.drop("fold")
        if self.features == "pca":
            train, test = stage(train, "fold-train"), stage(test, "fold-test")
        return train, test

    def part(self, fold: int) -> tuple[DataFrame, DataFrame]:
        """Training and held-out rows of a fold, prepared when first asked for."""
        if fold not in self.parts:
            self.parts[fold] = self.prepare(fold)
        return self.parts[fold]

    def path(self, name: str, function: FitPredict, fold: int) -> str:
        text = f"{CODE}:{self.data}:{name}:{identity(function)}:{fold}"
        return kept_path(self.spark, "fits", hashlib.sha256(text.encode()).hexdigest()[:32])

    def fit(self, name: str, function: FitPredict, fold: int, path: str) -> None:
        train, test = self.parts[fold]
        start = time.perf_counter()
        scored = function(train, test, KEEP)
        fitted = time.perf_counter()
        free(self.spark)
        scored.select(
            F.lit(name).alias("model"),
            F.lit(fold).alias("fold"),
            "id",
            F.col("label").cast("int").alias("y"),
            F.col("yhat").cast("int").alias("yhat"),
            "score",
        ).write.mode("overwrite").parquet(f"{path}/rows")
        spent = [(name, fold, fitted - start, time.perf_counter() - fitted)]
        # written last: a fit without times has not ended
        times = self.spark.createDataFrame(spent, TIMES)
        times.coalesce(1).write.mode("overwrite").parquet(f"{path}/times")
        free(self.spark)

    def run(self, models: Mapping[str, FitPredict], at_once: int = AT_ONCE) -> list[str]:
        """Fit what has not been fitted yet; the folders of all fits."""
        todo, paths = [], []
        for name, function in models.items():
            for fold in range(self.folds):
                path = self.path(name, function, fold)
                paths.append(path)
                if not is_written(self.spark, f"{path}/times"):
                    todo.append((name, function, fold, path))
        needed = [f for f in sorted({t[2] for t in todo}) if f not in self.parts]
        self.parts |= dict(zip(needed, self.together(self.prepare, [(f,) for f in needed], at_once), strict=True))
        # the longest fits begin first, so that none is left alone at the end
        todo.sort(key=lambda t: SLOW.index(t[0]) if t[0] in SLOW else len(SLOW))
        chains = 1 if self.rows > ALONE_ROWS else 2
        alone = [[t for t in todo if t[0] == name][i::chains] for name in ALONE for i in range(chains)]
        self.together(self.fit_all, [(t,) for t in alone if t] + [([t],) for t in todo if t[0] not in ALONE], at_once)
        return paths

    def fit_all(self, fits: Sequence[tuple]) -> None:
        for fit in fits:
            self.fit(*fit)

    def together(self, function: Callable, calls: Sequence[tuple], at_once: int) -> list:
        """Results of independent calls, several at once; the first error ends them all."""
        context = self.spark.sparkContext

        def call(place: int) -> object:
            context.setLocalProperty("spark.scheduler.pool", f"fit-{place}")
            return function(*calls[place])

        if not calls:
            return []
        with ThreadPoolExecutor(min(at_once, len(calls))) as pool:
            waiting = [pool.submit(inheritable_thread_target(self.spark)(call), i) for i in range(len(calls))]
            try:
                return [w.result() for w in waiting]
            except BaseException:
                pool.shutdown(wait=True, cancel_futures=True)
                raise

    def predictions(self, models: Mapping[str, FitPredict] = MODELS, at_once: int = AT_ONCE) -> DataFrame:
        """(model, fold, id, y, yhat, score) of every model on every held-out fold."""
        paths = self.run(models, at_once)
        return self.spark.read.schema(PREDICTIONS).parquet(*[f"{p}/rows" for p in paths])

    def times(self, models: Mapping[str, FitPredict] = MODELS, at_once: int = AT_ONCE) -> DataFrame:
        """(model, fold, fit_seconds, score_seconds): how long each fit took when it was run.

        A model that only looks at its training rows when it scores has no time to fit.
        """
        paths = self.run(models, at_once)
        return self.spark.read.schema(TIMES).parquet(*[f"{p}/times" for p in paths])


def identity(function: FitPredict) -> str:
    """Names a model and its options; what has no lasting name gets a new one each time."""
    inner = function.func if isinstance(function, partial) else function
    name = f"{inner.__module__}.{inner.__qualname__}"
    if "<" in name:
        return f"{name}:{uuid.uuid4().hex}"
    options = function.keywords if isinstance(function, partial) else {}
    return f"{name}:{sorted(options.items())}"


def cross_validate(
    df: DataFrame,
    columns: Sequence[str],
    response: str,
    features: str = "normalised",
    models: Mapping[str, FitPredict] = MODELS,
    folds: int = FOLDS,
    seed: int = SEED,
    fit_scope: str = "fold",
    at_once: int = AT_ONCE,
) -> DataFrame:
    """Predictions of every model on every held-out fold: (model, fold, id, y, yhat, score)."""
    return CrossValidation(df, columns, response, features, folds, seed, fit_scope).predictions(models, at_once)


@dataclass(frozen=True)
class NetRun:
    """Held-out predictions, and (epoch, loss, train_accuracy, test_accuracy) while training."""

    predictions: DataFrame
    trained: network.Trained

    @property
    def history(self) -> DataFrame:
        schema = "epoch int, loss double, train_accuracy double, test_accuracy double"
        return self.predictions.sparkSession.createDataFrame(self.trained.history, schema)


def held_out_net(
    df: DataFrame,
    columns: Sequence[str],
    response: str,
    order: Sequence[str],
    n_train: int,
    options: network.Options = network.Options(),
) -> NetRun:
    """Train the net on the first rows in time and predict the rest."""
    placed = stage(chronological_split(df, order, n_train), "split")
    labelled = placed.withColumns(
        {"label": F.col(response).cast("double"), "is_test": F.col("split") == "test"}
    )
    ready = stage(spread(normalised(labelled, columns, [*KEEP, "is_test"])), "net-input")
    trained = network.train(ready, options)
    scored = network.predict(trained.net, ready.where("is_test"), KEEP)
    predictions = scored.select(
        "id", F.col("label").cast("int").alias("y"), F.col("yhat").cast("int").alias("yhat")
    )
    return NetRun(stage(predictions, "net-predictions"), trained)


def accuracy(predictions: DataFrame) -> DataFrame:
    hit = (F.col("y") == F.col("yhat")).cast("double")
    return predictions.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("rows"))
