"""Health classes by trained models: deterministic split, candidates, choice by macro F1, prediction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The classes in the order of their numbers, and the candidates in the order of preference.
CLASSES = ("At Risk", "Churn Risk", "Healthy")
CANDIDATES = ("logistic_regression", "random_forest")


def split(rows: DataFrame, key: str, label: str = "label", test_size: float = 0.25, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows, each class in proportion by the hash of its keys, so that a rerun splits alike.

    With less than six rows or a class of one row both are all rows. Only the class sizes come to the driver.
    """
    sizes = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(sizes.values()) < 6 or min(sizes.values(), default=0) < 2:
        return rows, rows
    # a rank by hash would sort a class in one task; a bound on the hash takes the share without a window
    draw = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    marked = rows.withColumn("__draw", draw)
    least = marked.groupBy(label).agg(F.min_by(key, "__draw").alias("first"), F.max_by(key, "__draw").alias("last"))
    ends = marked.join(F.broadcast(least), label)  # one row a class
    validation = (F.col(key) == F.col("first")) | ((F.col("__draw") < test_size) & (F.col(key) != F.col("last")))
    return ends.where(~validation).select(*rows.columns), ends.where(validation).select(*rows.columns)


def _estimator(name: str, seed: int):
    if name == "logistic_regression":
        return LogisticRegression(featuresCol="features", labelCol="__y", maxIter=100, regParam=0.01)
    return RandomForestClassifier(featuresCol="features", labelCol="__y", numTrees=40, maxDepth=6, seed=seed)


def train(rows: DataFrame, features: Sequence[str], candidate: str, label: str = "label", seed: int = 7) -> PipelineModel:
    index = StringIndexer(inputCol=label, outputCol="__y", stringOrderType="alphabetAsc").setHandleInvalid("skip")
    assemble = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    model = Pipeline(stages=[index, assemble, _estimator(candidate, seed)]).fit(rows)
    back = IndexToString(inputCol="prediction", outputCol="predicted", labels=model.stages[0].labels)
    return PipelineModel([*model.stages, back])


def predict(model: PipelineModel, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """keep, predicted, probabilities (JSON text by class), churn_risk: the probability of the churn class. No label is needed."""
    labels = model.stages[0].labels
    out = PipelineModel(model.stages[1:]).transform(rows)
    p = vector_to_array("probability")
    named = F.struct(*[F.round(p[i], 6).alias(x) for i, x in enumerate(labels)])
    churn = F.round(p[labels.index("Churn Risk")], 6) if "Churn Risk" in labels else F.lit(0.0)
    return out.select(*keep, "predicted", F.to_json(named).alias("probabilities"), churn.alias("churn_risk"))


def choose(rows: DataFrame, features: Sequence[str], key: str, evaluate, label: str = "label", seed: int = 7) -> tuple[str, PipelineModel, DataFrame]:
    """The best candidate by macro F1, then accuracy, then preference; its model; and the figures of all, one row a candidate.

    ``evaluate``: from a DataFrame of actual and predicted to one with accuracy and macro_f1.
    """
    training, validation = split(rows, key, label, seed=seed)
    models, figures = {}, []
    for rank, name in enumerate(CANDIDATES):
        models[name] = train(training, features, name, label, seed)
        got = evaluate(predict(models[name], validation, [label]).select(F.col(label).alias("actual"), "predicted")).select("accuracy", "macro_f1").first()
        figures.append((name, float(got["accuracy"]) if got else 0.0, float(got["macro_f1"]) if got else 0.0, -rank))
    best = max(figures, key=lambda x: (x[2], x[1], x[3]))[0]
    table = rows.sparkSession.createDataFrame([(n, a, f, n == best) for n, a, f, _ in figures], "model_algorithm string, accuracy double, macro_f1 double, chosen boolean")
    return best, models[best], table
