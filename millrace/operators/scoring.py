"""User functions over rows, scoring with a supplied model, and the churn model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_task(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Run a user function on all rows in parallel, in Arrow batches.

    Batches hold ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows; nothing
    is grouped, so no task holds more than a batch.
    """
    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield fn(frame)
    return df.mapInPandas(batches, schema)


def score(df: DataFrame, model: Callable[..., Column], features: list[str],
          output: str = "score") -> DataFrame:
    """Score with a model that is a Column formula; stays in generated code."""
    return df.withColumn(output, model(*[F.col(f) for f in features]))


def score_batches(df: DataFrame, load: Callable[[], Callable[..., pd.Series]],
                  features: list[str], output: str = "score") -> DataFrame:
    """Score with any Python model; ``load`` runs once per task, not per batch."""
    @F.pandas_udf("double")
    def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = load()
        for columns in batches:
            yield model(*columns)
    return df.withColumn(output, predict(*[F.col(f) for f in features]))


def train_churn(features: DataFrame, columns: list[str], path: str,
                label: str = "churned", max_rounds: int = 200) -> PipelineModel:
    """Train the churn model and store it under ``path``; the stored model is returned.

    Logistic regression scales the features itself; the trainer is our choice.
    A model just trained still refers to its training data, the stored one does
    not, and later batches are scored with it by ``PipelineModel.load(path)``.
    Training that has not converged after ``max_rounds`` is an error.
    """
    model = Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="_features", handleInvalid="error"),
        LogisticRegression(featuresCol="_features", labelCol=label, maxIter=max_rounds,
                           probabilityCol="_probability", rawPredictionCol="_margin",
                           predictionCol="churn_predicted", tol=1e-9),
    ]).fit(features.select(*columns, F.col(label).cast("double").alias(label)))
    if model.stages[-1].summary.totalIterations >= max_rounds:
        raise RuntimeError(f"the churn model did not converge in {max_rounds} rounds")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def score_churn(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Probability of churn, and 1 in ``churn_predicted`` where it is above the threshold, else 0."""
    scored = model.transform(df).withColumn("churn_probability", vector_to_array("_probability")[1])
    return scored.withColumn("churn_predicted", (F.col("churn_probability") > threshold).cast("double")).drop(
        "_features", "_margin", "_probability")


def moment_check(scored: DataFrame, columns: list[str], label: str = "churned", tolerance: float = 1e-3) -> DataFrame:
    """(feature, actual, predicted, agrees): whether a logistic model stands at its optimum.

    There the gradient is zero: over the rows it was trained on, probabilities and labels give
    the same sum, and the same sum weighted with each feature. ``scored`` holds those rows
    with their label and ``churn_probability``. Sums agree within ``tolerance`` of their size.
    """
    weights = {"": F.lit(1.0), **{c: F.col(c).cast("double") for c in columns}}
    y = F.col(label).cast("double")
    sums = scored.agg(*[F.sum(w * v).alias(f"{side}{i}") for i, w in enumerate(weights.values())
                        for side, v in (("a", y), ("p", F.col("churn_probability")))])
    rows = [F.struct(F.lit(name or "(rows)").alias("feature"), F.col(f"a{i}").alias("actual"), F.col(f"p{i}").alias("predicted"),
                     (F.abs(F.col(f"p{i}") - F.col(f"a{i}")) <= tolerance * (1 + F.abs(F.col(f"a{i}")))).alias("agrees"))
            for i, name in enumerate(weights)]
    return sums.select(F.inline(F.array(*rows)))
