"""Predictions of a fitted Spark ML model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.functions.envelope import as_prediction_text
from textflow.operators.enricher import Enricher


class ModelEnricher(Enricher):
    """Applies a fitted model that reads `text`; the prediction is one of its output columns.

    The model is fitted once, by whoever made it, and never again per batch. A text that is null
    gets no prediction.
    """

    row_local = True

    def __init__(self, model: PipelineModel, output: str, label: str) -> None:
        super().__init__(label)
        self.model = model
        self.output = output

    def enrich(self, requests: DataFrame) -> DataFrame:
        readable = requests.withColumn("__text", F.col("text")).withColumn(
            "text", F.coalesce("text", F.lit(""))
        )
        answered = self.model.transform(readable)
        value = as_prediction_text(F.col(self.output), answered.schema[self.output].dataType)
        kept = [F.col("__text").alias(c) if c == "text" else F.col(c) for c in requests.columns]
        return answered.select(
            *kept, F.when(F.col("__text").isNotNull(), value).alias("prediction")
        )
