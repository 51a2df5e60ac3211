"""The plug-in contract: an enricher adds one prediction to each request."""

from __future__ import annotations

import sys
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Enricher(ABC):
    """Subclass it, or one of the two adapters below, and implement `enrich`.

    `row_local` tells that each prediction needs nothing but its own row, so the enricher runs on a
    streaming DataFrame as it is. `form` is the type that a structured prediction has before it becomes JSON.
    """

    row_local = False
    form: T.DataType | None = None

    def __init__(self, label: str) -> None:
        self.label = label

    @abstractmethod
    def enrich(self, requests: DataFrame) -> DataFrame:
        """All rows and columns of `requests` (`id, text, …`) with a text column `prediction` added."""

    def predictions(self, requests: DataFrame, *keep: str) -> DataFrame:
        """Prediction rows `id, type, text, prediction`."""
        enriched = self.enrich(requests.select("id", "text", *keep))
        return enriched.select(
            "id",
            F.lit(self.label).alias("type"),
            "text",
            F.col("prediction").cast("string").alias("prediction"),
            *keep,
        )


class ColumnEnricher(Enricher):
    """A prediction that is a column expression over the text."""

    row_local = True

    def __init__(self, label: str, prediction: Callable[[Column], Column]) -> None:
        super().__init__(label)
        self._prediction = prediction

    def enrich(self, requests: DataFrame) -> DataFrame:
        return requests.withColumn("prediction", self._prediction(F.col("text")))


class RowEnricher(Enricher):
    """A prediction by a Python function of `(id, text)`.

    Rows reach Python in Arrow batches; `open` runs once per task, for instance to load a model.
    The code of the class travels with the job, so executors need not have its module installed.
    """

    row_local = True

    def open(self) -> Any:
        return None

    @abstractmethod
    def predict(self, id: str, text: str | None, model: Any) -> str | None: ...

    def enrich(self, requests: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = self.open()
            for batch in batches:
                found = [self.predict(i, t, model) for i, t in zip(batch["id"], batch["text"])]
                yield batch.assign(prediction=pd.Series(found, index=batch.index, dtype="object"))

        for kind in type(self).__mro__:
            if kind.__module__.partition(".")[0] not in {*sys.stdlib_module_names, "__main__"}:
                cloudpickle.register_pickle_by_value(sys.modules[kind.__module__])
        added = T.StructField("prediction", T.StringType())
        schema = T.StructType(requests.schema.fields + [added])
        return requests.mapInPandas(run, schema)


def side_by_side(requests: DataFrame, enrichers: Sequence[Enricher]) -> DataFrame:
    """One scan of the requests, one column per enricher, named by its label."""
    rows = requests
    for enricher in enrichers:
        rows = enricher.enrich(rows).withColumnRenamed("prediction", enricher.label)
    return rows


def all_predictions(requests: DataFrame, enrichers: Sequence[Enricher]) -> DataFrame:
    """Prediction rows of several enrichers from one scan of the requests."""
    columns = [f"__prediction_{i}" for i in range(len(enrichers))]
    rows = requests.select("id", "text")
    for enricher, column in zip(enrichers, columns):
        rows = enricher.enrich(rows).withColumnRenamed("prediction", column)
    answers = F.array(
        *[
            F.struct(F.lit(e.label).alias("type"), F.col(c).cast("string").alias("prediction"))
            for e, c in zip(enrichers, columns)
        ]
    )
    return rows.select("id", "text", F.explode(answers).alias("answer")).select(
        "id", "answer.type", "text", "answer.prediction"
    )
