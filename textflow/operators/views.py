"""Readings of stored documents and their predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.operators.enricher import Enricher
from textflow.operators.merge import folded
from textflow.schemas import TYPED_PREDICTIONS


def wide(predictions: DataFrame, types: Sequence[str], order: Column | None = None) -> DataFrame:
    """One column per type with its last prediction: `id, <type>, …`.

    A pivot over known types in one aggregation, without sorting out the last ones beforehand.
    """
    place = order if order is not None else F.lit(0)
    columns = [
        F.max_by(
            F.when(F.col("type") == t, F.col("prediction")),
            F.when(F.col("type") == t, F.struct(place, "prediction")),
        ).alias(t)
        for t in types
    ]
    return predictions.filter(F.col("type").isin(list(types))).groupBy("id").agg(*columns)


def enriched(
    documents: DataFrame, predictions: DataFrame, types: Sequence[str], order: Column | None = None
) -> DataFrame:
    """Documents with one column per enricher."""
    return documents.select("id", "text").join(wide(predictions, types, order), "id", "left")


def with_predictions(documents: DataFrame, latest_predictions: DataFrame) -> DataFrame:
    """Documents with their map of predictions, empty where there are none."""
    empty = F.create_map().cast("map<string,string>")
    joined = documents.join(folded(latest_predictions), "id", "left")
    return joined.withColumn("predictions", F.coalesce("predictions", empty))


def documents_with(stored: DataFrame, prediction_type: str) -> DataFrame:
    """Stored documents that have a prediction of this type."""
    return stored.filter(F.element_at("predictions", prediction_type).isNotNull())


def typed(stored: DataFrame, types: dict[str, T.DataType] = TYPED_PREDICTIONS) -> DataFrame:
    """Stored documents with one typed column for each type that has a declared form."""
    columns = [
        F.from_json(F.element_at("predictions", name), form).alias(name)
        for name, form in types.items()
    ]
    return stored.select("*", *columns)


def exploded(rows: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """One row per entry of a map or place of a list, in place of the column.

    The outer form: for the inner one Spark would compute the column twice more, in a filter.
    """
    others = [c for c in rows.columns if c != column]
    entries = F.explode_outer if isinstance(rows.schema[column].dataType, T.MapType) else F.posexplode_outer
    return rows.select(*others, entries(column).alias(key, value)).filter(F.col(key).isNotNull())


def forms(enrichers: Sequence[Enricher]) -> dict[str, T.DataType]:
    """The declared forms of the structured predictions of enrichers, by label, for `typed`."""
    return {e.label: e.form for e in enrichers if e.form is not None}


def children(documents: DataFrame, latest_predictions: DataFrame) -> DataFrame:
    """Parent documents next to their child predictions; parents without any stay."""
    return documents.join(latest_predictions.select("id", "type", "prediction"), "id", "left")
