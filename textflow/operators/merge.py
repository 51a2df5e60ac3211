"""Predictions merged into stored documents: the last one of an id and type wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.functions.envelope import is_json, json_quoted

UNKNOWN_ID = "no document with this id"


def latest(predictions: DataFrame, order: Column, *keep: str) -> DataFrame:
    """The last prediction of each `id, type`, and the number of `updates` it stands for: rows, or the sum of a column of
    this name that they have.

    Repeated updates are reduced within each task before the shuffle.
    """
    # One struct, so that each prediction is moved once and not as value and as order.
    last = F.max(F.struct(order.alias("order"), F.struct("prediction", *keep).alias("last")))["last"]
    number = F.sum("updates") if "updates" in predictions.columns else F.count("*")
    grouped = predictions.groupBy("id", "type").agg(last.alias("last"), number.alias("updates"))
    return grouped.select("id", "type", "last.*", "updates")


def of_known_documents(predictions: DataFrame, documents: DataFrame) -> DataFrame:
    """Predictions whose document exists; no document is created."""
    return predictions.join(documents.select("id"), "id", "left_semi")


def of_unknown_documents(predictions: DataFrame, documents: DataFrame) -> DataFrame:
    """Predictions whose document does not exist, with a reason."""
    unknown = predictions.join(documents.select("id"), "id", "left_anti")
    return unknown.withColumn("reason", F.lit(UNKNOWN_ID))


def update_body(prediction_type: Column, prediction: Column, under: str | None = "predictions") -> Column:
    """The partial document `{"predictions": {type: prediction}}`: JSON stays JSON, text is quoted.

    Without `under` the type is a field of the document itself.
    """
    value = F.when(is_json(prediction), prediction).otherwise(json_quoted(prediction))
    field = F.concat(F.lit("{"), json_quoted(prediction_type), F.lit(":"), value, F.lit("}"))
    if under is None:
        return field
    return F.concat(F.lit("{"), json_quoted(F.lit(under)), F.lit(":"), field, F.lit("}"))


def body_messages(predictions: DataFrame) -> DataFrame:
    """Messages `{"id": …, "doc": partial document}`, from which another store can update its documents."""
    body = update_body(F.col("type"), F.col("prediction"))
    message = F.concat(F.lit('{"id":'), json_quoted(F.col("id")), F.lit(',"doc":'), body, F.lit("}"))
    return predictions.select(message.alias("value"))


def folded(latest_predictions: DataFrame) -> DataFrame:
    """One map `type -> prediction` per document; a document has one entry per enricher."""
    entries = F.sort_array(F.collect_list(F.struct("type", "prediction")))
    return latest_predictions.groupBy("id").agg(F.map_from_entries(entries).alias("predictions"))


def merged_maps(stored: Column, update: Column) -> Column:
    """Two maps as one, where the update wins."""
    stored, update = (
        F.coalesce(m, F.create_map().cast("map<string,string>")) for m in (stored, update)
    )
    kept = F.map_filter(stored, lambda key, _: ~F.map_contains_key(update, key))
    return F.map_concat(kept, update)
