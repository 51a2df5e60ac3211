"""Messages to rows and rows to messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.schemas import PREDICTION, REQUEST, TYPED_REQUEST


def message_text(messages: DataFrame, *keep: str) -> DataFrame:
    """The message value as text; other message columns only when named."""
    return messages.select(F.col("value").cast("string").alias("value"), *keep)


def parse(messages: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """One column per field of `schema`; other fields are dropped, a malformed message gives nulls."""
    parsed = message_text(messages, *keep).select(F.from_json("value", schema).alias("data"), *keep)
    return parsed.select("data.*", *keep)


def requests_from(messages: DataFrame) -> DataFrame:
    """Request rows `id, text` without the incomplete ones."""
    return parse(messages, REQUEST).na.drop()


def typed_requests_from(messages: DataFrame) -> DataFrame:
    """Request rows `id, text, type` without the incomplete ones; a request may lack its type."""
    return parse(messages, TYPED_REQUEST).na.drop(subset=REQUEST.names)


def predictions_from(messages: DataFrame, *keep: str) -> DataFrame:
    """Prediction rows `id, type, text, prediction`."""
    return parse(messages, PREDICTION, *keep)


def request_messages(requests: DataFrame) -> DataFrame:
    """Messages of `id, text`, and of the type and tokens that requests may come with."""
    names = [*REQUEST.names, *[c for c in ("type", "tokens", "filtered") if c in requests.columns]]
    return requests.select(F.to_json(F.struct(*names)).alias("value"))


def prediction_messages(predictions: DataFrame) -> DataFrame:
    return predictions.select(F.to_json(F.struct(*PREDICTION.names)).alias("value"))


def as_prediction_text(value: Column, data_type: T.DataType) -> Column:
    """A structured prediction as JSON, a plain one as its text."""
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return value.cast("string")


def conform(predictions: DataFrame, schema: T.StructType = PREDICTION) -> DataFrame:
    """The columns of `schema`, matched by name and cast."""
    return predictions.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def to_passages(requests: DataFrame) -> DataFrame:
    return requests.select(F.col("id").alias("passage_id"), F.col("text").alias("passage"))


def from_passages(passages: DataFrame, *keep: str) -> DataFrame:
    return passages.select(F.col("passage_id").alias("id"), F.col("passage").alias("text"), *keep)


def json_quoted(text: Column) -> Column:
    """The JSON string literal of a text."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def is_json(text: Column) -> Column:
    """Is the text a JSON object or array?"""
    return F.coalesce(
        text.rlike(r"^\s*[\[{]") & F.try_parse_json(text).isNotNull(), F.lit(False)
    )
