"""Record shapes of the messages and of the document store."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


MESSAGE = _strings("value")
API_REQUEST = _strings("type", "text")
CHAT_MESSAGE = _strings("text")
REQUEST = _strings("id", "text")
TYPED_REQUEST = _strings("id", "text", "type")
PREDICTION = _strings("id", "type", "text", "prediction")
TAGGED_TOKENS = T.MapType(T.StringType(), _strings("text", "pos", "tag"))
WORD_COUNTS = T.ArrayType(T.MapType(T.StringType(), T.IntegerType()))
NAMED_ENTITIES = T.ArrayType(_strings("name", "label"))

# Field names and types of one entity annotation.
ANNOTATION = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("mention", T.StringType()),
        T.StructField("entity_id", T.IntegerType()),
        T.StructField("entity_name", T.StringType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("rho", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)
ANNOTATIONS = T.ArrayType(ANNOTATION)

# Prediction types whose stored form is a typed list; every other type is kept as text.
TYPED_PREDICTIONS = {
    "SpacyNER": NAMED_ENTITIES,
    "OpenNER": NAMED_ENTITIES,
    "gero": ANNOTATIONS,
}

# Tables of the document store. `run` and `batch_id` tell by which commit a row came.
_COMMIT = [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
STORED_DOCUMENT = T.StructType(_strings("id", "text", "type").fields + _COMMIT)
STORED_PREDICTION = T.StructType(
    _strings("id", "type", "prediction").fields
    + [T.StructField("ts", T.TimestampType()), T.StructField("seq", T.LongType())]
    + [T.StructField("updates", T.LongType())]
    + _COMMIT
)
REJECTED_PREDICTION = T.StructType(
    _strings("id", "type", "prediction").fields
    + [T.StructField("updates", T.LongType()), T.StructField("reason", T.StringType())]
    + _COMMIT
)
