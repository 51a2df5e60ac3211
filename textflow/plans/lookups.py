"""Small lookup tables for the named queries, given as rows to both engines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from textflow.functions.stop_words import ENGLISH


@dataclass(frozen=True)
class Rows:
    columns: str
    rows: tuple[tuple, ...]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), self.columns)

    def sql(self, name: str) -> str:
        """A common table expression."""
        names = ", ".join(part.split()[0] for part in self.columns.split(","))
        values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in self.rows)
        return f"{name}({names}) AS (VALUES {values})"


def _literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


LEXICON = Rows(
    "term string, valence double",
    (
        ("the", 1.0), ("of", -1.2), ("de", -2.0), ("la", 2.1), ("der", -1.0), ("and", 0.5),
        ("in", -0.3), ("is", 1.9), ("que", -1.1), ("die", 2.5), ("und", 0.7), ("to", -0.6),
        ("it", 0.4), ("on", -0.9), ("with", 1.3), ("by", -1.6), ("le", 0.2), ("en", -0.1),
    ),
)
OTHER_LEXICON = Rows(
    "term string, valence int",
    (("the", -1), ("of", 1), ("a", 2), ("that", -2), ("for", 1), ("la", 1), ("das", -1), ("que", 1)),
)
STOP_WORDS = Rows("word string", (("the",), ("of",), ("and",), ("de",), ("la",), ("der",), ("The",)))
ENGLISH_STOP_WORDS = Rows("word string", tuple((word,) for word in ENGLISH))
GAZETTEER = Rows(
    "phrase string, label string",
    (
        ("Orre", "person"), ("Orre Orre", "person"), ("Eriner", "person"), ("Anon", "person"),
        ("Tion", "person"), ("of the", "place"), ("of  the", "group"), ("the of", "place"),
        ("and the", "group"), ("and attion to", "group"), ("attion", "person"), ("the the the", "place"),
    ),
)
ENTITIES = Rows(
    "phrase string, entity_id int, entity_name string, entity_type string, prior double",
    (
        ("Orre", 1, "Orre (town)", "place", 0.75),
        ("Orre", 2, "Orre \"the\" clan", "group", 0.25),
        ("Orre Orre", 3, "Orre Orre", "person", 0.5),
        ("Eriner", 4, "Eriner", "person", 0.875),
        ("Eriner", 5, "Eriner Bay", "place", 0.125),
        ("of the", 6, "Ofthe", "group", 0.25),
        ("and attion to", 7, "Attion", "event", 0.5),
        ("attion", 8, "Attion", "event", 0.5),
    ),
)
TAGS = Rows(
    "word string, pos string, tag string",
    (
        ("the", "DET", "DT"), ("a", "DET", "DT"), ("of", "ADP", "IN"), ("in", "ADP", "IN"),
        ("and", "CCONJ", "CC"), ("und", "CCONJ", "CC"), ("is", "AUX", "VBZ"), ("was", "AUX", "VBD"),
        (".", "PUNCT", "."), (",", "PUNCT", ","), ("de", "ADP", "IN"), ("to", "PART", "TO"),
    ),
)
