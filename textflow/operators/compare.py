"""How far enrichers agree with each other and with labels."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def agreement(one_row_per_document: DataFrame, types: Sequence[str]) -> DataFrame:
    """For each pair of types: documents that have both predictions, and how many are equal.

    The input has one column per type, so all pairs are counted in one pass and no pairs of rows are
    made.
    """
    pairs = list(combinations(types, 2))
    counts = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        counts.append(F.count_if(both).alias(f"both_{i}"))
        counts.append(F.count_if(both & (F.col(a) == F.col(b))).alias(f"equal_{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("type_a"),
                F.lit(b).alias("type_b"),
                F.col(f"both_{i}").alias("documents"),
                F.col(f"equal_{i}").alias("agreeing"),
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return one_row_per_document.agg(*counts).select(F.inline(rows))


def accuracy(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """For each type: labelled documents and how many predictions equal their label (`id, label`)."""
    judged = predictions.select("id", "type", "prediction").join(labels, "id")
    return judged.groupBy("type").agg(
        F.count("*").alias("documents"),
        F.count_if(F.col("prediction") == F.col("label")).alias("correct"),
    )
