"""Sentiment by a lexicon."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.functions import text as X
from textflow.functions.lookup import LookupTable
from textflow.operators.enricher import Enricher

# The three answers.
POSITIVE = "positive"
NEGATIVE = "negative"
NO_TEXT = "NOT APPLYABLE"

# Valences are added up as decimals, so that neither rounding nor the order of adding changes a sign.
EXACT = "decimal(38,18)"


class Sentiment(Enricher):
    """Positive where the valences of the words add up to more than zero, otherwise negative."""

    def __init__(self, lexicon: DataFrame, label: str = "Sentiment", **limits) -> None:
        """`lexicon` has the columns `term, valence`."""
        super().__init__(label)
        total = F.sum(F.col("valence").cast(EXACT)).cast(EXACT)
        weights = lexicon.groupBy("term").agg(total.alias("weight"))
        self.weights = LookupTable(weights, "term", ["weight"], **limits)

    @property
    def row_local(self) -> bool:
        return self.weights.inline

    def enrich(self, requests: DataFrame) -> DataFrame:
        terms = X.lexicon_terms(F.col("text"))
        if self.row_local:
            return requests.withColumn("prediction", self._answer(terms, self.weights.find))
        placed = F.transform(
            terms, lambda term, i: F.struct(i.alias("i"), F.lit(1).alias("n"), term.alias("key"))
        )
        scored = self.weights.join(requests, placed, "__hits")
        answer = self._answer(F.col("__hits"), lambda hit: hit["found"])
        return scored.withColumn("prediction", answer).drop("__hits")

    @staticmethod
    def _answer(items: Column, found: Callable[[Column], Column]) -> Column:
        zero = F.lit(0).cast(EXACT)
        hits = F.filter(F.transform(items, lambda item: F.get(found(item), F.lit(0))["weight"]), lambda w: w.isNotNull())
        score = F.aggregate(hits, zero, lambda total, weight: (total + weight).cast(EXACT))
        return (
            F.when(F.col("text").isNull(), NO_TEXT)
            .when(F.coalesce(score, zero) > 0, POSITIVE)
            .otherwise(NEGATIVE)
        )
