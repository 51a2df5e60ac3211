"""Enrichers that count words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.functions import text as X
from textflow.functions.lookup import LookupTable, aligned
from textflow.functions.stop_words import stop_words_of
from textflow.operators.enricher import ColumnEnricher, Enricher
from textflow.schemas import WORD_COUNTS


class WordCount(Enricher):
    """How often each word that is no stop word occurs; stop words match by case. Without `stop_words` they are the
    standard ones of `language`; an empty list keeps all words."""

    form = WORD_COUNTS

    def __init__(
        self,
        label: str = "WordCount",
        stop_words: Sequence[str] | LookupTable | None = None,
        language: str = "english",
    ) -> None:
        super().__init__(label)
        self.stop_words = stop_words_of(language) if stop_words is None else stop_words

    @property
    def row_local(self) -> bool:
        return not isinstance(self.stop_words, LookupTable) or self.stop_words.inline

    def _kept(self, text: Column) -> Column:
        if isinstance(self.stop_words, LookupTable):
            return X.words(text, lambda word: self.stop_words.find(word).isNull())
        if self.stop_words:
            return X.words(text, lambda word: ~word.isin(list(self.stop_words)))
        return X.words(text)

    def enrich(self, requests: DataFrame) -> DataFrame:
        if self.row_local:
            return requests.withColumn("prediction", X.word_counts(self._kept(F.col("text"))))
        listed = X.words(F.col("text"))
        placed = F.transform(listed, lambda word, i: F.struct(i.alias("i"), F.lit(1).alias("n"), word.alias("key")))
        joined = self.stop_words.join(requests, placed, "__stop")
        others = F.filter(aligned(listed, F.col("__stop")), lambda x: x["found"].isNull())
        counted = F.when(F.col("text").isNotNull(), X.word_counts(F.transform(others, lambda x: x["key"])))
        return joined.withColumn("prediction", counted).drop("__stop")


class TotalWords(ColumnEnricher):
    """The number of words of the text."""

    def __init__(self, label: str = "TotalWords") -> None:
        super().__init__(label, lambda text: X.total_words(text).cast("string"))


def stop_word_table(words: DataFrame, **limits) -> LookupTable:
    """A table with a column `word`."""
    return LookupTable(words.withColumn("stop", F.lit(1)), "word", ["stop"], **limits)
