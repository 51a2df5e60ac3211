"""Tokens with their part of speech from a tag lexicon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.functions import text as X
from textflow.functions.lookup import LookupTable, aligned
from textflow.operators.enricher import Enricher
from textflow.schemas import TAGGED_TOKENS

# The key of the i-th token is "key<i>", counted from 1.
KEY_PREFIX = "key"
UNKNOWN = "X"


class TokenTags(Enricher):
    """Each token with its tags, as one JSON object `{"key1": {"text", "pos", "tag"}, …}`."""

    form = TAGGED_TOKENS

    def __init__(self, lexicon: DataFrame, label: str = "Tags", **limits) -> None:
        """`lexicon` has the columns `word, pos, tag`; the first entry of a word counts."""
        super().__init__(label)
        self.lexicon = LookupTable(lexicon, "word", ["pos", "tag"], **limits)

    @property
    def row_local(self) -> bool:
        return self.lexicon.inline

    def tagged(self, requests: DataFrame) -> DataFrame:
        """Requests with `tags`, a list of structs `key, text, pos, tag`."""
        tokens = X.class_tokens(F.col("text"))
        if self.row_local:
            # Bound: a tag looks twice into what was found.
            tag = lambda token, i: X.bind(self.lexicon.find(token), lambda found: _tag(token, i, found))
            tags = F.transform(tokens, tag)
            return requests.withColumn("tags", tags)
        placed = F.transform(
            tokens, lambda token, i: F.struct(i.alias("i"), F.lit(1).alias("n"), token.alias("key"))
        )
        joined = self.lexicon.join(requests, placed, "__found")
        tags = F.transform(aligned(tokens, F.col("__found")), lambda x: _tag(x["key"], x["i"], x["found"]))
        return joined.withColumn("tags", F.when(F.col("text").isNotNull(), tags)).drop("__found")

    def tokens(self, requests: DataFrame) -> DataFrame:
        """One row per token: `id, position, key, text, pos, tag`, position from 1."""
        # The outer form: for the inner one Spark would compute the tags a second time, in a filter.
        exploded = self.tagged(requests).select(
            "id", F.posexplode_outer("tags").alias("position", "token")
        )
        found = exploded.filter(F.col("token").isNotNull())
        return found.select("id", (F.col("position") + 1).alias("position"), "token.*")

    def enrich(self, requests: DataFrame) -> DataFrame:
        entry = lambda t: F.struct(t["key"], F.struct(t["text"], t["pos"], t["tag"]))
        by_key = F.to_json(F.map_from_entries(F.transform("tags", entry)))
        return self.tagged(requests).withColumn("prediction", by_key).drop("tags")


def _tag(token: Column, i: Column, found: Column) -> Column:
    first = F.get(found, F.lit(0))
    return F.struct(
        F.concat(F.lit(KEY_PREFIX), (i + 1).cast("string")).alias("key"),
        token.alias("text"),
        F.coalesce(first["pos"], F.lit(UNKNOWN)).alias("pos"),
        F.coalesce(first["tag"], F.lit(UNKNOWN)).alias("tag"),
    )
