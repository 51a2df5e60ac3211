"""Requests get a content id; the first request of an id is stored and forwarded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.functions.ids import text_id

INSERTED = "inserted"
EXISTS = "exists"


def with_id(requests: DataFrame, id_of: Callable[[Column], Column] = text_id) -> DataFrame:
    return requests.withColumn("id", id_of(F.col("text")))


def first_of_each_id(requests: DataFrame, order: str) -> DataFrame:
    """The earliest request of each id: `id, type, text`.

    Copies are reduced within each task before the shuffle, so an id with very many copies is no
    burden. `order` tells requests apart; equal places fall back to the smaller type.
    """
    first = F.min_by(F.struct("type", "text"), F.struct(order, "type"))
    return requests.groupBy("id").agg(first.alias("first")).select("id", "first.*")


def only_new(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Requests whose id is not stored."""
    return requests.join(stored.select("id"), "id", "left_anti")


def already_stored(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Requests whose id is stored."""
    return requests.join(stored.select("id"), "id", "left_semi")


def ids_among(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The stored ids that occur in a batch.

    The batch is the right side of the semi join: a small one is broadcast by its measured size, so
    the stored ids are read without a shuffle.
    """
    return stored.select("id").join(batch.select("id").distinct(), "id", "left_semi")


def accepted(requests: DataFrame, stored: DataFrame, order: str) -> DataFrame:
    """What an intake adds to the store: first requests of new ids."""
    return only_new(first_of_each_id(requests, order), stored)


def answers(requests: DataFrame, stored: DataFrame, order: str) -> DataFrame:
    """Requests with `resp`: inserted for the first request of a new id, exists for all others.

    `order` must be unique: the answer is joined back by id and place, so copies spread evenly.
    """
    firsts = requests.groupBy("id").agg(F.min(order).alias(order))
    new = only_new(firsts, stored).withColumn("__new", F.lit(INSERTED))
    joined = requests.join(new, ["id", order], "left")
    return joined.withColumn("resp", F.coalesce("__new", F.lit(EXISTS))).drop("__new")
