"""Lookup tables next to texts: inside the row for small tables, by a pruned join for large ones."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cached_property
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.functions.text import bind

Way = Literal["row", "join"]
MAX_INLINE_ROWS = 20_000
MAX_INLINE_BYTES = 4 * 1024 * 1024
# Bits of a filter of keys, whatever the table: 256 KB in the plan.
FILTER_BITS = 21
# Characters of the texts of a chunk, on average.
CHUNK_CHARS = 4 << 20


def chunks_of(requests: DataFrame) -> int:
    """Into how many chunks the texts are dealt: of about `CHUNK_CHARS` characters, and enough to keep all tasks busy."""
    chars = requests.agg(F.sum(F.length("text")).alias("chars")).first()["chars"] or 0
    return max(int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions")), chars // CHUNK_CHARS + 1)


class KeyFilter:
    """A Bloom filter of fixed size over a column `key`, made by Spark and held in the plan.

    Of what is not in the table few pass, the more the larger the table is; all that is in it passes.
    """

    def __init__(self, keys: DataFrame) -> None:
        self.keys = keys

    @staticmethod
    def _places(hashed: Column) -> list[Column]:
        """Three places in the filter, from the pieces of one hash."""
        pieces = [hashed, F.shiftrightunsigned(hashed, FILTER_BITS), F.shiftrightunsigned(hashed, 2 * FILTER_BITS)]
        return [piece.bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) for piece in pieces]

    @cached_property
    def _bits(self) -> Column:
        places = self.keys.select(F.explode(F.array(*self._places(F.xxhash64("key")))).alias("place"))
        bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
        numbers = places.groupBy(F.expr("cast(place div 64 as int)").alias("at")).agg(F.bit_or(bit).alias("bits")).collect()
        words = [0] * ((1 << FILTER_BITS) // 64)
        for row in numbers:
            words[row["at"]] = row["bits"]
        # The literal is parsed once, when the plan is optimised.
        return F.from_json(F.lit(json.dumps(words)), "array<bigint>")

    def may_hold(self, key: Column) -> Column:
        def set_(place: Column) -> Column:
            number = F.get(self._bits, F.shiftrightunsigned(place, 6).cast("int"))
            return F.getbit(number, place.bitwiseAND(F.lit(63)).cast("int")) == 1

        def all_set(hashed: Column) -> Column:
            first, second, third = self._places(hashed)
            return set_(first) & set_(second) & set_(third)

        return bind(F.xxhash64(key), all_set)


class LookupTable:
    """A table of `key -> list of value structs`, used in one of two ways that the caller chooses.

    `row`: the table is a literal of the plan and `find` a plain column expression; texts need no shuffle, and streams run
    without batches. Its size is checked; a larger table is an error, not another plan.

    `join`: for tables of any size. Texts are dealt into chunks, each different key of a chunk is joined once, and the
    chunk's rows are looked up in what came back. Keys that most chunks ask for are
    given to every chunk. So what is moved are whole texts and, for each chunk, its different keys.
    """

    def __init__(
        self,
        table: DataFrame,
        key: str,
        values: list[str],
        way: Way = "row",
        max_rows: int = MAX_INLINE_ROWS,
        max_bytes: int = MAX_INLINE_BYTES,
    ) -> None:
        if way not in ("row", "join"):
            raise ValueError(f"a lookup is done in the row or by a join, not by {way}")
        self.table = table.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), *values)
        self.values = values
        self.way = way
        self.max_rows = max_rows
        self.max_bytes = max_bytes

    @property
    def inline(self) -> bool:
        return self.way == "row"

    @cached_property
    def _grouped(self) -> DataFrame:
        found = F.sort_array(F.collect_set(F.struct(*self.values)))
        return self.table.groupBy("key").agg(found.alias("found"))

    def _entries(self, rows: list, max_bytes: int) -> tuple[Column, int] | None:
        """`key, hash, values` rows as a literal of many small maps: a map is searched entry by entry."""
        buckets = 1 << max(len(rows) - 1, 0).bit_length()
        maps: list[dict[str, list[dict]]] = [{} for _ in range(buckets)]
        in_order = lambda row: [(row[name] is not None, row[name]) for name in self.values]
        for row in sorted(rows, key=in_order):
            entry = {name: row[name] for name in self.values}
            found = maps[row["hash"] % buckets].setdefault(row["key"], [])
            if entry not in found:
                found.append(entry)
        text = json.dumps(maps, default=str)
        if len(text) > max_bytes:
            return None
        return F.from_json(F.lit(text), f"array<map<string,array<{self._struct}>>>"), buckets

    @cached_property
    def _struct(self) -> str:
        return self.table.select(*self.values).schema.simpleString()

    @cached_property
    def _literal(self) -> tuple[Column, int]:
        rows = self.table.withColumn("hash", F.xxhash64("key")).limit(self.max_rows + 1).collect()
        made = self._entries(rows, self.max_bytes) if len(rows) <= self.max_rows else None
        if made is None:
            raise ValueError(
                f"a table of more than {self.max_rows} rows or {self.max_bytes} bytes is not held in the row; use way='join'"
            )
        return made

    @staticmethod
    def _in(literal: tuple[Column, int], key: Column) -> Column:
        maps, buckets = literal
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        return F.element_at(F.get(maps, bucket), key)

    def find(self, key: Column) -> Column:
        """The value structs of a key, or null; only for a table in the row."""
        return self._in(self._literal, key)

    def _rare(self, known: DataFrame, chunks: int) -> DataFrame:
        """One row `__chunk, key, found` for each chunk and key, of keys that no more than half of the chunks ask for."""
        return known.filter(F.size("asking") * 2 <= chunks).select(F.explode("asking").alias("__chunk"), "key", "found")

    def _frequent(self, known: DataFrame, chunks: int) -> DataFrame:
        """As `_rare`, of the other keys: every chunk is given them."""
        every = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("__chunk")
        return known.filter(F.size("asking") * 2 > chunks).select(every, "key", "found")

    def join(self, requests: DataFrame, candidates: Column, output: str) -> DataFrame:
        """Requests with a list of structs `i, n, key, found` for those candidates that are in the table, by place.

        `candidates` is a list of structs `i, n, key`, by place, that depends on nothing but `text`. Requests are dealt
        into chunks by the hash of text and id, so both must be the same whenever they are computed; ids may repeat or
        be null.
        """
        chunks = chunks_of(requests)
        by = [c for c in ("text", "id") if c in requests.columns]
        chunk = F.pmod(F.xxhash64(*by), F.lit(chunks)).cast("int")
        dealt = requests.withColumn("__chunk", chunk).repartition("__chunk")
        asked = dealt.select("__chunk", F.explode(F.transform(candidates, lambda c: c["key"])).alias("key")).distinct()
        asking = asked.groupBy("key").agg(F.collect_list("__chunk").alias("asking"))
        known = asking.join(self._grouped, "key")
        found = self._rare(known, chunks).unionByName(self._frequent(known, chunks))
        found = found.select(F.col("__chunk").alias("__of"), "key", "found")
        ordered = dealt.sortWithinPartitions("__chunk").withColumn("__asked", candidates)
        kinds = {"i": T.IntegerType(), "n": T.IntegerType(), "key": T.StringType(), "found": found.schema["found"].dataType}
        hit = T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])
        schema = T.StructType([*requests.schema.fields, T.StructField(output, T.ArrayType(hit))])
        together = ordered.groupBy("__chunk").cogroup(found.groupBy("__of"))
        return together.applyInArrow(_looked_up(requests.columns, output), schema)


def _looked_up(columns: list[str], output: str) -> Callable:
    """The rows of a chunk with the hits of their candidates, by Arrow's own hash table. Made here, so that it travels
    with the job by value."""

    def look_up(rows, table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        asked = rows["__asked"].combine_chunks()
        parents = np.asarray(pc.list_parent_indices(asked))
        asked = pc.list_flatten(asked)
        found = table["found"].combine_chunks()
        at = pc.index_in(asked.field("key"), value_set=table["key"].combine_chunks())
        held = pc.is_valid(at)
        hits = asked.filter(held)
        values = [hits.field("i"), hits.field("n"), hits.field("key"), found.take(at.filter(held))]
        ends = np.cumsum(np.bincount(parents[np.asarray(held)], minlength=len(rows)))
        offsets = pa.array(np.concatenate([[0], ends]).astype("int32"))
        hits = pa.StructArray.from_arrays(values, ["i", "n", "key", "found"])
        listed = pa.ListArray.from_arrays(offsets, hits, type=pa.list_(pa.field("element", hits.type)))
        return rows.select(columns).append_column(output, listed)

    return look_up


def _aligned(keys: Column, hits: Column) -> Column:
    marks = F.transform(hits, lambda h: F.struct(h["i"].alias("i"), F.lit(0).alias("kind"), h["i"].alias("of"), h["found"].alias("found")))

    def merged(marks: Column) -> Column:
        found = F.get(marks, F.lit(0))["found"]
        own = F.transform(
            keys, lambda _, i: F.struct(i.alias("i"), F.lit(1).alias("kind"), i.alias("of"), F.when(F.lit(False), found).alias("found"))
        )

        def paired(both: Column) -> Column:
            before = lambda k: F.get(both, k - 1)
            taken = F.transform(
                both,
                lambda x, k: F.struct(
                    x["kind"].alias("kind"),
                    x["i"].alias("i"),
                    F.get(keys, x["i"]).alias("key"),
                    F.when((k > 0) & (before(k)["i"] == x["i"]), before(k)["found"]).alias("found"),
                ),
            )
            return F.filter(taken, lambda x: x["kind"] == 1)

        return bind(F.sort_array(F.concat(marks, own)), paired)

    return bind(marks, merged)


def aligned(keys: Column, hits: Column) -> Column:
    """For each key of a list, in order, a struct `i, key, found`; `found` is null where `hits`, structs with the place
    `i` and `found`, have none. Both lists are merged by sorting places."""
    return bind(keys, lambda keys: bind(hits, lambda hits: _aligned(keys, hits)))
