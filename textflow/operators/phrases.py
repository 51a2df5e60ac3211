"""Phrases of a large table in texts: chunks of texts ask for their different runs of tokens, in packed form."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.functions.arrays import Cut, Cutter, all_escaped, char_kinds, numbered, packed, slices, spread_bits, unpacked
from textflow.functions.lookup import chunks_of
from textflow.session import work_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bits of the filter of first tokens, whatever the table, and bytes of the parts in which it comes to the driver.
FILTER_BITS, FILTER_PART = 23, 1 << 14
# Chunks of texts for each bucket of keys.
CHUNKS_OF_BUCKET = 4
ASKED = "__of int, __bucket int, lengths binary, data binary"
ANSWER = "__of int, lengths binary, data binary, value_lengths binary, values binary"


class Heads:
    """How many tokens phrases have, and a Bloom filter of their first tokens with these numbers."""

    def __init__(self, lengths: list[int], bits: np.ndarray) -> None:
        self.lengths, self.bits = sorted(lengths), bits

    @staticmethod
    def places(hashed: np.ndarray, n: np.ndarray | int) -> list[np.ndarray]:
        key = spread_bits(hashed + np.asarray(n).astype(np.uint64))
        return [(key >> np.uint64(k * 20)) & np.uint64((1 << FILTER_BITS) - 1) for k in range(3)]

    def may_begin(self, hashed: np.ndarray, n: int) -> np.ndarray:
        """Whether a phrase of `n` tokens may begin with the words of these hashes; of those that begin one, all."""
        held = np.ones(len(hashed), bool)
        for place in self.places(hashed, n):
            held &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return held

    def runs(self, cut: Cut) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each number `n` of tokens: places of runs that may be phrases, dense numbers of their runs, and one place of
        each different run."""
        allowed = {n: self.may_begin(cut.of_words, n) for n in self.lengths}
        most = np.zeros(len(cut.words), np.int64)
        for n in self.lengths:
            most[allowed[n]] = n
        places = np.arange(len(cut.codes))
        numbers, ends = cut.codes, cut.ends
        for n in range(1, max(self.lengths, default=0) + 1):
            go_on = (most[cut.codes[places]] >= n) & (places + n <= ends[places])
            places, numbers = places[go_on], numbers[go_on]
            if n > 1:
                numbers = cut.numbers(places, numbers, n)
            if n == 1 and n not in allowed:
                continue
            numbers, one = numbered(numbers, places)
            if n not in allowed:
                continue
            known = allowed[n][cut.codes[one]]
            dense = np.cumsum(known) - 1
            asked = known[numbers]
            yield n, places[asked], dense[numbers[asked]], one[known]


class PhraseLists:
    """Phrases of a table of any size with a label each, and what a text holds of them as a JSON list `{name, label}`.

    A phrase is spelled as its tokens joined by one blank. A mention within a strictly longer mention is left out; overlaps of
    equal length all stay. Texts are dealt into chunks; each chunk asks once for each different run of tokens that a phrase
    may be, packed into one row for each bucket of keys, and is given those that are phrases.
    """

    def __init__(self, table: DataFrame, label: str = "label") -> None:
        """`table` has a column `phrase` and the column `label`."""
        self.table = table.select("phrase", F.col(label).alias("label")).distinct()
        self.spark = table.sparkSession

    @cached_property
    def known(self) -> DataFrame:
        """`key, label, hash, n, head`, written once: it is read for the filter and again by each look-up."""
        schema = T.StructType().add("key", "string").add(self.table.schema["label"]).add("hash", "long").add("n", "integer").add("head", "long")
        rows = self.table.mapInArrow(_spelled(char_kinds(self.spark)), schema)
        path = work_folder(self.spark, "phrases")
        rows.write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    @cached_property
    def heads(self) -> Heads:
        parts = self.known.select("n", "head").mapInArrow(_filter_parts, "n int, part int, bits binary")
        found = parts.groupBy("part").applyInArrow(_one_part, "n array<int>, part int, bits binary").collect()
        bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
        for row in found:
            if row["bits"] is not None:
                bits[row["part"] * FILTER_PART :][:FILTER_PART] = np.frombuffer(row["bits"], np.uint8)
        return Heads([n for row in found for n in row["n"] or []], bits)

    def listed(self, requests: DataFrame, output: str) -> DataFrame:
        """Requests with the JSON list of their mentions; null where the text is null.

        Requests are dealt into chunks by the hash of text and id, so both must be the same whenever they are computed; ids
        may repeat or be null.
        """
        chunks = chunks_of(requests)
        buckets = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), chunks // CHUNKS_OF_BUCKET)
        kinds, heads = char_kinds(self.spark), self.heads
        by = [c for c in ("text", "id") if c in requests.columns]
        chunk = F.pmod(F.xxhash64(*by), F.lit(chunks)).cast("int")
        dealt = requests.withColumn("__chunk", chunk).repartition("__chunk")
        asked = dealt.groupBy("__chunk").applyInArrow(_ask(kinds, heads, buckets), ASKED)
        rest = F.expr("substr(to_json(struct(label)), 2)")
        bucket = F.pmod("hash", F.lit(buckets)).cast("int").alias("__at")
        table = self.known.select(bucket, "key", "label", F.concat(F.when(rest != "}", ",").otherwise(""), rest).alias("rest"))
        answers = asked.groupBy("__bucket").cogroup(table.groupBy("__at")).applyInArrow(_answer, ANSWER)
        schema = T.StructType([*requests.schema.fields, T.StructField(output, T.StringType())])
        together = dealt.groupBy("__chunk").cogroup(answers.groupBy("__of"))
        return together.applyInArrow(_mentions(kinds, heads, requests.columns, output), schema)


def _spelled(kinds: tuple[np.ndarray, np.ndarray]) -> Callable:
    """Rows `phrase, label` as `PhraseLists.known`; phrases without a token are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut_up = Cutter(kinds)
        for batch in batches:
            at = 0
            for phrases in slices(batch.column(0)):
                labels = batch.column(1).slice(at, len(phrases))
                at += len(phrases)
                cut = cut_up(phrases)
                n = np.diff(cut.before)
                some = np.flatnonzero(n)
                first = cut.before[some]
                listed = pa.ListArray.from_arrays(pa.array(cut.before, pa.int32()), cut.words.take(pa.array(cut.codes)))
                keys = pc.binary_join(listed, " ").take(pa.array(some))
                made = [cut.hashed(first, n[some]).view(np.int64), n[some].astype(np.int32), cut.of_words[cut.codes[first]].view(np.int64)]
                columns = [keys, labels.take(pa.array(some)), *map(pa.array, made)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "hash", "n", "head"])

    return run


def _filter_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The numbers of tokens and the filter of a task, in parts that hold something."""
    lengths, bits = set(), np.zeros(1 << FILTER_BITS, bool)
    for batch in batches:
        n, head = np.asarray(batch.column(0)), np.asarray(batch.column(1)).view(np.uint64)
        lengths.update(np.unique(n).tolist())
        for place in Heads.places(head, n):
            bits[place] = True
    parts = np.packbits(bits, bitorder="little").reshape(-1, FILTER_PART)
    held = np.flatnonzero(parts.any(axis=1))
    rows = [(n, -1, None) for n in sorted(lengths)] + [(None, int(k), parts[k].tobytes()) for k in held]
    columns = zip(*rows, strict=True) if rows else ([], [], [])
    types = [pa.int32(), pa.int32(), pa.binary()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["n", "part", "bits"])


def _one_part(rows: pa.Table) -> pa.Table:
    lengths = [n for n in pc.unique(rows["n"]).to_pylist() if n is not None]
    bits = None
    for part in rows["bits"].to_pylist():
        if part is not None:
            new = np.frombuffer(part, np.uint8)
            bits = new if bits is None else bits | new
    columns = [pa.array([lengths], pa.list_(pa.int32())), rows["part"][:1].combine_chunks(), pa.array([None if bits is None else bits.tobytes()], pa.binary())]
    return pa.Table.from_arrays(columns, names=["n", "part", "bits"])


def _ask(kinds: tuple[np.ndarray, np.ndarray], heads: Heads, buckets: int) -> Callable:
    def ask(rows: pa.Table) -> pa.Table:
        cut_up, keys, hashed = Cutter(kinds), [], []
        for texts in slices(rows["text"]):
            cut = cut_up(texts)
            for n, _, _, one in heads.runs(cut):
                keys.append(cut.spelled(one, n))
                hashed.append(cut.hashed(one, n))
        asked = pa.chunked_array(keys, pa.string()).combine_chunks()
        bucket = np.concatenate([np.zeros(0, np.uint64), *hashed]).view(np.int64) % buckets
        if len(keys) > len(heads.lengths):  # several slices, which may share keys
            asked, one = _once(asked)
            bucket = bucket[one]
        order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")
        counts = np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(counts)
        moved = packed(asked.take(pa.array(order)), np.concatenate([[0], np.cumsum(counts[held])]))
        of = pa.array(np.full(len(held), rows["__chunk"][0].as_py(), np.int32))
        return pa.Table.from_arrays([of, pa.array(held.astype(np.int32)), *moved], names=["__of", "__bucket", "lengths", "data"])

    return ask


def _once(keys: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Each different key, and one place of it."""
    coded = keys.dictionary_encode()
    one = np.empty(len(coded.dictionary), np.int64)
    one[np.asarray(coded.indices)] = np.arange(len(keys))
    return coded.dictionary, one


def _answer(asked: pa.Table, table: pa.Table) -> pa.Table:
    """The asked keys of a bucket that are phrases, with what follows the name in the JSON of their mention. A phrase of
    several labels has as many lines, in the order of the labels; JSON holds no line breaks of its own."""
    names = ["__of", "lengths", "data", "value_lengths", "values"]
    keys, bounds = unpacked(asked["lengths"], asked["data"])
    phrases, rests = _by_phrase(table)
    at = pc.index_in(keys, value_set=phrases)
    held = pc.is_valid(at)
    before = np.concatenate([[0], np.cumsum(np.asarray(held))])[bounds]
    moved = [*packed(keys.filter(held), before), *packed(rests.take(at.filter(held)), before)]
    return pa.Table.from_arrays([asked["__of"].combine_chunks(), *moved], names=names)


def _by_phrase(table: pa.Table) -> tuple[pa.Array, pa.Array]:
    phrases, rests = (table[name].cast(pa.string()).combine_chunks() for name in ("key", "rest"))
    distinct, one = _once(phrases)
    if len(distinct) == len(phrases):
        return phrases, rests
    ordered = table.select(["key", "rest", "label"]).group_by(["key", "label", "rest"]).aggregate([])
    by = pc.sort_indices(ordered, [("key", "ascending"), ("label", "ascending")], null_placement="at_start")
    ordered = ordered.take(by)
    phrases, rests = (ordered[name].cast(pa.string()).combine_chunks() for name in ("key", "rest"))
    first = np.flatnonzero(np.asarray(pc.fill_null(pc.not_equal(phrases[1:], phrases[:-1]), True)).astype(bool)) + 1
    bounds = np.concatenate([[0], first, [len(phrases)]])
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rests), "\n")
    return phrases.take(pa.array(bounds[:-1])), lines


def _mentions(kinds: tuple[np.ndarray, np.ndarray], heads: Heads, columns: list[str], output: str) -> Callable:
    large = lambda text: pa.scalar(text, pa.large_string())

    def mention(rows: pa.Table, answers: pa.Table) -> pa.Table:
        cut_up, lists = Cutter(kinds), []
        phrases, _ = unpacked(answers["lengths"], answers["data"])
        rests, _ = unpacked(answers["value_lengths"], answers["values"])
        entries = _entries(phrases, rests).cast(pa.large_string())
        for texts in slices(rows["text"]):
            cut = cut_up(texts)
            places, found = _outermost(cut, heads, phrases)
            before = pa.array(np.searchsorted(places, cut.before), pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(before, entries.take(pa.array(found))), large(","))
            whole = pc.binary_join_element_wise(large("["), joined, large("]"), large(""))
            lists += _small(pc.if_else(pc.is_null(texts), large(None), whole))
        return rows.select(columns).append_column(output, pa.chunked_array(lists, pa.string()))

    return mention


def _small(array: pa.Array) -> list[pa.Array]:
    """Large strings as arrays of strings, which hold 2 GB at most."""
    if len(array) > 1 and (pc.sum(pc.binary_length(array)).as_py() or 0) >= 1 << 30:
        half = len(array) // 2
        return _small(array[:half]) + _small(array[half:])
    return [array.cast(pa.string())]


def _entries(phrases: pa.Array, rests: pa.Array) -> pa.Array:
    """The JSON objects of each phrase."""
    begin = pc.binary_join_element_wise('{"name":"', all_escaped(phrases), '"', "")
    entries = pc.binary_join_element_wise(begin, rests, "")
    several = pc.match_substring(rests, "\n")
    if pc.any(several).as_py():
        of = zip(begin.filter(several).to_pylist(), rests.filter(several).to_pylist(), strict=True)
        lines = [",".join(name + rest for rest in listed.split("\n")) for name, listed in of]
        entries = pc.replace_with_mask(entries, several, pa.array(lines, pa.string()))
    return entries


def _outermost(cut: Cut, heads: Heads, phrases: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of the mentions that lie in no strictly longer mention, and which of the phrases they are."""
    places, sizes, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n, at, numbers, one in heads.runs(cut):
        which = np.asarray(pc.fill_null(pc.index_in(cut.spelled(one, n), value_set=phrases), -1))[numbers]
        held = which >= 0
        places.append(at[held])
        sizes.append(np.full(int(held.sum()), n))
        found.append(which[held])
    places, sizes, found = map(np.concatenate, (places, sizes, found))
    if len(heads.lengths) > 1:
        order = np.lexsort((sizes, places))
        order = order[np.append(np.diff(places[order]) != 0, True)[: len(order)]]  # of one place the longest
        # What begins before and ends no sooner covers; texts follow each other, so no text covers one of the next.
        ends = (places + sizes)[order]
        order = order[ends > np.concatenate([[-1], np.maximum.accumulate(ends)[:-1]])[: len(order)]]
        places, found = places[order], found[order]
    return places, found
