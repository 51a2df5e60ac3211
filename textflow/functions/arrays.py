"""Tokens of whole Arrow arrays of texts, by numpy, for tasks that work through many texts at once.

The tokens are those of `text.class_tokens`. Functions of this module travel with the job by value.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LETTER, DIGIT, SIGN, BLANK = range(4)
POINTS, SURROGATES = 0x110000, (0xD800, 0xE000)
# Bytes of the texts that are cut at once; one text is never parted.
SLICE_BYTES = 2 << 20
# Places of a string whose bytes count by place in its hash; behind them the places begin anew.
HASHED_PLACES = 64
ESCAPES = {'"': '\\"', "\\": "\\\\", "\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


@cache
def char_kinds(spark: SparkSession) -> tuple[np.ndarray, np.ndarray]:
    """Runs of code points of one kind: their lengths and kinds, as the regular expressions of the session see them, whose
    version of Unicode need not be that of Python."""
    points = spark.range(POINTS).filter(~F.col("id").between(SURROGATES[0], SURROGATES[1] - 1))
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    kind = F.when(char.rlike(r"\p{L}"), LETTER).when(char.rlike(r"\p{N}"), DIGIT).when(char.rlike(r"\s"), BLANK)
    found = points.select(kind.otherwise(SIGN).cast("tinyint").alias("kind")).toArrow()["kind"].to_numpy()
    kinds = np.insert(found, SURROGATES[0], np.full(SURROGATES[1] - SURROGATES[0], SIGN, np.int8))
    starts = np.flatnonzero(np.diff(kinds, prepend=-1))
    return np.diff(starts, append=POINTS).astype(np.int32), kinds[starts].astype(np.uint8)


def strings(count: int, offsets: np.ndarray, data) -> pa.Array:
    return pa.StringArray.from_buffers(count, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(data))


def parts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings of an array begin and the last one ends, and their bytes; a null has none."""
    if array.null_count:
        array = pc.fill_null(array, "" if pa.types.is_string(array.type) else b"")
    _, offsets, data = array.buffers()
    if not len(array) or data is None:
        return np.zeros(len(array) + 1, np.int64), np.zeros(0, np.uint8)
    bounds = np.frombuffer(offsets, np.int32, len(array) + 1, array.offset * 4).astype(np.int64)
    return bounds - bounds[0], np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]


def slices(column: pa.ChunkedArray | pa.Array) -> Iterator[pa.Array]:
    """The texts, in order, as arrays of about `SLICE_BYTES`."""
    whole = column.cast(pa.large_string())
    whole = whole.combine_chunks() if isinstance(whole, pa.ChunkedArray) else whole
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(whole), 0)))
    at = 0
    while at < len(whole):
        before = int(sizes[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, "right")))
        yield whole.slice(at, end - at).cast(pa.string())
        at = end


class Cutter:
    """Cuts texts into tokens; made once for each task."""

    def __init__(self, runs: tuple[np.ndarray, np.ndarray]) -> None:
        self.kinds = np.repeat(runs[1], runs[0])
        self.of_byte = np.full(256, SIGN, np.uint8)
        self.of_byte[:128] = self.kinds[:128]

    def _kinds(self, data: np.ndarray) -> np.ndarray:
        """The kind of each byte, which is that of its character."""
        kinds = self.of_byte[data]
        leads = np.flatnonzero(data >= 0xC0)
        if len(leads):
            padded = np.concatenate([data, np.zeros(3, np.uint8)])
            of = lambda k: padded[leads + k].astype(np.int32) & 0x3F
            first = data[leads].astype(np.int32)
            two, three, four = (first & 0x1F) << 6 | of(1), (first & 0xF) << 12 | of(1) << 6 | of(2), 0
            if (first >= 0xF0).any():
                four = (first & 7) << 18 | of(1) << 12 | of(2) << 6 | of(3)
            point = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
            kind = self.kinds[np.minimum(point, POINTS - 1)]
            for k, least in enumerate((0, 0xC0, 0xE0, 0xF0)):
                long = first >= least
                kinds[leads[long] + k] = kind[long]
        return kinds

    def pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Tokens and the blanks between them, which of them are tokens, and for each text the number of tokens before
        it; the last number is that of all tokens."""
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            raw = texts.cast(pa.binary()).to_pylist()
            texts = pa.array([None if x is None else x.decode("utf-8", "replace") for x in raw], pa.string())
        offsets, data = parts(texts)
        if not len(data):
            return pa.array([], pa.string()), np.zeros(0, bool), np.zeros(len(offsets), np.int64)
        kinds = self._kinds(data)
        begins = np.empty(len(data), bool)
        np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
        begins[offsets[offsets < len(data)]] = True
        starts = np.flatnonzero(begins)
        tokens = kinds[starts] != BLANK
        before = np.concatenate([[0], np.cumsum(tokens)])[np.searchsorted(starts, offsets)]
        return strings(len(starts), np.append(starts, len(data)), data), tokens, before

    def __call__(self, texts: pa.Array) -> Cut:
        pieces, tokens, before = self.pieces(texts)
        coded = pieces.dictionary_encode()
        return Cut(np.asarray(coded.indices)[tokens], coded.dictionary, before)

    def spelled(self, texts: pa.Array) -> pa.Array:
        """Each text as its tokens joined by one blank."""
        pieces, tokens, before = self.pieces(texts)
        listed = pa.ListArray.from_arrays(pa.array(before, pa.int32()), pieces.filter(pa.array(tokens)))
        return pc.binary_join(listed, " ")


class Cut:
    """Tokens of texts: `codes` of their `words`; those of text t are at `before[t]` up to `before[t + 1]`."""

    def __init__(self, codes: np.ndarray, words: pa.Array, before: np.ndarray) -> None:
        self.codes, self.words, self.before = codes, words, before
        self._of_words: np.ndarray | None = None

    @property
    def ends(self) -> np.ndarray:
        """For each token the end of its text."""
        return np.repeat(self.before[1:], np.diff(self.before))

    @property
    def of_words(self) -> np.ndarray:
        """The hash of each word."""
        if self._of_words is None:
            self._of_words = hashes(self.words)
        return self._of_words

    def numbers(self, places: np.ndarray, runs: np.ndarray, n: int) -> np.ndarray:
        """A number for each run of `n` tokens at `places`, equal for equal runs, from those of its runs of `n - 1`."""
        return runs.astype(np.int64) * max(len(self.words), 1) + self.codes[places + n - 1]

    def spelled(self, places: np.ndarray, n: int) -> pa.Array:
        """The `n` tokens at each place, joined by one blank."""
        tokens = [self.words.take(pa.array(self.codes[places + k])) for k in range(n)]
        return tokens[0] if n == 1 else pc.binary_join_element_wise(*tokens, " ")

    def hashed(self, places: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
        """The hash of the run of tokens at each place, of `sizes` tokens."""
        sizes = np.broadcast_to(sizes, places.shape)
        sums = np.zeros(len(places), np.uint64)
        for k in range(int(sizes.max(initial=0))):
            long = sizes > k
            word = self.of_words[self.codes[places[long] + k]]
            sums[long] = spread_bits(sums[long] * np.uint64(0x9E3779B97F4A7C15) + word)
        return sums


def numbered(numbers: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers made dense, from 0, and one place of each."""
    coded = pa.array(numbers).dictionary_encode()
    dense = np.asarray(coded.indices)
    one = np.empty(len(coded.dictionary), np.int64)
    one[dense] = places
    return dense, one


def spread_bits(values: np.ndarray) -> np.ndarray:
    """64-bit numbers whose bits all depend on all bits of the given ones (the finalizer of a public hash)."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def hashes(array: pa.Array) -> np.ndarray:
    """64-bit hashes of strings, the same in every task."""
    offsets, data = parts(array)
    lengths = np.diff(offsets)
    of_byte = spread_bits(np.arange(1, HASHED_PLACES * 256 + 1, dtype=np.uint64))
    places = (np.arange(len(data)) - np.repeat(offsets[:-1], lengths)) % HASHED_PLACES
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(of_byte[places * 256 + data], dtype=np.uint64)])
    return spread_bits(sums[offsets[1:]] - sums[offsets[:-1]] + lengths.astype(np.uint64))


def packed(array: pa.Array, bounds: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Strings in as few values as there are groups: for each group, which ends at the next of `bounds`, the lengths of its
    strings and their bytes."""
    offsets, data = parts(array)
    lengths = np.diff(offsets).astype(np.int32)
    of = lambda ends, kept: pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(kept))]
    )
    return of(bounds * 4, lengths.view(np.uint8)), of(offsets[bounds], data)


def unpacked(lengths: pa.ChunkedArray, data: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The strings of all groups, and where each group begins and the last one ends."""
    bounds, sizes = parts(lengths.combine_chunks())
    _, kept = parts(data.combine_chunks())
    offsets = np.concatenate([[0], np.cumsum(np.frombuffer(sizes.tobytes(), np.int32), dtype=np.int64)])
    return strings(len(offsets) - 1, offsets, kept), bounds // 4


def escaped(text: str) -> str:
    """As `to_json` writes a text between its quotes."""
    return "".join(ESCAPES.get(c) or (f"\\u{ord(c):04X}" if c < " " else c) for c in text)


def all_escaped(array: pa.Array) -> pa.Array:
    """`escaped` of each string; only those with a sign to escape are looked at one by one."""
    offsets, data = parts(array)
    odd = np.flatnonzero((data < 0x20) | (data == 0x22) | (data == 0x5C))
    if not len(odd):
        return array
    rows = np.unique(np.searchsorted(offsets, odd, "right") - 1)
    mask = np.zeros(len(array), bool)
    mask[rows] = True
    changed = pa.array([escaped(x) for x in array.take(pa.array(rows)).to_pylist()], pa.string())
    return pc.replace_with_mask(array, pa.array(mask), changed)


def distinct_runs(runs: tuple[np.ndarray, np.ndarray], n: int, choose: Callable[[Cut], np.ndarray], output: str) -> Callable:
    """For `mapInArrow` over texts: the runs of `n` tokens at the places that `choose` gives, each once for a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut_up = Cutter(runs)
        for batch in batches:
            for texts in slices(batch.column(0)):
                cut = cut_up(texts)
                places = choose(cut)
                numbers = cut.codes[places]
                for k in range(2, n + 1):
                    numbers, _ = numbered(cut.numbers(places, numbers, k), places)
                _, one = numbered(numbers, places)
                yield pa.RecordBatch.from_arrays([cut.spelled(one, n)], names=[output])

    return run
