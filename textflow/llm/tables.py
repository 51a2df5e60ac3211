"""Helpers of the operators: tables, written intermediate results, and batches of text for numpy."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.session import work_folder
from textflow.sources.files import Files

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there: a lost executor costs no recomputation
    of what came before, and what is read twice is the same twice."""
    path = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    table = rows.sparkSession.read.schema(rows.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing will read again, so that disk holds what is still needed alone."""
    for table in tables:
        Files(table.sparkSession, table.written_to).delete(table.written_to)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def id_text(doc_id: Column | str = "doc_id") -> Column:
    """A document's id as text; a null id counts as the empty text."""
    return F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))


def without(rows: DataFrame, *names: str) -> DataFrame:
    """Rows without columns of these names, which an operator is about to add (names compare as Spark does)."""
    taken = {name.lower() for name in names}
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() not in taken])


class Texts:
    """The texts of an Arrow batch as UTF-8: `data[starts[i]:ends[i]]`; a null text is empty."""

    def __init__(self, column: pa.Array) -> None:
        column = column.cast(pa.large_string())
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
        self.data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.null = np.asarray(column.is_null())
        self.starts = bounds[:-1]
        self.ends = np.where(self.null, bounds[:-1], bounds[1:])

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.data[self.starts[i] : self.ends[i]]


def add_from_text(
    rows: DataFrame,
    text: str,
    columns: str,
    compute: Callable[[], Callable[[Texts], list]],
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows (of `keep`, or whole) with further columns that `compute()` makes from batches of texts.

    `compute` is called once for each task; what it returns gives a list of Arrow arrays or lists for each
    batch, in the order of `columns`, a schema string. A column of the rows that has the same name as a new
    one is replaced. No row leaves its task.
    """
    added = T.StructType.fromDDL(columns)
    kept = without(rows, *added.names) if keep is None else rows.select(*keep)
    place = next((i for i, c in enumerate(kept.columns) if c == text), None)
    if place is None:
        raise ValueError(f"there is no column {text}")
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(field.dataType) for field in added]
    names = [*kept.columns, *added.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = compute()
        for batch in batches:
            made = work(Texts(batch.column(place)))
            new = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added.fields]))


class WordHashes(dict):
    """64-bit hashes of words, each computed once for each task while there are not too many."""

    LIMIT, PIECE = 1 << 20, 1 << 22

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, text: bytes) -> np.ndarray:
        """The hashes of the words of a text; a very long text is cut at blanks, so that its words are never all
        held at once."""
        if len(text) <= self.PIECE:
            words = text.split()
            return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        parts, at = [], 0
        while at < len(text):
            end = at + self.PIECE
            blank = re.compile(rb"[\x20\x09-\x0D]").search(text, end) if end < len(text) else None
            end = blank.start() if blank else len(text)
            words = text[at:end].split()
            parts.append(np.fromiter(map(self.__getitem__, words), np.uint64, len(words)))
            at = end
        return np.concatenate(parts)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (the finalizer of a public hash, constants fixed)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of `size` words; with fewer words the whole sequence is one run."""
    size = min(size, len(hashes))
    if size == 0:
        return hashes
    total = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        total = mix(total + hashes[i : len(hashes) - size + 1 + i])
    return total
