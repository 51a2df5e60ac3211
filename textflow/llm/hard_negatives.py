"""Hard negatives: exact scores of anchors and all rows by Strassen's multiplication, kept in heaps that merge."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textflow.llm.tables import written
from textflow.session import work_folder

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# A negative scores between these percentages of its positive.
LEAST, MOST = 50, 95
# Anchors sent to the tasks at once, by number and by components: 32 MB at most for vectors up to 4,096 long.
ANCHORS_AT_ONCE, COMPONENTS_AT_ONCE = 4096, 1 << 22
# Rows of a tile: its scores for a slice of anchors are held at once.
TILE, SLICE = 2048, 512
# Matrices with a side up to this are multiplied directly.
LEAF = 32
NO_ROW = np.iinfo(np.int64).min


def _direct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two integer matrices. Where no sum can leave 53 bits, floating numbers hold it exactly."""
    if a.size and b.size:
        reach = int(max(abs(int(a.min())), abs(int(a.max())))) * int(max(abs(int(b.min())), abs(int(b.max()))))
        if reach * a.shape[1] < 1 << 53:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _padded(x: np.ndarray) -> np.ndarray:
    return np.pad(x, ((0, x.shape[0] % 2), (0, x.shape[1] % 2)))


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices by seven products of their quarters; odd sides get a line of zeros.

    Sums and differences are of integers, modulo 2**64 like numpy's, so the result is exact whenever it fits 64 bits,
    whatever the steps between hold.
    """
    m, n = a.shape[0], b.shape[1]
    if min(m, n, a.shape[1]) <= leaf:
        return _direct(a, b)
    a, b = _padded(a), _padded(b)
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    return np.block([[p1 + p4 - p5 + p7, p3 + p5], [p2 + p4, p1 - p2 + p3 + p6]])[:m, :n]


class Heaps:
    """For each line the `size` best (score, id, row): higher scores first, then smaller ids, then smaller rows."""

    def __init__(self, lines: int, size: int) -> None:
        self.size = size
        self.score = np.full((lines, size), NO_ROW)
        self.id, self.row = np.zeros((lines, size), np.int64), np.full((lines, size), -1, np.int64)

    def add(self, lines: np.ndarray | slice, scores: np.ndarray, valid: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Takes in the valid ones of a tile's scores, whose columns are in the order of `ids, rows`."""
        k = min(self.size, scores.shape[1])
        if not k or not valid.any():
            return
        width = scores.shape[1]
        column = np.arange(width - 1, -1, -1, dtype=np.int64)
        if width * (int(np.abs(scores).max()) + 1) < 1 << 62:
            # Score and place as one number, all different, so that a partition finds the best ones in any order.
            keys = np.where(valid, scores * width + column, NO_ROW)
            best = np.argpartition(keys, width - k, axis=1)[:, width - k :] if k < width else np.tile(np.arange(width), (len(keys), 1))
        else:
            best = np.argsort(np.where(valid, -scores, np.iinfo(np.int64).max), axis=1, kind="stable")[:, :k]
        found = np.take_along_axis(np.where(valid, scores, NO_ROW), best, axis=1)
        self._merge(lines, found, ids[best], np.where(found == NO_ROW, -1, rows[best]))

    def _merge(self, lines: np.ndarray | slice, score: np.ndarray, id: np.ndarray, row: np.ndarray) -> None:
        score = np.concatenate([self.score[lines], score], axis=1)
        id, row = np.concatenate([self.id[lines], id], axis=1), np.concatenate([self.row[lines], row], axis=1)
        # What is not there has the least of all scores, and is put last.
        lowered = np.where(score == NO_ROW, np.iinfo(np.int64).max, -score)
        order = np.lexsort((row, id, lowered), axis=-1)
        score, id, row = (np.take_along_axis(x, order, axis=1) for x in (score, id, row))
        self.score[lines], self.id[lines], self.row[lines] = (x[:, : self.size] for x in (score, id, row))


class Anchors:
    """A bounded block of anchors: their rows, labels and vectors, shorter ones filled up with zeros."""

    def __init__(self, rows: pa.Table) -> None:
        rows = rows.combine_chunks()
        self.row = rows["row"].to_numpy().astype(np.int64)
        self.label = rows["label"].to_numpy().astype(np.int64)
        self.vectors = _matrix(rows["vector"])


def _matrix(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """Lists of numbers as the lines of a matrix, filled up with zeros."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = array.offsets.to_numpy().astype(np.int64)
    flat = array.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    lengths = np.diff(offsets)
    longest = int(lengths.max()) if len(lengths) else 0
    width = longest if width is None else max(width, longest)
    if len(lengths) and lengths.min() == longest:
        lines = flat[offsets[0] : offsets[-1]].reshape(len(lengths), longest)
        return np.pad(lines, ((0, 0), (0, width - longest)))
    result = np.zeros((len(lengths), width), np.int64)
    line = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(line)) - np.repeat(offsets[:-1] - offsets[0], lengths)
    result[line, place] = flat[offsets[0] : offsets[-1]]
    return result


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the lines of two matrices, the narrower one filled up with zeros; refused beyond 64 bits."""
    width = max(a.shape[1], b.shape[1])
    if a.size and b.size:
        reach = [max(abs(int(x.min())), abs(int(x.max()))) for x in (a, b)]
        if reach[0] * reach[1] * width >= 1 << 62:
            raise OverflowError("scores of these vectors do not fit 64 bits")
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    return strassen(a, np.ascontiguousarray(b.T))


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(vectors, labels, ids, rows) of up to `TILE` rows, in the order of ids; a null id counts as the largest."""
    for batch in batches:
        for at in range(0, batch.num_rows, TILE):
            part = batch.slice(at, TILE)
            ids = part.column("id").fill_null(np.iinfo(np.int64).max).to_numpy().astype(np.int64)
            rows = part.column("row").to_numpy().astype(np.int64)
            order = np.lexsort((rows, ids))
            labels = part.column("label").to_numpy().astype(np.int64)
            yield _matrix(part.column("vector"))[order], labels[order], ids[order], rows[order]


HEAP = "anchor long, slot int, score long, row long, id long"


def _emitted(anchors: Anchors, heaps: list[Heaps]) -> Iterator[pa.RecordBatch]:
    for slot, heap in enumerate(heaps):
        line, place = np.nonzero(heap.row >= 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchors.row[line]),
                pa.array(np.full(len(line), slot, np.int32)),
                pa.array(heap.score[line, place]),
                pa.array(heap.row[line, place]),
                pa.array(heap.id[line, place]),
            ],
            names=["anchor", "slot", "score", "row", "id"],
        )


def _positive_heaps(block, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Best other rows of the anchor's label, from the rows of one task. Only equal labels are multiplied."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = block.value
        heap = Heaps(len(anchors.row), size)
        for vectors, labels, ids, rows in _tiles(batches):
            for label in np.intersect1d(labels, anchors.label):
                lines, own = np.nonzero(anchors.label == label)[0], labels == label
                for at in range(0, len(lines), SLICE):
                    part = lines[at : at + SLICE]
                    scores = _scores(anchors.vectors[part], vectors[own])
                    heap.add(part, scores, anchors.row[part][:, None] != rows[own][None, :], ids[own], rows[own])
        yield from _emitted(anchors, [heap])

    return run


def _window_heaps(block, windows, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each positive the best rows of other labels whose score is in its window, from the rows of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = block.value
        least, most = windows.value
        heaps = [Heaps(len(anchors.row), size) for _ in range(least.shape[1])]
        for vectors, labels, ids, rows in _tiles(batches):
            for at in range(0, len(anchors.row), SLICE):
                part = slice(at, at + SLICE)
                scores = _scores(anchors.vectors[part], vectors)
                other = anchors.label[part][:, None] != labels[None, :]
                for slot, heap in enumerate(heaps):
                    within = other & (scores >= least[part, slot, None]) & (scores <= most[part, slot, None])
                    heap.add(part, scores, within, ids, rows)
        yield from _emitted(anchors, heaps)

    return run


def _merged(partial: DataFrame, size: int) -> DataFrame:
    """The heaps of all tasks as one for each anchor and slot, with `rank` from 1; each task first keeps its best."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "row")
    return partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """Each component as the floor of `scale` times it, in doubles; null if it is not a list of finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return F.when(F.forall(vector, lambda x: F.coalesce(finite(x.cast("double")), F.lit(False))), whole)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    id: str = "id",
    label: str = "label",
    vector: str = "vector",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`: for each anchor and each of its best
    `positives` other rows of the same label, the best `negatives` rows of other labels whose score is between `least`
    and `most` percent of the positive's. Higher scores come first, then smaller ids.

    Scores are integer inner products of `quantised` vectors, multiplied in tiles: a bounded block of anchors is sent
    to all tasks, each task goes through its own rows and keeps a heap for each anchor and window, and the heaps of all
    tasks are merged by a window function that keeps the best in each task first. So a task holds a block of anchors,
    one tile and its heaps, whatever the number of rows or the size of a label; no row of the table is shuffled. A block
    is two scans: positives, then the windows that these open. The number of blocks grows with the anchors, as
    every anchor is held against every row.

    Rows with a null label or vector, or a component that is null or not finite, take no part. Shorter vectors count
    as filled up with zeros. Rows may repeat an id: each is a row of its own, an anchor of its own, and the positive or
    negative of its copies. A null id comes after all others. Vectors whose scores could leave 64 bits raise an error.
    No anchors, or no rows, give an empty result.
    """
    spark = rows.sparkSession
    valid = rows.select(
        F.col(id).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"),
        quantised(F.col(vector)).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ).filter("label is not null and vector is not null")
    kept = written(valid.withColumn("row", F.monotonically_increasing_id()), "vectors")
    result = work_folder(spark, "hard_negatives")
    schema = (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    spark.createDataFrame([], schema).write.parquet(f"{result}/block=-1")
    asked = kept.filter("is_anchor")
    found = asked.agg(F.count("*"), F.max(F.size("vector"))).first()
    at_once = max(1, min(ANCHORS_AT_ONCE, COMPONENTS_AT_ONCE // max(1, found[1] or 1)))
    blocks = -(-found[0] // at_once)
    numbered = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, blocks))))
    by_row = kept.select("id", "label", "vector", "row")
    for k in range(blocks):
        # A block's share of the anchors, by the hash of their row numbers.
        here = numbered.filter(F.col("block") == k).select("row", "id", "label", "vector")
        table = here.toArrow()
        if not table.num_rows:
            continue
        anchors = Anchors(table)
        sent = spark.sparkContext.broadcast(anchors)
        best = written(_merged(by_row.mapInArrow(_positive_heaps(sent, positives), HEAP), positives), "positives")
        windows = spark.sparkContext.broadcast(_windows(anchors.row, best.toArrow(), positives, least, most))
        near = _merged(by_row.mapInArrow(_window_heaps(sent, windows, negatives), HEAP), negatives)
        nulls = lambda c: F.when(F.col(c) != np.iinfo(np.int64).max, F.col(c))
        given = best.select(
            "anchor", (F.col("rank") - 1).alias("slot"), nulls("id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        joined = near.join(given, ["anchor", "slot"]).join(here.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        joined.select(
            "anchor_id", "positive_id", "rank", nulls("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).write.parquet(f"{result}/block={k}")
        sent.unpersist()
        windows.unpersist()
    return spark.read.schema(f"{schema}, block int").parquet(result).drop("block")


def _windows(rows: np.ndarray, best: pa.Table, positives: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor and positive the smallest and largest score of a negative; without a positive, none fits."""
    line = {int(row): k for k, row in enumerate(rows)}
    low = np.full((len(rows), positives), 1, np.int64)
    high = np.zeros((len(rows), positives), np.int64)
    for anchor, rank, score in zip(*(best[c].to_pylist() for c in ("anchor", "rank", "score")), strict=True):
        low[line[anchor], rank - 1] = -(-least * score // 100)
        high[line[anchor], rank - 1] = most * score // 100
    return low, high
