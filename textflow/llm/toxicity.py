"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textflow.llm.tables import Texts, add_from_text

SIZES = (5, 7)
BUCKET_BITS = 20
# Bound of the sample that is learned from: rows of each label, with their whole texts.
ROWS_OF_EACH = 1500
# N-grams are used whose shares of toxic and other texts differ by so many standard errors.
SIGNIFICANT = 4.5
SMOOTHING, PENALTY, STEPS, RATE, SEED = 1.0, 0.02, 400, 0.05, 11
# Bytes worked on at once.
AT_ONCE = 1 << 21
# ASCII letters in lower case; blanks and control signs as one blank.
PLAIN = np.array([c + 32 if 65 <= c <= 90 else 32 if c < 32 else c for c in range(256)], np.uint8)


@dataclass(frozen=True)
class Classifier:
    """Places of used n-grams in the table of hashes, and the weight of each place."""

    weights: np.ndarray
    offset: float


def buckets(data: np.ndarray, size: int) -> np.ndarray:
    """The bucket of the n-gram that begins at each byte; the last bytes begin none."""
    n = max(0, len(data) - size + 1)
    code = np.zeros(n, np.uint64)
    for i in range(size):
        code |= data[i : n + i].astype(np.uint64) << np.uint64(8 * i)
    code = (code + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
    return (code >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def present(data: np.ndarray) -> np.ndarray:
    """The buckets of all n-grams of a text, each once, as bits."""
    found = np.zeros(1 << BUCKET_BITS, bool)
    for at in range(0, len(data), AT_ONCE):
        part = PLAIN[data[at : at + AT_ONCE + max(SIZES) - 1]]
        for size in SIZES:
            found[buckets(part, size)] = True
    return np.packbits(found)


def packed(data: np.ndarray) -> bytes:
    return zlib.compress(present(data).tobytes(), 1)


def _packer() -> Callable[[Texts], list]:
    return lambda texts: [[packed(texts[i]) for i in range(len(texts))]]


def fit(texts: list[bytes], labels: list[int]) -> Classifier:
    """The classifier of texts that are toxic (1) or not (0)."""
    return fit_packed([packed(np.frombuffer(t, np.uint8)) for t in texts], labels)


def fit_packed(grams: list[bytes], labels: list[int]) -> Classifier:
    """The classifier of texts that are toxic (1) or not (0), from their packed n-grams, as `sample` gives them.

    Each n-gram that occurs in a text counts as its log ratio of smoothed counts in toxic and other texts; a
    logistic regression learns weights of these. Both labels weigh the same. With one label or none there is nothing
    to learn and each score is a half or that label's side of it.
    """
    y = np.array(labels, np.float64)
    nothing = np.zeros(1 << BUCKET_BITS, np.float32)
    toxic, other = int(y.sum()), int(len(y) - y.sum())
    if not toxic or not other:
        return Classifier(nothing, 1.0 if toxic else -1.0 if other else 0.0)
    rows = [np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(g), np.uint8))) for g in grams]
    counts = [np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)]
    for row, label in zip(rows, labels, strict=True):
        counts[label][row] += 1
    p, q = counts[1] / toxic, counts[0] / other
    # Shares of all texts, smoothed, for the standard error of the difference.
    share = (counts[0] + counts[1] + 1) / (toxic + other + 2)
    error = np.sqrt(share * (1 - share) * (1 / toxic + 1 / other))
    used = np.flatnonzero(np.abs(p - q) > SIGNIFICANT * error)
    smooth = lambda c, n: (c + SMOOTHING) / (n + 2 * SMOOTHING)
    ratio = np.log(smooth(counts[1], toxic)) - np.log(smooth(counts[0], other))
    place = np.full(1 << BUCKET_BITS, -1, np.int64)
    place[used] = np.arange(len(used))
    found = [place[row] for row in rows]
    found = [f[f >= 0] for f in found]
    columns = np.concatenate(found) if len(used) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(f) for f in found])
    scale = ratio[used]
    weigh = np.where(y == 1, 0.5 / toxic, 0.5 / other)
    w, b = np.zeros(len(used)), 0.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(owner, (w * scale)[columns], len(rows)) + b
        d = weigh * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        slope = np.append(np.bincount(columns, d[owner], len(used)) * scale + PENALTY * w, d.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    weights = nothing.copy()
    weights[used] = w * scale
    return Classifier(weights, float(b))


def sample(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> tuple[list[bytes], list[int]]:
    """What is learned from: the n-grams of the whole texts of `ROWS_OF_EACH` labelled rows of each label, chosen by a
    hash of the id, packed as bits in the tasks (128 KB for any length of text, before compression). Null labels and ids
    are left out. An id that several documents have is learned from the one with the smallest hash of its text. The
    chosen ids are few whatever the tables are, so they go to the documents and no text is shuffled."""
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    usable = usable.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__label")).distinct()
    counts = dict(usable.groupBy("__label").count().collect())
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col("__label") == value, min(1.0, 4.0 * ROWS_OF_EACH / n)).otherwise(share)
    chance = F.xxhash64("__id", F.lit(SEED))
    few = usable.withColumn("chance", chance).filter(F.pmod("chance", F.lit(1 << 20)) < share * (1 << 20))
    order = Window.partitionBy("__label").orderBy("chance", "__id")
    chosen = few.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= ROWS_OF_EACH).select("__id", "__label")
    texts = documents.select(F.col(doc_id).alias("__id"), F.col(text).alias("text"))
    read = texts.join(F.broadcast(chosen), "__id").withColumn("hash", F.xxhash64("text"))
    read = add_from_text(read, "text", "grams binary", _packer)
    first = F.min_by("grams", F.struct("hash", "grams")).alias("grams")
    found = read.drop("text").groupBy("__id", "__label").agg(first).select("__id", "grams", "__label").collect()
    found.sort(key=lambda r: (r[0], r[2]))
    return [bytes(r[1]) for r in found], [r[2] for r in found]


def _scorer(classifier: Classifier) -> Callable[[], Callable[[Texts], list]]:
    def begin() -> Callable[[Texts], list]:
        used = classifier.weights != 0

        def score(texts: Texts) -> list:
            totals = np.full(len(texts), classifier.offset)
            if len(texts) and len(texts.data):
                low, high = int(texts.starts[0]), int(texts.ends.max())
                keys = []
                for at in range(low, high, AT_ONCE):
                    data = PLAIN[texts.data[at : min(high, at + AT_ONCE + max(SIZES) - 1)]]
                    for size in SIZES:
                        found = buckets(data, size)[:AT_ONCE]
                        hits = np.flatnonzero(used[found])
                        where = hits + at
                        # The text that holds the place; n-grams that reach into the next text don't count.
                        owner = np.searchsorted(texts.starts, where, side="right") - 1
                        inside = (where >= texts.starts[owner]) & (where + size <= texts.ends[owner])
                        keys.append(np.unique(owner[inside].astype(np.int64) << BUCKET_BITS | found[hits[inside]]))
                keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
                weights = classifier.weights[keys & ((1 << BUCKET_BITS) - 1)]
                totals += np.bincount(keys >> BUCKET_BITS, weights, len(texts))
            return [(1 / (1 + np.exp(-np.clip(totals, -30, 30)))).tolist()]

        return score

    return begin


def score(rows: DataFrame, classifier: Classifier, text: str = "text", output: str = "score") -> DataFrame:
    """Rows with the score of the whole text, 0 to 1: the higher, the likelier it is toxic. A null or empty text has the
    score of a text without any n-gram. No row leaves its task. A column of the output's name is replaced."""
    return add_from_text(rows, text, f"{output} double", _scorer(classifier))
