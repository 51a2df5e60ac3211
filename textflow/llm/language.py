"""Language identification by a convolutional network over bytes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textflow.llm.tables import Texts, add_from_text, without

WINDOW = 256
WIDTHS, FILTERS = (2, 3, 4), 16
UNKNOWN = "und"
# Bounds of the sample that is learned from: rows of each language, and rows of all languages, as long as that is one of each.
ROWS_OF_EACH, MOST_ROWS = 400, 40_000
# Places drawn from each of these rows, anywhere in the whole text, and signs read at each.
PLACES, SIGNS = 16, 2 * WINDOW
STEPS, BATCH, RATE, SEED = 500, 96, 0.01, 7
# Windows whose activations are held at once.
AT_ONCE = 128
LETTER = r"\p{L}"


@dataclass(frozen=True)
class Network:
    """Filters of each width read so many bytes as rows of a table for each place, the largest activation of a
    filter in a window is kept, and a softmax layer gives the languages' shares."""

    languages: tuple[str, ...]
    filters: tuple[np.ndarray, ...]
    biases: tuple[np.ndarray, ...]
    weights: np.ndarray
    offsets: np.ndarray

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """The largest activations of all filters, negative ones as 0; pairs of bytes are looked up at once."""
        twos = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        parts = []
        for width, table, bias in zip(WIDTHS, self._pairs(), self.biases, strict=True):
            last = WINDOW - width + 1
            total = np.take(table[0], twos[:, :last], axis=0)
            if width == 3:
                total += np.take(table[1], windows[:, 2:], axis=0)
            elif width == 4:
                total += np.take(table[1], twos[:, 2 : 2 + last], axis=0)
            parts.append(np.maximum(total.max(axis=1) + bias, 0))
        return np.concatenate(parts, axis=1)

    def _pairs(self) -> list[list[np.ndarray]]:
        if "pairs" not in self.__dict__:
            pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65_536, -1)
            made = [[pair(f[0], f[1]), *([f[2]] if len(f) == 3 else [pair(f[2], f[3])] if len(f) == 4 else [])] for f in self.filters]
            object.__setattr__(self, "pairs", made)
        return self.__dict__["pairs"]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "pairs"}

    def shares(self, windows: np.ndarray) -> np.ndarray:
        return softmax(self.pooled(windows) @ self.weights + self.offsets)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def fit(texts: list[bytes], labels: list[str], steps: int = STEPS, seed: int = SEED) -> Network | None:
    """A network for the languages of the labels, by Adam on random windows; None without labelled text."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return None
    random = np.random.default_rng(seed)
    place = {name: i for i, name in enumerate(languages)}
    of_language = [[t for t, name in zip(texts, labels, strict=True) if name == lang] for lang in languages]
    values = [random.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    values += [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    values += [random.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    n = len(WIDTHS)
    for step in range(1, steps + 1 if len(languages) > 1 else 1):
        chosen = random.integers(0, len(languages), BATCH)
        windows = np.stack([_random_window(of_language[k][random.integers(len(of_language[k]))], random) for k in chosen])
        pooled, tops = [], []
        for w, width in enumerate(WIDTHS):
            last = WINDOW - width + 1
            total = sum(values[w][k][windows[:, k : k + last]] for k in range(width))
            top = total.argmax(axis=1)
            tops.append(top)
            pooled.append(np.take_along_axis(total, top[:, None, :], 1)[:, 0] + values[n + w])
        raw = np.concatenate(pooled, axis=1)
        active = np.maximum(raw, 0)
        error = softmax(active @ values[2 * n] + values[2 * n + 1])
        error[np.arange(BATCH), chosen] -= 1
        error /= BATCH
        slopes = [np.zeros_like(v) for v in values]
        slopes[2 * n], slopes[2 * n + 1] = active.T @ error + 1e-4 * values[2 * n], error.sum(axis=0)
        back = (error @ values[2 * n].T) * (raw > 0)
        for w, width in enumerate(WIDTHS):
            part = back[:, w * FILTERS : (w + 1) * FILTERS]
            slopes[n + w] = part.sum(axis=0)
            for k in range(width):
                read = np.take_along_axis(windows, tops[w] + k, 1)
                np.add.at(slopes[w][k], (read, np.arange(FILTERS)[None, :]), part)
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.999 * second[i] + 0.001 * slope * slope
            values[i] -= RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    del place
    return Network(languages, tuple(values[:n]), tuple(values[n : 2 * n]), values[2 * n], values[2 * n + 1])


def _random_window(text: bytes, random: np.random.Generator) -> np.ndarray:
    """A window of the text; sometimes a short one, as the last of a text may be. Blanks fill it up."""
    length = WINDOW if random.random() < 0.7 else int(random.integers(16, WINDOW))
    at = int(random.integers(0, max(1, len(text) - length + 1)))
    return np.frombuffer(text[at : at + length].ljust(WINDOW), np.uint8)


def sample(
    rows: DataFrame, text: str = "text", lang: str = "lang", rows_of_each: int = ROWS_OF_EACH, most_rows: int = MOST_ROWS
) -> tuple[list[bytes], list[str]]:
    """What is learned from: of each language `rows_of_each` different texts, chosen by a hash, of each the signs at
    `PLACES` places, drawn from the whole text by the hash. Rows without letters or language are left out.

    Every language of the rows is learned. They are the classes of the network, so the driver holds them; if there are so many
    that all rows together would be more than `most_rows`, each has fewer rows, but one at least. Copies of a text
    are one choice. A share of each language that a count of its different texts gives is looked at, so the choice
    moves few rows at any size, and of these the places and not the texts.
    """
    usable = rows.filter(F.col(lang).isNotNull() & F.col(text).rlike(LETTER))
    usable = usable.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text, F.lit(SEED)).alias("chance"))
    counts = usable.groupBy("lang").agg(F.approx_count_distinct("chance").alias("n")).collect()
    if not counts:
        return [], []
    each = max(1, min(rows_of_each, most_rows // len(counts)))
    shares = [(name, min(1.0, (4.0 * each + 16) / max(1, n)) * (1 << 20)) for name, n in counts]
    shares = rows.sparkSession.createDataFrame(shares, "lang string, share double")
    few = usable.join(F.broadcast(shares), "lang").filter(F.pmod("chance", F.lit(1 << 20)) < F.col("share"))
    last = F.greatest(F.length("text") - SIGNS + 1, F.lit(1))
    at = lambda i: (1 + F.pmod(F.xxhash64("chance", i), last)).cast("int")
    pieces = F.transform(F.sequence(F.lit(1), F.lit(PLACES)), lambda i: F.substring("text", at(i), F.lit(SIGNS)))
    few = few.dropDuplicates(["lang", "chance"]).select("lang", "chance", pieces.alias("pieces"))
    order = Window.partitionBy("lang").orderBy("chance")
    chosen = few.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= each)
    found = chosen.orderBy("lang", "i").select("lang", F.explode("pieces").alias("piece")).collect()
    return [r.piece.encode() for r in found], [r.lang for r in found]


def _predictor(network: Network) -> Callable[[], Callable[[Texts], list]]:
    def begin() -> Callable[[Texts], list]:
        def predict(texts: Texts) -> list:
            lengths = texts.ends - texts.starts
            counts = -(-lengths // WINDOW)
            owner = np.repeat(np.arange(len(texts)), counts)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            begins = np.repeat(texts.starts, counts) + number * WINDOW
            sizes = np.minimum(np.repeat(texts.ends, counts) - begins, WINDOW)
            totals = np.zeros((len(texts), len(network.languages)))
            for at in range(0, len(owner), AT_ONCE):
                part = slice(at, at + AT_ONCE)
                windows = np.full((len(owner[part]), WINDOW), 32, np.uint8)
                for i, (begin, size) in enumerate(zip(begins[part].tolist(), sizes[part].tolist(), strict=True)):
                    windows[i, :size] = texts.data[begin : begin + size]
                np.add.at(totals, owner[part], network.shares(windows) * sizes[part, None])
            shares = totals / np.maximum(lengths, 1)[:, None]
            best = shares.argmax(axis=1)
            names = [network.languages[k] if n else UNKNOWN for k, n in zip(best.tolist(), lengths.tolist(), strict=True)]
            return [names, np.clip(shares[np.arange(len(best)), best], 0, 1).tolist()]

        return predict

    return begin


def identify(
    rows: DataFrame, network: Network | None, text: str = "text", predicted: str = "lang_pred", score: str = "lang_score"
) -> DataFrame:
    """Rows with the predicted language of the whole text and its share of the text, 0 to 1.

    A text is cut into windows of 256 bytes, the last filled up with blanks; the windows' softmax shares are averaged by
    their lengths. A text that is null or has no letter is `und` with score 0, and so is every text if there was
    nothing to learn from. No row leaves its task, and only some windows' activations are held at once, so texts may be
    very long. Columns of the result's names are replaced.
    """
    if network is None:
        return without(rows, predicted, score).withColumns({predicted: F.lit(UNKNOWN), score: F.lit(0.0)})
    found = add_from_text(rows, text, f"{predicted} string, {score} double", _predictor(network))
    known: Column = F.coalesce(F.col(text).rlike(LETTER), F.lit(False))
    return found.withColumns(
        {
            predicted: F.when(known, F.col(predicted)).otherwise(UNKNOWN),
            score: F.when(known, F.col(score)).otherwise(0.0),
        }
    )
