"""Spelling variants: words at one edit, found by pivotal bigrams, follow their more frequent forms."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.llm.tables import LOWER, UPPER, id_text, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWERED = str.maketrans(UPPER, LOWER)
# A run in this share of (document, run) pairs loses a letter, as a planted misspelling.
MISSPELLED_ONE_IN = 97
SHORTEST, LEAST_COUNT = 5, 3
# A form is at least this many times as frequent as the word that takes it.
TIMES = 2
# Different words counted in a task before they are passed on, and characters of a text read at once.
WORDS_AT_ONCE, PIECE = 1 << 18, 1 << 20
# Edits that are found, and letters of a gram.
EDITS, GRAM = 1, 2
# Bigrams of 116 letters at most (26 and those from U+00C0 to U+00FF, large and small).
MOST_GRAMS = 16_384
MOST_ROUNDS = 70


def _runs(text: str) -> Iterable[str]:
    """The lower-cased runs of a text; those of a very long text are never all held at once."""
    if len(text) <= PIECE:
        return RUN.findall(_lowered(text))
    return (_lowered(found.group()) for found in RUN.finditer(text))


def _lowered(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(LOWERED)


def observed(run: str, h: int, one_in: int = MISSPELLED_ONE_IN) -> str:
    """The run as it counts for a document: one in `one_in` (document, run) pairs loses a letter, chosen by their hash."""
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """`word, n`: words of at least `shortest` letters of all whole texts with the number of their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def taken() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )
            counts.clear()
            return batch

        for batch in batches:
            for id, whole in zip(batch.column(0), batch.column(1), strict=True):
                if not whole.is_valid:
                    continue
                begun = zlib.crc32(f"{id.as_py()}:".encode())
                # A run counts alike wherever it stands in a document.
                for word, n in Counter(_runs(whole.as_py())).items():
                    if len(word) >= shortest:
                        word = observed(word, zlib.crc32(word.encode(), begun))
                        if len(word) >= shortest:
                            counts[word] += n
                if len(counts) >= WORDS_AT_ONCE:
                    yield taken()
        yield taken()

    given = documents.select(id_text(doc_id).alias("id"), F.col(text).alias("text"))
    return given.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def pivots(places: list[int], costs: list[list[float]], size: int = GRAM) -> list[int]:
    """Which grams to pick: one for each list of costs, in the order of their places, none overlapping, at the least cost.

    `best[i]` is the least cost of the picks so far among the first i grams; a gram is left out, or added to the best
    choice among those that end before it.
    """
    best: list[tuple] = [(0.0, ())] * (len(places) + 1)
    for cost in costs:
        before, best = best, [(float("inf"), ())]
        for i, place in enumerate(places):
            ended = sum(1 for p in places[:i] if p + size <= place)
            total, chosen = before[ended]
            best.append(min(best[i], (total + cost[i], (*chosen, i))))
    return list(best[-1][1])


class Grams:
    """How frequent bigrams are among the words: their global order, and how many words share a part of a word."""

    def __init__(self, counts: dict[str, int]) -> None:
        if len(counts) > MOST_GRAMS:
            raise ValueError("words of other letters than expected")
        self.counts = counts
        self.rank = {g: k for k, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}
        self.first, self.second = Counter(), Counter()
        for gram, n in counts.items():
            self.first[gram[0]] += n
            self.second[gram[1]] += n

    def prefix(self, word: str) -> list[tuple[int, int, int]]:
        """`(place, rank of the prefix's last gram, which pivot)` for the grams of a word's prefix: 1 and 2 are the
        pivots in the order of their places, 0 the others.

        The prefix are the first `EDITS * GRAM + 1` grams in the global order, and all others that equal its last one.
        One edit changes at most one of the pivots, as these do not overlap. So of two words at one edit, a pivot of the
        one whose prefix ends first in the global order is in the prefix of the other. Pivots are chosen for rare
        grams in rare surroundings: by the expected number of words that share the letters up to the first, and from
        the second on.
        """
        grams = [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]
        ranks = [self.rank[g] for g in grams]
        last = sorted(ranks)[EDITS * GRAM]
        up_to = [float(self.counts[grams[0]])]
        for gram in grams[1:]:
            up_to.append(up_to[-1] * self.counts[gram] / self.first[gram[0]])
        from_on = [float(self.counts[grams[-1]])]
        for gram in reversed(grams[:-1]):
            from_on.append(from_on[-1] * self.counts[gram] / self.second[gram[1]])
        from_on.reverse()
        places = [i for i, r in enumerate(ranks) if r <= last]
        chosen = pivots(places, [[up_to[i] for i in places], [from_on[i] for i in places]])
        return [(i, last, chosen.index(k) + 1 if k in chosen else 0) for k, i in enumerate(places)]


def letters(word: str) -> int:
    """The letters that a word has, as bits of a signed number. One edit changes two of them at most."""
    bits = 0
    for letter in set(word):
        bits |= 1 << ord(letter) % 64
    return bits - (1 << 64) if bits >> 63 else bits


def _indexed(words: DataFrame) -> DataFrame:
    """`word, n, letters, place, last, pivot` for the prefix grams of the words."""
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(GRAM)))).alias("gram"))
    # At most one row for each pair of letters.
    known = Grams({r.gram: r.n for r in grams.groupBy("gram").agg(F.count("*").alias("n")).collect()})
    schema = "word string, n long, letters long, place int, last int, pivot int"
    names, types = ["word", "n", "letters", "place", "last", "pivot"], (pa.string(), *[pa.int64()] * 2, *[pa.int32()] * 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (word, n, bits, *entry)
                for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for bits in (letters(word),)
                for entry in known.prefix(word)
            ]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return words.select("word", "n").mapInArrow(run, schema)


def near_pairs(words: DataFrame) -> DataFrame:
    """`word, n, other, m`: all pairs of different words `word, n` at exactly one edit, in both directions.

    An edit behind the first pivot leaves the word up to that pivot as it is; any other one lies before the second pivot
    and leaves the word from that pivot on. So the place of the first pivot may not differ from the front, that of the
    second not from the end, and lengths differ by one at most: these limits, with the letters they fix, are the key
    on which pivots meet the grams of other words' prefixes. Words that differ in more letters than an edit can change
    are no pair; for the others the edit is verified inside the join, which makes rows for pairs alone.
    """
    index = written(_indexed(words), "grams")
    front = F.struct(F.lit(1).alias("side"), F.substr("word", F.lit(1), F.col("place") + GRAM).alias("part"))
    end = F.struct(F.lit(2).alias("side"), F.substr("word", F.col("place") + 1).alias("part"))
    lengths = F.explode(F.array(*[F.length("word") + longer for longer in (-1, 0, 1)])).alias("length")
    asked = index.filter("pivot > 0").withColumn("at", F.when(F.col("pivot") == 1, front).otherwise(end))
    asked = asked.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("last").alias("a_last"), F.col("letters").alias("a_letters"), "at.*", lengths)
    held = index.select("*", F.explode(F.array(front, end)).alias("at"))
    held = held.select(
        F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("last").alias("b_last"), F.col("letters").alias("b_letters"), "at.*", F.length("word").alias("length")
    )
    on = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("side", "part", "length")]
    few = F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2 * EDITS
    near = (F.col("a_last") <= F.col("b_last")) & few & (F.col("a") != F.col("b")) & (F.levenshtein("a", "b", EDITS) == EDITS)
    met = asked.alias("x").join(held.alias("y"), on[0] & on[1] & on[2] & near).select("a", "a_n", "b", "b_n")
    both = met.union(met.select("b", "b_n", "a", "a_n")).distinct()
    return both.toDF("word", "n", "other", "m")


def _rooted(forms: DataFrame) -> DataFrame:
    """`word, root` from `word, form`: forms are followed to the last one, each round twice as far as before. A form
    is more frequent than its word by a factor, so chains are short and end."""
    roots = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(MOST_ROUNDS):
        next_one = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        followed = roots.join(next_one, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        followed = written(followed, "roots")
        roots = followed.select("word", "root")
        if followed.filter("moved").isEmpty():
            return roots
    raise RuntimeError("forms lead in a circle")


def variants(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", least_count: int = LEAST_COUNT, times: int = TIMES
) -> DataFrame:
    """`word, form, root, n, n_near, form_n` for each word of at least five letters and `least_count` occurrences.

    Near words differ by one letter that is inserted, deleted or replaced. A word's form is its most frequent near word
    (of equal ones the first by code points), if that is at least `times` as frequent; else null. The root is the last of
    the forms from the word on.

    Occurrences are counted inside the tasks before they are shuffled, so a word that makes up a third of all text is a
    few rows. From there on rows are words, not texts.

    Null texts have no words; a null id counts as the empty text. Repeated rows count each time. No words, no rows.
    """
    counted = word_counts(documents, doc_id, text).filter(F.col("n") >= least_count)
    words = written(counted, "words")
    pairs = written(near_pairs(words), "near_words")
    best = F.min(F.struct((-F.col("m")).alias("order"), F.col("other")))
    near = pairs.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    takes = -F.col("best.order") >= times * F.col("n")
    near = near.select(
        "word", "n_near", F.when(takes, F.col("best.other")).alias("form"), F.when(takes, -F.col("best.order")).alias("form_n")
    )
    near = written(near, "near")
    roots = _rooted(near.filter("form is not null"))
    joined = words.join(near, "word", "left").join(roots, "word", "left")
    return joined.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"
    )
