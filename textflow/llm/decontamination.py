"""Passages of benchmark items in documents: SimHash windows, multi-index Hamming search, exact verification."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.llm.tables import Texts, WordHashes, add_from_text, shingle_hashes, without, written

SHINGLE, SIMILARITY = 5, 0.8
BITS, BLOCKS, RADIUS = 64, 4, 11
# A window starts where the hash of two words is the smallest of so many neighbours.
ANCHOR_SPAN = 8
# Window sizes grow by this factor from the smallest one.
SMALLEST, GROWTH = 8, 1.4
ITEMS_AT_ONCE = 20_000
# Words worked on at once, and words on either side by which an inserted or lost word may move a passage.
WORDS_AT_ONCE, SLACK = 1 << 16, 2
# ASCII letters in lower case, ASCII signs as blanks; other bytes as they are.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
LEAKS = "array<struct<item_id:bigint,similarity:double,start_word:bigint,n_words:bigint>>"


def anchored(pairs: np.ndarray) -> np.ndarray:
    """Positions whose hash is the smallest of some run of `ANCHOR_SPAN` neighbours. A run inside a passage chooses
    the same position wherever the passage stands."""
    n = len(pairs) - ANCHOR_SPAN + 1
    if n < 1:
        return np.zeros(0, np.int64)
    least = pairs[:n].copy()
    for i in range(1, ANCHOR_SPAN):
        np.minimum(least, pairs[i : n + i], out=least)
    best = np.zeros(len(pairs), np.uint64)
    for i in range(ANCHOR_SPAN):
        np.maximum(best[i : n + i], least, out=best[i : n + i])
    return np.flatnonzero(best == pairs)


def fingerprints(pairs: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHashes of the windows of `size` words at `starts`: each bit is what most hashes of two words have there."""
    out = np.zeros(len(starts), np.uint64)
    step = max(1, size - 1)
    for at in range(0, len(pairs), WORDS_AT_ONCE):
        chosen = np.flatnonzero((starts >= at) & (starts < at + WORDS_AT_ONCE))
        if len(chosen):
            part = pairs[at : at + WORDS_AT_ONCE + step]
            out[chosen] = _fingerprints(_sums(part), starts[chosen] - at, step)
    return out


def _sums(pairs: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(pairs.view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(bits) + 1, BITS), np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=sums[1:])
    return sums


def _fingerprints(sums: np.ndarray, starts: np.ndarray, step: int) -> np.ndarray:
    majority = (sums[starts + step] - sums[starts]) * 2 > step
    return np.packbits(majority, axis=1).reshape(-1, 8).view(np.uint64).ravel()


def window_plan(length: int) -> tuple[int, bool]:
    """(window size, whether windows start at anchors) for an item of so many words. Short items get windows at all
    positions, as much shorter than the item as its similarity may drop."""
    if length < SMALLEST + ANCHOR_SPAN - 1:
        return max(1, length - max(0, length - SHINGLE + 1) // 5), False
    size = float(SMALLEST)
    while int(size * GROWTH) <= length - ANCHOR_SPAN + 1:
        size *= GROWTH
    return int(size), True


class HammingIndex:
    """Fingerprints that are found by all queries within `RADIUS` bits: of four blocks one differs in at most a
    fourth of these bits, so each entry is listed under all values of a block that near its own."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        width = BITS // BLOCKS
        near = [0] + [sum(1 << b for b in bits) for n in range(1, RADIUS // BLOCKS + 1) for bits in combinations(range(width), n)]
        self.tables = []
        for block in range(BLOCKS):
            own = ((entries >> np.uint64(block * width)) & np.uint64((1 << width) - 1)).astype(np.int64)
            keys = (own[:, None] ^ np.array(near, np.int64)[None, :]).ravel()
            order = np.argsort(keys, kind="stable")
            starts = np.searchsorted(keys[order], np.arange((1 << width) + 1))
            self.tables.append((starts, (order // len(near)).astype(np.int32)))

    def search(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the query, place of the entry) of all pairs within the radius."""
        width, found = BITS // BLOCKS, []
        for block, (starts, listed) in enumerate(self.tables):
            key = ((asked >> np.uint64(block * width)) & np.uint64((1 << width) - 1)).astype(np.int64)
            first, count = starts[key], starts[key + 1] - starts[key]
            total = int(count.sum())
            if total:
                query = np.repeat(np.arange(len(asked)), count)
                inside = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
                entry = listed[np.repeat(first, count) + inside]
                near = np.bitwise_count(asked[query] ^ self.entries[entry]) <= RADIUS
                found.append(np.stack([query[near], entry[near]]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pairs[0], pairs[1]


class Items:
    """Benchmark items, prepared for search: windows by size, and weighted shingles for the verification. `held` has
    the number of items, of this block and all others, that hold a shingle of several items."""

    def __init__(self, rows: list[tuple[int | None, str | None]], held: Mapping[int, int]) -> None:
        words = WordHashes()
        listed = [(i, words.of((text or "").encode().translate(PLAIN))) for i, text in rows]
        listed = [(i, h) for i, h in listed if len(h)]
        self.ids = [i for i, _ in listed]
        self.lengths = [len(h) for _, h in listed]
        self.shingles = [Counter(shingle_hashes(h, SHINGLE).tolist()) for _, h in listed]
        #: A shingle of several items says less about one of them.
        self.weights = {s: float(1.0 / np.sqrt(n)) for s, n in held.items()}
        self.totals = [shingles.total() for shingles in self.shingles]
        self.weighed = [sum(self.weights.get(s, 1.0) * n for s, n in x.items()) for x in self.shingles]
        self.plans: dict[tuple[int, bool], tuple[HammingIndex, np.ndarray, np.ndarray]] = {}
        found: dict[tuple[int, bool], list[tuple[int, np.ndarray, np.ndarray]]] = {}
        for k, (_, h) in enumerate(listed):
            size, at_anchors = window_plan(len(h))
            pairs = shingle_hashes(h, 2)
            starts = anchored(pairs) if at_anchors else np.arange(len(h))
            starts = starts[starts + size <= len(h)]
            base = pairs if size > 1 else shingle_hashes(h, 1)
            found.setdefault((size, at_anchors), []).append((k, starts, fingerprints(base, starts, size)))
        for plan, parts in found.items():
            owners = np.concatenate([np.full(len(starts), k) for k, starts, _ in parts])
            offsets = np.concatenate([starts for _, starts, _ in parts])
            self.plans[plan] = HammingIndex(np.concatenate([f for _, _, f in parts])), owners, offsets

    def similarity(self, k: int, shingles: list[int]) -> float:
        """Similarity of an item and a passage: the smaller of both counts of each shingle over the larger ones. Once all
        shingles weigh the same and once by their weights; the higher one counts, so that neither a template that
        items share hides an edited copy, nor an edit of the template hides the rest."""
        own = self.shingles[k]
        if own.keys().isdisjoint(shingles):
            return 0.0
        other, weigh = Counter(shingles), self.weights.get
        both, weighed_both = 0, 0.0
        for s in own.keys() & other.keys():
            less = min(own[s], other[s])
            both += less
            weighed_both += weigh(s, 1.0) * less
        union = self.totals[k] + len(shingles) - both
        weighed_union = self.weighed[k] + sum(weigh(s, 1.0) * n for s, n in other.items()) - weighed_both
        return max(both / union, weighed_both / weighed_union)


def search(items: Items, hashes: np.ndarray, bounds: np.ndarray) -> dict[int, dict[int, tuple[float, int]]]:
    """For texts that follow each other (`bounds` of their words): place of the text -> item -> (similarity, first word)
    of its best passage."""
    pairs = shingle_hashes(hashes, 2) if len(hashes) > 1 else hashes.copy()
    ends = np.repeat(bounds[1:], np.diff(bounds))
    anchors = anchored(pairs)
    asked: list[tuple[int, int, int]] = []
    largest = max((size for size, _ in items.plans), default=1)
    singles = shingle_hashes(hashes, 1) if any(size == 1 for size, _ in items.plans) else pairs
    for at in range(0, len(hashes), WORDS_AT_ONCE):
        sums = _sums(pairs[at : at + WORDS_AT_ONCE + largest])
        for (size, at_anchors), (index, owners, offsets) in items.plans.items():
            step = max(1, size - 1)
            if size == 1:
                starts = np.arange(at, min(at + WORDS_AT_ONCE, len(hashes)))
                # A word's fingerprint is its hash, so near ones are other words; the first place in a text will do.
                prints = singles[starts]
                query, entry = index.search(prints)
                same = prints[query] == index.entries[entry]
                query, entry = query[same], entry[same]
                in_text = np.searchsorted(bounds, starts[query], side="right")
                _, first = np.unique(np.stack([in_text, owners[entry]]), axis=1, return_index=True)
                asked += zip(starts[query[first]].tolist(), owners[entry[first]].tolist(), offsets[entry[first]].tolist(), strict=True)
                continue
            if at_anchors:
                starts = anchors[np.searchsorted(anchors, at) : np.searchsorted(anchors, at + WORDS_AT_ONCE)]
            else:
                starts = np.arange(at, min(at + WORDS_AT_ONCE, len(hashes)))
            starts = starts[(starts + size <= ends[starts]) & (starts + step - at < len(sums))]
            if len(starts):
                query, entry = index.search(_fingerprints(sums, starts - at, step))
                asked += zip(starts[query].tolist(), owners[entry].tolist(), offsets[entry].tolist(), strict=True)
    best: dict[int, dict[int, tuple[float, int]]] = {}
    for at, k, offset in asked:
        text = int(np.searchsorted(bounds, at, side="right")) - 1
        low, high = int(bounds[text]), int(bounds[text + 1])
        for start in range(at - offset - SLACK, at - offset + SLACK + 1):
            first, last = max(low, start), min(high, start + items.lengths[k])
            if last > first:
                value = items.similarity(k, shingle_hashes(hashes[first:last], SHINGLE).tolist())
                known = best.setdefault(text, {}).get(k)
                if value >= SIMILARITY and (known is None or value > known[0]):
                    best[text][k] = (value, first - low)
    return best


def _shingles() -> Callable[[Texts], list]:
    words = WordHashes()

    def distinct(text: bytes) -> list[int]:
        hashes = words.of(text.translate(PLAIN))
        return np.unique(shingle_hashes(hashes, SHINGLE)).view(np.int64).tolist() if len(hashes) else []

    return lambda texts: [[distinct(texts[i].tobytes()) for i in range(len(texts))]]


def shared_shingles(items: DataFrame, text: str, block: str) -> DataFrame:
    """`block, shingle, n`: for each block of items its shingles that several items hold, of whatever block, with the
    number of these items."""
    each = add_from_text(items, text, "__shingles array<bigint>", _shingles)
    each = each.select(F.col(block).alias("__block"), F.explode("__shingles").alias("shingle"))
    counts = each.groupBy("shingle").agg(F.count("*").alias("n"), F.collect_set("__block").alias("__blocks"))
    return counts.filter("n > 1").select(F.explode("__blocks").alias("block"), "shingle", "n")


def _finder(items: Items) -> Callable[[], Callable[[Texts], list]]:
    def begin() -> Callable[[Texts], list]:
        words = WordHashes()

        def groups(texts: Texts) -> Iterator[tuple[int, list[np.ndarray]]]:
            """Texts that follow each other, as many as make up the words for one pass."""
            first, held, count = 0, [], 0
            for i in range(len(texts)):
                held.append(words.of(texts[i].tobytes().translate(PLAIN)))
                count += len(held[-1])
                if count >= WORDS_AT_ONCE:
                    yield first, held
                    first, held, count = i + 1, [], 0
            if held:
                yield first, held

        def find(texts: Texts) -> list:
            leaks: list[list[dict]] = [[] for _ in range(len(texts))]
            for first, held in groups(texts):
                bounds = np.concatenate([[0], np.cumsum([len(h) for h in held])]).astype(np.int64)
                for text, found in search(items, np.concatenate(held), bounds).items():
                    leaks[first + text] = [
                        {"item_id": items.ids[k], "similarity": round(value, 6), "start_word": start, "n_words": items.lengths[k]}
                        for k, (value, start) in sorted(found.items())
                    ]
            return [leaks]

        return find

    return begin


def with_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    item_id: str = "item_id",
    item_text: str = "text",
    text: str = "text",
    output: str = "leaks",
    items_at_once: int = ITEMS_AT_ONCE,
) -> DataFrame:
    """Documents with the list of benchmark items that they hold: item, similarity, first word and number of words.

    Words are runs of ASCII letters, digits and non-ASCII signs, in ASCII lower case. A document holds an item if the
    similarity of their five-word shingles, over a passage as long as the item, is 0.8 or more, be it plain or
    with shingles that n items hold weighing 1 / sqrt(n); an item of fewer words is one shingle. Windows of about
    the item's size start at anchors, are fingerprinted, and all fingerprints within 11 of 64 bits of an item's
    are verified exactly.

    The items are the query set; they are taken in blocks of `items_at_once`, each one pass over the documents in which
    no row leaves its task, however often a passage occurs. Null and empty texts hold nothing, and null or
    empty items are held by nothing. Items that repeat are each reported. A column of the output's name is replaced.
    """
    queries = benchmark.select(F.col(item_id).cast("bigint"), F.col(item_text))
    queries = queries.filter(F.length(F.trim(F.col(item_text))) > 0)
    count = queries.count()
    blocks = max(1, -(-count // items_at_once))
    found = without(documents, output)
    queries = queries.withColumn("__block", F.pmod(F.xxhash64(item_text), F.lit(blocks)))
    # Counted over all items, so that neither weights nor finds depend on the blocks.
    shared = written(shared_shingles(queries, item_text, "__block"), "shared_shingles")
    names = []
    for i in range(blocks):
        held = {s & (1 << BITS) - 1: n for s, n in shared.filter(F.col("block") == i).select("shingle", "n").collect()}
        rows = queries.filter(F.col("__block") == i).drop("__block").orderBy(item_id, item_text).collect()
        items = Items([tuple(r) for r in rows], held)
        names.append(f"__leaks_{i}")
        found = add_from_text(found, text, f"{names[-1]} {LEAKS}", _finder(items))
    return found.withColumn(output, F.concat(*[F.col(n) for n in names])).drop(*names)
