"""Near-duplicate documents: minima of universal hashes, bands, verified signatures, exact sets, connected components."""

from __future__ import annotations

from collections.abc import Callable
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.functions.text import bind
from textflow.llm.components import components
from textflow.llm.tables import Texts, WordHashes, add_from_text, discard, lower_ascii, mix, shingle_hashes, written

BANDS, ROWS = 40, 6
SIMILARITY = 80
SEED = 20_240_607
# Shingles hashed at a time, so that the matrix of hashes stays in the processor's cache.
CHUNK = 512
# Rounds with one partner for each text and bucket, before all pairs that are left are compared.
LEADER_ROUNDS = 2
# Bands whose buckets are looked at first.
FIRST_BANDS = 10
# The chance that a pair at the threshold is taken for one clearly below it by its signatures.
LOSS = 1e-6
# Bits of each minimum that a signature keeps: 32 minima in a 64-bit number.
SIGNATURE_BITS = 2
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BLANKS = r"[\x20\x09-\x0D]+"


def signer(words_per_shingle: int, bands: int, rows: int) -> Callable[[], Callable[[Texts], list]]:
    """What makes (number of different shingles, digest of the set, one hash for each band, signature) from texts."""

    def begin() -> Callable[[Texts], list]:
        import xxhash

        random = np.random.default_rng(SEED)
        factors = random.integers(0, 1 << 63, (bands * rows, 1), np.uint64) * np.uint64(2) + np.uint64(1)
        shifts = random.integers(0, 1 << 63, (bands * rows, 1), np.uint64)
        band = np.arange(1, bands + 1, dtype=np.uint64)
        words = WordHashes()

        def sign(texts: Texts) -> list:
            counts, digests, values, signatures = [], [], [], []
            for i in range(len(texts)):
                listed = words.of(texts[i].tobytes().translate(LOWER))
                shingles = np.unique(shingle_hashes(listed, words_per_shingle))
                counts.append(len(shingles))
                if not len(shingles):
                    digests.append(None)
                    values.append(None)
                    signatures.append(None)
                    continue
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                least = None
                for at in range(0, len(shingles), CHUNK):
                    part = (shingles[at : at + CHUNK] * factors + shifts).min(axis=1)
                    least = part if least is None else np.minimum(least, part)
                least >>= np.uint64(20)
                signatures.append(_signature(least))
                least = least.reshape(bands, rows)
                value = band.copy()
                for k in range(rows):
                    value = mix(value + least[:, k])
                values.append(value)
            return [counts, digests, _lists(values), _lists(signatures)]

        return sign

    return begin


def _signature(least: np.ndarray) -> np.ndarray:
    """The lowest bits of the spread minima, 32 of them in each number."""
    low = np.zeros(-(-len(least) // 32) * 32, np.uint64)
    low[: len(least)] = mix(least) & np.uint64(3)
    return np.bitwise_or.reduce(low.reshape(-1, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(SIGNATURE_BITS)), axis=1)


def _lists(values: list[np.ndarray | None]) -> pa.Array:
    """Lists of 64-bit numbers; empty ones for what is missing."""
    flat = np.concatenate([v for v in values if v is not None] or [np.zeros(0, np.uint64)]).view(np.int64)
    offsets = np.concatenate([[0], np.cumsum([0 if v is None else len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def most_differences(minima: int, similarity: int, loss: float = LOSS) -> int:
    """The number of different places that signatures of a pair at the threshold exceed with a chance below `loss`.

    Two minima agree with the chance of the similarity, and the bits of those that do not by a quarter of the rest."""
    differ = (1 - similarity / 100) * (1 - 0.25)
    tail, k = 1.0, -1
    while tail >= loss and k < minima:
        k += 1
        tail -= comb(minima, k) * differ**k * (1 - differ) ** (minima - k)
    return k


def _differences(a: str, b: str, numbers: int) -> Column:
    """The number of places at which two signatures differ."""

    def of_number(i: int) -> Column:
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        either = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(either.bitwiseAND(F.lit(0x5555555555555555)))

    total = of_number(0)
    for i in range(1, numbers):
        total = total + of_number(i)
    return total


def shingle_set(text: Column, words_per_shingle: int) -> Column:
    """The different shingles of a text as 64-bit hashes, for the exact comparison."""

    def of_words(words: Column) -> Column:
        def runs(n: int) -> Column:
            return F.transform(
                F.slice(words, F.lit(1), F.size(words) - n + 1),
                lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, n)]),
            )

        whole = F.array(F.xxhash64(words))
        return F.when(F.size(words) >= words_per_shingle, F.array_distinct(runs(words_per_shingle))).otherwise(whole)

    words = F.filter(F.split(lower_ascii(text), BLANKS), lambda w: w != "")
    return bind(words, of_words)


def _alike(a: str, b: str, similarity: int) -> Column:
    """Whether 100 times the intersection of two sets is at least `similarity` times their union. One cannot be that
    alike if the sizes differ more; then the sets are not compared."""
    sizes = F.size(a) + F.size(b)
    near = F.least(F.size(a), F.size(b)) * 100 >= F.greatest(F.size(a), F.size(b)) * similarity
    return near & (F.size(F.array_intersect(a, b)).cast("bigint") * (100 + similarity) >= sizes * similarity)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs `u, v` whose full sets are alike."""
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    return pairs.join(a, "u").join(b, "v").filter(_alike("a", "b", similarity)).select("u", "v")


class Search:
    """The search for links among classes `node, bands, signature`, whose full sets `sets` gives for some nodes."""

    def __init__(self, classes: DataFrame, sets: Callable[[DataFrame], DataFrame], similarity: int, minima: int) -> None:
        self.classes = classes
        self.sets = sets
        self.similarity = similarity
        self.most, self.numbers = most_differences(minima, similarity), -(-minima // 32)
        self.known: DataFrame | None = None
        self.made: list[DataFrame] = []

    def _possible(self, pairs: DataFrame) -> DataFrame:
        """The pairs `u, v` whose signatures do not differ too much, written."""
        own = self.classes.select("node", "signature")
        a, b = own.toDF("u", "a"), own.toDF("v", "b")
        near = pairs.join(a, "u").join(b, "v").filter(_differences("a", "b", self.numbers) <= self.most)
        self.made.append(written(near.select("u", "v"), "candidates"))
        return self.made[-1]

    def _know(self, nodes: DataFrame) -> None:
        """Makes the full sets of these nodes; each is made once."""
        nodes = nodes.distinct()
        if self.known is not None:
            nodes = nodes.join(self.known.select("node"), "node", "left_anti")
        more = written(self.sets(nodes), "shingle_sets")
        self.made.append(more)
        self.known = more if self.known is None else self.known.union(more)

    def of_pairs(self, pairs: DataFrame) -> DataFrame:
        """The alike pairs: first by signatures, then by full sets, which move for what is left alone."""
        near = self._possible(pairs)
        self._know(near.select(F.explode(F.array("u", "v")).alias("node")))
        return _verified(near, self.known, self.similarity)

    def across(self, members: DataFrame) -> DataFrame:
        """The alike pairs among members `value, node, component, bands` of a bucket that are in different components.

        Members without a possible partner in their bucket, by the signatures, are left out before any set moves. Sets are
        compared inside a join, in the first bucket that a pair shares, so rows are moved for members and made for
        links, never for pairs."""
        signed = members.select("value", "node", "component").join(self.classes.select("node", "signature"), "node")
        signed = written(signed, "signed_members")
        x, y = signed.alias("x"), signed.select("value", "component", "signature").alias("y")
        other = (F.col("x.value") == F.col("y.value")) & (F.col("x.component") != F.col("y.component"))
        few = _differences("x.signature", "y.signature", self.numbers) <= self.most
        possible = written(x.join(y, other & few, "left_semi"), "possible_members")
        self.made.append(possible)
        discard(signed)
        self._know(possible.select("node"))
        rows = possible.join(self.classes.select("node", "bands"), "node").join(self.known, "node")
        side = lambda x: rows.select(
            "value", *[F.col(c).alias(f"{x}_{c}") for c in ("node", "component", "bands", "signature", "shingles")]
        )
        first = F.array_min(F.array_intersect("a_bands", "b_bands")) == F.col("a.value")
        both = (F.col("a.value") == F.col("b.value")) & (F.col("a_component") < F.col("b_component"))
        few = _differences("a_signature", "b_signature", self.numbers) <= self.most
        alike = _alike("a_shingles", "b_shingles", self.similarity)
        found = side("a").alias("a").join(side("b").alias("b"), both & few & first & alike)
        return found.select(F.col("a_node").alias("u"), F.col("b_node").alias("v"))


def _leaders(members: DataFrame, order: Column | None = None) -> DataFrame:
    """Each member with the first and the last member of its bucket, by number or by some other order; written."""
    if order is None:
        ends = members.groupBy("value").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    else:
        by = F.struct(order, "node")
        ends = members.groupBy("value").agg(F.min(by).alias("lo"), F.max(by).alias("hi"))
        ends = ends.select("value", F.col("lo.node").alias("lo"), F.col("hi.node").alias("hi"))
    ends = written(ends, "leaders")
    led = members.select("value", "node").join(ends, "value")
    led = led.select("node", F.explode(F.array("lo", "hi")).alias("end"))
    pairs = led.select(F.greatest("node", "end").alias("u"), F.least("node", "end").alias("v")).filter("u != v")
    pairs = written(pairs.distinct(), "leader_pairs")
    discard(ends)
    return pairs


def _unsettled(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """`value, node, component` of the buckets that hold more than one component, from all bands."""
    named = classes.select("node", "bands").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = written(named, "named_classes")
    placed = named.select("node", "component", F.explode("bands").alias("value"))
    mixed = placed.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = written(mixed.filter("lo != hi").select("value"), "mixed_buckets")
    open_ = written(placed.join(mixed, "value"), "unsettled")
    discard(named, mixed)
    return open_


def _open_pairs(members: DataFrame) -> tuple[int, int]:
    """(members, pairs of members of different components) of the buckets, counted without making pairs."""
    sizes = members.groupBy("value", "component").agg(F.count("*").alias("n"))
    square = lambda x: x.cast("double") * x
    buckets = sizes.groupBy("value").agg(F.sum("n").alias("all"), F.sum(square(F.col("n"))).alias("own"))
    found = buckets.agg(F.sum("all"), F.sum((square(F.col("all")) - F.col("own")) / 2)).first()
    return int(found[0] or 0), int(found[1] or 0)


def links(
    classes: DataFrame, sets: Callable[[DataFrame], DataFrame], similarity: int = SIMILARITY, minima: int = BANDS * ROWS
) -> tuple[DataFrame, DataFrame]:
    """(verified links `u, v`, components `node, component`) of the classes `node, bands, signature`.

    A bucket is a band with equal minima. First, in the buckets of some bands, members are compared with the smallest
    and the largest node of their bucket only, so a bucket of m texts makes 2 m comparisons. Buckets whose
    members are then all in one component need nothing more: no further link could change a component. In the
    others, of all bands, members are compared with the ends of other random orders while many pairs are open, and at
    last all pairs of members in different components are compared. So a pair that shares a bucket is
    either compared or already known to be connected. A comparison is one of signatures first; where these differ by
    more than a pair at the threshold does but for a chance of `LOSS`, full sets are not looked at.
    """
    search = Search(classes, sets, similarity, minima)
    placed = classes.select("node", F.explode(F.slice("bands", 1, FIRST_BANDS)).alias("value"))
    shared = placed.groupBy("value").agg(F.count("*").alias("n")).filter("n > 1").select("value")
    shared = written(shared, "shared_buckets")
    members = written(placed.join(shared, "value"), "members")
    pairs = _leaders(members)
    found = written(search.of_pairs(pairs), "links")
    discard(shared, members, pairs)
    for k in range(1, LEADER_ROUNDS + 1):
        members = _unsettled(classes, components(found, 1, exact=False))
        count, pairs = _open_pairs(members)
        if not pairs:
            break
        last = pairs <= count or k == LEADER_ROUNDS
        new = search.across(members) if last else search.of_pairs(_leaders(members, F.xxhash64("node", F.lit(k))))
        before, found = found, written(found.union(new), "links")
        discard(before, members)
        if last:
            break
    discard(*search.made)
    return found, written(components(found), "components")


def near_duplicates(
    documents: DataFrame,
    words_per_shingle: int,
    similarity: int = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """`doc_id, text_md5, n_shingles, component_id, stays` for each document.

    Two documents are linked if 100 times the size of the intersection of their sets of shingles is at least
    `similarity` times that of the union. `component_id` is the smallest id that is reachable over links, the
    own one included. Of each component the row with the smallest id, then the smallest text hash, `stays`.

    Texts with equal sets are one class, so any number of copies is one row from there on. Texts that share one of
    the bands are compared by their signatures, two bits of each minimum, and where these leave it open on their
    full sets. A pair of similarity 0.8 shares none of 40 bands of 6 minima with a chance of 5e-6, and is lost by its
    signatures with one of 1e-6. Texts move to those classes whose sets are compared; all else are rows of a few numbers.

    Null and empty texts, and texts of blanks, have no shingles, are linked with nothing and stay. Rows may repeat an
    id: each is judged by its own text; rows that repeat id and text stay or go together. Null ids count last; a
    component of null ids alone has the id null.
    """
    own = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    keyed = own.withColumn("text_md5", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    signed = add_from_text(
        keyed, "text", "n_shingles long, digest binary, bands array<long>, signature array<long>", signer(words_per_shingle, bands, rows)
    )
    signed = written(signed.drop("text"), "signatures")
    full = signed.filter("n_shingles > 0")
    classes = full.groupBy("digest").agg(
        F.min("text_md5").alias("text_md5"), F.first("bands").alias("bands"), F.first("signature").alias("signature")
    )
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    def sets(nodes: DataFrame) -> DataFrame:
        needed = nodes.join(classes.select("node", "text_md5"), "node")
        texts = keyed.join(needed, "text_md5").groupBy("node").agg(F.first("text").alias("text"))
        return texts.select("node", shingle_set(F.col("text"), words_per_shingle).alias("shingles"))

    _, labels = links(classes.select("node", "bands", "signature"), sets, similarity, bands * rows)
    grouped = classes.select("digest", "node").join(labels, "node", "left")
    grouped = grouped.select("digest", F.coalesce("component", "node").alias("component"))
    own_first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_md5")).alias("first")
    smallest = written(full.groupBy("digest").agg(own_first).join(grouped, "digest"), "first_rows")
    # The first row of a component, from the first rows of its classes. Both are written, so that the join of a
    # component with very many classes can be split.
    least = written(smallest.groupBy("component").agg(F.min("first").alias("kept")), "kept_rows")
    by_class = written(smallest.join(least, "component").select("digest", "kept"), "by_class")
    judged = signed.select("doc_id", "text_md5", "n_shingles", "digest").join(by_class, "digest", "left")
    linked = F.col("n_shingles") > 0
    return judged.select(
        "doc_id",
        "text_md5",
        "n_shingles",
        F.when(linked, F.col("kept.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linked, F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("text_md5") == F.col("kept.text_md5")))
        .otherwise(True)
        .alias("stays"),
    )


def deduplicated(documents: DataFrame, words_per_shingle: int, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that stay, whole rows, one for each component and for each document without shingles. Of rows that repeat
    id and text one stays."""
    judged = near_duplicates(documents, words_per_shingle, doc_id=doc_id, text=text, **options)
    staying = judged.filter("stays").select(F.col("doc_id").alias("__id"), F.col("text_md5").alias("__md5")).distinct()
    staying = written(staying, "staying")
    rows = documents.withColumn("__own_md5", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))))
    same = (F.col("__own_md5") == F.col("__md5")) & F.col(doc_id).eqNullSafe(F.col("__id"))
    kept = rows.join(staying, same).dropDuplicates(["__own_md5", doc_id])
    return kept.drop("__own_md5", "__id", "__md5")
