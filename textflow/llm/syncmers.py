"""Document fingerprints: closed syncmers over words, anchors that depend on nothing but their own words."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textflow.functions.text import bind
from textflow.llm.tables import without

# Words of a k-mer and of its inner substrings.
K, S = 6, 2
# Words are pieces of non-blank signs of at most this length, so that a text without blanks has anchors too.
PIECES = r"[^\x20\x09-\x0D]{1,16}"
ROWS_PER_BLOCK = 1024
MOST_BLOCKS = 262_144
CUTS = 256
# Bands of moves to either side, over the longer fingerprint.
BANDS = 8


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """The closed syncmers of a text in their order: 32-bit hashes of the runs of k words whose smallest inner run
    of s words, by hash, is the first or the last one.

    Whether a run is chosen depends on its own words alone, so equal passages have equal anchors wherever they
    stand. With fewer than k words the whole sequence is the one anchor; without words (also a null
    text) there is none.
    """
    inner = k - s + 1

    def of_words(words: Column) -> Column:
        hashed = F.transform(words, lambda w: F.xxhash64(w))

        def of_hashes(h: Column) -> Column:
            count = F.size(h) - s + 1
            runs = F.transform(
                F.slice(h, F.lit(1), F.greatest(count, F.lit(0))),
                lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, s)]),
            )

            def of_runs(g: Column) -> Column:
                def closed(_: Column, i: Column) -> Column:
                    ends = F.least(F.get(g, i), F.get(g, i + inner - 1))
                    between = [F.get(g, i + j) for j in range(1, inner - 1)]
                    return ends <= (F.least(*between) if len(between) > 1 else between[0])

                starts = F.filter(
                    F.transform(F.slice(g, F.lit(1), F.size(h) - k + 1), lambda _, i: i),
                    lambda i: closed(i, i),
                )
                inside = range(0, k - s + 1, s) if (k - s) % s == 0 else range(k - s + 1)
                return F.transform(starts, lambda i: F.hash(*[F.get(g, i + j) for j in inside]))

            return bind(runs, of_runs)

        whole = F.array(F.hash(hashed))
        return F.when(F.size(words) >= k, bind(hashed, of_hashes)).when(F.size(words) > 0, whole).otherwise(
            F.array().cast("array<int>")
        )

    return bind(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECES), F.lit(0)), of_words)


def likeness(a: Column, b: Column) -> Column:
    """How much of two fingerprints matches in place: twice the number of matched anchors over the sum of the different
    anchors of each, 0 to 1; 1 for two texts without anchors.

    Different anchors are numbered as they come; one that both have is moved by the difference of its numbers. Matched are
    those whose moves lie in one band, the one that holds most; a band reaches an eighth of the longer fingerprint to
    either side. So a passage that was put in front moves all alike and costs only itself, while halves that change
    places match once. Anchors are brought together by sorting, so the work is n log n.
    """
    placed = lambda found, side: F.transform(
        found, lambda x, i: F.shiftleft(x.cast("bigint"), 32) + F.lit(side << 31) + i
    )

    def moves(listed: Column) -> Column:
        number = lambda x: x.bitwiseAND(F.lit((1 << 31) - 1))

        def move(x: Column, i: Column) -> Column:
            following = F.get(listed, i + 1)
            return F.when(F.shiftright(x, 32) == F.shiftright(following, 32), number(following) - number(x))

        return F.filter(F.transform(listed, move), lambda x: x.isNotNull())

    def of_both(both: Column) -> Column:
        x, y = both["x"], both["y"]
        reach = F.greatest(F.size(x), F.size(y), F.lit(BANDS)) / BANDS
        held = lambda found: F.transform(
            F.sequence(F.lit(-BANDS), F.lit(BANDS)),
            lambda band: F.size(F.filter(found, lambda move: F.abs(move - band * reach) <= reach)),
        )
        matched = F.array_max(bind(bind(F.sort_array(F.concat(placed(x, 0), placed(y, 1))), moves), held))
        total = F.size(x) + F.size(y)
        apart = (total > 0) & ~F.arrays_overlap(x, y)
        return F.when(total == 0, F.lit(1.0)).when(apart, F.lit(0.0)).otherwise(2.0 * matched / total)

    return bind(F.struct(F.array_distinct(a).alias("x"), F.array_distinct(b).alias("y")), of_both)


def as_text(found: Column) -> Column:
    """A fingerprint as text: eight hex digits for each anchor, in order."""
    return F.array_join(F.transform(found, lambda x: F.lpad(F.lower(F.hex(x.cast("bigint") + (1 << 31))), 8, "0")), "")


def _ranges(cuts: list[int], blocks: int) -> list[tuple[int, int, int]]:
    """(first id, number of ids, number of blocks) of ranges that follow each other, from quantiles of the ids. An id that
    is several quantiles is a range of its own, with as many times the blocks; what lies before the first or behind
    the last quantile, which an approximation may leave there, is a block each."""
    times = Counter(cuts)
    edges = sorted(times)
    ranges = [(-(1 << 63), 1, 1)]
    for low, high in zip(edges, [*edges[1:], edges[-1] + 1]):
        if times[low] > 1:
            ranges.append((low, 1, blocks * times[low]))
            low += 1
        if low < high:
            ranges.append((low, high - low, blocks))
    return [*ranges, (min(edges[-1] + 1, (1 << 63) - 1), 1, 1)]


def _blocks(documents: DataFrame, doc_id: str, tie: Column) -> tuple[Column, DataFrame]:
    """The block of a row, from its id and `tie`, and for each block the least id and tie in it and the block before it.

    A block holds about `ROWS_PER_BLOCK` rows whose ids follow each other; there are at most about twice `MOST_BLOCKS`.
    Ranges between quantiles of the ids are cut into parts of equal width, so ids need not be dense or evenly spread.
    A range of one id is cut by the hash of the text instead, and so are the rows without an id, which come first.
    """
    cuts = [i / CUTS for i in range(CUTS + 1)]
    number = F.col(doc_id).cast("bigint")
    found = documents.agg(
        F.count(doc_id).alias("n"), F.count("*").alias("all"), F.percentile_approx(number, cuts, 10_000).alias("cuts")
    ).first()
    of = lambda n: max(1, min(n // ROWS_PER_BLOCK, MOST_BLOCKS))
    ranges, nulls = _ranges(found["cuts"] or [0], max(1, of(found["n"]) // CUTS)), of(found["all"] - found["n"])
    firsts = [sum(n for *_, n in ranges[:i]) for i in range(len(ranges))]
    lows, widths, blocks = zip(*ranges)
    listed = lambda values, kind: F.array(*[F.lit(kind(x)) for x in values])
    # Numbers of ids may be beyond 64 bits.
    table = [listed(lows, int), listed(widths, float), listed(blocks, int), listed(firsts, int)]
    share = tie.cast("double") / float(1 << 64) + 0.5
    part = lambda at, n: F.greatest(F.least(F.floor(at * n), n - 1), F.lit(0)).cast("bigint")

    def block(at: Column) -> Column:
        low, ids, n, first = (F.get(column, at) for column in table)
        inside = F.when(ids == 1, share).otherwise((number.cast("double") - low.cast("double")) / ids)
        return first.cast("bigint") + F.when(n == 1, F.lit(0).cast("bigint")).otherwise(part(inside, n))

    at = F.size(F.filter(table[0].cast("array<bigint>"), lambda low: low <= number)) - 1
    placed = F.when(number.isNull(), part(share, F.lit(nulls)) - nulls).otherwise(bind(at, block))
    in_order = Window.orderBy("__block")
    heads = documents.groupBy(placed.alias("__block")).agg(F.min(F.struct(F.col(doc_id).alias("id"), tie.alias("tie"))).alias("__head"))
    heads = heads.withColumn("__before", F.lag("__block").over(in_order))
    # The last block is followed by the first one.
    last = F.max("__block").over(Window.partitionBy())
    return placed, heads.withColumn("__before", F.coalesce("__before", last))


def with_next(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with `anchors` of their text, and text and anchors of the next document (`next_text`,
    `next_anchors`): ascending ids, after the last the first. Null ids come first; rows that share an id follow each
    other in the order of a hash of their text, then of the text; repeated rows follow each other. A single document is its own next.

    Texts are moved once, to blocks of neighbouring ids. The first row of a block also goes, as a guest, to the
    block before, whose last row it follows. Rows that share an id, or have none, are dealt out by the hash of their text;
    only copies with one id stay together. The table of first ids has a row for each block, at most about 500,000
    whatever the documents are, and is broadcast for that reason.
    """
    tie = F.xxhash64(text)
    placed, heads = _blocks(documents.select(doc_id, text), doc_id, tie)
    rows = documents.withColumns({"__block": placed, "__tie": tie})
    guests = F.broadcast(heads.select("__block", "__head", "__before"))
    rows = rows.join(guests, "__block", "left")
    first = F.col(doc_id).eqNullSafe(F.col("__head.id")) & (F.col("__tie") == F.col("__head.tie"))
    home = F.struct(F.col("__block").alias("block"), F.lit(0).alias("guest"))
    away = F.struct(F.col("__before").alias("block"), F.lit(1).alias("guest"))
    rows = rows.withColumn("__at", F.explode(F.when(first, F.array(home, away)).otherwise(F.array(home))))
    rows = rows.withColumns({"__to": F.col("__at.block"), "__guest": F.col("__at.guest")})
    kept = without(rows, "anchors", "next_text", "next_anchors")
    kept = kept.drop("__at", "__block", "__head", "__before").repartition("__to")
    order = Window.partitionBy("__to").orderBy("__guest", doc_id, "__tie", text)
    seen = kept.withColumn("anchors", anchors(F.col(text)))
    seen = seen.withColumns(
        {"next_text": F.lead(text).over(order), "next_anchors": F.lead("anchors").over(order)}
    )
    return seen.filter("__guest = 0").drop("__to", "__guest", "__tie")
