"""Mixing sources to target weights: each source's blocks get release times and deadlines, the earliest
deadline goes first."""

from __future__ import annotations

import json
from collections.abc import Mapping
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textflow.llm.tables import without

# Lane of documents without a source, and of sources beyond the number that have lanes of their own.
REST = "*"
# Sources without a target that have a lane of their own, the most frequent ones.
MOST_LANES = 200
# Documents that follow each other from one source.
BLOCK = 8
# Hex digits of a document's key that name its part of a lane: 16 ** 3 parts of each lane.
PART_DIGITS = 3
MAX_WEIGHT = 10_000


def schedule(weights: Mapping[str, int]) -> list[tuple[str, int, int, int, int]]:
    """One period of the mix: `(lane, turn, release, deadline, slot)` for each of its slots.

    A lane of weight w among weights of sum W may use its turn j from slot floor(j W / w) on and has to before
    ceil((j + 1) W / w). In each slot the released turn with the earliest deadline runs (on a tie the lane named
    first). With one slot at a time this meets all deadlines, so in every prefix each lane is off its share by
    less than one turn. After W slots the pattern starts anew, so the table has W rows for any amount of data.
    """
    if any(w < 1 for w in weights.values()):
        raise ValueError("weights are whole numbers of at least 1")
    if not weights:
        return []
    shared = gcd(*weights.values())
    weights = {lane: w // shared for lane, w in weights.items()}
    total = sum(weights.values())
    if total > MAX_WEIGHT:
        raise ValueError(f"the weights add up to {total}; choose smaller ones, {MAX_WEIGHT} in all at most")
    turns = dict.fromkeys(weights, 0)
    period = []
    for slot in range(total):
        ready = [
            (-(-(turns[lane] + 1) * total // w), k, lane)
            for k, (lane, w) in enumerate(weights.items())
            if turns[lane] < w and turns[lane] * total // w <= slot
        ]
        deadline, _, lane = min(ready)
        period.append((lane, turns[lane], turns[lane] * total // weights[lane], deadline, slot))
        turns[lane] += 1
    return period


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The order of documents within a source: the hash of the id, or of the text where the id is null."""
    own = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text:"), F.md5(text)), F.lit(""))
    return F.md5(own)


def lanes(
    documents: DataFrame, targets: Mapping[str, int], rest: int = 1, source: str = "source", most: int = MOST_LANES
) -> dict[str, int]:
    """Weights of all lanes: the targets, then the other sources by name, then `REST` where it is needed.

    The sources without a target share the weight `rest` evenly, each in its own lane. Beyond `most` of them the most
    frequent ones, counted over all documents, have lanes, and all others share the lane `REST`, which then counts as one
    of them; so do documents without a source. At most that many names come to the driver.
    """
    other = F.coalesce(F.col(source), F.lit(REST))
    counts = documents.groupBy(other.alias("source")).agg(F.count("*").alias("n"))
    listed = counts.filter(~F.col("source").isin([*targets, REST])).orderBy(F.desc("n"), "source").limit(most + 1).collect()
    shared = len(listed) > most or not counts.filter(F.col("source") == REST).isEmpty()
    names = sorted(r.source for r in listed[:most]) + [REST] * (shared and REST not in targets)
    return {**{name: w * max(1, len(names)) for name, w in targets.items()}, **dict.fromkeys(names, rest)}


def mix(
    documents: DataFrame,
    targets: Mapping[str, int],
    rest: int = 1,
    block: int = BLOCK,
    source: str = "source",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Documents with their place in the mix: `lane`, `turn`, `release`, `deadline`, `slot`, `position`.

    `targets` gives whole-number weights of sources; all other sources share the weight `rest` evenly, in `lanes` of their
    own up to a bound. In its lane a document comes in the order of its hashed id, `block` of them make a turn.
    `position` orders the whole mix. All documents get a place: the slots of a lane that has run out stay empty,
    and the others go on with their deadlines, so the shares hold until the first lane has run out.

    Lanes are counted in 4,096 parts by the key's first digits. The sums before each part are a table of lanes
    times 4,096 rows and the period one of as many rows as the weights add up to, both bounded by parameters;
    so no task sees a whole lane, however large a source is. Repeated rows are placed one after the other.
    Columns of the result's names are replaced.
    """
    weights = lanes(documents, targets, rest, source)
    period = schedule(weights)
    spark = documents.sparkSession
    of_period = F.from_json(
        F.lit(json.dumps([dict(zip(("lane", "k", "r", "d", "s"), x, strict=True)) for x in period])),
        "array<struct<lane:string,k:bigint,r:bigint,d:bigint,s:bigint>>",
    )
    per_turn = spark.range(1).select(F.inline(of_period)).toDF("lane", "__k", "__r", "__d", "__s")

    added = ("lane", "turn", "release", "deadline", "slot", "position")
    named = F.from_json(F.lit(json.dumps(list(weights))), "array<string>")
    lane = F.when(F.array_contains(named, F.col(source)), F.col(source)).otherwise(REST)
    keyed = documents.withColumns({"__lane": lane, "__key": document_key(doc_id, text)})
    keyed = without(keyed, *added).withColumnRenamed("__lane", "lane")
    keyed = keyed.withColumn("__part", F.substring("__key", 1, PART_DIGITS))

    before = Window.partitionBy("lane").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        keyed.groupBy("lane", "__part")
        .agg(F.count("*").alias("__n"))
        .select("lane", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    )
    in_part = Window.partitionBy("lane", "__part").orderBy("__key", doc_id, text)
    numbered = keyed.withColumn("__i", F.row_number().over(in_part) - 1).join(
        F.broadcast(sums), ["lane", "__part"]
    )
    total = len(period)
    nth = F.col("__before") + F.col("__i")
    turned = numbered.withColumn("__nth", nth).withColumn("turn", F.expr(f"__nth div {block}"))
    # Weights of a lane, to find the turn in its period.
    weight = F.element_at(
        F.from_json(F.lit(json.dumps({name: sum(x[0] == name for x in period) for name in weights})), "map<string,bigint>"),
        F.col("lane"),
    )
    turned = turned.withColumn("__w_of", weight).withColumn("__k", F.col("turn") % F.col("__w_of"))
    placed = turned.join(F.broadcast(per_turn), ["lane", "__k"])
    periods = F.expr("turn div __w_of") * total
    placed = placed.withColumns(
        {
            "release": periods + F.col("__r"),
            "deadline": periods + F.col("__d"),
            "slot": periods + F.col("__s"),
        }
    ).withColumn("position", F.col("slot") * block + F.col("__nth") % block)
    own = [F.col(f"`{c}`") for c in documents.columns if c.lower() not in added]
    return placed.select(*own, *added)


def in_order_of_the_mix(
    documents: DataFrame, targets: Mapping[str, int], rest: int = 1, lane: str | None = None, position: str | None = None, **options
) -> DataFrame:
    """The documents, sorted by their place in the mix: files written from this follow each other in its order, and
    each file holds the sources in their shares. Columns stay as they are; on demand `lane` and `position` name further
    ones, which replace those of the same names."""
    own = [c for c in documents.columns if c.lower() not in {x.lower() for x in (lane, position) if x}]
    names = {c: f"__own_{i}" for i, c in enumerate(documents.columns)}
    read = {k: names[options.pop(k, k)] for k in ("source", "doc_id", "text")}
    mixed = mix(documents.withColumnsRenamed(names), targets, rest, **read, **options)
    ordered = mixed.orderBy("position", read["doc_id"])
    added = [F.col(c).alias(name) for c, name in (("lane", lane), ("position", position)) if name]
    return ordered.select(*[F.col(names[c]).alias(c) for c in own], *added)
