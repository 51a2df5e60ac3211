"""Fingerprints against a plain version of the anchors, likeness by places, and rows that share an id."""

from __future__ import annotations

import random
import re

import xxhash
from pyspark.sql import functions as F

from textflow.llm import syncmers

K, S = syncmers.K, syncmers.S
MASK = (1 << 32) - 1


def signed(value, bits):
    return value - (1 << bits) if value >> (bits - 1) else value


def hash64(values, seed=42):
    """Spark's xxhash64 of texts or 64-bit numbers, one after the other."""
    for value in values:
        data = value.encode() if isinstance(value, str) else value.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return signed(seed, 64)


def hash32(values, seed=42):
    """Spark's hash of 64-bit numbers, one after the other: Murmur3 of their two halves."""
    turn = lambda x, n: (x << n | x >> (32 - n)) & MASK
    for value in values:
        for half in (value & MASK, value >> 32 & MASK):
            seed ^= turn(half * 0xCC9E2D51 & MASK, 15) * 0x1B873593 & MASK
            seed = (turn(seed, 13) * 5 + 0xE6546B64) & MASK
        seed ^= 8
        seed = (seed ^ seed >> 16) * 0x85EBCA6B & MASK
        seed = (seed ^ seed >> 13) * 0xC2B2AE35 & MASK
        seed ^= seed >> 16
    return signed(seed, 32)


def plain_anchors(text):
    words = [hash64([w]) for w in re.findall(r"[^\x20\x09-\x0D]{1,16}", text or "")]
    if len(words) < K:
        return [hash32(words)] if words else []
    runs = [hash64(words[i : i + S]) for i in range(len(words) - S + 1)]
    found = []
    for i in range(len(words) - K + 1):
        inner = runs[i : i + K - S + 1]
        if min(inner) in (inner[0], inner[-1]):
            found.append(hash32(inner[::S]))
    return found


def plain_likeness(a, b):
    a, b = list(dict.fromkeys(a)), list(dict.fromkeys(b))
    if not a and not b:
        return 1.0
    places = {x: i for i, x in enumerate(b)}
    moves = [places[x] - i for i, x in enumerate(a) if x in places]
    reach = max(len(a), len(b), 8) / 8
    return 2 * max(sum(abs(m - j * reach) <= reach for m in moves) for j in range(-8, 9)) / (len(a) + len(b))


def texts():
    choose = random.Random(11)
    word = lambda n: "".join(choose.choice("abcdefghij") for _ in range(n))
    prose = [word(choose.randint(1, 9)) for _ in range(300)]
    found = ["", "   ", "one", "one two three", "a b c d e f", "été \U0001f600 " * 9, "x" * 200, " ".join(prose)]
    found += [" ".join(prose[150:] + prose[:150]), " ".join(prose[:140] + ["new"] * 9 + prose[140:]), " ".join(prose[100:])]
    found += [" ".join([word(3) for _ in range(200)] + prose), " ".join(choose.choices("pqr", k=400)), " ".join(prose * 3)]
    return found


def test_anchors_and_likeness_of_a_plain_version(spark):
    listed = texts()
    rows = spark.createDataFrame(list(enumerate(listed)), "i long, text string").select("i", syncmers.anchors(F.col("text")).alias("a"))
    found = {r.i: r.a for r in rows.collect()}
    for i, text in enumerate(listed):
        assert found[i] == plain_anchors(text)
    other = rows.select(F.col("i").alias("j"), F.col("a").alias("b"))
    near = rows.crossJoin(other).select("i", "j", syncmers.likeness(F.col("a"), F.col("b")).alias("near"))
    near = {(r.i, r.j): r.near for r in near.collect()}
    for (i, j), value in near.items():
        assert value == plain_likeness(found[i], found[j]) == near[j, i] and 0 <= value <= 1
    assert all(near[i, i] == 1 for i in range(len(listed)))
    # Halves that changed places match once; a few words put in, or a start that is gone, cost little.
    assert near[7, 8] < 0.6 and near[7, 9] > 0.9 and near[7, 10] > 0.7 and near[7, 11] > 0.6


def test_null_text_has_no_anchors(spark):
    row = spark.range(1).select(syncmers.anchors(F.lit(None).cast("string")).alias("a")).first()
    assert row.a == []


def test_rows_that_share_an_id_are_dealt_out(spark, monkeypatch):
    """A third of the rows without an id and a third with one id: no block holds more than a part of them, and each
    row is followed by the next one all the same."""
    monkeypatch.setattr(syncmers, "ROWS_PER_BLOCK", 4)
    rows = [(None, f"n{i}") for i in range(3000)] + [(700, f"h{i}") for i in range(3000)]
    rows += [(i * (i % 7 + 1), f"t{i}") for i in range(3000)] + [(-(2**63), "least"), (2**63 - 1, "most"), (None, None)]
    random.Random(3).shuffle(rows)
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    placed, _ = syncmers._blocks(documents, "doc_id", F.xxhash64("text"))
    assert max(r["count"] for r in documents.groupBy(placed.alias("b")).count().collect()) < 60
    tie = lambda text: 42 if text is None else hash64([text])
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1])))
    after = {a: b[1] for a, b in zip(order, order[1:] + order[:1], strict=True)}
    found = syncmers.with_next(documents).collect()
    assert len(found) == len(rows)
    assert all(r.next_text == after[r.doc_id, r.text] for r in found)
