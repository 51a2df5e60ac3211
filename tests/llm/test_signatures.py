"""Signatures of near-duplicates, the text that toxicity learns from, and lanes of the mix."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textflow.llm import mixing, near_duplicates, toxicity
from textflow.llm.tables import Texts


def test_signatures_of_pairs_at_the_threshold_stay_within_the_bound(spark):
    most = near_duplicates.most_differences(240, 80)
    assert 36 < most < 90 and near_duplicates.most_differences(240, 100) == 0
    choose = random.Random(1)
    words = [f"w{i}" for i in range(1000)]
    texts, shares = [], []
    for _ in range(60):
        base = choose.sample(words, 100)
        for changed in (5, 60):
            # One word per shingle: sets of 100 words that share all but a few.
            other = base[changed:] + [f"x{choose.random()}" for _ in range(changed)]
            texts += [" ".join(base), " ".join(other)]
            shares.append((100 - changed) / (100 + changed))
    sign = near_duplicates.signer(1, 40, 6)()
    found = sign(Texts(pa.array(texts)))[3].to_pylist()
    frame = spark.createDataFrame([(i, found[2 * i], found[2 * i + 1]) for i in range(len(shares))], "i int, a array<long>, b array<long>")
    counted = {r.i: r.n for r in frame.select("i", near_duplicates._differences("a", "b", 8).alias("n")).collect()}
    for i, share in enumerate(shares):
        plain = sum((x >> 2 * k & 3) != (y >> 2 * k & 3) for x, y in zip(found[2 * i], found[2 * i + 1]) for k in range(32))
        assert counted[i] == plain
        # Minima agree with the chance of the similarity, their bits by a quarter of the rest as well.
        assert abs(plain / 240 - 0.75 * (1 - share)) < 0.12
        assert (plain <= most) == (share > 0.8)


def test_toxicity_learns_from_the_whole_text(spark):
    choose = random.Random(2)
    words = [f"word{i}" for i in range(300)]
    filler = lambda: " ".join(choose.choices(words, k=5000))
    rows = [(i, filler() + (" you awful stupid idiot" if i % 2 else " what a fine day it is")) for i in range(120)]
    # An id that many rows share is learned from once.
    rows += [(1000, "you awful stupid idiot")] * 50 + [(1001, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)] + [(1000, 1), (1001, 0), (1002, 1)], "doc_id long, toxic int")
    grams, known = toxicity.sample(documents, labels)
    assert len(grams) == 122 and Counter(known) == {0: 61, 1: 61}
    assert all(len(g) < 1 << 17 for g in grams)
    classifier = toxicity.fit_packed(grams, known)
    scored = toxicity.score(documents, classifier).collect()
    assert all((r.score >= 0.5) == bool(r.doc_id % 2) for r in scored if r.doc_id < 1000)


def test_packed_grams_are_those_of_the_whole_text():
    text = np.frombuffer(bytes(range(32, 120)) * 40, np.uint8)
    whole = {int(b) for size in toxicity.SIZES for b in toxicity.buckets(toxicity.PLAIN[text], size)}
    before, toxicity.AT_ONCE = toxicity.AT_ONCE, 100
    try:
        assert set(np.flatnonzero(np.unpackbits(toxicity.present(text)))) == whole
    finally:
        toxicity.AT_ONCE = before


def test_every_source_has_a_lane_up_to_the_bound(spark):
    many = spark.range(3000).selectExpr("id doc_id", "'t' text", "case when id % 10 = 0 then null else concat('s', id % 10) end source")
    found = mixing.lanes(many, {"s1": 3, "s2": 1}, 2)
    assert found == {"s1": 24, "s2": 8, **{f"s{k}": 2 for k in range(3, 10)}, mixing.REST: 2}
    rows = mixing.mix(many, {"s1": 3, "s2": 1}, 2, block=4).orderBy("position").collect()
    counts, total = Counter(), sum(found.values())
    for t, r in enumerate(rows[:600], 1):
        assert r.lane == (r.source or mixing.REST)
        counts[r.lane] += 1
        assert all(abs(counts[lane] - t * w / total) <= 2 * 4 for lane, w in found.items())
    assert mixing.lanes(many.filter("source is not null"), {"s1": 3}, 2, most=3) == {"s1": 12, "s2": 2, "s3": 2, "s4": 2, mixing.REST: 2}
    assert mixing.lanes(many.limit(0), {"s1": 3}, 2) == {"s1": 3} and mixing.lanes(many.limit(0), {}) == {}
    assert mixing.mix(many.limit(0), {}, 1).count() == 0
    assert len({r.position for r in mixing.mix(many, {}, 1).collect()}) == 3000
    assert mixing.mix(many.withColumn("source", F.lit("*")), {"a": 1}, 1).select("lane").distinct().collect() == [("*",)]
