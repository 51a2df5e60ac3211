"""Hard negatives against plain sorting of all pairs, and on odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textflow.llm import hard_negatives

VECTORS = "vec_id long, label int, vector array<float>"


def test_strassen_is_exact():
    random_ = np.random.default_rng(5)
    for m, k, n in ((1, 1, 1), (7, 3, 5), (33, 65, 71), (130, 64, 97), (64, 129, 64), (3, 0, 4), (0, 5, 4)):
        for reach in (1 << 8, 1 << 28):
            a, b = random_.integers(-reach, reach, (m, k)), random_.integers(-reach, reach, (k, n))
            assert (hard_negatives.strassen(a, b, leaf=4) == a @ b).all()


def plain(rows, positives=5, negatives=3, least=50, most=95):
    kept = []
    for place, (id, label, vector) in enumerate(rows):
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((place, id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    last = lambda id: (id is None, id or 0)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    found = []
    for place, id, label, vector in kept:
        if id is None or id % 50:
            continue
        scored = sorted(((-dot(vector, v), last(i), p, i, lab) for p, i, lab, v in kept if p != place))
        for s, _, _, positive, _ in [x for x in scored if x[4] == label][:positives]:
            near = [x for x in scored if x[4] != label and least * -s <= 100 * -x[0] <= most * -s][:negatives]
            found += [(id, positive, rank, x[3], -s, -x[0]) for rank, x in enumerate(near, 1)]
    return found


def mined(frame, **options):
    return [tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 50 == 0, id="vec_id", **options).collect()]


def order(rows):
    return sorted(rows, key=str)


def test_all_negatives_of_all_anchors(spark, monkeypatch):
    choose = random.Random(3)
    rows = [(i, choose.randrange(4), [choose.gauss(0, 0.3) + 0.2 for _ in range(9)]) for i in range(400)]
    # Ties: many rows of few different vectors, a third of them with one label.
    rows += [(1000 + i, 1 if i % 3 == 0 else i % 5, [0.5, 0.25 * (i % 4), 0.125]) for i in range(160)]
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    expected = plain(rows)
    assert len(expected) > 50 and order(mined(frame)) == order(expected)
    assert order(mined(frame, positives=2, negatives=1, least=10, most=99)) == order(plain(rows, 2, 1, 10, 99))
    monkeypatch.setattr(hard_negatives, "ANCHORS_AT_ONCE", 3)
    monkeypatch.setattr(hard_negatives, "TILE", 16)
    assert order(mined(frame)) == order(expected)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (1, 1, [1.0]), (2, 1, []), (3, 2, [1.0, 1.0, 9.0]), (None, 2, [0.9, 1.4]),
        (None, 1, [0.9, 2.4]), (4, None, [1.0, 2.0]), (5, 2, None), (6, 2, [1.0, None]), (7, 2, [nan, 1.0]), (8, 2, [1.0, inf]),
        (50, 3, [-1.0, -2.0]), (100, 2, [0.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, VECTORS).withColumns({"Row": F.lit("mine"), "is_anchor": F.lit(1), "anchor": F.lit(2)})
    expected = plain(rows)
    assert expected and order(mined(frame)) == order(expected)
    assert mined(frame.limit(0)) == [] and mined(frame.filter("vec_id = 3")) == [] and mined(frame.filter("label is null")) == []
    with pytest.raises(Exception, match="64 bits"):
        mined(spark.createDataFrame([(0, 1, [1e30]), (1, 1, [1e30])], VECTORS))
