"""Spelling variants against all pairs of words, and on odd rows."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from textflow.llm import spelling

DOCUMENTS = "doc_id long, text string"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(documents):
    counts = Counter()
    for doc_id, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return rows


def found(frame):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(frame).collect()]


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("letters", ["ab", "abcdé", "abcdefghijklmnopÿ"])
def test_all_pairs_are_found(spark, letters):
    choose = random.Random(len(letters))
    stems = ["".join(choose.choices(letters, k=choose.randint(5, 9))) for _ in range(60)]

    def edited(word):
        for _ in range(choose.randint(0, 3)):
            at, how = choose.randrange(len(word)), choose.randrange(3)
            word = word[:at] + (choose.choice(letters) if how else "") + word[at + (how < 2) :]
        return word

    documents = [(i, " ".join(edited(w) for w in choose.choices(stems, k=120)) + ".") for i in range(40)]
    rows = found(spark.createDataFrame(documents, DOCUMENTS).repartition(3))
    expected = plain(documents)
    assert order(rows) == order(expected)
    assert sum(r[1] is not None for r in expected) > 5


def test_pivots_do_not_overlap_and_cost_least():
    choose = random.Random(8)
    for _ in range(300):
        places = sorted(choose.sample(range(12), choose.randint(3, 6)))
        costs = [[choose.randint(1, 9) for _ in places] for _ in range(2)]
        a, b = spelling.pivots(places, costs)
        assert places[b] - places[a] >= 2
        pairs = [(i, j) for i, j in combinations(range(len(places)), 2) if places[j] - places[i] >= 2]
        assert costs[0][a] + costs[1][b] == min(costs[0][i] + costs[1][j] for i, j in pairs)


def test_odd_rows(spark):
    long = " ".join(["letter", "Letters", "lettre", "LETTER"] * 200_000)
    documents = [(1, None), (2, ""), (3, "1 2 !"), (None, "lettter lettter"), (None, "lettter lettter"), (4, long), (4, long), (5, "Écoles " * 5 + "écoles " * 20), (6, "x" * 70_000)]
    frame = spark.createDataFrame(documents, DOCUMENTS).withColumns({"word": F.lit("mine"), "N": F.lit(1), "id": F.lit(0)})
    assert order(found(frame)) == order(plain(documents))
    assert found(frame.limit(0)) == [] and found(frame.filter("text is null")) == []


def test_long_chains_of_forms_lead_to_the_last(spark):
    words = ["aaaaa" + "b" * k for k in range(9)]
    text = " ".join(f"{w} " * (3 * 2**k) for k, w in enumerate(words))
    documents = [(k, text) for k in range(1)]
    rows = found(spark.createDataFrame(documents, DOCUMENTS))
    assert order(rows) == order(plain(documents)) and len({r[2] for r in rows}) <= 2
