"""License notices against a plain search of every block, and on odd rows."""

import re

import pytest
from pyspark.sql import functions as F

from textflow.llm import licenses, queries

TEMPLATES = (*licenses.PHRASES, *licenses.NOTICES)
DOCUMENTS = "doc_id long, text string"


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_blocks(words, templates=TEMPLATES):
    """Every block of every template, and every place of a phrase, without any filter."""
    held, places = set(), set()
    for k, t in enumerate(templates):
        tokens, m = set(t.words), len(t.words)
        for block in range(0, len(words), t.stride):
            shared = len(tokens & set(words[block : block + 2 * t.stride]))
            if shared >= t.need:
                held.add((k, block, min(block + 2 * t.stride, len(words)), shared / len(tokens)))
        if t.phrase:
            places |= {(k, i) for i in range(len(words) - m + 1) if words[i : i + m] == t.words}
    return held, places


TEXTS = [
    None,
    "",
    " ... ",
    "CC BY",
    "cc, by cc BY; x all rights reserved. All Rights\nReserved",
    "Released under the MIT License",
    "released license under MIT " + "filler " * 30 + "the",
    "the the the the software is provided as is without warranty of kind express or implied",
    "é general public license ß GENERAL PUBLIC LICENSE general public  license",
    "by cc by cc by",
    "all rights " * 9 + "reserved",
    " ".join(f"w{i % 13} by" for i in range(30_000)) + " under the apache license version 2 0",
]


def test_blocks_and_places_are_all_found(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), DOCUMENTS).repartition(3)
    rows = {r.doc_id: r for r in licenses.scan(frame).collect()}
    for k, text in enumerate(TEXTS):
        words = plain_words(text)
        held, places = plain_blocks(words)
        assert rows[k].n_words == len(words)
        assert {(b.template, b.start, b.end, b.containment) for b in rows[k].blocks} == held and len(rows[k].blocks) == len(held)
        assert {tuple(p) for p in rows[k].places} == places and len(rows[k].places) == len(places)
        names = {TEMPLATES[t].label for t, _ in places}
        assert rows[k].base_labels == sorted(names)
        assert rows[k].labels == sorted(names | {TEMPLATES[b[0]].label for b in held if not TEMPLATES[b[0]].phrase})
        assert 0 <= rows[k].score <= 1 and (rows[k].score == 1 or not places)


def test_filters_lose_nothing_at_any_threshold(spark):
    templates = [licenses.Template(f"t{k}", "the software is provided as is without warranty of any kind", least) for k, least in enumerate((1, 34, 50, 77, 100))]
    frame = spark.createDataFrame(list(enumerate(TEXTS)), DOCUMENTS)
    for row in licenses.scan(frame, templates).collect():
        held, _ = plain_blocks(plain_words(TEXTS[row.doc_id]), templates)
        assert {(b.template, b.start, b.end, b.containment) for b in row.blocks} == held


def test_odd_rows(spark):
    rows = [(None, "cc by"), (None, "cc by"), (1, "cc by"), (1, None)]
    frame = spark.createDataFrame(rows, DOCUMENTS).withColumns({"Labels": F.lit(1), "score": F.lit("mine"), "words": F.lit(2)})
    found = licenses.scan(frame).collect()
    assert sorted((r.n_words, ",".join(r.labels), r.score, r.words) for r in found) == [(0, "", 0.0, 2)] + [(2, "cc-by", 1.0, 2)] * 3
    assert licenses.scan(frame, ()).filter("size(blocks) + size(places) + score > 0").count() == 0
    assert licenses.scan(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(frame, [licenses.Template("x", "w " * (licenses.MOST_TEMPLATE_WORDS + 1))])


def test_nothing_moves_and_nothing_leaves_the_jvm(spark):
    plan = queries.op11_licenses(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Arrow" not in plan and "Python" not in plan
