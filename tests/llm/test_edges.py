"""Nulls, empty and long texts, ties, repeated rows, empty tables, extra and clashing columns."""

from __future__ import annotations

import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from textflow.llm import (  # noqa: E402
    components,
    decontamination,
    language,
    mixing,
    near_duplicates,
    pii,
    queries,
    sharding,
    syncmers,
    toxicity,
    url_filter,
    warc,
)

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 997} the" for i in range(60_000))
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "", 0),
    (3, "  \n\t ", "en", "src0", 5),
    (None, "a text without id and some words", "en", "src0", 3),
    (None, "a text without id and some words", "en", "src0", 3),
    (4, "mail a.b@c.de or 1.2.3.4, card 4111 1111 1111 1111 é", "fr", "src1", 40),
    (4, "mail a.b@c.de or 1.2.3.4, card 4111 1111 1111 1111 é", "fr", "src1", 40),
    (5, LONG, "en", "src0", len(LONG)),
    (6, "x" * 70_000, "en", "src2", 70_000),
    (7, "12345 !!! 67", "de", None, 12),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENTS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


def clashing(frame, *names):
    return frame.withColumns({name: F.lit("mine") for name in names})


def test_shards_take_turns(spark, odd, none):
    table = sharding.slot_table(queries.SHARDS)
    sizes = Counter(table).values()
    assert len(table) == sharding.TABLE_SIZE and max(sizes) - min(sizes) <= 1
    fewer = sharding.slot_table(queries.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != len(queries.SHARDS) - 1)
    assert moved < 0.1 * len(table)
    keys = [F.col("doc_id"), F.md5("text")]
    placed = sharding.place(clashing(odd, "Slot", "shard"), keys, queries.SHARDS).collect()
    assert len(placed) == len(ODD) and all(r.shard == queries.SHARDS[table[r.slot]] for r in placed)
    assert len({r.shard for r in placed if r.doc_id == 4}) == 1
    assert sharding.place(none, keys, queries.SHARDS).count() == 0


def test_mix_keeps_its_shares(spark, odd, none):
    weights = {"a": 5, "b": 3, "c": 1}
    period = mixing.schedule(weights)
    for t in range(1, len(period) + 1):
        for lane, w in weights.items():
            assert abs(sum(x[0] == lane for x in period[:t]) - t * w / len(period)) < 1
    assert all(release <= slot < deadline for _, _, release, deadline, slot in period)
    many = spark.range(4000).selectExpr("id doc_id", "'t' text", "case when id % 3 = 0 then 'a' when id % 3 = 1 then 'b' else null end source")
    rows = mixing.mix(many, {"a": 2}, 1, block=4).orderBy("position").collect()
    assert len(rows) == 4000 and len({r.position for r in rows}) == 4000
    first = [r.lane for r in rows[:1500]]
    assert abs(first.count("a") - 1000) <= 4
    mixed = mixing.mix(clashing(odd, "slot", "LANE"), queries.TARGETS, queries.REST).collect()
    assert len(mixed) == len(ODD) and len({r.position for r in mixed}) == len(ODD)
    assert mixing.in_order_of_the_mix(clashing(odd, "position"), queries.TARGETS).columns == [*odd.columns, "position"]
    assert mixing.mix(none, queries.TARGETS).count() == 0


def test_personal_data(spark, odd, none):
    tricky = [
        "a@b.c_x@y.z a@b.c.d.e.f @b.c a@b a@b.-", "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.1.1 1.2.3", "+1 (017) 555-7713 +49(0)30 12345 +12",
        "4111111111111111 4111-1111-1111-1112 0 0 0 0 0 0 0 0 0 0 0 0 0 0 0 0 0 0 0 0", "é😀 a@b.co é 10.0.0.1", "a" * 5000 + "@", "1" * 5000,
    ]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(tricky)], "doc_id long, text string")
    for row in pii.find(clashing(frame, "PII")).collect():
        base = [(s.start, s.place, s.kind, s.end) for s in row.pii if s.place < 4]
        assert base == brute.base_spans(row.text)
    found = {(r.doc_id, i): r.pii for i, r in enumerate(pii.find(odd).collect())}
    assert len(found) == len(ODD) and all(x is not None for x in found.values())
    assert pii.find(none).count() == 0
    more = spark.createDataFrame([("IBAN DE89 3704 0044 0532 0130 00.",), ("IBAN DE88 3704 0044 0532 0130 00.",), ("ssn 123-45-6789",), ("no 123-45-6789",), ("a@b.co and 1.2.3.4!",)], "text string")
    assert [[s.kind for s in r.pii if s.kind not in ("card",)] for r in pii.find(more).collect()][:4] == [["iban"], [], ["ssn"], []]
    assert pii.redact(pii.find(more)).collect()[4].text == "<EMAIL> and <IP>!"


def test_components(spark):
    random.seed(5)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(7, 7), (500, 501), (500, 501), (None, 3)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    roots = brute.roots(600, [(a, b) for a, b in edges if a is not None])
    assert found == {x: roots[x] for e in edges if e[0] is not None and e[0] != e[1] for x in e}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def chain(count=60, words=120, seed=3):
    """Texts of which each differs a little from the one before, so that far ones are linked by others alone."""
    choose, now = random.Random(seed), [f"v{i}" for i in range(words)]
    for i in range(count):
        yield i, " ".join(now)
        now = list(now)
        now[choose.randrange(words)] = f"n{i}"


def test_near_duplicates_of_chains_and_odd_rows(spark, odd, none):
    texts = [*chain(), *((100 + i, t) for i, t in chain(40, 60, 9)), *((200 + i, "one two") for i in range(5)), (300, None), (301, " ")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: r for r in near_duplicates.near_duplicates(frame, 2).collect()}
    sets = [brute.shingles(t, 2) for _, t in texts]
    roots = brute.roots(len(sets), brute.linked(sets))
    assert {i: r.component_id for i, r in found.items()} == {d[0]: texts[roots[i]][0] for i, d in enumerate(texts)}
    rows = near_duplicates.near_duplicates(clashing(odd, "node", "bands", "digest"), 5).collect()
    assert len(rows) == len(ODD)
    assert {(r.doc_id, r.component_id) for r in rows} == {(d[0], d[0]) for d in ODD}
    kept = near_duplicates.deduplicated(clashing(odd, "node"), 5)
    assert kept.columns == [*odd.columns, "node"] and kept.count() == len(ODD) - 2
    assert near_duplicates.near_duplicates(none, 5).count() == 0


def test_fingerprints(spark, odd, none):
    rows = syncmers.with_next(clashing(odd, "anchors", "next_text")).collect()
    assert len(rows) == len(ODD) and rows[0].anchors is not None
    order = sorted(ODD, key=lambda d: (d[0] is not None, d[0] or 0))
    after = {a[0]: b[1] for a, b in zip(order, order[1:] + order[:1], strict=True)}
    for r in rows:
        if r.doc_id not in (None, 4):
            assert r.next_text == after[r.doc_id]
    assert syncmers.with_next(none).count() == 0
    sparse = spark.createDataFrame([(10**15, "b"), (-5, "a"), (3, "c")], "doc_id long, text string")
    assert {r.doc_id: r.next_text for r in syncmers.with_next(sparse).collect()} == {-5: "c", 3: "b", 10**15: "a"}
    many = spark.range(5000).selectExpr("id * id doc_id", "cast(id as string) text")
    assert all(int(r.next_text) == (int(r.text) + 1) % 5000 for r in syncmers.with_next(many).collect())
    one = syncmers.with_next(sparse.limit(1)).collect()
    assert len(one) == 1 and one[0].text == one[0].next_text


def test_archives(spark):
    given = [(3, "u\r\nx", "same"), (1, None, "same"), (2, "é", None), (None, "n", "same"), (None, "n", "other"), (5, "", ""), (6, "z", "x\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame(given, "page_id long, url string, html string").repartition(2)
    rows = warc.archive_and_read(clashing(pages, "archive")).collect()
    found = {(r.page_id, r.payload_digest): (r.payload_bytes, r.record_type, r.refers_to) for r in rows}
    sha = brute.sha1_base32
    assert found == {
        (1, sha(b"same")): (4, "response", None), (3, sha(b"same")): (4, "revisit", 1), (None, sha(b"same")): (4, "revisit", 1),
        (2, sha(b"")): (0, "response", None), (5, sha(b"")): (0, "revisit", 2),
        (None, sha(b"other")): (5, "response", None), (6, sha(b"x\r\n\r\nWARC/1.1")): (13, "response", None),
    }
    assert warc.archive_and_read(pages.limit(0)).count() == 0
    assert {r.record_type for r in warc.archive_and_read(pages, least_bytes=100).collect()} == {"response"}


def test_hamming_index_misses_nothing():
    random = np.random.default_rng(1)
    entries = random.integers(0, 1 << 63, 300, np.uint64)
    asked = entries.repeat(4)
    for i in range(len(asked)):
        for b in random.choice(64, i % 14, replace=False):
            asked[i] ^= np.uint64(1) << np.uint64(b)
    query, entry = decontamination.HammingIndex(entries).search(asked)
    near = np.bitwise_count(asked[:, None] ^ entries[None, :]) <= decontamination.RADIUS
    assert set(zip(query.tolist(), entry.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_leaks(spark, odd, none):
    choose = random.Random(2)
    word = lambda: "".join(choose.choice("abcdefghijklm") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((3, 6, 12, 16, 25, 40, 60, 150))]
    items += [(90, items[5][1]), (None, ""), (91, None)]
    documents = []
    for i, (_, text) in enumerate(items[:8]):
        fill = lambda: " ".join(word() for _ in range(choose.randrange(60)))
        words = text.split()
        if len(words) >= 60:
            words[len(words) // 2] = "EDITED"
        documents += [(2 * i, f"{fill()} {' '.join(words).upper()}, {fill()}"), (2 * i + 1, fill())]
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for at_once in (20_000, 3):
        leaks = decontamination.with_leaks(clashing(frame, "Leaks"), benchmark, items_at_once=at_once).collect()
        found = {(r.doc_id, x.item_id) for r in leaks for x in r.leaks}
        assert found == {(2 * i, i) for i in range(8)} | {(10, 90)}
    assert all(len(r.leaks) == 0 for r in decontamination.with_leaks(odd, benchmark).collect())
    assert decontamination.with_leaks(none, benchmark).count() == 0
    assert decontamination.with_leaks(frame, benchmark.limit(0)).filter("size(leaks) > 0").count() == 0


def test_languages_and_toxicity_of_odd_rows(spark, odd, none):
    network = language.fit([b"the cat and the dog " * 9, "le chat et le chien é ".encode() * 9], ["en", "fr"], steps=60)
    rows = language.identify(clashing(odd, "lang_pred"), network).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert language.fit(*language.sample(none)) is None
    assert language.identify(none, None).count() == 0
    assert {r.lang_pred for r in language.identify(odd, None).collect()} == {"und"}
    classifier = toxicity.fit([b"you idiot there", b"good day to you"] * 20, [1, 0] * 20)
    scores = toxicity.score(clashing(odd, "SCORE"), classifier).collect()
    assert len(scores) == len(ODD) and len({r.score for r in scores if not (r.text or "").strip()}) == 1
    assert toxicity.score(none, classifier).count() == 0
    assert [toxicity.fit(t, y).offset for t, y in (([], []), ([b"a"], [1]), ([b"a"], [0]))] == [0.0, 1.0, -1.0]
    pieces = spark.createDataFrame([("idi",), ("ot you idiot",), ("", ), ("i",)], "text string").coalesce(1)
    alone = [toxicity.score(pieces.filter(F.col("text") == t), classifier).first().score for t in ("idi", "ot you idiot", "", "i")]
    assert [r.score for r in toxicity.score(pieces, classifier).collect()] == alone


def test_urls(spark):
    given = [(1, None, None), (2, "no scheme", "x"), (3, "http://A.example.NET/en/x?y", "<a href='http://bad.net/'>"), (4, "ftp://net", ""), (5, "http://net/", ""), (6, "http://xnet/a", ""), (6, "http://xnet/a", ""), (7, "http://links.to/bad", '<a href="//evil.net/x">'), (8, "://h#://z", "")]
    pages = spark.createDataFrame(given, "page_id long, url string, html string")
    rows = url_filter.judge(clashing(pages, "verdict", "HOST"), queries.RULES).collect()
    assert len(rows) == len(given)
    for r in rows:
        host, path = brute.host_path(r.url)
        rule, action = brute.rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and (action is None or r.verdict == action)
    assert url_filter.judge(pages.limit(0), queries.RULES).count() == 0
    ranks = {r.host: r for r in url_filter.spread(
        spark.createDataFrame([("good", "a"), ("a", "b"), ("x", "bad")], "src string, dst string"),
        spark.createDataFrame([("good", 1.0, 0.0), ("bad", 0.0, 1.0)], "host string, trusted double, blocked double"),
    ).collect()}
    assert ranks["a"].trust > ranks["b"].trust > 0 and ranks["x"].distrust > 0 and ranks["b"].distrust == 0


def test_pipeline(spark, odd):
    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = corpus_pipeline.run(spark, folder).collect()
    kept = {r.doc_id: r for r in rows}
    every = {r.doc_id: r for r in documents.collect()}
    ids = [i for i in sorted(every) if any(c.isalpha() for c in every[i].text or "")]
    sets = [brute.shingles(every[i].text, 5) for i in ids]
    roots = brute.roots(len(ids), brute.linked(sets))
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    expected = {ids[i] for i in range(len(ids)) if roots[i] == i and not brute.leaks(every[ids[i]].text, items)}
    assert len(rows) == len(kept) and set(kept) <= expected and len(kept) >= 0.98 * len(expected)
    table = sharding.slot_table(queries.SHARDS)
    assert all(r.shard == queries.SHARDS[table[r.slot]] for r in rows)
    assert rows[0].asDict().keys() == {*documents.columns, "slot", "shard", "mix_lane", "mix_position"}
    docs = clashing(odd, "node", "leaks", "lane")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.columns[: len(odd.columns) + 3] == [*odd.columns, "node", "leaks", "lane"]
        docs.collect()
