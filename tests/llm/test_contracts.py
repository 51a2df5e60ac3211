"""Each query over the whole small tables against a plain version."""

from __future__ import annotations

import hashlib
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from textflow.llm import queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{FOLDER}/pages.parquet").orderBy("page_id").collect()


def result(spark, name, key="doc_id"):
    return {row[key]: row for row in queries.QUERIES[name](spark, FOLDER).collect()}


def test_personal_data(spark, documents):
    found = result(spark, "op2_pii")
    assert len(found) == len(documents)
    for d in documents:
        spans = brute.base_spans(d.text or "")
        row = found[d.doc_id]
        assert [row[f"n_{kind}"] for kind in brute.KINDS] == [sum(s[2] == kind for s in spans) for kind in brute.KINDS]
        listed = [f"{kind}:{start}:{end}" for start, _, kind, end in spans]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row.spans.split(",")) | {""}


def test_near_duplicates(spark, documents):
    found = result(spark, "op3_minhash")
    sets = [brute.shingles(d.text, 2) for d in documents]
    roots = brute.roots(len(sets), brute.linked(sets))
    for i, d in enumerate(documents):
        row = found[d.doc_id]
        assert (row.n_shingles, row.component_id) == (len(sets[i]), documents[roots[i]].doc_id)
        assert row.kept == (roots[i] == i)


def test_language(spark, documents):
    found = result(spark, "op4_language")
    assert len(found) == len(documents)
    held = [d for d in documents if brute.crc(d.doc_id) % 4 == 2]
    for d in documents:
        row = found[d.doc_id]
        assert row.held_out == (brute.crc(d.doc_id) % 4 == 2)
        assert (row.lang_pred == "und") == (not any(c.isalpha() for c in d.text or ""))
        assert 0 <= row.score <= 1
    assert sum(found[d.doc_id].lang_pred == d.lang for d in held) >= 0.95 * len(held)


def test_fingerprints(spark, documents):
    found = result(spark, "op5_syncmers")
    by_text = {}
    for d, after in zip(documents, documents[1:] + documents[:1], strict=True):
        row, text = found[d.doc_id], d.text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + (after.text or "")[:half]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        if len(text) > 500 and text != (after.text or "") and row.near_next < 0.2:
            assert 0.2 < row.near_edited < 0.9


def test_archives(spark, pages):
    found = result(spark, "op6_warc", "page_id")
    assert len(found) == len(pages)
    first = {}
    for p in pages:
        payload = (p.html or "").encode()
        response = first.setdefault(payload, p.page_id)
        row = found[p.page_id]
        assert (row.payload_bytes, row.payload_digest) == (len(payload), brute.sha1_base32(payload))
        revisit = response != p.page_id
        assert (row.record_type, row.refers_to) == (("revisit", response) if revisit else ("response", None))


def test_benchmark_passages(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    found = {(r.doc_id, r.item_id): r.similarity for r in queries.op7_decontamination(spark, FOLDER).collect()}
    expected = {(d.doc_id, i): v for d in documents for i, v in brute.leaks(d.text, items).items()}
    assert found.keys() == expected.keys() and len(found) > 0
    assert all(abs(found[k] - v) < 1e-4 for k, v in expected.items())


def test_urls(spark, pages):
    found = result(spark, "op9_urls", "page_id")
    assert len(found) == len(pages)
    judged = brute.verdicts([(p.page_id, p.url, p.html) for p in pages])
    for p in pages:
        row = found[p.page_id]
        host, path = brute.host_path(p.url)
        rule, action = brute.rule(host, path)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == judged[p.page_id][0] and (action is None or row.verdict == action)


def test_toxicity(spark, documents):
    found = {r.doc_id: r for r in queries.op10_toxicity(spark, FOLDER).collect()}
    assert len(found) == len(documents)
    for d in documents:
        row = found[d.doc_id]
        assert row.held_out == (brute.crc(d.doc_id) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in queries.op10_toxicity(spark, folder).collect()}
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if found[r.doc_id].held_out]
    toxic = [found[r.doc_id].score for r in labels if r.toxic == 1]
    other = [found[r.doc_id].score for r in labels if r.toxic == 0]
    assert sum(s >= 0.5 for s in toxic) >= 0.85 * len(toxic)
    assert sum(s >= 0.5 for s in other) <= 0.04 * len(other)
