"""The commit log, buckets and levels of the document store."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textflow.functions import envelope
from textflow.operators import commits
from textflow.operators.commits import CommitLog, Conflict, Part, State
from textflow.operators.store import DocumentStore
from textflow.session import work_folder
from textflow.sources.channels import message_folder
from textflow.sources.files import Files

DOCUMENT = "id string, text string, type string"
UPDATE = "id string, type string, prediction string, ts timestamp, seq long"


@pytest.fixture
def store(spark):
    return DocumentStore(spark, work_folder(spark, "store"), buckets=8, fan=3).create()


def docs(spark, *ids):
    return spark.createDataFrame([(i, f"text {i}", "s") for i in ids], DOCUMENT)


def answers(spark, *rows):
    return spark.createDataFrame([(i, t, p, None, k) for k, (i, t, p) in enumerate(rows)], UPDATE)


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_a_commit_is_made_once(spark):
    log = CommitLog(spark, work_folder(spark, "log"))
    assert log.read() is None
    log.commit(State(0, 4), log.path)
    after = log.read().after_batch("0", 0, [Part("documents", "a", 0, (1, 2))])
    log.commit(after, log.path)
    with pytest.raises(Conflict):
        log.commit(State(0, 4).after_batch("0", 0, []), log.path)
    assert log.read() == after and log.read().has("0", 0) and not log.read().has("0", 1) and not log.read().has("1", 0)
    assert all(not name.startswith(".") or name.endswith(".crc") for name in log.files.names(log.path))


def test_old_versions_and_replaced_parts_go(spark, monkeypatch):
    monkeypatch.setattr(commits, "KEPT_VERSIONS", 4)
    store = DocumentStore(spark, work_folder(spark, "store"), buckets=2, fan=2).create()
    for k in range(9):
        store.add_documents(docs(spark, str(k)), "text", k)
    state = store.state("documents")
    assert store.documents().count() == 9 and len(state.parts) <= 4
    files = Files(spark, store.path)
    assert len(files.names(f"{store.path}/log/documents")) <= 2 * 5
    kept = {n.removeprefix("part=") for n in files.names(f"{store.path}/documents") if n.startswith("part=")}
    assert {p.name for p in state.parts} <= kept and len(kept) <= len(state.parts) + len(state.retired)


def test_batch_looks_into_its_buckets_only_and_reads_ids_once(spark, store, monkeypatch):
    store.add_documents(docs(spark, *map(str, range(200))), "text", 0)
    read = []
    whole = DocumentStore._read

    def watched(self, table, buckets=None, parts=None):
        frame = whole(self, table, buckets, parts)
        if table == "documents" and buckets is not None:
            read.append((sorted(buckets), frame.inputFiles()))
        return frame

    monkeypatch.setattr(DocumentStore, "_read", watched)
    store.add_predictions(answers(spark, ("7", "A", "x"), ("nobody", "A", "x")), 0)
    hashed = spark.createDataFrame([("7",), ("nobody",)], "id string").select(F.pmod(F.xxhash64("id"), F.lit(8)))
    expected = sorted({r[0] for r in hashed.collect()})
    assert len(read) == 1 and read[0][0] == expected and len(expected) <= 2
    assert {f.split("bucket=")[1].split("/")[0] for f in read[0][1]} == set(map(str, expected))
    assert rows(store.predictions(), "id") == [("7",)] and rows(store.rejected(), "id") == [("nobody",)]
    read.clear()
    store.add_documents(docs(spark, "7"), "text", 1)
    assert len(read) == 1 and len(read[0][0]) == 1


def test_files_have_bloom_filters_of_ids(spark, store):
    for k in range(3):
        store.add_documents(docs(spark, *map(str, range(50 * k, 50 * k + 50))), "text", k)
    (part,) = store.state("documents").parts
    assert part.level == 1
    file = next(Path(store.path).glob(f"documents/part={part.name}/bucket=*/*.parquet"))
    java = spark._jvm.org.apache.parquet
    path = spark._jvm.org.apache.hadoop.fs.Path(str(file))
    reader = java.hadoop.ParquetFileReader.open(java.hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration()))
    try:
        columns = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in reader.getFooter().getBlocks()[0].getColumns()}
    finally:
        reader.close()
    assert columns["id"] > 0 and columns["text"] <= 0
    assert rows(store.find("7", "none"), "id", "text") == [("7", "text 7")]


def test_parts_stay_few_and_latest_is_that_of_all_updates(spark, store):
    ids = [str(i) for i in range(6)]
    store.add_documents(docs(spark, *ids), "text", 0)
    expected, seen = {}, {}
    for k in range(14):
        batch = [(i, "A" if k % 2 else "B", f"{k}") for i in ids[k % 3 :]]
        store.add_predictions(answers(spark, *batch), k)
        for i, t, p in batch:
            expected[i, t], seen[i, t] = p, seen.get((i, t), 0) + 1
        parts = [p for p in store.state("updates").parts if p.table == "predictions"]
        assert all(sum(p.level == level for p in parts) < store.fan for level in range(4))
    found = {(r.id, r.type): (r.prediction, r.updates) for r in store.latest().collect()}
    assert found == {key: (expected[key], seen[key]) for key in expected}
    copy = store.compact_into(work_folder(spark, "store"))
    assert {(r.id, r.type): (r.prediction, r.updates) for r in copy.latest().collect()} == found
    copy.add_predictions(answers(spark, ("0", "A", "more")), 0)
    assert rows(copy.latest().filter("id = '0' and type = 'A'"), "prediction", "updates") == [("more", seen["0", "A"] + 1)]


class Broken(DocumentStore):
    """Fails at its n-th write."""

    left = 0

    def _write(self, rows, table, level=0):
        part = super()._write(rows, table, level)
        if not self.left:
            raise OSError("gone")
        self.left -= 1
        return part


@pytest.mark.parametrize("writes", range(4))
def test_a_batch_counts_whole_or_not_at_all(spark, writes):
    store = Broken(spark, work_folder(spark, "store"), fan=1_000)
    store.left = 100
    store.create().add_documents(docs(spark, "1"), "text", 0)
    for k in range(2):
        store.add_predictions(answers(spark, ("1", "A", str(k)), ("2", "A", "?")), k)
    store.left, store.fan = writes, 2
    batch = answers(spark, ("1", "A", "new"), ("3", "A", "?"))
    with pytest.raises(OSError):
        store.add_predictions(batch, 2)
    # With two writes the batch is committed and the merge of its parts fails.
    done = writes >= 2
    again = DocumentStore(spark, store.path, fan=2)
    assert rows(again.latest(), "prediction") == [("new" if done else "1",)]
    assert again.rejected().count() == 2 + done
    again.add_predictions(batch, 2)
    again.add_predictions(answers(spark, ("1", "B", "b")), 3)
    assert rows(again.latest(), "type", "prediction") == [("A", "new"), ("B", "b")] and again.rejected().count() == 3


def test_empty_batches_and_null_ids(spark, store):
    store.add_documents(docs(spark).limit(0), "text", 0)
    store.add_predictions(answers(spark, (None, None, None)), 0)
    store.add_predictions(spark.createDataFrame([], UPDATE), 1)
    assert store.documents().count() == store.latest().count() == 0 and store.rejected().count() == 1
    assert store.find("x").count() == 0


def test_a_part_of_a_folder_appears_once(spark):
    channel = message_folder(work_folder(spark, "channel"))
    sent = envelope.request_messages(spark.createDataFrame([("1", "a")], "id string, text string"))
    for _ in range(2):
        channel.write_batch(sent, "run=0/batch_id=0")
    assert [json.loads(r.value) for r in channel.read_batch(spark).collect()] == [{"id": "1", "text": "a"}]
    # What a failed write left is not read.
    sent.write.text(f"{channel.path}/_written/left")
    assert channel.read_batch(spark).count() == 1
