import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textflow.config import Options, Topics
from textflow.operators.enricher import Enricher
from textflow.operators.store import DocumentStore
from textflow.operators.tags import TokenTags
from textflow.operators.words import TotalWords, WordCount
from textflow.session import work_folder
from textflow.sources import channels
from textflow.sources.channels import message_folder
from textflow.streaming import queries as streams

ONCE = {"availableNow": True}


@pytest.fixture
def place(spark):
    return work_folder(spark, "streams")


def write(spark, path, *values):
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").text(path)


def values(channel, spark):
    return sorted(row.value for row in channel.read_batch(spark).select("value").collect())


def test_dispatch_drops_incomplete_and_restarts_without_copies(spark, place):
    source, target = message_folder(f"{place}/in"), message_folder(f"{place}/out")
    write(spark, f"{place}/in", '{"id":"1","text":"a","type":"s"}', "bad", '{"id":"2"}')
    for expected in (['{"id":"1","text":"a"}'], ['{"id":"1","text":"a"}', '{"id":"3","text":"c"}']):
        for _ in range(2):
            streams.start_dispatch(source.read_stream(spark), target, f"{place}/check", ONCE).awaitTermination()
            assert values(target, spark) == expected
        write(spark, f"{place}/in", '{"id":"3","text":"c"}')


@pytest.mark.parametrize("start", [streams.start_enricher, streams.start_row_enricher])
def test_enricher_over_several_batches(spark, place, start):
    source = message_folder(f"{place}/in", maxFilesPerTrigger="1")
    target = message_folder(f"{place}/out")
    for i in range(3):
        write(spark, f"{place}/in", f'{{"id":"{i}","text":"w w v{i}"}}')
    write(spark, f"{place}/in", '{"id":"9"}')
    for _ in range(2):
        start(source.read_stream(spark), WordCount(), target, f"{place}/check", ONCE).awaitTermination()
        found = values(target, spark)
        assert found[:3] == [
            f'{{"id":"{i}","type":"WordCount","text":"w w v{i}","prediction":"[{{\\"w\\":2}},{{\\"v{i}\\":1}}]"}}'
            for i in range(3)
        ]
        assert found[3:] == ['{"id":"9","type":"WordCount"}']


class Batchwise(Enricher):
    """Predicts the number of requests of the batch."""

    def enrich(self, requests):
        return requests.crossJoin(requests.agg(F.count("*").cast("string").alias("prediction")))


def test_batchwise_enricher(spark, place):
    source, target = message_folder(f"{place}/in"), message_folder(f"{place}/out")
    write(spark, f"{place}/in", '{"id":"1","text":"a"}', '{"id":"2","text":"b"}')
    with pytest.raises(ValueError):
        streams.start_row_enricher(source.read_stream(spark), Batchwise("n"), target, f"{place}/c1", ONCE)
    streams.start_enricher(source.read_stream(spark), Batchwise("n"), target, f"{place}/c2", ONCE).awaitTermination()
    assert values(target, spark) == [
        '{"id":"1","type":"n","text":"a","prediction":"2"}', '{"id":"2","type":"n","text":"b","prediction":"2"}',
    ]


def test_whole_flow(spark, place):
    """Intake, dispatch, two enrichers and merge, each fed by the messages of the one before."""
    store = DocumentStore(spark, f"{place}/store").create()
    requests, to_enrich, enriched = (message_folder(f"{place}/{n}") for n in ("requests", "to_enrich", "enriched"))
    api = spark.createDataFrame(
        [("s", "one two", 1), ("w", "one two", 2), ("w", "three", 3)], "type string, text string, at int"
    )
    api.coalesce(1).write.parquet(f"{place}/api")
    intake = spark.readStream.schema(api.schema).parquet(f"{place}/api")
    streams.start_intake(intake, store, requests, f"{place}/check/intake", "at", trigger=ONCE).awaitTermination()
    streams.start_dispatch(
        requests.read_stream(spark), to_enrich, f"{place}/check/dispatch", ONCE
    ).awaitTermination()
    for enricher in (TotalWords(), WordCount()):
        streams.start_enricher(
            to_enrich.read_stream(spark), enricher, enriched, f"{place}/check/{enricher.label}", ONCE
        ).awaitTermination()
    streams.start_merge(enriched.read_stream(spark), store, f"{place}/check/merge", ONCE).awaitTermination()
    found = {row.text: (row.type, row.predictions) for row in store.stored().collect()}
    assert found == {
        "one two": ("s", {"TotalWords": "2", "WordCount": '[{"one":1},{"two":1}]'}),
        "three": ("w", {"TotalWords": "1", "WordCount": '[{"three":1}]'}),
    }
    assert store.rejected().count() == 0


def test_last_message_of_a_folder_wins(spark, place):
    store = DocumentStore(spark, f"{place}/store").create()
    store.add_documents(spark.createDataFrame([("1", "a", None), ("2", "b", None)], "id string, text string, type string"), "id", 0)
    source = message_folder(f"{place}/in")
    message = lambda id, answer: f'{{"id":"{id}","type":"n","prediction":"{answer}"}}'
    write(spark, f"{place}/in", message(1, 9), message(1, 10), message(2, 9), message(2, 8))
    write(spark, f"{place}/in", message(2, 7), message(2, 11))
    with pytest.raises(ValueError):
        streams.start_merge(source.read_stream(spark).select("value"), store, f"{place}/c", ONCE)
    streams.start_merge(source.read_stream(spark), store, f"{place}/check", ONCE).awaitTermination()
    assert {r.id: r.prediction for r in store.latest().collect()} == {"1": "10", "2": "11"}


def test_bodies_of_complete_predictions(spark, place):
    source, target = message_folder(f"{place}/in"), message_folder(f"{place}/out")
    write(spark, f"{place}/in", '{"id":"1","type":"n","prediction":"[1]"}', '{"id":"2"}', "bad", '{"id":"a\\"b","type":"t","prediction":"x"}')
    streams.start_bodies(source.read_stream(spark), target, f"{place}/check", ONCE).awaitTermination()
    assert values(target, spark) == ['{"id":"1","doc":{"predictions":{"n":[1]}}}', '{"id":"a\\"b","doc":{"predictions":{"t":"x"}}}']


PRINTS = """
import sys
from textflow.operators.tags import TokenTags
from textflow.session import local_session
from textflow.sources.channels import message_folder, show_batch
from textflow.streaming import queries as streams
spark = local_session(1)
lexicon = spark.createDataFrame([("hello", "INTJ", "UH")], "word string, pos string, tag string")
messages = message_folder(sys.argv[1] + "/in").read_stream(spark)
streams.wait(streams.start_tag_view(messages, TokenTags(lexicon), sys.argv[1] + "/check", {"availableNow": True}))
show_batch(spark.createDataFrame([("a row of a table",)], "text string"))
"""


def test_views_print(spark, place):
    """In a process of its own, as the console is the one of the JVM."""
    write(spark, f"{place}/in", "hello")
    root = str(Path(__file__).resolve().parents[1])
    path = place.removeprefix("file:")
    done = subprocess.run([sys.executable, "-c", PRINTS, path], capture_output=True, text=True, cwd=root, timeout=300)
    assert done.returncode == 0, done.stderr
    assert "Batch: 0" in done.stdout and "|hello|" in done.stdout and "|a row of a table|" in done.stdout


def test_tag_view_goes_whole_to_a_channel(spark, place):
    source, view = message_folder(f"{place}/in"), message_folder(f"{place}/view")
    lexicon = spark.createDataFrame([("hello", "INTJ", "UH")], "word string, pos string, tag string")
    expected = []
    for i in range(30):
        write(spark, f"{place}/in", "hello " * i)
        tagged = {f"key{k + 1}": {"text": "hello", "pos": "INTJ", "tag": "UH"} for k in range(i)}
        expected.append(("hello " * i, tagged))
    for _ in range(2):
        streams.wait(streams.start_tag_view(source.read_stream(spark), TokenTags(lexicon), f"{place}/check", ONCE, view))
        shown = [json.loads(value) for value in values(view, spark)]
        assert sorted(m["text"] for m in shown) == sorted(text for text, _ in expected)
        assert {m["text"]: json.loads(m["prediction"]) for m in shown} == dict(expected)
    with pytest.raises(ValueError, match="checkpoint"):
        streams.start_tag_view(source.read_stream(spark), TokenTags(lexicon), view=view)


def test_tokens_for_some_types(spark, place):
    source, target = message_folder(f"{place}/in"), message_folder(f"{place}/out")
    write(spark, f"{place}/in", '{"id":"1","text":"The cat","type":"a"}', '{"id":"2","text":"The cat","type":"b"}',
          '{"id":"3","text":"The cat"}', '{"id":"4","type":"a"}', "bad", '{"id":"5","text":"","type":"a"}')
    streams.wait(streams.start_dispatch(source.read_stream(spark), target, f"{place}/check", ONCE, ("a", "c")))
    assert values(target, spark) == [
        '{"id":"1","text":"The cat","type":"a","tokens":["the","cat"],"filtered":["cat"]}',
        '{"id":"2","text":"The cat","type":"b"}',
        '{"id":"3","text":"The cat"}',
        '{"id":"5","text":"","type":"a","tokens":[""],"filtered":[""]}',
    ]
    messages = spark.createDataFrame([('{"id":"1","text":"x","type":"a"}',)], "value string")
    assert streams.preprocess(messages, ()).first().tokens is None


def test_preprocess_with_tokens(spark):
    messages = spark.createDataFrame([('{"id":"1","text":"The cat is Here"}',)], "value string")
    row = streams.preprocess(messages, tokens=True).first()
    assert row.tokens == ["the", "cat", "is", "here"] and row.filtered == ["cat"]


def test_kafka_options():
    options = Options("b1:9092,b2:9092", "/store", Topics("in", "mid", "out"))
    found = channels.topics(options)
    assert found["requests"].format == "kafka"
    assert found["requests"].read_options == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "in", "startingOffsets": "latest",
    }
    assert found["enriched"].write_options == {"kafka.bootstrap.servers": "b1:9092,b2:9092", "topic": "out"}


def test_wait_stops_all_legs_when_one_fails(spark, place):
    source, target = message_folder(f"{place}/in"), message_folder(f"{place}/out")
    write(spark, f"{place}/in", '{"id":"1","text":"a"}')

    class Failing(Enricher):
        def enrich(self, requests):
            raise ValueError("no model")

    going = streams.start_dispatch(source.read_stream(spark), target, f"{place}/c1")
    assert streams.wait(going, seconds=0.5) is False
    failing = streams.start_enricher(source.read_stream(spark), Failing("f"), target, f"{place}/c2", ONCE)
    with pytest.raises(Exception, match="no model"):
        streams.wait(going, failing)
    assert not going.isActive
    again = streams.start_dispatch(source.read_stream(spark), target, f"{place}/c1", ONCE)
    assert streams.wait(again) is True and values(target, spark) == ['{"id":"1","text":"a"}']


def _documents(spark, folder: str, files: int) -> str:
    rows = spark.range(60).selectExpr("id doc_id", "concat('word ', id, ' and more') text", "'en' lang", "'s' source", "20L n_chars")
    rows.repartition(files).write.parquet(f"{folder}/documents.parquet")
    rows.selectExpr("doc_id", "1 quality", "0 toxic").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_messages_of_many_tasks_come_in_many_files(spark, tmp_path, monkeypatch):
    """Neither leg's messages go through one task, nor through a fixed number of tasks."""
    from textflow.plans import queries

    folder = _documents(spark, f"{tmp_path}/tables", 4)
    for name, part, least in (("stream_two_legs", "part=1", 2), ("stream_merge_batches", "part=1", 10)):
        monkeypatch.setattr(queries, "work_folder", lambda _, purpose, name=name: f"{tmp_path}/{name}")
        assert queries.QUERIES[name](spark, folder).count() == 60
        files = list((tmp_path / name / "enriched" / part).glob("part-*"))
        assert len(files) >= least
        assert all(file.name.endswith(".gz") for file in files)
