import json

import pytest
from pyspark.sql import functions as F

from textflow.operators import compare, intake, merge, views
from textflow.operators.enricher import all_predictions
from textflow.operators.entities import EntityNames
from textflow.operators.store import DocumentStore
from textflow.operators.tags import TokenTags
from textflow.operators.words import TotalWords, WordCount
from textflow.session import work_folder


@pytest.fixture
def store(spark):
    return DocumentStore(spark, work_folder(spark, "store")).create()


def calls(spark, *rows):
    return intake.with_id(spark.createDataFrame(list(rows), "type string, text string, at int"))


def updates(spark, *rows):
    return spark.createDataFrame(
        list(rows), "id string, type string, prediction string, ts timestamp, seq long"
    )


def rows(frame, *columns):
    return sorted(tuple(row) for row in frame.select(*columns).collect())


def test_created_tables_are_empty_with_their_schemas(store):
    assert store.documents().columns == ["id", "text", "type", "run", "batch_id"]
    assert store.documents().count() == store.predictions().count() == store.rejected().count() == 0


def test_first_type_of_a_text_wins(spark, store):
    first = calls(spark, ("b", "x", 2), ("a", "x", 1), (None, "y", 3))
    assert rows(store.add_documents(first, "at", 0).fillna("-"), "type", "text") == [("-", "y"), ("a", "x")]
    assert rows(store.add_documents(calls(spark, ("c", "x", 1), ("c", "z", 2)), "at", 1), "text") == [("z",)]
    assert rows(store.documents(), "text") == [("x",), ("y",), ("z",)]


def test_repeated_batch_keeps_its_documents(spark, store):
    batch = calls(spark, ("a", "x", 1))
    store.add_documents(batch, "at", 0)
    assert rows(store.add_documents(batch, "at", 0), "text") == [("x",)]
    assert store.documents().count() == 1
    assert store.add_documents(batch, "at", 1).count() == 0


def test_answers(spark):
    requests = calls(spark, ("a", "x", 1), ("b", "x", 2), ("a", "y", 3), ("a", "old", 4))
    stored = intake.with_id(spark.createDataFrame([("old",)], "text string"))
    assert rows(intake.answers(requests, stored, "at"), "at", "resp") == [
        (1, "inserted"), (2, "exists"), (3, "inserted"), (4, "exists"),
    ]


def test_last_prediction_wins_and_other_types_stay(spark, store):
    store.add_documents(spark.createDataFrame([("1", "t", "s")], "id string, text string, type string"), "text", 0)
    store.add_predictions(updates(spark, ("1", "A", "old", None, 1), ("1", "B", "b", None, 1)), 0)
    batch = updates(spark, ("1", "A", "new", None, 8), ("1", "A", "older", None, 7), ("9", "A", "?", None, 1), (None, None, "?", None, 2))
    store.add_predictions(batch, 1)
    store.add_predictions(batch, 1)
    assert store.stored().first()["predictions"] == {"A": "new", "B": "b"}
    assert rows(store.rejected().fillna("-"), "id", "updates", "reason") == [
        ("-", 1, merge.UNKNOWN_ID), ("9", 1, merge.UNKNOWN_ID),
    ]
    assert rows(store.enriched(["B", "A", "C"]), "A", "B", "C") == [("new", "b", None)]
    assert store.documents_with("B").count() == 1
    assert store.documents_with("C").count() == 0


def test_compacted_store_goes_on(spark, store):
    store.add_documents(spark.createDataFrame([("1", "t", "s")], "id string, text string, type string"), "text", 0)
    store.add_predictions(updates(spark, ("1", "A", "a0", None, 5), ("1", "B", "b0", None, 5)), 0)
    store.add_predictions(updates(spark, ("1", "A", "a1", None, 1), ("2", "A", "x", None, 1)), 1)
    compact = store.compact_into(work_folder(spark, "store"))
    assert compact.predictions().count() == 2
    assert compact.rejected().count() == 1
    assert compact.stored().first()["predictions"] == store.stored().first()["predictions"] == {"A": "a1", "B": "b0"}
    compact.add_predictions(updates(spark, ("1", "B", "b2", None, 0)), 2)
    assert compact.stored().first()["predictions"] == {"A": "a1", "B": "b2"}


def test_intake_and_merge_go_on_after_compaction(spark, store):
    """Their batch ids differ; no later batch may hide or overwrite what was compacted."""
    doc = lambda *ids: spark.createDataFrame([(i, i, "s") for i in ids], "id string, text string, type string")
    store.add_documents(doc("x", "y"), "text", 0)
    for batch in range(3):
        store.add_predictions(updates(spark, (("x", "y", "y")[batch], f"T{batch}", "p", None, 1)), batch)
    compact = store.compact_into(work_folder(spark, "store"))
    assert compact.add_documents(doc("x", "w"), "text", 1).count() == 1
    assert compact.add_documents(doc("x", "w"), "text", 1).count() == 1
    compact.add_documents(doc("v"), "text", 2)
    compact.add_predictions(updates(spark, ("y", "T2", "again", None, 1)), 2)
    assert rows(compact.documents(), "id") == [("v",), ("w",), ("x",), ("y",)]
    assert rows(compact.latest(), "id", "type", "prediction") == [
        ("x", "T0", "p"), ("y", "T1", "p"), ("y", "T2", "again"),
    ]


def test_create_keeps_what_is_stored(spark, store):
    store.add_documents(spark.createDataFrame([("1", "t", "s")], "id string, text string, type string"), "text", 0)
    compact = store.compact_into(work_folder(spark, "store"))
    assert compact.create().documents().count() == store.create().documents().count() == 1


def test_requests_without_id_are_not_stored(spark, store):
    for batch in range(3):
        store.add_documents(calls(spark, ("a", None, 1), ("a", "x", 2)), "at", batch)
    assert rows(store.documents(), "text") == [("x",)]


def test_new_run_does_not_overwrite(spark, store):
    store.add_documents(spark.createDataFrame([("1", "t", "s")], "id string, text string, type string"), "text", 0)
    store.add_predictions(updates(spark, ("1", "A", "a0", None, 1)), 0)
    again = DocumentStore(spark, store.path, run="1")
    again.add_predictions(updates(spark, ("1", "A", "a1", None, 1)), 0)
    assert store.predictions().count() == 2
    assert store.stored().first()["predictions"] == {"A": "a1"}


def test_update_bodies(spark):
    given = spark.createDataFrame([("A", '{"x":[1]}'), ('B"', 'say "hi"\n'), ("C", "12")], "type string, p string")
    bodies = given.select(merge.update_body(F.col("type"), F.col("p")).alias("b")).collect()
    assert [json.loads(row.b) for row in bodies] == [
        {"predictions": {"A": {"x": [1]}}}, {"predictions": {'B"': 'say "hi"\n'}}, {"predictions": {"C": "12"}},
    ]


def test_typed_predictions(spark):
    link = '[{"start":0,"end":4,"mention":"Orre","entity_id":1,"entity_name":"O","entity_type":"p","rho":0.5,"confidence":1.0}]'
    stored = spark.createDataFrame(
        [("1", {"OpenNER": '[{"name":"a","label":"person"}]', "gero": link})], "id string, predictions map<string,string>"
    )
    row = views.typed(stored).first()
    assert [tuple(x) for x in row["OpenNER"]] == [("a", "person")]
    assert tuple(row["gero"][0]) == (0, 4, "Orre", 1, "O", "p", 0.5, 1.0)
    assert row["SpacyNER"] is None


def test_enrichers_declare_the_form_of_what_they_predict(spark, requests):
    gazetteer = spark.createDataFrame([("Orre", "person")], "phrase string, label string")
    lexicon = spark.createDataFrame([("a", "DET", "DT")], "word string, pos string, tag string")
    enrichers = [EntityNames(gazetteer, wrapper="names"), TokenTags(lexicon), WordCount(stop_words=()), TotalWords()]
    rows = requests(("1", "a Orre a"), ("2", None))
    stored = views.with_predictions(rows, merge.latest(all_predictions(rows, enrichers), F.lit(0)))
    found = {r.id: r for r in views.typed(stored, views.forms(enrichers)).collect()}
    assert set(views.forms(enrichers)) == {"OpenNER", "Tags", "WordCount"}
    assert [tuple(x) for x in found["1"].OpenNER.names] == [("Orre", "person")]
    assert found["1"].WordCount == [{"a": 2}, {"Orre": 1}]
    assert found["1"].Tags["key1"].pos == "DET" and found["1"].Tags["key2"].tag == "X"
    assert found["2"].Tags is None


def test_agreement_counts_documents_with_both(spark):
    wide = spark.createDataFrame([("1", "x", "x"), ("2", "x", "y"), ("3", None, "y")], "id string, A string, B string")
    assert rows(compare.agreement(wide, ["A", "B"]), "type_a", "type_b", "documents", "agreeing") == [("A", "B", 2, 1)]


def test_hot_ids_are_reduced_before_the_shuffle(spark):
    """A third of all requests and updates belongs to one id; each task sends one row of it."""
    requests = calls(spark, *[("t", "hot" if i % 3 == 0 else f"x{i}", i) for i in range(300)]).repartition(4)
    firsts = intake.first_of_each_id(requests, "at")
    assert firsts.count() == 201
    assert rows(firsts.filter("text = 'hot'"), "type", "text") == [("t", "hot")]
    given = updates(spark, *[("hot" if i % 3 == 0 else str(i), "A", str(i), None, i) for i in range(300)])
    last = merge.latest(given, F.col("seq"))
    assert rows(last.filter("id = 'hot'"), "prediction", "updates") == [("297", 100)]
    for frame in (firsts, last):
        below = frame._jdf.queryExecution().executedPlan().toString().split("ENSURE_REQUIREMENTS")[1]
        assert "partial_" in below


def test_body_without_outer_field(spark):
    given = spark.createDataFrame([("A", "x")], "type string, p string")
    body = given.select(merge.update_body(F.col("type"), F.col("p"), under=None).alias("b")).first().b
    assert json.loads(body) == {"A": "x"}


def test_a_prediction_is_moved_once(spark):
    """The payload of an update is in the rows that are reduced a single time, and rows of equal order have one winner."""
    given = spark.createDataFrame([("a", "T", "x", 1), ("a", "T", "y", 1), ("a", "T", None, 1)], "id string, type string, prediction string, seq int")
    last = merge.latest(given, F.col("seq"), "seq")
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan
    assert rows(last, "id", "type", "prediction", "seq", "updates") == [("a", "T", "y", 1, 3)]


def test_stored_maps_and_lists_are_made_rows_from_one_computing(spark):
    given = spark.createDataFrame([("a", '{"k":"v"}', '["x",null]'), ("b", None, "[]"), (None, "{}", None)], "id string, m string, l string")
    typed = given.select("id", F.from_json("m", "map<string,string>").alias("m"), F.from_json("l", "array<string>").alias("l"))
    found = views.exploded(typed.select("id", "m"), "m", "key", "value")
    assert rows(found, "id", "key", "value") == [("a", "k", "v")]
    places = views.exploded(typed.select("id", "l"), "l", "place", "value")
    assert rows(places.fillna("-"), "id", "place", "value") == [("a", 0, "x"), ("a", 1, "-")]
    for frame in (found, places):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_texts_that_are_stored_do_not_move(spark, store, monkeypatch):
    """A batch with few new ids and long stored texts, some ids twice, some null: the same rows in either way."""
    moved = []
    first_of_each_id = intake.first_of_each_id
    monkeypatch.setattr(intake, "first_of_each_id", lambda rows, order: moved.append(rows.count()) or first_of_each_id(rows, order))
    old = [("a", f"old {i}", i) for i in range(20)]
    store.add_documents(calls(spark, *old), "at", 0)
    batch = calls(spark, *old, ("b", "new", 31), ("a", "new", 30), ("a", None, 33))
    assert rows(store.add_documents(batch, "at", 1), "text", "type") == [("new", "a")]
    assert moved == [20, 2]
    monkeypatch.setattr("textflow.operators.store.SENT_IDS", 0)
    more = calls(spark, *old, ("b", "newer", 41), ("a", "newer", 40))
    assert rows(store.add_documents(more, "at", 2), "text", "type") == [("newer", "a")]
    assert store.documents().count() == 22
