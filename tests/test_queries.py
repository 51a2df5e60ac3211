import pytest
from oracle import connect, differences

from textflow.plans.oracle import SQL
from textflow.plans.queries import QUERIES
from textflow.sources.tables import INPUT_TASKS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    frame = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert differences(frame, connection, SQL[name]) == []
    else:
        assert frame.count() > 0


def test_all_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_word_count_moves_no_row(spark):
    plan = QUERIES["word_count"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_inputs_are_dealt_out_when_asked_for(spark):
    spark.conf.set(INPUT_TASKS, "5")
    try:
        plan = QUERIES["word_count"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(INPUT_TASKS)
    assert "Exchange hashpartitioning(id" in plan


def test_classifier_gives_an_answer_for_each_document(spark):
    answers = QUERIES["fitted_model_quality"](spark, FOLDER)
    assert answers.count() == 200
    assert {row.prediction for row in answers.select("prediction").distinct().collect()} <= {"0.0", "1.0"}


def test_typed_tags_moves_texts_and_parses_their_tags_once(spark, tmp_path):
    """Ids that come twice, are null or have no text; the tags, many times their texts, stay in the task that makes them."""
    given = [(1, "In a a"), (1, "in"), (2, None), (None, "in"), (3, "")]
    spark.createDataFrame(given, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["typed_tags"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert plan.count("from_json") == 1 and not any("type#" in line for line in moved)
    # Both rows of the id have its last predictions, which are those of the greater text: each type for itself.
    rows = sorted((r.id, r.words, r.key, r.text) for r in found.collect())
    assert rows == 2 * [("1", 1, "key1", "in")] or len(rows) == 6 and {r[2:] for r in rows} == {("key1", "In"), ("key2", "a"), ("key3", "a")}
