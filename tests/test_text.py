import hashlib
import json

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from textflow.functions import envelope, ids
from textflow.functions import text as X
from textflow.functions.stop_words import ENGLISH


def one(spark, text, expression):
    row = spark.createDataFrame([(text,)], "text string").select(expression(F.col("text")).alias("x"))
    return row.first()["x"]


@pytest.mark.parametrize(
    ("text", "count"),
    [("", 1), ("   ", 0), (" a b", 3), ("  Hi  the\tWorld  ", 4), ("a", 1), ("a ", 1), ("a\n b", 2), (None, None)],
)
def test_total_words(spark, text, count):
    assert one(spark, text, X.total_words) == count


@pytest.mark.parametrize(
    ("text", "tokens"),
    [
        ("  Hi  the\tWorld  ", ["", "", "hi", "", "the", "world"]),
        ("", [""]),
        ("   ", []),
        (None, None),
    ],
)
def test_tokens(spark, text, tokens):
    frame = spark.createDataFrame([(text,)], "text string")
    assert X.tokenize(frame).first()["tokens"] == tokens


def test_stop_words_by_case_and_list(spark):
    frame = spark.createDataFrame([(["The", "the", "cat", "Cat"],), (None,)], "tokens array<string>")
    kept = [row.filtered for row in X.remove_stop_words(frame).collect()]
    assert kept == [["cat", "Cat"], None]
    by_case = X.remove_stop_words(frame, stop_words=["the", "cat"], case_sensitive=True)
    assert by_case.first()["filtered"] == ["The", "Cat"]
    assert X.remove_stop_words(frame, language="french").first()["filtered"] == ["The", "the", "cat", "Cat"]


def test_english_list_is_sparks(spark):
    assert list(ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")


@pytest.mark.parametrize("text", ["a b", " a\xa0b　c d\x1ee\x85 f g ", "", "\t", "a​b", "x᠎y"])
def test_words_are_those_of_str_split(spark, text):
    assert one(spark, text, X.words) == text.split()


def test_word_counts_keep_first_occurrence_order(spark):
    found = one(spark, 'b "a" b é \\ b "a"', lambda text: X.word_counts(X.words(text)))
    assert json.loads(found) == [{"b": 3}, {'"a"': 2}, {"é": 1}, {"\\": 1}]
    assert one(spark, "", lambda text: X.word_counts(X.words(text))) == "[]"
    assert one(spark, None, lambda text: X.word_counts(X.words(text))) is None


def test_lexicon_terms(spark):
    assert one(spark, "(Good), :) it's A. 'TIS", X.lexicon_terms) == ["good", ":)", "it's", "a.", "tis"]


@pytest.mark.parametrize("count", [0, 1, 2, 3, 7, 8, 9, 1000])
def test_running_sums(spark, count):
    numbers = [(i * 7919) % 13 for i in range(count)]
    row = spark.createDataFrame([(numbers,)], "n array<int>").select(X.running_sums(F.col("n")).alias("s")).first()
    assert row.s == [sum(numbers[: i + 1]) for i in range(count)]


def test_pieces_join_to_the_text(spark):
    text = " Ein Haus,\n\tn°5… 12ab\x0b ½ "
    assert "".join(one(spark, text, X.class_pieces)) == text
    assert one(spark, text, X.class_tokens) == ["Ein", "Haus", ",", "n", "°", "5", "…", "12", "ab", "½"]


@pytest.mark.parametrize(
    ("text", "answer"),
    [('{"a":1}', True), ("[1,2]", True), (" [1]", True), ("12", False), ('"x"', False), ("bad", False),
     ("{bad", False), ("", False), (None, False)],
)
def test_is_json(spark, text, answer):
    assert one(spark, text, envelope.is_json) is answer


@pytest.mark.parametrize("text", ['say "hi"', "a\\b\nc", "", "é ", "\x1f\x0b \\u001F \\\\\x1f"])
def test_quoted_text_is_its_json(spark, text):
    assert json.loads(one(spark, text, envelope.json_quoted)) == text


def test_ids(spark):
    for text in ("I love it", 'a "b"\n', "é\x1f\x0b \\u001F \\\\\x1f\\"):
        body = json.dumps({"text": text}, ensure_ascii=False, separators=(",", ":"))
        assert one(spark, text, ids.json_id) == hashlib.sha256(body.encode()).hexdigest()
        assert one(spark, text, ids.text_id) == hashlib.sha256(text.encode()).hexdigest()
    assert one(spark, None, ids.json_id) is None


def test_body_id(spark):
    rows = spark.createDataFrame(
        [("en", "a \x1f \\u001F\"", 3), (None, "b", None), ("en", None, 7), (None, None, None)], "lang string, text string, n int"
    )
    found = [r[0] for r in rows.select(ids.body_id(text=F.col("text"), lang=F.col("lang"), n=F.col("n"))).collect()]
    bodies = [{"text": "a \x1f \\u001F\"", "lang": "en", "n": 3}, {"text": "b"}, {"lang": "en", "n": 7}]
    expected = [hashlib.sha256(json.dumps(b, separators=(",", ":")).encode()).hexdigest() for b in bodies]
    assert found == [*expected, None]


def test_parse(spark):
    values = ["bad", '{"id":"2"}', '{"id":"4","text":"t","type":"s"}', '{"id":3,"text":{"x":1}}', None]
    messages = spark.createDataFrame([(v.encode() if v else None,) for v in values], "value binary")
    parsed = envelope.parse(messages, envelope.REQUEST).collect()
    assert [tuple(row) for row in parsed] == [
        (None, None), ("2", None), ("4", "t"), ("3", '{"x":1}'), (None, None),
    ]
    assert [tuple(row) for row in envelope.requests_from(messages).collect()] == [("4", "t"), ("3", '{"x":1}')]


def test_conform_matches_by_name(spark):
    rows = spark.createDataFrame([(1, "p", "t", "x", 0)], "id int, prediction string, type string, text string, more int")
    assert tuple(envelope.conform(rows).first()) == ("1", "t", "x", "p")
