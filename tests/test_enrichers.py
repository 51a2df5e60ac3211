"""Enrichers against plain Python on small texts, each by the inline lookup and by the join."""

import json
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.ml import Pipeline
from pyspark.ml.feature import Tokenizer

from textflow.operators.enricher import RowEnricher, all_predictions, side_by_side
from textflow.operators.entities import EntityLinks, EntityNames, LinkedEntities
from textflow.operators.model import ModelEnricher
from textflow.operators.sentiment import Sentiment
from textflow.operators.tags import TokenTags
from textflow.operators.words import TotalWords, WordCount, stop_word_table

BOTH = pytest.mark.parametrize("limits", [{}, {"way": "join"}], ids=["inline", "joined"])
VOCABULARY = ["New", "York", "new", "City", "of", "the", ",", "Times", "é1", "x"]
PHRASES = ["New York", "York City", "New York City", "Times", "the", "York City of", "é1", "x x", "of the New"]


def texts(seed, count=60):
    choose = random.Random(seed)
    blanks = [" ", "  ", "\n", "\t "]
    return [
        choose.choice(["", " "]) + "".join(choose.choice(VOCABULARY) + choose.choice(blanks) for _ in range(choose.randrange(25)))
        for _ in range(count)
    ]


def tokens_with_spans(text):
    """Letters, digits, other signs; enough for the vocabulary above."""
    return [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+|\d+|[^\w\s]+", text)]


def mentions(text, phrases=PHRASES):
    tokens = tokens_with_spans(text)
    spelled = {" ".join(t for t, _, _ in tokens_with_spans(p)): p for p in phrases}
    hits = []
    for i in range(len(tokens)):
        for n in range(1, len(tokens) - i + 1):
            name = " ".join(t for t, _, _ in tokens[i : i + n])
            if name in spelled:
                hits.append((i, n, name))
    kept = [
        h for h in hits
        if not any(o[1] > h[1] and o[0] <= h[0] and o[0] + o[1] >= h[0] + h[1] for o in hits)
    ]
    return [(name, tokens[i][1], tokens[i + n - 1][2]) for i, n, name in kept]


def answers(enricher, frame):
    return {row["id"]: row["prediction"] for row in enricher.predictions(frame).collect()}


@BOTH
def test_names(spark, requests, limits):
    given = texts(1)
    gazetteer = spark.createDataFrame([(p, "B") for p in PHRASES] + [("Times", "A")], "phrase string, label string")
    frame = requests(*[(str(i), t) for i, t in enumerate(given)], ("none", None))
    found = answers(EntityNames(gazetteer, **limits), frame)
    assert found.pop("none") is None
    for i, text in enumerate(given):
        expected = []
        for name, _, _ in mentions(text):
            expected += [(name, label) for label in (["A", "B"] if name == "Times" else ["B"])]
        assert [(e["name"], e["label"]) for e in json.loads(found[str(i)])] == expected


@BOTH
def test_links(spark, requests, limits):
    given = texts(2)
    rows = [(p, i, f"E{i}", "place", 1.0) for i, p in enumerate(PHRASES)] + [("Times", 99, "E99", "paper", 3.0)]
    entities = spark.createDataFrame(
        rows, "phrase string, entity_id int, entity_name string, entity_type string, prior double"
    )
    frame = requests(*[(str(i), t) for i, t in enumerate(given)], ("none", None))
    linker = EntityLinks(entities, **limits)
    found = answers(linker, frame)
    assert found.pop("none") is None
    for i, text in enumerate(given):
        expected = []
        for name, start, end in mentions(text):
            ids = [j for j, p in enumerate(PHRASES) if " ".join(t for t, _, _ in tokens_with_spans(p)) == name]
            expected += [(start, end, text[start:end], j) for j in ids + ([99] if name == "Times" else [])]
        links = json.loads(found[str(i)])
        assert [(x["start"], x["end"], x["mention"], x["entity_id"]) for x in links] == expected
        assert all(x["rho"] == (3.0 if x["entity_id"] == 99 else 1.0) for x in links)
        assert {x["confidence"] for x in links if x["mention"] == "Times"} <= {0.25, 0.75}
    annotations = linker.annotations(frame)
    assert answers(LinkedEntities(annotations), frame.filter("text is not null")) == found
    only = answers(LinkedEntities(annotations, keep_unannotated=False), frame)
    assert only == {k: v for k, v in found.items() if v != "[]"}


@BOTH
def test_sentiment(spark, requests, limits):
    lexicon = spark.createDataFrame([("good", 0.1), ("nice", 0.2), ("bad", -0.3)], "term string, valence double")
    frame = requests(
        ("a", "Good!"), ("b", "good (nice) bad"), ("c", "bad"), ("d", ""), ("e", None), ("f", "nothing"), ("a2", "Good!"),
    )
    found = answers(Sentiment(lexicon, **limits), frame)
    assert found == {
        "a": "positive", "b": "negative", "c": "negative", "d": "negative", "e": "NOT APPLYABLE", "f": "negative",
        "a2": "positive",
    }


@BOTH
def test_copies_of_a_request_have_the_same_answer(spark, requests, limits):
    lexicon = spark.createDataFrame([("good", 1), ("bad", -1)], "term string, valence int")
    stop = spark.createDataFrame([("the",)], "word string")
    frame = requests(*[("a", "good bad good the")] * 5, ("b", "bad"))
    moods = Sentiment(lexicon, **limits).predictions(frame).collect()
    assert [row.prediction for row in moods if row.id == "a"] == ["positive"] * 5
    counted = WordCount(stop_words=stop_word_table(stop, **limits)).predictions(frame).collect()
    assert [row.prediction for row in counted if row.id == "a"] == ['[{"good":2},{"bad":1}]'] * 5


@BOTH
def test_stop_words_match_by_case(spark, requests, limits):
    stop = spark.createDataFrame([("the",), ("a",)], "word string")
    frame = requests(("1", "The the a cat The"), ("2", "the"), ("3", None))
    found = answers(WordCount(stop_words=stop_word_table(stop, **limits)), frame)
    assert found == {"1": '[{"The":2},{"cat":1}]', "2": "[]", "3": None}


@BOTH
def test_tags(spark, requests, limits):
    lexicon = spark.createDataFrame([("the", "DET", "DT"), (".", "PUNCT", ".")], "word string, pos string, tag string")
    tagger = TokenTags(lexicon, **limits)
    frame = requests(("1", "the cat."), ("2", ""), ("3", None))
    found = answers(tagger, frame)
    assert json.loads(found["1"]) == {
        "key1": {"text": "the", "pos": "DET", "tag": "DT"},
        "key2": {"text": "cat", "pos": "X", "tag": "X"},
        "key3": {"text": ".", "pos": "PUNCT", "tag": "."},
    }
    assert found["2"] == "{}"
    assert found["3"] is None
    assert [(r.position, r.key) for r in tagger.tokens(frame).orderBy("position").collect()] == [
        (1, "key1"), (2, "key2"), (3, "key3"),
    ]


def test_word_count_leaves_standard_stop_words_out(spark, requests):
    frame = requests(("1", "the cat und The cat"))
    assert answers(WordCount(), frame) == {"1": '[{"cat":2},{"und":1},{"The":1}]'}
    assert answers(WordCount(language="german"), frame) == {"1": '[{"the":1},{"cat":2},{"The":1}]'}
    assert answers(WordCount(stop_words=()), frame) == {"1": '[{"the":1},{"cat":2},{"und":1},{"The":1}]'}
    assert answers(WordCount(stop_words=["cat"]), frame) == {"1": '[{"the":1},{"und":1},{"The":1}]'}


def test_null_text_fails_no_enricher(spark, requests):
    frame = requests(("1", None))
    assert answers(TotalWords(), frame) == {"1": None}
    assert answers(WordCount(), frame) == {"1": None}
    model = Pipeline(stages=[Tokenizer(inputCol="text", outputCol="tokens")]).fit(requests(("1", "a")))
    enricher = ModelEnricher(model, "tokens", "Tokens")
    assert answers(enricher, requests(("1", None), ("2", "A b"))) == {"1": None, "2": '["a","b"]'}
    assert enricher.enrich(frame).columns == ["id", "text", "prediction"]


class Opened(RowEnricher):
    def open(self):
        return {"calls": 0}

    def predict(self, id, text, model):
        model["calls"] += 1
        return None if text is None else f"{model['calls']}:{text.upper()}"


def test_row_function_opens_once_per_task(spark, requests):
    frame = requests(("1", "a"), ("2", None), ("3", "c")).coalesce(1)
    assert answers(Opened("Upper"), frame) == {"1": "1:A", "2": None, "3": "3:C"}


def test_several_enrichers_in_one_scan(spark, requests):
    frame = requests(("1", "a b"))
    enrichers = [TotalWords("n"), WordCount("w", stop_words=()), Opened("u")]
    assert side_by_side(frame, enrichers).first().asDict() == {
        "id": "1", "text": "a b", "n": "2", "w": '[{"a":1},{"b":1}]', "u": "1:A B",
    }
    rows = {(r.id, r.type, r.text, r.prediction) for r in all_predictions(frame, enrichers).collect()}
    assert rows == {("1", "n", "a b", "2"), ("1", "w", "a b", '[{"a":1},{"b":1}]'), ("1", "u", "a b", "1:A B")}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_small_lookups_need_no_shuffle(spark, requests):
    frame = requests(("1", "a"))
    lexicon = spark.createDataFrame([("good", 1)], "term string, valence int")
    gazetteer = spark.createDataFrame([("New York", "place")], "phrase string, label string")
    for enricher in (Sentiment(lexicon), EntityNames(gazetteer), WordCount(), TotalWords()):
        assert enricher.row_local
        text = plan(enricher.predictions(frame))
        assert "Exchange" not in text and "Join" not in text and "Aggregate" not in text
    assert not Sentiment(lexicon, way="join").row_local
    with pytest.raises(ValueError, match="way='join'"):
        Sentiment(lexicon, max_bytes=1).enrich(frame)


def test_ids_that_repeat_or_are_null_do_not_mix_texts(spark, requests):
    """Both ways answer each row by its own text, whatever its id."""
    given = requests(("1", "New York of"), ("1", "the x x Times"), (None, "la New York"), (None, "of of the"), ("2", None), ("1", "New York of"))
    stop = spark.createDataFrame([("of",), ("the",)], "word string")
    lexicon = spark.createDataFrame([("the", 1.0), ("of", -1.0)], "term string, valence double")
    gazetteer = spark.createDataFrame([(p, "B") for p in PHRASES], "phrase string, label string")
    entities = spark.createDataFrame(
        [("New York", 1, "NY", "city", 0.5), ("x x", 2, "X", "sign", 0.0)],
        "phrase string, entity_id int, entity_name string, entity_type string, prior double",
    )
    tags = spark.createDataFrame([("the", "DET", "DT"), ("of", "ADP", "IN")], "word string, pos string, tag string")
    made = [
        lambda limits: Sentiment(lexicon, **limits),
        lambda limits: WordCount(stop_words=stop_word_table(stop, **limits)),
        lambda limits: EntityNames(gazetteer, **limits),
        lambda limits: EntityLinks(entities, **limits),
        lambda limits: TokenTags(tags, **limits),
    ]
    order = lambda row: tuple(str(x) for x in row)
    for make in made:
        inline, joined = (
            sorted((tuple(r) for r in make(limits).predictions(given).select("id", "text", "prediction").collect()), key=order)
            for limits in ({}, {"way": "join"})
        )
        assert inline == joined and len(inline) == 6


def test_a_large_table_in_the_row_is_an_error(spark, requests):
    lexicon = spark.createDataFrame([(f"w{i}", 1.0) for i in range(30)], "term string, valence double")
    with pytest.raises(ValueError, match="way='join'"):
        Sentiment(lexicon, max_rows=29).enrich(requests(("1", "w1"))).collect()
    with pytest.raises(ValueError):
        Sentiment(lexicon, way="other")
    assert Sentiment(lexicon, max_rows=30).predictions(requests(("1", "w1"))).first().prediction == "positive"


@BOTH
def test_small_valences_are_not_rounded(spark, requests, limits):
    lexicon = spark.createDataFrame([("good", 4e-7), ("nice", 4e-7), ("bad", -7.9e-7)], "term string, valence double")
    rows = Sentiment(lexicon, **limits).predictions(requests(("1", "good nice"), ("2", "bad good"), ("3", "bad good nice"))).collect()
    assert {r.id: r.prediction for r in rows} == {"1": "positive", "2": "negative", "3": "positive"}


def test_only_rare_keys_of_the_table_are_moved(spark, monkeypatch):
    """Half of all tokens are one word and most others are in no table: a row is moved for each text and rare key."""
    from textflow.functions import lookup

    table = spark.createDataFrame([("the", 1)] + [(f"k{i}", i) for i in range(3000)], "word string, v int")
    texts = [f"the {'the ' * (i % 40)}unknown{i} other{i} k{i} k{i}" for i in range(2000)]
    rows = spark.createDataFrame([(t,) for t in texts] * 2, "text string")
    moved = []
    rare = lookup.LookupTable._rare
    monkeypatch.setattr(lookup.LookupTable, "_rare", lambda self, *given: moved.append(rare(self, *given)) or moved[-1])
    large = lookup.LookupTable(table, "word", ["v"], way="join")
    words = F.split("text", " ")
    placed = F.transform(words, lambda w, i: F.struct(i.alias("i"), F.lit(1).alias("n"), w.alias("key")))
    found = large.join(rows, placed, "hits").collect()
    assert len(found) == 2 * len(texts)
    for row in found:
        expected = [(i, w) for i, w in enumerate(row.text.split(" ")) if w == "the" or w.startswith("k")]
        assert [(h.i, h.key) for h in row.hits] == expected
        assert all(h.found[0].v == (1 if h.key == "the" else int(h.key[1:])) for h in row.hits)
    asked = moved[0]
    assert asked.filter("key = 'the'").count() == 0
    assert asked.filter("key like 'unknown%' or key like 'other%'").count() < 0.05 * 2 * len(texts)


def test_only_runs_with_a_known_head_and_length_are_made(spark, requests):
    gazetteer = spark.createDataFrame([("Ann Lee", "person"), ("Bob", "person"), ("New York City Hall", "place")], "phrase string, label string")
    table = EntityNames(gazetteer, way="join").table
    rows = requests(("1", "Ann met Bob in New York City Hall and " + "nobody " * 500)).withColumn("tokens", F.split("text", " "))
    keys = [r.key for r in rows.select(F.inline(table._grams(F.col("tokens")))).collect()]
    assert {"Ann met", "Bob", "New York City Hall"} <= set(keys) and len(keys) <= 6


def test_a_key_is_moved_once_for_each_chunk(spark, monkeypatch):
    """Texts share their keys: what is moved grows with the keys of a chunk, not with those of each text."""
    from textflow.functions import lookup

    keys, texts = 2000, 400
    table = spark.createDataFrame([(f"k{i}", i) for i in range(keys)], "word string, v int")
    rows = spark.createDataFrame([(" ".join(f"k{(t * 7 + j * 11) % keys}" for j in range(200)),) for t in range(texts)], "text string")
    moved = []
    rare = lookup.LookupTable._rare
    monkeypatch.setattr(lookup.LookupTable, "_rare", lambda self, *given: moved.append(rare(self, *given)) or moved[-1])
    placed = F.transform(F.split("text", " "), lambda w, i: F.struct(i.alias("i"), F.lit(1).alias("n"), w.alias("key")))
    found = lookup.LookupTable(table, "word", ["v"], way="join").join(rows, placed, "hits").collect()
    assert len(found) == texts and all([f"k{h.found[0].v}" for h in row.hits] == row.text.split(" ") for row in found)
    assert moved[0].count() <= int(spark.conf.get("spark.sql.shuffle.partitions")) * keys


ODD_TEXTS = [
    "", " ", None, "a1b2  c\x0bd\x1ce", "日本語テスト、123４５６ Ⅻ ½ 𝒳𝟘 😀😀áb", "\x00\x01\"\\/\x7f \x85", "don't “q” – ñ",
    "".join(map(chr, range(0x3000))), "".join(chr(i) + " " for i in range(0xE000, 0x30000, 5)),
]


def test_arrays_are_cut_as_spark_cuts_texts(spark, monkeypatch):
    from textflow.functions import arrays, text

    rows = spark.createDataFrame([(t,) for t in ODD_TEXTS + texts(7)], "text string")
    expected = [r.tokens for r in rows.select("text", text.class_tokens(F.col("text")).alias("tokens")).collect()]
    given = pa.array([r.text for r in rows.collect()], pa.string())
    cutter = arrays.Cutter(arrays.char_kinds(spark))
    monkeypatch.setattr(arrays, "SLICE_BYTES", 200)
    found = []
    for part in arrays.slices(given):
        cut = cutter(part)
        words = cut.words.to_pylist()
        found += [[words[c] for c in cut.codes[a:b]] for a, b in zip(cut.before[:-1], cut.before[1:])]
    assert found == [tokens or [] for tokens in expected]
    assert cutter.spelled(given).to_pylist() == [" ".join(tokens or []) for tokens in expected]


def test_bytes_that_are_no_text_are_cut_as_signs(spark):
    from textflow.functions import arrays

    broken = pa.array([b"a\xffb", b"c d"]).view(pa.string())
    assert arrays.Cutter(arrays.char_kinds(spark)).spelled(broken).to_pylist() == ["a � b", "c d"]


def test_names_with_odd_signs_and_several_labels_are_the_same_both_ways(spark, monkeypatch):
    from textflow.functions import arrays

    monkeypatch.setattr(arrays, "SLICE_BYTES", 60)
    phrases = [("a \"b", "x"), ("\\", "y\"z\\\n"), ("\x1b\x08", None), ("Times", "b\"c"), ("Times", "b#c"), ("Times", None), ("  Times ", "a"), ("é1", "é\t"), (None, "n"), (" ", "n")]
    phrases += [(p, "B") for p in PHRASES + ["York City of the New"]]
    gazetteer = spark.createDataFrame(phrases * 2, "phrase string, label string")
    given = [*texts(5), *ODD_TEXTS[:7], "a \"b \\ \x1b\x08 Times", "New York City of the New York"]
    frame = spark.createDataFrame([(str(i % 9) if i % 4 else None, t) for i, t in enumerate(given * 2)], "id string, text string")
    for wrapper in (None, "Na\"mes\x1f"):
        inline, joined = (
            sorted((str(r.id), str(r.text), str(r.prediction)) for r in EntityNames(gazetteer, wrapper=wrapper, **limits).predictions(frame).collect())
            for limits in ({}, {"way": "join"})
        )
        assert inline == joined and len(joined) == 2 * len(given)


def test_joined_names_read_the_gazetteer_once_and_make_no_row_for_a_run(spark, requests):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    given = spark.createDataFrame([(f"name of {i}", "x") for i in range(50)], "phrase string, label string")
    named = EntityNames(given.mapInArrow(counted, given.schema), way="join")
    frame = requests(*[(str(t), " ".join(f"name of {(t + j) % 60}" for j in range(30))) for t in range(20)])
    rows = named.predictions(frame)
    assert "Generate" not in plan(rows)
    found = {r.id: [e["name"] for e in json.loads(r.prediction)] for r in rows.collect()}
    assert found == {str(t): [f"name of {(t + j) % 60}" for j in range(30) if (t + j) % 60 < 50] for t in range(20)}
    assert read.value == 50
