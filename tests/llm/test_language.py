"""What the language network learns from: whole texts, every language, different texts, in a stated number."""

from __future__ import annotations

from collections import Counter

from textflow.llm import language


def test_places_lie_anywhere_in_a_text(spark):
    """The words that tell the languages apart begin after sign 40,000, behind what all texts share."""
    shared = "same words for all of them " * 1500
    rows = [(name, f"{shared} {i} " + own * 1500) for name, own in (("a", "zyx wvu "), ("b", "klm nop ")) for i in range(8)]
    pieces, labels = language.sample(spark.createDataFrame(rows, "lang string, text string"))
    assert Counter(labels) == {"a": 8 * language.PLACES, "b": 8 * language.PLACES}
    assert sum(b"zyx" in p or b"klm" in p for p in pieces) > 0.1 * len(pieces)
    network = language.fit(pieces, labels, steps=150)
    late = spark.createDataFrame([(0, "zyx wvu " * 40), (1, "klm nop " * 40)], "i long, text string")
    assert [r.lang_pred for r in language.identify(late, network).orderBy("i").collect()] == ["a", "b"]


def test_every_language_is_learned_and_rows_are_bounded(spark):
    rows = [(f"l{i:03d}", f"text {j} of {i}") for i in range(130) for j in range(1 + i % 5)]
    rows += [("l000", f"further text {j}") for j in range(900)] + [("l001", "copied text")] * 900
    rows += [(None, "text"), ("l002", None), ("l003", "12 34"), ("only digits", "12")]
    documents = spark.createDataFrame(rows, "lang string, text string")
    _, labels = language.sample(documents)
    chosen = {name: n // language.PLACES for name, n in Counter(labels).items()}
    assert set(chosen) == {f"l{i:03d}" for i in range(130)}
    assert chosen["l000"] == 40_000 // 130 and chosen["l001"] == 3 and chosen["l129"] == 5
    few = Counter(language.sample(documents, rows_of_each=2)[1])
    assert max(few.values()) == 2 * language.PLACES and len(few) == 130
    least = Counter(language.sample(documents, most_rows=7)[1])
    assert set(least.values()) == {language.PLACES} and len(least) == 130


def test_choice_does_not_depend_on_partitions(spark):
    rows = [(f"l{i % 3}", f"some text number {i}") for i in range(3000)]
    documents = spark.createDataFrame(rows, "lang string, text string")
    assert language.sample(documents.repartition(7), rows_of_each=20) == language.sample(documents.repartition(2), rows_of_each=20)
