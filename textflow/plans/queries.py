"""Named queries: each reads whole tables of a folder and returns a DataFrame."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

import numpy as np
from pyspark.errors import StreamingQueryException
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, CountVectorizer, StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.functions import arrays, envelope, ids
from textflow.functions import text as X
from textflow.functions.lookup import chunks_of
from textflow.operators import compare, intake, merge, views
from textflow.operators.enricher import ColumnEnricher, Enricher, RowEnricher, all_predictions, side_by_side
from textflow.operators.entities import EntityLinks, EntityNames, LinkedEntities, annotated_passages
from textflow.operators.model import ModelEnricher
from textflow.operators.sentiment import NEGATIVE, POSITIVE, Sentiment
from textflow.operators.store import DocumentStore
from textflow.operators.tags import TokenTags
from textflow.operators.words import TotalWords, WordCount, stop_word_table
from textflow.plans import lookups
from textflow.schemas import TAGGED_TOKENS, TYPED_REQUEST
from textflow.session import work_folder
from textflow.sources.channels import message_folder
from textflow.sources.models import load_model, save_model
from textflow.sources.requests import api_requests, chat_requests
from textflow.sources.tables import read_table, spread
from textflow.streaming import queries as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ONCE = {"availableNow": True}
# Documents that a word of a fitted vocabulary is in; words of a vocabulary, which a model holds as a whole.
LEAST_DOCUMENTS, MOST_WORDS = 5, 1 << 22
# Files of a part of messages, at least.
LEAST_FILES = 20
# The way for tables of any size.
LARGE = {"way": "join"}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as requests `id, text`."""
    rows = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    return spread(rows, "id")


def document_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("id"))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that `labels` covers, as requests `id, text`."""
    covered = table(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return documents(spark, folder).join(covered, "id", "left_semi")


def calls(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as API calls `type, text` with their order of arrival."""
    rows = table(spark, folder, "documents").select(F.col("lang").alias("type"), "text", "doc_id")
    return api_requests(spread(rows, "doc_id"), "doc_id")


def stored_ids(spark: SparkSession, folder: str) -> DataFrame:
    """A store that holds the labelled documents."""
    return labelled(spark, folder).select(ids.text_id(F.col("text")).alias("id")).distinct()


# Intake


@query
def request_ids_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents")
    return rows.select("doc_id", ids.text_id(F.col("text")).alias("id"))


@query
def request_ids_json(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents")
    return rows.select("doc_id", ids.json_id(F.col("text")).alias("id"))


@query
def request_ids_body(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of requests whose body has more fields than the text; some lack one."""
    rows = table(spark, folder, "documents")
    source = F.when(F.col("doc_id") % 3 != 0, F.col("source"))
    return rows.select("doc_id", ids.body_id(lang=F.col("lang"), text=F.col("text"), source=source, size=F.col("n_chars")).alias("id"))


@query
def message_filter(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    commands = turns.withColumn("text", F.concat(F.lit("/"), "text"))
    empty = turns.withColumn("text", F.lit(None).cast("string"))
    return chat_requests(turns.union(commands).union(empty), "conv_id", "turn")


@query
def intake_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    return intake.first_of_each_id(intake.with_id(calls(spark, folder)), "doc_id")


@query
def intake_accepted(spark: SparkSession, folder: str) -> DataFrame:
    requests = intake.with_id(calls(spark, folder))
    return intake.accepted(requests, stored_ids(spark, folder), "doc_id")


@query
def intake_status(spark: SparkSession, folder: str) -> DataFrame:
    requests = intake.with_id(calls(spark, folder)).select("doc_id", "id")
    return intake.answers(requests, stored_ids(spark, folder), "doc_id")


@query
def intake_already_stored(spark: SparkSession, folder: str) -> DataFrame:
    requests = intake.with_id(calls(spark, folder)).select("doc_id", "id")
    return intake.already_stored(requests, stored_ids(spark, folder))


# Envelopes


@query
def envelope_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    sent = envelope.request_messages(documents(spark, folder))
    return envelope.parse(sent, envelope.REQUEST)


@query
def prediction_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    sent = envelope.prediction_messages(TotalWords().predictions(documents(spark, folder)))
    return envelope.conform(envelope.predictions_from(sent))


@query
def preprocess(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as messages; texts of Spanish ones missing, and each text malformed a second time."""
    columns = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    rows = spread(columns, "doc_id")
    given = F.when(F.col("lang") != "es", F.col("text"))
    whole = F.to_json(F.struct(F.col("doc_id").alias("id"), given.alias("text"), "source"))
    messages = rows.select(F.encode(whole, "utf-8").alias("value")).union(
        rows.select(F.encode(F.concat(F.lit("{"), "text"), "utf-8").alias("value"))
    )
    return streams.preprocess(messages)


@query
def preprocess_with_tokens(spark: SparkSession, folder: str) -> DataFrame:
    messages = envelope.request_messages(documents(spark, folder))
    prepared = streams.preprocess(messages, tokens=True)
    return prepared.select("id", F.to_json("filtered").alias("filtered"))


# Text functions


@query
def tokens(spark: SparkSession, folder: str) -> DataFrame:
    split = X.tokenize(documents(spark, folder))
    return split.select("id", F.to_json("tokens").alias("tokens"))


@query
def tokens_no_stop(spark: SparkSession, folder: str) -> DataFrame:
    kept = X.remove_stop_words(X.tokenize(documents(spark, folder)))
    return kept.select("id", F.to_json("filtered").alias("filtered"))


@query
def token_count(spark: SparkSession, folder: str) -> DataFrame:
    split = X.tokenize(documents(spark, folder))
    return split.select("id", X.token_count(F.col("tokens")).cast("bigint").alias("n"))


@query
def class_tokens(spark: SparkSession, folder: str) -> DataFrame:
    found = X.class_tokens(F.col("text"))
    return documents(spark, folder).select("id", F.to_json(found).alias("tokens"))


@query
def json_check(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions that are JSON lists, and texts that are not."""
    rows = WordCount(stop_words=()).predictions(documents(spark, folder))
    checked = rows.select(
        "id",
        envelope.is_json(F.col("prediction")).alias("list"),
        envelope.is_json(F.col("text")).alias("plain"),
        envelope.is_json(envelope.json_quoted(F.col("text"))).alias("quoted"),
    )
    return checked.select("id", *[F.col(c).cast("int").alias(c) for c in ("list", "plain", "quoted")])


# Enrichers


@query
def total_words(spark: SparkSession, folder: str) -> DataFrame:
    return TotalWords().predictions(documents(spark, folder))


@query
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    stop = [word for (word,) in lookups.STOP_WORDS.rows]
    return WordCount(stop_words=stop).predictions(documents(spark, folder))


@query
def word_count_english(spark: SparkSession, folder: str) -> DataFrame:
    """Word counts without the standard English stop words."""
    return WordCount().predictions(documents(spark, folder))


@query
def word_count_all_words(spark: SparkSession, folder: str) -> DataFrame:
    return WordCount(stop_words=()).predictions(documents(spark, folder))


@query
def word_count_stop_table(spark: SparkSession, folder: str) -> DataFrame:
    stop = stop_word_table(lookups.STOP_WORDS.frame(spark))
    return WordCount(stop_words=stop).predictions(documents(spark, folder))


@query
def word_count_large_stop_table(spark: SparkSession, folder: str) -> DataFrame:
    stop = stop_word_table(lookups.STOP_WORDS.frame(spark), **LARGE)
    return WordCount(stop_words=stop).predictions(documents(spark, folder))


@query
def sentiment(spark: SparkSession, folder: str) -> DataFrame:
    return Sentiment(lookups.LEXICON.frame(spark)).predictions(documents(spark, folder))


@query
def sentiment_large_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    enricher = Sentiment(lookups.LEXICON.frame(spark), **LARGE)
    return enricher.predictions(documents(spark, folder))


@query
def entity_names(spark: SparkSession, folder: str) -> DataFrame:
    return EntityNames(lookups.GAZETTEER.frame(spark)).predictions(documents(spark, folder))


@query
def entity_names_wrapped(spark: SparkSession, folder: str) -> DataFrame:
    enricher = EntityNames(lookups.GAZETTEER.frame(spark), wrapper="OpenNER")
    return enricher.predictions(documents(spark, folder))


@query
def entity_names_large_gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    enricher = EntityNames(lookups.GAZETTEER.frame(spark), **LARGE)
    return enricher.predictions(documents(spark, folder))


@query
def entity_links(spark: SparkSession, folder: str) -> DataFrame:
    return EntityLinks(lookups.ENTITIES.frame(spark)).predictions(documents(spark, folder))


@query
def entity_links_large_table(spark: SparkSession, folder: str) -> DataFrame:
    enricher = EntityLinks(lookups.ENTITIES.frame(spark), **LARGE)
    return enricher.predictions(documents(spark, folder))


@query
def entity_annotations(spark: SparkSession, folder: str) -> DataFrame:
    linker = EntityLinks(lookups.ENTITIES.frame(spark))
    return linker.annotations(documents(spark, folder))


def ready_annotations(spark: SparkSession, folder: str) -> DataFrame:
    return entity_annotations(spark, folder)


@query
def entity_links_ready(spark: SparkSession, folder: str) -> DataFrame:
    given = ready_annotations(spark, folder)
    return LinkedEntities(given).predictions(documents(spark, folder))


@query
def annotated_only(spark: SparkSession, folder: str) -> DataFrame:
    passages = envelope.to_passages(documents(spark, folder))
    joined = annotated_passages(ready_annotations(spark, folder), passages, keep_unannotated=False)
    return envelope.from_passages(joined, "prediction")


@query
def token_tags(spark: SparkSession, folder: str) -> DataFrame:
    rows = TokenTags(lookups.TAGS.frame(spark)).tokens(documents(spark, folder))
    return rows.withColumn("position", F.col("position").cast("bigint"))


@query
def token_tags_large_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    rows = TokenTags(lookups.TAGS.frame(spark), **LARGE).tokens(documents(spark, folder))
    return rows.withColumn("position", F.col("position").cast("bigint"))


@query
def token_tags_json(spark: SparkSession, folder: str) -> DataFrame:
    return TokenTags(lookups.TAGS.frame(spark)).predictions(documents(spark, folder))


# Lookup tables made from all documents, too large for the row


def document_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select(F.explode(X.class_tokens(F.col("text"))).alias("token"))


def document_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    terms = document_tokens(spark, folder).select(F.lower("token").alias("term")).distinct()
    return terms.withColumn("valence", (F.length("term") % 7 - 3) / 10)


@query
def sentiment_document_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    return Sentiment(document_lexicon(spark, folder), **LARGE).predictions(documents(spark, folder))


@query
def word_count_document_stop_words(spark: SparkSession, folder: str) -> DataFrame:
    """Word counts without the words of the documents whose length is even."""
    words = documents(spark, folder).select(F.explode(X.words(F.col("text"))).alias("word")).distinct()
    stop = stop_word_table(words.filter(F.length("word") % 2 == 0), **LARGE)
    return WordCount(stop_words=stop).predictions(documents(spark, folder))


@query
def token_tags_document_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    words = document_tokens(spark, folder).select(F.col("token").alias("word")).distinct().filter(F.length("word") % 4 != 0)
    size = F.length("word").cast("string")
    lexicon = words.withColumns({"pos": F.concat(F.lit("P"), size), "tag": F.concat(F.lit("T"), size)})
    rows = TokenTags(lexicon, **LARGE).tokens(documents(spark, folder))
    return rows.withColumn("position", F.col("position").cast("bigint"))


@query
def entity_names_document_gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """Every fifth token of a document, with the one behind it, is a name."""

    def every_fifth(cut: arrays.Cut) -> np.ndarray:
        places = np.arange(len(cut.codes))
        inside = places - np.repeat(cut.before[:-1], np.diff(cut.before))
        return places[(inside % 5 == 4) & (places + 1 < cut.ends)]

    pairs = arrays.distinct_runs(arrays.char_kinds(spark), 2, every_fifth, "phrase")
    gazetteer = documents(spark, folder).select("text").mapInArrow(pairs, "phrase string").distinct()
    named = EntityNames(gazetteer.withColumn("label", F.lit("pair")), **LARGE)
    return named.predictions(documents(spark, folder))


class LongestLine(RowEnricher):
    """A custom predictor: characters of the longest line."""

    def predict(self, id: str, text: str | None, model: object) -> str | None:
        return None if text is None else str(max(len(line) for line in text.split("\n")))


@query
def custom_predictor(spark: SparkSession, folder: str) -> DataFrame:
    return LongestLine("LongestLine").predictions(documents(spark, folder))


@query
def fitted_model_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """A fitted model, saved and loaded again, whose output is a list."""
    stages = [
        Tokenizer(inputCol="text", outputCol="tokens"),
        StopWordsRemover(inputCol="tokens", outputCol="filtered"),
    ]
    rows = documents(spark, folder)
    path = work_folder(spark, "model")
    save_model(Pipeline(stages=stages).fit(rows), path)
    return ModelEnricher(load_model(path), "filtered", "Tokens").predictions(rows)


def quality_model(known: DataFrame) -> str:
    """Naive Bayes over the words of at least `LEAST_DOCUMENTS` of the given texts `text, label`, weighted by their inverse
    document frequency; fitted once, saved, and loaded by its path."""
    stages = [
        Tokenizer(inputCol="text", outputCol="tokens"),
        CountVectorizer(inputCol="tokens", outputCol="counts", minDF=float(LEAST_DOCUMENTS), vocabSize=MOST_WORDS),
        IDF(inputCol="counts", outputCol="features"),
        NaiveBayes(smoothing=1.0, predictionCol="quality"),
    ]
    path = work_folder(known.sparkSession, "model")
    save_model(Pipeline(stages=stages).fit(known), path)
    return path


def known_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled documents `id, text, label`."""
    labels = table(spark, folder, "labels").filter("quality is not null")
    known = labels.select(F.col("doc_id").cast("string").alias("id"), F.col("quality").alias("label"))
    return documents(spark, folder).filter("text is not null").join(known, "id")


@query
def fitted_model_quality(spark: SparkSession, folder: str) -> DataFrame:
    """A model fitted once on all labelled documents, applied to all documents."""
    path = quality_model(known_quality(spark, folder))
    return ModelEnricher(load_model(path), "quality", "Quality").predictions(documents(spark, folder))


@query
def fitted_model_held_out(spark: SparkSession, folder: str) -> DataFrame:
    """How many labels a model gets right that learned from four of five labelled documents: of these and of the rest,
    next to the number that the more frequent label would get right."""
    known = known_quality(spark, folder)
    held_out = F.col("id").cast("long") % 5 == 0
    path = quality_model(known.filter(~held_out))
    answered = ModelEnricher(load_model(path), "quality", "Quality").enrich(known)
    right = F.sum((F.col("prediction").cast("double") == F.col("label")).cast("bigint"))
    ones = F.sum(F.col("label").cast("bigint"))
    grouped = answered.groupBy(held_out.alias("held_out")).agg(F.count("*").alias("documents"), right.alias("correct"), ones.alias("ones"))
    return grouped.select("held_out", "documents", "correct", F.greatest("ones", F.col("documents") - F.col("ones")).alias("majority"))


@query
def side_by_side_enrichers(spark: SparkSession, folder: str) -> DataFrame:
    """One column per enricher from one scan."""
    enrichers = [
        Sentiment(lookups.LEXICON.frame(spark)),
        WordCount(stop_words=()),
        EntityNames(lookups.GAZETTEER.frame(spark)),
    ]
    return side_by_side(documents(spark, folder), enrichers)


# Merge into the store


def updates(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions with their order: all documents, the labelled ones again, and unknown ids."""
    rows = documents(spark, folder)
    sentiment_of = Sentiment(lookups.LEXICON.frame(spark))
    total = TotalWords("Words")
    tokens_only = ColumnEnricher("Words", lambda text: F.size(X.class_tokens(text)).cast("string"))
    turns = table(spark, folder, "conversations")
    strangers = turns.select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("id"), "text", "turn")
    answered = total.predictions(strangers, "turn").withColumnRenamed("turn", "seq")
    parts = [
        (all_predictions(rows, [total, sentiment_of]), 1),
        (tokens_only.predictions(labelled(spark, folder)), 2),
    ]
    merged = [p.withColumn("seq", F.lit(seq).cast("bigint")) for p, seq in parts] + [answered]
    result = merged[0]
    for part in merged[1:]:
        result = result.unionByName(part)
    return result.select("id", "type", "prediction", "seq")


@query
def merged_predictions(spark: SparkSession, folder: str) -> DataFrame:
    last = merge.latest(updates(spark, folder), F.col("seq"))
    known = merge.of_known_documents(last, document_ids(spark, folder))
    return merge.folded(known).select("id", F.to_json("predictions").alias("predictions"))


@query
def merged_increment(spark: SparkSession, folder: str) -> DataFrame:
    """Stored maps of the first updates, with the maps of later updates put over them."""
    given = updates(spark, folder)
    stored, update = (
        merge.folded(merge.latest(part, F.col("seq")))
        for part in (given.filter("seq <= 1"), given.filter("seq > 1"))
    )
    old, new = stored.withColumnRenamed("predictions", "old"), update.withColumnRenamed("predictions", "new")
    joined = old.join(new, "id", "full")
    both = F.coalesce(merge.merged_maps(F.col("old"), F.col("new")), "old", "new")
    merged = F.map_from_entries(F.sort_array(F.map_entries(both)))
    return joined.select("id", F.to_json(merged).alias("predictions"))


@query
def rejected_updates(spark: SparkSession, folder: str) -> DataFrame:
    last = merge.latest(updates(spark, folder), F.col("seq"))
    return merge.of_unknown_documents(last, document_ids(spark, folder))


@query
def prediction_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies of JSON predictions, of short texts, and of whole texts with all their signs."""
    enrichers = [
        WordCount(stop_words=()),
        Sentiment(lookups.LEXICON.frame(spark)),
        ColumnEnricher('Echo "text"', lambda text: text),
    ]
    rows = all_predictions(documents(spark, folder), enrichers)
    body = merge.update_body(F.col("type"), F.col("prediction"))
    return rows.select("id", "type", body.alias("body"))


@query
def enriched_view(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder)
    return views.enriched(rows, updates(spark, folder), ["Sentiment", "Words"], F.col("seq"))


@query
def documents_with_type(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents have one more prediction; the documents with it."""
    echo = ColumnEnricher("Lines", lambda text: F.size(F.split(text, "\n")).cast("string"))
    found = TotalWords("Words").predictions(documents(spark, folder)).unionByName(
        echo.predictions(labelled(spark, folder))
    )
    last = merge.latest(found, F.lit(0))
    stored = views.documents_with(views.with_predictions(documents(spark, folder), last), "Lines")
    return stored.select("id", "text", F.to_json("predictions").alias("predictions"))


@query
def parent_child(spark: SparkSession, folder: str) -> DataFrame:
    last = merge.latest(updates(spark, folder), F.col("seq"))
    return views.children(documents(spark, folder), last)


@query
def typed_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Stored name lists in their declared form, one row per name."""
    rows = documents(spark, folder)
    found = EntityNames(lookups.GAZETTEER.frame(spark)).predictions(rows)
    stored = views.with_predictions(rows, merge.latest(found, F.lit(0)))
    names = views.exploded(views.typed(stored).select("id", "OpenNER"), "OpenNER", "place", "entity")
    return names.select("id", F.col("place").cast("bigint").alias("place"), "entity.name", "entity.label")


@query
def typed_links(spark: SparkSession, folder: str) -> DataFrame:
    """Stored entity links in the form that their enricher declares, one row per link."""
    rows = documents(spark, folder)
    linker = EntityLinks(lookups.ENTITIES.frame(spark))
    stored = views.with_predictions(rows, merge.latest(linker.predictions(rows), F.lit(0)))
    typed = views.typed(stored, views.forms([linker]))
    links = views.exploded(typed.select(F.col("id").alias("passage_id"), linker.label), linker.label, "place", "link")
    return links.select("passage_id", "link.*")


@query
def typed_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Stored tags in their declared form, one row per tagged token, next to the number of stored word counts."""
    rows = documents(spark, folder)
    enrichers = [TokenTags(lookups.TAGS.frame(spark)), WordCount(stop_words=())]
    # The tags of a text are many times its size, so texts are what is moved, and their tags stay where they are made.
    together = rows.repartition(chunks_of(rows), "id")
    last = merge.latest(all_predictions(together, enrichers), F.lit(0))
    stored = views.documents_with(views.with_predictions(rows, last), "Tags")
    typed = views.typed(stored, views.forms(enrichers[:1]))
    # Counted as they are stored, and before tags become rows: after that each row would carry its text's word counts.
    words = F.json_array_length(F.element_at("predictions", "WordCount")).cast("bigint")
    counted = typed.select("id", words.alias("words"), "Tags")
    found = views.exploded(counted, "Tags", "key", "token")
    return found.select("id", "words", "key", "token.*")


# Comparison


def rivals(spark: SparkSession) -> list[Enricher]:
    return [
        Sentiment(lookups.LEXICON.frame(spark), "First"),
        Sentiment(lookups.OTHER_LEXICON.frame(spark), "Second"),
        ColumnEnricher("Even", lambda text: _answer(F.length(text) % 2 == 0)),
    ]


def _answer(positive: Column) -> Column:
    return F.when(positive, POSITIVE).otherwise(NEGATIVE)


@query
def agreement(spark: SparkSession, folder: str) -> DataFrame:
    enrichers = rivals(spark)
    answers = side_by_side(documents(spark, folder), enrichers)
    return compare.agreement(answers, [e.label for e in enrichers])


@query
def agreement_of_predictions(spark: SparkSession, folder: str) -> DataFrame:
    enrichers = rivals(spark)
    types = [e.label for e in enrichers]
    predictions = all_predictions(documents(spark, folder), enrichers)
    return compare.agreement(views.wide(predictions, types), types)


@query
def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    known = labels.select(
        F.col("doc_id").cast("string").alias("id"), _answer(F.col("quality") == 1).alias("label")
    )
    return compare.accuracy(all_predictions(documents(spark, folder), rivals(spark)), known)


# Streams: run until all input is taken, then what they wrote is read


def document_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as a file stream. A pattern serves for one file and for a folder of files."""
    files = table(spark, folder, "documents")
    rows = spark.readStream.schema(files.schema).parquet(f"{folder}/documents.parque[t]")
    return spread(rows, "doc_id")


def message_stream(spark: SparkSession, folder: str) -> DataFrame:
    rows = document_stream(spark, folder).select(F.col("doc_id").cast("string").alias("id"), "text")
    return envelope.request_messages(rows)


@query
def stream_intake(spark: SparkSession, folder: str) -> DataFrame:
    place = work_folder(spark, "intake")
    store = DocumentStore(spark, f"{place}/store").create()
    forward = message_folder(f"{place}/requests")
    rows = document_stream(spark, folder).select(F.col("lang").alias("type"), "text", "doc_id")
    streams.start_intake(
        rows, store, forward, f"{place}/checkpoint", "doc_id", trigger=ONCE
    ).awaitTermination()
    sent = envelope.requests_from(forward.read_batch(spark))
    return sent.join(store.documents().select("id", "type"), "id")


@query
def stream_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    place = work_folder(spark, "dispatch")
    to_enrich = message_folder(f"{place}/messages")
    streams.start_dispatch(
        message_stream(spark, folder), to_enrich, f"{place}/checkpoint", ONCE
    ).awaitTermination()
    return envelope.requests_from(to_enrich.read_batch(spark))


@query
def stream_dispatch_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Requests on to the enrichers with their tokens, from one folder of messages to another."""
    place = work_folder(spark, "dispatch")
    requests, to_enrich = message_folder(f"{place}/requests"), message_folder(f"{place}/messages")
    requests.write_batch(envelope.request_messages(documents(spark, folder)), "run=0")
    streams.start_dispatch(
        requests.read_stream(spark), to_enrich, f"{place}/checkpoint", ONCE, tokens=True
    ).awaitTermination()
    declared = T.StructType().add("id", T.StringType()).add("filtered", T.ArrayType(T.StringType()))
    sent = envelope.parse(to_enrich.read_batch(spark), declared)
    return sent.select("id", F.to_json("filtered").alias("filtered"))


@query
def stream_dispatch_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """API calls through the intake and on to the enrichers: tokens for requests of two of the types only."""
    place = work_folder(spark, "dispatch")
    store = DocumentStore(spark, f"{place}/store").create()
    requests, to_enrich = message_folder(f"{place}/requests"), message_folder(f"{place}/messages")
    calls = document_stream(spark, folder).select(F.col("lang").alias("type"), "text", "doc_id")
    streams.wait(streams.start_intake(calls, store, requests, f"{place}/checkpoints/intake", "doc_id", trigger=ONCE))
    streams.wait(streams.start_dispatch(requests.read_stream(spark), to_enrich, f"{place}/checkpoints/dispatch", ONCE, ("en", "de")))
    declared = T.StructType([*TYPED_REQUEST.fields, T.StructField("filtered", T.ArrayType(T.StringType()))])
    sent = envelope.parse(to_enrich.read_batch(spark), declared)
    return sent.select("id", "type", F.to_json("filtered").alias("filtered"))


@query
def stream_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Word counts from a channel of predictions on to a channel of partial documents."""
    place = work_folder(spark, "bodies")
    enriched, bodies = message_folder(f"{place}/enriched"), message_folder(f"{place}/bodies")
    streams.start_row_enricher(
        message_stream(spark, folder), WordCount(stop_words=()), enriched, f"{place}/checkpoints/enrich", ONCE
    ).awaitTermination()
    streams.start_bodies(
        enriched.read_stream(spark), bodies, f"{place}/checkpoints/bodies", ONCE
    ).awaitTermination()
    return bodies.read_batch(spark)


@query
def stream_enrich(spark: SparkSession, folder: str) -> DataFrame:
    place = work_folder(spark, "enrich")
    enriched = message_folder(f"{place}/messages")
    stop = [word for (word,) in lookups.STOP_WORDS.rows]
    streams.start_enricher(
        message_stream(spark, folder), WordCount(stop_words=stop), enriched, f"{place}/checkpoint", ONCE
    ).awaitTermination()
    return envelope.predictions_from(enriched.read_batch(spark))


@query
def stream_enrich_document_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """Sentiment of a stream by a lexicon of all words of the documents, which is joined batch by batch."""
    place = work_folder(spark, "enrich")
    enriched = message_folder(f"{place}/messages")
    enricher = Sentiment(document_lexicon(spark, folder), **LARGE)
    streams.start_enricher(
        message_stream(spark, folder), enricher, enriched, f"{place}/checkpoint", ONCE
    ).awaitTermination()
    return envelope.predictions_from(enriched.read_batch(spark))


@query
def stream_enrich_rows(spark: SparkSession, folder: str) -> DataFrame:
    place = work_folder(spark, "enrich")
    enriched = message_folder(f"{place}/messages")
    enricher = Sentiment(lookups.LEXICON.frame(spark))
    streams.start_row_enricher(
        message_stream(spark, folder), enricher, enriched, f"{place}/checkpoint", ONCE
    ).awaitTermination()
    return envelope.predictions_from(enriched.read_batch(spark))


@query
def stream_tags(spark: SparkSession, folder: str) -> DataFrame:
    place = work_folder(spark, "tags")
    enriched = message_folder(f"{place}/messages")
    tagger = TokenTags(lookups.TAGS.frame(spark))
    streams.start_row_enricher(
        message_stream(spark, folder), tagger, enriched, f"{place}/checkpoint", ONCE
    ).awaitTermination()
    return envelope.predictions_from(enriched.read_batch(spark))


@query
def stream_tag_view(spark: SparkSession, folder: str) -> DataFrame:
    """The tagged tokens of a stream of texts, one row each, as the debugging view shows them."""
    place = work_folder(spark, "tag_view")
    view = message_folder(f"{place}/view")
    texts = document_stream(spark, folder).select(F.col("text").alias("value"))
    tagger = TokenTags(lookups.TAGS.frame(spark))
    streams.wait(streams.start_tag_view(texts, tagger, f"{place}/checkpoint", ONCE, view))
    shown = envelope.parse(view.read_batch(spark), T.StructType().add("text", "string").add("prediction", "string"))
    # Before tags become rows: after that the id would be made of the text once for each token.
    tagged = shown.select(F.sha2("text", 256).alias("text_id"), F.from_json("prediction", TAGGED_TOKENS).alias("tags"))
    return views.exploded(tagged, "tags", "key", "token").select("text_id", "key", "token.*")


@query
def stream_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Both legs: predictions of labelled and of unknown documents into a store of labelled ones."""
    place = work_folder(spark, "merge")
    store = DocumentStore(spark, f"{place}/store").create()
    held = labelled(spark, folder).withColumn("type", F.lit(None).cast("string"))
    store.add_documents(held, "id", 0)
    to_enrich, enriched = message_folder(f"{place}/messages"), message_folder(f"{place}/enriched")
    streams.start_row_enricher(
        message_stream(spark, folder), TotalWords("Words"), enriched, f"{place}/checkpoints/enrich", ONCE
    ).awaitTermination()
    legs = streams.start_dispatcher(
        message_stream(spark, folder), to_enrich, enriched.read_stream(spark), store, f"{place}/checkpoints", ONCE
    )
    for leg in legs:
        leg.awaitTermination()
    applied = store.latest().select("id", "type", "prediction", F.lit("").alias("reason"))
    return applied.unionByName(store.rejected().select("id", "type", "prediction", "reason"))


@query
def stream_merge_batches(spark: SparkSession, folder: str) -> DataFrame:
    """A merge over several batches, with several predictions of each document in one: the last to arrive counts."""
    place = work_folder(spark, "merge")
    store = DocumentStore(spark, f"{place}/store").create()
    held = documents(spark, folder).withColumn("type", F.lit(None).cast("string"))
    store.add_documents(held, "id", 0)
    # Files and their number in a batch grow with the session's tasks, so that no task's share grows with the input alone.
    files = max(LEAST_FILES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    enriched = message_folder(f"{place}/enriched", maxFilesPerTrigger=str(files * 3 // 5))

    def send(part: str, *answers: DataFrame) -> None:
        """Each document's answers into one file, one after the other."""
        rows = [answer.withColumn("turn", F.lit(i)) for i, answer in enumerate(answers)]
        together = rows[0]
        for more in rows[1:]:
            together = together.unionByName(more)
        in_order = together.repartition(files, "id").sortWithinPartitions("id", "turn")
        enriched.write_batch(envelope.prediction_messages(in_order), part)
        streams.start_merge(
            enriched.read_stream(spark), store, f"{place}/checkpoint", ONCE
        ).awaitTermination()

    length = ColumnEnricher("Words", lambda text: F.length(text).cast("string"))
    tokens_only = ColumnEnricher("Words", lambda text: F.size(X.class_tokens(text)).cast("string"))
    rows = documents(spark, folder)
    send("part=1", TotalWords("Words").predictions(rows), length.predictions(rows))
    again = labelled(spark, folder)
    send("part=2", length.predictions(again), tokens_only.predictions(again))
    return store.latest().select("id", "type", "prediction")


@query
def store_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """A store that is compacted; then intake and merge go on with the copy, and each batch is delivered twice."""
    place = work_folder(spark, "compacted")
    store = DocumentStore(spark, f"{place}/store").create()
    some, every = (
        rows(spark, folder).withColumn("type", F.lit(None).cast("string")) for rows in (labelled, documents)
    )
    here = {"ts": F.lit(None).cast("timestamp"), "seq": F.lit(0).cast("long")}
    store.add_documents(some, "id", 0)
    store.add_predictions(TotalWords("Words").predictions(some).withColumns(here), 0)
    copy = store.compact_into(f"{place}/copy")
    tokens_only = ColumnEnricher("Tokens", lambda text: F.size(X.class_tokens(text)).cast("string"))
    for _ in range(2):
        copy.create().add_documents(every, "id", 0)
        copy.add_predictions(tokens_only.predictions(every).withColumns(here), 0)
    last = copy.latest().select("id", F.col("type").alias("answer"), "prediction")
    return copy.documents().select("id", "text").join(last, "id")


def _arrived(rows: DataFrame) -> DataFrame:
    """Predictions as a merge takes them, without an order of their own."""
    return rows.withColumns({"ts": F.lit(None).cast("timestamp"), "seq": F.lit(0).cast("long")})


def _untyped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("type", F.lit(None).cast("string"))


@query
def store_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Ten batches of documents and of predictions, whose parts are merged level by level. The k-th batch of predictions
    is about the documents whose id ends in k or more, so their last one and the number of updates differ."""
    store = DocumentStore(spark, f"{work_folder(spark, 'levels')}/store").create()
    rows = documents(spark, folder)
    digit = F.col("id").cast("long") % 10
    for k in range(10):
        store.add_documents(_untyped(rows.filter(digit <= k)), "id", k)
    # Without the texts, so that these are read and counted once for all batches.
    words = TotalWords("Words").predictions(rows).drop("text").persist()
    for k in range(10):
        numbered = words.withColumn("prediction", F.concat_ws(":", F.lit(k), "prediction"))
        store.add_predictions(_arrived(numbered.filter(digit >= k)), k)
    words.unpersist()
    return store.latest().join(store.documents().select("id", "text"), "id")


class FailsBetweenWrites(DocumentStore):
    """A store whose process ends when one of the two tables of a batch is written."""

    def _write(self, rows: DataFrame, table: str, level: int = 0):
        if table == "rejected":
            raise OSError("the process ended between two writes")
        return super()._write(rows, table, level)


@query
def store_failed_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A batch of predictions that fails between its two tables: readers see nothing of it until it is delivered again."""
    store = FailsBetweenWrites(spark, f"{work_folder(spark, 'failed')}/store").create()
    store.add_documents(_untyped(labelled(spark, folder)), "id", 0)
    batch = _arrived(TotalWords("Words").predictions(documents(spark, folder)))
    try:
        store.add_predictions(batch, 0)
    except OSError:
        seen = store.predictions().count() + store.rejected().count()
    store = DocumentStore(spark, store.path)
    for _ in range(2):
        store.add_predictions(batch, 0)
    found = store.predictions().select("id", "prediction", F.lit("").alias("reason"))
    found = found.unionByName(store.rejected().select("id", "prediction", "reason"))
    return found.withColumn("seen", F.lit(seen).cast("bigint"))


@query
def stream_enrich_replay(spark: SparkSession, folder: str) -> DataFrame:
    """A batch that is delivered twice to a folder: the stream behind it takes each message once."""
    place = work_folder(spark, "replay")
    enriched, bodies = message_folder(f"{place}/enriched"), message_folder(f"{place}/bodies")
    for delivery in range(2):
        streams.start_enricher(
            message_stream(spark, folder), TotalWords("Words"), enriched, f"{place}/checkpoints/{delivery}", ONCE
        ).awaitTermination()
        streams.start_bodies(
            enriched.read_stream(spark), bodies, f"{place}/checkpoints/bodies", ONCE
        ).awaitTermination()
    return bodies.read_batch(spark)


@query
def stream_two_legs(spark: SparkSession, folder: str) -> DataFrame:
    """Both legs of the dispatcher, of which the merge fails once: the wait for them raises its error, and started anew they
    go on. One batch of the channel holds nothing but malformed messages."""
    place = work_folder(spark, "legs")
    store = FailsBetweenWrites(spark, f"{place}/store").create()
    store.add_documents(_untyped(labelled(spark, folder)), "id", 0)
    enriched = message_folder(f"{place}/enriched")
    rows = documents(spark, folder)
    malformed = rows.limit(3).select(F.lit("{").alias("value"))
    enriched.write_batch(malformed, "part=0")
    to_enrich = message_folder(f"{place}/messages")

    def start(store: DocumentStore):
        return streams.start_dispatcher(
            message_stream(spark, folder), to_enrich, enriched.read_stream(spark), store, f"{place}/checkpoints", ONCE
        )

    failures = 0
    try:
        streams.wait(*start(store))
    except StreamingQueryException:
        failures = 1
    # The batch of malformed messages failed and is delivered again; the next one has as many files as there are tasks.
    enriched.write_batch(envelope.prediction_messages(TotalWords("Words").predictions(rows)), "part=1")
    store = DocumentStore(spark, store.path)
    streams.wait(*start(store))
    sent = envelope.requests_from(to_enrich.read_batch(spark))
    merged = store.latest().select("id", "prediction")
    return sent.select("id").join(merged, "id", "left").withColumn("failures", F.lit(failures).cast("bigint"))


@query
def stream_from_time(spark: SparkSession, folder: str) -> DataFrame:
    """A stream that begins at a time: messages of older files are passed over, also when it is started anew."""
    place = work_folder(spark, "since")
    everything = message_folder(f"{place}/requests")
    everything.write_batch(envelope.request_messages(labelled(spark, folder)), "part=0")
    # Times of files are whole milliseconds, in some stores whole seconds.
    time.sleep(1.1)
    since = datetime.fromtimestamp(int(time.time()), timezone.utc)
    channel, to_enrich = message_folder(f"{place}/requests", since=since), message_folder(f"{place}/messages")
    others = documents(spark, folder).join(labelled(spark, folder), "id", "left_anti")
    time.sleep(1.1)
    for _ in range(2):
        streams.start_dispatch(channel.read_stream(spark), to_enrich, f"{place}/checkpoint", ONCE).awaitTermination()
        everything.write_batch(envelope.request_messages(others), "part=1")
    streams.start_dispatch(channel.read_stream(spark), to_enrich, f"{place}/checkpoint", ONCE).awaitTermination()
    return envelope.requests_from(to_enrich.read_batch(spark))
