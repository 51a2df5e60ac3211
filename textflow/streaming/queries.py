"""Streaming queries. Each takes its channels, a checkpoint of its own and an optional trigger."""

from __future__ import annotations

import time
from collections.abc import Callable, Collection, Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textflow.functions import envelope
from textflow.functions.ids import text_id
from textflow.functions.text import remove_stop_words, tokenize
from textflow.operators import merge
from textflow.operators.enricher import Enricher
from textflow.operators.intake import with_id
from textflow.operators.store import DocumentStore
from textflow.operators.tags import TokenTags
from textflow.schemas import REQUEST
from textflow.sources.channels import Channel, show_stream

Trigger = Mapping | None
# How long `wait` looks at one leg before it looks at the others.
WATCH_SECONDS = 1


def _each_batch(
    rows: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, trigger: Trigger
) -> StreamingQuery:
    """Runs `work` for each batch that has rows; the guard looks at the input, before any work."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            work(batch, batch_id)

    writer = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def preprocess(
    messages: DataFrame, tokens: bool | Collection[str] = False, language: str = "english"
) -> DataFrame:
    """Complete requests of a channel; on demand with `tokens` and `filtered`, its tokens without
    stop words.

    With a list of types the requests keep their `type`, and only those of one of them are tokenised: the others, and
    requests without a type, have null tokens.
    """
    if isinstance(tokens, bool):
        requests = envelope.requests_from(messages)
        return remove_stop_words(tokenize(requests), language=language) if tokens else requests
    requests = envelope.typed_requests_from(messages)
    asked = F.when(F.col("type").isin(list(tokens)), F.col("text"))
    listed = tokenize(requests.withColumn("__asked", asked), text="__asked").drop("__asked")
    return remove_stop_words(listed, language=language)


def start_intake(
    requests: DataFrame,
    store: DocumentStore,
    forward: Channel,
    checkpoint: str,
    order: str,
    id_of: Callable[[Column], Column] = text_id,
    trigger: Trigger = None,
) -> StreamingQuery:
    """Requests `type, text` to the store and on to a channel, once per id.

    What is forwarded is read back from the committed part, so both always hold the same rows.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        stored = store.add_documents(with_id(batch, id_of), order, batch_id)
        forward.write_batch(envelope.request_messages(stored), store.part(batch_id))

    return _each_batch(requests, work, checkpoint, trigger)


def start_dispatch(
    messages: DataFrame,
    to_enrich: Channel,
    checkpoint: str,
    trigger: Trigger = None,
    tokens: bool | Collection[str] = False,
) -> StreamingQuery:
    """Complete requests on to the channel of the enrichers, on demand with their tokens: all of them, or those of the
    named types."""
    requests = preprocess(messages, tokens)
    return to_enrich.write_stream(envelope.request_messages(requests), checkpoint, trigger)


def start_enricher(
    messages: DataFrame,
    enricher: Enricher,
    enriched: Channel,
    checkpoint: str,
    trigger: Trigger = None,
    run: str = "0",
) -> StreamingQuery:
    """Predictions of one enricher to the channel of predictions, batch by batch.

    The predictions of a batch are computed once, by the write itself.
    """
    requests = envelope.parse(messages, REQUEST)

    def work(batch: DataFrame, batch_id: int) -> None:
        answered = envelope.prediction_messages(enricher.predictions(batch))
        enriched.write_batch(answered, f"type={enricher.label}/run={run}/batch_id={batch_id}")

    return _each_batch(requests, work, checkpoint, trigger)


def start_row_enricher(
    messages: DataFrame,
    enricher: Enricher,
    enriched: Channel,
    checkpoint: str,
    trigger: Trigger = None,
) -> StreamingQuery:
    """As `start_enricher` for a row-local enricher, as one streaming plan without batch callbacks.

    On a folder of messages this delivers each prediction exactly once.
    """
    if not enricher.row_local:
        raise ValueError(f"{enricher.label} needs whole batches; use start_enricher")
    answered = enricher.predictions(envelope.parse(messages, REQUEST))
    return enriched.write_stream(envelope.prediction_messages(answered), checkpoint, trigger)


def start_merge(
    messages: DataFrame, store: DocumentStore, checkpoint: str, trigger: Trigger = None
) -> StreamingQuery:
    """Predictions into the store; of those of one id and type the last to arrive counts.

    Within a batch a topic's messages are ordered by time and offset, and a folder's by the time and path of their
    file and their place in it. Messages without such columns have no order and are refused.
    """
    order = [c for c in ("timestamp", "offset", "file", "block") if c in messages.columns]
    if "timestamp" not in order or not {"offset", "file"} & set(order):
        raise ValueError("the order of messages is unknown: timestamp and offset, or timestamp, file and block")
    predictions = envelope.predictions_from(messages, *order)

    def work(batch: DataFrame, batch_id: int) -> None:
        # Rows of a split are numbered as they follow each other in the file.
        numbered = batch.withColumn("row", F.monotonically_increasing_id())
        seq = F.col("offset" if "offset" in order else "row").cast("long")
        placed = numbered.withColumns({"ts": F.col("timestamp"), "seq": seq})
        store.add_predictions(placed, batch_id, F.struct(*order, "row"))

    return _each_batch(predictions, work, checkpoint, trigger)


def start_bodies(messages: DataFrame, bodies: Channel, checkpoint: str, trigger: Trigger = None) -> StreamingQuery:
    """Predictions on to a channel as partial documents, for a store outside; incomplete ones are left out."""
    predictions = envelope.predictions_from(messages).filter("id is not null and type is not null")
    return bodies.write_stream(merge.body_messages(predictions), checkpoint, trigger)


def start_tag_view(
    messages: DataFrame,
    tagger: TokenTags,
    checkpoint: str | None = None,
    trigger: Trigger = None,
    view: Channel | None = None,
) -> StreamingQuery:
    """Shows the tagged tokens of each message, for debugging: printed, or with `view` sent there whole as messages
    `text, prediction`, which anything that reads a channel can look at."""
    if not tagger.row_local:
        raise ValueError(f"{tagger.label} needs whole batches: its lexicon is joined; use start_enricher")
    texts = envelope.message_text(messages).select(
        F.lit(None).cast("string").alias("id"), F.col("value").alias("text")
    )
    shown = tagger.enrich(texts).select("text", "prediction")
    return show_stream(shown, checkpoint, trigger, view)


def start_dispatcher(
    requests: DataFrame,
    to_enrich: Channel,
    predictions: DataFrame,
    store: DocumentStore,
    checkpoints: str,
    trigger: Trigger = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Both legs of the dispatcher in one application."""
    return (
        start_dispatch(requests, to_enrich, f"{checkpoints}/dispatch", trigger),
        start_merge(predictions, store, f"{checkpoints}/merge", trigger),
    )


def wait(*legs: StreamingQuery, seconds: float | None = None) -> bool:
    """Blocks until all legs have ended, and tells whether they have; at most for `seconds`.

    When one fails the others are stopped and its error is raised, so that an application never goes on with half of
    its queries; started anew with their checkpoints, all legs go on where they were.
    """
    until = None if seconds is None else time.monotonic() + seconds
    while True:
        failed = next((leg for leg in legs if not leg.isActive and leg.exception() is not None), None)
        if failed is not None:
            for leg in legs:
                leg.stop()
            raise failed.exception()
        running = [leg for leg in legs if leg.isActive]
        if not running:
            return True
        if until is not None and time.monotonic() >= until:
            return False
        try:
            running[0].awaitTermination(WATCH_SECONDS)
        except StreamingQueryException:
            # Told by the query itself, and raised above once the others are stopped.
            continue
