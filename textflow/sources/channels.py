"""Message channels: a Kafka topic, or a folder of message files."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textflow.config import Options
from textflow.schemas import MESSAGE
from textflow.sources.files import Files


@dataclass(frozen=True)
class Channel:
    """Messages are rows with a column `value`; the format's own options say where they are."""

    format: str
    read_options: Mapping[str, str] = field(default_factory=dict)
    write_options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None
    since: datetime | None = None

    def read_stream(self, spark: SparkSession) -> DataFrame:
        """Messages as they come. Those of a folder carry the time, path and split of their file as `timestamp`, `file`
        and `block`, for consumers that need the order of arrival. With `since`, files that are older are passed over:
        the start of a stream by time, which stays the same when it is started anew."""
        reader = spark.readStream.format(self.format).options(**self.read_options)
        if self.path is None:
            return reader.load()
        places = {"timestamp": "file_modification_time", "file": "file_path", "block": "file_block_start"}
        found = [F.col(f"_metadata.{of}").alias(name) for name, of in places.items()]
        messages = reader.schema(MESSAGE).load(self.path).select("*", *found)
        return messages if self.since is None else messages.filter(F.col("timestamp") >= F.lit(self.since))

    def read_batch(self, spark: SparkSession) -> DataFrame:
        """All messages so far."""
        reader = spark.read.format(self.format).options(**self.read_options)
        if self.path is None:
            return reader.option("startingOffsets", "earliest").load()
        return reader.schema(MESSAGE).load(self.path)

    def write_stream(
        self, messages: DataFrame, checkpoint: str, trigger: Mapping | None = None
    ) -> StreamingQuery:
        """Appends a stream of messages; every query has a checkpoint of its own."""
        writer = messages.writeStream.format(self.format).outputMode("append")
        writer = writer.options(**self.write_options).option("checkpointLocation", checkpoint)
        if trigger:
            writer = writer.trigger(**trigger)
        return writer.start(self.path) if self.path else writer.start()

    def write_batch(self, messages: DataFrame, batch: str) -> None:
        """Writes one micro-batch. A folder gets a part per batch, which appears as a whole, by a rename, and only once:
        a batch that is delivered again finds its part and writes nothing, so streams that read the folder take each
        message once. What a failed batch left is in a hidden folder, which no reader looks into."""
        writer = messages.write.format(self.format).options(**self.write_options)
        if self.path is None:
            writer.save()
            return
        files = Files(messages.sparkSession, self.path)
        if files.exists(f"{self.path}/{batch}"):
            return
        hidden = f"{self.path}/_written/{uuid.uuid4().hex}"
        writer.save(hidden)
        files.move_new(hidden, f"{self.path}/{batch}")


def kafka_topic(brokers: str, topic: str, starting_offsets: str = "latest") -> Channel:
    at = {"kafka.bootstrap.servers": brokers}
    return Channel(
        "kafka",
        {**at, "subscribe": topic, "startingOffsets": starting_offsets},
        {**at, "topic": topic},
    )


def message_folder(path: str, format: str = "text", since: datetime | None = None, **read_options: str) -> Channel:
    """A folder of compressed message files, from the beginning or from a time on; `maxFilesPerTrigger` bounds what a batch
    takes."""
    return Channel(format, {"recursiveFileLookup": "true", **read_options}, {"compression": "gzip"}, path, since)


def topics(options: Options) -> dict[str, Channel]:
    """The three topics of a deployment."""
    names = options.topics
    return {
        role: kafka_topic(options.brokers, name, options.starting_offsets)
        for role, name in (
            ("requests", names.requests),
            ("to_enrich", names.to_enrich),
            ("enriched", names.enriched),
        )
    }


def show_stream(
    rows: DataFrame, checkpoint: str | None = None, trigger: Mapping | None = None, view: Channel | None = None
) -> StreamingQuery:
    """Prints new rows as they come, the first ones of each batch; with `view` all go to that channel, as JSON."""
    if view is not None:
        if checkpoint is None:
            raise ValueError("a view that is a channel needs a checkpoint")
        return view.write_stream(rows.select(F.to_json(F.struct("*")).alias("value")), checkpoint, trigger)
    writer = rows.writeStream.format("console").outputMode("append")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def show_batch(rows: DataFrame) -> None:
    """Prints the first rows of a table."""
    rows.write.format("console").mode("append").save()
