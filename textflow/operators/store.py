"""The document store: buckets of ids, parts that a commit log names, and levels into which parts are merged."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.operators import intake, merge, views
from textflow.operators.commits import CommitLog, Part, State
from textflow.schemas import REJECTED_PREDICTION, STORED_DOCUMENT, STORED_PREDICTION

# Later commits win; within a commit the time and place in the source decide.
COMMIT_ORDER = ("run", "batch_id", "ts", "seq")
# The run of compacted parts: no stream commits to it, and it sorts before all others.
COMPACTED_RUN = "!compacted"
# Buckets by the hash of the id; a large store has some hundreds.
BUCKETS = 8
# New ids of a batch that are sent to all tasks, at most; with more of them texts move before stored ones are left out.
SENT_IDS = 1 << 19
# Parts of one level that become one part of the next.
FAN = 4
# Tables, and the log that names their parts: those of one log are committed together.
LOGS = {"documents": ("documents",), "updates": ("predictions", "rejected")}
SCHEMAS = {"documents": STORED_DOCUMENT, "predictions": STORED_PREDICTION, "rejected": REJECTED_PREDICTION}


def _log_of(table: str) -> str:
    return next(log for log, tables in LOGS.items() if table in tables)


class DocumentStore:
    """Tables `documents`, `predictions` and `rejected`, each in parts laid out as `part=…/bucket=…`.

    A batch writes new parts and then one commit, so it counts as a whole or not at all, and a batch that is delivered
    again after its commit changes nothing. A batch looks for its ids in their buckets only, and files carry Bloom
    filters of ids for single look-ups. When there are `fan` parts of a level, they become one part of the next level, in
    which each id and type has one prediction; so a row is written anew about log n times in the life of the store,
    and readings take a few parts for each level, however many batches there were.

    `run` names the life of a checkpoint: a new checkpoint, whose batch ids begin at 0 again, needs a new run that
    sorts after the old one. Intake commits to one log and merge to another, each with one writer at a time; a second
    writer of a version fails, and its batch is delivered again.
    """

    def __init__(self, spark: SparkSession, path: str, run: str = "0", buckets: int = BUCKETS, fan: int = FAN) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.run = run
        self.buckets = buckets
        self.fan = fan
        self.logs = {name: CommitLog(spark, f"{self.path}/log/{name}") for name in LOGS}

    def create(self) -> DocumentStore:
        """An empty store where there is none; one that is there stays as it is."""
        for log in self.logs.values():
            if log.read() is None:
                log.commit(State(0, self.buckets), self.path)
        return self

    def state(self, log: str) -> State:
        found = self.logs[log].read()
        if found is None:
            raise FileNotFoundError(f"there is no store at {self.path}")
        return found

    def part(self, batch_id: int) -> str:
        """Where a batch of this run goes in a channel."""
        return f"run={self.run}/batch_id={batch_id}"

    # Reading

    def _read(self, table: str, buckets: Sequence[int] | None = None, parts: Sequence[Part] | None = None) -> DataFrame:
        """Rows of the live parts (or the given ones), of some buckets only: no other folder is listed."""
        live = self.state(_log_of(table)).of(table) if parts is None else parts
        root = f"{self.path}/{table}"
        paths = [
            f"{root}/part={p.name}/bucket={b}" for p in live for b in p.buckets if buckets is None or b in set(buckets)
        ]
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[table])
        placed = T.StructType([*SCHEMAS[table].fields, T.StructField("part", T.StringType()), T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(placed).option("basePath", root).parquet(*paths)
        return rows.select(*SCHEMAS[table].names)

    def documents(self) -> DataFrame:
        return self._read("documents")

    def predictions(self) -> DataFrame:
        return self._read("predictions")

    def rejected(self) -> DataFrame:
        return self._read("rejected")

    def latest(self) -> DataFrame:
        """The last prediction of each document and type, and how many `updates` led to it."""
        return merge.latest(self.predictions(), F.struct(*COMMIT_ORDER))

    def stored(self) -> DataFrame:
        """Documents with their map of predictions."""
        return views.with_predictions(self.documents().select("id", "text", "type"), self.latest())

    def find(self, *ids: str) -> DataFrame:
        """The stored documents of a few ids with their predictions, from the buckets of these ids alone."""
        asked = self.spark.createDataFrame([(i,) for i in ids], "id string")
        buckets = self._buckets_of(self._placed(asked))
        among = F.col("id").isin(list(ids))
        updates = merge.latest(self._read("predictions", buckets).filter(among), F.struct(*COMMIT_ORDER))
        return views.with_predictions(self._read("documents", buckets).filter(among).select("id", "text", "type"), updates)

    def documents_with(self, prediction_type: str) -> DataFrame:
        return views.documents_with(self.stored(), prediction_type)

    def enriched(self, types: Sequence[str]) -> DataFrame:
        """Documents with one column per enricher."""
        order = F.struct(*COMMIT_ORDER)
        return views.enriched(self.documents(), self.predictions(), types, order)

    # Writing

    @cached_property
    def stored_buckets(self) -> int:
        """The number of buckets that the store was created with, whatever this object was given."""
        return self.state("documents").buckets

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(self.stored_buckets)).cast("int"))

    @staticmethod
    def _buckets_of(placed: DataFrame) -> list[int]:
        return [row.bucket for row in placed.select("bucket").distinct().collect()]

    def _write(self, rows: DataFrame, table: str, level: int = 0) -> Part:
        """A new part, which counts from a commit on that names it."""
        name = uuid.uuid4().hex
        path = f"{self.path}/{table}/part={name}"
        placed = self._placed(rows.select(*SCHEMAS[table].names))
        # Rows of a bucket come together; Spark splits those that are large.
        writer = placed.hint("rebalance", "bucket").write.partitionBy("bucket")
        if level:
            # Worth their making in the large files of merged parts.
            writer = writer.options(**{"parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.adaptive.enabled": "true"})
        writer.parquet(path)
        names = self.logs[_log_of(table)].files.names(path)
        return Part(table, name, level, tuple(int(n[7:]) for n in names if n.startswith("bucket=")))

    def _committed(self, rows: DataFrame, batch_id: int) -> DataFrame:
        return rows.withColumns({"run": F.lit(self.run), "batch_id": F.lit(batch_id).cast("long")})

    def _known(self, placed: DataFrame, documents: State | None = None) -> DataFrame:
        """The stored ids that occur in a persisted batch, read from the batch's buckets.

        Looking at the buckets fills the batch's cache, so that Spark knows its size when it plans the join.
        """
        parts = (documents or self.state("documents")).of("documents")
        return intake.ids_among(self._read("documents", self._buckets_of(placed), parts), placed)

    def add_documents(self, requests: DataFrame, order: str, batch_id: int) -> DataFrame:
        """Stores the first request of each new id and returns what was stored. Requests without id, such as
        those of a null text, are left out: nothing could ever be merged into their documents.
        Requests are read twice, first for their ids."""
        state = self.state("documents")
        if state.has(self.run, batch_id):
            return self.documents().filter((F.col("run") == self.run) & (F.col("batch_id") == batch_id))
        requests = requests.filter("id is not null")
        asked = self._placed(requests.select("id").distinct()).persist()
        new = intake.only_new(asked, self._known(asked, state)).select("id").persist()
        if new.count() <= SENT_IDS:
            # Texts that are stored already are left out before any text moves.
            firsts = intake.first_of_each_id(requests.join(F.broadcast(new), "id", "left_semi"), order)
        else:
            firsts = intake.first_of_each_id(requests, order).join(new, "id", "left_semi")
        part = self._write(self._committed(firsts, batch_id), "documents")
        state = state.after_batch(self.run, batch_id, [part])
        self.logs["documents"].commit(state, self.path)
        new.unpersist()
        asked.unpersist()
        self.settle("documents", state)
        # What was merged meanwhile stays for some versions.
        return self._read("documents", parts=[part])

    def add_predictions(self, predictions: DataFrame, batch_id: int, order: Column | None = None) -> None:
        """Commits `id, type, prediction, ts, seq`; updates of unknown ids go to `rejected`, in the same commit. The last
        one in the batch counts, by `ts` and `seq` or by a finer `order`."""
        state = self.state("updates")
        if state.has(self.run, batch_id):
            return
        order = F.struct("ts", "seq") if order is None else order
        last = self._placed(merge.latest(predictions, order, "ts", "seq")).persist()
        known = self._known(last).withColumn("known", F.lit(True))
        judged = self._committed(last.drop("bucket").join(known, "id", "left"), batch_id).persist()
        refused = judged.filter("known is null").withColumn("reason", F.lit(merge.UNKNOWN_ID))
        parts = [self._write(judged.filter("known"), "predictions"), self._write(refused, "rejected")]
        state = state.after_batch(self.run, batch_id, parts)
        self.logs["updates"].commit(state, self.path)
        judged.unpersist()
        last.unpersist()
        self.settle("updates", state)

    # Merging

    def _merged(self, table: str, parts: Sequence[Part]) -> DataFrame:
        rows = self._read(table, parts=parts)
        if table != "predictions":
            return rows
        return merge.latest(rows, F.struct(*COMMIT_ORDER), *COMMIT_ORDER)

    def settle(self, log: str, state: State | None = None) -> None:
        """Merges parts while there are `fan` of one level. A merge is a commit of its own: one that fails or is
        overtaken loses nothing, and is made up for with the next batch."""
        state = state or self.state(log)
        for table in LOGS[log]:
            level = 0
            while level <= max((p.level for p in state.of(table)), default=-1):
                parts = [p for p in state.of(table) if p.level == level]
                if len(parts) >= self.fan:
                    new = self._write(self._merged(table, parts), table, level + 1)
                    state = state.after_merge(parts, new)
                    self.logs[log].commit(state, self.path)
                level += 1

    def compact_into(self, path: str) -> DocumentStore:
        """A copy of the store with few large files and only the last predictions.

        What was committed so far becomes parts of a run of its own, which sorts before all others and
        which no stream commits to. So intake and merge, which number their batches separately, go on with the
        copy as they would with the store: their next batches find its documents and put updates over its
        predictions. Take the copy between batches.
        """
        target = DocumentStore(self.spark, path, self.run, self.stored_buckets, self.fan).create()
        compacted = DocumentStore(self.spark, path, COMPACTED_RUN, self.stored_buckets, self.fan)
        for log, tables in LOGS.items():
            state = self.state(log)
            parts = []
            for table in tables:
                rows = compacted._committed(self._merged(table, state.of(table)), 0)
                parts.append(compacted._write(rows, table, max((p.level for p in state.of(table)), default=0) + 1))
            target.logs[log].commit(target.state(log).after_batch(COMPACTED_RUN, 0, parts), path)
        return target
