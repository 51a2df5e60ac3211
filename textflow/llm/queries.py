"""The operators as named queries over the whole tables, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.llm import (
    decontamination,
    hard_negatives,
    language,
    licenses,
    mixing,
    near_duplicates,
    pii,
    sharding,
    spelling,
    syncmers,
    toxicity,
    url_filter,
    warc,
)
from textflow.llm.tables import id_text, table

SHARDS = tuple(f"shard-{i:02d}" for i in range(32))
# Weights of sources in a mix; the other sources share the weight REST evenly.
TARGETS, REST = {"src0": 5, "src1": 2, "src2": 2, "src3": 1}, 10
RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)
# Rows from which nothing is learned: crc32 of the id as text, modulo the first, equal to the second.
LANGUAGE_FOLD, TOXICITY_FOLD = (4, 2), (5, 0)


def held_out(fold: tuple[int, int], doc_id: str = "doc_id") -> Column:
    return F.crc32(id_text(doc_id)) % fold[0] == fold[1]


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return sharding.place(documents, [F.col("doc_id"), F.md5("text")], SHARDS).select("doc_id", "slot", "shard")


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents").select("doc_id", "text"), output="found")
    base = F.filter("found", lambda s: s["place"] < len(pii.BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    counts = [count(kind).alias(f"n_{kind}") for kind in pii.BASE]
    scores = F.array_join(F.transform("found", lambda s: F.format_number(s["score"], 2)), ",")
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("found")).alias("spans"),
        scores.alias("scores"),
        count("secret").alias("n_secret"),
        F.size("found").cast("bigint").alias("n_spans"),
    )


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    judged = near_duplicates.near_duplicates(table(spark, folder, "documents"), words_per_shingle=2)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return judged.select("doc_id", "n_shingles", "component_id", kept)


def _language_network(documents: DataFrame) -> language.Network | None:
    return language.fit(*language.sample(documents.filter(~held_out(LANGUAGE_FOLD))))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = language.identify(documents.select("doc_id", "text"), _language_network(documents), score="score")
    return found.select("doc_id", held_out(LANGUAGE_FOLD).alias("held_out"), "lang_pred", "score")


def op5_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = syncmers.with_next(documents)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), F.length("text") - half), F.left(F.col("next_text"), half))
    rows = rows.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), edited.alias("edited"), "anchors", "next_anchors")
    rows = rows.withColumn("edited_anchors", syncmers.anchors(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        syncmers.as_text(F.col("anchors")).alias("fingerprint"),
        syncmers.as_text(F.col("edited_anchors")).alias("edited_fingerprint"),
        syncmers.likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        syncmers.likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_and_read(table(spark, folder, "pages"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.with_leaks(documents, table(spark, folder, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.mix(documents, TARGETS, REST).drop("text")


def op9_urls(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge(table(spark, folder, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    classifier = toxicity.fit_packed(*toxicity.sample(documents, labels.filter(~held_out(TOXICITY_FOLD))))
    scored = toxicity.score(documents.select("doc_id", "text"), classifier)
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", held_out(TOXICITY_FOLD).alias("held_out"), "score", predicted)


def op11_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Phrases and notices in every document: `n_base` places of phrases, labels, and the blocks that hold a notice."""
    found = licenses.scan(table(spark, folder, "documents").select("doc_id", "text"))
    starts = F.transform("places", lambda p: p["start"].cast("bigint"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        F.size("blocks").cast("bigint").alias("n_blocks"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every 50th vector among all vectors; every 7th vector has the next label."""
    given = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = given.withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0, id="vec_id", vector="embedding")


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with the more frequent words at one edit that they are variants of."""
    return spelling.variants(table(spark, folder, "documents"))


# Stages of the pipeline: each takes documents and returns documents.


def keep_known_language(spark: SparkSession, docs: DataFrame, folder: str, least: float = 0.5) -> DataFrame:
    """Documents whose language is recognised with a score of at least `least`."""
    found = language.identify(docs, _language_network(docs), predicted="__lang", score="__score")
    return found.filter((F.col("__lang") != language.UNKNOWN) & (F.col("__score") >= least)).drop("__lang", "__score")


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id; documents without words all stay."""
    return near_duplicates.deduplicated(docs, words_per_shingle=5)


def keep_without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in which no benchmark item was found; null and empty texts stay."""
    found = decontamination.with_leaks(docs, table(spark, folder, "benchmark"), output="__leaks")
    return found.filter(F.size("__leaks") == 0).drop("__leaks")


def order_by_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents in the order of the mix."""
    return mixing.in_order_of_the_mix(docs, TARGETS, REST)


def place_on_shards(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with their `slot` and `shard`, and with `mix_lane` and `mix_position`, in whose order they come: files that
    are read again do not keep an order. Each row is placed by its own id and text; none is left out."""
    placed = sharding.place(docs, [F.col("doc_id"), F.md5("text")], SHARDS)
    return mixing.in_order_of_the_mix(placed, TARGETS, REST, "mix_lane", "mix_position")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_pii,
        op3_minhash,
        op4_language,
        op5_syncmers,
        op6_warc,
        op7_decontamination,
        op8_mixing,
        op9_urls,
        op10_toxicity,
        op11_licenses,
        op12_hard_negatives,
        op13_spelling,
    )
}
