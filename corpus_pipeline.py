"""From raw documents to shards: language, near-duplicates, benchmark passages, mix of sources, placement.

Each stage takes `(spark, docs, sf_dir)` and returns what the next one works on; it is written as Parquet and
read again in between. All stages but the last return the columns they were given. The last one's rows are in the
order of the mix and are not written, as reading files again would not keep it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textflow.llm import queries
from textflow.llm.tables import table, written

STAGES = [
    ("language", queries.keep_known_language),
    ("near_duplicates", queries.keep_one_of_near_duplicates),
    ("decontamination", queries.keep_without_benchmark),
    ("mixing", queries.order_by_mix),
    ("sharding", queries.place_on_shards),
]

# Learned languages and minima of hashes have no SQL form; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that all stages kept, with `slot` and `shard`, in the order of the mix."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
