"""Tables of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Session setting: the number of tasks over which inputs are dealt out. Not set, they keep the splits of their files.
INPUT_TASKS = "textflow.input.tasks"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by a unique key over as many tasks as the session's `textflow.input.tasks` says.

    Work inside a row keeps the partitions of its input, so one small file would keep one core busy. Dealing out
    shuffles whole texts; it is for small inputs on few machines, and off unless it is asked for.
    """
    tasks = rows.sparkSession.conf.get(INPUT_TASKS, None)
    return rows.repartition(int(tasks), key) if tasks else rows
