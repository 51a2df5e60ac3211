"""Intake of requests from tables or streams of API calls and chat messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMMAND_SIGN = "/"


def api_requests(calls: DataFrame, *keep: str) -> DataFrame:
    """API calls `type, text`."""
    return calls.select("type", "text", *keep)


def chat_requests(messages: DataFrame, *keep: str) -> DataFrame:
    """Chat messages with a text that is no command, as requests without a type."""
    said = messages.filter(F.col("text").isNotNull() & ~F.col("text").startswith(COMMAND_SIGN))
    return said.select(F.lit(None).cast("string").alias("type"), "text", *keep)
