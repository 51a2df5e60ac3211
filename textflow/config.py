"""Options of a deployment, as plain values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Topics:
    """Names of the three message topics."""

    requests: str = "requests"
    to_enrich: str = "processRequest"
    enriched: str = "processResponse"


@dataclass(frozen=True)
class Options:
    brokers: str
    store_path: str
    topics: Topics = Topics()
    starting_offsets: str = "latest"
