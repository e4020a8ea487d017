"""Queries whose plans change when a session is too large for one task, in that form.

A layout splits sessions of millions of events; here it splits those of a few dozen, so the
SQL comparison also sees the plans that carry values from segment to segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwake.queries.base import ORACLES, QUERIES, SplitTables, Tables, query

SPLIT = (
    "gold_sessions", "online_features", "session_rows", "buffer_flush", "warmup_gate", "history_180s",
    "replay_features", "offer_lifecycle", "arrived_history",
)


def _register(name: str) -> None:
    @query(f"{name}_split", ORACLES[name])
    def _run(t: Tables) -> DataFrame:
        return QUERIES[name](SplitTables(t.spark, t.sf_dir))


for _name in SPLIT:
    _register(_name)
