"""Keyed session state: the newest items of each session, with expiry.

The state function only stores and serves items: per batch it emits the stored items of a
session once, and its new events as they came.  Order, upserts, history frames, features,
scores and offers are DataFrame work on what it emits, shared with the batch replay, so nothing
depends on how the rows of a key are cut into frames.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cartwake import schema as S
from cartwake.operators.replay import gate, with_history

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

EVENT_COLUMNS = {
    "session_id": "string",
    "event_id": "bigint",
    "ts_us": "bigint",
    "event_type": "string",
    "user_id": "string",
    "mouse_x": "double",
    "mouse_y": "double",
    "cart_value": "double",
    "product_count": "bigint",
    "product_quantities": "string",
    "shipping_option_selected": "string",
    "delivery_mode": "string",
    "shipping_type": "string",
    "shipping_cost": "double",
    "mouse_click_count": "bigint",
    "page": "string",
    "payment_method_selected": "string",
}
_ADDED = {"is_new": "boolean", "seen": "bigint"}
#: What names an event; the rest goes through the state function as one text.
_NAMES = ("session_id", "event_id", "ts_us")
_REST = ", ".join(f"{n} {t}" for n, t in EVENT_COLUMNS.items() if n not in _NAMES)
_ITEM = "event_id bigint, rest string"
OUTPUT = "session_id string, event_id bigint, ts_us bigint, rest string, is_new boolean, seen bigint"

#: Instants of a key that are held before repeats among them are dropped.
_INSTANTS = 100_000


class SessionItems(StatefulProcessor):
    """Keeps the newest ``items`` of each session, each for ``ttl_s`` after it was written.

    The state is a map from instant to item and the number of instants seen; a batch writes
    the items that it adds and removes those that they push out, nothing else.  A later event
    of an instant replaces its item; of events of one batch the larger event_id counts.
    Memory holds ``items`` items twice and eight bytes for each event of the key in the batch.
    Rows are session, event_id and instant, then whatever is kept of the event with its id.
    """

    def __init__(self, items: int = S.HISTORY_ITEMS, ttl_s: int = S.STATE_TTL_S):
        self.most, self.ttl_ms = items, ttl_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.items = handle.getMapState("items", "ts_us bigint", _ITEM, self.ttl_ms)
        self.seen = handle.getValueState("seen", "instants bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:
        before = {us[0]: tuple(item) for us, item in self.items.iterator()}
        seen = self.seen.get()[0] if self.seen.exists() else 0
        first = next(rows)
        told = Row(*first.__fields__, *_ADDED)
        for us in sorted(before):
            item = before[us]
            yield told(key[0], item[0], us, *item[1:], False, seen)
        new: dict[int, tuple] = {}
        instants, recent = np.zeros(0, np.int64), []
        for r in chain([first], rows):
            us, item = r[2], (r[1], *r[3:])
            yield told(*r, True, seen)
            if us is None:
                continue
            if us not in new or (item[0] or 0) >= (new[us][0] or 0):
                new[us] = item
            if len(new) > 2 * self.most:
                new = dict(sorted(new.items())[-self.most :])
            if us not in before:
                recent.append(us)
            if len(recent) == _INSTANTS:
                instants, recent = np.union1d(instants, recent), []
        kept = set(sorted(before.keys() | new.keys())[-self.most :])
        for us in before.keys() - kept:
            self.items.removeKey((us,))
        for us in new.keys() & kept:
            self.items.updateValue((us,), new[us])
        self.seen.update((seen + len(np.union1d(instants, np.array(recent, np.int64))),))

    def close(self) -> None:
        pass


def with_session_items(
    events: DataFrame, items: int = S.HISTORY_ITEMS, ttl_s: int = S.STATE_TTL_S
) -> DataFrame:
    """A stream of typed events with the stored items of their sessions before them."""
    have = set(events.columns)
    rows = events.select(
        *[
            (F.col(n).cast(t) if n in have else F.lit(None).cast(t)).alias(n)
            for n, t in EVENT_COLUMNS.items()
        ]
    )
    # One text instead of some fourteen columns: Python converts each value of a row.
    rest = F.to_json(F.struct(*[n for n in rows.columns if n not in _NAMES])).alias("rest")
    kept = rows.select(*_NAMES, rest).groupBy("session_id").transformWithState(
        SessionItems(items, ttl_s), outputStructType=OUTPUT, outputMode="append", timeMode="processingTime"
    )
    return kept.select(*_NAMES, F.inline(F.array(F.from_json("rest", _REST))), *_ADDED)


def batch_history(
    batch: DataFrame, items: int = S.HISTORY_ITEMS, warmup: int = S.WARMUP_HEARTBEATS
) -> DataFrame:
    """New events of one batch with position, gate and history.

    Of events of one instant the last write counts, a new event before a stored one.
    """
    rest = [c for c in batch.columns if c not in ("session_id", "ts_us")]
    last = F.max_by(F.struct(*rest), F.struct("is_new", "event_id"))
    rows = batch.groupBy("session_id", "ts_us").agg(last.alias("_e"), F.min("is_new").alias("_adds"))
    rows = rows.select("session_id", "ts_us", "_e.*", "_adds")
    so_far = Window.partitionBy("session_id").orderBy("ts_us", "event_id").rowsBetween(
        Window.unboundedPreceding, 0
    )
    rows = rows.withColumns(
        {
            "position": F.col("seen") + F.sum(F.col("_adds").cast("bigint")).over(so_far),
            "product_quantities": F.from_json("product_quantities", S.QUANTITIES),
        }
    )
    rows = with_history(rows, items=items).withColumn("status", gate(warmup))
    rows = rows.withColumn("history", F.when(F.col("status") == "scored", F.col("history")))
    return rows.filter("is_new").drop("is_new", "seen", "_adds")
