"""History of each event as of its arrival.

Two orders at once: an event sees the newest 150 items by event time of all that arrived
before it, items of later times included, and so may not see itself when it is late.  A
session is cut into segments by arrival.  A segment's newest 150 items are a bounded list;
the lists of the segments before, merged, are what a segment starts from, and every segment
is then walked on its own with no more than 150 items in memory.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from cartwake import schema as S
from cartwake.functions.history import ITEM, add_history_features, item
from cartwake.layout import SEG, SessionLayout
from cartwake.operators.replay import explicit_offer, gate

#: Events in the order in which they arrived, sessions undivided.
BY_EVENT = SessionLayout(order=("event_id",))

_OWN = ("_late_beat", "_late_offer", "_late_item", "_late_entry")
#: Events whose histories are put together at a time.
_ROWS = 256


class _Newest:
    """The newest items of one session: sorted instants and places of their rows, also of
    the heartbeats alone."""

    def __init__(self, most: int):
        self.most = most
        self.us: list[int] = []
        self.at: list[int] = []
        self.offers: list[tuple[int, str]] = []
        self.beat_us: list[int] = []
        self.beat_at = array("q")

    def put(self, us: int, at: int, beat: list[bool], offer: list[str | None]) -> None:
        """Store an item; a later write of an instant replaces the earlier one."""
        i = bisect_left(self.us, us)
        if i < len(self.us) and self.us[i] == us:
            self._forget(i, beat, offer)
        elif len(self.us) == self.most and i == 0:
            return
        self.us.insert(i, us)
        self.at.insert(i, at)
        if beat[at]:
            b = bisect_left(self.beat_us, us)
            self.beat_us.insert(b, us)
            self.beat_at.insert(b, at)
        if offer[at]:
            self.offers.insert(bisect_left(self.offers, (us, "")), (us, offer[at]))
        if len(self.us) > self.most:
            self._forget(0, beat, offer)

    def _forget(self, i: int, beat: list[bool], offer: list[str | None]) -> None:
        us, at = self.us.pop(i), self.at.pop(i)
        if beat[at]:
            b = bisect_left(self.beat_us, us)
            self.beat_us.pop(b)
            self.beat_at.pop(b)
        if offer[at]:
            self.offers.pop(bisect_left(self.offers, (us, "")))


def with_arrived_history(
    df: DataFrame, layout: SessionLayout = BY_EVENT, items: int = S.HISTORY_ITEMS, arrays: bool = True,
    fields: tuple[str, ...] | None = None,
) -> DataFrame:
    """Add ``history_beats``, ``offer_state`` and (with ``arrays``) ``history`` as of arrival.

    ``fields`` names the fields of an item that history carries, all by default; only the
    columns behind them must be there.

    ``layout`` orders a session by arrival (its order names each row of a session once) and
    says which sessions are walked in segments.  An event without a time is not stored and
    sees what is there.  Events without a session are one session.
    """
    rows = layout.split(df.withColumns({
        "_late_beat": F.col("event_type") == "heartbeat",
        "_late_offer": explicit_offer(),
        "_late_item": item(fields) if arrays else F.lit(None).cast(ITEM),
        "_late_entry": F.lit(False),
    }))
    if not layout.hot:
        rows = rows.withColumn(SEG, F.lit(0))
    else:
        # What is stored of an event that came before is its item; the rest of it is not sent again.
        rows = rows.unionByName(_entries(rows, layout, items), allowMissingColumns=True)
    order = [F.col(layout.key), SEG, F.col("_late_entry").desc(), *layout.order]
    walked = rows.repartition(layout.key, SEG).sortWithinPartitions(*order)

    names = [c for c in rows.columns if c not in (*_OWN, SEG)]
    added = StructType.fromDDL("history_beats bigint, offer_state string").fields
    if arrays:
        added.append(StructField("history", ArrayType(rows.schema["_late_item"].dataType)))
    schema = StructType([rows.schema[n] for n in names] + added)
    key = layout.key

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, newest = None, _Newest(items)
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            # Rows of stored items come first, so that places name both kinds.
            pool = table.select(["_late_item", "_late_beat", "_late_offer"])
            start = held.num_rows if held is not None else 0
            pool = pa.concat_tables([held, pool]).combine_chunks() if start else pool.combine_chunks()
            beat = [bool(b) for b in pool.column("_late_beat").to_pylist()]
            offer = pool.column("_late_offer").to_pylist()
            told: list[int] = []
            beats, states, ends, flat = [], [], [0], array("q")

            def result() -> pa.RecordBatch:
                out = table.select(names).take(pa.array(told, pa.int64()))
                columns = [*out.columns, pa.array(beats, pa.int64()), pa.array(states, pa.string())]
                if arrays:
                    found = pool.column("_late_item").combine_chunks().take(pa.array(np.array(flat, dtype=np.int64)))
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found))
                return pa.Table.from_arrays(columns, [f.name for f in schema]).combine_chunks().to_batches()[0]

            places = zip(*(table.column(c).to_pylist() for c in (key, SEG, "ts_us", "_late_entry")))
            for i, (session, seg, us, entry) in enumerate(places):
                if (session, seg) != place:
                    place, newest = (session, seg), _Newest(items)
                if us is not None:
                    newest.put(us, start + i, beat, offer)
                if entry:
                    continue
                told.append(i)
                beats.append(len(newest.beat_us))
                states.append(newest.offers[-1][1] if newest.offers else None)
                if arrays:
                    flat.extend(newest.beat_at)
                    ends.append(len(flat))
                if len(told) == _ROWS:
                    yield result()
                    told, beats, states, ends, flat = [], [], [], [0], array("q")
            if told:
                yield result()
            held = pool.take(pa.array(newest.at, pa.int64()))
            newest.beat_at = array("q", [i for i, at in enumerate(newest.at) if beat[at]])
            newest.at = list(range(len(newest.at)))

    return walked.mapInArrow(walk, schema)


def _entries(rows: DataFrame, layout: SessionLayout, items: int) -> DataFrame:
    """The newest items before each segment of a hot session, marked ``_late_entry``.

    A session sends ``items`` rows a segment, of them what ``_OWN`` and the order need; one
    task merges a session's lists in order.
    """
    kept = dict.fromkeys([layout.key, SEG, "ts_us", *layout.order, "_late_beat", "_late_offer", "_late_item"])
    parts = rows.where((F.col(SEG) > 0) & F.col("ts_us").isNotNull()).select(*kept).repartition(layout.key, SEG)
    last = Window.partitionBy(layout.key, SEG, "ts_us").orderBy(*[F.col(c).desc() for c in layout.order])
    newest = Window.partitionBy(layout.key, SEG).orderBy(F.col("ts_us").desc())
    lists = parts.withColumn("_n", F.row_number().over(last)).where("_n = 1")
    lists = lists.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= items).drop("_n")

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by(SEG)
        seg, us = group.column(SEG).to_pylist(), group.column("ts_us").to_pylist()
        stored: dict[int, int] = {}
        taken, to, i = [], [], 0
        while i < len(seg):
            taken += stored.values()
            to += [seg[i]] * len(stored)
            first = i
            while i < len(seg) and seg[i] == seg[first]:
                stored[us[i]] = i
                i += 1
            stored = dict(sorted(stored.items())[-items:])
        out = group.take(pa.array(taken, pa.int64()))
        return out.set_column(out.schema.get_field_index(SEG), SEG, pa.array(to, pa.int32()))

    found = lists.groupBy(layout.key).applyInArrow(merge, lists.schema)
    return found.withColumn("_late_entry", F.lit(True))


def enrich_arrived(
    df: DataFrame, layout: SessionLayout = BY_EVENT, warmup: int = S.WARMUP_HEARTBEATS, items: int = S.HISTORY_ITEMS
) -> DataFrame:
    """Online features of every event that reaches scoring, from its history as of arrival."""
    rows = with_arrived_history(df, layout, items).withColumn("status", gate(warmup))
    rows = rows.withColumn("history", F.when(F.col("status") == "scored", F.col("history")))
    return add_history_features(rows).withColumn(
        "heartbeat_count", F.when(F.col("history").isNotNull(), F.col("history_beats"))
    )
