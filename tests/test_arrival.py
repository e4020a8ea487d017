import random

import pytest
from helpers import SMALL, same
from pyspark.sql import functions as F

from cartwake.layout import profile_sessions
from cartwake.operators import arrival as A
from cartwake.operators import replay as R
from cartwake.queries.base import SplitTables, late_clicks


def brute(rows, items):
    """rows: (session, event_id, ts_us, event_type) in order of arrival."""
    stored, out = {}, {}
    for session, event, us, kind in rows:
        of = stored.setdefault(session, {})
        if us is not None:
            of[us] = (event, kind)
        newest = sorted(of.items(), reverse=True)[:items]
        offers = [{"accept_offer": "accepted", "reject_offer": "rejected"}.get(k) for _, (_, k) in newest]
        beats = sorted(u for u, (_, k) in newest if k == "heartbeat")
        out[session, event] = (len(beats), next((o for o in offers if o), None), beats)
    return out


@pytest.fixture(scope="module")
def shuffled():
    """Late events, repeated instants, offers that are overwritten, times and sessions that lack."""
    dice = random.Random(4)
    kinds = ["heartbeat"] * 6 + ["accept_offer", "reject_offer", "page_view"]
    rows = []
    for event in range(1500):
        session = dice.choice(["hot", "hot", "hot", "a", "b", None])
        us = None if dice.random() < 0.02 else dice.randrange(event // 2 + 1, event + 40) * 1000
        rows.append((session, event, us, dice.choice(kinds)))
    return rows


def clicks(spark, rows):
    df = spark.createDataFrame(rows, "session_id string, event_id long, ts_us long, event_type string")
    return df.withColumns(
        {c: F.lit(None).cast(k) for c, k in (
            ("mouse_x", "double"), ("mouse_y", "double"), ("cart_value", "double"), ("product_quantities", "map<string,bigint>"),
            ("shipping_option_selected", "string"), ("mouse_click_count", "bigint"), ("page", "string"))}
    ).repartition(5)


@pytest.mark.parametrize("items", [1, 7, 150])
@pytest.mark.parametrize("split", [False, True])
def test_equals_a_store_that_is_asked_after_each_arrival(spark, shuffled, items, split):
    df = clicks(spark, shuffled)
    layout = A.BY_EVENT
    if split:
        layout = profile_sessions(df, hot_rows=100, segment_rows=30, fraction=1.0, order=("event_id",))
        assert layout.hot
    got = A.with_arrived_history(df, layout, items).select(
        "session_id", "event_id", "history_beats", "offer_state", F.transform("history", lambda h: h["us"]).alias("us")
    )
    found = {(r[0], r[1]): (r[2], r[3], r[4]) for r in got.collect()}
    assert found == brute(shuffled, items)


def test_in_order_arrival_is_the_plain_history(spark, tables):
    plain = R.enrich(R.upserted(tables.carts)).drop("history")
    arrived = A.enrich_arrived(R.upserted(tables.carts), A.SessionLayout(order=("ts_us", "event_id"))).drop("history")
    assert arrived.where("status = 'scored'").count() > 100
    same(arrived.select(*plain.columns), plain)


def test_batches_that_cut_a_session(spark, shuffled):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = A.with_arrived_history(clicks(spark, shuffled), items=20, arrays=False).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {(r.session_id, r.event_id): (r.history_beats, r.offer_state) for r in got} == {k: v[:2] for k, v in brute(shuffled, 20).items()}


def test_no_task_holds_a_hot_session(spark):
    tables = SplitTables(spark, SMALL)
    assert tables.late_layout.hot and tables.long_layout.hot
    plan = A.with_arrived_history(late_clicks(tables.carts), tables.late_layout)._jdf.queryExecution().toString()
    assert "_seg" in plan and "Join" in plan


def test_no_rows(spark):
    assert A.with_arrived_history(clicks(spark, [("a", 1, 1, "heartbeat")]).where("event_id > 1")).count() == 0


@pytest.mark.parametrize("split", [False, True])
def test_history_of_chosen_fields_sends_no_others(spark, shuffled, split):
    df = clicks(spark, shuffled)
    layout = profile_sessions(df, hot_rows=100, segment_rows=30, fraction=1.0, order=("event_id",)) if split else A.BY_EVENT
    narrow = df.select("session_id", "event_id", "ts_us", "event_type")
    got = A.with_arrived_history(narrow, layout, 20, fields=("us",)).select("session_id", "event_id", "history_beats", "offer_state", "history")
    assert got.schema["history"].dataType.simpleString() == "array<struct<us:bigint>>"
    found = {(r[0], r[1]): (r[2], r[3], [h["us"] for h in r[4]]) for r in got.collect()}
    assert found == brute(shuffled, 20)


def test_lists_of_segments_hold_items_alone(spark):
    tables = SplitTables(spark, SMALL)
    plan = A.with_arrived_history(late_clicks(tables.carts), tables.late_layout)._jdf.queryExecution().executedPlan().toString()
    merge = next(line for line in plan.split("\n") if "FlatMapGroupsInArrow" in line)
    assert "event_timestamp" not in merge and "_late_item" in merge
