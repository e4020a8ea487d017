"""Online, historical and replay features on small literal sessions."""

import datetime as dt

import pytest
from helpers import same
from pyspark.sql import functions as F

from cartwake.functions.history import add_history_features
from cartwake.operators import historical as H
from cartwake.operators import online as O
from cartwake.operators import replay as R

TYPES = (
    "session_id string, event_id bigint, ts_us bigint, event_timestamp timestamp_ntz, event_type string, "
    "user_id string, device string, mouse_x double, mouse_y double, cart_value double, product_count bigint, "
    "product_quantities map<string,bigint>, product_id string, shipping_option_selected string, mouse_click_count bigint, "
    "page string, payment_method_selected string, abandon_reason string, payment_method string"
)
START = dt.datetime(2026, 7, 24, 18, 30)


def event(n, s, x=0.0, y=0.0, kind="heartbeat", value=0.0, qty=None, ship="standard", clicks=0,
          page="cart", method=None, product=None, session="a"):
    us = round(s * 1_000_000)
    return (session, n, us, START + dt.timedelta(microseconds=us), kind, "u", "desktop", float(x),
            float(y), float(value), 1, qty or {}, product, ship, clicks, page, method, None, None)


@pytest.fixture
def table(spark):
    return lambda *rows: spark.createDataFrame(list(rows), TYPES)


def path(*xs, y=0, step=1.0):
    return [event(i, i * step, x, y) for i, x in enumerate(xs)]


def test_dwell_segments(table):
    still = [event(i, i * 0.25, 100, 100) for i in range(3)] + [event(3, 0.75, 200, 200)]
    rows = O.dwell_segments(table(*still)).collect()
    assert [(r["start_us"], r["end_us"], r["still_count"]) for r in rows] == [(250_000, 500_000, 2)]
    assert O.dwell_segments(table(*path(0, 10, 20))).count() == 0


def test_open_run_counts_online_and_not_historically(table):
    df = table(event(0, 0, 5), event(1, 1, 9), event(2, 2, 9), event(3, 4, 9))
    online = O.session_features(df).first()
    assert (online["dwell_total_ms"], online["dwell_segments"]) == (2000, 2)
    past = H.session_features(df).first()
    assert (past["dwell_total_ms"], past["dwell_segments"]) == (0, 0)
    closed = H.session_features(table(*[event(0, 0, 5), event(1, 1, 9), event(2, 2, 9), event(3, 4, 9), event(4, 5, 1)])).first()
    assert (closed["dwell_total_ms"], closed["dwell_segments"]) == (3000, 1)


def test_distance_idle_and_too_few(table):
    assert O.session_features(table(event(0, 0), event(1, 1, 3, 4), event(2, 2, 6, 8))).first()["distance_total"] == 10.0
    idle = O.session_features(table(*path(50, 50, 50))).first()
    assert idle["idle_total_ms"] == 2000
    assert O.session_features(table(event(0, 0))).count() == 0
    assert O.all_features(table(event(0, 0))).count() == 0


@pytest.mark.parametrize("xs, trend", [
    ((0, 10, 15, 18, 20, 21), "decreasing"), ((0, 1, 3, 6, 10, 15), "increasing"), ((0, 5, 10, 15), "stable")])
def test_trend(table, xs, trend):
    assert O.session_features(table(*path(*xs))).first()["velocity_trend"] == trend


def test_zero_gap_takes_the_heartbeat_interval(table):
    row = O.session_features(table(event(0, 1), event(1, 1, 3, 4))).first()
    assert row["velocity_avg"] == 20.0


def test_cart_change(table):
    df = table(event(0, 0, value=100, qty={"prod_001": 1}),
               event(1, 1, value=150, qty={"prod_001": 1, "prod_002": 1}))
    row = O.cart_features(df).first()
    assert row["cart_delta"] == 50.0 and row["product_additions"] == {"prod_002": 1}
    assert row["product_removals"] == {}
    alone = O.cart_features(table(event(0, 0, value=5))).first()
    assert alone["cart_delta"] == 0.0 and alone["shipping_switches"] == 0
    ships = [event(i, i, ship=s) for i, s in enumerate(("standard", "express", "standard"))]
    assert O.cart_features(table(*ships)).first()["shipping_switches"] == 2


def test_funnel(table):
    back = [event(i, i, page=p) for i, p in enumerate(("checkout", "cart", "checkout"))]
    assert O.funnel_features(table(*back)).first()["page_regression_count"] == 1
    pay = [event(i, s, page="checkout", method=m) for i, (s, m) in enumerate(((0, None), (3, None), (5, "credit_card")))]
    row = O.funnel_features(table(*pay)).first()
    assert row["payment_hesitation_ms"] == 5000 and row["payment_method_switches"] == 1
    assert O.funnel_features(table(*pay), ignore_nulls=True).first()["payment_method_switches"] == 0
    gap = [event(0, 0, page="checkout"), event(1, 1, page=None), event(2, 2, page="cart")]
    assert O.funnel_features(table(*gap)).first()["page_regression_count"] == 1


@pytest.mark.parametrize("values, want", [("aaa", 0), ("abb", 1), ("abac", 3), ("a", 0)])
def test_value_changes(table, values, want):
    df = table(*[event(i, i, page=v) for i, v in enumerate(values)])
    assert O.value_changes(df, "page").first()["change_count"] == want


def test_value_changes_counts_nulls(table):
    df = table(*[event(i, i, method=v) for i, v in enumerate((None, "x", None))])
    assert O.value_changes(df, "payment_method_selected").first()["change_count"] == 2


def test_window_edges(table):
    one = O.window_features(table(event(0, 0))).first()
    assert one["window_5s"] is None
    df = table(*[event(i, s, s) for i, s in enumerate((0, 5, 9, 10))])
    row = O.window_features(df).first()
    assert row["window_5s"]["heartbeat_count"] == 3  # 5 s is on the edge
    assert row["window_10s"]["heartbeat_count"] == 4
    counts = [row[f"window_{s}s"]["heartbeat_count"] for s in (5, 10, 30)]
    assert counts == sorted(counts)
    # the pair 0 -> 5 starts before the edge, so it is not part of the window
    assert row["window_5s"]["velocity_avg"] == 1.0


def test_all_features_groups(table):
    df = table(*path(0, 3, 9), event(9, 3, kind="start_checkout", page="checkout", method="paypal"))
    row = O.all_features(df).first()
    assert row["heartbeat_count"] == 3 and row["window_30s"]["heartbeat_count"] == 3
    assert row["page_regression_count"] == 0 and row["payment_method_switches"] == 0


def test_historical_gap_cap_and_tallies(table):
    df = table(event(0, 0), event(1, 20, 3, 4), event(2, 21, kind="add_to_cart", product="p1"),
               event(3, 22, kind="remove_from_cart", product="p1"), event(4, 23, kind="add_to_cart"),
               event(5, 24, kind="abandon"))
    row = H.session_rows(df).first()
    assert row["velocity_avg"] == 20.0  # 5 px over a quarter second
    assert row["product_additions"] == '{"p1":1,"unknown":1}' and row["product_removals"] == '{"p1":1}'
    assert row["abandoned"] == 1 and row["session_duration_s"] == 24.0
    few = H.session_rows(table(event(0, 0), event(1, 1, kind="add_to_cart", product="p"))).first()
    assert few["velocity_avg"] is None and few["product_additions"] == "{}"


def test_first_terminal_wins(table):
    df = table(event(0, 0, kind="purchase"), event(1, 1, kind="abandon"))
    assert H.terminal_labels(df).first()["terminal"] == "purchase"
    assert H.terminal_labels(table(event(0, 0))).first()["terminal"] is None


def test_history_arrays_equal_windows(tables):
    """The array form at the last event equals the grouped form of the session."""
    beats = tables.carts.filter("event_type = 'heartbeat'")
    rows = R.with_history(beats, items=10_000)
    last = R.newest_items(rows, 1)
    arrays = add_history_features(last, newest_first_funnel=False)
    whole = O.all_features(beats.withColumn("payment_method_selected", F.lit(None).cast("string")))
    names = ["velocity_avg", "velocity_std", "acceleration_max", "idle_total_ms", "distance_total",
             "velocity_trend", "exit_intent_count", "dwell_total_ms", "dwell_segments",
             "click_frequency", "cart_delta", "shipping_switches", "page_regression_count",
             "payment_hesitation_ms"]
    same(arrays.select("session_id", *names), whole.select("session_id", *names))
    for s in (5, 10, 30):
        same(arrays.select("session_id", f"window_{s}s.velocity_avg", f"window_{s}s.total_clicks", f"window_{s}s.idle_ratio"),
             whole.select("session_id", f"window_{s}s.velocity_avg", f"window_{s}s.total_clicks", f"window_{s}s.idle_ratio"))


def test_funnel_of_newest_first_history(table):
    pages = ("cart", "checkout", "cart", "cart")
    rows = R.with_history(table(*[event(i, i, page=p) for i, p in enumerate(pages)]))
    last = rows.filter("event_id = 3")
    back = add_history_features(last, newest_first_funnel=False).first()
    forward = add_history_features(last).first()
    # checkout -> cart once in time order; cart -> checkout once newest first
    assert back["page_regression_count"] == 1 and forward["page_regression_count"] == 1
    first = R.with_history(table(*[event(i, i, page=p) for i, p in enumerate(("checkout", "cart"))]))
    only = add_history_features(first.filter("event_id = 1")).first()
    assert only["page_regression_count"] == 1  # the event after the oldest page
