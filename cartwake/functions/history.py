"""Online features of a bounded history held in one array column.

``history`` is an array of at most 150 heartbeats in time order, each a struct
``us, x, y, value, quantities, ship, clicks, page``.  The replay and the stream
both end in such an array, so both use these expressions and stay in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.functions import maps as M
from cartwake.functions import scalar as X

ITEM = (
    "struct<us:bigint,x:bigint,y:bigint,value:double,quantities:map<string,bigint>,"
    "ship:string,clicks:bigint,page:string>"
)


def item(fields: tuple[str, ...] | None = None) -> Column:
    """A heartbeat as it is kept in history, pointer in whole pixels; only ``fields`` if given."""
    known = _fields()
    return F.struct(*[known[f].alias(f) for f in fields or known])


def _fields() -> dict[str, Column]:
    whole = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint"))
    return {
        "us": F.col("ts_us"),
        "x": whole("mouse_x"),
        "y": whole("mouse_y"),
        "value": F.coalesce("cart_value", F.lit(0.0)),
        "quantities": F.coalesce("product_quantities", F.from_json(F.lit("{}"), S.QUANTITIES)),
        "ship": F.coalesce("shipping_option_selected", F.lit(S.DEFAULT_SHIPPING)),
        "clicks": whole("mouse_click_count"),
        "page": F.coalesce("page", F.lit("cart")),
    }


def _neighbours(a: Column, join) -> Column:
    """``join(older, newer)`` over adjacent elements; empty below two."""
    n = F.greatest(F.size(a) - 1, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(2), n), join)


def pair_between(a: Column, b: Column) -> Column:
    """Measures between a heartbeat and the next one."""
    raw = X.exact_seconds(a["us"], b["us"])
    dt = F.when(raw > 0, raw).otherwise(F.lit(S.HEARTBEAT_S))
    dist = X.distance(
        a["x"].cast("double"), a["y"].cast("double"), b["x"].cast("double"), b["y"].cast("double")
    )
    return F.struct(
        a["us"].alias("p_us"),
        b["us"].alias("us"),
        dt.alias("dt_s"),
        F.when(raw > 0, X.truncated_ms(raw)).otherwise(F.lit(250)).alias("dt_ms"),
        dist.alias("dist"),
        (dist / dt).alias("v"),
        ((a["x"] == b["x"]) & (a["y"] == b["y"])).alias("static"),
        b["y"].alias("y"),
        (a["ship"] != b["ship"]).alias("ship_changed"),
    )


def _total(a: Column, of, zero: Column) -> Column:
    return F.aggregate(a, zero, lambda acc, e: acc + of(e))


def _count(a: Column, where) -> Column:
    return F.size(F.filter(a, where)).cast("bigint")


def _stats(values: str) -> tuple[Column, Column, Column]:
    """Mean, maximum and sample deviation of an array column, zero where undefined.

    ``<values>_mean`` holds its mean (see ``_mean``).
    """
    a, mean = F.col(values), F.col(f"{values}_mean")
    n, zero = F.size(a), F.lit(0.0)
    squares = F.aggregate(a, zero, lambda acc, v: acc + (v - mean) * (v - mean))
    return (
        F.when(n > 0, mean).otherwise(zero),
        F.when(n > 0, F.array_max(a)).otherwise(zero),
        F.when(n > 1, F.sqrt(squares / (n - 1))).otherwise(zero),
    )


def _mean(values: str) -> Column:
    a = F.col(values)
    return F.try_divide(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v), F.size(a))


def _dwell_ms(pairs: Column) -> Column:
    no_start = F.lit(None).cast("bigint")

    def length(start: Column, end: Column) -> Column:
        return F.coalesce(X.truncated_ms(X.exact_seconds(start, end)), F.lit(0).cast("bigint"))

    def step(a: Column, p: Column) -> Column:
        return F.struct(
            F.when(p["static"], F.coalesce(a["start"], p["us"])).otherwise(no_start).alias("start"),
            p["us"].alias("last"),
            (
                a["total"]
                + F.when(p["static"], F.lit(0).cast("bigint")).otherwise(
                    length(a["start"], p["p_us"])
                )
            ).alias("total"),
        )

    first = F.struct(
        no_start.alias("start"), no_start.alias("last"), F.lit(0).cast("bigint").alias("total")
    )
    return F.aggregate(pairs, first, step, lambda a: a["total"] + length(a["start"], a["last"]))


def _since(a: Column, field: str, edge: Column) -> Column:
    return F.filter(a, lambda e: e[field] >= edge)


def _window(seconds: int) -> Column:
    """Measures of a trailing window, from its heartbeats and pairs."""
    inside, moved = F.col(f"_in_{seconds}"), F.col(f"_moved_{seconds}")
    n = F.size(inside)
    avg, top, std = _stats(f"_v_{seconds}")
    clicks = F.element_at(inside, -1)["clicks"] - F.element_at(inside, 1)["clicks"]
    return F.when(
        n >= 2,
        F.struct(
            avg.alias("velocity_avg"),
            top.alias("velocity_max"),
            std.alias("velocity_std"),
            F.greatest(clicks, F.lit(0)).alias("total_clicks"),
            (_count(moved, lambda p: p["static"]) / n).alias("idle_ratio"),
            n.cast("bigint").alias("heartbeat_count"),
        ),
    )


def change_between(a: Column, b: Column) -> Column:
    """Change from a pair to the next one."""
    return F.struct(
        ((b["v"] - a["v"]) / b["dt_s"]).alias("acc"),
        X.trend_vote(b["v"], a["v"]).alias("vote"),
    )


def _later(a: Column, first: int) -> Column:
    """The elements from the ``first`` on."""
    return F.slice(a, F.lit(first), F.greatest(F.size(a) - (first - 1), F.lit(0)))


def add_history_features(
    df: DataFrame, history: str = "history", newest_first_funnel: bool = True, measured: bool = False
) -> DataFrame:
    """Add the online features of ``history`` and of the event on the row.

    The funnel walks the heartbeats and then the row's own event.  History is
    served newest first, so by default it counts moves from cart to checkout;
    ``newest_first_funnel=False`` walks in time order and counts returns.
    Everything is null where history has fewer than two heartbeats.
    With ``measured`` the columns ``_pairs`` and ``_changes`` hold, for each heartbeat of
    history, its pair with the one before and that pair's change.
    """
    h = F.col(history)
    zero = F.lit(0.0)
    rows = df.withColumn(history, F.when(F.size(h) >= 2, h))
    if measured:
        known = F.col(history).isNotNull()
        rows = rows.withColumns(
            {
                "_pairs": F.when(known, _later(F.col("_pairs"), 2)),
                "_changes": F.when(known, _later(F.col("_changes"), 3)),
            }
        )
    else:
        rows = rows.withColumn("_pairs", _neighbours(h, pair_between))
        rows = rows.withColumn("_changes", _neighbours(F.col("_pairs"), change_between))
    pairs = F.col("_pairs")
    changes = F.col("_changes")
    # Arrays that several measures share become columns, so each is made once.
    shared = {
        "_v": pairs["v"],
        "_acc": changes["acc"],
    }
    newest = F.element_at(h, -1)["us"]
    for s in S.WINDOWS_S:
        edge = newest - s * X.MICROS
        shared[f"_in_{s}"] = _since(h, "us", edge)
        shared[f"_moved_{s}"] = _since(pairs, "p_us", edge)
    rows = rows.withColumns(shared)
    rows = rows.withColumns(
        {f"_v_{s}": F.col(f"_moved_{s}")["v"] for s in S.WINDOWS_S}
    )
    averaged = ["_v", "_acc", *[f"_v_{s}" for s in S.WINDOWS_S]]
    rows = rows.withColumns({f"{c}_mean": _mean(c) for c in averaged})
    v_avg, v_max, v_std = _stats("_v")
    a_avg, a_max, _ = _stats("_acc")
    first, last, prev = F.element_at(h, 1), F.element_at(h, -1), F.element_at(h, -2)

    page, method = F.col("page"), F.col("payment_method_selected")
    steps = _neighbours(
        h, lambda a, b: F.struct(a["page"].alias("older"), b["page"].alias("newer"))
    )
    before, after = ("newer", "older") if newest_first_funnel else ("older", "newer")
    neighbour = first["page"] if newest_first_funnel else last["page"]
    moves = _count(steps, lambda s: (s[after] == "cart") & (s[before] == "checkout"))
    own_move = F.coalesce((page == "cart") & (neighbour == "checkout"), F.lit(False))
    at_checkout = F.filter(h, lambda e: e["page"] == "checkout")["us"]
    own_us = F.when(page == "checkout", F.col("ts_us"))
    hesitation = X.exact_seconds(
        F.least(F.array_min(at_checkout), own_us), F.greatest(F.array_max(at_checkout), own_us)
    )
    switched = own_us.isNotNull() & (F.size(at_checkout) > 0) & method.isNotNull()

    features = {
        "velocity_avg": v_avg,
        "velocity_max": v_max,
        "velocity_std": v_std,
        "acceleration_avg": a_avg,
        "acceleration_max": a_max,
        "idle_total_ms": _total(
            F.filter(pairs, lambda p: p["v"] < S.IDLE_VELOCITY),
            lambda p: p["dt_ms"],
            F.lit(0).cast("bigint"),
        ),
        "distance_total": _total(pairs, lambda p: p["dist"], zero),
        "velocity_trend": X.trend_name(_total(changes, lambda c: c["vote"], F.lit(0))),
        "exit_intent_count": _count(pairs, lambda p: X.exit_intent(p["y"], p["v"])),
        "dwell_total_ms": _dwell_ms(pairs),
        "dwell_segments": _count(pairs, lambda p: p["static"]),
        "click_frequency": X.click_frequency(
            last["clicks"], first["clicks"], X.exact_seconds(first["us"], last["us"])
        ),
        "cart_delta": last["value"] - prev["value"],
        "product_removals": M.quantity_drop(prev["quantities"], last["quantities"]),
        "product_additions": M.quantity_rise(prev["quantities"], last["quantities"]),
        "shipping_switches": _count(pairs, lambda p: p["ship_changed"]),
        "page_regression_count": moves + own_move.cast("bigint"),
        "payment_hesitation_ms": F.coalesce(
            X.truncated_ms(hesitation), F.lit(0).cast("bigint")
        ),
        "payment_method_switches": switched.cast("bigint"),
        **{f"window_{s}s": _window(s) for s in S.WINDOWS_S},
    }
    known = h.isNotNull()
    helpers = ["_pairs", "_changes", *shared, *averaged, *[f"{c}_mean" for c in averaged]]
    return rows.withColumns({n: F.when(known, c) for n, c in features.items()}).drop(*helpers)
