"""Rules the browser applies before it sends: shape, gate, buffer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.layout import PLAIN, SEG, SessionLayout

# Fields each event type carries beyond the five that all carry.
_COMMON = {"event_type", "timestamp", "event_timestamp", "ts_us", "event_id", "session_id",
           "user_id", "mouse_click_count"}
_CART = ["cart_value", "product_count", "product_quantities", "shipping_option_selected"]
_FIELDS = {
    "heartbeat": ["page", *_CART, "delivery_mode", "shipping_type", "shipping_cost", "mouse_x",
                  "mouse_y"],
    "page_view": ["page", *_CART],
    "add_to_cart": ["product_id", "category", "price", *_CART],
    "remove_from_cart": _CART,
    "start_checkout": ["page", *_CART],
    "purchase": [*_CART, "payment_method_selected"],
    "abandon": [*_CART, "abandon_reason"],
    "view_product": ["product_id", "category", "price"],
    "accept_offer": ["retention_type"],
    "reject_offer": ["retention_type"],
}
_CHOICE_TYPES = ("heartbeat", "page_view", "add_to_cart", "remove_from_cart")


def shape_events(df: DataFrame) -> DataFrame:
    """Null every field that an event's type does not carry.

    Pickup replaces the shipping option on cart events, a checkout start is on
    the checkout page, and a purchase without a method is by credit card.
    """
    kind = F.col("event_type")
    fixed = df.withColumns(
        {
            "shipping_option_selected": F.when(
                kind.isin(*_CHOICE_TYPES) & (F.col("delivery_mode") == "store"), "store"
            ).otherwise(F.col("shipping_option_selected")),
            "page": F.when(kind == "start_checkout", "checkout").otherwise(F.col("page")),
            "payment_method_selected": F.when(
                kind == "purchase", F.coalesce("payment_method_selected", F.lit("credit_card"))
            ),
        }
    )
    out = []
    for name in fixed.columns:
        owners = [t for t, fields in _FIELDS.items() if name in fields]
        col = F.col(name)
        if name not in _COMMON and name != "device":
            col = F.when(kind.isin(*owners), col).alias(name) if owners else F.lit(None).cast(
                fixed.schema[name].dataType
            ).alias(name)
        out.append(col)
    return fixed.select(*out)


def is_tracked(hidden: Column | None = None) -> Column:
    """Tracked page, something in the cart, tab visible."""
    ok = F.col("page").isin(*S.TRACKED_PAGES) & (F.col("product_count") > 0)
    ok = F.coalesce(ok, F.lit(False))
    return ok if hidden is None else ok & ~F.coalesce(hidden, F.lit(False))


def tracking_gate(df: DataFrame, hidden: Column | None = None) -> DataFrame:
    return df.filter(is_tracked(hidden))


def buffer_flush(
    df: DataFrame,
    layout: SessionLayout = PLAIN,
    limit: int = S.BUFFER_LIMIT,
    hidden: Column | None = None,
) -> DataFrame:
    """Every event that gets sent, with ``sent_us``.

    Tracked events go at once.  The others wait for the next tracked event; of
    each wait only the newest ``limit`` go, and a wait that never ends is lost.
    Release and place in the wait both come from one pass from the end of the session.
    """
    tracked = F.col("_tracked")
    rows = df.withColumn("_tracked", is_tracked(hidden))
    rows = layout.running_sum(rows, True, _later=(~tracked).cast("bigint"))
    release = F.struct("ts_us", "_later")
    rows = layout.running_last(rows, True, _release=F.when(tracked, release)).drop(SEG)
    waited = F.col("_later") - F.col("_release")["_later"]
    return (
        rows.filter(tracked | (waited <= limit))
        .withColumns({"sent_us": F.col("_release")["ts_us"], "buffered": ~tracked})
        .drop("_tracked", "_later", "_release")
    )
