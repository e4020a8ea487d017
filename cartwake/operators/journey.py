"""Measures described in the design notes of the source system: interaction
rate, categories, entry and exit, waiting time, a rule score, offer rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwake.functions import scalar as X
from cartwake.layout import PLAIN, SEG, SessionLayout
from cartwake.operators.online import at

# Signal weights of the rule score, its threshold and limits.
RULE_WEIGHTS = {
    "slowing": 0.25,
    "idle": 0.25,
    "regressions": 0.20,
    "switches": 0.15,
    "exits": 0.10,
    "removals": 0.05,
}
RULE_THRESHOLD = 0.50
RULE_IDLE_SHARE = 0.30
RULE_COUNT = 2


def interaction_frequency(df: DataFrame) -> DataFrame:
    """Events other than heartbeats per minute of session."""
    n = F.count_if(F.col("event_type") != "heartbeat")
    seconds = X.exact_seconds(F.min("ts_us"), F.max("ts_us"))
    return df.groupBy("session_id").agg(
        n.alias("interactions"), (X.ratio(n, seconds) * 60).alias("interactions_per_minute")
    )


def categories_viewed(df: DataFrame, category: str = "product_category") -> DataFrame:
    seen = F.when(F.col("event_type") == "view_product", F.col(category))
    return df.groupBy("session_id").agg(F.count_distinct(seen).alias("categories_viewed"))


def predominant_category(df: DataFrame, category: str = "product_category") -> DataFrame:
    """Most frequent category of a session; the first by name on a tie."""
    counts = (
        df.filter(F.col(category).isNotNull())
        .groupBy("session_id", category)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("session_id").agg(
        F.min_by(category, F.struct((-F.col("n")).alias("n"), F.col(category))).alias("category"),
        F.max("n").alias("event_count"),
    )


def entry_exit(df: DataFrame) -> DataFrame:
    """First and last page and event type of each session."""
    return df.groupBy("session_id").agg(
        F.min_by("page", at()).alias("entry_page"),
        F.max_by("page", at()).alias("exit_page"),
        F.min_by("event_type", at()).alias("first_event"),
        F.max_by("event_type", at()).alias("last_event"),
    )


def event_sequence(df: DataFrame, layout: SessionLayout = PLAIN) -> DataFrame:
    """Event types in order, one row per step, so a session may be of any length."""
    rows = layout.running_sum(df, step=F.lit(1)).drop(SEG)
    return rows.select("session_id", F.col("step").cast("bigint").alias("step"), "event_type")


def terminal_gap(df: DataFrame, layout: SessionLayout = PLAIN) -> DataFrame:
    """Time from the event before the first purchase or abandon to it."""
    w = layout.window()
    rows = layout.look_back(df, 1).withColumn("_before", F.lag("ts_us").over(w))
    rows = layout.settle(rows).filter(F.col("event_type").isin("purchase", "abandon"))
    first = rows.groupBy("session_id").agg(
        F.min_by(F.struct("event_type", "ts_us", "_before"), at()).alias("t")
    )
    return first.select(
        "session_id",
        F.col("t.event_type").alias("terminal"),
        (F.col("t.ts_us") - F.col("t._before")).alias("gap_us"),
    )


def added_viewed_ratio(df: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    adds, views = F.count_if(kind == "add_to_cart"), F.count_if(kind == "view_product")
    return df.groupBy("session_id").agg(
        adds.alias("added"), views.alias("viewed"),
        F.try_divide(adds, views).alias("added_to_viewed"),
    )


def cart_page_time(df: DataFrame) -> DataFrame:
    """Time from the first cart page to the first checkout page after it."""
    cart = F.min(F.when(F.col("page") == "cart", F.col("ts_us")))
    checkout = F.min(F.when(F.col("page") == "checkout", F.col("ts_us")))
    return df.groupBy("session_id").agg(
        F.when(checkout >= cart, checkout - cart).alias("cart_to_checkout_us")
    )


def idle_share(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "session_id", X.ratio(F.col("total_idle_ms"), F.col("session_duration_s") * 1000)
        .alias("idle_share"),
    )


def rule_score(
    trend: Column, idle: Column, regressions: Column, switches: Column, exits: Column,
    removals: Column, additions: Column,
) -> Column:
    """Weighted sum of six abandonment signals."""
    signals = {
        "slowing": trend == "decreasing",
        "idle": idle > RULE_IDLE_SHARE,
        "regressions": regressions >= RULE_COUNT,
        "switches": switches >= RULE_COUNT,
        "exits": exits >= RULE_COUNT,
        "removals": removals > additions,
    }
    total = F.lit(0.0)
    for name, on in signals.items():
        total = total + F.when(on, RULE_WEIGHTS[name]).otherwise(0.0)
    return F.round(total, 2)


def earlier_offer(
    probability: Column, delivery_mode: Column, shipping_cost: Column, shipping_type: Column,
    threshold: float = 0.7,
) -> Column:
    """The first offer rules: free shipping, express upgrade, else a coupon."""
    offer = (
        F.when((delivery_mode == "shipping") & (shipping_cost > 0), "shipping_discount")
        .when(shipping_type == "standard", "express_upgrade")
        .otherwise("coupon")
    )
    return F.when(probability > threshold, offer)
