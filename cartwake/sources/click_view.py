"""Click events derived from a generic ``events`` table.

One user is one session and time is compressed 40,000 times, so a month of
events becomes a minute-long session with about a second between heartbeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwake.functions.scalar import floor_div

EPOCH = "timestamp_ntz'2024-01-01 00:00:00'"
COMPRESSION = 40_000


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def click_view(events: DataFrame) -> DataFrame:
    uid, k = F.col("uid"), F.col("k")
    base = events.select(
        "event_id",
        F.col("user_id").alias("uid"),
        F.col("event_type").alias("et"),
        "value",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        floor_div(
            F.timestamp_diff("MICROSECOND", F.expr(EPOCH), F.col("ts")), COMPRESSION
        ).alias("ts_us"),
    )
    et = F.col("et")
    kind = (
        F.when((et == "purchase") & (k >= 96), "purchase")
        .when((et == "error") & (k >= 94), "abandon")
        .when((et == "signup") & (k < 25), "start_checkout")
        .when((et == "view") & (k < 30), "view_product")
        .when((et == "view") & (k >= 85), "add_to_cart")
        .when((et == "view") & (k >= 75), "remove_from_cart")
        .otherwise("heartbeat")
    )
    zone = floor_div(k, 10) % 5
    return base.select(
        "event_id",
        F.concat(F.lit("s"), uid.cast("string")).alias("session_id"),
        F.concat(F.lit("u"), uid.cast("string")).alias("user_id"),
        "ts_us",
        F.timestamp_add("MICROSECOND", F.col("ts_us"), F.expr(EPOCH)).alias("event_timestamp"),
        kind.alias("event_type"),
        F.when(zone < 2, "cart").when(zone < 4, "checkout").otherwise("catalog").alias("page"),
        F.when(uid % 20 < 13, "desktop").when(uid % 20 < 18, "mobile").otherwise("tablet")
        .alias("device"),
        F.when(k % 4 == 0, 500.0).otherwise(((k * 37) % 1920).cast("double")).alias("mouse_x"),
        F.when(k % 4 == 0, 350.0).otherwise((F.col("cents") % 1080).cast("double"))
        .alias("mouse_y"),
        F.col("value").alias("cart_value"),
        (1 + k % 6).alias("product_count"),
        F.concat(F.lit("prod_"), F.lpad((1 + k % 15).cast("string"), 3, "0")).alias("product_id"),
        (1 + k % 3).alias("qty"),
        floor_div(F.col("ts_us"), 300_000).alias("mouse_click_count"),
        F.when(k % 5 == 0, "express").otherwise("standard").alias("shipping_option_selected"),
        F.when(k % 7 == 0, "store").otherwise("shipping").alias("delivery_mode"),
        F.when(k % 3 == 0, "credit_card").when(k % 3 == 1, "debit_card")
        .alias("payment_method_selected"),
    )


def with_quantities(clicks: DataFrame) -> DataFrame:
    """Add the cart map ``{product_id: qty}``."""
    return clicks.withColumn(
        "product_quantities", F.create_map(F.col("product_id"), F.col("qty"))
    )


def raw_json(clicks: DataFrame) -> DataFrame:
    """One JSON text per event, as a browser would post it.

    Products, prices and reasons appear only on the event types that carry them;
    null fields are left out.
    """
    et = F.col("event_type")
    with_product = et.isin("add_to_cart", "view_product")
    fields = with_quantities(clicks).select(
        "event_id",
        "event_type",
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        "session_id", "user_id", "mouse_click_count", "device", "page", "cart_value",
        "product_count", "product_quantities", "shipping_option_selected", "delivery_mode",
        F.when(et == "heartbeat", F.col("mouse_x")).alias("mouse_x"),
        F.when(et == "heartbeat", F.col("mouse_y")).alias("mouse_y"),
        F.when(with_product, F.col("product_id")).alias("product_id"),
        F.when(with_product, F.lit("misc")).alias("category"),
        F.when(with_product, F.col("cart_value")).alias("price"),
        "payment_method_selected",
        F.when(et == "purchase", F.col("payment_method_selected")).alias("payment_method"),
        F.when((et == "abandon") & (F.col("product_count") > 2), F.lit("browsing"))
        .alias("abandon_reason"),
    )
    return fields.select(F.to_json(F.struct(*fields.columns)).alias("value"))
