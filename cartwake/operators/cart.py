"""Cart economics: totals from lines, shipping, delivery, discounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwake import schema as S


def catalogue(spark: SparkSession, store: bool = False) -> DataFrame:
    """The product list (15 rows; 20 for the storefront's)."""
    return spark.createDataFrame(S.STORE_CATALOGUE if store else S.BATCH_CATALOGUE, S.CATALOGUE)


def with_product(df: DataFrame, products: DataFrame, keep_unknown: bool = True) -> DataFrame:
    """Name, price and category of each row's product.

    The catalogue is joined without a hint: Spark broadcasts it while its size is
    below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides beyond.
    """
    side = products.select(
        F.col("product_id"),
        F.col("name").alias("product_name"),
        F.col("price").alias("list_price"),
        F.col("category").alias("product_category"),
    )
    return df.join(side, "product_id", "left" if keep_unknown else "inner")


def products_in(products: DataFrame, category: str) -> DataFrame:
    return products.filter(F.col("category") == category)


def categories(products: DataFrame) -> DataFrame:
    return products.select("category").distinct().orderBy("category")


def cart_lines(df: DataFrame, keys: list[str], column: str = "product_quantities") -> DataFrame:
    """One row per product of each cart map."""
    return df.select(*keys, F.explode(column).alias("product_id", "qty"))


def cart_totals(lines: DataFrame, products: DataFrame, keys: list[str]) -> DataFrame:
    """Value, units, distinct lines and quantities of each cart.

    Quantities are summed per product first, so the map has one entry for each
    product of the cart however many lines it came from.
    """
    per_product = lines.groupBy(*keys, "product_id").agg(F.sum("qty").alias("qty"))
    return (
        with_product(per_product, products)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum(F.col("list_price") * F.col("qty")), F.lit(0.0)).alias("cart_value"),
            F.sum("qty").alias("unit_count"),
            F.count(F.lit(1)).alias("line_count"),
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("product_id", "qty")))).alias(
                "product_quantities"
            ),
        )
    )


def map_units(m: Column) -> Column:
    """Units in a cart map."""
    return F.aggregate(F.map_values(m), F.lit(0).cast("bigint"), lambda a, n: a + n)


def unit_rate(shipping_type: Column) -> Column:
    return F.when(shipping_type == "express", S.UNIT_SHIPPING * S.EXPRESS_FACTOR).otherwise(
        S.UNIT_SHIPPING
    )


def shipping_cost(
    units: Column, delivery_mode: Column, shipping_type: Column, discount: Column | None = None
) -> Column:
    """Per-unit rate, tripled for express, free for pickup, never below zero."""
    full = units * unit_rate(shipping_type)
    reduced = full if discount is None else full - discount
    return F.when(delivery_mode == "store", F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), reduced)
    )


def delivery_days(delivery_mode: Column, shipping_type: Column) -> Column:
    return (
        F.when(delivery_mode == "store", 0).when(shipping_type == "express", 1).otherwise(4)
    )


def offer_discount(retention_type: Column, units: Column, shipping_type: Column) -> Column:
    """What an accepted offer takes off the shipping cost."""
    standard = units * F.lit(S.UNIT_SHIPPING)
    return (
        F.when(retention_type == "express_discount", standard * (S.EXPRESS_FACTOR - 1))
        .when(retention_type == "free_shipping", units * unit_rate(shipping_type))
        .otherwise(F.lit(0.0))
    )


def order_total(subtotal: Column, shipping: Column) -> Column:
    return subtotal + shipping
