"""Clickstream and cart-abandonment analytics as Spark DataFrame operators."""
