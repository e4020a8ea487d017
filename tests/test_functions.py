"""Scalar and map functions on literal values."""

import pytest
from pyspark.sql import functions as F

from cartwake.functions import maps as M
from cartwake.functions import scalar as X
from cartwake.operators import cart as C


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def num(v):
    return F.lit(float(v))


@pytest.mark.parametrize(
    "points, dt, want", [((0, 0, 3, 4), 1, 5.0), ((0, 0, 3, 4), 0, 0.0), ((0, 0, 3, 4), -1, 0.0)]
)
def test_velocity(spark, points, dt, want):
    d = X.distance(*[num(p) for p in points])
    assert value(spark, X.velocity(d, num(dt))) == want


def test_distance(spark):
    assert value(spark, X.distance(num(0), num(0), num(3), num(4))) == 5.0


@pytest.mark.parametrize("v1, v2, dt, want", [(10, 30, 2, 10.0), (10, 30, 0, 0.0)])
def test_acceleration(spark, v1, v2, dt, want):
    assert value(spark, X.acceleration(num(v1), num(v2), num(dt))) == want


@pytest.mark.parametrize("y, v, want", [(50, 300, True), (50, 10, False), (150, 300, False)])
def test_exit_intent(spark, y, v, want):
    assert value(spark, X.exit_intent(num(y), num(v))) is want


@pytest.mark.parametrize("now, before, dt, want", [(20, 10, 2, 5.0), (20, 10, 0, 0.0), (5, 10, 2, 0.0)])
def test_click_frequency(spark, now, before, dt, want):
    assert value(spark, X.click_frequency(F.lit(now), F.lit(before), num(dt))) == want


@pytest.mark.parametrize("v, want", [(4.9, 250), (5.0, 0)])
def test_idle_time(spark, v, want):
    assert value(spark, X.idle_time(num(v), F.lit(250))) == want


def quantities(**kv):
    return F.from_json(F.lit(str(kv).replace("'", '"')), "map<string,bigint>")


def test_quantity_changes(spark):
    drop = M.sorted_json(M.quantity_drop(quantities(a=3, b=1), quantities(a=1, b=1)))
    assert value(spark, drop) == '{"a":2}'
    none = M.sorted_json(M.quantity_drop(quantities(a=3), quantities(a=3)))
    assert value(spark, none) == "{}"
    rise = M.sorted_json(M.quantity_rise(quantities(a=1), quantities(a=2, b=1)))
    assert value(spark, rise) == '{"a":1,"b":1}'
    gone = M.sorted_json(M.quantity_drop(quantities(a=2), F.lit(None)))
    assert value(spark, gone) == '{"a":2}'


@pytest.mark.parametrize(
    "text, us",
    [
        ("2026-07-24T18:30:00Z", 1784917800000000),
        ("2026-07-24T18:30:00.250Z", 1784917800250000),
        ("2026-07-24T20:30:00.000001+02:00", 1784917800000001),
        ("1784917800", 1784917800000000),
        ("1784917800.5", 1784917800500000),
        ("yesterday", None),
        (None, None),
    ],
)
def test_any_timestamp(spark, text, us):
    assert value(spark, X.any_timestamp_us(F.lit(text).cast("string"))) == us


@pytest.mark.parametrize("text, ok", [
    ("2026-07-24T18:30:00.000Z", True), ("2026-07-24T18:30:00Z", True),
    ("2026-07-24T18:30:00+00:00", False), ("2026-07-24", False), ("2026-13-24T18:30:00Z", False)])
def test_strict_timestamp(spark, text, ok):
    assert (value(spark, X.strict_timestamp(F.lit(text))) is not None) is ok


@pytest.mark.parametrize("a, b, want", [(0, 900_000, 0), (900_000, 0, 0), (0, 2_500_000, 2), (0, -1_500_000, -1)])
def test_whole_seconds_cut_toward_zero(spark, a, b, want):
    assert value(spark, X.whole_seconds(F.lit(a).cast("bigint"), F.lit(b).cast("bigint"))) == want


@pytest.mark.parametrize("gap, longest, want", [
    (None, None, 0.25), (0.0, None, 0.25), (-1.0, None, 0.25), (2.0, None, 2.0), (11.0, 10.0, 0.25),
    (10.0, 10.0, 10.0)])
def test_gap_or_default(spark, gap, longest, want):
    assert value(spark, X.gap_or_default(F.lit(gap).cast("double"), longest=longest)) == want


@pytest.mark.parametrize("mode, kind, units, discount, cost, days", [
    ("store", "express", 3, None, 0.0, 0), ("shipping", "standard", 3, None, 12.0, 4),
    ("shipping", "express", 3, None, 36.0, 1), ("shipping", "express", 3, 24.0, 12.0, 1),
    ("shipping", "standard", 3, 50.0, 0.0, 4)])
def test_shipping(spark, mode, kind, units, discount, cost, days):
    less = None if discount is None else F.lit(discount)
    assert value(spark, C.shipping_cost(F.lit(units), F.lit(mode), F.lit(kind), less)) == cost
    assert value(spark, C.delivery_days(F.lit(mode), F.lit(kind))) == days


@pytest.mark.parametrize("offer, kind, want", [
    ("express_discount", "express", 24.0), ("free_shipping", "express", 36.0),
    ("free_shipping", "standard", 12.0), (None, "standard", 0.0)])
def test_offer_discount(spark, offer, kind, want):
    got = C.offer_discount(F.lit(offer).cast("string"), F.lit(3), F.lit(kind))
    assert value(spark, got) == want


def test_cart_totals(spark):
    carts = spark.createDataFrame(
        [("c", {"prod_001": 2, "prod_002": 1}), ("d", {"prod_005": 3})],
        "cart string, product_quantities map<string,bigint>",
    )
    products = C.catalogue(spark)
    got = {
        r["cart"]: (r["cart_value"], r["unit_count"], r["line_count"])
        for r in C.cart_totals(C.cart_lines(carts, ["cart"]), products, ["cart"]).collect()
    }
    assert got == {"c": (2485.0, 3, 2), "d": (285.0, 3, 1)}
    units = carts.select(C.map_units(F.col("product_quantities"))).collect()
    assert sorted(r[0] for r in units) == [3, 3]


def test_catalogues(spark):
    assert C.catalogue(spark).count() == 15 and C.catalogue(spark, store=True).count() == 20
    names = [r[0] for r in C.categories(C.catalogue(spark)).collect()]
    assert names == ["accesorios", "audio", "computacion", "muebles", "perifericos", "wearables"]
