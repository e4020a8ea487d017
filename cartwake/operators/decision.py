"""From features to a model row and a retention decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwake import schema as S

# Fields of a scoring request with their types and defaults.
WINDOW_TYPE = (
    "struct<velocity_avg:double,velocity_max:double,velocity_std:double,"
    "total_clicks:bigint,idle_ratio:double,heartbeat_count:bigint>"
)
REQUEST_FIELDS = {
    "session_id": ("string", None),
    "user_id": ("string", None),
    "cart_value": ("double", 0.0),
    "product_count": ("bigint", 0),
    "product_quantities": ("map<string,bigint>", {}),
    "shipping_option_selected": ("string", "standard"),
    "delivery_mode": ("string", "shipping"),
    "shipping_type": ("string", "standard"),
    "shipping_cost": ("double", 0.0),
    "mouse_click_count": ("bigint", 0),
    "page": ("string", "cart"),
    "velocity_avg": ("double", 0.0),
    "velocity_max": ("double", 0.0),
    "velocity_std": ("double", 0.0),
    "acceleration_avg": ("double", 0.0),
    "acceleration_max": ("double", 0.0),
    "idle_seconds": ("double", 0.0),
    "distance_total": ("double", 0.0),
    "velocity_trend": ("string", "stable"),
    "exit_intent_count": ("bigint", 0),
    "dwell_seconds": ("double", 0.0),
    "dwell_segments": ("bigint", 0),
    "click_frequency": ("double", 0.0),
    "cart_delta": ("double", 0.0),
    "shipping_switches": ("bigint", 0),
    "page_regression_count": ("bigint", 0),
    "payment_hesitation_seconds": ("double", 0.0),
    "payment_method_switches": ("bigint", 0),
    "window_5s": (WINDOW_TYPE, None),
    "window_10s": (WINDOW_TYPE, None),
    "window_30s": (WINDOW_TYPE, None),
}
REQUIRED_REQUEST = ("session_id", "user_id")
# Request field -> feature measured in milliseconds.
SECONDS_OF = {
    "idle_seconds": "idle_total_ms",
    "dwell_seconds": "dwell_total_ms",
    "payment_hesitation_seconds": "payment_hesitation_ms",
}


def _typed(column: Column, kind: str, default) -> Column:
    if isinstance(default, dict):
        return F.coalesce(column, F.from_json(F.lit("{}"), S.QUANTITIES))
    return column if default is None else F.coalesce(column, F.lit(default).cast(kind))


def payload(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 31 fields of a scoring request; absent inputs take their default."""
    out = []
    for name, (kind, default) in REQUEST_FIELDS.items():
        if name in SECONDS_OF and SECONDS_OF[name] in df.columns:
            col = F.col(SECONDS_OF[name]) / 1000.0
        elif name in df.columns:
            col = F.col(name)
        else:
            col = F.lit(None).cast(kind)
        out.append(_typed(col, kind, default).alias(name))
    return df.select(*keep, *out)


def parse_requests(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed scoring requests from JSON text, with ``error`` for refused ones.

    A field may be absent and then takes its default.  A field that is present
    must convert to its type, and only a window may be null.
    """
    text = F.col(column)
    flat = {n: t for n, (t, _) in REQUEST_FIELDS.items() if not t.startswith(("map", "struct"))}
    nested = {n: t for n, (t, _) in REQUEST_FIELDS.items() if n not in flat}
    as_text = F.from_json(text, ", ".join(f"{n} string" for n in REQUEST_FIELDS))
    once = F.array(F.struct(F.json_object_keys(text).alias("_keys"), as_text.alias("_t")))
    rows = lines.select(text.alias("_text"), F.inline(once))
    parsed = {n: F.col(f"_t.{n}").try_cast(t) for n, t in flat.items()}
    parsed |= {n: F.from_json(F.col(f"_t.{n}"), t) for n, t in nested.items()}
    rows = rows.withColumns({f"_p_{n}": c for n, c in parsed.items()})
    wrong = []
    for name, (kind, _) in REQUEST_FIELDS.items():
        present = F.array_contains("_keys", name)
        null_ok = kind == WINDOW_TYPE
        bad = present & F.col(f"_p_{name}").isNull()
        if null_ok:
            bad = bad & F.col(f"_t.{name}").isNotNull()
        if name in REQUIRED_REQUEST:
            bad = bad | ~present
        wrong.append(F.when(bad, F.lit(name)))
    wrong_fields = F.filter(F.array(*wrong), lambda n: n.isNotNull())
    error = F.when(F.col("_keys").isNull(), F.lit("Invalid JSON")).when(
        F.size(wrong_fields) > 0,
        F.concat(F.lit("Invalid fields: "), F.array_join(wrong_fields, ", ")),
    )
    return rows.select(
        F.col("_text").alias("value"),
        error.alias("error"),
        *[_typed(F.col(f"_p_{n}"), t, d).alias(n) for n, (t, d) in REQUEST_FIELDS.items()],
    )


def model_row(requests: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Model columns of a request.

    A request describes one moment, so measures that only a finished session has
    are constants, and the device is always the default one.
    """
    ms = lambda c: F.col(c) * 1000
    given = {
        "total_idle_ms": ms("idle_seconds"),
        "total_distance_px": F.col("distance_total"),
        "total_dwell_ms": ms("dwell_seconds"),
        "dwell_event_count": F.col("dwell_segments"),
        "session_duration_s": F.lit(0.0),
        "idle_ratio": F.lit(0.0),
        "cart_value_max": F.col("cart_value"),
        "cart_value_avg": F.col("cart_value"),
        "cart_delta_total": F.col("cart_delta"),
        "heartbeat_count": F.lit(1),
        "total_events": F.lit(1),
        "product_count_max": F.col("product_count"),
        "add_to_cart_count": F.lit(0),
        "remove_from_cart_count": F.lit(0),
        "checkout_count": (F.col("page") == "checkout").cast("bigint"),
        "view_product_count": F.lit(0),
        "payment_hesitation_ms": ms("payment_hesitation_seconds"),
        "events_per_minute": F.lit(0.0),
        "total_clicks": F.col("mouse_click_count"),
        "device": F.lit(S.DEFAULT_DEVICE),
    }
    return requests.select(*keep, *[given.get(c, F.col(c)).alias(c) for c in S.MODEL_COLUMNS])


def backfill(
    df: DataFrame, columns: list[str] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``columns`` in order as doubles; absent, null or unreadable ones are zero."""
    names = columns or S.MODEL_NUMERIC
    have = set(df.columns)
    return df.select(
        *keep,
        *[
            (F.coalesce(F.col(n).try_cast("double"), F.lit(0.0)) if n in have else F.lit(0.0)).alias(n)
            for n in names
        ],
    )


def retention_type(shipping_type: Column) -> Column:
    return F.when(shipping_type == "express", "express_discount").otherwise("free_shipping")


def decide(
    df: DataFrame, probability: str = "probability", threshold: float = S.RETENTION_THRESHOLD
) -> DataFrame:
    """Probability to four places, whether to make an offer, and which.

    A row without a probability (scoring failed or was skipped) is neutral.
    """
    p = F.coalesce(F.col(probability), F.lit(0.0))
    trigger = p >= threshold
    return df.withColumns(
        {
            "abandon_probability": F.round(p, 4),
            "trigger_retention": trigger,
            "retention_type": F.when(trigger, retention_type(F.col("shipping_type"))),
        }
    )
