"""Raw events to typed rows: parse, validate, type, deduplicate, flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.functions import scalar as X
from cartwake.layout import SessionLayout

def parse_events(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to the superset row type, with the text and its ``keys`` kept.

    The parsed value goes through ``inline`` so that each text is parsed once;
    a plain projection would be merged into its consumers and parse per field.
    """
    text = F.col(column)
    once = F.array(
        F.struct(
            F.from_json(text, S.RAW_EVENT).alias("event"),
            F.json_object_keys(text).alias("keys"),
        )
    )
    return lines.select(text.alias("value"), F.inline(once)).select("value", "keys", "event.*")


def _required(kind: Column, accept_selected_method: bool) -> Column:
    rules = F.create_map(
        *[
            part
            for name, keys in S.REQUIRED_KEYS.items()
            for part in (F.lit(name), F.array(*[F.lit(k) for k in keys]))
        ]
    )
    needed = F.try_element_at(rules, kind)
    if accept_selected_method:
        needed = F.transform(
            needed,
            lambda k: F.when(k == "payment_method", "payment_method_selected").otherwise(k),
        )
    return needed


def validate(events: DataFrame, accept_selected_method: bool = False) -> DataFrame:
    """Add ``error``: null for a valid event.

    Presence is checked on the keys of the JSON text, so an explicit null counts
    as present.  ``accept_selected_method`` takes ``payment_method_selected`` in
    place of the ``payment_method`` key that purchases are required to have.
    """
    kind = F.col("event_type")
    keys = F.col("keys")
    needed = _required(kind, accept_selected_method)
    missing = F.array_except(needed, keys)
    quoted = F.transform(missing, lambda k: F.concat(F.lit("'"), k, F.lit("'")))
    error = (
        F.when(keys.isNull(), F.lit("Invalid JSON"))
        .when(
            needed.isNull(),
            F.concat(F.lit("Invalid event_type: "), F.coalesce(kind, F.lit("None"))),
        )
        .when(
            F.size(missing) > 0,
            F.concat(
                F.lit("Missing required fields: ["), F.array_join(quoted, ", "), F.lit("]")
            ),
        )
    )
    return events.withColumn("error", error)


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("error").isNull()).drop("error", "keys")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("error").isNotNull()).select("value", "error")


def _or(column: str, kind: str, default) -> Column:
    return F.coalesce(F.col(column).try_cast(kind), F.lit(default)).alias(column)


def _or_whole(column: str) -> Column:
    """Whole number from text, also when it was written with a fraction."""
    c = F.col(column)
    whole = F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
    return F.coalesce(whole, F.lit(0)).alias(column)


def _time(online: bool) -> Column:
    """Naive time of an event.  Batch files end in ``Z``; online any offset will do."""
    text = F.col("timestamp")
    return X.naive_timestamp(X.any_timestamp_us(text)) if online else X.strict_timestamp(text)


def bronze(
    events: DataFrame, keep_bad_timestamps: bool = False, online: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Typed events with defaults and date parts, and the ``keep`` columns as they are.

    Rows whose timestamp does not parse are left out (``bad_timestamps`` returns
    them); set ``keep_bad_timestamps`` to keep them with a null time.
    """
    ts = _time(online)
    text = [
        "delivery_mode", "shipping_type", "payment_method_selected", "payment_method",
        "abandon_reason", "retention_type", "product_id", "category",
    ]
    numbers = {"shipping_cost": "double", "price": "double", "time_on_page": "bigint"}
    typed = events.select(
        *keep,
        F.coalesce(
            F.col("event_id").try_cast("bigint"), F.xxhash64("value")
        ).alias("event_id"),
        "event_type", "session_id", "user_id", "timestamp",
        ts.alias("event_timestamp"),
        X.naive_micros(ts).alias("ts_us"),
        _or("mouse_x", "double", 0.0),
        _or("mouse_y", "double", 0.0),
        _or("cart_value", "double", 0.0),
        _or_whole("product_count"),
        _or_whole("mouse_click_count"),
        _or("device", "string", S.DEFAULT_DEVICE),
        _or("page", "string", S.DEFAULT_PAGE),
        _or("shipping_option_selected", "string", S.DEFAULT_SHIPPING),
        _or("product_quantities", "string", "{}"),
        *text,
        *[F.col(n).try_cast(t).alias(n) for n, t in numbers.items()],
        F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
    )
    return typed if keep_bad_timestamps else typed.filter(F.col("event_timestamp").isNotNull())


def bad_timestamps(events: DataFrame, online: bool = False) -> DataFrame:
    return events.filter(_time(online).isNull()).select(
        "value", F.lit("Invalid timestamp").alias("error")
    )


def quantities(column: str = "product_quantities") -> Column:
    """The cart map held as JSON text by the typed layer."""
    return F.from_json(F.col(column), S.QUANTITIES)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the earliest by ``order``.

    A partial aggregate keeps one candidate per key and task before the shuffle,
    so a key with very many copies does not gather in one place.
    """
    return _pick(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the latest by ``order``: an upsert where later writes win."""
    return _pick(df, keys, order, F.max_by)


def _pick(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}") for c in rest])
        .select(*df.columns)
    )


def in_time_range(
    df: DataFrame, start_us: int | None = None, end_us: int | None = None, test_users=()
) -> DataFrame:
    """Drop events outside ``[start_us, end_us)`` and those of test users."""
    keep = F.lit(True)
    if start_us is not None:
        keep = keep & (F.col("ts_us") >= start_us)
    if end_us is not None:
        keep = keep & (F.col("ts_us") < end_us)
    if test_users:
        keep = keep & ~F.col("user_id").isin(*test_users)
    return df.filter(keep)


def quality_flags(
    df: DataFrame, arrival: SessionLayout, max_jump_px: float = 2000.0
) -> DataFrame:
    """Flag outlier jumps, negative amounts, a pointer at the origin, and events
    whose time is before that of the event that arrived just ahead of them.

    ``arrival`` is a layout ordered by a column that says when an event arrived, such as
    an ingest time or a sequence number; the time of the event itself will not do.
    """
    if set(arrival.order) & {"ts_us", "event_timestamp"}:
        raise ValueError("arrival order is needed, not the order of event times")
    w = arrival.window()
    rows = arrival.look_back(df, 1)
    x, y = F.col("mouse_x"), F.col("mouse_y")
    jump = X.distance(F.lag("mouse_x").over(w), F.lag("mouse_y").over(w), x, y)
    flagged = rows.withColumns(
        {
            "is_outlier": F.coalesce(jump > max_jump_px, F.lit(False)),
            "is_negative_value": F.col("cart_value") < 0,
            "is_origin_mouse": (x == 0) & (y == 0),
            "is_out_of_order": F.coalesce(
                F.lag("ts_us").over(w) > F.col("ts_us"), F.lit(False)
            ),
        }
    )
    return arrival.settle(flagged).drop("_seg")
