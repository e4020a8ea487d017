"""Column functions for time, motion and funnel arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwake import schema as S

MICROS = 1_000_000


def strict_timestamp(text: Column) -> Column:
    """Naive timestamp from ISO text that ends in ``Z``; anything else is null."""
    return F.when(
        text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,9})?Z$"),
        text.try_cast("timestamp_ntz"),
    )


def naive_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a naive timestamp."""
    return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01'"), ts)


def naive_timestamp(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, F.expr("timestamp_ntz'1970-01-01'"))


def any_timestamp_us(text: Column) -> Column:
    """Epoch microseconds from ISO text with any offset, or from epoch seconds.

    Epoch seconds may come as an integer, a decimal or their text.  Words that
    Spark would read as a time (``yesterday``) are not times here.
    """
    seconds = F.when(text.rlike(r"^\s*-?\d+(\.\d+)?([eE][+-]?\d+)?\s*$"), text.try_cast("double"))
    return F.when(
        seconds.isNotNull(), F.round(seconds * MICROS).cast("bigint")
    ).when(text.rlike(r"^\d{4}-\d\d-\d\d"), F.unix_micros(text.try_cast("timestamp")))


def whole_seconds(start_us: Column, end_us: Column) -> Column:
    """Difference in whole seconds, truncated toward zero."""
    return _div(end_us - start_us, MICROS)


def exact_seconds(start_us: Column, end_us: Column) -> Column:
    return (end_us - start_us) / F.lit(float(MICROS))


def truncated_ms(seconds: Column) -> Column:
    """Milliseconds of a double number of seconds, cut like an integer cast."""
    return (seconds * F.lit(1000.0)).cast("bigint")


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def floor_div(a: Column, b: int) -> Column:
    """Quotient rounded down, also for negative numbers."""
    return _div(a - F.pmod(a, F.lit(b).cast("bigint")), b)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x2 - x1, y2 - y1
    return F.sqrt(dx * dx + dy * dy)


def velocity(dist: Column, dt_s: Column) -> Column:
    return F.when(dt_s > 0, dist / dt_s).otherwise(F.lit(0.0))


def acceleration(v1: Column, v2: Column, dt_s: Column) -> Column:
    return F.when(dt_s > 0, (v2 - v1) / dt_s).otherwise(F.lit(0.0))


def idle_time(v: Column, dt_ms: Column, threshold: float = S.IDLE_VELOCITY) -> Column:
    return F.when(v < threshold, dt_ms).otherwise(F.lit(0))


def exit_intent(
    y: Column, v: Column, y_bound: float = S.EXIT_Y_BOUND, v_bound: float = S.EXIT_VELOCITY
) -> Column:
    return (y < y_bound) & (v > v_bound)


def click_frequency(clicks: Column, prev_clicks: Column, dt_s: Column) -> Column:
    gained = clicks - prev_clicks
    return F.when((dt_s > 0) & (gained >= 0), gained / dt_s).otherwise(F.lit(0.0))


def gap_or_default(
    dt: Column, default: float = S.HEARTBEAT_S, longest: float | None = None
) -> Column:
    """``dt`` where it is positive (and not above ``longest``), else ``default``."""
    usable = dt > 0
    if longest is not None:
        usable = usable & (dt <= longest)
    return F.when(usable, dt.cast("double")).otherwise(F.lit(default))


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` where ``b`` is positive, else 0."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def trend_vote(v: Column, prev: Column) -> Column:
    """-1, 0 or 1 against the previous velocity; null without one."""
    return (
        F.when(v < prev * S.TREND_DOWN, F.lit(-1))
        .when(v > prev * S.TREND_UP, F.lit(1))
        .when(prev.isNotNull(), F.lit(0))
    )


def trend_name(balance: Column) -> Column:
    """Name of a trend from ups minus downs (or any signed measure)."""
    return (
        F.when(balance < 0, F.lit("decreasing"))
        .when(balance > 0, F.lit("increasing"))
        .otherwise(F.lit("stable"))
    )


def slope_name(slope: Column, limit: float = S.SLOPE_LIMIT) -> Column:
    return (
        F.when(slope < -limit, F.lit("decreasing"))
        .when(slope > limit, F.lit("increasing"))
        .otherwise(F.lit("stable"))
    )


def changed(a: Column, b: Column) -> Column:
    """Null-safe inequality."""
    return ~a.eqNullSafe(b)


def date_path(ts: Column) -> Column:
    return F.date_format(ts, "yyyy/MM/dd")
