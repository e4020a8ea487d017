"""Silver layer: pointer motion per heartbeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.functions import scalar as X
from cartwake.layout import PLAIN, SessionLayout


def motion_columns(df: DataFrame, w, whole_seconds: bool) -> DataFrame:
    """Motion of each row against the row before it in window ``w``.

    The first row of a sequence has no predecessor: it stands still for one
    heartbeat interval, and so counts as idle and as dwell.
    """
    lag = lambda c: F.lag(c).over(w)
    gap = X.whole_seconds if whole_seconds else X.exact_seconds
    zero = F.lit(0.0)
    lagged = df.withColumns(
        {
            "dx": F.coalesce(F.col("mouse_x") - lag("mouse_x"), zero),
            "dy": F.coalesce(F.col("mouse_y") - lag("mouse_y"), zero),
            "delta_time_s": X.gap_or_default(gap(lag("ts_us"), F.col("ts_us"))),
            "cart_delta": F.coalesce(F.col("cart_value") - lag("cart_value"), zero),
            "shipping_changed": F.coalesce(
                F.col("shipping_option_selected") != lag("shipping_option_selected"), F.lit(False)
            ).cast("bigint"),
        }
    )
    dx, dy = F.col("dx"), F.col("dy")
    moved = lagged.withColumn("mouse_distance", F.sqrt(dx * dx + dy * dy)).withColumn(
        "velocity_px_s", X.velocity(F.col("mouse_distance"), F.col("delta_time_s"))
    )
    v = F.col("velocity_px_s")
    ms = F.col("delta_time_s") * 1000
    return (
        moved.withColumn("acceleration_px_s2", F.coalesce(v - F.lag(v).over(w), zero))
        .withColumns(
            {
                "is_idle": v < S.IDLE_VELOCITY,
                "is_exit_intent": X.exit_intent(F.col("mouse_y"), v),
                "is_dwell": (dx == 0) & (dy == 0),
            }
        )
        .withColumns(
            {
                "idle_ms_segment": F.when(F.col("is_idle"), ms).otherwise(zero),
                "dwell_ms_segment": F.when(F.col("is_dwell"), ms).otherwise(zero),
            }
        )
    )


def silver(
    bronze: DataFrame, layout: SessionLayout = PLAIN, whole_seconds: bool = True
) -> DataFrame:
    """One row per heartbeat with its motion.

    Durations are whole seconds by default, so gaps under a second take the
    heartbeat interval; ``whole_seconds=False`` keeps the exact gap.
    """
    beats = layout.look_back(bronze.filter(F.col("event_type") == "heartbeat"), 2)
    moved = motion_columns(beats, layout.window(), whole_seconds)
    return layout.settle(moved).drop("_seg")
