"""Registry of named queries: a Spark callable and, where SQL can say it, the
DuckDB text that must give the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwake.layout import SessionLayout, profile_sessions
from cartwake.operators.replay import upserted
from cartwake.sources.click_view import click_view, read_events, with_quantities

_LAYOUTS: dict[tuple, SessionLayout] = {}


def on_workers(spark: SparkSession) -> None:
    """Let Python workers of this machine import the package from where the driver did.

    On a cluster the package is installed or sent along; then this changes nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    own = spark.sparkContext.environment
    have = own.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        own["PYTHONPATH"] = os.pathsep.join([root, *filter(None, have)])


class Tables:
    """Inputs of a query: the click view of one table folder and its layout."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        on_workers(spark)
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def clicks(self) -> DataFrame:
        return click_view(read_events(self.spark, self.sf_dir))

    @cached_property
    def carts(self) -> DataFrame:
        return with_quantities(self.clicks)

    @cached_property
    def long_clicks(self) -> DataFrame:
        return long_sessions(self.clicks)

    @cached_property
    def long_carts(self) -> DataFrame:
        return long_sessions(self.carts)

    def _layout(self, order: tuple[str, ...]) -> SessionLayout:
        # Like table statistics: profiled once per table folder and reused.
        place = (self.spark.sparkContext.applicationId, self.sf_dir, order)
        if place not in _LAYOUTS:
            _LAYOUTS[place] = profile_sessions(self.clicks, order=order)
        return _LAYOUTS[place]

    @property
    def long_layout(self) -> SessionLayout:
        place = (self.spark.sparkContext.applicationId, self.sf_dir, "long")
        if place not in _LAYOUTS:
            _LAYOUTS[place] = profile_sessions(long_instants(self.clicks))
        return _LAYOUTS[place]

    @cached_property
    def split_layout(self) -> SessionLayout:
        """A layout in which every session of more than 40 events is split, as only sessions
        of millions are by default."""
        return profile_sessions(self.clicks, hot_rows=40, segment_rows=16, fraction=1.0)

    @cached_property
    def long_split_layout(self) -> SessionLayout:
        return profile_sessions(long_instants(self.clicks), hot_rows=40, segment_rows=200, fraction=1.0)

    @property
    def layout(self) -> SessionLayout:
        return self._layout(("ts_us", "event_id"))

    @property
    def late_layout(self) -> SessionLayout:
        """Long sessions by the time at which their events arrived."""
        place = (self.spark.sparkContext.applicationId, self.sf_dir, "late")
        if place not in _LAYOUTS:
            _LAYOUTS[place] = profile_sessions(late_clicks(self.clicks), order=LATE_ORDER)
        return _LAYOUTS[place]

    @cached_property
    def late_split_layout(self) -> SessionLayout:
        return profile_sessions(late_clicks(self.clicks), hot_rows=40, segment_rows=200, fraction=1.0, order=LATE_ORDER)

    @property
    def arrival(self) -> SessionLayout:
        return self._layout(("event_id",))


# Sessions of the click view are short; those of so many users, one after another, pass every
# bound of the history, and their number grows with the users.
USERS_A_SESSION = 20
USER_US = 70_000_000
USER_CLICKS = 234


def as_long_sessions(df: DataFrame) -> DataFrame:
    """Users of the click view, some twenty to a session, each after the one before."""
    user = F.substring("user_id", 2, 20).cast("bigint")
    group = F.call_function("div", user, F.lit(USERS_A_SESSION))
    later = user % USERS_A_SESSION * USER_US
    return df.withColumns(
        {
            "session_id": F.concat(F.lit("s"), group.cast("string")),
            "ts_us": F.col("ts_us") + later,
            "mouse_click_count": F.col("mouse_click_count") + user % USERS_A_SESSION * USER_CLICKS,
            "event_timestamp": F.timestamp_add("MICROSECOND", later, F.col("event_timestamp")),
        }
    )


def long_sessions(df: DataFrame) -> DataFrame:
    """The long sessions with one event per instant."""
    return upserted(as_long_sessions(df))


def long_instants(df: DataFrame) -> DataFrame:
    """Session and instant of each of their events: all that a profile reads."""
    return as_long_sessions(df).select("session_id", "ts_us").distinct()


LATE_ORDER = ("arrived_us", "event_id")


def late_clicks(df: DataFrame) -> DataFrame:
    """Long sessions whose events arrive up to 20 s late, so out of order; instants repeat."""
    rows = as_long_sessions(df)
    rows = rows.withColumn("arrived_us", F.col("ts_us") + F.col("event_id") * 7919 % 1009 * 20_000)
    return rows.withColumn("ts_us", F.col("ts_us") - F.col("ts_us") % 50_000)


class SplitTables(Tables):
    """The same tables with sessions split that are ordinary by default."""

    @property
    def layout(self) -> SessionLayout:
        return self.split_layout

    @property
    def long_layout(self) -> SessionLayout:
        return self.long_split_layout

    @property
    def late_layout(self) -> SessionLayout:
        return self.late_split_layout


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, places: int = 4, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every double so that summation order does not show."""
    out: list[Column] = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind == "double" and name not in skip:
            c = (F.round(c, places) + F.lit(0.0)).alias(name)
        out.append(c)
    return df.select(*out)


CLICK = """
b as (
  select event_id, user_id as uid, event_type as et, value,
         cast(round(value * 100) as bigint) as cents,
         cast(json_extract_string(props, '$.k') as bigint) as k,
         (epoch_us(ts) - epoch_us(timestamp '2024-01-01 00:00:00')) // 40000 as ts_us
  from events),
click as (
select event_id, 's' || cast(uid as varchar) as session_id, 'u' || cast(uid as varchar) as user_id,
  ts_us, make_timestamp(epoch_us(timestamp '2024-01-01 00:00:00') + ts_us) as event_timestamp,
  case when et = 'purchase' and k >= 96 then 'purchase' when et = 'error' and k >= 94 then 'abandon'
       when et = 'signup' and k < 25 then 'start_checkout' when et = 'view' and k < 30 then 'view_product'
       when et = 'view' and k >= 85 then 'add_to_cart' when et = 'view' and k >= 75 then 'remove_from_cart'
       else 'heartbeat' end as event_type,
  case when (k // 10) % 5 < 2 then 'cart' when (k // 10) % 5 < 4 then 'checkout' else 'catalog' end as page,
  case when uid % 20 < 13 then 'desktop' when uid % 20 < 18 then 'mobile' else 'tablet' end as device,
  case when k % 4 = 0 then 500.0::double else ((k * 37) % 1920)::double end as mouse_x,
  case when k % 4 = 0 then 350.0::double else (cents % 1080)::double end as mouse_y,
  value as cart_value, 1 + k % 6 as product_count,
  'prod_' || lpad(cast(1 + k % 15 as varchar), 3, '0') as product_id, 1 + k % 3 as qty,
  ts_us // 300000 as mouse_click_count,
  case when k % 5 = 0 then 'express' else 'standard' end as shipping_option_selected,
  case when k % 7 = 0 then 'store' else 'shipping' end as delivery_mode,
  case when k % 3 = 0 then 'credit_card' when k % 3 = 1 then 'debit_card' end as payment_method_selected
from b)"""

_USER = "cast(substr(user_id, 2) as bigint)"
AS_LONG = f"""'s' || ({_USER} // {USERS_A_SESSION}) as session_id, ts_us + {_USER} % {USERS_A_SESSION} * {USER_US} as ts_us,
    mouse_click_count + {_USER} % {USERS_A_SESSION} * {USER_CLICKS} as mouse_click_count,
    event_timestamp + to_microseconds({_USER} % {USERS_A_SESSION} * {USER_US}) as event_timestamp"""

LONG = CLICK + f""",
longer as (
  select * from (select * replace ({AS_LONG}) from click)
  qualify row_number() over (partition by session_id, ts_us order by event_id desc) = 1)"""

SILVER = CLICK + """,
lagged as (
  select *, lag(mouse_x) over w as px, lag(mouse_y) over w as py, lag(ts_us) over w as pt,
         lag(cart_value) over w as pc, lag(shipping_option_selected) over w as ps
  from click where event_type = 'heartbeat'
  window w as (partition by session_id order by ts_us, event_id)),
moved as (
  select * exclude (px, py, pt, pc, ps),
         coalesce(mouse_x - px, 0.0) as dx, coalesce(mouse_y - py, 0.0) as dy,
         case when (ts_us - pt) // 1000000 > 0 then ((ts_us - pt) // 1000000)::double else 0.25::double end as delta_time_s,
         coalesce(cart_value - pc, 0.0) as cart_delta,
         coalesce(shipping_option_selected != ps, false)::bigint as shipping_changed
  from lagged),
fast as (
  select *, sqrt(dx * dx + dy * dy) as mouse_distance,
         sqrt(dx * dx + dy * dy) / delta_time_s as velocity_px_s from moved),
silver as (
  select *,
    coalesce(velocity_px_s - lag(velocity_px_s) over (partition by session_id order by ts_us, event_id), 0.0) as acceleration_px_s2,
    velocity_px_s < 5.0 as is_idle,
    mouse_y < 100 and velocity_px_s > 200.0 as is_exit_intent,
    dx = 0 and dy = 0 as is_dwell,
    case when velocity_px_s < 5.0 then delta_time_s * 1000 else 0.0 end as idle_ms_segment,
    case when dx = 0 and dy = 0 then delta_time_s * 1000 else 0.0 end as dwell_ms_segment
  from fast)"""

BEATS = """
beats as (
  select session_id, min(ts_us) as first_us, max(ts_us) as last_us, count(*) as heartbeat_count,
    avg(velocity_px_s) as velocity_avg, max(velocity_px_s) as velocity_max,
    stddev_samp(velocity_px_s) as velocity_std,
    avg(acceleration_px_s2) as acceleration_avg, max(acceleration_px_s2) as acceleration_max,
    sum(idle_ms_segment) as total_idle_ms, sum(mouse_distance) as total_distance_px,
    count(*) filter (where is_exit_intent) as exit_intent_count,
    sum(dwell_ms_segment) as total_dwell_ms, count(*) filter (where is_dwell) as dwell_event_count,
    arg_max(mouse_click_count, ts_us) as last_click_count,
    arg_min(mouse_click_count, ts_us) as first_click_count,
    max(cart_value) as cart_value_max, avg(cart_value) as cart_value_avg,
    sum(cart_delta) as cart_delta_total, sum(shipping_changed)::bigint as shipping_switches
  from silver group by session_id),
beats2 as (
  select *, (last_us - first_us) // 1000000 as session_duration_s,
    greatest(last_click_count - first_click_count, 0) as total_clicks from beats),
beats3 as (
  select *, case when session_duration_s > 0 then total_clicks::double / session_duration_s else 0.0 end as click_frequency,
    case when session_duration_s > 0 then total_idle_ms / (session_duration_s * 1000) else 0.0 end as idle_ratio
  from beats2)"""

EVENTS = """
switched as (
  select *, coalesce(shipping_option_selected != lag(shipping_option_selected) over w, false)::bigint as ship_switch,
    coalesce(page = 'cart' and lag(page) over w = 'checkout', false)::bigint as page_regression
  from click window w as (partition by session_id order by ts_us, event_id)),
evs as (
  select session_id, count(*) as total_events, arg_min(device, ts_us) as device, arg_min(user_id, ts_us) as user_id,
    max(product_count) as product_count_max,
    count(*) filter (where event_type = 'add_to_cart') as add_to_cart_count,
    count(*) filter (where event_type = 'remove_from_cart') as remove_from_cart_count,
    count(*) filter (where event_type = 'start_checkout') as checkout_count,
    count(*) filter (where event_type = 'view_product') as view_product_count,
    bool_or(event_type = 'purchase') as has_purchase, bool_or(event_type = 'abandon') as has_abandon,
    sum(ship_switch)::bigint as shipping_switches_all, sum(page_regression)::bigint as page_regression_count
  from switched group by session_id),
pay as (
  select session_id, min(ts_us) as checkout_first_us, max(ts_us) as checkout_last_us
  from click where page = 'checkout' group by session_id)"""

GOLD = SILVER + "," + BEATS + "," + EVENTS + """,
gold as (
  select session_id, user_id, device,
    coalesce(heartbeat_count, 0) as heartbeat_count, coalesce(velocity_avg, 0) as velocity_avg,
    coalesce(velocity_max, 0) as velocity_max, coalesce(velocity_std, 0) as velocity_std,
    coalesce(acceleration_avg, 0) as acceleration_avg, coalesce(acceleration_max, 0) as acceleration_max,
    coalesce(total_idle_ms, 0) as total_idle_ms, coalesce(total_distance_px, 0) as total_distance_px,
    coalesce(exit_intent_count, 0) as exit_intent_count, coalesce(total_dwell_ms, 0) as total_dwell_ms,
    coalesce(dwell_event_count, 0) as dwell_event_count, coalesce(session_duration_s, 0) as session_duration_s,
    coalesce(click_frequency, 0) as click_frequency, coalesce(idle_ratio, 0) as idle_ratio,
    coalesce(cart_value_max, 0) as cart_value_max, coalesce(cart_value_avg, 0) as cart_value_avg,
    coalesce(cart_delta_total, 0) as cart_delta_total, coalesce(shipping_switches, 0) as shipping_switches,
    page_regression_count, shipping_switches_all, total_events, product_count_max, add_to_cart_count,
    remove_from_cart_count, checkout_count, view_product_count,
    coalesce((checkout_last_us - checkout_first_us) // 1000000 * 1000, 0) as payment_hesitation_ms,
    case when session_duration_s > 0 then total_events / session_duration_s::double * 60 else 0.0 end as events_per_minute,
    coalesce(total_clicks, 0) as total_clicks,
    has_purchase::bigint as has_purchase, has_abandon::bigint as has_abandon,
    (has_abandon and not has_purchase)::bigint as abandoned
  from evs left join beats3 using (session_id) left join pay using (session_id)
  where has_purchase or has_abandon)"""


def round_sql(columns: list[str], places: int = 4) -> str:
    return ", ".join(f"round({c}, {places}) + 0.0 as {c}" for c in columns)
