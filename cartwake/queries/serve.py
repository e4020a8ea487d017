"""Replay, payload and decision queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.functions import maps as M
from cartwake.operators import decision as D
from cartwake.operators import replay as R
from cartwake.operators.arrival import with_arrived_history
from cartwake.queries.base import (
    AS_LONG, CLICK, LONG, Tables, late_clicks, query, round_sql, rounded,
)
from cartwake.queries.online import (
    MOTION_DOUBLES, MOTION_WHOLE, WINDOW_DOUBLES, flat_windows,
)

# Some product views stand in for answers to an offer.
OFFERS = LONG + """,
ofr as (
  select * replace (case when event_type = 'view_product' and product_count = 1 then 'accept_offer'
                         when event_type = 'view_product' and product_count = 2 then 'reject_offer' else event_type end as event_type)
  from longer),
ev as (select *, row_number() over (partition by session_id order by ts_us, event_id) as rn from ofr),
gt as (
  select *, count(*) filter (where event_type = 'heartbeat') over f as history_beats,
    case last_value(case event_type when 'accept_offer' then 1 when 'reject_offer' then 2 end ignore nulls) over f
      when 1 then 'accepted' when 2 then 'rejected' end as offer_state
  from ev window f as (partition by session_id order by ts_us, event_id rows between 149 preceding and current row)),
st as (
  select *, case when event_type in ('accept_offer', 'reject_offer') then 'offer' when history_beats < 10 then 'warmup'
    when offer_state is not null then 'suppressed' else 'scored' end as status from gt)"""


def offer_clicks(t: Tables) -> DataFrame:
    return with_offers(t.long_carts)


def with_offers(df: DataFrame) -> DataFrame:
    viewed = F.col("event_type") == "view_product"
    return df.withColumn(
        "event_type",
        F.when(viewed & (F.col("product_count") == 1), "accept_offer")
        .when(viewed & (F.col("product_count") == 2), "reject_offer")
        .otherwise(F.col("event_type")),
    )


@query(
    "history_last150",
    f"""with {LONG} select session_id, event_id, recency from (
      select *, row_number() over (partition by session_id order by ts_us desc, event_id desc) as recency from longer) where recency <= 150""",
)
def _history_last150(t: Tables) -> DataFrame:
    return R.newest_items(t.long_clicks).select("session_id", "event_id", "recency")


@query("warmup_gate", f"with {OFFERS} select event_id, history_beats, status from st")
def _warmup_gate(t: Tables) -> DataFrame:
    rows = R.with_history(offer_clicks(t), t.long_layout, arrays=False)
    return rows.select("event_id", "history_beats", R.gate().alias("status"))


@query("offer_state", f"with {OFFERS} select event_id, offer_state from st")
def _offer_state(t: Tables) -> DataFrame:
    return R.with_history(offer_clicks(t), t.long_layout, arrays=False).select(
        "event_id", "offer_state"
    )


@query(
    "history_180s",
    f"""with {OFFERS} select e.event_id, count(h.event_id) as beats from ev e left join ev h
      on h.session_id = e.session_id and h.rn between e.rn - 149 and e.rn and h.event_type = 'heartbeat' and h.ts_us * 60 >= e.ts_us * 60 - 180 * 1000000
    group by e.event_id""",
)
def _history_180s(t: Tables) -> DataFrame:
    # The view lasts about a minute; an hour here, so that 180 s are a few events.
    slow = offer_clicks(t).withColumn("ts_us", F.col("ts_us") * 60)
    layout = replace(t.long_layout, cuts=tuple((k, tuple(c * 60 for c in cuts)) for k, cuts in t.long_layout.cuts))
    return R.with_history(slow, layout, window_s=180, arrays=False).select("event_id", F.col("history_beats").alias("beats"))


# Each arrival beside all that arrived before it in its session; of an instant the last counts.
LATE = CLICK + f""",
longs as (select * replace ({AS_LONG}) from click),
late as (
  select * replace (ts_us - ts_us % 50000 as ts_us,
      case when event_type = 'view_product' and product_count = 1 then 'accept_offer'
           when event_type = 'view_product' and product_count = 2 then 'reject_offer' else event_type end as event_type),
    ts_us + event_id * 7919 % 1009 * 20000 as arrived_us
  from longs),
seen as (
  select e.event_id, h.event_id as other, h.ts_us, h.event_type
  from late e join late h on h.session_id = e.session_id and (h.arrived_us, h.event_id) <= (e.arrived_us, e.event_id)
  qualify row_number() over (partition by e.event_id, h.ts_us order by h.arrived_us desc, h.event_id desc) = 1),
newest as (select * from seen qualify row_number() over (partition by event_id order by ts_us desc) <= 150)"""


@query(
    "arrived_history",
    f"""with {LATE} select event_id, count(*) filter (where event_type = 'heartbeat') as history_beats,
      arg_max(case event_type when 'accept_offer' then 'accepted' when 'reject_offer' then 'rejected' end, ts_us)
        filter (where event_type in ('accept_offer', 'reject_offer')) as offer_state,
      min(ts_us) filter (where event_type = 'heartbeat') as oldest_us, max(ts_us) filter (where event_type = 'heartbeat') as newest_us,
      sum(ts_us) filter (where event_type = 'heartbeat')::bigint as sum_us
    from newest group by event_id""",
)
def _arrived_history(t: Tables) -> DataFrame:
    """History of each event as of its arrival, events up to 20 s late."""
    late = with_offers(late_clicks(t.carts)).select("session_id", "event_id", "ts_us", "arrived_us", "event_type")
    rows = with_arrived_history(late, t.late_layout, fields=("us",))
    us = F.col("history")["us"]
    return rows.select(
        "event_id", "history_beats", "offer_state", F.array_min(us).alias("oldest_us"), F.array_max(us).alias("newest_us"),
        F.when(F.size(us) > 0, F.aggregate(us, F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("sum_us"),
    )


def _window(s: int) -> str:
    edge = f"(last_us - {s} * 1000000)"
    return f"""
    case when count(*) filter (where us >= {edge}) >= 2 then coalesce(avg(v) filter (where p_us >= {edge}), 0) end as w{s}_velocity_avg,
    case when count(*) filter (where us >= {edge}) >= 2 then coalesce(max(v) filter (where p_us >= {edge}), 0) end as w{s}_velocity_max,
    case when count(*) filter (where us >= {edge}) >= 2 then coalesce(stddev_samp(v) filter (where p_us >= {edge}), 0) end as w{s}_velocity_std,
    case when count(*) filter (where us >= {edge}) >= 2 then greatest(arg_max(clicks, us) filter (where us >= {edge}) - arg_min(clicks, us) filter (where us >= {edge}), 0) end as w{s}_total_clicks,
    case when count(*) filter (where us >= {edge}) >= 2 then count(*) filter (where p_us >= {edge} and is_static) / (count(*) filter (where us >= {edge}))::double end as w{s}_idle_ratio,
    case when count(*) filter (where us >= {edge}) >= 2 then count(*) filter (where us >= {edge}) end as w{s}_heartbeat_count"""


REPLAY = OFFERS + """,
hh as (
  select e.event_id as eid, e.page as cur_page, e.ts_us as cur_us, e.payment_method_selected as cur_method, h.ts_us as us, h.rn,
    h.mouse_x as x, h.mouse_y as y, h.cart_value as value, h.product_id as pid, h.qty, h.shipping_option_selected as ship,
    h.mouse_click_count as clicks, h.page,
    max(h.ts_us) over (partition by e.event_id) as last_us, min(h.rn) over (partition by e.event_id) as lo, max(h.rn) over (partition by e.event_id) as hi
  from st e join ev h on h.session_id = e.session_id and h.rn between e.rn - 149 and e.rn and h.event_type = 'heartbeat'
  where e.status = 'scored'),
h1 as (
  select *, lag(us) over w as p_us, lag(x) over w as px, lag(y) over w as py, lag(ship) over w as pship, lag(page) over w as ppage,
    lag(value) over w as pvalue, lag(pid) over w as ppid, lag(qty) over w as pqty
  from hh window w as (partition by eid order by rn)),
h2 as (
  select *, case when p_us is null then null when us > p_us then (us - p_us) / 1000000.0 else 0.25::double end as dt_s,
    case when p_us is null then null when us > p_us then trunc((us - p_us) / 1000000.0 * 1000.0)::bigint else 250 end as dt_ms,
    sqrt((x - px) * (x - px) + (y - py) * (y - py)) as dist, (x = px and y = py) as is_static from h1),
h3 as (select *, dist / dt_s as v from h2),
h4 as (
  select *, (v - lag(v) over w) / dt_s as acc,
    case when v < lag(v) over w * 0.8 then -1 when v > lag(v) over w * 1.2 then 1 when lag(v) over w is not null then 0 end as vote,
    sum(case when is_static then 0 else 1 end) over w as island
  from h3 window w as (partition by eid order by rn)),
hd as (
  select eid, sum(ms)::bigint as dwell_total_ms from (
    select eid, trunc((max(us) - min(us)) / 1000000.0 * 1000.0)::bigint as ms from h4 where is_static group by eid, island) group by eid),
rf as (
  select h4.eid as event_id, coalesce(avg(v), 0) as velocity_avg, coalesce(max(v), 0) as velocity_max, coalesce(stddev_samp(v), 0) as velocity_std,
    coalesce(avg(acc), 0) as acceleration_avg, coalesce(max(acc), 0) as acceleration_max,
    coalesce(sum(case when v < 5 then dt_ms end), 0)::bigint as idle_total_ms, sum(dist) as distance_total,
    case when sum(vote) < 0 then 'decreasing' when sum(vote) > 0 then 'increasing' else 'stable' end as velocity_trend,
    count(*) filter (where y < 100 and v > 200) as exit_intent_count,
    coalesce(any_value(dwell_total_ms), 0) as dwell_total_ms, count(*) filter (where is_static) as dwell_segments,
    case when max(us) > min(us) then (arg_max(clicks, us) - arg_min(clicks, us)) / ((max(us) - min(us)) / 1000000.0) else 0.0 end as click_frequency,
    count(*) as heartbeat_count,
    arg_max(value, us) - arg_max(pvalue, us) as cart_delta,
    any_value(case when rn = hi then case when ppid = pid then case when pqty > qty then '{"' || ppid || '":' || (pqty - qty) || '}' else '{}' end else '{"' || ppid || '":' || pqty || '}' end end) as product_removals,
    any_value(case when rn = hi then case when ppid = pid then case when qty > pqty then '{"' || pid || '":' || (qty - pqty) || '}' else '{}' end else '{"' || pid || '":' || qty || '}' end end) as product_additions,
    count(*) filter (where p_us is not null and ship <> pship) as shipping_switches,
    count(*) filter (where page = 'checkout' and ppage = 'cart') + any_value((cur_page = 'cart')::bigint) * max(case when rn = lo and page = 'checkout' then 1 else 0 end) as page_regression_count,
    coalesce(trunc((greatest(max(us) filter (where page = 'checkout'), any_value(case when cur_page = 'checkout' then cur_us end))
      - least(min(us) filter (where page = 'checkout'), any_value(case when cur_page = 'checkout' then cur_us end))) / 1000000.0 * 1000.0), 0)::bigint as payment_hesitation_ms,
    (any_value(cur_page) = 'checkout' and count(*) filter (where page = 'checkout') > 0 and any_value(cur_method) is not null)::bigint as payment_method_switches,""" + ",".join(
    _window(s) for s in S.WINDOWS_S
) + """
  from h4 left join hd on h4.eid = hd.eid group by h4.eid)"""

_W = [f"w{s}_{c}" for s in S.WINDOWS_S for c in WINDOW_DOUBLES]
REPLAY_DOUBLES = [*MOTION_DOUBLES, "cart_delta", *_W]
REPLAY_WHOLE = [
    *MOTION_WHOLE, "shipping_switches", "page_regression_count", "payment_hesitation_ms",
    "payment_method_switches", *[f"w{s}_{c}" for s in S.WINDOWS_S for c in ("total_clicks", "heartbeat_count")],
]


@query(
    "replay_features",
    f"with {REPLAY} select event_id, velocity_trend, product_removals, product_additions, {', '.join(REPLAY_WHOLE)}, {round_sql(REPLAY_DOUBLES)} from rf",
)
def _replay_features(t: Tables) -> DataFrame:
    rows = R.enrich(offer_clicks(t), t.long_layout).filter("status = 'scored'")
    rows = flat_windows(rows).withColumns(
        {c: M.sorted_json(F.col(c)) for c in ("product_removals", "product_additions")}
    )
    return rounded(
        rows.select(
            "event_id", "velocity_trend", "product_removals", "product_additions",
            *REPLAY_WHOLE, *REPLAY_DOUBLES,
        )
    )


def shipped(df: DataFrame) -> DataFrame:
    """Give the click view the shipping type and cost a browser would send."""
    kind = F.col("shipping_option_selected")
    return df.withColumns(
        {
            "shipping_type": kind,
            "shipping_cost": F.when(kind == "express", 12.0).otherwise(4.0) * F.col("qty"),
        }
    )


_PAYLOAD = """
pay_in as (
  select e.event_id, e.session_id, e.user_id, e.cart_value, e.product_count, e.shipping_option_selected, e.delivery_mode,
    e.shipping_option_selected as shipping_type, case when e.shipping_option_selected = 'express' then 12.0 else 4.0 end * e.qty as shipping_cost,
    e.mouse_click_count, e.page, rf.* exclude (event_id)
  from rf join ev e using (event_id))"""
_PAY_DOUBLES = [
    "cart_value", "shipping_cost", "velocity_avg", "velocity_max", "velocity_std",
    "acceleration_avg", "acceleration_max", "distance_total", "click_frequency", "cart_delta",
]
_PAY_PLAIN = [
    "session_id", "user_id", "product_count", "shipping_option_selected", "delivery_mode",
    "shipping_type", "mouse_click_count", "page", "velocity_trend", "exit_intent_count",
    "dwell_segments", "shipping_switches", "page_regression_count", "payment_method_switches",
]


@query(
    "payload",
    f"""with {REPLAY}, {_PAYLOAD} select event_id, {', '.join(_PAY_PLAIN)}, {round_sql(_PAY_DOUBLES)},
      round(idle_total_ms / 1000.0, 4) as idle_seconds, round(dwell_total_ms / 1000.0, 4) as dwell_seconds,
      round(payment_hesitation_ms / 1000.0, 4) as payment_hesitation_seconds from pay_in""",
)
def _payload(t: Tables) -> DataFrame:
    rows = R.enrich(shipped(offer_clicks(t)), t.long_layout).filter("status = 'scored'")
    return payload_columns(D.payload(rows, ("event_id",)))


def payload_columns(sent: DataFrame) -> DataFrame:
    return rounded(
        sent.select(
            "event_id", *_PAY_PLAIN, *_PAY_DOUBLES, "idle_seconds", "dwell_seconds",
            "payment_hesitation_seconds",
        )
    )


MODEL_SQL = """
mrow as (
  select event_id, session_id, shipping_type, velocity_avg, velocity_max, velocity_std, acceleration_avg, acceleration_max,
    idle_total_ms / 1000.0 * 1000 as total_idle_ms, distance_total as total_distance_px, exit_intent_count,
    dwell_total_ms / 1000.0 * 1000 as total_dwell_ms, dwell_segments as dwell_event_count, 0.0::double as session_duration_s, click_frequency,
    0.0::double as idle_ratio, cart_value as cart_value_max, cart_value as cart_value_avg, cart_delta as cart_delta_total, shipping_switches,
    page_regression_count, 1 as heartbeat_count, 1 as total_events, product_count as product_count_max, 0 as add_to_cart_count,
    0 as remove_from_cart_count, (page = 'checkout')::bigint as checkout_count, 0 as view_product_count,
    payment_hesitation_ms / 1000.0 * 1000 as payment_hesitation_ms, 0.0::double as events_per_minute, mouse_click_count as total_clicks, 'desktop' as device
  from pay_in)"""


@query(
    "model_row",
    f"with {REPLAY}, {_PAYLOAD}, {MODEL_SQL} select event_id, device, {round_sql(S.MODEL_NUMERIC)} from mrow",
)
def _model_row(t: Tables) -> DataFrame:
    rows = R.enrich(shipped(offer_clicks(t)), t.long_layout).filter("status = 'scored'")
    out = D.model_row(D.payload(rows, ("event_id",)), ("event_id",))
    numeric = D.backfill(out, keep=("event_id", "device"))
    return rounded(numeric)


def linear_score(df: DataFrame) -> DataFrame:
    """A fixed score in [0, 1] that SQL can repeat, in place of a fitted model."""
    raw = (
        F.col("cart_value_max") / 190.0
        + F.col("page_regression_count") * 0.05
        + F.col("checkout_count") * 0.2
    )
    return df.withColumn("probability", F.least(F.lit(1.0), raw))


LINEAR_SQL = "least(1.0::double, cart_value_max / 190.0::double + page_regression_count * 0.05::double + checkout_count * 0.2::double)"


@query(
    "retention_decision",
    f"""with {REPLAY}, {_PAYLOAD}, {MODEL_SQL}, p as (select *, {LINEAR_SQL} as probability from mrow)
    select event_id, round(probability, 4) as abandon_probability, probability >= 0.7 as trigger_retention,
      case when probability >= 0.7 then case when shipping_type = 'express' then 'express_discount' else 'free_shipping' end end as retention_type from p""",
)
def _retention_decision(t: Tables) -> DataFrame:
    rows = R.enrich(shipped(offer_clicks(t)), t.long_layout).filter("status = 'scored'")
    scored = linear_score(
        D.model_row(D.payload(rows, ("event_id",)), ("event_id", "shipping_type"))
    )
    return D.decide(scored).select(
        "event_id", "abandon_probability", "trigger_retention", "retention_type"
    )


@query(
    "offer_lifecycle",
    f"""with recursive {REPLAY}, {_PAYLOAD}, {MODEL_SQL},
    p as (select mrow.*, {LINEAR_SQL} as probability, ev.rn as rn from mrow join ev using (event_id)),
    cand as (select session_id, rn from p where probability >= 0.7),
    shown(session_id, rn) as (
      select session_id, min(rn) from cand group by session_id
      union all
      select s.session_id, (select min(c.rn) from cand c where c.session_id = s.session_id and c.rn >= s.rn + 150) as rn
      from shown s where s.rn is not null)
    select p.session_id, p.event_id,
      case when probability >= 0.7 and s.rn is null then 0.0 else round(probability, 4) end as abandon_probability,
      probability >= 0.7 and s.rn is not null as trigger_retention,
      case when probability >= 0.7 and s.rn is not null then case when shipping_type = 'express' then 'express_discount' else 'free_shipping' end end as retention_type
    from p left join (select * from shown where rn is not null) s on s.session_id = p.session_id and s.rn = p.rn""",
)
def _offer_lifecycle(t: Tables) -> DataFrame:
    return R.decisions(shipped(offer_clicks(t)), linear_score, t.long_layout).drop("position", "ts_us")
