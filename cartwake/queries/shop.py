"""Tracking, cart, report and journey queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.functions import maps as M
from cartwake.operators import cart as C
from cartwake.operators import historical as H
from cartwake.operators import journey as J
from cartwake.operators import motion, reports, sessions
from cartwake.operators import online as O
from cartwake.operators import tracking as T
from cartwake.queries.base import (
    BEATS, CLICK, GOLD, LONG, SILVER, Tables, query, rounded,
)
from cartwake.queries.online import MOTION, ROWS, labelled_carts

CATALOGUE = "cat(product_id, name, price, category) as (values " + ", ".join(
    f"('{i}', '{n}', {p}::double, '{c}')" for i, n, p, c in S.BATCH_CATALOGUE
) + ")"
SHIP_TYPE = "shipping_option_selected"


# -- catalogue and cart -----------------------------------------------------
@query(
    "catalogue_lookup",
    f"""with {CLICK}, {CATALOGUE} select event_id, click.product_id, name as product_name, price as list_price, category as product_category
    from click left join cat using (product_id)""",
)
def _catalogue_lookup(t: Tables) -> DataFrame:
    return C.with_product(t.clicks, C.catalogue(t.spark)).select(
        "event_id", "product_id", "product_name", "list_price", "product_category"
    )


@query(
    "categories_sold",
    f"""with {CLICK}, {CATALOGUE} select distinct category from click join cat using (product_id)""",
)
def _categories_sold(t: Tables) -> DataFrame:
    sold = C.with_product(t.clicks, C.catalogue(t.spark), keep_unknown=False)
    return C.categories(sold.select(F.col("product_category").alias("category")))


@query(
    "category_products",
    f"""with {CLICK}, {CATALOGUE} select product_id, count(*) as event_count from click join cat using (product_id)
    where category = 'audio' group by product_id""",
)
def _category_products(t: Tables) -> DataFrame:
    audio = C.products_in(C.catalogue(t.spark), "audio")
    return (
        t.clicks.join(audio.select("product_id"), "product_id")
        .groupBy("product_id").agg(F.count(F.lit(1)).alias("event_count"))
    )


@query(
    "cart_value",
    f"""with {CLICK}, {CATALOGUE}, pp as (
      select session_id, product_id, sum(qty)::bigint as qty from click where event_type = 'add_to_cart' group by session_id, product_id)
    select session_id, coalesce(sum(price * qty), 0.0) as cart_value, sum(qty)::bigint as unit_count, count(*) as line_count,
      '{{' || string_agg('"' || product_id || '":' || qty, ',' order by product_id) || '}}' as quantities
    from pp left join cat using (product_id) group by session_id""",
)
def _cart_value(t: Tables) -> DataFrame:
    adds = t.carts.filter(F.col("event_type") == "add_to_cart")
    lines = C.cart_lines(adds, ["session_id"])
    totals = C.cart_totals(lines, C.catalogue(t.spark), ["session_id"])
    return totals.withColumn("quantities", M.sorted_json(F.col("product_quantities"))).drop(
        "product_quantities"
    )


SHIP = """ship as (
  select *, case when delivery_mode = 'store' then 0.0 when shipping_option_selected = 'express' then qty * 12.0 else qty * 4.0 end::double as shipping_cost,
    case when delivery_mode = 'store' then 0 when shipping_option_selected = 'express' then 1 else 4 end as delivery_days,
    case when product_count % 2 = 0 then 'express_discount' else 'free_shipping' end as retention_type
  from click),
disc as (
  select *, case when retention_type = 'express_discount' then qty * 8.0 when shipping_option_selected = 'express' then qty * 12.0 else qty * 4.0 end::double as discount
  from ship)"""


def _shipped(t: Tables) -> DataFrame:
    qty = F.col("qty")
    rows = t.clicks.withColumns(
        {
            "shipping_cost": C.shipping_cost(qty, F.col("delivery_mode"), F.col(SHIP_TYPE)),
            "delivery_days": C.delivery_days(F.col("delivery_mode"), F.col(SHIP_TYPE)),
            "retention_type": F.when(F.col("product_count") % 2 == 0, "express_discount")
            .otherwise("free_shipping"),
        }
    )
    return rows.withColumn("discount", C.offer_discount(F.col("retention_type"), qty, F.col(SHIP_TYPE)))


@query("shipping_cost", f"with {CLICK}, {SHIP} select event_id, shipping_cost, delivery_days from ship")
def _shipping_cost(t: Tables) -> DataFrame:
    return _shipped(t).select("event_id", "shipping_cost", "delivery_days")


@query("offer_discount", f"with {CLICK}, {SHIP} select event_id, retention_type, discount from disc")
def _offer_discount(t: Tables) -> DataFrame:
    return _shipped(t).select("event_id", "retention_type", "discount")


@query(
    "order_total",
    f"""with {CLICK}, {SHIP} select event_id, case when delivery_mode = 'store' then 0.0 else greatest(shipping_cost - discount, 0) end as discounted,
      round(cart_value + case when delivery_mode = 'store' then 0.0 else greatest(shipping_cost - discount, 0) end, 4) as order_total from disc""",
)
def _order_total(t: Tables) -> DataFrame:
    rows = _shipped(t)
    less = C.shipping_cost(F.col("qty"), F.col("delivery_mode"), F.col(SHIP_TYPE), F.col("discount"))
    return rounded(
        rows.select(
            "event_id", less.alias("discounted"),
            C.order_total(F.col("cart_value"), less).alias("order_total"),
        )
    )


# -- tracking ---------------------------------------------------------------
@query(
    "shape_events",
    f"""with {CLICK} select event_id, event_type,
      case when event_type in ('heartbeat') then page when event_type = 'start_checkout' then 'checkout' end as page,
      case when event_type <> 'view_product' then cart_value end as cart_value,
      case when event_type <> 'view_product' then case when delivery_mode = 'store' and event_type in ('heartbeat', 'add_to_cart', 'remove_from_cart') then 'store'
        else shipping_option_selected end end as shipping_option_selected,
      case when event_type = 'heartbeat' then delivery_mode end as delivery_mode,
      case when event_type = 'heartbeat' then mouse_x end as mouse_x,
      case when event_type in ('add_to_cart', 'view_product') then product_id end as product_id,
      case when event_type = 'purchase' then coalesce(payment_method_selected, 'credit_card') end as payment_method_selected
    from click""",
)
def _shape_events(t: Tables) -> DataFrame:
    return T.shape_events(t.clicks).select(
        "event_id", "event_type", "page", "cart_value", "shipping_option_selected",
        "delivery_mode", "mouse_x", "product_id", "payment_method_selected",
    )


@query(
    "tracking_gate",
    f"with {CLICK} select event_id, session_id, page from click where page in ('cart', 'checkout') and product_count - 1 > 0",
)
def _tracking_gate(t: Tables) -> DataFrame:
    some = t.clicks.withColumn("product_count", F.col("product_count") - 1)
    return T.tracking_gate(some).select("event_id", "session_id", "page")


@query(
    "buffer_flush",
    f"""with {LONG}, tr as (
      select *, (page in ('cart', 'checkout') and product_count >= 6 and product_id = 'prod_006') as tracked from longer),
    wt as (select *, sum(tracked::int) over (partition by session_id order by ts_us, event_id) as wait from tr),
    held as (select *, row_number() over (partition by session_id, wait order by ts_us desc, event_id desc) as rn from wt where not tracked)
    select event_id, session_id, ts_us as sent_us, false as buffered from wt where tracked
    union all
    select h.event_id, h.session_id, r.ts_us as sent_us, true as buffered
    from held h join (select * from wt where tracked) r on h.session_id = r.session_id and r.wait = h.wait + 1 where rn <= 100""",
)
def _buffer_flush(t: Tables) -> DataFrame:
    # Few events are tracked, so that waits of more than a hundred events come about.
    rare = (F.col("product_count") >= 6) & (F.col("product_id") == "prod_006")
    some = t.long_clicks.withColumn("product_count", F.when(rare, F.col("product_count")).otherwise(0))
    return T.buffer_flush(some, t.long_layout).select(
        "event_id", "session_id", "sent_us", "buffered"
    )


# -- reports ----------------------------------------------------------------
@query(
    "reason_counts",
    f"with {ROWS} select abandon_reason, count(*) as session_count from session_rows where abandoned = 1 group by abandon_reason",
)
def _reason_counts(t: Tables) -> DataFrame:
    return reports.reason_counts(H.session_rows(labelled_carts(t), t.layout))


DESCRIBED = [
    "event_count", "abandoned", "has_checkout", "velocity_avg", "velocity_max", "velocity_std",
    "acceleration_avg", "acceleration_max", "idle_total_ms", "distance_total",
    "exit_intent_count", "dwell_total_ms", "dwell_segments", "session_duration_s",
    "shipping_switches", "page_regression_count", "payment_hesitation_ms",
    "payment_method_switches",
]


@query(
    "describe_features",
    f"with {ROWS} "
    + " union all ".join(
        f"select '{c}' as feature, round(avg({c}::double), 2) as mean, round(stddev_samp({c}::double), 2) as std, "
        f"round(min({c}::double), 2) as min, round(max({c}::double), 2) as max from session_rows"
        for c in DESCRIBED
    ),
)
def _describe_features(t: Tables) -> DataFrame:
    return reports.describe(H.session_rows(labelled_carts(t), t.layout), DESCRIBED)


@query(
    "dataset_summary",
    f"""with {CLICK}, ps as (
      select session_id, count(*) as n, count(*) filter (where event_type = 'heartbeat') as beats,
        arg_min(event_type, ts_us) filter (where event_type in ('purchase', 'abandon')) as terminal from click group by session_id)
    select count(*) as session_count, sum(n)::bigint as total_events, round(sum(n) / count(*), 1) as avg_events_per_session,
      round(sum(beats) / count(*), 1) as avg_heartbeats_per_session, count(*) filter (where terminal = 'abandon') as abandon_count,
      count(*) filter (where terminal = 'purchase') as purchase_count,
      round(count(*) filter (where terminal = 'abandon') / count(*) * 100, 2) as abandon_rate_pct from ps""",
)
def _dataset_summary(t: Tables) -> DataFrame:
    return reports.dataset_summary(t.clicks)


@query(
    "event_type_pivot",
    f"with {CLICK} select session_id, "
    + ", ".join(
        f"count(*) filter (where event_type = '{k}') as {n}"
        for n, k in (("heartbeats", "heartbeat"), ("adds", "add_to_cart"),
                     ("removes", "remove_from_cart"), ("checkouts", "start_checkout"),
                     ("abandons", "abandon"), ("purchases", "purchase"))
    )
    + " from click group by session_id",
)
def _event_type_pivot(t: Tables) -> DataFrame:
    return reports.event_type_counts(t.clicks)


@query(
    "latency_percentiles",
    f"""with {CLICK}, gaps as (
      select event_type, (ts_us - lag(ts_us) over (partition by session_id order by ts_us, event_id)) // 1000 as gap_ms from click)
    select event_type, count(gap_ms) as n, quantile_cont(gap_ms, 0.5) as p50, round(quantile_cont(gap_ms, 0.95), 4) as p95,
      round(quantile_cont(gap_ms, 0.99), 4) as p99 from gaps where gap_ms is not null group by event_type""",
)
def _latency_percentiles(t: Tables) -> DataFrame:
    w = t.layout.window()
    rows = t.layout.look_back(t.clicks, 1)
    gap = F.call_function("div", F.col("ts_us") - F.lag("ts_us").over(w), F.lit(1000))
    gaps = t.layout.settle(rows.withColumn("gap_ms", gap)).filter("gap_ms is not null")
    return rounded(reports.latency_percentiles(gaps, "gap_ms", ["event_type"]))


# -- journey ----------------------------------------------------------------
def _with_category(t: Tables) -> DataFrame:
    return C.with_product(t.clicks, C.catalogue(t.spark))


@query(
    "interaction_frequency",
    f"""with {CLICK} select session_id, count(*) filter (where event_type <> 'heartbeat') as interactions,
      round(count(*) filter (where event_type <> 'heartbeat') / ((max(ts_us) - min(ts_us)) / 1000000.0) * 60, 6) as interactions_per_minute
    from click group by session_id""",
)
def _interaction_frequency(t: Tables) -> DataFrame:
    return rounded(J.interaction_frequency(t.clicks), 6)


@query(
    "categories_viewed",
    f"""with {CLICK}, {CATALOGUE} select session_id, count(distinct category) filter (where event_type = 'view_product') as categories_viewed
    from click left join cat using (product_id) group by session_id""",
)
def _categories_viewed(t: Tables) -> DataFrame:
    return J.categories_viewed(_with_category(t))


@query(
    "predominant_category",
    f"""with {CLICK}, {CATALOGUE}, n as (select session_id, category, count(*) as n from click join cat using (product_id) group by session_id, category)
    select session_id, category, n as event_count from (
      select *, row_number() over (partition by session_id order by n desc, category) as rn from n) where rn = 1""",
)
def _predominant_category(t: Tables) -> DataFrame:
    return J.predominant_category(_with_category(t))


@query(
    "entry_exit",
    f"""with {CLICK} select session_id, arg_min(page, ts_us) as entry_page, arg_max(page, ts_us) as exit_page,
      arg_min(event_type, ts_us) as first_event, arg_max(event_type, ts_us) as last_event from click group by session_id""",
)
def _entry_exit(t: Tables) -> DataFrame:
    return J.entry_exit(t.clicks)


@query(
    "event_sequence",
    f"""with {CLICK} select session_id, row_number() over (partition by session_id order by ts_us, event_id) as step, event_type from click""",
)
def _event_sequence(t: Tables) -> DataFrame:
    return J.event_sequence(t.clicks, t.layout)


@query(
    "terminal_gap",
    f"""with {CLICK}, l as (select *, lag(ts_us) over (partition by session_id order by ts_us, event_id) as pt from click)
    select session_id, event_type as terminal, ts_us - pt as gap_us from (
      select *, row_number() over (partition by session_id order by ts_us, event_id) as rn from l where event_type in ('purchase', 'abandon')) where rn = 1""",
)
def _terminal_gap(t: Tables) -> DataFrame:
    return J.terminal_gap(t.clicks, t.layout)


@query(
    "added_viewed_ratio",
    f"""with {CLICK}, c as (select session_id, count(*) filter (where event_type = 'add_to_cart') as added,
      count(*) filter (where event_type = 'view_product') as viewed from click group by session_id)
    select session_id, added, viewed, round(case when viewed > 0 then added / viewed end, 6) as added_to_viewed from c""",
)
def _added_viewed_ratio(t: Tables) -> DataFrame:
    return rounded(J.added_viewed_ratio(t.clicks), 6)


@query(
    "cart_page_time",
    f"""with {CLICK}, m as (select session_id, min(ts_us) filter (where page = 'cart') as a, min(ts_us) filter (where page = 'checkout') as b from click group by session_id)
    select session_id, case when b >= a then b - a end as cart_to_checkout_us from m""",
)
def _cart_page_time(t: Tables) -> DataFrame:
    return J.cart_page_time(t.clicks)


@query(
    "idle_share",
    f"with {SILVER}, {BEATS} select session_id, round(idle_ratio, 6) as idle_share from beats3",
)
def _idle_share(t: Tables) -> DataFrame:
    return rounded(J.idle_share(sessions.heartbeat_table(motion.silver(t.clicks, t.layout))), 6)


RULES = (
    "g_all as (select session_id, idle_ratio, shipping_switches, exit_intent_count, page_regression_count, remove_from_cart_count, add_to_cart_count, abandoned from gold)"
)
RULE_SCORE_SQL = """round(case when velocity_trend = 'decreasing' then 0.25 else 0.0 end::double + case when idle_ratio > 0.3 then 0.25 else 0.0 end
      + case when page_regression_count >= 2 then 0.2 else 0.0 end + case when shipping_switches >= 2 then 0.15 else 0.0 end
      + case when g_all.exit_intent_count >= 2 then 0.1 else 0.0 end + case when remove_from_cart_count > add_to_cart_count then 0.05 else 0.0 end, 2)"""
GOLD_AND_TREND = (
    f"with {GOLD}, {RULES}, mo as (select session_id, velocity_trend from ("
    f"with {MOTION.lstrip()} select * from om))"
)


def scored_sessions(t: Tables) -> DataFrame:
    """Gold rows with their trend and rule score."""
    g = sessions.gold(t.clicks, t.layout)
    trend = O.session_features(t.clicks, t.layout).select("session_id", "velocity_trend")
    score = J.rule_score(
        F.coalesce("velocity_trend", F.lit("stable")), F.col("idle_ratio"),
        F.col("page_regression_count"), F.col("shipping_switches"), F.col("exit_intent_count"),
        F.col("remove_from_cart_count"), F.col("add_to_cart_count"),
    )
    return g.join(trend, "session_id", "left").withColumn("score", score)


@query(
    "rule_score",
    f"""{GOLD_AND_TREND} select session_id, abandoned, {RULE_SCORE_SQL} as score, {RULE_SCORE_SQL} >= 0.5 as predicted
    from g_all left join mo using (session_id)""",
)
def _rule_score(t: Tables) -> DataFrame:
    return scored_sessions(t).select(
        "session_id", "abandoned", "score", (F.col("score") >= J.RULE_THRESHOLD).alias("predicted")
    )


@query(
    "earlier_offers",
    f"""with {CLICK}, {SHIP}, p as (select *, (mouse_click_count % 100) / 100.0 as probability from ship)
    select event_id, case when probability > 0.7 then case when delivery_mode = 'shipping' and shipping_cost > 0 then 'shipping_discount'
      when shipping_option_selected = 'standard' then 'express_upgrade' else 'coupon' end end as offer from p""",
)
def _earlier_offers(t: Tables) -> DataFrame:
    p = (F.col("mouse_click_count") % 100) / F.lit(100.0)
    return _shipped(t).select(
        "event_id",
        J.earlier_offer(p, F.col("delivery_mode"), F.col("shipping_cost"), F.col(SHIP_TYPE)).alias("offer"),
    )
