"""Online and historical feature queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.functions import maps as M
from cartwake.operators import historical as H
from cartwake.operators import online as O
from cartwake.queries.base import CLICK, Tables, query, round_sql, rounded

PAIRS = CLICK + """,
lp as (
  select *, lag(ts_us) over w as p_us, lag(mouse_x) over w as px, lag(mouse_y) over w as py,
    lag(shipping_option_selected) over w as pship, lag(cart_value) over w as pval,
    lag(product_id) over w as ppid, lag(qty) over w as pqty
  from click where event_type = 'heartbeat'
  window w as (partition by session_id order by ts_us, event_id)),
g as (
  select *, case when p_us is null then null when ts_us > p_us then (ts_us - p_us) / 1000000.0 else 0.25::double end as dt_s,
    case when p_us is null then null when ts_us > p_us then trunc((ts_us - p_us) / 1000000.0 * 1000.0)::bigint else 250 end as dt_ms,
    sqrt((mouse_x - px) * (mouse_x - px) + (mouse_y - py) * (mouse_y - py)) as dist,
    (mouse_x = px and mouse_y = py) as is_static
  from lp),
gv as (select *, dist / dt_s as v from g),
gp as (
  select *, (v - lag(v) over w) / dt_s as acc,
    case when v < lag(v) over w * 0.8 then -1 when v > lag(v) over w * 1.2 then 1
         when lag(v) over w is not null then 0 end as vote,
    coalesce(lag(is_static) over w, false) as was_static
  from gv window w as (partition by session_id order by ts_us, event_id)),
runs as (
  select *, sum(case when is_static then 0 else 1 end) over (partition by session_id order by ts_us, event_id) as island
  from gp),
dwell as (
  select session_id, island, min(ts_us) as start_us, max(ts_us) as end_us, count(*) as still_count
  from runs where is_static group by session_id, island)"""

MOTION_WHOLE = ["idle_total_ms", "exit_intent_count", "dwell_total_ms", "dwell_segments", "heartbeat_count"]
MOTION_DOUBLES = [
    "velocity_avg", "velocity_max", "velocity_std", "acceleration_avg", "acceleration_max",
    "distance_total", "click_frequency",
]

MOTION = PAIRS + """,
dw as (select session_id, sum(trunc((end_us - start_us) / 1000000.0 * 1000.0)::bigint)::bigint as dwell_total_ms from dwell group by session_id),
om as (
  select session_id, coalesce(avg(v), 0) as velocity_avg, coalesce(max(v), 0) as velocity_max,
    coalesce(stddev_samp(v), 0) as velocity_std, coalesce(avg(acc), 0) as acceleration_avg,
    coalesce(max(acc), 0) as acceleration_max,
    coalesce(sum(case when v < 5 then dt_ms end), 0)::bigint as idle_total_ms, sum(dist) as distance_total,
    case when sum(vote) < 0 then 'decreasing' when sum(vote) > 0 then 'increasing' else 'stable' end as velocity_trend,
    count(*) filter (where mouse_y < 100 and v > 200) as exit_intent_count,
    coalesce(any_value(dwell_total_ms), 0) as dwell_total_ms,
    count(*) filter (where is_static) as dwell_segments,
    case when max(ts_us) > min(ts_us) and arg_max(mouse_click_count, ts_us) >= arg_min(mouse_click_count, ts_us)
      then (arg_max(mouse_click_count, ts_us) - arg_min(mouse_click_count, ts_us)) / ((max(ts_us) - min(ts_us)) / 1000000.0)
      else 0.0 end as click_frequency,
    count(*) as heartbeat_count
  from gp left join dw using (session_id) group by session_id having count(*) >= 2)"""


@query(
    "online_session",
    f"with {MOTION} select session_id, velocity_trend, {', '.join(MOTION_WHOLE)}, {round_sql(MOTION_DOUBLES)} from om",
)
def _online_session(t: Tables) -> DataFrame:
    return rounded(O.session_features(t.clicks, t.layout))


@query(
    "velocity_trend",
    f"with {MOTION} select session_id, velocity_trend from om",
)
def _velocity_trend(t: Tables) -> DataFrame:
    return O.session_features(t.clicks, t.layout).select("session_id", "velocity_trend")


@query(
    "dwell_segments",
    f"with {PAIRS} select session_id, start_us, end_us, still_count from dwell",
)
def _dwell_segments(t: Tables) -> DataFrame:
    return O.dwell_segments(t.clicks, t.layout)


@query(
    "pair_motion",
    f"with {PAIRS} select event_id, dt_ms, is_static, vote, {round_sql(['dt_s', 'dist', 'v', 'acc'], 6)} from gp where p_us is not null",
)
def _pair_motion(t: Tables) -> DataFrame:
    rows = O.pairs(t.clicks, t.layout).filter("p_us is not null")
    return rounded(rows.select("event_id", "dt_ms", "is_static", "vote", "dt_s", "dist", "v", "acc"), 6)


def _window_cte(s: int) -> str:
    edge = f"(last_us - {s} * 1000000)"
    return f"""w{s} as (
  select session_id, coalesce(avg(v) filter (where p_us >= {edge}), 0) as velocity_avg,
    coalesce(max(v) filter (where p_us >= {edge}), 0) as velocity_max,
    coalesce(stddev_samp(v) filter (where p_us >= {edge}), 0) as velocity_std,
    greatest(arg_max(mouse_click_count, ts_us) filter (where ts_us >= {edge})
           - arg_min(mouse_click_count, ts_us) filter (where ts_us >= {edge}), 0) as total_clicks,
    count(*) filter (where p_us >= {edge} and is_static) / (count(*) filter (where ts_us >= {edge}))::double as idle_ratio,
    count(*) filter (where ts_us >= {edge}) as heartbeat_count
  from gl group by session_id having count(*) filter (where ts_us >= {edge}) >= 2)"""


WINDOWS = (
    ",\ngl as (select *, max(ts_us) over (partition by session_id) as last_us from gp),\n"
    + ",\n".join(_window_cte(s) for s in S.WINDOWS_S)
)
WINDOW_DOUBLES = ["velocity_avg", "velocity_max", "velocity_std", "idle_ratio"]


def _window_query(s: int) -> None:
    @query(
        f"window_{s}s",
        f"with {PAIRS}{WINDOWS} select session_id, total_clicks, heartbeat_count, {round_sql(WINDOW_DOUBLES)} from w{s}",
    )
    def _window(t: Tables) -> DataFrame:
        rows = O.window_features(t.clicks, t.layout).filter(F.col(f"window_{s}s").isNotNull())
        return rounded(rows.select("session_id", f"window_{s}s.*"))


for _s in S.WINDOWS_S:
    _window_query(_s)

CART = """,
cl as (select * from (select *, row_number() over (partition by session_id order by ts_us desc, event_id desc) as rn from gp) where rn = 1),
cf as (
  select session_id, case when p_us is null then 0.0 else cart_value - pval end as cart_delta,
    case when p_us is null then '{}' when ppid = product_id then
      case when pqty > qty then '{"' || ppid || '":' || (pqty - qty) || '}' else '{}' end
      else '{"' || ppid || '":' || pqty || '}' end as product_removals,
    case when p_us is null then '{}' when ppid = product_id then
      case when qty > pqty then '{"' || product_id || '":' || (qty - pqty) || '}' else '{}' end
      else '{"' || product_id || '":' || qty || '}' end as product_additions
  from cl),
sw as (select session_id, count(*) filter (where p_us is not null and shipping_option_selected is distinct from pship) as shipping_switches
  from gp group by session_id)"""


def _map_text(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: M.sorted_json(F.col(c)) for c in ("product_removals", "product_additions")}
    )


@query(
    "cart_features",
    f"with {PAIRS}{CART} select session_id, {round_sql(['cart_delta'])}, product_removals, product_additions, shipping_switches from cf join sw using (session_id)",
)
def _cart_features(t: Tables) -> DataFrame:
    return rounded(_map_text(O.cart_features(t.carts, t.layout)))


@query(
    "map_diff",
    f"""with {CLICK}, q as (
      select event_id, product_id, qty, 'prod_001' as other, (mouse_click_count % 3)::bigint as oqty from click)
    select event_id,
      case when product_id = other then case when oqty > qty then '{{"prod_001":' || (oqty - qty) || '}}' else '{{}}' end
           when oqty > 0 then '{{"prod_001":' || oqty || '}}' else '{{}}' end as removed,
      case when product_id = other then case when qty > oqty then '{{"prod_001":' || (qty - oqty) || '}}' else '{{}}' end
           else '{{"' || product_id || '":' || qty || '}}' end as added
    from q""",
)
def _map_diff(t: Tables) -> DataFrame:
    prev = F.create_map(F.lit("prod_001"), F.col("mouse_click_count") % 3)
    cur = F.col("product_quantities")
    return t.carts.select(
        "event_id",
        M.sorted_json(M.quantity_drop(prev, cur)).alias("removed"),
        M.sorted_json(M.quantity_rise(prev, cur)).alias("added"),
    )


def funnel_sql(name: str, ignore_nulls: bool) -> str:
    where = "page = 'checkout'" + (" and payment_method_selected is not null" if ignore_nulls else "")
    return f"""
{name}_r as (
  select session_id, count(*) filter (where page = 'cart' and pp = 'checkout') as page_regression_count,
    coalesce(trunc((max(ts_us) filter (where page = 'checkout') - min(ts_us) filter (where page = 'checkout')) / 1000000.0 * 1000.0), 0)::bigint as payment_hesitation_ms
  from (select *, lag(page) over (partition by session_id order by ts_us, event_id) as pp from click) group by session_id),
{name}_p as (
  select session_id, count(*) filter (where pt is not null and payment_method_selected is distinct from pm) as n
  from (select *, lag(ts_us) over w as pt, lag(payment_method_selected) over w as pm from click where {where}
        window w as (partition by session_id order by ts_us, event_id)) group by session_id),
{name} as (select session_id, page_regression_count, payment_hesitation_ms, coalesce(n, 0) as payment_method_switches
  from {name}_r left join {name}_p using (session_id))"""


@query("funnel", f"with {CLICK}, {funnel_sql('fu', False)} select * from fu")
def _funnel(t: Tables) -> DataFrame:
    return O.funnel_features(t.clicks, t.layout)


@query(
    "value_changes",
    f"""with {CLICK} select session_id, count(*) filter (where pt is not null and payment_method_selected is distinct from pm) as change_count
    from (select *, lag(ts_us) over w as pt, lag(payment_method_selected) over w as pm from click
          window w as (partition by session_id order by ts_us, event_id)) group by session_id""",
)
def _value_changes(t: Tables) -> DataFrame:
    return O.value_changes(t.clicks, "payment_method_selected", t.layout)


ALL = MOTION + WINDOWS + CART + """,
hp as (select *, lag(page) over (partition by session_id order by ts_us, event_id) as pp from click where event_type = 'heartbeat'),
hf as (
  select session_id, count(*) filter (where page = 'cart' and pp = 'checkout') as reg,
    min(ts_us) filter (where page = 'checkout') as fc, max(ts_us) filter (where page = 'checkout') as lc,
    arg_max(page, ts_us) as last_page from hp group by session_id),
cur as (select * from (select *, row_number() over (partition by session_id order by ts_us desc, event_id desc) as rn from click) where rn = 1),
fn as (
  select session_id, reg + (cur.page = 'cart' and last_page = 'checkout')::bigint as page_regression_count,
    coalesce(trunc((greatest(lc, case when cur.page = 'checkout' then cur.ts_us end) - least(fc, case when cur.page = 'checkout' then cur.ts_us end)) / 1000000.0 * 1000.0), 0)::bigint as payment_hesitation_ms,
    (cur.page = 'checkout' and fc is not null and cur.payment_method_selected is not null)::bigint as payment_method_switches
  from hf join cur using (session_id))"""
ALL_SELECT = (
    f"select om.session_id, velocity_trend, {', '.join('om.' + c + ' as ' + c for c in MOTION_WHOLE)}, "
    + ", ".join(f"round(om.{c}, 4) + 0.0 as {c}" for c in MOTION_DOUBLES)
    + ", round(cart_delta, 4) + 0.0 as cart_delta, product_removals, product_additions, shipping_switches, "
    "page_regression_count, payment_hesitation_ms, payment_method_switches, "
    + ", ".join(
        f"w{s}.heartbeat_count as w{s}_heartbeat_count, w{s}.total_clicks as w{s}_total_clicks, "
        + ", ".join(f"round(w{s}.{c}, 4) + 0.0 as w{s}_{c}" for c in WINDOW_DOUBLES)
        for s in S.WINDOWS_S
    )
    + " from om join cf on om.session_id = cf.session_id join sw on om.session_id = sw.session_id "
    "join fn on om.session_id = fn.session_id "
    + " ".join(f"left join w{s} on om.session_id = w{s}.session_id" for s in S.WINDOWS_S)
)


def flat_windows(df: DataFrame) -> DataFrame:
    parts = ["heartbeat_count", "total_clicks", *WINDOW_DOUBLES]
    cols = {f"w{s}_{p}": F.col(f"window_{s}s.{p}") for s in S.WINDOWS_S for p in parts}
    return df.withColumns(cols).drop(*[f"window_{s}s" for s in S.WINDOWS_S])


@query("online_features", f"with {ALL} {ALL_SELECT}")
def _online_features(t: Tables) -> DataFrame:
    return rounded(_map_text(flat_windows(O.all_features(t.carts, t.layout))))


# -- historical -------------------------------------------------------------
HIST = CLICK + """,
lp as (
  select *, lag(ts_us) over w as p_us, lag(mouse_x) over w as px, lag(mouse_y) over w as py,
    lag(cart_value) over w as pval, lag(shipping_option_selected) over w as pship
  from click where event_type = 'heartbeat'
  window w as (partition by session_id order by ts_us, event_id)),
g as (
  select *, (ts_us - p_us) / 1000000.0 as raw_s,
    sqrt((mouse_x - px) * (mouse_x - px) + (mouse_y - py) * (mouse_y - py)) as dist,
    (mouse_x = px and mouse_y = py) as is_static
  from lp),
g2 as (
  select *, case when p_us is null then null when raw_s > 0 and raw_s <= 10 then raw_s else 0.25::double end as dt_s,
    case when p_us is null then null when raw_s > 0 and raw_s <= 10 then trunc(raw_s * 1000.0)::bigint else 250 end as dt_ms
  from g),
gv as (select *, dist / dt_s as v from g2),
gp as (
  select *, (v - lag(v) over w) / dt_s as acc,
    case when v < lag(v) over w * 0.8 then -1 when v > lag(v) over w * 1.2 then 1
         when lag(v) over w is not null then 0 end as vote,
    count(v) over (partition by session_id order by ts_us, event_id) as pair_no,
    sum(case when is_static then 0 else 1 end) over (partition by session_id order by ts_us, event_id) as island,
    max(ts_us) over (partition by session_id) as last_us
  from gv window w as (partition by session_id order by ts_us, event_id)),
seg as (
  select session_id, min(p_us) as a, max(ts_us) as b from gp where is_static
  group by session_id, island having max(ts_us) < any_value(last_us)),
segs as (select session_id, count(*) as dwell_segments, sum(trunc((b - a) / 1000000.0 * 1000.0))::bigint as dwell_total_ms from seg group by session_id),
steps as (
  select *, sqrt(pow(mouse_x - lag(mouse_x) over w, 2) + pow(mouse_y - lag(mouse_y) over w, 2)) as step
  from click window w as (partition by session_id order by ts_us, event_id)),
ev as (
  select session_id, arg_min(user_id, ts_us) as user_id, arg_min(device, ts_us) as device, count(*) as event_count,
    sum(step) as distance_total, sum(mouse_click_count)::double as clicks,
    (max(ts_us) - min(ts_us)) / 1000000.0 as dur,
    arg_min(event_type, ts_us) filter (where event_type in ('purchase', 'abandon')) as terminal,
    bool_or(page = 'checkout')::bigint as has_checkout,
    coalesce(arg_max(abandon_reason, ts_us) filter (where abandon_reason is not null), '') as abandon_reason,
    coalesce(arg_max(payment_method, ts_us) filter (where payment_method is not null), '') as payment_method
  from (select *, case when event_type = 'abandon' then case when product_count % 2 = 0 then 'browsing' else 'extra_costs' end end as abandon_reason,
          case when event_type = 'purchase' then payment_method_selected end as payment_method from steps)
  group by session_id),
hm as (
  select session_id, round(coalesce(avg(v), 0), 2) as velocity_avg, round(coalesce(max(v), 0), 2) as velocity_max,
    round(coalesce(stddev_samp(v), 0), 2) as velocity_std, round(coalesce(avg(acc), 0), 2) as acceleration_avg,
    round(coalesce(max(acc), 0), 2) as acceleration_max,
    coalesce(sum(case when v < 5 then dt_ms end), 0)::bigint as idle_total_ms,
    case when count(v) >= 10 then case when regr_slope(v, pair_no) < -10 then 'decreasing' when regr_slope(v, pair_no) > 10 then 'increasing' else 'stable' end
         when sum(vote) < 0 then 'decreasing' when sum(vote) > 0 then 'increasing' else 'stable' end as velocity_trend,
    count(*) filter (where mouse_y < 100 and v > 200) as exit_intent_count,
    count(*) as heartbeat_count,
    count(*) filter (where p_us is not null and shipping_option_selected is distinct from pship) as shipping_switches,
    round(coalesce(arg_max(cart_value, ts_us) - arg_max(pval, ts_us), 0), 2) + 0.0 as cart_delta
  from gp group by session_id),
hs as (
  select session_id, velocity_avg, velocity_max, velocity_std, acceleration_avg, acceleration_max, idle_total_ms,
    round(coalesce(distance_total, 0), 2) as distance_total, velocity_trend, exit_intent_count,
    coalesce(dwell_total_ms, 0) as dwell_total_ms, coalesce(dwell_segments, 0) as dwell_segments,
    round(clicks / greatest(dur, 1), 4) as click_frequency, heartbeat_count, round(dur, 2) as session_duration_s
  from hm join ev using (session_id) left join segs using (session_id) where heartbeat_count >= 2),
tl as (
  select session_id, product_id as pid, count(*) filter (where event_type = 'add_to_cart') as adds,
    count(*) filter (where event_type = 'remove_from_cart') as removes, count(*) filter (where event_type = 'heartbeat') as beats
  from click group by session_id, product_id),
tally as (
  select session_id,
    case when sum(beats) >= 2 then '{' || coalesce(string_agg('"' || pid || '":' || removes, ',' order by pid) filter (where removes > 0), '') || '}' else '{}' end as product_removals,
    case when sum(beats) >= 2 then '{' || coalesce(string_agg('"' || pid || '":' || adds, ',' order by pid) filter (where adds > 0), '') || '}' else '{}' end as product_additions
  from tl group by session_id)"""


def labelled_carts(t: Tables) -> DataFrame:
    """Click view with the reason and method columns of terminal events."""
    kind = F.col("event_type")
    return t.carts.withColumns(
        {
            "abandon_reason": F.when(
                kind == "abandon",
                F.when(F.col("product_count") % 2 == 0, "browsing").otherwise("extra_costs"),
            ),
            "payment_method": F.when(kind == "purchase", F.col("payment_method_selected")),
        }
    )


@query("history_session", f"with {HIST} select * from hs")
def _history_session(t: Tables) -> DataFrame:
    return H.session_features(t.clicks, t.layout)


@query("product_tallies", f"with {HIST} select * from tally")
def _product_tallies(t: Tables) -> DataFrame:
    return H.product_tallies(t.clicks)


@query(
    "history_cart",
    f"""with {HIST} select session_id, coalesce(cart_delta, 0.0) as cart_delta, coalesce(shipping_switches, 0) as shipping_switches, product_removals, product_additions
    from tally left join hm using (session_id)""",
)
def _history_cart(t: Tables) -> DataFrame:
    return rounded(H.cart_features(t.clicks, t.layout), 2)


@query("history_funnel", f"with {CLICK}, {funnel_sql('fu', True)} select * from fu")
def _history_funnel(t: Tables) -> DataFrame:
    return H.funnel_features(t.clicks, t.layout)


@query(
    "terminal_label",
    f"""with {CLICK} select session_id, arg_min(event_type, ts_us) filter (where event_type in ('purchase', 'abandon')) as terminal
    from click group by session_id""",
)
def _terminal_label(t: Tables) -> DataFrame:
    return H.terminal_labels(t.clicks)


ROWS = HIST + "," + funnel_sql("fu", True) + """,
session_rows as (
  select ev.session_id, ev.user_id, ev.device, event_count, coalesce((terminal = 'abandon')::bigint, 0) as abandoned,
    abandon_reason, payment_method, has_checkout, velocity_avg, velocity_max, velocity_std, acceleration_avg,
    acceleration_max, idle_total_ms, hs.distance_total as distance_total, velocity_trend, exit_intent_count, dwell_total_ms,
    dwell_segments, click_frequency, session_duration_s, coalesce(cd.cart_delta, 0.0) as cart_delta,
    coalesce(cd.shipping_switches, 0) as shipping_switches, product_removals, product_additions,
    page_regression_count, payment_hesitation_ms, payment_method_switches
  from ev left join hs on ev.session_id = hs.session_id join tally on ev.session_id = tally.session_id
  join fu on ev.session_id = fu.session_id
  left join (select session_id, cart_delta, shipping_switches from hm) cd on ev.session_id = cd.session_id)"""


@query("session_rows", f"with {ROWS} select * from session_rows")
def _session_rows(t: Tables) -> DataFrame:
    return rounded(H.session_rows(labelled_carts(t), t.layout))


@query(
    "slope_trend",
    f"""with {HIST} select session_id, round(regr_slope(v, pair_no), 4) + 0.0 as slope, count(v) as pair_count from gp group by session_id""",
)
def _slope_trend(t: Tables) -> DataFrame:
    rows = H._rows(t.clicks, t.layout).filter("_beat")
    return rounded(
        rows.groupBy("session_id").agg(
            F.regr_slope(F.col("v"), F.col("pair_no").cast("double")).alias("slope"),
            F.count("v").alias("pair_count"),
        )
    )
