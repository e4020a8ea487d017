"""Validation, cleaning, storage and parsing queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwake.functions import maps as M
from cartwake.functions import scalar as X
from cartwake.operators import decision as D
from cartwake.operators import ingest as I
from cartwake.operators import replay as R
from cartwake.plans.medallion import build_layers
from cartwake.queries.base import CLICK, GOLD, ORACLES, Tables, as_long_sessions, query, rounded
from cartwake.queries.serve import LINEAR_SQL, MODEL_SQL, _PAYLOAD, REPLAY
from cartwake.queries.serve import linear_score, offer_clicks, payload_columns, shipped
from cartwake.sources import files
from cartwake.sources.click_view import raw_json
from cartwake.streaming import jobs


def messy_json(t: Tables) -> DataFrame:
    """Raw text in which some rows are cut off and some have an unknown type."""
    text = F.col("value")
    cut = F.when(text.contains('"mouse_click_count":100,'), F.substring(text, 1, 40))
    hover = F.when(
        text.contains('"device":"tablet"') & text.contains('"event_type":"heartbeat"'),
        F.replace(text, F.lit('"event_type":"heartbeat"'), F.lit('"event_type":"hover"')),
    )
    return raw_json(t.clicks).select(F.coalesce(cut, hover, text).alias("value"))


MESSY = CLICK + """,
messy as (
  select *, mouse_click_count = 100 as cut,
    case when device = 'tablet' and event_type = 'heartbeat' then 'hover' else event_type end as kind from click),
checked as (
  select event_id, case when cut then null else kind end as event_type, cut,
    case when cut then 'Invalid JSON' when kind = 'hover' then 'Invalid event_type: hover'
      when kind = 'purchase' and payment_method_selected is null then 'Missing required fields: [''payment_method'']'
      when kind = 'abandon' and product_count <= 2 then 'Missing required fields: [''abandon_reason'']' end as error
  from messy)"""


@query("validate_events", f"with {MESSY} select event_id, event_type, error from checked where not cut")
def _validate_events(t: Tables) -> DataFrame:
    checked = I.validate(I.parse_events(messy_json(t)))
    return checked.filter("event_id is not null").select(
        F.col("event_id").cast("bigint").alias("event_id"), "event_type", "error"
    )


@query(
    "reject_counts",
    f"with {MESSY} select error, count(*) as event_count from checked where error is not null group by error",
)
def _reject_counts(t: Tables) -> DataFrame:
    refused = I.rejected(I.validate(I.parse_events(messy_json(t))))
    return refused.groupBy("error").agg(F.count(F.lit(1)).alias("event_count"))


@query(
    "accepted_by_alias",
    f"with {MESSY} select event_type, count(*) as event_count from checked where error is null group by event_type",
)
def _accepted_by_alias(t: Tables) -> DataFrame:
    checked = I.validate(I.parse_events(messy_json(t)), accept_selected_method=True)
    return I.accepted(checked).groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


@query(
    "parse_timestamps",
    f"with {CLICK} select event_id, epoch_us(event_timestamp) as parsed_us from click",
)
def _parse_timestamps(t: Tables) -> DataFrame:
    ts, method = F.col("event_timestamp"), F.col("payment_method_selected")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    later = F.timestamp_add("HOUR", F.lit(2), ts)
    us = X.naive_micros(ts)
    seconds = F.format_string(
        "%d.%06d", F.call_function("div", us, F.lit(1_000_000)), us % 1_000_000
    )
    text = (
        F.when(method == "credit_card", F.concat(F.date_format(ts, iso), F.lit("Z")))
        .when(method == "debit_card", seconds)
        .otherwise(F.concat(F.date_format(later, iso), F.lit("+02:00")))
    )
    return t.clicks.select("event_id", X.any_timestamp_us(text).alias("parsed_us"))


@query(
    "dedup_events",
    f"""with {CLICK}, twice as (select *, ts_us // 1000000 as sec from click)
    select session_id, sec, event_id, event_type from (
      select *, row_number() over (partition by session_id, sec order by event_id) as rn from twice) where rn = 1""",
)
def _dedup_events(t: Tables) -> DataFrame:
    both = t.clicks.unionByName(t.clicks).withColumn("sec", X.floor_div(F.col("ts_us"), X.MICROS))
    return I.first_per_key(both, ["session_id", "sec"], ["event_id"]).select(
        "session_id", "sec", "event_id", "event_type"
    )


@query(
    "state_upsert",
    f"""with {CLICK}, s as (select *, ts_us // 1000000 as sec from click)
    select session_id, sec, event_id, event_type from (
      select *, row_number() over (partition by session_id, sec order by event_id desc) as rn from s) where rn = 1""",
)
def _state_upsert(t: Tables) -> DataFrame:
    rows = t.clicks.withColumn("sec", X.floor_div(F.col("ts_us"), X.MICROS))
    return I.last_per_key(rows, ["session_id", "sec"], ["event_id"]).select(
        "session_id", "sec", "event_id", "event_type"
    )


@query(
    "range_filter",
    f"with {CLICK} select event_id, session_id from click where ts_us >= 10000000 and ts_us < 50000000 and user_id not in ('u1', 'u2')",
)
def _range_filter(t: Tables) -> DataFrame:
    return I.in_time_range(t.clicks, 10_000_000, 50_000_000, ("u1", "u2")).select(
        "event_id", "session_id"
    )


@query(
    "quality_flags",
    f"""with {CLICK}, d as (
      select * replace (case when product_count = 3 then -cart_value else cart_value end as cart_value,
                        case when product_count = 4 then 0.0::double else mouse_x end as mouse_x,
                        case when product_count = 4 then 0.0::double else mouse_y end as mouse_y,
                        case when product_count = 5 then ts_us - 5000000 else ts_us end as ts_us) from click)
    select event_id,
      coalesce(sqrt(pow(mouse_x - lag(mouse_x) over w, 2) + pow(mouse_y - lag(mouse_y) over w, 2)) > 1500, false) as is_outlier,
      cart_value < 0 as is_negative_value, mouse_x = 0 and mouse_y = 0 as is_origin_mouse,
      coalesce(lag(ts_us) over w > ts_us, false) as is_out_of_order
    from d window w as (partition by session_id order by event_id)""",
)
def _quality_flags(t: Tables) -> DataFrame:
    n = F.col("product_count")
    damaged = t.clicks.withColumns(
        {
            "cart_value": F.when(n == 3, -F.col("cart_value")).otherwise(F.col("cart_value")),
            "mouse_x": F.when(n == 4, 0.0).otherwise(F.col("mouse_x")),
            "mouse_y": F.when(n == 4, 0.0).otherwise(F.col("mouse_y")),
            "ts_us": F.when(n == 5, F.col("ts_us") - 5_000_000).otherwise(F.col("ts_us")),
        }
    )
    return I.quality_flags(damaged, t.arrival, max_jump_px=1500.0).select(
        "event_id", "is_outlier", "is_negative_value", "is_origin_mouse", "is_out_of_order"
    )


KEY_SQL = """strftime(event_timestamp, '%Y/%m/%d') || '/' || {name} || '_' ||
  substr(sha256(session_id || '|' || event_type || '|' || ts_us || '|' || event_id), 1, 8) || '.json'"""


@query(
    "raw_keys",
    f"""with {CLICK} select event_id, 'raw/' || {KEY_SQL.format(name="event_type || '_' || session_id")} as raw_key,
    'enriched/' || {KEY_SQL.format(name="session_id || '_' || event_type")} as enriched_key from click""",
)
def _raw_keys(t: Tables) -> DataFrame:
    return t.clicks.select(
        "event_id", files.raw_key().alias("raw_key"), files.enriched_key().alias("enriched_key")
    )


@query(
    "state_items",
    f"""with {CLICK} select event_id, 1704070800 as ttl, cast(ts_us / 1000000.0 as decimal(18,6))::varchar as key_time,
      case when event_type in ('add_to_cart', 'view_product') then 'cart_value,device,event_type,page,product_id,user_id'
           else 'cart_value,device,event_type,page,user_id' end as fields,
      cast(round(cart_value, 4) as decimal(18,4))::double as cart_value from click""",
)
def _state_items(t: Tables) -> DataFrame:
    with_product = F.col("event_type").isin("add_to_cart", "view_product")
    rows = t.clicks.select(
        "event_id", "session_id", "ts_us", "event_timestamp", "event_type", "user_id", "device",
        "page", "cart_value", F.when(with_product, F.col("product_id")).alias("product_id"),
        F.lit("dropped").alias("not_whitelisted"),
    )
    items = files.state_items(rows, F.timestamp_seconds(F.lit(1_704_067_200)))
    return items.select(
        "event_id",
        "ttl",
        F.col("timestamp").cast("string").alias("key_time"),
        F.array_join(F.array_sort(F.json_object_keys("item")), ",").alias("fields"),
        F.get_json_object("item", "$.cart_value").cast("double").alias("cart_value"),
    )


@query(
    "decimal_state",
    f"""with {CLICK} select event_id, cast(cart_value as decimal(18,4)) as cart_value,
      '{{"' || product_id || '":' || qty || '.0000}}' as quantities from click""",
)
def _decimal_state(t: Tables) -> DataFrame:
    return t.carts.select(
        "event_id",
        F.col("cart_value").cast("decimal(18,4)").alias("cart_value"),
        F.to_json(M.decimal_map(F.col("product_quantities"))).alias("quantities"),
    )


@query(
    "ndjson_roundtrip",
    f"with {CLICK} select event_id, session_id, event_type, cart_value, event_timestamp from click",
)
def _ndjson_roundtrip(t: Tables) -> DataFrame:
    path = files.shared_folder(t.spark, "ndjson")
    raw_json(t.clicks).write.mode("overwrite").text(path)
    return I.bronze(files.read_raw(t.spark, path)).select(
        "event_id", "session_id", "event_type", "cart_value", "event_timestamp"
    )


@query(
    "compaction",
    f"with {CLICK} select event_type, count(*) as event_count, sum(product_count)::bigint as products from click group by event_type",
)
def _compaction(t: Tables) -> DataFrame:
    small = files.shared_folder(t.spark, "small")
    packed = files.shared_folder(t.spark, "packed")
    files.write_raw(t.clicks, small)
    files.compact(t.spark, small, packed)
    rows = files.read_raw(t.spark, packed)
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum(F.col("product_count").cast("bigint")).alias("products"),
    )


@query(
    "layer_rows",
    f"""with {GOLD} select (select count(*) from click) as bronze_rows, 0 as rejected_rows,
    (select count(*) from silver) as silver_rows, (select count(*) from gold) as gold_rows""",
)
def _layer_rows(t: Tables) -> DataFrame:
    raw = files.shared_folder(t.spark, "raw")
    out = files.shared_folder(t.spark, "layers")
    raw_json(t.clicks).write.mode("overwrite").text(raw)
    rows = build_layers(t.spark, raw, out, t.layout, gold_by_date=True)
    counted = {
        "bronze_rows": "bronze", "rejected_rows": "rejects", "silver_rows": "silver",
        "gold_rows": "gold",
    }
    assert set(rows) == set(counted)
    one = None
    for name, layer in counted.items():
        n = files.read_layer(t.spark, f"{out}/{layer}").agg(F.count(F.lit(1)).alias("n"))
        n = n.select(F.lit(name).alias("layer"), "n")
        one = n if one is None else one.unionByName(n)
    return one.groupBy().pivot("layer", list(counted)).agg(F.first("n"))


@query(
    "gold_by_date",
    f"with {GOLD}, {{d}} select year, month, day, count(*) as session_count, sum(abandoned)::bigint as abandoned from d group by year, month, day".replace(
        "{d}",
        "d as (select gold.*, strftime(s, '%Y') as year, strftime(s, '%m') as month, strftime(s, '%d') as day from gold left join "
        "(select session_id, min(event_timestamp) + to_days(any_value(cast(substr(user_id, 2) as int) % 40)) as s from silver group by session_id) using (session_id))",
    ),
)
def _gold_by_date(t: Tables) -> DataFrame:
    from cartwake.operators.sessions import gold

    out = files.shared_folder(t.spark, "gold")
    # The view lasts a minute; moved by user, its sessions lie on forty days.
    days = F.substring("user_id", 2, 20).cast("int") % 40
    moved = gold(t.clicks, t.layout).withColumn("session_start", F.timestamp_add("DAY", days, F.col("session_start")))
    rows = files.date_columns(moved, "session_start")
    files.write_layer(rows, out, ("year", "month", "day"))
    back = files.read_layer(t.spark, out, rows.schema)
    return back.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("session_count"), F.sum("abandoned").alias("abandoned")
    )


@query(
    "ndjson_writer",
    f"with {CLICK} select event_id, session_id, event_type, round(cart_value, 4) + 0.0 as cart_value, event_timestamp, ts_us, product_count from click",
)
def _ndjson_writer(t: Tables) -> DataFrame:
    path = files.shared_folder(t.spark, "written")
    rows = t.clicks.select("event_id", "session_id", "event_type", "cart_value", "event_timestamp", "ts_us", "product_count")
    files.write_ndjson(rows, path)
    return rounded(t.spark.read.schema(rows.schema).json(path))


@query(
    "raw_bodies",
    f"""with {MESSY}, o as (
      select checked.event_id, checked.error, click.payment_method_selected as method, click.event_timestamp as ts, click.device
      from checked join click using (event_id) where not checked.cut)
    select event_id, case when error is not null then error when device = 'mobile' and method is null then 'Invalid timestamp' else 'stored' end as outcome,
      case when error is null and not (device = 'mobile' and method is null) then strftime(ts, '%Y-%m-%d') end as day, 'kept' as extra from o""",
)
def _raw_bodies(t: Tables) -> DataFrame:
    """Every line is stored as posted or refused with its reason, whatever form its time has."""
    text = F.get_json_object("value", "$.timestamp")
    ts = F.substring(text, 1, 26).try_cast("timestamp_ntz")
    method = F.get_json_object("value", "$.payment_method_selected")
    other = (
        F.when(method == "credit_card", F.concat(F.lit('"'), text, F.lit('"')))
        .when(method == "debit_card", F.date_format(F.timestamp_add("HOUR", F.lit(2), ts), "'\"'yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00\"'"))
        .when(F.get_json_object("value", "$.device") == "mobile", F.lit('"garbage"'))
        .otherwise(F.date_format(ts, "'\"'yyyy-MM-dd'T'HH:mm:ss.SSSSSS'\"'"))
    )
    changed = F.regexp_replace(F.col("value"), F.lit('"timestamp":"[^"]*"'), F.concat(F.lit('"extra":"kept","timestamp":'), other))
    folder = files.shared_folder(t.spark, "bodies")
    messy_json(t).select(F.coalesce(changed, F.col("value")).alias("value")).write.text(f"{folder}/in")
    job = jobs.start_ingest(jobs.read_lines(t.spark, f"{folder}/in"), f"{folder}/raw", f"{folder}/no", f"{folder}/checkpoint")
    job.awaitTermination()
    stored = t.spark.read.schema("value string, batch bigint, year string, month string, day string").text(f"{folder}/raw")
    day = F.concat_ws("-", "year", "month", "day")
    refused = t.spark.read.schema("value string, error string, batch bigint").json(f"{folder}/no")
    rows = stored.select("value", F.lit("stored").alias("outcome"), day.alias("day")).unionByName(
        refused.select("value", F.col("error").alias("outcome"), F.lit(None).cast("string").alias("day"))
    )
    return rows.select(
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), "outcome", "day",
        F.get_json_object("value", "$.extra").alias("extra"),
    ).filter("event_id is not null")


@query("parse_payload", ORACLES["payload"])
def _parse_payload(t: Tables) -> DataFrame:
    """All fields of a request through JSON text and back."""
    rows = R.enrich(shipped(offer_clicks(t)), t.long_layout).filter("status = 'scored'")
    sent = D.payload(rows, ("event_id",))
    fields = [c for c in sent.columns if c != "event_id"]
    text = sent.select(F.to_json(F.struct(F.col("event_id").cast("string").alias("session_id"), *[c for c in fields if c != "session_id"])).alias("value"))
    back = D.parse_requests(text).filter("error is null").withColumn("event_id", F.col("session_id").cast("bigint"))
    # The session as the events have it: the features are not made a second time for it.
    return payload_columns(back.drop("session_id").join(as_long_sessions(t.clicks).select("event_id", "session_id"), "event_id"))


@query(
    "parse_requests",
    f"""with {CLICK} select event_id::varchar as session_id, case when device = 'tablet' then 'Invalid fields: product_count' end as error,
      cart_value, case when device = 'tablet' then 0 else product_count end as product_count,
      case when page = 'catalog' then 'cart' else page end as page, 'stable' as velocity_trend from click""",
)
def _parse_requests(t: Tables) -> DataFrame:
    fields = t.clicks.select(
        F.col("event_id").cast("string").alias("session_id"), "user_id", "cart_value",
        F.when(F.col("device") == "tablet", "many")
        .otherwise(F.col("product_count").cast("string")).alias("product_count"),
        F.when(F.col("page") != "catalog", F.col("page")).alias("page"),
    )
    text = fields.select(F.to_json(F.struct(*fields.columns)).alias("value"))
    return D.parse_requests(text).select(
        "session_id", "error", "cart_value", "product_count", "page", "velocity_trend"
    )


@query(
    "enriched_records",
    f"""with {REPLAY}, {_PAYLOAD}, {MODEL_SQL}, p as (select event_id, {LINEAR_SQL} as probability from mrow)
    select event_id, 'enriched/' || {KEY_SQL.format(name="session_id || '_' || event_type")} as enriched_key,
      coalesce(rf.heartbeat_count, 0) as heartbeat_count, rid is not null as has_features,
      coalesce(round(p.probability, 4), 0.0) as abandon_probability
    from st left join (select event_id as rid, heartbeat_count from rf) rf on st.event_id = rid left join (select event_id as pid, probability from p) p on st.event_id = pid""",
)
def _enriched_records(t: Tables) -> DataFrame:
    rows = R.enrich(shipped(offer_clicks(t)), t.long_layout)
    rows = rows.withColumns(
        {
            "cart_value_max": F.col("cart_value"),
            "checkout_count": (F.col("page") == "checkout").cast("bigint"),
        }
    )
    scored = linear_score(rows).withColumn(
        "probability", F.when(F.col("velocity_trend").isNotNull(), F.col("probability"))
    )
    records = files.enriched_records(
        D.decide(scored),
        ["velocity_avg", "velocity_trend", "idle_total_ms", "window_5s"],
        ["session_id", "event_type", "cart_value", "page"],
        F.current_timestamp(),
    )
    record = F.col("record")
    return records.select(
        "event_id",
        "enriched_key",
        F.get_json_object(record, "$.heartbeat_count").cast("bigint").alias("heartbeat_count"),
        F.get_json_object(record, "$.features").isNotNull().alias("has_features"),
        F.get_json_object(record, "$.inference.abandon_probability").cast("double").alias(
            "abandon_probability"
        ),
    )
