"""Validation, typing, storage and streaming on small inputs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.operators import decision as D
from cartwake.operators import ingest as I
from cartwake.operators import tracking as T
from cartwake.plans.medallion import build_layers
from cartwake.sources import files
from cartwake.streaming import jobs

BASE = {"session_id": "s", "user_id": "u", "timestamp": "2026-07-24T18:30:00.000Z"}
CART = {"cart_value": 10.5, "product_count": 1, "product_quantities": {"prod_001": 2},
        "shipping_option_selected": "standard", "mouse_click_count": 3}
EXTRA = {
    "heartbeat": {**CART, "mouse_x": 1, "mouse_y": 2, "page": "cart"},
    "page_view": {**CART, "page": "cart"},
    "add_to_cart": {**CART, "product_id": "p", "category": "c", "price": 1},
    "remove_from_cart": CART,
    "start_checkout": {**CART, "payment_method_selected": None},
    "purchase": {**CART, "payment_method": None},
    "abandon": {**CART, "abandon_reason": "browsing"},
    "view_product": {"product_id": "p", "category": "c", "price": 1},
    "accept_offer": {"retention_type": "free_shipping"},
    "reject_offer": {"retention_type": "free_shipping"},
}


def lines(spark, *events):
    rows = [(e if isinstance(e, str) else json.dumps(e),) for e in events]
    return spark.createDataFrame(rows, "value string")


def errors(spark, *events, **kw):
    df = I.validate(I.parse_events(lines(spark, *events)), **kw)
    return [r["error"] for r in df.select("error").collect()]


def test_every_type_is_accepted(spark):
    assert set(EXTRA) == set(S.EVENT_TYPES)
    assert errors(spark, *[{**BASE, "event_type": k, **v} for k, v in EXTRA.items()]) == [None] * 10


@pytest.mark.parametrize("event, error", [
    ("not json", "Invalid JSON"),
    ({"event_type": "hover", **BASE}, "Invalid event_type: hover"),
    (BASE, "Invalid event_type: None"),
    ({**BASE, "event_type": "view_product", "price": 1}, "Missing required fields: ['product_id', 'category']"),
])
def test_refused(spark, event, error):
    assert errors(spark, event) == [error]


def test_only_a_type_lists_what_is_missing(spark):
    (error,) = errors(spark, {"event_type": "heartbeat"})
    assert "'session_id', 'user_id', 'timestamp', 'cart_value'" in error and error.endswith("'page']")


def test_selected_method_counts_only_on_request(spark):
    event = {**BASE, "event_type": "purchase", **CART, "payment_method_selected": "cash"}
    assert errors(spark, event) == ["Missing required fields: ['payment_method']"]
    assert errors(spark, event, accept_selected_method=True) == [None]


def test_bronze_defaults_and_bad_values(spark):
    events = I.parse_events(lines(
        spark,
        {**BASE, "event_type": "heartbeat", "cart_value": "oops", "product_count": 3.0},
        {**BASE, "timestamp": "soon", "event_type": "heartbeat"},
    ))
    row = I.bronze(events).first()
    assert (row["cart_value"], row["product_count"], row["mouse_x"]) == (0.0, 3, 0.0)
    assert (row["device"], row["page"], row["shipping_option_selected"]) == ("desktop", "catalog", "standard")
    assert row["product_quantities"] == "{}" and (row["year"], row["month"], row["day"]) == ("2026", "07", "24")
    assert I.bronze(events).count() == 1 and I.bad_timestamps(events).count() == 1


def test_text_is_parsed_once(spark):
    plan = I.parse_events(lines(spark, BASE)).select("page", "device")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def test_upsert_keeps_the_later_write(spark):
    df = spark.createDataFrame([("s", 1, 1, "a"), ("s", 1, 2, "b"), ("s", 2, 3, "c")], "k string, t int, n int, v string")
    assert sorted(r["v"] for r in I.last_per_key(df, ["k", "t"], ["n"]).collect()) == ["b", "c"]
    assert sorted(r["v"] for r in I.first_per_key(df, ["k", "t"], ["n"]).collect()) == ["a", "c"]


def test_tracking(spark):
    rows = [("s", 1, "catalog", 1), ("s", 2, "cart", 0), ("s", 3, "cart", 1), ("s", 4, "catalog", 1), ("t", 1, "catalog", 1)]
    df = spark.createDataFrame([(s, t, t, p, n) for s, t, p, n in rows], "session_id string, ts_us bigint, event_id bigint, page string, product_count int")
    assert [r["ts_us"] for r in T.tracking_gate(df).collect()] == [3]
    sent = {(r["session_id"], r["ts_us"]): r["sent_us"] for r in T.buffer_flush(df).collect()}
    assert sent == {("s", 1): 3, ("s", 2): 3, ("s", 3): 3}
    assert T.buffer_flush(df, limit=1).count() == 2
    assert T.tracking_gate(df, F.col("ts_us") == 3).count() == 0


def test_model_row_units_and_defaults(spark):
    row = D.model_row(D.payload(spark.createDataFrame([("s", 3.0, 1.5, 0.5, 10, "checkout")],
        "session_id string, idle_seconds double, dwell_seconds double, payment_hesitation_seconds double, mouse_click_count bigint, page string"))).first()
    assert (row["total_idle_ms"], row["total_dwell_ms"], row["payment_hesitation_ms"]) == (3000, 1500, 500)
    assert row["total_clicks"] == 10 and row["checkout_count"] == 1
    empty = D.model_row(D.payload(spark.range(1).select(F.lit("s").alias("session_id")))).first()
    assert (empty["total_idle_ms"], empty["heartbeat_count"], empty["checkout_count"]) == (0, 1, 0)
    assert list(empty.asDict()) == S.MODEL_COLUMNS


def test_payload_converts_to_seconds(spark):
    df = spark.createDataFrame([(3000, 2000)], "dwell_total_ms bigint, payment_hesitation_ms bigint")
    row = D.payload(df).first()
    assert (row["dwell_seconds"], row["payment_hesitation_seconds"]) == (3.0, 2.0)
    assert len(row) == 31 and row["velocity_trend"] == "stable"


@pytest.mark.parametrize("p, kind, want", [
    (0.7, "standard", (0.7, True, "free_shipping")), (0.95, "express", (0.95, True, "express_discount")),
    (0.69999, "express", (0.7, False, None)), (None, "express", (0.0, False, None))])
def test_decide(spark, p, kind, want):
    df = spark.createDataFrame([(p, kind)], "probability double, shipping_type string")
    row = D.decide(df).first()
    assert (row["abandon_probability"], row["trigger_retention"], row["retention_type"]) == want


@pytest.mark.parametrize("request_, error", [
    ({"session_id": "s", "user_id": "u"}, None),
    ({"session_id": "s"}, "Invalid fields: user_id"),
    ({"session_id": "s", "user_id": "u", "cart_value": "x"}, "Invalid fields: cart_value"),
    ({"session_id": "s", "user_id": "u", "cart_value": None}, "Invalid fields: cart_value"),
    ({"session_id": "s", "user_id": "u", "window_5s": None}, None),
    ({"session_id": "s", "user_id": "u", "window_5s": {"velocity_avg": 2.0}}, None),
    ("{", "Invalid JSON"),
])
def test_requests(spark, request_, error):
    assert D.parse_requests(lines(spark, request_)).first()["error"] == error


def test_state_items(spark, tables):
    rows = tables.clicks.select("event_id", "session_id", "event_type", "ts_us", "event_timestamp", F.lit(None).cast("double").alias("mouse_x"))
    item = files.state_items(rows, F.timestamp_seconds(F.lit(100))).first()
    assert item["ttl"] == 3700 and set(json.loads(item["item"])) == {"event_type"}


def test_layers(spark, tmp_path):
    raw = tmp_path / "raw.ndjson"
    raw.write_text("\n".join(json.dumps({**BASE, "event_type": k, **v}) for k, v in EXTRA.items())
                   + "\n" + json.dumps({"event_type": "heartbeat", "timestamp": "bad"}))
    rows = build_layers(spark, str(raw), str(tmp_path / "out"))
    assert rows == {"bronze_rows": 10, "rejected_rows": 1, "silver_rows": 1, "gold_rows": 1}
    gold = files.read_layer(spark, str(tmp_path / "out" / "gold")).first()
    assert gold["has_purchase"] == 1 and gold["has_abandon"] == 1 and gold["abandoned"] == 0


def test_compaction_takes_the_consolidated_file(spark, tmp_path):
    folder = tmp_path / "raw"
    (folder / "2026").mkdir(parents=True)
    (folder / "2026" / "one.json").write_text('{"a":1}\n')
    (folder / "2026" / "two.json").write_text('{"a":2}\n')
    (folder / "2026" / "notes.txt").write_text("no\n")
    files.compact(spark, str(folder), str(tmp_path / "a"), files=1)
    assert spark.read.text(str(tmp_path / "a")).count() == 2
    (folder / "all_events.ndjson").write_text('{"a":9}\n')
    files.compact(spark, str(folder), str(tmp_path / "b"))
    assert spark.read.text(str(tmp_path / "b")).count() == 1


def test_shared_folder_follows_the_session(spark):
    where = files.shared_folder(spark, "x")
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    assert os.path.basename(where).startswith("x-") and (base is None or where.startswith(base))


def test_stream_drops_repeats_and_keeps_order_state(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    beat = {**BASE, "event_type": "heartbeat", **EXTRA["heartbeat"]}
    beats = [{**beat, "event_id": i, "timestamp": f"2026-07-24T18:30:{i:02d}.000Z", "cart_value": i} for i in range(14)]
    (source / "a.json").write_text("\n".join(json.dumps(b) for b in [*beats, beats[3]]))
    events = jobs.without_repeats(jobs.typed_events(jobs.read_lines(spark, str(source))))
    out = str(tmp_path / "dedup")
    job = events.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "c0")).trigger(availableNow=True).start()
    job.awaitTermination(60)
    assert spark.read.parquet(out).count() == 14

    # A second file replays one event: the item is replaced, not added.
    def always(df):
        return df.withColumn("probability", F.lit(0.9))

    def run():
        typed = jobs.typed_events(jobs.read_lines(spark, str(source)))
        job = jobs.start_answers(typed, always, str(tmp_path / "out"), str(tmp_path / "c1"), items=12, warmup=10)
        job.awaitTermination(120)
        assert job.exception() is None

    (source / "a.json").unlink()
    (source / "b.json").write_text("\n".join(json.dumps(b) for b in beats[:11]))
    run()
    (source / "c.json").write_text("\n".join(json.dumps(b) for b in beats[11:]))
    run()
    got = spark.read.parquet(str(tmp_path / "out" / "answers")).orderBy("event_id").collect()
    # Warm after ten heartbeats; one offer, then none while it is among the newest twelve.
    assert [(r["event_id"], r["trigger_retention"]) for r in got] == [(9, True), *[(i, False) for i in range(10, 14)]]
    stored = spark.read.parquet(str(tmp_path / "out" / "features")).orderBy("event_id").collect()
    assert [r["history_beats"] for r in stored] == [*range(1, 12), 12, 12, 12]
    assert sum(r["velocity_trend"] is not None for r in stored) == 5


def test_a_day_is_few_files_and_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "layer")
    days = lambda *d: spark.range(400).selectExpr("id", "2026 as year", "7 as month", f"{d[0]} + id % {len(d)} as day").repartition(20)
    assert files.write_days(days(1, 2, 3), path) == 400
    each = [len(list(f.glob("*.parquet"))) for f in (tmp_path / "layer").glob("year=*/month=*/day=*")]
    assert len(each) == 3 and max(each) <= 2
    kept = {f for d in (1, 3) for f in (tmp_path / "layer").glob(f"year=*/month=*/day={d}/*.parquet")}
    assert files.write_days(days(2).limit(50), path) == 400 - 133 + 50
    assert kept == {f for d in (1, 3) for f in (tmp_path / "layer").glob(f"year=*/month=*/day={d}/*.parquet")}


def test_only_finished_batches_are_compacted(spark, tmp_path):
    raw, state = tmp_path / "raw", tmp_path / "state"
    for batch in range(4):
        folder = raw / f"batch={batch}" / "year=2026" / "month=07" / "day=24"
        folder.mkdir(parents=True)
        (folder / "a.txt").write_text(f"line {batch}")
    assert files.last_batch(spark, str(state)) == -1
    (state / "commits").mkdir(parents=True)
    for batch in (1, 2):
        (state / "commits" / str(batch)).write_text("v1\n{}")
    (state / "commits" / ".3.tmp").write_text("")
    files.compact(spark, str(raw), str(tmp_path / "out"), checkpoint=str(state))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["line 0", "line 1", "line 2"]


def test_requests_are_made_from_one_replay(tables):
    from cartwake.queries import QUERIES

    plan = QUERIES["parse_payload"](tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and plan.count("max_by") == 1
