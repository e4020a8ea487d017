"""Streams on input that is shuffled, repeated, late or unreadable."""

import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwake.operators import replay as R
from cartwake.streaming import jobs, sessions

from helpers import same

BEAT = {"event_type": "heartbeat", "user_id": "u", "mouse_click_count": 0, "device": "desktop", "page": "cart",
        "cart_value": 5.0, "product_count": 1, "product_quantities": "{}", "shipping_option_selected": "standard",
        "delivery_mode": "shipping"}


def stamp(second):
    return f"2026-07-24T{10 + second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}.000Z"


def events(n, session="s"):
    return [{**BEAT, "session_id": session, "event_id": i, "timestamp": stamp(i), "mouse_x": i * 7 % 31, "mouse_y": i % 5,
             "cart_value": float(i)} for i in range(n)]


def high_at_50(df):
    return df.withColumn("probability", F.when(F.col("cart_value_max") % 50 == 0, 0.9).otherwise(0.1))


def run(spark, tmp_path, batches, name="a", score=high_at_50, **settings):
    source = tmp_path / f"in-{name}"
    source.mkdir()
    for i, lines in enumerate(batches):
        for f in source.iterdir():
            f.unlink()
        (source / f"{i}.json").write_text("\n".join(json.dumps(e) for e in lines))
        typed = jobs.typed_events(jobs.read_lines(spark, str(source)))
        job = jobs.start_answers(typed, score, str(tmp_path / f"out-{name}"), str(tmp_path / f"c-{name}"), **settings)
        job.awaitTermination(300)
        assert job.exception() is None
    read = spark.read.parquet
    return read(str(tmp_path / f"out-{name}" / "features")), read(str(tmp_path / f"out-{name}" / "answers"))


@pytest.mark.parametrize("limit", [50, 10_000])
def test_order_does_not_depend_on_frames(spark, tmp_path, limit):
    rows = events(12_000)
    random.Random(0).shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    try:
        features, answers = run(spark, tmp_path, [rows], items=20)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    bad = features.where(f"position <> event_id + 1 or history_beats <> least(20, event_id + 1)")
    assert features.count() == 12_000 and bad.count() == 0
    shown = [r.event_id for r in answers.where("trigger_retention").orderBy("event_id").collect()]
    assert shown == [e for e in range(50, 12_000, 50)]


def test_stream_equals_replay(spark, tmp_path):
    """In three batches and in one: the same answers as the stored events give."""
    rows = [e for s in ("a", "b", None) for e in events(300, s)]
    typed = jobs.ingest.bronze(jobs.ingest.parse_events(spark.createDataFrame([(json.dumps(e),) for e in rows], "value string")))
    want = R.decisions(
        typed.withColumns({"product_quantities": F.from_json("product_quantities", "map<string,bigint>"), "shipping_cost": F.lit(None).cast("double")}),
        high_at_50, items=20,
    )
    cut = [[e for e in rows if lo <= e["event_id"] < lo + 100] for lo in (0, 100, 200)]
    for name, batches in (("three", cut), ("one", [rows])):
        _, answers = run(spark, tmp_path, batches, name, items=20)
        same(answers.select(*want.columns), want)


def test_repeats_give_one_item_and_one_answer(spark, tmp_path):
    rows = events(30)
    later = {**rows[7], "event_id": 900, "cart_value": 50.0}  # the same instant, written later
    features, answers = run(spark, tmp_path, [[*rows[:20], rows[3], later], [*rows[15:], rows[19]]], items=20)
    assert features.groupBy("event_id").count().where("count > 1").count() <= 5  # 15..19 come in both batches
    first = features.where("batch = 0")
    assert first.count() == 20 and first.where("event_id = 7").count() == 0
    assert features.where("batch = 1").agg(F.max("position")).first()[0] == 30
    records = spark.read.json(str(tmp_path / "out-a" / "enriched"))
    assert records.count() == features.count()


def test_lost_offers_end_the_query(spark, tmp_path):
    import shutil

    rows = events(40)
    run(spark, tmp_path, [rows[:20]], "x")
    shutil.rmtree(tmp_path / "out-x" / "offers")
    (tmp_path / "in-x" / "0.json").unlink()
    (tmp_path / "in-x" / "1.json").write_text("\n".join(json.dumps(e) for e in rows[20:]))
    typed = jobs.typed_events(jobs.read_lines(spark, str(tmp_path / "in-x")))
    with pytest.raises(Exception, match="offers"):
        jobs.start_answers(typed, high_at_50, str(tmp_path / "out-x"), str(tmp_path / "c-x")).awaitTermination(120)


def test_failed_scores_are_neutral(spark, tmp_path):
    def fails(df):
        raise RuntimeError("no model")

    _, answers = run(spark, tmp_path, [events(30)], score=fails)
    assert answers.count() == 21
    assert answers.where("trigger_retention or abandon_probability <> 0 or retention_type is not null").count() == 0


def test_settings_of_the_session_stay(spark, tmp_path):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.noDataMicroBatches.enabled")}
    run(spark, tmp_path, [events(3)])
    assert before == {k: spark.conf.get(k, None) for k in before}


def test_no_line_is_lost(spark, tmp_path):
    base = events(1)[0]
    times = ["2026-07-24T18:30:00.000Z", "2026-07-24T18:30:00+02:00", "2026-07-24T18:30:00", 1785000000.5, "1785000000", "garbage", None, "NaN"]
    lines = [json.dumps({**base, "timestamp": t, "extra": {"a": [1, 2]}}) for t in times]
    lines += [lines[0], '{"cut', json.dumps({"event_type": "view"}), "[]"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    job = jobs.start_ingest(jobs.read_lines(spark, str(tmp_path / "in")), str(tmp_path / "raw"), str(tmp_path / "no"), str(tmp_path / "c"))
    job.awaitTermination(120)
    raw = spark.read.text(str(tmp_path / "raw"))
    assert set(raw.columns) == {"value", "batch", "year", "month", "day"}
    kept = sorted(r.value for r in raw.collect())
    assert kept == sorted([*lines[:5], lines[0]])
    refused = spark.read.json(str(tmp_path / "no"))
    assert sorted(r.value for r in refused.collect()) == sorted(lines[5:8] + lines[9:])
    assert refused.where("error = 'Invalid timestamp'").count() == 3


class Store:
    """State of one key as the processor sees it; counts what it reads and writes."""

    def __init__(self):
        self.map, self.value, self.writes = {}, None, 0

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        store = self

        class Value:
            exists = staticmethod(lambda: store.value is not None)
            get = staticmethod(lambda: store.value)
            update = staticmethod(lambda v: setattr(store, "value", v))

        return Value()

    def iterator(self):
        return ((k, v) for k, v in list(self.map.items()))

    def removeKey(self, k):
        del self.map[k]

    def updateValue(self, k, v):
        self.map[k], self.writes = v, self.writes + 1


def stored_rows(ids, at=None):
    names = list(sessions.EVENT_COLUMNS)
    rows = [dict.fromkeys(names) | {"session_id": "s", "event_id": i, "ts_us": i if at is None else at, "event_type": "heartbeat"} for i in ids]
    return iter([Row(**r) for r in rows])


def test_a_stored_item_is_emitted_once_per_batch():
    store, keeper = Store(), sessions.SessionItems(items=3)
    keeper.init(store)
    out = list(keeper.handleInputRows(("s",), stored_rows([5, 1, 9, 5]), None))
    assert [r.is_new for r in out] == [True] * 4 and {r.seen for r in out} == {0}
    out = list(keeper.handleInputRows(("s",), stored_rows([10, 9]), None))
    assert [r.event_id for r in out if not r.is_new] == [1, 5, 9] and {r.seen for r in out} == {3}
    assert store.value == (4,) and sorted(store.map) == [(5,), (9,), (10,)]


def test_state_writes_follow_the_new_events():
    store, keeper = Store(), sessions.SessionItems(items=150)
    keeper.init(store)
    list(keeper.handleInputRows(("s",), stored_rows(range(1000)), None))
    assert store.writes == 150 and len(store.map) == 150
    list(keeper.handleInputRows(("s",), stored_rows(range(1000, 1003)), None))
    assert store.writes == 153 and len(store.map) == 150 and store.value == (1003,)
    # Of one instant the larger event id of a batch counts, and any of a later batch.
    list(keeper.handleInputRows(("s",), stored_rows([7, 9, 8], at=2000), None))
    assert store.map[(2000,)][0] == 9
    list(keeper.handleInputRows(("s",), stored_rows([3], at=2000), None))
    assert store.map[(2000,)][0] == 3 and store.value == (1004,)


def test_events_pass_the_state_unchanged_as_one_text(spark, tmp_path):
    """Python converts each column of each row, so there are few; odd values come back as they were."""
    assert len(StructType.fromDDL(sessions.OUTPUT)) == 6
    schema = ", ".join(f"{n} {t}" for n, t in sessions.EVENT_COLUMNS.items())
    odd = dict.fromkeys(sessions.EVENT_COLUMNS) | {"ts_us": 1}
    rows = [
        odd | {"session_id": "s", "event_id": (1 << 62) + 1, "page": '"\\\n', "mouse_x": -0.0, "mouse_y": float("inf"), "user_id": ""},
        odd | {"session_id": None, "event_id": 2, "cart_value": 0.1 + 0.2, "product_quantities": '{"a":1}', "product_count": (1 << 53) + 1},
        odd | {"session_id": "t", "event_id": 3, "ts_us": None, "page": "\u00e9\U0001f600", "cart_value": 5e-324},
    ]
    spark.createDataFrame([tuple(r.values()) for r in rows], schema).write.parquet(str(tmp_path / "in"))
    kept = sessions.with_session_items(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    settings = {"spark.sql.streaming.stateStore.providerClass": sessions.ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    with jobs._settings(spark, settings):
        job = kept.writeStream.foreachBatch(lambda b, i: b.write.mode("append").parquet(str(tmp_path / "out"))).option(
            "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        job.awaitTermination(120)
    got = sorted(spark.read.parquet(str(tmp_path / "out")).drop("is_new", "seen").collect(), key=lambda r: r.event_id)
    want = sorted(rows, key=lambda r: r["event_id"])
    assert [repr(r.asDict()) for r in got] == [repr({n: r[n] for n in got[0].__fields__}) for r in want]


def test_items_expire(spark, tmp_path, monkeypatch):
    """With one second to live, an item of the batch before is gone."""
    plain = sessions.SessionItems
    monkeypatch.setattr(sessions, "SessionItems", lambda items, ttl_s: plain(items, 1))
    rows = events(40)
    features, _ = run(spark, tmp_path, [rows[:20], rows[20:]], items=30)
    last = {r.event_id: (r.position, r.history_beats) for r in features.collect()}
    assert last[19] == (20, 20) and last[39] == (20, 20)


def test_one_bad_row_gets_one_neutral_answer(spark, tmp_path):
    def score(df):
        odd = F.col("cart_value_max") == 27
        return df.withColumn("probability", F.when(odd, F.raise_error(F.lit("bad row"))).otherwise(F.lit(0.9)))

    _, answers = run(spark, tmp_path, [events(40)], score=score)
    found = {r.event_id: r for r in answers.collect()}
    assert sorted(found) == list(range(9, 40))
    assert found[27].abandon_probability == 0 and not found[27].trigger_retention
    # All others are scored; the first shows its offer, which suppresses the rest.
    assert [e for e, r in found.items() if r.trigger_retention] == [9]
    probe = spark.createDataFrame([("s", i, i * 1000, i, "x", float(i)) for i in range(200)], "session_id string, event_id long, ts_us long, position long, shipping_type string, cart_value_max double")
    assert [r.event_id for r in probe.where(jobs.unscorable(probe, score)).collect()] == [27]


def test_a_store_that_fails_ends_the_query(spark, tmp_path):
    (tmp_path / "out-a").mkdir()
    (tmp_path / "out-a" / "answers").write_text("a file where a folder should be")
    with pytest.raises(Exception, match="answers|out-a"):
        run(spark, tmp_path, [events(30)])


def test_offers_are_gathered_now_and_then(spark, tmp_path, monkeypatch):
    rows = [e for i in range(8) for e in events(12, f"s{i}")]
    cut = [[e for e in rows if e["session_id"] in (f"s{2 * i}", f"s{2 * i + 1}")] for i in range(4)]
    always = lambda df: df.withColumn("probability", F.lit(0.9))
    _, many = run(spark, tmp_path, [*cut, rows], "many", always, items=20)
    monkeypatch.setattr(jobs, "OFFER_BATCHES", 2)
    _, few = run(spark, tmp_path, [*cut, rows], "few", always, items=20)
    same(many, few)
    assert many.where("trigger_retention").count() == 8
    names = sorted(f.name for f in (tmp_path / "out-few" / "offers").iterdir())
    assert names == ["alive=2", "alive=4", *[f"batch={i}" for i in range(5)]]
    # A batch writes its own offers alone.
    for i in range(4):
        assert spark.read.parquet(str(tmp_path / "out-many" / "offers" / f"batch={i}")).count() == 2


def test_repeats_are_dropped_while_their_state_lives(spark, tmp_path):
    (tmp_path / "in").mkdir()
    found = []

    def feed(i, rows):
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(json.dumps(e) for e in rows))
        typed = jobs.typed_events(jobs.read_lines(spark, str(tmp_path / "in")))
        job = jobs.start_deduplicated(typed, str(tmp_path / "out"), str(tmp_path / "c"), delay="10 seconds")
        job.awaitTermination(120)
        found.append(job.lastProgress["stateOperators"][0]["numRowsTotal"])

    rows = events(200)
    feed(0, [*rows[:5], rows[2], rows[4]])
    feed(1, [rows[1], *rows[5:9]])
    feed(2, rows[100:105])
    feed(3, [rows[102], *rows[190:195]])
    read = spark.read.parquet(str(tmp_path / "out")).groupBy("event_id").count()
    assert {r.event_id: r["count"] for r in read.collect()} == {i: 1 for i in [*range(9), *range(100, 105), *range(190, 195)]}
    # State of events older than the delay is gone.
    assert max(found) <= 15
