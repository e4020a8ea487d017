"""Every ordered operator gives the same rows with a hot session split up."""

import pytest
from helpers import same
from pyspark.sql import functions as F

from cartwake.functions import maps as M
from cartwake.functions.history import add_history_features
from cartwake.layout import PLAIN, SessionLayout, profile_sessions
from cartwake.operators import historical as H
from cartwake.operators import ingest as I
from cartwake.operators import journey as J
from cartwake.operators import online as O
from cartwake.operators import replay as R
from cartwake.operators import tracking as T
from cartwake.queries.online import flat_windows
from cartwake.queries.serve import linear_score, shipped


def text_maps(df):
    names = [n for n, k in df.dtypes if k.startswith("map")]
    return df.withColumns({n: M.sorted_json(F.col(n)) for n in names})


def labelled(df):
    return df.withColumns({"abandon_reason": F.lit(None).cast("string"), "payment_method": F.col("payment_method_selected")})


CASES = {
    "session": lambda d, l: O.session_features(d, l),
    "dwell": lambda d, l: O.dwell_segments(d, l),
    "cart": lambda d, l: text_maps(O.cart_features(d, l)),
    "funnel": lambda d, l: O.funnel_features(d, l),
    "funnel_no_nulls": lambda d, l: O.funnel_features(d, l, ignore_nulls=True),
    "all": lambda d, l: flat_windows(text_maps(O.all_features(d, l))),
    "changes": lambda d, l: O.value_changes(d, "page", l),
    "history": lambda d, l: H.session_features(d, l),
    "rows": lambda d, l: H.session_rows(labelled(d), l),
    "buffer": lambda d, l: text_maps(T.buffer_flush(d.withColumn("product_count", F.col("product_count") - 1), l, limit=3)),
    "sequence": lambda d, l: J.event_sequence(d, l),
    "terminal": lambda d, l: J.terminal_gap(d, l),
    "gate": lambda d, l: R.with_history(d, l, items=40, arrays=False).select("event_id", "history_beats", "offer_state"),
    "decisions": lambda d, l: R.decisions(shipped(d), linear_score, l, items=20),
}


@pytest.mark.parametrize("name", CASES)
def test_hot_equals_plain(name, skewed, hot_layout):
    same(CASES[name](skewed, hot_layout), CASES[name](skewed, PLAIN))


@pytest.mark.parametrize("name", ["funnel_no_nulls", "all", "rows"])
def test_tiny_segments_equal_plain(name, skewed, tiny_layout):
    same(CASES[name](skewed, tiny_layout), CASES[name](skewed, PLAIN))


def test_quality_flags(skewed):
    d = skewed.drop("product_quantities")
    arrival = profile_sessions(d, hot_rows=150, segment_rows=20, fraction=1.0, max_segments=64, order=("event_id",))
    assert arrival.hot
    same(I.quality_flags(d, arrival), I.quality_flags(d, SessionLayout(order=("event_id",))))


def test_offers_against_a_plain_walk(spark):
    """Greedy choice over many segments equals a loop."""
    import random

    rng = random.Random(3)
    rows = [("a", i, i * 10, i + 1) for i in range(3000) if rng.random() < 0.3]
    rows += [("b", i, i * 10, i + 1) for i in range(400)]
    df = spark.createDataFrame(rows, "session_id string, event_id bigint, ts_us bigint, position bigint")
    want, free = set(), {}
    for s, n, _, p in rows:
        if p >= free.get(s, 0):
            want.add((s, n))
            free[s] = p + 7
    for cuts in ((), tuple(range(100, 30000, 100)), tuple(range(10, 30000, 10))):
        layout = SessionLayout(cuts=(("a", cuts),)) if cuts else PLAIN
        got = {(r[0], r[1]) for r in R.offers_shown(df, layout, items=7).collect()}
        assert got == want


def test_offers_are_chosen_by_many_tasks(spark):
    """A few bytes of candidates are much work; they do not end up in one task."""
    df = spark.range(2000).select(
        F.concat(F.lit("s"), F.col("id") % 50).alias("session_id"), F.col("id").alias("event_id"),
        F.col("id").alias("ts_us"), (F.col("id") + 1).alias("position"))
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for layout in (PLAIN, SessionLayout(cuts=(("s1", tuple(range(100, 2000, 100))),))):
        assert R.offers_shown(df, layout).rdd.getNumPartitions() == usual > 1


def test_top_k_is_limited_before_the_shuffle(tables):
    plan = R.newest_items(tables.clicks)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before


def test_tallies_and_buffer_need_one_scan(spark, skewed, tmp_path):
    skewed.write.parquet(str(tmp_path / "clicks"))
    clicks = spark.read.parquet(str(tmp_path / "clicks"))
    builds = [lambda d: H.session_rows(labelled(d)), H.cart_features, H.funnel_features, O.all_features, T.buffer_flush]
    for build in builds:
        text = build(clicks)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in text
        assert (text.count("Exchange"), text.count("FileScan")) == (1, 1)


def test_tallies_of_pieces_add_up(skewed, tiny_layout):
    names = ["session_id", "product_removals", "product_additions"]
    want = H.product_tallies(skewed).select(*names)
    same(H.cart_features(skewed, tiny_layout).select(*names), want)
    same(H.cart_features(skewed).select(*names), want)


@pytest.mark.parametrize("limit", [1, 7])
def test_buffer_in_tiny_segments(skewed, tiny_layout, limit):
    d = skewed.withColumn("product_count", F.when(F.col("event_id") % 9 == 0, F.col("product_count")).otherwise(0))
    same(text_maps(T.buffer_flush(d, tiny_layout, limit)), text_maps(T.buffer_flush(d, PLAIN, limit)))


@pytest.mark.parametrize("window_s", [None, 2])
@pytest.mark.parametrize("items", [1, 7, 40])
def test_history_of_a_split_session_equals_a_plain_walk(skewed, hot_layout, monkeypatch, items, window_s):
    monkeypatch.setattr("cartwake.layout.BLOCK_ROWS", 50)
    found = skewed.select("session_id", "ts_us", "event_id", "event_type").collect()
    sessions = {}
    for r in sorted(found, key=lambda r: (r["ts_us"], r["event_id"])):
        sessions.setdefault(r["session_id"], []).append(r)
    want = {}
    for rows in sessions.values():
        for i, r in enumerate(rows):
            beats = [b["ts_us"] for b in rows[max(0, i - items + 1) : i + 1] if b["event_type"] == "heartbeat"]
            want[r["event_id"]] = [b for b in beats if window_s is None or b >= r["ts_us"] - window_s * 1_000_000]
    for layout in (PLAIN, hot_layout):
        rows = R.with_history(skewed, layout, items=items, window_s=window_s)
        got = {r["event_id"]: (r["us"], r["history_beats"]) for r in rows.select("event_id", "history.us", "history_beats").collect()}
        assert got == {e: (us, len(us)) for e, us in want.items()}
        counts = R.with_history(skewed, layout, items=items, window_s=window_s, arrays=False)
        assert "history" not in counts.columns
        assert {r["event_id"]: r["history_beats"] for r in counts.collect()} == {e: len(us) for e, us in want.items()}


def test_history_is_not_gathered_for_every_event(skewed, hot_layout, tmp_path):
    skewed.write.parquet(str(tmp_path / "clicks"))
    clicks = skewed.sparkSession.read.parquet(str(tmp_path / "clicks"))
    plan = R.enrich(clicks, hot_layout)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and not any("collect_list" in w for w in windows)
    # The rows to their segments and to their blocks; the sizes of segments twice.
    assert sum("Exchange hashpartitioning" in line for line in plan.split("\n")) == 4
    assert "SortMergeJoin" not in plan


def test_long_profile_reads_two_columns(spark):
    from cartwake.queries.base import Tables, long_instants
    from helpers import SMALL

    t = Tables(spark, SMALL)
    df = long_instants(t.clicks)
    same(df, t.long_clicks.select("session_id", "ts_us"))
    assert "max_by" not in df._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_measured_once_for_all_histories(skewed, hot_layout):
    where = R.gate() == "scored"
    for layout in (PLAIN, hot_layout):
        rows = R.with_history(skewed, layout, items=30, where=where).withColumn("status", R.gate())
        each = add_history_features(rows).withColumn(
            "heartbeat_count", F.when(F.col("history").isNotNull(), F.col("history_beats")))
        once = R.enrich(skewed, layout, items=30)
        plan = once._jdf.queryExecution().executedPlan().toString()
        assert plan.count("zip_with(") < each._jdf.queryExecution().executedPlan().toString().count("zip_with(")
        clear = lambda d: flat_windows(text_maps(d)).drop("history").filter("status = 'scored'")
        same(clear(once), clear(each))
