from helpers import same
from pyspark.sql import functions as F

from cartwake.layout import PLAIN, SEG, TASK_ROWS, SessionLayout, bucket_index, profile_sessions
from cartwake.operators import motion, sessions


def test_profile_finds_the_hot_session(skewed, hot_layout):
    assert [k for k, _ in hot_layout.cuts] == ["s1"]
    sizes = hot_layout.split(skewed).filter("session_id = 's1'").groupBy(SEG).count()
    counts = [r["count"] for r in sizes.collect()]
    assert len(counts) >= 16 and max(counts) <= 60


def test_profile_of_ordinary_sessions_is_plain(tables):
    assert profile_sessions(tables.clicks) == PLAIN


def test_tasks_grow_with_the_rows(tables):
    usual = int(tables.spark.conf.get("spark.sql.shuffle.partitions"))
    many = SessionLayout(rows=5 * usual * TASK_ROWS)
    assert many.together(tables.clicks).rdd.getNumPartitions() == 5 * usual
    assert SessionLayout(rows=1).together(tables.clicks).rdd.getNumPartitions() <= usual
    assert profile_sessions(tables.clicks, fraction=1.0).rows == tables.clicks.count()


def test_bucket_index(spark):
    df = spark.createDataFrame([(v,) for v in (0, 10, 11, 25, 30, 99)], "v bigint")
    cuts = F.array(*[F.lit(c).cast("bigint") for c in (10, 20, 30)])
    got = [r[0] for r in df.select(bucket_index(F.col("v"), cuts, 2)).collect()]
    assert got == [0, 1, 1, 2, 3, 3]


def test_look_back_gives_whole_frames(skewed, hot_layout):
    def last_seven(df, layout):
        w = layout.window().rowsBetween(-6, 0)
        rows = layout.look_back(df, 6)
        rows = rows.withColumn("s", F.sum("ts_us").over(w)).withColumn(
            "n", F.count("*").over(w)
        )
        return layout.settle(rows).select("event_id", "s", "n")

    df = skewed.select("session_id", "ts_us", "event_id")
    same(last_seven(df, hot_layout), last_seven(df, PLAIN))


def test_look_back_across_short_segments(spark):
    # One row per segment, so a look-back of 3 spans three segments.
    df = spark.createDataFrame([("a", t, t) for t in range(10)], "session_id string, ts_us long, event_id long")
    cut = SessionLayout(cuts=(("a", tuple(range(1, 10))),))

    def three(layout):
        w = layout.window().rowsBetween(-3, 0)
        rows = layout.look_back(df, 3).withColumn("s", F.sum("ts_us").over(w))
        return layout.settle(rows).select("event_id", "s")

    same(three(cut), three(PLAIN))


def test_segments_without_a_sequence_still_see_it(spark):
    # Kind "x" appears only in the first segment; later rows look back past it.
    rows = [("a", t, t, "x" if t in (1, 2) else "y", t * t) for t in range(12)]
    df = spark.createDataFrame(rows, "session_id string, ts_us long, event_id long, kind string, v long")
    cut = SessionLayout(cuts=(("a", (3, 4, 8)),))

    def lags(layout):
        r = layout.look_back(df, 1, "kind")
        r = r.withColumn("any", F.lag("v").over(layout.window())).withColumn(
            "own", F.lag("v").over(layout.window("kind"))
        )
        return layout.settle(r).select("event_id", "any", "own")

    same(lags(cut), lags(PLAIN))


def test_null_session_can_be_hot(spark):
    df = spark.createDataFrame([(None, t, t) for t in range(40)], "session_id string, ts_us long, event_id long")
    layout = profile_sessions(df, hot_rows=10, segment_rows=5, fraction=1.0, max_segments=16)
    assert layout.hot
    rows = layout.look_back(df, 1).withColumn("p", F.lag("ts_us").over(layout.window()))
    got = {r["ts_us"]: r["p"] for r in layout.settle(rows).collect()}
    assert got == {t: (t - 1 if t else None) for t in range(40)}


def test_running_values_and_totals(skewed, hot_layout):
    df = skewed.select("session_id", "ts_us", "event_id", "qty", "page")

    def run(layout):
        out = layout.running_sum(df, total=F.col("qty"))
        out = layout.running_last(
            out, seen=F.when(F.col("page") == "checkout", F.col("ts_us"))
        )
        out = layout.totals(out, newest=F.max("ts_us"), n=F.count(F.lit(1)))
        return out.drop(SEG)

    same(run(hot_layout), run(PLAIN))


def test_hot_layout_keeps_silver_and_gold(skewed, hot_layout, tiny_layout):
    same(motion.silver(skewed, hot_layout).drop("product_quantities"),
         motion.silver(skewed).drop("product_quantities"))
    same(sessions.gold(skewed, hot_layout), sessions.gold(skewed))
    same(sessions.gold(skewed, tiny_layout), sessions.gold(skewed))
    same(sessions.gold_by_joins(skewed, hot_layout), sessions.gold(skewed))


def test_plain_gold_shuffles_once(tables):
    plan = sessions.gold(tables.clicks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def test_shuffle_invariance(skewed):
    same(sessions.gold(skewed.repartition(7)), sessions.gold(skewed))


def test_carries_move_no_rows(skewed, hot_layout, tmp_path):
    spark = skewed.sparkSession
    skewed.write.parquet(str(tmp_path / "clicks"))
    clicks = spark.read.parquet(str(tmp_path / "clicks"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = hot_layout.running_sum(clicks, position=F.lit(1))
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The rows to their segments; the sums of segments to three places.
    assert "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 4, plan
    same(rows.drop(SEG), PLAIN.running_sum(skewed, position=F.lit(1)))
