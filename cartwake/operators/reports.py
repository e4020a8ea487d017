"""Counts, distributions and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwake.layout import bucket_index
from cartwake.sources.files import stored

NUMERIC = ("double", "float", "bigint", "int", "smallint", "tinyint")


def reason_counts(rows: DataFrame) -> DataFrame:
    """Abandon reasons among abandoned sessions."""
    return (
        rows.filter(F.col("abandoned") == 1)
        .groupBy("abandon_reason")
        .agg(F.count(F.lit(1)).alias("session_count"))
    )


def describe(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mean, deviation, minimum and maximum of each numeric column, long form.

    One pass aggregates every column; the single result row is then unpivoted.
    """
    names = columns or [n for n, k in rows.dtypes if k in NUMERIC]
    aggs: list[Column] = []
    for n in names:
        c = F.col(n).cast("double")
        aggs.append(
            F.struct(
                F.lit(n).alias("feature"),
                F.round(F.avg(c), 2).alias("mean"),
                F.round(F.stddev_samp(c), 2).alias("std"),
                F.round(F.min(c), 2).alias("min"),
                F.round(F.max(c), 2).alias("max"),
            ).alias(n)
        )
    one = rows.agg(*aggs)
    return one.select(F.explode(F.array(*names)).alias("s")).select("s.*").filter(
        F.col("mean").isNotNull()
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    """Totals over all sessions, one row.

    Sessions are counted by their first terminal event.
    """
    kind = F.col("event_type")
    ends = F.when(kind.isin("purchase", "abandon"), F.struct("ts_us", "event_id"))
    per_session = df.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(kind == "heartbeat").alias("beats"),
        F.min_by(kind, ends).alias("terminal"),
    )
    sessions = F.count(F.lit(1))
    abandons = F.count_if(F.col("terminal") == "abandon")
    return per_session.agg(
        sessions.alias("session_count"),
        F.sum("n").alias("total_events"),
        F.round(F.sum("n") / sessions, 1).alias("avg_events_per_session"),
        F.round(F.sum("beats") / sessions, 1).alias("avg_heartbeats_per_session"),
        abandons.alias("abandon_count"),
        F.count_if(F.col("terminal") == "purchase").alias("purchase_count"),
        F.round(abandons / sessions * 100, 2).alias("abandon_rate_pct"),
    )


def event_type_counts(df: DataFrame) -> DataFrame:
    """Events of the six reported types per session."""
    kinds = {
        "heartbeats": "heartbeat",
        "adds": "add_to_cart",
        "removes": "remove_from_cart",
        "checkouts": "start_checkout",
        "abandons": "abandon",
        "purchases": "purchase",
    }
    return df.groupBy("session_id").agg(
        *[F.count_if(F.col("event_type") == k).alias(n) for n, k in kinds.items()]
    )


def class_distribution(rows: DataFrame, split: str = "split", label: str = "abandoned"):
    """Rows of each class in each split, one row per split."""
    return rows.groupBy(split).agg(
        F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")
    )


def latency_percentiles(
    df: DataFrame, column: str, by: list[str], ranges: int = 64
) -> DataFrame:
    """50th, 95th and 99th percentile of a duration, interpolated between exact ranks.

    Rows first collapse to counts per distinct value.  Their running counts are taken
    inside value ranges with the counts before each as a carry, so no task sorts all values
    of a key; only the two values around each rank are looked at in the end.
    """
    shares = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    value = F.col(column).cast("double")
    counts = stored(
        df.filter(F.col(column).isNotNull()).groupBy(*by, value.alias("_v")).agg(F.count(F.lit(1)).alias("_n")),
        "durations",
    )
    grid = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    keys = counts.groupBy(*by).agg(F.percentile_approx("_v", grid).alias("_cuts"), F.sum("_n").alias("n"))
    rows = counts.join(keys, by).withColumn("_range", bucket_index(F.col("_v"), F.col("_cuts"), ranges.bit_length()))
    rows = rows.drop("_cuts")
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy(*by, "_range").agg(F.sum("_n").alias("_m")).select(
        *by, "_range", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(*by, "_range").orderBy("_v")
    rows = rows.withColumn("_to", F.sum("_n").over(inside)).join(carry, [*by, "_range"])
    rows = rows.withColumn("_to", F.col("_to") + F.col("_before")).withColumn("_from", F.col("_to") - F.col("_n"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_to")), F.col("_v")))

    ends = []
    for name, q in shares.items():
        rank = (F.col("n") - 1) * q
        ends += [at(F.floor(rank)).alias(f"_lo_{name}"), at(F.ceil(rank)).alias(f"_hi_{name}")]
    found = rows.groupBy(*by, "n").agg(*ends)
    out = []
    for name, q in shares.items():
        rank, lo, hi = (F.col("n") - 1) * q, F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((lo + (hi - lo) * (rank - F.floor(rank))).alias(name))
    return found.select(*by, "n", *out)
