"""Classifier metrics as aggregations over scored rows.

Ranking metrics first collapse to counts per distinct score.  The running counts
over those scores are taken inside score ranges, with the totals of the ranges
before each as a carry, so no task sorts all scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwake.layout import bucket_index
from cartwake.sources.files import stored


def _rate(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _derived(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    precision, recall = _rate(tp, tp + fp), _rate(tp, tp + fn)
    return {
        "precision": precision,
        "recall": recall,
        "f1_score": _rate(2 * tp.cast("double"), 2 * tp + fp + fn),
        "specificity": _rate(tn, tn + fp),
    }


def confusion(
    df: DataFrame, score: str = "score", label: str = "abandoned", threshold: float = 0.5
) -> DataFrame:
    """Confusion counts with precision, recall, F1 and specificity, one row.

    A ratio with nothing below the line is zero.
    """
    hit, pos = F.col(score) >= threshold, F.col(label) == 1
    counts = df.agg(
        F.count_if(hit & pos).alias("true_positives"),
        F.count_if(hit & ~pos).alias("false_positives"),
        F.count_if(~hit & pos).alias("false_negatives"),
        F.count_if(~hit & ~pos).alias("true_negatives"),
    )
    return counts.withColumns(
        _derived(*[F.col(f"{n}s") for n in (
            "true_positive", "false_positive", "false_negative", "true_negative")])
    )


def _running_counts(df: DataFrame, score: str, label: str, ranges: int | None) -> DataFrame:
    """Positives and negatives per distinct score and down to it."""
    spark = df.sparkSession
    n = ranges or max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    counts = df.groupBy((-F.col(score)).cast("double").alias("down")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    counts = stored(counts, "score-counts")
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    found = counts.agg(F.percentile_approx("down", shares).alias("q")).first()["q"]
    cuts = sorted(set(found or ()))
    at = bucket_index(F.col("down"), F.array(*[F.lit(c) for c in cuts]), len(cuts).bit_length())
    rows = counts.withColumn("_range", at if cuts else F.lit(0))
    inside = Window.partitionBy("_range").orderBy("down")
    # One row per score range.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy("_range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).select(
        "_range",
        F.coalesce(F.sum("p").over(before), F.lit(0)).alias("_p"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n"),
    )
    return rows.withColumns({"tp": F.sum("pos").over(inside), "fp": F.sum("neg").over(inside)}).join(
        carry, "_range"
    ).withColumns({"tp": F.col("tp") + F.col("_p"), "fp": F.col("fp") + F.col("_n")}).drop("_range", "_p", "_n")


def ranking(
    df: DataFrame, score: str = "score", label: str = "abandoned", ranges: int | None = None
) -> DataFrame:
    """``auc_roc`` and ``auc_pr`` (average precision, step sum), one row.

    Equal scores share a rank.  Both are null without positives, and the first
    also without negatives.
    """
    rows = _running_counts(df, score, label, ranges)
    lost = F.sum(F.col("pos") * (F.col("fp") - F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    gained = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return rows.agg(
        (F.lit(1.0) - F.try_divide(lost, pairs)).alias("auc_roc"),
        F.try_divide(gained, F.sum("pos")).alias("auc_pr"),
    )


def by_threshold(
    df: DataFrame, thresholds: list[float], score: str = "score", label: str = "abandoned"
) -> DataFrame:
    """Metrics at each threshold.

    Rows are counted by how many thresholds they reach, one pass whatever the
    number of thresholds; the sums run over those few counts.
    """
    grid = sorted(thresholds)
    cuts = F.array(*[F.lit(float(v)) for v in grid])
    reached = bucket_index(F.col(score).cast("double"), cuts, len(grid).bit_length())
    counts = df.groupBy(reached.alias("reached")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    at_least = [
        F.struct(
            F.lit(v).alias("threshold"),
            F.sum(F.when(F.col("reached") > i, F.col("pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(F.col("reached") > i, F.col("neg")).otherwise(0)).alias("fp"),
            F.sum(F.when(F.col("reached") <= i, F.col("pos")).otherwise(0)).alias("fn"),
            F.sum(F.when(F.col("reached") <= i, F.col("neg")).otherwise(0)).alias("tn"),
        )
        for i, v in enumerate(grid)
    ]
    rows = counts.agg(F.array(*at_least).alias("g")).select(F.inline("g"))
    return rows.withColumns(_derived(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def best_threshold(metrics: DataFrame) -> DataFrame:
    """The threshold with the highest F1, the lowest one on a tie."""
    best = F.max_by(
        F.struct("threshold", "f1_score", "precision", "recall"),
        F.struct(F.round("f1_score", 9).alias("f"), (-F.col("threshold")).alias("t")),
    )
    return metrics.agg(best.alias("b")).select("b.*")
