"""Split, scaling, metrics and models."""

import random

import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.ml import metrics, training
from cartwake.operators import sessions


@pytest.fixture(scope="module")
def gold(spark):
    from cartwake.queries import Tables

    return sessions.gold(Tables(spark, "/root/testdata/sf0.01").clicks).cache()


def scored(spark, rows):
    return spark.createDataFrame(rows, "score double, abandoned bigint")


def test_metrics_against_a_loop(spark):
    rng = random.Random(5)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.4)) for _ in range(600)]
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, tp, fp = 0.0, 0, 0
    for cut in sorted({s for s, _ in rows}, reverse=True):
        more = sum(1 for s, y in rows if s == cut and y)
        tp, fp = tp + more, fp + sum(1 for s, y in rows if s == cut and not y)
        ap += more / len(pos) * tp / (tp + fp)
    for ranges in (2, 8, 50):
        got = metrics.ranking(scored(spark, rows), ranges=ranges).first()
        assert got["auc_roc"] == pytest.approx(auc) and got["auc_pr"] == pytest.approx(ap)


def test_metrics_without_positives(spark):
    df = scored(spark, [(0.2, 0), (0.9, 0)])
    row = metrics.confusion(df).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["specificity"]) == (0, 0, 0, 0.5)
    assert metrics.ranking(df).first()["auc_roc"] is None


def test_threshold_grid_matches_confusion(spark):
    rng = random.Random(6)
    df = scored(spark, [(rng.random(), int(rng.random() < 0.5)) for _ in range(200)] + [(0.5, 1)])
    grid = metrics.by_threshold(df, [0.25, 0.5, 0.75])
    for r in grid.collect():
        want = metrics.confusion(df, threshold=r["threshold"]).first()
        assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (
            want["true_positives"], want["false_positives"], want["false_negatives"], want["true_negatives"])
    best = metrics.best_threshold(grid).first()
    assert best["f1_score"] == pytest.approx(max(r["f1_score"] for r in grid.collect()))


def test_split_is_exact_and_stable(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("s"), "id").alias("session_id"), (F.col("id") < 700).cast("bigint").alias("abandoned"))
    a = {r["session_id"] for r in training.stratified_split(df).filter("split = 'test'").collect()}
    b = {r["session_id"] for r in training.stratified_split(df.repartition(5)).filter("split = 'test'").collect()}
    assert a == b and len(a) == 200
    assert sum(int(s[1:]) < 700 for s in a) == 140
    assert df.count() == training.stratified_split(df).count()
    more = training.oversample(df)
    assert {r["abandoned"]: r["count"] for r in more.groupBy("abandoned").count().collect()} == {0: 700, 1: 700}


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = training.fit_scaler(df, ["a", "b"]).transform(df).orderBy("a").collect()
    assert [(r["z_a"], r["z_b"]) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]


def test_train_report_save_and_score(gold, tmp_path):
    model, report = training.train_and_report(gold, training.booster(maxIter=3, maxDepth=3))
    row = report.first()
    assert row["n_train"] + row["n_test"] == gold.count() and row["train_auc_roc"] > 0.7
    assert row["feature_cols"].split(",") == S.MODEL_COLUMNS
    training.save(model, str(tmp_path / "model"))
    again = training.load(str(tmp_path / "model"))
    a = training.score(model, gold, ("session_id",)).orderBy("session_id").collect()
    b = training.score(again, gold, ("session_id",)).orderBy("session_id").collect()
    assert a == b and all(0 <= r["probability"] <= 1 for r in a)


def test_training_tasks_follow_the_rows(gold, monkeypatch):
    tasks = []

    class Spy:
        def fit(self, rows):
            tasks.append(rows.rdd.getNumPartitions())
            return LogisticRegression(featuresCol="features", labelCol=S.LABEL, maxIter=1).fit(rows)

    training.fit(gold.repartition(40), Spy())
    monkeypatch.setattr(training, "FIT_ROWS", 3)
    training.fit(gold.repartition(40), Spy())
    assert tasks == [1, -(-gold.count() // 3)]


def test_unseen_device_fails(gold):
    model = training.fit(gold, LogisticRegression(featuresCol="features", labelCol=S.LABEL, maxIter=2))
    odd = gold.limit(1).withColumn("device", F.lit("watch"))
    with pytest.raises(Exception, match="(?i)unseen"):
        training.score(model, odd, ("session_id",)).collect()


def average_precision(rows):
    """Plain: precision at each positive, rows of equal score taken together."""
    hits = [sum(y for p, y in rows if p >= at) / sum(p >= at for p, _ in rows) for at, y in rows if y]
    return sum(hits) / len(hits) if hits else None


def test_candidates(gold):
    common = {"featuresCol": "features", "labelCol": S.LABEL, "weightCol": "weight"}
    kinds = {
        "logistic": LogisticRegression(maxIter=5, **common),
        "forest": RandomForestClassifier(numTrees=3, maxDepth=3, seed=1, **common)}
    scores = training.out_of_fold(gold, kinds, folds=3)
    rows = scores.collect()
    sessions = {r.session_id for r in gold.collect()}
    for name in kinds:
        assert sorted(r.session_id for r in rows if r.candidate == name) == sorted(sessions)
    found = {(r.candidate, r.fold): r for r in training.fold_metrics(scores).collect()}
    assert len(found) == 6
    for (name, fold), r in found.items():
        part = [(x.probability, x.abandoned) for x in rows if (x.candidate, x.fold) == (name, fold)]
        assert (r.n_rows, r.positives) == (len(part), sum(y for _, y in part))
        want = average_precision(part)
        assert r.auc_pr is None and want is None or abs(r.auc_pr - want) < 1e-9
    name, model, metrics = training.best_of(gold, kinds, folds=3)
    means = {n: sum((r.auc_pr or 0.0) for (c, _), r in found.items() if c == n) / 3 for n in kinds}
    assert means[name] == max(means.values()) and model is not None and metrics.count() == 6


def test_a_model_that_says_the_same_of_all_ranks_by_chance(spark):
    rows = [("c", 0, f"s{i}", int(i % 4 == 0), 0.5) for i in range(40)]
    scores = spark.createDataFrame(rows, "candidate string, fold int, session_id string, abandoned int, probability double")
    r = training.fold_metrics(scores).first()
    assert (r.auc_roc, r.auc_pr) == (0.5, 0.25)


def test_folds_deal_out_each_class(gold):
    counts = training.folds_of(gold, 3).groupBy("fold", S.LABEL).count().collect()
    for label in (0, 1):
        n = [r["count"] for r in counts if r[S.LABEL] == label]
        assert max(n) - min(n) <= 1 and len(n) == 3


def test_default_booster_has_the_fixed_settings():
    gbt = training.booster()
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize()) == (300, 6, 0.05)
    assert (gbt.getSubsamplingRate(), gbt.getFeatureSubsetStrategy()) == (0.8, "0.8")
