"""From gold rows to a saved model: split, weights, scaling, fit, report."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.layout import SEG, SessionLayout
from cartwake.ml import metrics
from cartwake.ml.neighbours import nearest
from cartwake.sources.files import stored

CODE = "device_code"
FEATURES = [*S.MODEL_NUMERIC, CODE]
_HASH_SPAN = 1 << 48
#: Training rows of one task.  A fit makes some 2,000 jobs over the same rows, so tasks follow
#: the rows and not the shuffle partitions of the session.
FIT_ROWS = 50_000


def numeric_matrix(gold: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Model numbers as doubles, zero where absent or unreadable, and the device."""
    from cartwake.operators.decision import backfill

    device = F.coalesce(F.col("device").cast("string"), F.lit("unknown")).alias("device")
    numbers = backfill(gold.withColumn("device", device), keep=("device", *keep))
    return numbers


def device_indexer() -> StringIndexer:
    """Codes in alphabetical order; an unseen device fails at scoring."""
    return StringIndexer(
        inputCol="device", outputCol=CODE, stringOrderType="alphabetAsc", handleInvalid="error"
    )


# -- split ------------------------------------------------------------------
def class_positions(
    df: DataFrame, label: str = S.LABEL, key: str = "session_id", seed: int = S.SEED,
    pieces: int | None = None,
) -> DataFrame:
    """Add ``position`` and ``class_size``: a shuffled order inside each class.

    The order is that of a hash of the key.  A hash is spread evenly, so fixed
    cut points divide even a class with nearly all rows into equal ``pieces``; by default
    there are as many as the session has shuffle partitions.
    """
    if pieces is None:
        pieces = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    rows = df.withColumns(
        {"_d": digest, "_h": F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")}
    )
    cuts = tuple(_HASH_SPAN // pieces * i for i in range(1, pieces))
    layout = SessionLayout(
        cuts=(("0", cuts), ("1", cuts)), key=label, order=("_h", "_d", key)
    )
    rows = layout.running_sum(rows, position=F.lit(1).cast("bigint"))
    rows = layout.totals(rows, class_size=F.count(F.lit(1)))
    return rows.drop("_d", "_h", SEG)


def stratified_split(
    df: DataFrame, label: str = S.LABEL, key: str = "session_id", test_share: float = S.TEST_SHARE,
    seed: int = S.SEED,
) -> DataFrame:
    """Add ``split``; the test share is the same in each class, to the row."""
    rows = class_positions(df, label, key, seed)
    wanted = F.floor(F.col("class_size") * test_share + 0.5)
    split = F.when(F.col("position") <= wanted, "test").otherwise("train")
    return rows.withColumn("split", split).drop("position", "class_size")


def class_counts(df: DataFrame, label: str = S.LABEL) -> tuple[int, int]:
    row = df.agg(
        F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")
    ).first()
    return row["neg"], row["pos"]


def with_class_weight(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Weight positives by negatives over positives."""
    return _weighted(df, *class_counts(df, label), label)


def _weighted(df: DataFrame, neg: int, pos: int, label: str = S.LABEL) -> DataFrame:
    weight = F.when(F.col(label) == 1, neg / max(pos, 1)).otherwise(1.0)
    return df.withColumn("weight", weight)


def oversample(
    df: DataFrame, label: str = S.LABEL, key: str = "session_id", seed: int = S.SEED
) -> DataFrame:
    """Repeat rows of the smaller class until both are equally large.

    ``copy`` numbers the copies.  Every row is repeated equally often, and as many
    rows as are left over, in hash order, once more.
    """
    neg, pos = class_counts(df, label)
    largest = max(neg, pos)
    rows = class_positions(df, label, key, seed)
    size = F.col("class_size")
    base = F.call_function("div", F.lit(largest).cast("bigint"), size)
    extra = (F.col("position") <= F.lit(largest) - base * size).cast("bigint")
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), base + extra)))
    return copies.drop("position", "class_size")


def synthetic_minority(
    df: DataFrame, columns: list[str], label: str = S.LABEL, key: str = "session_id",
    k: int = S.SMOTE_NEIGHBOURS, seed: int = S.SEED,
) -> DataFrame:
    """New rows of the smaller class, as many as it lacks.

    Each lies between a row of the class and one of its ``k`` nearest rows of the class, by
    the z-scores of ``columns`` over the class.  Rows are used equally often, as far as that
    goes, and those left over in hash order; which neighbour and how far follow from a hash
    of seed, key and copy, so a rerun makes the same rows.  Columns: ``key`` (of the row it
    starts from), ``copy``, ``neighbour``, ``share`` (0 at the row, below 1), the label and
    ``columns``.  A class of one row has no neighbour and gives none.
    """
    neg, pos = class_counts(df, label)
    small, lack = (0, pos - neg) if neg < pos else (1, neg - pos)
    few = df.where(F.col(label) == small).select(key, label, *[F.col(c).cast("double").alias(c) for c in columns])
    scaled = fit_scaler(few, columns).transform(few)
    pairs = nearest(scaled.select(F.col(key).cast("string").alias("key"), F.array(*[f"z_{c}" for c in columns]).alias("v")), k)
    pairs = pairs.withColumnRenamed("key", "_key")

    size = F.col("class_size")
    base = F.call_function("div", F.lit(lack).cast("bigint"), size)
    times = base + (F.col("position") <= F.lit(lack) - base * size).cast("bigint")
    made = class_positions(few.select(key, label), label, key, seed).where(times > 0)
    made = made.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), times)))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.col("copy").cast("string")))
    part = lambda start: F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
    known = pairs.groupBy("_key").agg(F.max("rank").alias("_known"))
    made = made.join(known, F.col(key).cast("string") == F.col("_key")).drop("_key").select(
        key, label, "copy", (part(1) % F.col("_known") + 1).alias("_rank"), (part(9) / F.lit(float(1 << 32))).alias("share")
    )
    made = made.join(pairs, (F.col(key).cast("string") == F.col("_key")) & (F.col("_rank") == F.col("rank")))
    ends = [few.select(F.col(key).cast("string").alias(f"_{n}"), *[F.col(c).alias(f"_{n}_{c}") for c in columns]) for n in "ab"]
    made = made.join(ends[0], F.col(key).cast("string") == F.col("_a")).join(ends[1], F.col("neighbour") == F.col("_b"))
    between = [(F.col(f"_a_{c}") + F.col("share") * (F.col(f"_b_{c}") - F.col(f"_a_{c}"))).alias(c) for c in columns]
    return made.select(key, "copy", "neighbour", "share", label, *between)


# -- scaling ----------------------------------------------------------------
def fit_scaler(df: DataFrame, columns: list[str]) -> SQLTransformer:
    """Zero mean and unit population deviation, as a stage that can be saved.

    A column that never varies is only centred.
    """
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    ).first()
    terms = []
    for c in columns:
        mean, std = row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 0.0
        terms.append(f"({c} - {float(mean)!r}D) / {float(std or 1.0)!r}D AS z_{c}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


# -- fit --------------------------------------------------------------------
def booster(**changes) -> GBTClassifier:
    settings = {**S.BOOSTING, **changes}
    return GBTClassifier(
        featuresCol="features", labelCol=S.LABEL, weightCol="weight", seed=S.SEED, **settings
    )


def fit(train: DataFrame, classifier: Estimator | None = None, fit_on: DataFrame | None = None):
    """Fit encoder, scaler and classifier on gold rows.

    ``fit_on`` gives other rows to the encoder and the scaler (all rows, to match
    a run that scales before it splits); by default they see ``train`` alone.
    """
    keep = (S.LABEL,) if S.LABEL in train.columns else ()
    rows = numeric_matrix(train, keep)
    base = rows if fit_on is None else numeric_matrix(fit_on)
    indexer = device_indexer().fit(base)
    scaler = fit_scaler(indexer.transform(base), FEATURES)
    assembler = VectorAssembler(inputCols=[f"z_{c}" for c in FEATURES], outputCol="features")
    prepare = PipelineModel([indexer, scaler, assembler])
    neg, pos = class_counts(rows)
    ready = _weighted(prepare.transform(rows).select(S.LABEL, "features"), neg, pos)
    ready = ready.repartition(-(-(neg + pos) // FIT_ROWS) or 1).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = (classifier or booster()).fit(ready)
    finally:
        ready.unpersist()
    return PipelineModel([indexer, scaler, assembler, fitted])


def score(model: PipelineModel, rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Abandon probability of gold rows or of request model rows."""
    out = model.transform(numeric_matrix(rows, keep))
    return out.select(*keep, vector_to_array("probability")[1].alias("probability"))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# -- report -----------------------------------------------------------------
def report(
    test: DataFrame, train: DataFrame | None = None, score_col: str = "probability"
) -> DataFrame:
    """Test metrics, train ranking metrics and class counts, one row."""
    spark = test.sparkSession
    found = {
        **metrics.confusion(test, score_col, threshold=0.5).first().asDict(),
        **metrics.ranking(test, score_col).first().asDict(),
    }
    neg, pos = class_counts(test)
    found |= {"n_test": neg + pos, "test_neg": neg, "test_pos": pos}
    if train is not None:
        neg, pos = class_counts(train)
        ranks = metrics.ranking(train, score_col).first()
        found |= {
            "train_auc_roc": ranks["auc_roc"], "train_auc_pr": ranks["auc_pr"],
            "n_train": neg + pos, "train_neg": neg, "train_pos": pos,
        }
    found["feature_cols"] = ",".join(S.MODEL_COLUMNS)
    return spark.createDataFrame([found])


def train_and_report(
    gold: DataFrame, classifier: Estimator | None = None, fit_on_all: bool = False
) -> tuple[PipelineModel, DataFrame]:
    """Split, fit, score both parts and report."""
    split = stratified_split(gold).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, test = (split.filter(F.col("split") == n) for n in ("train", "test"))
        model = fit(train, classifier, split if fit_on_all else None)
        scored = [
            score(model, part, ("session_id", S.LABEL)).persist(StorageLevel.MEMORY_AND_DISK)
            for part in (test, train)
        ]
        found = report(*scored)
        for part in scored:
            part.unpersist()
        return model, found
    finally:
        split.unpersist()


def folds_of(
    df: DataFrame, folds: int = S.FOLDS, label: str = S.LABEL, key: str = "session_id", seed: int = S.SEED
) -> DataFrame:
    """Add ``fold`` (from 0); each class is dealt out in hash order, so folds differ by one row of it."""
    rows = class_positions(df, label, key, seed)
    return rows.withColumn("fold", ((F.col("position") - 1) % folds).cast("int")).drop("position", "class_size")


def candidates(**changes) -> dict[str, Estimator]:
    """The kinds of model that are compared: a linear one, a forest and boosted trees."""
    settings = {"featuresCol": "features", "labelCol": S.LABEL, "weightCol": "weight"}
    return {
        "linear": LogisticRegression(regParam=0.01, **settings),
        "forest": RandomForestClassifier(numTrees=S.FOREST_TREES, maxDepth=S.BOOSTING["maxDepth"], seed=S.SEED, **settings),
        "boosted": booster(**{"maxIter": S.FOLD_TREES, **changes}),
    }


def out_of_fold(gold: DataFrame, kinds: dict[str, Estimator], folds: int = S.FOLDS) -> DataFrame:
    """``candidate``, ``fold``, session, label and ``probability``: every row once per candidate,
    scored by a model that did not see its fold.

    Encoder, scaler and class weights are fitted without the fold, too.  A fold whose
    training rows have one class alone is left out.
    """
    parts = stored(folds_of(gold, folds), "folds")
    sizes = {(r["fold"], r[S.LABEL]): r["n"] for r in parts.groupBy("fold", S.LABEL).agg(F.count("*").alias("n")).collect()}
    scores = []
    for fold in sorted({f for f, _ in sizes}):
        train, held = parts.filter(F.col("fold") != fold), parts.filter(F.col("fold") == fold)
        if any(sum(n for (f, y), n in sizes.items() if f != fold and y == c) == 0 for c in (0, 1)):
            continue
        for name, estimator in kinds.items():
            seen = score(fit(train, estimator), held, ("session_id", S.LABEL))
            scores.append(seen.withColumns({"candidate": F.lit(name), "fold": F.lit(fold)}))
    if not scores:
        return parts.limit(0).select("session_id", S.LABEL, F.lit(0.0).alias("probability"), F.lit("").alias("candidate"), "fold")
    return stored(reduce(DataFrame.unionByName, scores), "out-of-fold")


def fold_metrics(scores: DataFrame) -> DataFrame:
    """Rows, positives, AUC and average precision of each candidate and fold, in one pass.

    Equal scores are counted together first, so what is ranked are distinct scores.
    """
    group = ["candidate", "fold"]
    counts = scores.groupBy(*group, "probability").agg(
        F.count_if(F.col(S.LABEL) == 1).alias("pos"), F.count_if(F.col(S.LABEL) == 0).alias("neg")
    )
    down = Window.partitionBy(*group).orderBy(F.col("probability").desc())
    counts = counts.withColumns({"tp": F.sum("pos").over(down), "fp": F.sum("neg").over(down)})
    lost = F.sum(F.col("pos") * (F.col("fp") - F.col("neg") / 2))
    return counts.groupBy(*group).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n_rows"), F.sum("pos").alias("positives"),
        (F.lit(1.0) - F.try_divide(lost, F.sum("pos").cast("double") * F.sum("neg"))).alias("auc_roc"),
        F.try_divide(F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))), F.sum("pos")).alias("auc_pr"),
    )


def best_of(
    gold: DataFrame, kinds: dict[str, Estimator] | None = None, folds: int = S.FOLDS
) -> tuple[str, PipelineModel, DataFrame]:
    """The candidate of the best mean average precision over folds, fitted on all rows.

    Of equal ones the first by name.  Also gives the metrics of every fold.
    """
    kinds = kinds or candidates()
    found = stored(fold_metrics(out_of_fold(gold, kinds, folds)), "fold-metrics")
    means = {r["candidate"]: r["m"] or 0.0 for r in found.groupBy("candidate").agg(F.avg("auc_pr").alias("m")).collect()}
    best = max(sorted(kinds), key=lambda name: means.get(name, 0.0))
    return best, fit(gold, kinds[best]), found
