"""Training and metric queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.ml import boosting, metrics, training
from cartwake.operators import reports, sessions
from cartwake.queries.base import GOLD, Tables, query, round_sql, rounded
from cartwake.sources import files
from cartwake.sources.files import stored


def _gold(t: Tables) -> DataFrame:
    return sessions.gold(t.clicks, t.layout)


def _scored(t: Tables) -> DataFrame:
    """Gold rows with a fixed score that SQL can repeat."""
    return _gold(t).withColumn("score", F.round(_raw_score(), 6))


def _raw_score():
    return F.least(
        F.lit(1.0),
        F.col("checkout_count") * 0.3 + F.col("idle_ratio") + F.col("page_regression_count") * 0.02,
    )


SCORED = GOLD + """,
sc as (select *, round(least(1.0::double, checkout_count * 0.3::double + idle_ratio + page_regression_count * 0.02::double), 6) as score from gold)"""
SPLIT = GOLD + """,
rk as (select *, row_number() over (partition by abandoned order by md5('42:' || session_id)) as position,
  count(*) over (partition by abandoned) as class_size from gold),
spl as (select *, case when position <= floor(class_size * 0.2::double + 0.5) then 'test' else 'train' end as split from rk)"""


@query(
    "label_encode",
    f"""with {GOLD} select session_id, device, (dense_rank() over (order by device) - 1)::double as device_code from gold""",
)
def _label_encode(t: Tables) -> DataFrame:
    rows = _gold(t).select("session_id", "device")
    return training.device_indexer().fit(rows).transform(rows)


@query(
    "numeric_matrix",
    f"with {GOLD} select session_id, device, {round_sql(S.MODEL_NUMERIC)} from gold",
)
def _numeric_matrix(t: Tables) -> DataFrame:
    return rounded(training.numeric_matrix(_gold(t), ("session_id",)))


@query(
    "standardize",
    f"with {GOLD} select session_id, "
    + ", ".join(
        f"round(({c} - avg({c}) over ()) / case when stddev_pop({c}) over () = 0 then 1 else stddev_pop({c}) over () end, 4) + 0.0 as z_{c}"
        for c in S.MODEL_NUMERIC
    )
    + " from gold",
)
def _standardize(t: Tables) -> DataFrame:
    rows = training.numeric_matrix(_gold(t), ("session_id",))
    scaled = training.fit_scaler(rows, S.MODEL_NUMERIC).transform(rows)
    return rounded(scaled.select("session_id", *[f"z_{c}" for c in S.MODEL_NUMERIC]))


@query("stratified_split", f"with {SPLIT} select session_id, abandoned, split from spl")
def _stratified_split(t: Tables) -> DataFrame:
    return training.stratified_split(_gold(t).select("session_id", "abandoned"))


@query(
    "class_distribution",
    f"with {SPLIT} select split, count(*) filter (where abandoned = 0) as neg, count(*) filter (where abandoned = 1) as pos from spl group by split",
)
def _class_distribution(t: Tables) -> DataFrame:
    split = training.stratified_split(_gold(t).select("session_id", "abandoned"))
    return reports.class_distribution(split)


@query(
    "class_weight",
    f"""with {GOLD} select session_id, round(case when abandoned = 1 then
      (count(*) filter (where abandoned = 0) over ()) / greatest(count(*) filter (where abandoned = 1) over (), 1)::double else 1.0 end, 6) as weight from gold""",
)
def _class_weight(t: Tables) -> DataFrame:
    rows = training.with_class_weight(_gold(t).select("session_id", "abandoned"))
    return rounded(rows.select("session_id", "weight"), 6)


@query(
    "oversample",
    f"""with {SPLIT}, big as (select max(class_size) as n from rk),
    cp as (select session_id, abandoned, n // class_size + (position <= n - (n // class_size) * class_size)::bigint as copies from rk, big)
    select session_id, abandoned, unnest(range(1, copies + 1)) as copy from cp""",
)
def _oversample(t: Tables) -> DataFrame:
    return training.oversample(_gold(t).select("session_id", "abandoned"))


_Z = ", ".join(
    f"(({c})::double - avg({c}) over ()) / (case when stddev_pop({c}) over () = 0 then 1 else stddev_pop({c}) over () end)"
    for c in S.MODEL_NUMERIC
)


@query(
    "synthetic_minority",
    f"""with {GOLD}, sizes as (select count(*) filter (where abandoned = 0) as neg, count(*) filter (where abandoned = 1) as pos from gold),
    few as (select gold.*, abs(neg - pos) as lack, count(*) over () as class_size from gold, sizes where abandoned = case when neg < pos then 0 else 1 end),
    z as (select session_id, [{_Z}] as v from few),
    nb as (select a.session_id, b.session_id as neighbour,
      row_number() over (partition by a.session_id order by round(list_distance(a.v, b.v), 9), b.session_id) as rank
      from z a join z b on a.session_id <> b.session_id qualify rank <= 5),
    known as (select session_id, max(rank) as known from nb group by session_id),
    ps as (select session_id, lack // class_size + ((row_number() over (order by md5('42:' || session_id))) <= lack - (lack // class_size) * class_size)::bigint as times from few),
    cp as (select session_id, unnest(range(1, times + 1)) as copy from ps),
    dg as (select *, md5('42:' || session_id || ':' || copy) as h from cp),
    pick as (select dg.session_id, copy, ('0x' || substr(h, 1, 8))::bigint % known + 1 as rank, ('0x' || substr(h, 9, 8))::bigint / 4294967296.0::double as share
      from dg join known using (session_id))
    select pick.session_id, copy, neighbour, round(share, 6) as share, a.abandoned,
      {", ".join(f"round(a.{c} + share * (b.{c} - a.{c}), 4) + 0.0 as {c}" for c in S.MODEL_NUMERIC)}
    from pick join nb using (session_id, rank) join few a using (session_id) join few b on b.session_id = neighbour""",
)
def _synthetic_minority(t: Tables) -> DataFrame:
    """Rows between sessions of the smaller class and their nearest, until both classes are equal."""
    made = training.synthetic_minority(stored(_gold(t), "gold"), S.MODEL_NUMERIC)
    return rounded(made.withColumn("share", F.round("share", 6)), 4, skip=("share",))


CONFUSION = """
cm as (select count(*) filter (where score >= 0.5 and abandoned = 1) as true_positives, count(*) filter (where score >= 0.5 and abandoned = 0) as false_positives,
  count(*) filter (where score < 0.5 and abandoned = 1) as false_negatives, count(*) filter (where score < 0.5 and abandoned = 0) as true_negatives from sc)"""


@query(
    "metrics_confusion",
    f"""with {SCORED}, {CONFUSION} select *,
      round(case when true_positives + false_positives > 0 then true_positives / (true_positives + false_positives) else 0 end, 6) as precision,
      round(case when true_positives + false_negatives > 0 then true_positives / (true_positives + false_negatives) else 0 end, 6) as recall,
      round(case when 2 * true_positives + false_positives + false_negatives > 0 then 2 * true_positives / (2 * true_positives + false_positives + false_negatives) else 0 end, 6) as f1_score,
      round(case when true_negatives + false_positives > 0 then true_negatives / (true_negatives + false_positives) else 0 end, 6) as specificity from cm""",
)
def _metrics_confusion(t: Tables) -> DataFrame:
    return rounded(metrics.confusion(_scored(t)), 6)


RANKS = """
ds as (select score, count(*) filter (where abandoned = 1) as pos, count(*) filter (where abandoned = 0) as neg from sc group by score),
cu as (select *, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp from ds)"""


@query(
    "auc_roc",
    f"with {SCORED}, {RANKS} select round(1 - sum(pos * (fp - neg / 2.0)) / (sum(pos)::double * sum(neg)), 6) as auc_roc from cu",
)
def _auc_roc(t: Tables) -> DataFrame:
    return rounded(metrics.ranking(_scored(t)).select("auc_roc"), 6)


@query(
    "average_precision",
    f"with {SCORED}, {RANKS} select round(sum(pos * tp::double / (tp + fp)) / sum(pos), 6) as auc_pr from cu",
)
def _average_precision(t: Tables) -> DataFrame:
    return rounded(metrics.ranking(_scored(t)).select("auc_pr"), 6)


THRESHOLDS = [i / 20 for i in range(1, 20)]
GRID = "grid(threshold) as (values " + ", ".join(f"({v}::double)" for v in THRESHOLDS) + ")"
TUNED = f"""{GRID},
th as (select threshold, count(*) filter (where score >= threshold and abandoned = 1) as tp, count(*) filter (where score >= threshold and abandoned = 0) as fp,
  count(*) filter (where score < threshold and abandoned = 1) as fn, count(*) filter (where score < threshold and abandoned = 0) as tn from sc, grid group by threshold),
tm as (select *, case when tp + fp > 0 then tp / (tp + fp) else 0 end as precision, case when tp + fn > 0 then tp / (tp + fn) else 0 end as recall,
  case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) else 0 end as f1_score, case when tn + fp > 0 then tn / (tn + fp) else 0 end as specificity from th)"""


@query(
    "threshold_metrics",
    f"with {SCORED}, {TUNED} select threshold, tp, fp, fn, tn, {round_sql(['precision', 'recall', 'f1_score', 'specificity'], 6)} from tm",
)
def _threshold_metrics(t: Tables) -> DataFrame:
    return rounded(metrics.by_threshold(_scored(t), THRESHOLDS), 6)


@query(
    "threshold_tuning",
    f"""with {SCORED}, {TUNED} select threshold, {round_sql(['f1_score', 'precision', 'recall'], 6)} from tm
    order by round(f1_score, 9) desc, threshold limit 1""",
)
def _threshold_tuning(t: Tables) -> DataFrame:
    return rounded(metrics.best_threshold(metrics.by_threshold(_scored(t), THRESHOLDS)), 6)


_TRAINED: dict[tuple[str, str], tuple] = {}


def _trained(t: Tables):
    """The boosted model of the train split and its report, fitted once per table folder."""
    place = (t.spark.sparkContext.applicationId, t.sf_dir)
    if place not in _TRAINED:
        _TRAINED[place] = training.train_and_report(stored(_gold(t), "gold"))
    return _TRAINED[place]


@query(
    "gbt_score",
    f"with {SPLIT} select session_id, abandoned, split, true as in_range, true as same_after_reload from spl",
)
def _gbt_score(t: Tables) -> DataFrame:
    """Scores of every session, by the model and by the model saved and loaded again."""
    model, _ = _trained(t)
    path = files.shared_folder(t.spark, "model")
    training.save(model, path)
    rows = training.stratified_split(_gold(t))
    keep = ("session_id", "abandoned", "split")
    again = training.score(training.load(path), rows, keep).select("session_id", F.col("probability").alias("again"))
    return training.score(model, rows, keep).join(again, "session_id").select(
        *keep, F.col("probability").between(0, 1).alias("in_range"),
        (F.col("probability") == F.col("again")).alias("same_after_reload"),
    )


REPORTED = """
n as (select split, count(*) filter (where abandoned = 0) as neg, count(*) filter (where abandoned = 1) as pos from spl group by split)"""


@query(
    "train_report",
    f"""with {SPLIT}, {REPORTED} select te.neg + te.pos as n_test, te.neg as test_neg, te.pos as test_pos, tr.neg + tr.pos as n_train,
      tr.neg as train_neg, tr.pos as train_pos, te.pos as positives, te.neg as negatives, 300 as trees, true as rates_in_range,
      '{",".join(S.MODEL_COLUMNS)}' as feature_cols
    from n te, n tr where te.split = 'test' and tr.split = 'train'""",
)
def _train_report(t: Tables) -> DataFrame:
    """The report of the boosted model, written as JSON and read back."""
    model, report = _trained(t)
    path = files.shared_folder(t.spark, "report")
    files.write_report(report, path)
    back = t.spark.read.schema(report.schema).json(path)
    rates = ["precision", "recall", "f1_score", "specificity", "auc_roc", "auc_pr", "train_auc_roc", "train_auc_pr"]
    fine = F.lit(True)
    for c in rates:
        fine = fine & F.col(c).between(0, 1)
    return back.select(
        "n_test", "test_neg", "test_pos", "n_train", "train_neg", "train_pos",
        (F.col("true_positives") + F.col("false_negatives")).alias("positives"),
        (F.col("true_negatives") + F.col("false_positives")).alias("negatives"),
        F.lit(model.stages[-1].getNumTrees).alias("trees"), fine.alias("rates_in_range"), "feature_cols",
    )


@query(
    "scaled_on_all",
    f"""with {SPLIT} select round(avg(velocity_avg), 4) + 0.0 as mean_all, round(avg(velocity_avg) filter (where split = 'train'), 4) + 0.0 as mean_train,
      true as centred_all, true as centred_train from spl""",
)
def _scaled_on_all(t: Tables) -> DataFrame:
    """The scaler fitted before the split sees all rows, the other one the train rows."""
    rows = stored(training.stratified_split(_gold(t)), "split")
    train = rows.filter("split = 'train'")
    parts = []
    for fit_on, seen in ((rows, rows), (train, train)):
        scaled = training.fit_scaler(fit_on, ["velocity_avg"]).transform(seen)
        parts.append(scaled.agg(F.avg("velocity_avg").alias("mean"), (F.abs(F.avg("z_velocity_avg")) < 1e-9).alias("centred")))
    whole, part = parts
    return rounded(
        whole.select(F.col("mean").alias("mean_all"), F.col("centred").alias("centred_all")).join(
            part.select(F.col("mean").alias("mean_train"), F.col("centred").alias("centred_train"))
        )
    )


@query(
    "best_candidate",
    f"""with {SPLIT}, fd as (select *, (position - 1) % {S.FOLDS} as fold from rk),
    ok as (select distinct a.fold from fd a where exists (select 1 from fd b where b.fold <> a.fold and b.abandoned = 0)
      and exists (select 1 from fd b where b.fold <> a.fold and b.abandoned = 1))
    select candidate, fold::int as fold, count(*) as n_rows, sum(abandoned)::bigint as positives, true as ranks_agree
    from fd join ok using (fold), (select unnest(['linear', 'forest', 'boosted']) as candidate) group by candidate, fold""",
)
def _best_candidate(t: Tables) -> DataFrame:
    """Rows of each candidate and fold, and whether another way finds the same average precision:
    the mean, over positives, of the share of positives among rows that score as high."""
    scores = training.out_of_fold(stored(_gold(t), "gold"), training.candidates())
    # Row by row, ties included, where the operator counts equal scores together.
    down = Window.partitionBy("candidate", "fold").orderBy(F.col("probability").desc()).rangeBetween(Window.unboundedPreceding, 0)
    rows = scores.withColumn("precision", F.sum("abandoned").over(down) / F.count("*").over(down))
    again = rows.groupBy("candidate", "fold").agg(F.avg(F.when(F.col("abandoned") == 1, F.col("precision"))).alias("again"))
    found = training.fold_metrics(scores).join(again, ["candidate", "fold"], "left")
    same = F.coalesce(F.abs(F.col("auc_pr") - F.col("again")) < 1e-9, F.col("auc_pr").isNull() & F.col("again").isNull())
    return found.select("candidate", "fold", "n_rows", "positives", same.alias("ranks_agree"))


# Small enough to be written out in SQL tree by tree.
_SMALL = boosting.Settings(trees=3, depth=3, rate=0.3, bins=16)


def _boosted_sql(s: boosting.Settings, columns: list[str]) -> str:
    """Each tree and level as one step: sums per bin, running sums, best gain, next nodes."""
    unit, names = "16777216.0::double", "[" + ", ".join(f"'{c}'" for c in columns) + "]"
    share = "[" + ", ".join(f"{i / s.bins}" for i in range(1, s.bins)) + "]"
    steps = [
        f"num as materialized (select session_id, abandoned, {round_sql(columns)} from gold)",
        f"""lab as materialized (select session_id, abandoned as y, case when abandoned = 1 then
          (count(*) filter (where abandoned = 0) over ()) / greatest(count(*) filter (where abandoned = 1) over (), 1)::double else 1.0::double end as w from num)""",
        f"xs as materialized (select session_id, unnest(range(1, {len(columns) + 1})) as f, unnest([{', '.join(f'{c}::double' for c in columns)}]) as x from num)",
        f"qs as (select f, min(x) as least, unnest(quantile_disc(x, {share})) as cut from xs group by f)",
        "cuts as materialized (select distinct f, cut from qs where cut > least)",
        "bn as materialized (select session_id, xs.f, count(cut) as bin from xs left join cuts on cuts.f = xs.f and cut <= x group by all)",
        "m0 as materialized (select session_id, 0.0::double as margin from lab)",
    ]
    for t in range(s.trees):
        steps += [
            f"""u{t} as materialized (select i as f from (select i, row_number() over (order by md5('{s.seed}:{t}:' || {names}[i])) as r
              from (select unnest(range(1, {len(columns) + 1})) as i)) where r <= {max(1, int(s.column_share * len(columns)))})""",
            f"p{t} as materialized (select session_id, y, w, 1 / (1 + exp(-margin)) as p from lab join m{t} using (session_id))",
            f"""g{t} as materialized (select session_id, round_even((p - y) * w * {unit}, 0)::bigint as g, round_even(greatest(p * (1 - p), 1e-16::double) * w * {unit}, 0)::bigint as h
              from p{t} where ('0x' || substr(md5('{s.seed}:{t}:' || session_id), 1, 8))::bigint < {int(s.row_share * (1 << 32))})""",
            f"n{t}_0 as materialized (select session_id, 0 as node from lab)",
        ]
        for d in range(s.depth):
            steps += [
                f"""h{t}_{d} as materialized (select node, f, bin, sum(g)::bigint as g, sum(h)::bigint as h from n{t}_{d} join g{t} using (session_id)
                  join bn using (session_id) join u{t} using (f) where node >= {(1 << d) - 1} group by all)""",
                f"""c{t}_{d} as materialized (select node, f, bin, (sum(g) over up)::double / {unit} as gl, (sum(h) over up)::double / {unit} as hl,
                  (sum(g) over whole)::double / {unit} as ga, (sum(h) over whole)::double / {unit} as ha from h{t}_{d}
                  window up as (partition by node, f order by bin), whole as (partition by node, f))""",
                f"""s{t}_{d} as materialized (select node, gl, hl, ga, ha, f, bin, gl * gl / (hl + {s.shrink}::double) + (ga - gl) * (ga - gl) / (ha - hl + {s.shrink}::double) - ga * ga / (ha + {s.shrink}::double) as gain from c{t}_{d}
                  where hl >= {s.least_curvature} and ha - hl >= {s.least_curvature})""",
                f"b{t}_{d} as materialized (select node, f, bin as cut from s{t}_{d} where gain > 1e-6::double qualify row_number() over (partition by node order by gain desc, f, bin) = 1)",
                f"""n{t}_{d + 1} as materialized (select a.session_id, case when b.f is null then a.node else 2 * a.node + 1 + (bn.bin > b.cut)::int end as node
                  from n{t}_{d} a left join b{t}_{d} b on b.node = a.node left join bn on bn.session_id = a.session_id and bn.f = b.f)""",
            ]
        steps += [
            f"""v{t} as materialized (select node, -(sum(g)::double / {unit}) / (sum(h)::double / {unit} + {s.shrink}::double) * {s.rate}::double as value
              from n{t}_{s.depth} join g{t} using (session_id) group by node)""",
            f"""m{t + 1} as materialized (select session_id, margin + coalesce(value, 0) as margin
              from m{t} join n{t}_{s.depth} using (session_id) left join v{t} using (node))""",
        ]
    return f"with {GOLD}, {', '.join(steps)} select session_id, y as abandoned, round(1 / (1 + exp(-margin)), 6) + 0.0 as probability from m{s.trees} join lab using (session_id)"


@query("second_order_trees", _boosted_sql(_SMALL, S.MODEL_NUMERIC))
def _second_order_trees(t: Tables) -> DataFrame:
    """Probabilities by three second-order trees, each split and leaf found again in SQL."""
    rows = stored(rounded(training.numeric_matrix(_gold(t), ("session_id", S.LABEL))), "gold")
    model = boosting.fit(rows, S.MODEL_NUMERIC, settings=_SMALL)
    return rounded(model.score(rows, ("session_id", S.LABEL)), 6)
