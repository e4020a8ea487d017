"""Mixing sources to target weights with exact word budgets.

A source's target is reached by whole passes over its documents plus a remaining budget.
Documents are counted by exact length; the remaining budget is spread over the lengths in
proportion, and what is left after rounding is met by bounded-knapsack dynamic
programming over the counts.  Documents of each length are then picked in seeded order.
Only counts per (source, length) meet in one task, never documents.
"""

from __future__ import annotations

from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwake.llm.common import WORD, free
from cartwake.sources.files import stored

WEIGHTS = (5, 2, 1)
#: Most times that a document may be used.
MOST_USES = 3
#: Documents that are ranked together when some of a length are picked.
RANKED = 4096
#: Least and most words that the proportional part leaves to the knapsack on purpose.
LEAST_RESERVE, RESERVE = 1 << 12, 1 << 17


def targets(sizes: list[int], weights: list[int], most_uses: int = MOST_USES) -> list[Fraction]:
    """Shares of the total by weight; none exceeds ``most_uses`` times its size.

    What a source cannot take is shared again by weight among the others.
    """
    total = Fraction(sum(sizes))
    caps = [Fraction(most_uses * s) for s in sizes]
    out: list[Fraction | None] = [None] * len(sizes)
    while True:
        free = [i for i, t in enumerate(out) if t is None]
        weight = sum(weights[i] for i in free)
        left = total - sum(t for t in out if t is not None)
        if not free or not weight:
            return [t or Fraction(0) for t in out]
        over = [i for i in free if left * weights[i] / weight > caps[i]]
        if not over:
            return [left * weights[i] / weight if t is None else t for i, t in enumerate(out)]
        for i in over:
            out[i] = caps[i]


def knapsack(budget: int, counts: list[tuple[int, int]]) -> dict[int, int]:
    """How many items of each size give the largest sum up to ``budget``.

    ``counts`` holds (size, how many there are), sizes above zero.  Bit s of a state says
    that the sum s can be made; counts are split into powers of two.
    """
    keep = (1 << (budget + 1)) - 1
    states, steps, reach = [], [], 1
    for size, n in counts:
        n, power = min(n, budget // size), 1
        while n:
            take = min(power, n)
            states.append(reach)
            steps.append((size, take))
            reach |= (reach << (size * take)) & keep
            n, power = n - take, power * 2
        if reach >> budget & 1:
            break
    left, out = reach.bit_length() - 1, {}
    for before, (size, take) in zip(reversed(states), reversed(steps)):
        if not before >> left & 1:
            out[size] = out.get(size, 0) + take
            left -= size * take
    return out


def fill(budget: int, counts: list[tuple[int, int]]) -> dict[int, int]:
    """Documents to use of each size, so that the words come as near below ``budget`` as can be.

    First a proportional part of every size, then one more of sizes in ascending order of
    the rounded-off part while it fits, then the knapsack over what is left.
    """
    counts = [(s, n) for s, n in sorted(counts) if s > 0 and n > 0]
    total = sum(s * n for s, n in counts)
    if budget >= total:
        return dict(counts)
    # A reserve of several long documents gives the knapsack room to be exact.
    room = min(max(8 * counts[-1][0], LEAST_RESERVE), RESERVE)
    spread = max(0, budget - room)
    out = {s: n * spread // total for s, n in counts}
    left = budget - sum(s * n for s, n in out.items())
    for s, n in sorted(counts, key=lambda c: (-(c[1] * budget % total), c[0])):
        if out[s] < n and left - s >= room:
            out[s] += 1
            left -= s
    # Long documents first: they take up the reserve, short ones make it exact.
    more = knapsack(left, [(s, n - out[s]) for s, n in reversed(counts) if out[s] < n and s <= left])
    for s, n in more.items():
        out[s] += n
    return out


def n_words(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plan(counts: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_uses: int = MOST_USES) -> DataFrame:
    """Per (source, size) of a count table: source_size, target, passes and extra.

    Every document of the row is used ``passes`` times, ``extra`` of them once more.
    """
    sums = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("s")).collect()  # one row per source
    names = sorted((r.source for r in sums if r.source is not None), key=lambda x: [ord(c) for c in x])
    names += [None] * any(r.source is None for r in sums)
    size = {r.source: int(r.s) for r in sums}
    share = targets([size[n] for n in names], [weights[i % len(weights)] for i in range(len(names))], most_uses)
    target = dict(zip(names, share))

    def solve(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        name = None if pd.isna(key[0]) else key[0]
        whole, goal = size[name], target[name]
        budget = round(goal)
        passes = min(most_uses, budget // whole) if whole else 0
        extra = fill(budget - passes * whole, list(zip(rows["size"].tolist(), rows["n"].tolist()))) if passes < most_uses else {}
        return pd.DataFrame({
            "source": rows["source"], "size": rows["size"], "n": rows["n"],
            "source_size": whole, "target": float(goal), "passes": passes,
            "extra": [extra.get(s, 0) for s in rows["size"].tolist()],
        })

    return counts.groupBy("source").applyInPandas(
        solve, "source string, size long, n long, source_size long, target double, passes long, extra long"
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_uses: int = MOST_USES, seed: int = 0,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """One row per document: doc_id, row (hash of all its values), source, size,
    source_size, target, uses and taken (uses times size).

    Sources in code point order, null last, get the weights in turn; all targets add up
    to the words of all documents unless every source is at its limit.  Documents without
    words are never used.  Null texts have no words, documents without an id are mixed
    like others.  Equal rows are ranked one after another.
    """
    light = stored(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
            n_words(F.col(f"`{text}`")).alias("size"), _row(docs, seed).alias("row"),
        ),
        "sizes",
    )
    counts = light.groupBy("source", "size").agg(F.count("*").alias("n"))
    plans = stored(plan(counts, weights, most_uses), "mix-plan")
    same = ["source", "size"]
    # Seeded order within a length: parts by hash, whole parts first, then ranks in one.
    null_safe = [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in same]
    ready = light.alias("d").join(plans.alias("p"), null_safe[0] & null_safe[1]).select(
        "d.*", "p.n", "p.source_size", "p.target", "p.passes", "p.extra",
        F.pmod(F.col("d.row"), F.ceil(F.col("p.n") / RANKED)).alias("part"),
    )
    some = ready.where((F.col("extra") > 0) & (F.col("extra") < F.col("n")))
    rest = ready.where((F.col("extra") == 0) | (F.col("extra") == F.col("n")))
    out = rest.withColumn("uses", F.col("passes") + (F.col("extra") > 0).cast("long"))
    out = out.unionByName(_picked(some))
    return out.select(
        "doc_id", "row", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.col("uses")).otherwise(0).alias("uses"),
        F.when(F.col("size") > 0, F.col("uses") * F.col("size")).otherwise(0).alias("taken"),
    )


def _picked(some: DataFrame) -> DataFrame:
    """``uses`` where only some documents of a (source, size) are used once more."""
    key = ["source", "size"]
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = some.groupBy(*key, "part").agg(F.count("*").alias("m")).select(
        *[F.col(c).alias(f"_{c}") for c in (*key, "part")],
        F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"),
    )
    rank = F.row_number().over(Window.partitionBy(*key, "part").orderBy("row", "doc_id"))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*key, "part")]
    ranked = some.withColumn("rank", rank).join(parts, on[0] & on[1] & on[2])
    once_more = (F.col("before") + F.col("rank") <= F.col("extra")).cast("long")
    return ranked.withColumn("uses", F.col("passes") + once_more).drop("rank", "before", *[f"_{c}" for c in (*key, "part")])


def repeat(docs: DataFrame, mixed: DataFrame, seed: int = 0) -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed`` (made from them) uses it."""
    row, n, copy = (free(docs.columns, c) for c in ("_row", "_uses", "_copy"))
    uses = mixed.where("uses > 0").groupBy(F.col("row").alias(row)).agg(F.sum("uses").cast("int").alias(n))
    joined = docs.withColumn(row, _row(docs, seed)).join(uses, row)
    # Rows of one hash are repeats of one row and share the uses.
    once = joined.dropDuplicates([row])
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return once.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*kept)


def _row(docs: DataFrame, seed: int) -> Column:
    """Hash of all values of a row; maps cannot be hashed and are left out."""
    kinds = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in kinds])
