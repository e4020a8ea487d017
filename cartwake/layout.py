"""Ordered per-session work that survives a session of any size.

A window partitioned by ``session_id`` puts a whole session in one task.  That
is the right plan for ordinary sessions (a few hundred events) and the wrong
one for a bot or a stuck client that owns a third of the table.

``profile_sessions`` looks for such sessions in a small sample and picks time
cut points for them.  A ``SessionLayout`` then spreads each hot session over
``(session_id, _seg)``.  Every row still meets exactly the rows it needs:

* frames with a bounded look-back (``lag``, the last 150 rows) get the missing
  rows of earlier segments as *halo* rows, which ``settle`` removes again;
* running totals and "last value so far" add a per-segment carry;
* whole-session values are joined back from a partially aggregated total.

Cut points only steer where rows go, so a bad sample costs time and never
changes a result.  With no hot session every method is the plain window plan.
The cut points are one row per hot session and the only thing broadcast by a hint.  Carries,
totals and halo starts are a few rows per segment and sequence; Spark broadcasts them while
their measured size allows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEG = "_seg"
HALO = "_halo"
#: Rows that one task sorts for its windows where the number of rows is known.
TASK_ROWS = 250_000
#: Rows of a block (see ``SessionLayout.blocks``).
BLOCK_ROWS = 4_096


def bucket_index(value: Column, cuts: Column, steps: int) -> Column:
    """Number of ascending ``cuts`` that are ``<= value`` (binary search).

    ``steps`` is the number of halvings; it covers ``2**steps - 1`` cuts.
    """
    powers = F.array(*[F.lit(1 << p) for p in reversed(range(steps))])

    def advance(pos: Column, step: Column) -> Column:
        here = F.get(cuts, pos + step - F.lit(1))
        return F.when(here <= value, pos + step).otherwise(pos)

    return F.aggregate(powers, F.lit(0), advance)


@dataclass(frozen=True)
class SessionLayout:
    """Where the rows of each session go.  ``cuts`` names the hot sessions.

    ``rows`` is about how many rows there are, 0 if that is not known.
    """

    cuts: tuple[tuple[str | None, tuple[float, ...]], ...] = ()
    key: str = "session_id"
    order: tuple[str, ...] = ("ts_us", "event_id")
    rows: int = field(default=0, compare=False)

    @property
    def hot(self) -> bool:
        return bool(self.cuts)

    # -- placement ---------------------------------------------------------
    def split(self, df: DataFrame) -> DataFrame:
        """Add ``_seg``: 0 for ordinary sessions, 1.. for pieces of a hot one."""
        if not self.hot or SEG in df.columns:
            return df
        steps = max(len(c) for _, c in self.cuts).bit_length()
        real = any(isinstance(v, float) for _, c in self.cuts for v in c)
        kind = "double" if real else "bigint"
        table = df.sparkSession.createDataFrame(
            [(None if k is None else str(k), list(c)) for k, c in self.cuts],
            f"_hot_key string, _cuts array<{kind}>",
        ).withColumn("_is_hot", F.lit(True))
        joined = df.join(
            F.broadcast(table),
            F.col(self.key).cast("string").eqNullSafe(F.col("_hot_key")),
            "left",
        )
        seg = F.when(
            F.col("_is_hot"),
            bucket_index(F.col(self.order[0]), F.col("_cuts"), steps) + 1,
        ).otherwise(F.lit(0))
        return joined.withColumn(SEG, seg).drop("_hot_key", "_cuts", "_is_hot")

    def by(self, *extra: str) -> list[str]:
        """Partitioning columns of an ordered window."""
        return [self.key, *extra, SEG] if self.hot else [self.key, *extra]

    def window(self, *extra: str, backwards: bool = False):
        order = [F.col(c).desc() if backwards else F.col(c) for c in self.order]
        return Window.partitionBy(*self.by(*extra)).orderBy(*order)

    def together(self, df: DataFrame) -> DataFrame:
        """Bring the rows of an ordinary session into one task by one exchange.

        Windows over a session and any of its parts then share it, where a window over a
        part that comes first would make an exchange of its own.  Tasks grow in number with
        the rows, so that what one of them sorts does not.
        """
        if self.hot:
            return df
        usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        needed = -(-self.rows // TASK_ROWS)
        return df.repartition(*([needed] if needed > usual else []), F.col(self.key))

    # -- bounded look-back -------------------------------------------------
    def look_back(self, df: DataFrame, rows: int, *extra: str) -> DataFrame:
        """Make frames of up to ``rows`` preceding rows whole in every segment.

        ``extra`` columns split a session into sequences.  Each segment gets the last
        ``rows`` rows of every sequence, so frames over any subset of the ``extra``
        columns are whole.
        """
        if not self.hot:
            return df
        part = self.split(df)
        seq = [self.key, *extra]
        newest = Window.partitionBy(*seq, SEG).orderBy(*[F.col(c).desc() for c in self.order])
        tail = (
            part.filter(F.col(SEG) > 0)
            .withColumn("_r", F.row_number().over(newest))
            .filter(F.col("_r") <= rows)
            .drop("_r")
            .withColumn(
                "_p", F.row_number().over(Window.partitionBy(*seq).orderBy(*self.order))
            )
        )
        starts = self._starts(tail, seq)
        wanted = starts.select(
            *[F.col(c).alias(f"_w_{c}") for c in seq],
            "_to",
            "_first",
            F.explode(
                F.array(F.floor(F.col("_first") / rows), F.floor(F.col("_first") / rows) - 1)
            ).alias("_block"),
        )
        match = F.floor(F.col("_p") / rows) == F.col("_block")
        for c in seq:
            match = match & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
        match = match & (F.col("_p") < F.col("_first")) & (F.col("_p") >= F.col("_first") - rows)
        halo = (
            tail.join(wanted, match)
            .withColumn(SEG, F.col("_to"))
            .select(*part.columns)
        )
        rows = part.withColumn(HALO, F.lit(False)).unionByName(
            halo.withColumn(HALO, F.lit(True))
        )
        # One exchange for the windows over a segment and over any sequence in it.
        return rows.repartition(self.key, SEG) if extra else rows

    def blocks(self, df: DataFrame, rows: int, position: str | None = None) -> DataFrame:
        """Like ``look_back``, from segments cut anew into blocks of equally many rows.

        A row's position in the session tells its block and if the next one needs it, so
        only ``rows`` rows a block are sent twice, however short the segments are, and
        nothing but the start of each segment is joined.  ``position`` names a column
        that counts the rows of a session from 1, if there is one.
        """
        if not self.hot:
            return df
        size = max(BLOCK_ROWS, rows)
        part = df if position else self._positions(self.split(df))
        at = F.col(position or "_pos") - 1
        own = F.call_function("div", at, F.lit(size).cast("bigint"))
        to = F.when(at % size >= size - rows, F.array(own, own + 1)).otherwise(F.array(own))
        placed = part.drop(SEG).withColumns({"_own": own, "_to": to})
        placed = placed.withColumn(SEG, F.explode("_to")).withColumn(HALO, F.col(SEG) != F.col("_own"))
        return placed.drop("_own", "_to", "_pos")

    def _positions(self, part: DataFrame) -> DataFrame:
        """Count the rows of each session in ``_pos``.

        The rows before each segment are one number, as its cut point is, and go the same way.
        """
        before = Window.partitionBy("_ck").orderBy("_cs").rowsBetween(Window.unboundedPreceding, -1)
        starts = (
            part.groupBy(F.col(self.key).alias("_ck"), F.col(SEG).alias("_cs"))
            .agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_before", F.sum("_n").over(before))
            .filter(F.col("_before").isNotNull())
        )
        on = F.col(self.key).eqNullSafe(F.col("_ck")) & (F.col(SEG) == F.col("_cs"))
        counted = part.withColumn("_pos", F.row_number().over(self.window()))
        joined = counted.join(F.broadcast(starts.drop("_n")), on, "left")
        pos = F.col("_pos") + F.coalesce(F.col("_before"), F.lit(0))
        return joined.withColumn("_pos", pos).drop("_ck", "_cs", "_before")

    def _starts(self, tail: DataFrame, seq: list[str]) -> DataFrame:
        """Where each segment begins in the tail of each sequence.

        Every segment of a session is listed for every sequence of it, also when it
        holds no row of that sequence: a window over a coarser key still needs the
        rows before it.
        """
        last = tail.groupBy(*seq, SEG).agg(F.max("_p").alias("_hi"))
        segments = tail.select(F.col(self.key).alias("_sk"), F.col(SEG).alias("_to")).distinct()
        grid = (
            last.select(*seq)
            .distinct()
            .join(segments, F.col(self.key).eqNullSafe(F.col("_sk")))
            .drop("_sk")
        )
        have = last.select(
            *[F.col(c).alias(f"_h_{c}") for c in seq], F.col(SEG).alias("_h_seg"), "_hi"
        )
        on = F.col("_to") == F.col("_h_seg")
        for c in seq:
            on = on & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
        before = Window.partitionBy(*seq).orderBy("_to").rowsBetween(
            Window.unboundedPreceding, -1
        )
        first = F.coalesce(F.max("_hi").over(before), F.lit(0)) + 1
        return (
            grid.join(have, on, "left")
            .select(*seq, "_to", first.alias("_first"))
            .filter(F.col("_first") > 1)
        )

    def settle(self, df: DataFrame) -> DataFrame:
        """Drop halo rows once the look-back columns are computed."""
        if HALO not in df.columns:
            return df
        return df.filter(~F.col(HALO)).drop(HALO)

    # -- unbounded prefixes ------------------------------------------------
    def running_sum(self, df: DataFrame, backwards: bool = False, **values: Column) -> DataFrame:
        """Inclusive running total of each value along each session, by name.

        ``backwards`` runs from the end of the session.
        """
        part = self.split(df)
        so_far = self.window(backwards=backwards).rowsBetween(Window.unboundedPreceding, 0)
        local = part.withColumns({n: F.sum(v).over(so_far) for n, v in values.items()})
        if not self.hot:
            return local
        carry = self._carry(
            part,
            {n: F.sum(v) for n, v in values.items()},
            lambda c, before: F.sum(c).over(before),
            backwards,
        )
        zero = F.lit(0)
        joined = self._attach(local, carry)
        return joined.withColumns(
            {
                n: F.coalesce(F.col(n), zero) + F.coalesce(F.col(f"_carry_{n}"), zero)
                for n in values
            }
        ).drop(*[f"_carry_{n}" for n in values])

    def running_last(self, df: DataFrame, backwards: bool = False, **values: Column) -> DataFrame:
        """Latest non-null value up to and including each row, by name.

        ``backwards`` gives the earliest one from each row on.
        """
        part = self.split(df)
        so_far = self.window(backwards=backwards).rowsBetween(Window.unboundedPreceding, 0)
        nearest = F.min_by if backwards else F.max_by
        local = part.withColumns(
            {n: F.last(v, ignorenulls=True).over(so_far) for n, v in values.items()}
        )
        if not self.hot:
            return local
        carry = self._carry(
            part,
            {
                n: nearest(v, F.when(v.isNotNull(), F.struct(*self.order)))
                for n, v in values.items()
            },
            lambda c, before: F.last(c, ignorenulls=True).over(before),
            backwards,
        )
        joined = self._attach(local, carry)
        return joined.withColumns(
            {n: F.coalesce(F.col(n), F.col(f"_carry_{n}")) for n in values}
        ).drop(*[f"_carry_{n}" for n in values])

    def _carry(
        self, part: DataFrame, aggs: dict[str, Column], combine, backwards: bool = False
    ) -> DataFrame:
        """What the segments before (or after) each segment add up to, one row per segment."""
        order = F.col(SEG).desc() if backwards else F.col(SEG)
        before = (
            Window.partitionBy(self.key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        )
        return (
            part.filter(F.col(SEG) > 0)
            .groupBy(self.key, SEG)
            .agg(*[a.alias(n) for n, a in aggs.items()])
            .select(
                F.col(self.key).alias("_ck"),
                F.col(SEG).alias("_cs"),
                *[combine(F.col(n), before).alias(f"_carry_{n}") for n in aggs],
            )
        )

    def _attach(self, df: DataFrame, carry: DataFrame) -> DataFrame:
        # A null-safe key would send all rows once more: their exchange is by the key itself.
        key, other = F.col(self.key), F.col("_ck")
        same = key.eqNullSafe(other) if any(k is None for k, _ in self.cuts) else key == other
        return df.join(carry, same & (F.col(SEG) == F.col("_cs")), "left").drop("_ck", "_cs")

    # -- whole-session values ----------------------------------------------
    def totals(self, df: DataFrame, **aggs: Column) -> DataFrame:
        """Attach whole-session aggregates to every row."""
        part = self.split(df)
        everyone = Window.partitionBy(*self.by())
        local = part.withColumns({n: a.over(everyone) for n, a in aggs.items()})
        if not self.hot:
            return local
        whole = (
            part.filter(F.col(SEG) > 0)
            .groupBy(F.col(self.key).alias("_tk"))
            .agg(*[a.alias(f"_t_{n}") for n, a in aggs.items()])
        )
        joined = local.join(
            whole, F.col(self.key).eqNullSafe(F.col("_tk")), "left"
        )
        fixed = {
            n: F.when(F.col(SEG) > 0, F.col(f"_t_{n}")).otherwise(F.col(n)) for n in aggs
        }
        return joined.withColumns(fixed).drop("_tk", *[f"_t_{n}" for n in aggs])


PLAIN = SessionLayout()


def profile_sessions(
    df: DataFrame,
    hot_rows: int = 5_000_000,
    segment_rows: int = 1_000_000,
    fraction: float = 0.001,
    max_segments: int | None = None,
    seed: int = 7,
    key: str = "session_id",
    order: tuple[str, ...] = ("ts_us", "event_id"),
) -> SessionLayout:
    """Find sessions of about ``hot_rows`` or more and choose their cut points; count rows, too.

    One pass over two columns of a sample.  What reaches the driver is bounded by
    the sample: at most ``1 / (hot_rows * fraction)`` of the sampled rows as keys, and for
    each one cut point per ``segment_rows`` rows (at most ``max_segments``, if given).
    """
    sample = df.select(key, order[0])
    if fraction < 1.0:
        sample = sample.sample(fraction=fraction, seed=seed)
    counts = sample.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = F.when(F.col("n") >= hot_rows * fraction, F.struct(key, "n"))
    seen, sizes = counts.agg(F.sum("n"), F.collect_list(hot)).first()
    rows = int((seen or 0) / fraction)
    if not sizes:
        return SessionLayout(key=key, order=order, rows=rows)
    spark = df.sparkSession
    needed = {}
    for row in sizes:
        pieces = max(2, -(-int(row["n"] / fraction) // segment_rows))
        pieces = 1 << (pieces - 1).bit_length()
        needed[row[key]] = pieces if max_segments is None else min(max_segments, pieces)
    max_segments = max(needed.values())
    wanted = [(k, max_segments // pieces) for k, pieces in needed.items()]
    steps = spark.createDataFrame(wanted, "_hot_key string, _every int")
    shares = F.array(*[F.lit(i / max_segments) for i in range(1, max_segments)])
    cuts = (
        sample.join(F.broadcast(steps), F.col(key).eqNullSafe(F.col("_hot_key")))
        .groupBy("_hot_key", "_every")
        .agg(F.percentile_approx(order[0], shares, 100_000).alias("_q"))
        .select(
            "_hot_key",
            F.expr(
                f"array_sort(array_distinct(transform(sequence(_every, {max_segments} - 1, _every),"
                " i -> _q[i - 1])))"
            ).alias("_cuts"),
        )
        .collect()
    )
    return SessionLayout(
        cuts=tuple(sorted(((r["_hot_key"], tuple(r["_cuts"])) for r in cuts), key=str)),
        key=key,
        order=order,
        rows=rows,
    )
