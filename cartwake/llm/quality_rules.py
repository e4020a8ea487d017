"""Quality rules as a short-circuit cascade, in Spark expressions only.

The cost of a rule and the share that it rejects are estimated on a sample; rules are
then tried in descending order of rejections per cost, and a document is done with the
first that rejects it.  The order changes how much is computed, never which documents
are kept.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwake.llm.common import WORD, let, text_of
from cartwake.sources.files import stored

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Low bits of a sort key that hold a window's place.
PLACE_BITS = 21
#: Rows of the sample that orders the rules, and the longest text in it.
SAMPLE_ROWS = 500
SAMPLE_BYTES = 1 << 16


# -- statistics -------------------------------------------------------------
def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def n_of(text: Column, characters: str) -> Column:
    """How many characters of a set a text has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_lines(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))).cast("long")


def _covered(places: Column) -> Column:
    """Words that windows of three at these ascending places cover."""
    steps = F.transform(places, lambda x, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), x - F.get(places, i - 1))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def _places_by_key(grams: Column) -> Column:
    """Places of repeated windows; null where a shortened key mixes different windows.

    A key is the upper part of a window's hash with its place below, so one sort of plain
    numbers brings equal windows together.
    """
    low = F.lit((1 << PLACE_BITS) - 1).cast("long")
    keys = F.sort_array(F.transform(grams, lambda g, i: F.shiftleft(F.shiftright(g, PLACE_BITS), PLACE_BITS).bitwiseOR(i.cast("long"))))

    def found(keys: Column) -> Column:
        def near(x: Column, y: Column) -> Column:
            return F.shiftright(x, PLACE_BITS) == F.shiftright(y, PLACE_BITS)

        def gram(x: Column) -> Column:
            return F.get(grams, x.bitwiseAND(low).cast("int"))

        def next_to(x: Column, i: Column) -> Column:
            after = F.get(keys, i + 1)
            return ((i > 0) & near(x, F.get(keys, F.greatest(i - 1, F.lit(0))))) | F.coalesce(near(x, after), F.lit(False))

        def mixed(x: Column, i: Column) -> Column:
            before = F.get(keys, F.greatest(i - 1, F.lit(0)))
            return near(x, before) & (gram(x) != gram(before))

        places = F.sort_array(F.transform(F.filter(keys, next_to), lambda x: x.bitwiseAND(low)))
        return F.when(~F.exists(F.transform(keys, mixed), lambda x: x), places)

    return let(keys, found)


def _places_by_pair(grams: Column) -> Column:
    """The same for any text: windows sorted by whole hash, then place."""
    pairs = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.cast("long").alias("i"))))

    def found(pairs: Column) -> Column:
        def next_to(x: Column, i: Column) -> Column:
            before, after = F.get(pairs, F.greatest(i - 1, F.lit(0)))["g"], F.get(pairs, i + 1)["g"]
            return ((i > 0) & (x["g"] == before)) | F.coalesce(x["g"] == after, F.lit(False))

        return F.sort_array(F.transform(F.filter(pairs, next_to), lambda x: x["i"]))

    return let(pairs, found)


def n_repeat_words(words: Column) -> Column:
    """Words in three-word windows found twice or more, the first included.

    Windows are compared by 64-bit hashes.
    """

    def of_grams(grams: Column) -> Column:
        short = F.size(grams) < (1 << PLACE_BITS)
        places = F.coalesce(F.when(short, _places_by_key(grams)), _places_by_pair(grams))
        repeats = F.size(F.array_distinct(grams)) < F.size(grams)
        return F.when(repeats, let(places, _covered)).otherwise(F.lit(0).cast("long"))

    def of_hashes(h: Column) -> Column:
        first = F.slice(h, F.lit(1), F.greatest(F.size(h) - 2, F.lit(0)))
        return let(F.transform(first, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))), of_grams)

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def _counted(body: Column) -> Column:
    return let(
        words(body),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), n_repeat_words(w).alias("n_repeat_words")),
    )


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Null texts count as empty; columns of these names are replaced.
    """
    body = text_of(text)
    stats = F.struct(
        _counted(body).alias("counted"),
        (F.length(body) - n_of(body, SPACES)).cast("long").alias("word_chars"),
        n_of(body, SYMBOLS).alias("n_symbols"),
        n_dup_lines(body).alias("n_dup_lines"),
    )
    # inline computes the struct once; a projection would be merged into its consumers.
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in BASE]
    rows = docs.select(*kept, F.inline(F.array(F.struct(stats.alias("_stats")))))
    return rows.select(
        *kept, "_stats.counted.n_words", "_stats.word_chars", "_stats.n_symbols",
        "_stats.n_dup_lines", "_stats.counted.n_repeat_words",
    )


# -- rules ------------------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    """A condition on a row that rejects it; null does not reject."""

    name: str
    rejects: Column


def base_failed() -> Column:
    """Too short, or most words lie in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def default_rules(text: str = "text") -> list[Rule]:
    """Rules on the statistics of ``with_statistics`` and on the text."""
    body = text_of(text)
    n = F.col("n_words")
    return [
        Rule("too_short", n < 50),
        Rule("repetitive", 100 * F.col("n_repeat_words") > 50 * n),
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n)),
        Rule("repeated_lines", 2 * F.col("n_dup_lines") > n_lines(body)),
        Rule("shouting", 2 * n_of(body, CAPITALS) > F.length(body)),
    ]


def order_rules(sample: DataFrame, rules: list[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) by rejections per cost, the best first.

    The cost of a rule is the time of a job that counts its rejections, beyond that of a
    job that counts rows; equal ratios go by name.
    """

    def timed(column: Column) -> tuple[float, float]:
        best, value = None, 0.0
        for _ in range(2):
            start = time.perf_counter()
            value = sample.agg(column).first()[0] or 0.0
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        return best, value

    floor, _ = timed(F.avg(F.lit(1.0)))
    found = []
    for rule in rules:
        took, share = timed(F.avg(F.coalesce(rule.rejects, F.lit(False)).cast("double")))
        found.append((rule, max(took - floor, 1e-4), share))
    return sorted(found, key=lambda f: (-f[2] / f[1], f[0].name))


def cascade(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Add the statistics and ``rejected_by``: the first rule in order that rejects, or null.

    The order comes from up to ``sample_rows`` rows of moderate length, wherever Spark finds
    them first, so only as much input is read as that takes.  A document is rejected if any
    rule rejects it, whatever the order; which of several rules is named can differ.  An
    empty table keeps the order by name.
    """
    rules = default_rules(text) if rules is None else rules
    counted = with_statistics(docs, text)
    few = docs.where(F.octet_length(text_of(text)) <= SAMPLE_BYTES).take(sample_rows)
    sample = stored(with_statistics(docs.sparkSession.createDataFrame(few, docs.schema), text), "rules-sample")
    order = [f[0] for f in order_rules(sample, rules)] if len(rules) > 1 else rules
    first = F.lit(None).cast("string")
    for rule in reversed(order):
        first = F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name)).otherwise(first)
    return counted.withColumn("rejected_by", first)
