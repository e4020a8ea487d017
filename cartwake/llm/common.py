"""Small helpers that several text operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORD_BYTES = 4 << 20


def on_workers(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did.

    On a cluster the package is installed or sent along; then this changes nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    own = spark.sparkContext.environment
    have = own.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        own["PYTHONPATH"] = os.pathsep.join([root, *filter(None, have)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str) -> Column:
    """A text column in which null counts as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once per row.

    An expression named twice in a lambda would be computed for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def others(columns: list[str], added: list[str]) -> list[str]:
    """Columns but those that ``added`` ones replace; case does not tell names apart."""
    new = {c.lower() for c in added}
    return [c for c in columns if c.lower() not in new]


def free(columns: list[str], name: str) -> str:
    """``name``, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def per_text(docs: DataFrame, text: str, keep: list[str], added: dict[str, str | T.DataType], work) -> DataFrame:
    """The ``keep`` columns and the ``added`` ones, which ``work`` makes from a list of texts.

    Names of the user's may hold dots or differ in case alone; inside, numbers stand in.
    """
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, F.col(f"`{text}`").alias("text"))
    schema = rows.drop("text").schema
    for i, kind in enumerate(added.values()):
        schema = schema.add(f"n{i}", kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = work()
        for batch in slices(batches, "text"):
            found = made(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], schema.names)

    return rows.mapInArrow(run, schema).toDF(*keep, *added)


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = WORD_BYTES):
    """Batches cut so that each holds about ``most`` bytes of ``text``, or one row.

    Long texts then do not add up in memory while a batch is worked on.
    """
    for batch in batches:
        col, n, start = batch.column(text), batch.num_rows, 0
        if n and col.nbytes <= most:
            yield batch
            continue
        used = 0
        for i in range(n):
            size = len(col[i].as_py() or "")
            if used and used + size > most:
                yield batch.slice(start, i - start)
                start, used = i, 0
            used += size
        if start < n:
            yield batch.slice(start, n - start)
