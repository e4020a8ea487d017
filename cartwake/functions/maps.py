"""Map columns: quantity differences, decimals, stable text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwake import schema as S



def _or_empty(m: Column) -> Column:
    return F.coalesce(m, F.from_json(F.lit("{}"), S.QUANTITIES))


def quantity_drop(prev: Column, cur: Column) -> Column:
    """Products whose quantity fell, with the amount; a missing key counts 0."""
    gap = F.map_zip_with(
        _or_empty(prev),
        _or_empty(cur),
        lambda _, a, b: F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)),
    )
    return F.map_filter(gap, lambda _, n: n > 0)


def quantity_rise(prev: Column, cur: Column) -> Column:
    return quantity_drop(cur, prev)


def sorted_json(m: Column) -> Column:
    """JSON text of a map with keys in order, so equal maps give equal text."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(_or_empty(m)))))


def decimal_map(m: Column, kind: str = "decimal(18,4)") -> Column:
    return F.transform_values(m, lambda _, v: v.cast(kind))
