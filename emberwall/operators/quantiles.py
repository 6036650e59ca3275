"""Exact quantiles without gathering the values in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberwall.session import store

RANGES_PER_DOUBLING = 64
STEPS = 4096
#: A range holds some 2^46 doubles, so four times 4096 steps end at single values.
LEVELS = 4


@dataclass(frozen=True)
class Cell:
    """All values from ``low`` to ``high``: ``n`` of them, after ``before`` smaller."""

    low: float
    high: float
    before: int
    n: int

    def holds(self, rank: int) -> bool:
        return self.before <= rank < self.before + self.n


def value_range(value: Column) -> Column:
    """Number of the range a double lies in, rising with the value.

    Ranges are 1/64 of a doubling wide, on both sides of zero, so there are at
    most some 270,000 of them whatever the data, and far fewer in practice.
    """
    size = F.greatest(F.abs(value), F.lit(5e-324))
    place = F.least(F.log2(size) * RANGES_PER_DOUBLING, F.lit(70_000.0))
    number = F.floor(place) + 70_000
    signed = F.when(value > 0, number).when(value < 0, -number)
    return F.coalesce(signed, F.lit(0))


def count_values(df: DataFrame, column: str) -> DataFrame:
    """(``value``, ``n``) of the different values as doubles, without null and NaN."""
    number = F.col(column).cast("double")
    values = df.select(number.alias("value")).filter("value IS NOT NULL")
    values = values.filter(~F.isnan("value"))
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def _cells(rows: DataFrame, keys: list[str], ranks: Sequence[int]) -> list[Cell]:
    """Cells of the rows with equal keys that hold one of the ranks. The rows carry
    ``start``, how many values come before those with the same first key."""
    window = Window.partitionBy(*keys[:-1]).orderBy(keys[-1])
    earlier = F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1))
    cells = (
        rows.groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.max("start").alias("start"),
        )
        .withColumn("before", F.col("start") + F.coalesce(earlier, F.lit(0)))
    )
    wanted = F.lit(False)
    for rank in ranks:
        wanted = wanted | F.lit(rank).between(F.col("before"), F.col("before") + F.col("n") - 1)
    found = cells.filter(wanted).select("low", "high", "before", "n").collect()
    return [Cell(*row) for row in found]


def quantiles_of(counted: DataFrame, probabilities: Sequence[float]) -> dict[float, float | None]:
    """Quantiles of the values of ``counted(value, n)``, interpolated linearly between
    neighbours; without any value they are null.

    Counts per range tell which few ranges hold the wanted ranks; each of these is
    split into steps between its own lowest and highest value, and so on, until a
    cell is a single value. No task puts more in order than there are ranges, or
    steps of two cells per probability, and only these few cells come to the driver.
    """
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not total:
        return dict.fromkeys(probabilities)
    places = {p: p * (total - 1) for p in probabilities}
    ranks = sorted({f(x) for x in places.values() for f in (math.floor, math.ceil)})
    rows = counted.select(
        "value", "n", value_range(F.col("value")).alias("cell"), F.lit(0).alias("start")
    )
    cells = _cells(rows, ["cell"], ranks)
    for _ in range(LEVELS):
        wide = [c for c in cells if c.low < c.high]
        if not wide:
            break
        cell = step = start = F.lit(None)
        for i, c in enumerate(wide):
            inside = F.col("value").between(F.lit(c.low), F.lit(c.high))
            width = c.high - c.low
            part = (F.col("value") / width - c.low / width) if math.isinf(width) else (
                (F.col("value") - F.lit(c.low)) / F.lit(width)
            )
            cell = F.when(inside, i).otherwise(cell)
            step = F.when(inside, F.floor(part * STEPS)).otherwise(step)
            start = F.when(inside, F.lit(c.before)).otherwise(start)
        rows = counted.select("value", "n", cell.alias("cell"), step.alias("step"), start.alias("start"))
        rows = rows.filter(F.col("cell").isNotNull())
        done = [c for c in cells if c.low == c.high]
        cells = done + _cells(rows, ["cell", "step"], ranks)
    at = {rank: next(c.low for c in cells if c.holds(rank)) for rank in ranks}
    out = {}
    for p, place in places.items():
        low, high = at[math.floor(place)], at[math.ceil(place)]
        part = place - math.floor(place)
        out[p] = low if part == 0 or low == high else low + (high - low) * part
    return out


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float]
) -> DataFrame:
    """Rows (``p``, ``value``), as ``quantiles_of``. Null and NaN are not counted."""
    counted = store(count_values(df, column), "values")
    rows = list(quantiles_of(counted, probabilities).items())
    return df.sparkSession.createDataFrame(rows, "p double, value double")
