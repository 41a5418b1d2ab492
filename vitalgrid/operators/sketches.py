"""Quantile sketches as stored values: one row per group, merged without going back to the rows.

A sketch holds, per cell of the value (`step` wide), how many rows fell into it and its smallest and largest value.
Merging adds counts and takes extremes, so the order of merging does not matter and no error builds up: a merged
sketch is the sketch of all its rows. Its size is bounded by the number of cells, whatever the number of rows.

A quantile read from a sketch comes with bounds that hold for certain: the rows next to the wanted rank lie in known
cells, so the exact quantile lies between the smallest value of the first and the largest of the second.
`rank_error` is the share of the rows in these cells, the most by which the rank of any value between the bounds differs.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = "array<struct<cell:long,n:long,low:double,high:double>>"
# wide enough for scores in [0, 1]: at most 4,096 cells
STEP = 1 / 4096


def _packed(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    return cells.groupBy(*by).agg(
        F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("cell", "n", "low", "high"))).cast(CELL).alias("cells")
    )


def quantile_sketches(rows: DataFrame, value: str, by: Sequence[str], step: float = STEP) -> DataFrame:
    """One sketch (by, n, cells) per group, over its non-NULL values; counts combine map-side."""
    cells = rows.filter(F.col(value).isNotNull()).groupBy(*by, F.floor(F.col(value) / step).cast("long").alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high")
    )
    return _packed(cells, by)


def merged_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """The sketches of each group as one."""
    cells = sketches.select(*by, F.inline("cells")).groupBy(*by, "cell").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    return _packed(cells, by)


def _at(rank: Column) -> Column:
    """The cell that holds the row of a rank, counted from 0."""
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast(CELL[6:-1]).alias("found"))

    def step(state, c):
        here = state.found.isNull() & (state.before + c.n > rank)
        return F.struct((state.before + c.n).alias("before"), F.when(here, c).otherwise(state.found).alias("found"))

    return F.aggregate("cells", start, step, lambda state: state.found)


def sketch_quantiles(sketches: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    """Per quantile its estimate under the given name, and `_low`, `_high` and `_rank_error` after that name.

    The estimate is the upper bound, a value that occurs.
    """
    out = {}
    for name, q in quantiles.items():
        place = (F.col("n") - 1) * q
        first, second = _at(F.floor(place)), _at(F.ceil(place))
        both = F.when(first.cell == second.cell, first.n).otherwise(first.n + second.n)
        out |= {
            name: second.high, f"{name}_low": first.low, f"{name}_high": second.high,
            f"{name}_rank_error": both / F.col("n"),
        }
    return sketches.withColumns(out)


def range_quantiles(
    daily: DataFrame, ranges: DataFrame, quantiles: Mapping[str, float], by: Sequence[str] = ("location",)
) -> DataFrame:
    """Quantiles of every range (name, first, last, both days included) from sketches per group and day.

    The ranges are a small table the caller asks for; rows behind the sketches are not read.
    """
    inside = daily.join(F.broadcast(ranges), F.col("day").between(F.col("first"), F.col("last")))
    return sketch_quantiles(merged_sketches(inside, [*by, "name"]), quantiles).drop("cells")
