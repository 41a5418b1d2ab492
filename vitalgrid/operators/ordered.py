"""Order statistics and running totals that never put a whole group into one task.

A window partitioned by location (or label, or feature) sends a third of all rows to one
task when one key is that large. Here each group is cut into cells by a coarser key: cell
totals are combined map-side, offsets run over the few cells, and only the rows of one cell
are sorted together.
"""

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, written
from .attach import BROADCAST_VALUES, attach

# a window may sort this many rows of one group in one task; larger groups are cut
HEAVY_ROWS = 1_000_000
# Levels of cells for any numbers: `magnitude` without its last four bits, 65,536 cells an octave.
# Numbers seldom span more than some ten octaves, so the window over the cells of a group sorts at
# most a million rows, and a cell of a group of 10^12 rows holds some millions.
WIDE_LEVELS = (4,)
# Coarser cells for numbers of few octaves, such as a score in [0, 1].
UNIT_LEVELS = (6,)


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence,
    values: Sequence[str],
    cells: Sequence[str],
    inclusive: bool = True,
    prefix: str = "running_",
) -> DataFrame:
    """Add `running_<v>`: the sum of v over `by` in `order`, up to this row.

    `cells` are columns, coarse to fine, that never decrease along `order` within `by`; a
    group whose cells are NULL stays whole. Rows with a NULL in `by` get NULL, as a grouped
    cumulative sum has no group for them.
    """
    last = 0 if inclusive else -1
    # the finest cell leads the sort: it tells rows of a hot key apart, the key does not
    part = [*reversed(cells), *by]
    window = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    inside = df.withColumns({f"{prefix}{v}": F.coalesce(F.sum(v).over(window), F.lit(0)) for v in values})
    known = reduce(and_, [F.col(c).isNotNull() for c in by], F.lit(True))
    if not cells:
        return inside.withColumns({f"{prefix}{v}": F.when(known, F.col(f"{prefix}{v}")) for v in values}) if by else inside
    totals = df.filter(F.col(cells[-1]).isNotNull()).groupBy(*part).agg(*[F.sum(v).alias(v) for v in values])
    before = f"_before{len(cells)}_"
    offsets = running_totals(totals, by, [cells[-1]], values, cells[:-1], inclusive=False, prefix=before)
    offsets = offsets.select(*part, *[f"{before}{v}" for v in values])
    joined = inside.join(offsets, part, "left")

    def total(v):
        return F.when(known, F.col(f"{prefix}{v}") + F.coalesce(F.col(f"{before}{v}"), F.lit(0)))

    return joined.select(*df.columns, *[total(v).alias(f"{prefix}{v}") for v in values])


def running_totals_by_size(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence,
    values: Sequence[str],
    cells: Mapping[str, Column],
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Running totals where only groups of more than `heavy_rows` rows are cut into cells.

    The groups are counted first. Usually none is heavy and one window does; otherwise the
    heavy ones alone get cells, and their offsets stay a small table. A row without a time has
    the first cell of its group, as it comes first in the order: both ways give the same sums.
    """
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    heavy = cut_lineage(sizes.filter(F.col("_size") > heavy_rows).select(*by, F.lit(True).alias("_heavy")))
    if heavy.isEmpty():
        return running_totals(df, by, order, values, [])
    marked = attach(df, heavy, by, computed=True)
    kinds = {f.name: f.dataType for f in df.select(*[c.alias(n) for n, c in cells.items()]).schema}
    placed = {n: F.coalesce(c, F.lit("0001-01-01").cast(kinds[n])) for n, c in cells.items()}
    marked = marked.withColumns({n: F.when(F.col("_heavy"), c) for n, c in placed.items()}).drop("_heavy")
    return running_totals(marked, by, order, values, list(cells)).drop(*cells)


def magnitude(value: Column) -> Column:
    """A whole number that never falls as a number grows: its sign and scaled logarithm.

    It only deals numbers to cells, in which they are compared as they are, so nothing is rounded
    and nothing overflows.
    """
    octaves = F.least(F.log2(F.lit(1.0) + F.abs(value) * F.lit(2.0**60)), F.lit(2048.0))
    return (F.signum(value) * F.floor(octaves * F.lit(2.0**20))).cast("long")


def cell_names(levels: Sequence[int]) -> list[str]:
    return [f"_cell_{bits}" for bits in levels]


def keyed_rows(df: DataFrame, key: Column, levels: Sequence[int]) -> DataFrame:
    """Rows with `_key`, a number or an integer hash, and its cells; the caller leaves out rows without a key.

    The key is declared non-NULL, or every join on it would compute it once more to filter.
    """
    keyed = df.withColumn("_key", F.coalesce(key, F.lit(0)))
    whole = keyed.schema["_key"].dataType.typeName() == "long"
    ordinal = F.col("_key") if whole else magnitude(F.col("_key"))
    return keyed.withColumns({f"_cell_{bits}": F.shiftright(ordinal, bits) for bits in levels})


def key_counts(
    df: DataFrame, key: Column, by: Sequence[str], levels: Sequence[int], values: Mapping[str, Column]
) -> DataFrame:
    """One row per group and distinct key with sums of `values`: what a full ranking needs, written once."""
    sums = [F.sum(v).alias(name) for name, v in values.items()]
    return written(keyed_rows(df, key, levels).groupBy(*by, *cell_names(levels), "_key").agg(*sums), "key-counts")


def keys_at_ranks(
    df: DataFrame, key: Column, by: Sequence[str], ranks: Mapping[str, Column], levels: Sequence[int]
) -> DataFrame:
    """The keys found at given 0-based ranks in each group, without sorting the rows.

    Keys are doubles, or longs when spread like a hash.

    A rank may refer to the group size `_total`. One row per group comes back: by, _total and
    one key per rank. Level by level, rows are counted per cell and only the cells that hold
    a wanted rank are looked into. Counts combine map-side, so the rows themselves are never
    shuffled; they are scanned once per level, so pass a table rather than a long plan.
    """
    rows = keyed_rows(df, key, levels)
    rows = rows.select(*by, *cell_names(levels), "_key")
    first, *finer = [*cell_names(levels), "_key"]

    top = rows.groupBy(*by, first).agg(F.count(F.lit(1)).alias("_n"))
    ordered = Window.partitionBy(*by).orderBy(first)
    top = top.withColumn("_upto", F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    top = top.withColumn("_total", F.sum("_n").over(Window.partitionBy(*by)))
    named = F.array(*[
        F.struct(F.lit(name).alias("_name"), rank.cast("long").alias("_rank")) for name, rank in ranks.items()
    ])
    wanted = _inside(top.select("*", F.inline(named))).select(*by, first, "_total", "_name", "_rank")

    found = [*by, first]
    for step in finer:
        wanted = cut_lineage(wanted)
        totals = _rows_in(rows, wanted, found).groupBy(*found, step).agg(F.count(F.lit(1)).alias("_n"))
        ordered = Window.partitionBy(*found, "_name").orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
        reached = wanted.join(totals, found).withColumn("_upto", F.sum("_n").over(ordered))
        found = [*found, step]
        wanted = _inside(reached).select(*found, "_total", "_name", "_rank")

    return wanted.groupBy(*by).agg(
        F.max("_total").alias("_total"),
        *[F.max(F.when(F.col("_name") == name, F.col("_key"))).alias(name) for name in ranks],
    )


def _rows_in(rows: DataFrame, wanted: DataFrame, cells: Sequence[str]) -> DataFrame:
    """Rows of the wanted cells: a filter by broadcast while those are few, else a join."""
    chosen = wanted.select(*cells).distinct()
    if wanted.count() * len(cells) <= BROADCAST_VALUES:
        chosen = F.broadcast(chosen)
    return rows.join(chosen, list(cells), "left_semi")


def _inside(df: DataFrame) -> DataFrame:
    """Rows whose span (_upto - _n, _upto] holds the wanted rank, made relative to the span."""
    start = F.col("_upto") - F.col("_n")
    return df.filter((F.col("_rank") >= start) & (F.col("_rank") < F.col("_upto"))).withColumn(
        "_rank", F.col("_rank") - start
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    levels: Sequence[int] = WIDE_LEVELS,
) -> DataFrame:
    """Linearly interpolated quantiles of a number, exact at any size.

    NULL values are left out. One row per group: by, n, and one column per name in `probs`.
    """
    position = {name: (F.col("_total") - 1) * F.lit(float(p)) for name, p in probs.items()}
    ranks = {}
    for name, pos in position.items():
        ranks[f"_{name}_low"] = F.floor(pos)
        ranks[f"_{name}_high"] = F.ceil(pos)
    known = df.filter(F.col(value).isNotNull())
    found = keys_at_ranks(known, F.col(value).cast("double"), by, ranks, levels)

    def between(name):
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        return low + (high - low) * (position[name] - F.floor(position[name]))

    return found.select(*by, F.col("_total").alias("n"), *[between(name).alias(name) for name in probs])


def share_cut(df: DataFrame, key: Column, share: float, by: Sequence[str], rounding, at_least: int = 0) -> DataFrame:
    """The hash key up to which `share` of each group's rows lie, to select rows without ranking them.

    `rounding` is F.ceil or F.floor on share * n. Rows with one key stay on one side.
    """
    levels = (44,)  # md5 prefixes are uniform, so 2^16 cells split any group evenly
    wanted = F.greatest(rounding(F.col("_total") * F.lit(share)).cast("long"), F.lit(at_least).cast("long"))
    found = keys_at_ranks(df, key, by, {"cut": wanted - 1}, levels)
    return found.select(*by, F.col("_total").alias("n"), "cut")
