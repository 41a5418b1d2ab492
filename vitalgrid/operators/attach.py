"""Bring one row of values per key to many rows, when a key may hold a third of them."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# up to this many values (8 MB of numbers) the small side is broadcast
BROADCAST_VALUES = 1_000_000


def attach(
    rows: DataFrame,
    values: DataFrame,
    on: Sequence[str],
    how: str = "left",
    width: int | None = None,
    computed: bool = False,
) -> DataFrame:
    """Join `values` (one row per key) to `rows` without sending a hot key to one task.

    The values are computed once and counted. When few, they are broadcast and the rows do
    not move. Otherwise both sides are shuffled, and adaptive execution splits the partition of
    a hot key among many tasks and repeats its one row of values for each. No salt is drawn, so
    a task that runs again sees the same rows. `width` is the number of values in a row of
    `values`; `computed` says that they are a checkpoint or files already.
    """
    values = values if computed else cut_lineage(values)
    if values.count() * (width or len(values.columns)) <= BROADCAST_VALUES:
        values = F.broadcast(values)
    return rows.join(values, list(on), how)
