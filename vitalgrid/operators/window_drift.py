"""Drift between any two windows of days from one stored table, without reading the hours again.

The table holds, per feature and cell of the value, how many values there were up to each day. A window's histogram is
the difference of two of its rows, so PSI and KS of as many pairs of windows as are asked for come from the histogram
alone. Its size depends on features, cells and days, not on rows.

PSI bins are whole cells, cut where another tenth of the reference begins. The KS distance is known at the ends of the
cells (`ks_low`); inside a cell it can be larger by no more than what falls into it (`ks_high`).
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .drift import EPSILON, long_features
from .keyed_trees import cell

# cells of a value per unit of ln(1 + |value|): about a five-hundredth of the value
CELLS = 512
WINDOWS = "name string, ref_first date, ref_last date, cur_first date, cur_last date"


def running_histograms(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """feature, cell, day, upto: values up to and with the day, for the days on which the cell has some."""
    rows = long_features(df.withColumn("day", F.to_date("timestamp")), names, ["day"])
    daily = rows.groupBy("feature", cell(F.col("value"), CELLS).alias("cell"), "day").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("feature", "cell").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("feature", "cell", "day", F.sum("n").over(before).alias("upto"))


def _counts(running: DataFrame, windows: DataFrame) -> DataFrame:
    """name, feature, cell, ref, cur: both histograms of every asked pair of windows."""
    seen = running.join(F.broadcast(windows), F.col("day") <= F.greatest("ref_last", "cur_last"))

    def upto(condition):
        return F.coalesce(F.max(F.when(condition, F.col("upto"))), F.lit(0))

    def inside(which):
        return upto(F.col("day") <= F.col(f"{which}_last")) - upto(F.col("day") < F.col(f"{which}_first"))

    found = seen.groupBy("name", "feature", "cell").agg(inside("ref").alias("ref"), inside("cur").alias("cur"))
    return found.filter("ref > 0 or cur > 0")


def window_drift(running: DataFrame, windows: DataFrame, bins: int = 10) -> DataFrame:
    """name, feature, n_ref, n_cur, psi, ks_low, ks_high of every pair of windows (columns of `WINDOWS`).

    The windows are a small table the caller asks for. A pair of which one window is empty has no row.
    """
    group = Window.partitionBy("name", "feature")
    upto = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = _counts(running, windows).select(
        "name", "feature", "ref", "cur",
        *[F.sum(c).over(upto).alias(f"upto_{c}") for c in ("ref", "cur")],
        *[F.sum(c).over(group).alias(f"n_{c}") for c in ("ref", "cur")],
    ).filter("n_ref > 0 and n_cur > 0")
    end = {c: F.col(f"upto_{c}") / F.col(f"n_{c}") for c in ("ref", "cur")}
    start = {c: (F.col(f"upto_{c}") - F.col(c)) / F.col(f"n_{c}") for c in ("ref", "cur")}
    key = ["name", "feature", "n_ref", "n_cur"]
    share = F.floor((F.col("upto_ref") - F.col("ref")) * bins / F.col("n_ref"))
    binned = cells.groupBy(*key, F.least(share, F.lit(bins - 1)).alias("bin")).agg(
        F.sum("ref").alias("ref"), F.sum("cur").alias("cur"),
        F.max(F.abs(end["ref"] - end["cur"])).alias("low"),
        F.max(F.greatest(end["ref"] - start["cur"], end["cur"] - start["ref"])).alias("high"),
    )
    p, q = (F.greatest(F.col(c) / F.col(f"n_{c}"), F.lit(EPSILON)) for c in ("ref", "cur"))
    return binned.groupBy(*key).agg(
        F.sum((p - q) * F.ln(p / q)).alias("psi"), F.max("low").alias("ks_low"), F.max("high").alias("ks_high")
    )
