"""Correlation of every pair of sites, per measure, over the hours that both have.

No row meets another in a join. Sites are dealt to blocks of about `BLOCK`; a row goes to the pairs of blocks that its own
is in, and a task sees one pair of blocks on one day: at most 2 `BLOCK` sites and their hours, as matrices. It returns the
sums of products of each pair of sites, which Spark adds up. A site with many hours has many days, many sites have many
pairs of blocks; neither makes a task larger.
"""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import no_nan

BLOCK = 64
SUMS = ("n", "sa", "sb", "saa", "sbb", "sab")


def _day_sums(names: Sequence[str]):
    """Of one pair of blocks and day: sums of each pair of sites and measure."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sites, column = np.unique(rows["location"].to_numpy(str), return_inverse=True)
        hours, line = np.unique(rows["timestamp"].to_numpy(), return_inverse=True)
        own = np.zeros(len(sites), np.int64)
        own[column] = rows["block"]
        left, right = rows["i"].iloc[0], rows["j"].iloc[0]
        a, b = np.triu_indices(len(sites), 1)
        # inside one block all pairs, else those across
        wanted = (left == right) | (own[a] != own[b])
        a, b = a[wanted], b[wanted]
        parts = []
        for name in names:
            x = np.full((len(hours), len(sites)), np.nan)
            x[line, column] = rows[name]
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            n, s, q, p = there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x
            part = pd.DataFrame({
                "measure": name, "a": sites[a], "b": sites[b], "n": n[a, b], "sa": s[a, b], "sb": s[b, a],
                "saa": q[a, b], "sbb": q[b, a], "sab": p[a, b],
            })
            parts.append(part[part["n"] > 0])
        return pd.concat(parts)

    return run


def site_correlations(merged: DataFrame, names: Sequence[str], block: int = BLOCK) -> DataFrame:
    """measure, a, b (sites, a before b), n hours that both have, and corr; NULL where one does not vary.

    `merged` has one row per location and hour. A NULL measure leaves its hour out for its site.
    """
    rows = merged.filter("location is not null and timestamp is not null").select(
        "location", "timestamp", F.to_date("timestamp").alias("day"), *[F.col(n).cast("double").alias(n) for n in names]
    )
    blocks = F.greatest(F.ceil(F.count_distinct("location") / block), F.lit(1)).cast("int")
    counted = rows.agg(blocks.alias("blocks")).scalar()
    own = F.pmod(F.xxhash64("location"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.withColumn("blocks", counted).withColumn("block", own).withColumn("_other", other)
    dealt = dealt.select(
        "location", "timestamp", "day", "block", F.least("block", "_other").alias("i"),
        F.greatest("block", "_other").alias("j"), *names,
    )
    schema = "measure string, a string, b string, " + ", ".join(f"{s} double" for s in SUMS)
    parts = dealt.groupBy("i", "j", "day").applyInPandas(_day_sums(names), schema)
    total = parts.groupBy("measure", "a", "b").agg(*[F.sum(s).alias(s) for s in SUMS])

    def spread(square, single):
        return F.col(square) - F.col(single) * F.col(single) / F.col("n")

    both = F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")
    # a site whose squares are rounding alone does not vary
    varies = (spread("saa", "sa") > F.col("saa") * 1e-12) & (spread("sbb", "sb") > F.col("sbb") * 1e-12)
    corr = F.when(varies, both / F.sqrt(spread("saa", "sa") * spread("sbb", "sb")))
    return total.select("measure", "a", "b", F.col("n").cast("long").alias("n"), no_nan(corr).alias("corr"))
