"""Drift statistics between a reference and a current window, and data quality."""

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import no_nan, stable
from ..schemas import SENSOR_RANGES
from .ordered import WIDE_LEVELS, cell_names, exact_quantiles, key_counts, running_totals

EPSILON = 1e-4
# usual reading of the index: below 0.1 stable, from 0.25 shifted
PSI_LEVELS = (0.1, 0.25)
# coefficients of the two-sample test at 5 % and at 0.1 %
KS_LEVELS = (1.358, 1.949)


def long_features(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows (feature, value), NULL values left out."""
    doubles = [stable(F.col(n).cast("double")).alias(n) for n in names]
    return df.select(*keep, *doubles).unpivot(list(keep), list(names), "feature", "value").filter(
        F.col("value").isNotNull()
    )


def both_windows(reference: DataFrame, current: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows (feature, value, is_current) of both windows."""
    marked = [
        long_features(df, names).withColumn("is_current", F.lit(flag)) for df, flag in ((reference, 0), (current, 1))
    ]
    return marked[0].unionByName(marked[1])


def population_stability(reference: DataFrame, current: DataFrame, names: Sequence[str], bins: int = 10) -> DataFrame:
    """PSI per feature over bins cut at the reference's quantiles.

    The edges are one row per feature, so their broadcast is bounded by the column list.
    """
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    edges = exact_quantiles(long_features(reference, names), "value", probs, ["feature"])
    edges = edges.select("feature", F.array(*probs).alias("edges"))
    binned = both_windows(reference, current, names).join(F.broadcast(edges), "feature").select(
        "feature", "is_current", F.size(F.filter("edges", lambda e: F.col("value") > e)).alias("bin")
    )
    counts = binned.groupBy("feature", "bin").agg(
        F.count(F.when(F.col("is_current") == 0, 1)).alias("ref"),
        F.count(F.when(F.col("is_current") == 1, 1)).alias("cur"),
    )
    sizes = counts.groupBy("feature").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    shares = counts.join(sizes, "feature").select(
        "feature",
        F.greatest(F.col("ref") / F.nullif("n_ref", F.lit(0)), F.lit(EPSILON)).alias("p"),
        F.greatest(F.col("cur") / F.nullif("n_cur", F.lit(0)), F.lit(EPSILON)).alias("q"),
    )
    p, q = F.col("p"), F.col("q")
    return shares.groupBy("feature").agg(F.sum((p - q) * F.ln(p / q)).alias("psi"))


def kolmogorov_smirnov(reference: DataFrame, current: DataFrame, names: Sequence[str]) -> DataFrame:
    """Largest distance between the two empirical distributions, per feature."""
    one = F.lit(1).cast("long")
    counts = key_counts(
        both_windows(reference, current, names), F.col("value"), ["feature"], WIDE_LEVELS,
        {"ref": F.when(F.col("is_current") == 0, one).otherwise(0),
         "cur": F.when(F.col("is_current") == 1, one).otherwise(0)},
    )
    upto = running_totals(counts, ["feature"], ["_key"], ["ref", "cur"], cell_names(WIDE_LEVELS))
    sizes = counts.groupBy("feature").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    gap = F.abs(
        F.col("running_ref") / F.nullif("n_ref", F.lit(0)) - F.col("running_cur") / F.nullif("n_cur", F.lit(0))
    )
    # one row per feature: bounded by the column list
    return upto.join(F.broadcast(sizes), "feature").groupBy("feature", "n_ref", "n_cur").agg(
        F.max(gap).alias("ks")
    )


def drift_alerts(psi: DataFrame, levels: Sequence[float] = PSI_LEVELS) -> DataFrame:
    """One alert per feature whose index passes the lower level."""
    value = F.col("psi")
    return psi.filter(value > levels[0]).select(
        "feature",
        value.alias("value"),
        F.lit("drift").alias("type"),
        F.when(value > levels[1], "high").otherwise("medium").alias("severity"),
    )


def ks_alerts(ks: DataFrame, levels: Sequence[float] = KS_LEVELS) -> DataFrame:
    """One alert per feature whose distance passes the critical value of the first level.

    `levels` are coefficients of the two-sample test; the critical value is one of them times
    sqrt((n_ref + n_cur) / (n_ref n_cur)).
    """
    unit = F.sqrt((F.col("n_ref") + F.col("n_cur")) / (F.col("n_ref").cast("double") * F.col("n_cur")))
    value = F.col("ks")
    return ks.filter(value > levels[0] * unit).select(
        "feature",
        value.alias("value"),
        (levels[0] * unit).alias("critical"),
        F.lit("drift").alias("type"),
        F.when(value > levels[1] * unit, "high").otherwise("medium").alias("severity"),
    )


def daily_profile(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of each feature per day."""
    by = ["date", "feature"]
    rows = long_features(df.withColumn("date", F.to_date("timestamp")), names, ["date"])
    moments = rows.groupBy(*by).agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(rows, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, by)
    return moments.join(quartiles, by)


def data_quality(readings: DataFrame, ranges: Mapping[str, tuple] = SENSOR_RANGES) -> DataFrame:
    """Per column: rows, NULL share and values outside the sensor's range, in one aggregate."""
    checked = [c for c in ranges if c in readings.columns]
    fields = []
    for c in checked:
        low, high = ranges[c]
        fields.append(F.struct(
            F.lit(c).alias("column"),
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col(c).isNull(), 1)).alias("nulls"),
            F.count(F.when((F.col(c) < low) | (F.col(c) > high), 1)).alias("out_of_range"),
        ))
    report = readings.agg(F.array(*fields).alias("_checks")).select(F.inline("_checks"))
    return report.withColumn("null_share", F.col("nulls") / F.nullif("n", F.lit(0)))


def duplicate_keys(readings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return readings.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def correlations(df: DataFrame, names: Sequence[str], by: Sequence[str] = ("location",)) -> DataFrame:
    """Pearson correlation of every pair of columns, per group, from one aggregate."""
    pairs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), no_nan(F.corr(a, b)).alias("corr"))
        for a, b in combinations(names, 2)
    ]
    return df.groupBy(*by).agg(F.array(*pairs).alias("_pairs")).select(*by, F.inline("_pairs"))
