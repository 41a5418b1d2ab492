"""Sinks: location-partitioned tables and the metrics log."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import WEARABLE, WEARABLE_ALT
from .events import Sources


def write_by_location(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite the partitions that occur in `df`.

    Rows are spread by location and day before the write: a hot location is written by many
    tasks, and many small locations do not leave one file per task each. Files are in time order.
    """
    (
        df.withColumn("_day", F.to_date("timestamp"))
        .repartition("location", "_day")
        .sortWithinPartitions("location", "timestamp")
        .drop("_day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("location")
        .format(fmt)
        .save(path)
    )


def write_node_csv(df: DataFrame, path: str) -> None:
    """CSV with header, one folder per location."""
    df.write.mode("overwrite").option("header", True).partitionBy("location").csv(path)


def write_sources_csv(sources: Sources, path: str, alternative: Sequence[str] = ()) -> None:
    """All three sources as CSV folders by location; the `alternative` sites in the second wearable layout."""
    other = F.col("location").isin(*alternative) if alternative else F.lit(False)
    for folder, layout, rows in (("wearable", WEARABLE, ~other), ("wearable_alt", WEARABLE_ALT, other)):
        columns = ["location", *[c for c in layout.names if c != "location"]]
        write_node_csv(sources.wearable.filter(rows).select(*columns), f"{path}/{folder}")
    write_node_csv(sources.air, f"{path}/air")
    write_node_csv(sources.weather, f"{path}/weather")


def labeled_path(base: str, method: str) -> str:
    """Table path of the labeled data for a labeling method."""
    names = {"binary": "labeled", "continuous": "labeled_continuous"}
    if method not in names:
        raise ValueError(f"method must be 'binary' or 'continuous', not {method!r}")
    return f"{base}_{names[method]}"


def append_metrics(metrics: DataFrame, path: str, run: str) -> None:
    """Append round metrics to the metrics table of all runs."""
    metrics.withColumn("run", F.lit(run)).write.mode("append").parquet(path)
