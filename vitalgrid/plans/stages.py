"""The stages named queries start from: merged, scored and labeled hourly tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.core import clamp, stable
from ..operators import features, labels, merge
from ..schemas import MERGED_COLUMNS
from ..session import written
from ..sources.events import Sources, event_sources


def sources(spark: SparkSession, folder: str, cumulative: bool = False) -> Sources:
    return event_sources(spark, folder, cumulative)


def merged(spark: SparkSession, folder: str, cumulative: bool = False) -> DataFrame:
    """The merged hourly table; running steps are left out where no column needs them."""
    s = sources(spark, folder, cumulative)
    return merge.merge_sources(s.wearable, s.air, s.weather)


def scored(spark: SparkSession, folder: str, cumulative: bool = False) -> DataFrame:
    """Merged table with its score, written once: labels need several passes over it,
    and none of them should go back to the raw readings."""
    return written(labels.with_risk_score(merged(spark, folder, cumulative)), "scored")


def labeled(spark: SparkSession, folder: str, scope: str = "node", cumulative: bool = False) -> DataFrame:
    return labels.binary_labels(scored(spark, folder, cumulative), scope).select(
        *MERGED_COLUMNS, "risk_score", "health_risk", "risk_category"
    )


def labeled_once(spark: SparkSession, folder: str, scope: str = "node", cumulative: bool = False) -> DataFrame:
    """The labeled table as files, for queries that read it more than once."""
    return written(labeled(spark, folder, scope, cumulative), "labeled")


def model_rows(spark: SparkSession, folder: str, scope: str = "node") -> tuple[DataFrame, list[str]]:
    """Encoded features of every labeled hour, written once for the passes of a fit."""
    table = labeled(spark, folder, scope, cumulative=True).drop("risk_score")
    rows, names = features.prepare_features(table)
    return written(rows, "features"), names


def linear_scorer(table: DataFrame) -> DataFrame:
    """A fixed linear score in [0, 1] and its class, to check metrics without a fitted model."""
    raw = (
        F.lit(0.002) * F.col("aqi")
        + F.lit(0.01) * (F.col("heart_rate_mean") - F.lit(60.0))
        + F.lit(0.02) * (F.lit(96.0) - F.col("spo2_mean"))
    )
    with_score = table.withColumn("score", stable(clamp(raw, 0, 1)))
    return with_score.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
