"""A metrics table that survives repeated and broken runs: rows are staged, then a commit names them.

Every write stages its rows under an attempt of its own; one row per (run, round) in the commit table then says which
attempt counts. The first commit of a (run, round) stays: a run that is repeated changes nothing, and one that was
killed before its commit is not seen, whatever files it left. No rename or delete is needed, so any file system will do.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

COMMIT = "run string, round int, attempt string, committed_at timestamp"
KEY = ("run", "round")


def stage_rounds(metrics: DataFrame, path: str, run: str) -> str:
    """Write the rounds of a run where readers do not look yet; returns the attempt to commit."""
    attempt = uuid.uuid4().hex
    metrics.withColumns({"run": F.lit(run), "round": F.col("round").cast("int"), "attempt": F.lit(attempt)}).write.mode(
        "append"
    ).parquet(f"{path}/rounds")
    return attempt


def commits(spark: SparkSession, path: str) -> DataFrame:
    """run, round, attempt: what counts, the first commit of each round."""
    try:
        rows = spark.read.schema(COMMIT).parquet(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], COMMIT)
    first = F.min_by("attempt", F.struct("committed_at", "attempt"))
    return rows.groupBy(*KEY).agg(first.alias("attempt"))


def commit_rounds(spark: SparkSession, path: str, run: str, attempt: str) -> None:
    """Make the rounds of an attempt visible, those that no attempt before has committed."""
    staged = spark.read.parquet(f"{path}/rounds").filter((F.col("run") == run) & (F.col("attempt") == attempt))
    new = staged.select(*KEY, "attempt").distinct().join(commits(spark, path).select(*KEY), list(KEY), "left_anti")
    new.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def log_rounds(metrics: DataFrame, path: str, run: str) -> None:
    """Stage and commit the rounds of a run."""
    commit_rounds(metrics.sparkSession, path, run, stage_rounds(metrics, path, run))


def read_rounds(spark: SparkSession, path: str) -> DataFrame:
    """The committed rounds of all runs, one attempt of each; commits are one small row per round."""
    rows = spark.read.parquet(f"{path}/rounds")
    return rows.join(F.broadcast(commits(spark, path)), [*KEY, "attempt"]).drop("attempt")
