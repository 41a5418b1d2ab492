"""Streams that keep their state in tables: hours that late readings repair, and limits that follow the data.

Each batch writes folders of its own number and overwrites them when it runs again, so a restart neither loses nor
repeats rows. What a batch may know of the ones before it is read from their folders only.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.core import stable
from ..operators import labels, sketches
from ..operators.attach import attach
from ..schemas import LABEL_QUANTILE
from ..session import written
from .run import AVAILABLE

DELAY = "2 hours"
KEYS = ("location", "timestamp")
# measures with a mean; the first also has a deviation
MEANS = ("heart_rate", "spo2", "sleep_quality")


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, trigger=AVAILABLE) -> None:
    """Process what is there, batch by batch; the checkpoint makes a later call go on after it."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    query.awaitTermination()


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches with their number; none before the first."""
    schema = T.StructType([f for f in schema if f.name != "batch"] + [T.StructField("batch", T.LongType())])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _put(rows: DataFrame, path: str, batch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


# --- partial aggregates ------------------------------------------------------------------------


def partial_vitals(readings: DataFrame, by=KEYS) -> DataFrame:
    """What hourly vitals need of some readings, in a form that adds up.

    Per measure the number of readings, their mean and the sum of squares around it; sums, extremes.
    """
    return readings.filter(F.col("timestamp").isNotNull()).groupBy(*by).agg(
        *[F.count(m).alias(f"{m}_n") for m in MEANS],
        *[F.coalesce(F.avg(m), F.lit(0.0)).alias(f"{m}_mean") for m in MEANS],
        F.coalesce(F.var_pop("heart_rate") * F.count("heart_rate"), F.lit(0.0)).alias("heart_rate_m2"),
        F.max("heart_rate").alias("heart_rate_max"), F.min("spo2").alias("spo2_min"),
        F.max("cumulative_steps").alias("cumulative_steps_max"),
        *[F.coalesce(F.sum(m), F.lit(0).cast("long")).alias(m) for m in ("steps", "sleep_status")],
        F.count("user_id").alias("users"),
    )


def merged_vitals(partials: DataFrame) -> DataFrame:
    """Hourly vitals, as `hourly_vitals` gives them for all readings behind the partial aggregates."""
    total = {m: F.sum(f"{m}_n") for m in MEANS}
    mean = {m: F.sum(F.col(f"{m}_n") * F.col(f"{m}_mean")) / F.nullif(total[m], F.lit(0)) for m in MEANS}
    # squares around the common mean, from those around each part's
    parts = partials.groupBy(*KEYS).agg(mean["heart_rate"].alias("_mean"))
    around = partials.join(parts, list(KEYS))
    squares = F.sum(F.col("heart_rate_m2") + F.col("heart_rate_n") * F.pow(F.col("heart_rate_mean") - F.col("_mean"), 2))
    n = total["heart_rate"]
    return around.groupBy(*KEYS).agg(
        stable(mean["heart_rate"]).alias("heart_rate_mean"),
        stable(F.when(n > 1, F.sqrt(squares / (n - 1)))).alias("heart_rate_std"),
        F.max("heart_rate_max").alias("heart_rate_max"),
        F.sum("steps").alias("steps_total"),
        F.max("cumulative_steps_max").alias("cumulative_steps_max"),
        stable(mean["spo2"]).alias("spo2_mean"),
        F.min("spo2_min").alias("spo2_min"),
        F.sum("sleep_status").alias("sleeping_users_count"),
        stable(mean["sleep_quality"]).alias("sleep_quality_mean"),
        F.sum("users").alias("active_users_count"),
    )


class RepairableHours:
    """Hourly vitals of a stream of readings, in which late readings are kept and merged in afterwards.

    An hour is closed once its end lies at or before the newest time of all batches before, less `delay`. Readings of
    a closed hour are late: they go to a side table, and `repair` adds them to the stored partial aggregates. Readings
    of a batch are held against what the batches before it saw, so a batch that runs again judges alike.
    """

    def __init__(self, path: str, delay: str = DELAY):
        self.path, self.delay = path, delay

    def _folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def _marks(self, spark: SparkSession) -> DataFrame:
        return _stored(spark, self._folder("marks"), T.StructType([T.StructField("newest", T.TimestampNTZType())]))

    def absorb(self, readings: DataFrame, batch: int) -> None:
        """Take in one batch: (readings, batch number)."""
        spark = readings.sparkSession
        mark = self._marks(spark).filter(F.col("batch") < batch).agg(
            (F.max("newest") - F.expr(f"INTERVAL {self.delay}")).alias("mark")
        )
        rows = readings.filter(F.col("timestamp").isNotNull())
        end = F.date_trunc("hour", "timestamp").cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")
        marked = rows.withColumn("_late", F.coalesce(end <= mark.scalar(), F.lit(False)))
        hour = F.date_trunc("hour", "timestamp").cast("timestamp_ntz")
        _put(marked.filter("_late").drop("_late"), self._folder("late"), batch)
        in_time = marked.filter(~F.col("_late")).drop("_late").withColumn("timestamp", hour)
        _put(partial_vitals(in_time), self._folder("partials"), batch)
        # last, because the mark is what later batches go by
        _put(rows.agg(F.max("timestamp").alias("newest")), self._folder("marks"), batch)

    def late_readings(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        return _stored(spark, self._folder("late"), schema)

    def repair(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """Add the late readings of batches not repaired yet; returns the hours hit, with their late readings."""
        late = self.late_readings(spark, schema)
        empty = partial_vitals(late.filter("false").drop("batch"))
        done = _stored(spark, self._folder("repairs"), empty.schema).select("batch").distinct()
        hour = F.date_trunc("hour", "timestamp").cast("timestamp_ntz")
        new = late.join(F.broadcast(done), "batch", "left_anti").withColumn("timestamp", hour)
        # one folder per repaired batch, overwritten alike when a broken repair runs again
        partial_vitals(new, ("batch", *KEYS)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "batch"
        ).parquet(self._folder("repairs"))
        return new.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("late_readings"))

    def hours(self, spark: SparkSession, schema: T.StructType, closed_only: bool = False) -> DataFrame:
        """The hourly table as it stands, repaired hours included; `closed_only` leaves open hours out."""
        wanted = partial_vitals(spark.createDataFrame([], schema)).schema
        parts = [_stored(spark, self._folder(name), wanted) for name in ("partials", "repairs")]
        found = merged_vitals(parts[0].unionByName(parts[1]))
        if not closed_only:
            return found
        mark = self._marks(spark).agg((F.max("newest") - F.expr(f"INTERVAL {self.delay}")).alias("mark"))
        return found.filter(F.col("timestamp") + F.expr("INTERVAL 1 HOUR") <= mark.scalar())


# --- limits that follow the data ---------------------------------------------------------------


class FollowingLimits:
    """Labels of a stream against limits learned from all batches before, and from nothing else.

    Every batch stores one quantile sketch per location and the limits it was judged by, so the version of the limits
    behind a label can be looked up; the merged sketches of the batches before give the limits. A location that no
    batch before has seen gets no label.
    """

    def __init__(self, path: str, quantile: float = LABEL_QUANTILE, step: float = sketches.STEP):
        self.path, self.quantile, self.step = path, quantile, step

    def _sketches(self, spark: SparkSession) -> DataFrame:
        schema = T._parse_datatype_string(f"location string, n long, cells {sketches.CELL}")
        return _stored(spark, f"{self.path}/sketches", schema)

    def limits_before(self, spark: SparkSession, batch: int) -> DataFrame:
        """location, threshold, rows: the limits that batch `batch` is judged by."""
        merged = sketches.merged_sketches(self._sketches(spark).filter(F.col("batch") < batch), ["location"])
        found = sketches.sketch_quantiles(merged, {"threshold": self.quantile})
        return found.select("location", "threshold", F.col("n").alias("learned_from"))

    def absorb(self, merged: DataFrame, batch: int) -> None:
        """Label one batch of merged hours, then learn from it."""
        spark = merged.sparkSession
        scored = written(labels.with_risk_score(merged), "batch-scores")
        _put(self.limits_before(spark, batch), f"{self.path}/limits", batch)
        limits = spark.read.parquet(f"{self.path}/limits/batch={batch}")
        labeled = attach(scored, limits, ["location"], computed=True)
        labeled = labeled.withColumn("health_risk", (F.col("risk_score") >= F.col("threshold")).cast("int"))
        _put(labeled, f"{self.path}/labeled", batch)
        _put(sketches.quantile_sketches(scored, "risk_score", ["location"], self.step), f"{self.path}/sketches", batch)

    def labeled(self, spark: SparkSession) -> DataFrame:
        """Every hour with its label, the limit it was held against and its batch."""
        return spark.read.parquet(f"{self.path}/labeled")
