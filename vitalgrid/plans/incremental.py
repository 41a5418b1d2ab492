"""The merged table kept up to date: only the days of a location that changed input files touch are computed again.

A manifest lists every input file with its length and modification time and the (location, day) pairs it holds. A run
compares the listing with the manifest, reads the files that are new or changed for the pairs they hold now, adds the
pairs that changed or removed files held before, and rewrites these partitions; all others keep their files. The merged
table may be built so because every hour depends on readings of its own day and location alone.

The manifest's new version is written last. A run that breaks before leaves the old version, so the next run finds the
same pairs and overwrites them again.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators import merge
from ..operators.attach import attach
from ..schemas import AIR_QUALITY, WEARABLE, WEARABLE_ALT, WEATHER
from ..session import written
from ..sources.readers import read_partitioned_csv, read_source_folders

SCHEMAS = {"wearable": WEARABLE, "wearable_alt": WEARABLE_ALT, "air": AIR_QUALITY, "weather": WEATHER}
MANIFEST = "source string, path string, length long, modified timestamp, location string, day date, version long"
PAIR = ["location", "day"]


@dataclass(frozen=True)
class IncrementalTable:
    """Merged hours in `out`/merged by location and day, from CSV folders by location in `raw`."""

    raw: str
    out: str

    def manifest(self, spark: SparkSession) -> DataFrame:
        """Files and pairs of the newest version; none before the first run."""
        try:
            rows = spark.read.schema(MANIFEST).parquet(f"{self.out}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], MANIFEST)
        newest = rows.agg(F.max("version").alias("v"))
        return rows.filter(F.col("version") == newest.scalar())

    def listing(self, spark: SparkSession) -> DataFrame:
        """source, path, length, modified of every input file; contents are not read."""
        found = None
        for source in SCHEMAS:
            files = (
                spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
                .load(f"{self.raw}/{source}")
                .select(F.lit(source).alias("source"), "path", "length", F.col("modificationTime").alias("modified"))
            )
            found = files if found is None else found.unionByName(files)
        return found

    def _pairs_of(self, spark: SparkSession, source: str, changed: DataFrame) -> DataFrame:
        """path, location, day of what the changed files of a source hold; others are not read."""
        paths = [r["path"] for r in changed.filter(F.col("source") == source).select("path").collect()]
        if not paths:
            return spark.createDataFrame([], "path string, location string, day date")
        rows = read_partitioned_csv(spark, paths, SCHEMAS[source], base=f"{self.raw}/{source}")
        path = F.url_decode(F.regexp_replace("_file", r"\+", "%2B"))
        named = rows.select(F.col("_metadata.file_path").alias("_file"), "location", F.to_date("timestamp").alias("day"))
        return named.filter("day is not null").select(path.alias("path"), *PAIR).distinct()

    def update(self, spark: SparkSession) -> DataFrame:
        """Bring the table up to date; returns the pairs that were computed again, with their hours (0: gone)."""
        before = written(self.manifest(spark).drop("version"), "manifest")
        now = written(self.listing(spark), "listing")
        file = ["source", "path", "length", "modified"]
        known = before.select(*file).distinct()
        changed = written(now.join(known, file, "left_anti"), "changed")
        stale = written(before.join(now, file, "left_anti"), "stale")
        held = None
        for source in SCHEMAS:
            pairs = self._pairs_of(spark, source, changed).withColumn("source", F.lit(source))
            held = pairs if held is None else held.unionByName(pairs)
        fresh = written(changed.join(held, ["source", "path"], "left"), "fresh")
        touched = written(
            fresh.select(*PAIR).union(stale.select(*PAIR)).filter("day is not null").distinct(), "touched"
        )
        table = self._rebuilt(spark, touched)
        counts = written(
            attach(touched, table.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("hours")), PAIR).fillna(0, ["hours"]), "rebuilt"
        )
        table.repartition(*PAIR).sortWithinPartitions(*PAIR, "timestamp").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*PAIR).parquet(f"{self.out}/merged")
        self._remove(spark, counts.filter("hours = 0"))
        version = spark.read.schema(MANIFEST).parquet(f"{self.out}/manifest").agg(
            F.max("version")).first()[0] if not known.isEmpty() else 0
        kept = before.join(stale.select(*file).distinct(), file, "left_anti")
        kept.unionByName(fresh).withColumn("version", F.lit(version + 1)).write.mode("append").parquet(f"{self.out}/manifest")
        return counts

    def _rebuilt(self, spark: SparkSession, touched: DataFrame) -> DataFrame:
        """The merged hours of the touched pairs, from all files that may hold them."""
        s = read_source_folders(spark, self.raw)

        def here(rows):
            return attach(rows.withColumn("day", F.to_date("timestamp")), touched, PAIR, "left_semi", computed=True).drop("day")

        merged = merge.merge_sources(here(s.wearable), here(s.air), here(s.weather))
        return written(merged.withColumn("day", F.to_date("timestamp")), "rebuilt-hours")

    def _remove(self, spark: SparkSession, gone: DataFrame) -> None:
        """Drop the partitions that have no hours any more: an overwrite leaves what it has no rows for."""
        for row in gone.collect():
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.out}/merged/location={row['location']}/day={row['day']}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.out}/merged").drop("day")
