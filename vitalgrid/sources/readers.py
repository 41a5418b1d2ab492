"""Readers with fixed schemas; NaN and empty fields become NULL."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.core import no_nan
from ..operators.merge import union_sites
from ..operators.vitals import with_missing_columns
from ..schemas import AIR_QUALITY, WEARABLE, WEARABLE_ALT, WEATHER
from .events import Sources

# the header must match the schema by name and order
CSV = {"header": True, "enforceSchema": False, "nanValue": "NaN", "nullValue": ""}

# file name patterns of one node's three sources
FILE_NAMES = {
    "wearable": "{node}.csv",
    "air": "{node}_air_quality.csv",
    "weather": "{node}_weather.csv",
}


def clean(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column."""
    numbers = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: no_nan(c) for c in numbers}) if numbers else df


def read_table(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """A missing path is an error of the reader itself.

    CSV headers are checked against the schema; nothing is inferred.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(**CSV)
    paths = [paths] if isinstance(paths, str) else list(paths)
    return clean(reader.format(fmt).load(paths))


def _node_of_file(suffix: str):
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1)
    return F.regexp_replace(F.url_decode(name), f"{suffix}$", "")


def read_nodes(spark: SparkSession, folder: str, nodes: Sequence[str]) -> Sources:
    """The three sources of all nodes, one plan each; the node is taken from the file name."""

    def paths(kind):
        return [f"{folder}/{FILE_NAMES[kind].format(node=n)}" for n in nodes]

    wearable = spark.read.schema(WEARABLE).options(**CSV).csv(paths("wearable"))
    return Sources(
        clean(wearable.withColumn("location", _node_of_file(r"\.csv"))),
        read_table(spark, paths("air"), AIR_QUALITY),
        read_table(spark, paths("weather"), WEATHER),
    )


def read_partitioned_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, base: str | None = None
) -> DataFrame:
    """CSV folders by location; the location comes from the folder name. Single files need `base`, the folder of all."""
    own = [f for f in schema.fields if f.name != "location"]
    with_location = T.StructType([*own, T.StructField("location", T.StringType())])
    reader = spark.read.schema(with_location).options(**CSV)
    return clean((reader.option("basePath", base) if base else reader).csv(path))


def read_source_folders(spark: SparkSession, path: str) -> Sources:
    """The three sources from CSV folders by location; wearables may come in either layout."""
    wearable = read_partitioned_csv(spark, f"{path}/wearable", WEARABLE)
    other = read_partitioned_csv(spark, f"{path}/wearable_alt", WEARABLE_ALT)
    other = with_missing_columns(other.withColumn("user_id", F.col("user_id").cast("string")), WEARABLE)
    return Sources(
        union_sites([wearable, other]),
        read_partitioned_csv(spark, f"{path}/air", AIR_QUALITY),
        read_partitioned_csv(spark, f"{path}/weather", WEATHER),
    )


def read_labeled(spark: SparkSession, path: str, schema: T.StructType, node: str | None = None) -> DataFrame:
    """The labeled table; one node is a partition filter, an unknown node gives no rows."""
    table = spark.read.schema(schema).parquet(path)
    return table.filter(F.col("location") == node) if node else table


def combined_or_parts(combined: DataFrame | None, parts: Sequence[DataFrame], schema: T.StructType, spark):
    """The combined table when there is one, else the union of the node tables, else no rows."""
    if combined is not None:
        return combined
    return union_sites(parts) if parts else spark.createDataFrame([], schema)
