"""Build the merged and labeled tables: python -m vitalgrid RAW OUT [--nodes A B ...]"""

import argparse

from pyspark.sql import SparkSession

from .operators.labels import label_distribution
from .plans.tables import build_tables
from .schemas import DEFAULT_NODES


def main():
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw")
    parser.add_argument("out")
    parser.add_argument("--nodes", nargs="+", default=list(DEFAULT_NODES))
    parser.add_argument("--align", choices=["exact", "hour"], default="exact")
    parser.add_argument("--no-labels", action="store_true")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("vitalgrid").getOrCreate()
    paths = build_tables(spark, args.raw, args.out, args.nodes, not args.no_labels, args.align)
    for name, path in paths.items():
        print(name, path)
    if "node" in paths:
        label_distribution(spark.read.parquet(paths["node"]), ["location"]).orderBy("location", "health_risk").show()


if __name__ == "__main__":
    main()
