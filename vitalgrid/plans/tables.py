"""From raw files to the merged and labeled tables, and the panels read from them."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators import labels, merge, reports, rules
from ..schemas import DEFAULT_NODES, MERGED_COLUMNS
from ..session import written
from ..sources.readers import read_nodes
from ..sources.writers import labeled_path, write_by_location

LABELED_COLUMNS = (*MERGED_COLUMNS, "health_risk", "risk_category")


def build_tables(
    spark: SparkSession,
    raw: str,
    out: str,
    nodes: Sequence[str] = DEFAULT_NODES,
    generate_labels: bool = True,
    align: str = "exact",
) -> dict[str, str]:
    """Merge the raw sources of all nodes and label them; returns the path of each table.

    The merged table is written once and every labeling reads it back: `node` labels against
    each location's own threshold, `all` against one threshold, `continuous` is the score.
    """
    s = read_nodes(spark, raw, nodes)
    merged = merge.merge_sources(s.wearable, s.air, s.weather, align)
    paths = {"merged": f"{out}/merged"}
    write_by_location(merged, paths["merged"])
    if not generate_labels:
        return paths
    stored = spark.read.schema(merged.schema).parquet(paths["merged"])
    scored = labels.with_risk_score(stored)
    tables = {
        "node": (labeled_path(f"{out}/node", "binary"), labels.binary_labels(scored, "node")),
        "all": (labeled_path(f"{out}/all", "binary"), labels.binary_labels(scored, "global")),
        "continuous": (labeled_path(f"{out}/all", "continuous"), labels.continuous_labels(scored)),
    }
    for name, (path, table) in tables.items():
        write_by_location(table.select(*LABELED_COLUMNS), path)
        paths[name] = path
    return paths


def authority_panels(
    labeled_all: DataFrame, labeled_node: DataFrame, regions: Sequence[str], dates: Sequence = ()
) -> dict[str, DataFrame]:
    """What health authorities see. The filtered rows are written once for all panels;
    the regional comparison covers all dates, against each location's own threshold."""
    rows = written(reports.in_date_range(reports.in_regions(labeled_all, regions), dates), "panel-rows")
    return {
        "rows": rows,
        "kpi": reports.kpi_overview(rows),
        "alerts": rules.alerts(rows),
        "comparison": reports.regional_comparison(labeled_node, regions),
        "trends": reports.daily_risk_trends(rows),
        "environment": reports.long_series(rows, reports.ENVIRONMENT_SERIES, ordered=True),
        "vitals": reports.long_series(rows, reports.VITALS_SERIES, ordered=True),
        "detail": reports.detail_table(rows),
    }


def citizen_panels(labeled_node: DataFrame, region: str, dates: Sequence = ()) -> dict[str, DataFrame]:
    """What a citizen of one region sees; without dates, its last seven days."""
    here = reports.in_regions(labeled_node, [region])
    rows = written(reports.in_date_range(here, dates) if len(dates) == 2 else reports.last_days(here), "panel-rows")
    return {
        "rows": rows,
        "status": reports.latest_status(rows),
        "alerts": rules.alerts_for(rules.alerts(rows), region),
        "daily": reports.citizen_daily(rows),
        "health": reports.daily_health(rows),
        "environment": reports.long_series(rows, reports.ENVIRONMENT_SERIES, ordered=True),
        "recommendations": rules.recommendations(rows),
    }
