"""Risk score, percentile threshold and labels."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import core, risk
from ..schemas import LABEL_QUANTILE, SCORE_INPUTS
from ..session import cut_lineage
from .attach import attach
from .ordered import UNIT_LEVELS, exact_quantiles, share_cut

SCOPES = {"node": ["location"], "global": []}
POSITIVE_SHARE = 0.3
# closeness of two scores, relative to the first row of the scope
_ABSOLUTE, _RELATIVE = 1e-8, 1e-5


def require_columns(df: DataFrame, needed: Sequence[str] = SCORE_INPUTS) -> None:
    for name in needed:
        if name not in df.columns:
            raise ValueError(f"missing column {name!r}; the risk score needs {', '.join(needed)}")


def with_risk_components(merged: DataFrame) -> DataFrame:
    require_columns(merged)
    return merged.withColumns({name: make() for name, make in risk.COMPONENTS.items()}).withColumn(
        "risk_score", risk.weighted_score({name: name for name in risk.COMPONENTS})
    )


def with_risk_score(merged: DataFrame) -> DataFrame:
    require_columns(merged)
    return merged.withColumn("risk_score", risk.weighted_score())


def thresholds(scored: DataFrame, scope: str = "node", quantile: float = LABEL_QUANTILE) -> DataFrame:
    """The label threshold of each scope, over its non-NULL scores."""
    return exact_quantiles(
        scored, "risk_score", {"threshold": quantile}, SCOPES[scope], levels=UNIT_LEVELS
    )


def constant_scopes(scored: DataFrame, scope: str = "node") -> DataFrame:
    """Per scope: are all scores close to the first one?"""
    by = SCOPES[scope]
    # within one location the time alone orders the rows, and keeps a hash aggregate possible
    first = F.min_by("risk_score", "timestamp" if by else F.struct("timestamp", "location"))
    stats = scored.filter(F.col("risk_score").isNotNull()).groupBy(*by).agg(
        F.min("risk_score").alias("_low"), F.max("risk_score").alias("_high"), first.alias("_first")
    )
    slack = F.lit(_ABSOLUTE) + F.lit(_RELATIVE) * F.abs("_first")
    far = F.greatest(F.abs(F.col("_low") - F.col("_first")), F.abs(F.col("_high") - F.col("_first")))
    return stats.select(*by, (far <= slack).alias("is_constant"))


def constant_labels(scored: DataFrame, scope: str = "node") -> DataFrame:
    """Labels for scopes whose scores are all alike: max(1, floor(0.3 n)) rows get 1.

    The rows are chosen by hash of location and time, so every run chooses the same ones.
    """
    by = SCOPES[scope]
    key = core.hash_key("location", "timestamp")
    cut = share_cut(scored.filter(F.col("risk_score").isNotNull()), key, POSITIVE_SHARE, by, F.floor, at_least=1)
    chosen = F.when(F.col("risk_score").isNotNull(), (key <= F.col("cut")).cast("int"))
    return _attach(scored, cut.select(*by, "cut"), by).withColumn("health_risk", chosen).drop("cut")


def binary_labels(scored: DataFrame, scope: str = "node", quantile: float = LABEL_QUANTILE) -> DataFrame:
    """health_risk = 1 from the scope's score quantile upward, ties included.

    A scope whose scores are all alike falls back to a fixed share of its rows. Thresholds are
    computed first, as a small table; the fallback is planned only when a scope needs it.
    """
    by = SCOPES[scope]
    limits = thresholds(scored, scope, quantile).select(*by, "threshold")
    flat = constant_scopes(scored, scope)
    if by:
        limits = limits.join(flat, by)
    else:
        limits = limits.withColumn("is_constant", flat.scalar())
    limits = cut_lineage(limits)
    labeled = _attach(scored, limits, by, computed=True).withColumn(
        "health_risk", (F.col("risk_score") >= F.col("threshold")).cast("int")
    )
    if not limits.filter("is_constant").isEmpty():
        labeled = _with_constant_scopes(labeled, scope)
    return labeled.drop("is_constant").withColumn("risk_category", risk.binary_category())


def _with_constant_scopes(labeled: DataFrame, scope: str) -> DataFrame:
    """Replace the labels of constant scopes; the other rows keep theirs."""
    flat = F.coalesce("is_constant", F.lit(False))
    replaced = constant_labels(labeled.filter(flat).drop("health_risk"), scope)
    return labeled.filter(~flat).unionByName(replaced)


def continuous_labels(scored: DataFrame) -> DataFrame:
    """health_risk = the score itself, with its right-closed category."""
    return scored.withColumn("health_risk", F.col("risk_score")).withColumn(
        "risk_category", risk.score_category("health_risk")
    )


def label_distribution(labeled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return labeled.groupBy(*by, "health_risk").agg(F.count(F.lit(1)).alias("n"))


def _attach(rows: DataFrame, per_scope: DataFrame, by: Sequence[str], computed: bool = False) -> DataFrame:
    """Bring the values of each scope to its rows; a single scope needs no join at all."""
    if by:
        return attach(rows, per_scope, by, computed=computed)
    values = per_scope.select(F.struct(*per_scope.columns)).scalar()
    return rows.withColumn("_scope", values).select(*rows.columns, "_scope.*")
