"""Feature encoding, scaling and train/test splits."""

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import core
from ..schemas import CATEGORY_VOCABULARY, NON_FEATURES
from ..session import cut_lineage
from .attach import attach
from .ordered import share_cut

# a text column with more values is taken for something else than a category
MAX_CATEGORIES = 10_000


def vocabulary(df: DataFrame, columns: Sequence[str] = tuple(CATEGORY_VOCABULARY)) -> DataFrame:
    """Distinct non-NULL values of each category column, as rows (feature, category)."""
    present = [c for c in columns if c in df.columns]
    return df.select(*present).unpivot([], present, "feature", "category").filter(
        F.col("category").isNotNull()
    ).distinct()


def collect_vocabulary(df: DataFrame, columns: Sequence[str], most: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """The vocabulary on the driver, where it names the indicator columns.

    A column with more than `most` values is an error, not a cut.
    """
    words = cut_lineage(vocabulary(df, columns))
    large = [r["feature"] for r in words.groupBy("feature").count().filter(F.col("count") > most).collect()]
    if large:
        raise ValueError(f"more than {most} categories in {large}: not a category column")
    found = {c: [] for c in columns}
    for feature, category in sorted(map(tuple, words.collect())):
        found[feature].append(category)
    return found


def feature_columns(df: DataFrame, exclude: Sequence[str] = NON_FEATURES) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def one_hot(df: DataFrame, mapping: Mapping[str, Sequence[str]]) -> DataFrame:
    """0/1 indicator per listed category; other values and NULL give all zeros."""
    indicators = {
        f"{c}_{v}": F.col(c).eqNullSafe(F.lit(v)).cast("int") for c, values in mapping.items() for v in values
    }
    return df.withColumns(indicators).drop(*mapping) if indicators else df


def aligned(df: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Exactly the stored features, in stored order; absent ones are 0, extra ones go."""
    return df.select(
        *[c for c in keep if c in df.columns], *[F.col(n) if n in df.columns else F.lit(0).alias(n) for n in names]
    )


def prepare_features(
    df: DataFrame,
    mapping: Mapping[str, Sequence[str]] | None = None,
    names: Sequence[str] | None = None,
    missing: float | Mapping[str, float] = 0.0,
    exclude: Sequence[str] = NON_FEATURES,
    keep: Sequence[str] = ("location", "timestamp", "health_risk"),
    max_categories: int = MAX_CATEGORIES,
) -> tuple[DataFrame, list[str]]:
    """Numeric feature columns, sorted by name, beside the key and label columns.

    String columns in `mapping` become indicators of its categories, other string columns
    those of their own values. Missing numbers become `missing` (an explicit choice: a
    single reading has no deviation, and its hour should still be scored).
    """
    mapping = dict(CATEGORY_VOCABULARY if mapping is None else mapping)
    texts = [
        f.name for f in df.schema if f.name not in exclude and isinstance(f.dataType, T.StringType)
    ]
    unmapped = [c for c in texts if c not in mapping]
    learned = collect_vocabulary(df, unmapped, max_categories) if unmapped else {}
    encoded = one_hot(df, {c: mapping.get(c, learned.get(c)) for c in texts})
    names = sorted(feature_columns(encoded, exclude)) if names is None else list(names)
    rows = aligned(encoded, names, keep)
    fill = missing if isinstance(missing, Mapping) else {n: missing for n in names}
    return rows.select(
        *[c for c in keep if c in rows.columns],
        *[F.coalesce(F.col(n).cast("double"), F.lit(float(fill.get(n, 0.0)))).alias(n) for n in names],
    ), names


# ---- scaling -------------------------------------------------------------


def scaler_stats(rows: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation per feature, one row per group; a zero deviation scales by 1."""
    measures = list(chain.from_iterable(
        (F.avg(n).alias(f"mean_{n}"), _scale(F.stddev_pop(n)).alias(f"scale_{n}")) for n in names
    ))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *measures)


def _scale(deviation):
    return F.when(core.stable(deviation) == 0, F.lit(1.0)).otherwise(deviation)


def long_stats(stats: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (by, feature, mean, scale, n)."""
    pairs = [
        F.struct(F.lit(n).alias("feature"), F.col(f"mean_{n}").alias("mean"), F.col(f"scale_{n}").alias("scale"))
        for n in names
    ]
    return stats.select(*by, "n", F.inline(F.array(*pairs)))


def scaled(rows: DataFrame, stats: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(x - mean) / scale with the statistics of the row's group, or of all rows when `by` is empty."""
    if by:
        joined, prefix = attach(rows, stats.drop("n"), by), ""
    else:
        joined, prefix = rows.withColumn("_stats", stats.select(F.struct(*stats.columns)).scalar()), "_stats."
    return joined.select(
        *[c for c in rows.columns if c not in names],
        *[((F.col(n) - F.col(f"{prefix}mean_{n}")) / F.col(f"{prefix}scale_{n}")).alias(n) for n in names],
    )


# ---- splits --------------------------------------------------------------


def stratified_split(
    rows: DataFrame, test_size: float = 0.2, seed: int = 42, by: Sequence[str] = ("health_risk",)
) -> DataFrame:
    """Mark ceil(test_size * n) rows of each stratum as test rows, chosen by hash of the row key.

    The cut in hash order is found from counts, so no stratum is ever sorted in one task. A row
    without a stratum (a NULL label) is no test row.
    """
    key = core.hash_key("location", "timestamp", F.lit(seed))
    cut = share_cut(rows, key, test_size, by, F.ceil).select(*by, "cut")
    marked = attach(rows, cut, by) if by else rows.withColumn("cut", cut.scalar())
    return marked.withColumn("is_test", F.coalesce(key <= F.col("cut"), F.lit(False))).drop("cut")


def random_split(rows: DataFrame, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """The same without strata: ceil(test_size * n) test rows of all."""
    return stratified_split(rows, test_size, seed, by=())
