"""Classifiers on prepared features: scaling, fit, prediction, evaluation, persistence."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import features, metrics

LABEL = "health_risk"
VECTOR = "features"

# default settings per model type; keyword arguments override them
DEFAULTS = {
    "random_forest": {"n_estimators": 100, "max_depth": 10, "random_state": 42},
    "gradient_boosting": {"n_estimators": 100, "max_depth": 5, "learning_rate": 0.1, "random_state": 42},
    "logistic_regression": {"max_iter": 1000, "random_state": 42},
}
# the library's limits: the deepest tree it grows stands in for "no limit", and a split is sought
# among this many values of a feature; `max_bins` in the settings overrides the second
DEEPEST = 30
MAX_BINS = 256


def estimator(model_type: str, n_rows: int, settings: Mapping):
    """The Spark ML estimator of a model type."""
    base = {"featuresCol": VECTOR, "labelCol": LABEL}
    if model_type == "random_forest":
        return RandomForestClassifier(
            numTrees=settings["n_estimators"], maxDepth=settings["max_depth"] or DEEPEST,
            seed=settings["random_state"], featureSubsetStrategy="sqrt",
            maxBins=settings.get("max_bins", MAX_BINS), **base,
        )
    if model_type == "gradient_boosting":
        return GBTClassifier(
            maxIter=settings["n_estimators"], maxDepth=settings["max_depth"], stepSize=settings["learning_rate"],
            seed=settings["random_state"], maxBins=settings.get("max_bins", MAX_BINS), **base,
        )
    # the summed loss plus half the squared weights, per row
    return LogisticRegression(
        maxIter=settings["max_iter"], elasticNetParam=0.0, standardization=False, regParam=1.0 / max(n_rows, 1), **base
    )


def scaling_stage(stats: Mapping[str, tuple[float, float]]) -> SQLTransformer:
    """(x - mean) / scale per feature, as a stage that is saved with the model.

    The library's own scaler divides by the sample deviation and turns constant features
    into zeros, so it would not give these numbers.
    """
    columns = ", ".join(
        f"(`{name}` - ({mean!r}D)) / {scale!r}D AS `z_{name}`" for name, (mean, scale) in stats.items()
    )
    return SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")


def collect_stats(rows: DataFrame, names: Sequence[str]) -> tuple[int, dict[str, tuple[float, float]]]:
    """Row count and (mean, scale) per feature: one row, as wide as the feature vector."""
    row = features.scaler_stats(rows, names).first()
    return row["n"], {n: (float(row[f"mean_{n}"]), float(row[f"scale_{n}"])) for n in names}


def labeled_only(rows: DataFrame) -> DataFrame:
    """Rows with a label: an hour without a score has none, and nothing can be learned from it."""
    return rows.filter(F.col(LABEL).isNotNull())


@dataclass
class HealthModel:
    """A classifier with its feature names and scaling; every pass over rows is a Spark job."""

    model_type: str = "random_forest"
    settings: dict = field(default_factory=dict)
    names: list[str] | None = None
    fitted: PipelineModel | None = None

    def __post_init__(self):
        if self.model_type not in DEFAULTS:
            raise ValueError(f"unknown model type {self.model_type!r}")
        self.settings = {**DEFAULTS[self.model_type], **self.settings}

    def prepare(self, table: DataFrame, mapping=None) -> DataFrame:
        """Encoded rows; the first call fixes the feature names, later ones align to them."""
        rows, self.names = features.prepare_features(table, mapping, self.names)
        return rows

    def fit(self, rows: DataFrame, stats: Mapping | None = None) -> "HealthModel":
        """Fit on the labeled ones of prepared rows. `stats` replaces the scaling learned from them."""
        rows = labeled_only(rows)
        if self.names is None:
            self.names = features.feature_columns(rows)
        n, learned = collect_stats(rows, self.names)
        pre = [
            scaling_stage(stats or learned),
            VectorAssembler(inputCols=[f"z_{c}" for c in self.names], outputCol=VECTOR, handleInvalid="error"),
        ]
        staged = rows
        for stage in pre:
            staged = stage.transform(staged)
        training = staged.select(F.col(LABEL).cast("double").alias(LABEL), VECTOR).persist()
        try:
            model = estimator(self.model_type, n, self.settings).fit(training)
        finally:
            training.unpersist()
        self.fitted = PipelineModel([*pre, model])
        return self

    @property
    def model(self):
        return self.fitted.stages[-1]

    def rescaled(self, stats: Mapping[str, tuple[float, float]]) -> "HealthModel":
        """The same classifier behind other scaling values."""
        stages = [scaling_stage(stats), *self.fitted.stages[1:]]
        return HealthModel(self.model_type, self.settings, self.names, PipelineModel(stages))

    def predict(self, rows: DataFrame) -> DataFrame:
        """Add `prediction` (0/1) and `score` (probability of class 1)."""
        out = self.fitted.transform(rows)
        probability = vector_to_array("probability")[1]
        return out.select(
            *rows.columns, F.col("prediction").cast("int").alias("prediction"), probability.alias("score")
        )

    def evaluate(self, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        return metrics.evaluate(self.predict(labeled_only(rows)), by)

    def importances(self) -> DataFrame:
        """Rows (idx, feature, value): tree importances, or weights of the linear model."""
        weights = (
            self.model.coefficients if self.model_type == "logistic_regression" else self.model.featureImportances
        ).toArray()
        rows = [(i, name, float(w)) for i, (name, w) in enumerate(zip(self.names, weights))]
        schema = T.StructType([
            T.StructField("idx", T.IntegerType()), T.StructField("feature", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ])
        return SparkSession.active().createDataFrame(rows, schema)

    def save(self, path: str) -> None:
        self.fitted.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str, model_type: str, settings: Mapping | None = None) -> "HealthModel":
        """A saved model; its feature names come back from the assembler."""
        fitted = PipelineModel.load(path)
        names = [c.removeprefix("z_") for c in fitted.stages[1].getInputCols()]
        return cls(model_type, dict(settings or {}), names, fitted)


def train_and_score(
    rows: DataFrame, names: Sequence[str], model_type: str, by: Sequence[str] = (), settings: Mapping | None = None
) -> DataFrame:
    """Fit on the rows not marked `is_test` and evaluate on the others."""
    model = HealthModel(model_type, dict(settings or {}), list(names))
    model.fit(rows.filter(~F.col("is_test")))
    return model.evaluate(rows.filter("is_test"), by).withColumn("model_type", F.lit(model_type))


def central_train(labeled: DataFrame, path: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """The centralized trainer: unstratified split, a forest of 150 trees without depth limit,
    saved to `path`; returns the number of its test rows, its accuracy, and how many rows were left
    out for want of a label. Categories are encoded like everywhere else."""
    model = HealthModel("random_forest", {"n_estimators": 150, "max_depth": None, "random_state": seed})
    prepared = model.prepare(labeled)
    rows = features.random_split(labeled_only(prepared), test_size, seed)
    model.fit(rows.filter(~F.col("is_test")))
    model.save(path)
    scored = model.predict(rows.filter("is_test"))
    unlabeled = prepared.filter(F.col(LABEL).isNull()).agg(F.count(F.lit(1))).scalar()
    return metrics.confusion_metrics(scored).select("n", "accuracy", unlabeled.alias("left_out"))
