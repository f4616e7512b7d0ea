"""Classifier training on executors (TRN1-TRN3).

The reference trains scikit-learn forests and LightGBM on the driver; here the
same three configurations are ``pyspark.ml`` estimators fitted on a
distributed DataFrame.  Not the same models: ``min_samples_split`` maps to
``minInstancesPerNode`` (per child, not per parent), trees grow level-wise and
``max_delta_step`` has no counterpart -- quality is comparable, not equal.  The
reference's own booster, leaf-wise and with ``max_delta_step``, is ``leafwise``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.session import stored

# The three reference configurations.
RF_SMALL = {"maxDepth": 4, "featureSubsetStrategy": "4", "numTrees": 100, "seed": 1, "minInstancesPerNode": 1}
RF_LARGE = {"maxDepth": 8, "featureSubsetStrategy": "6", "numTrees": 100, "seed": 1, "minInstancesPerNode": 1}
GBT = {"stepSize": 0.07, "maxIter": 100, "maxDepth": 10, "seed": 42, "lossType": "logistic"}


# Input partitions of a fit.  Bagging is seeded per partition, so the layout is
# part of the model: it follows from the number of rows alone (or is stated), and is
# the same on any cluster.
ROWS_PER_PARTITION = 250_000
#: Of forests of few levels: every partition sends the statistics of all nodes of a level, which are few there.
SHALLOW_ROWS_PER_PARTITION, SHALLOW_DEPTH = 50_000, 5
MIN_PARTITIONS = 4


def fit_partitions(rows: int, shallow: bool = False) -> int:
    """Partitions of a fit on so many rows."""
    return max(MIN_PARTITIONS, -(-rows // (SHALLOW_ROWS_PER_PARTITION if shallow else ROWS_PER_PARTITION)))


def _laid_out(df: DataFrame, partitions: int) -> DataFrame:
    """Rows dealt by their own hash and sorted by it: the same layout, and so the
    same model, however ``df`` was partitioned."""
    mixed = F.xxhash64(*[F.col(c) for c in df.columns])
    return (df.withColumn("_h", mixed).repartition(partitions, "_h").sortWithinPartitions("_h", *df.columns).drop("_h"))


def _fit(stages: Pipeline, df: DataFrame, partitions: int | None, shallow: bool = False) -> PipelineModel:
    """Fit and return a copy: the copy drops the training summary, which holds
    the session and would otherwise be captured by every scoring closure."""
    rows = stored(df, "fit-rows")  # counted, laid out, and read again by every level of every tree
    return stages.fit(_laid_out(rows, partitions or fit_partitions(rows.count(), shallow))).copy()


def _assembled(feature_cols: list[str], estimator) -> Pipeline:
    assembler = VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, estimator])


def train_random_forest(df: DataFrame, feature_cols: list[str], label_col: str,
                        params: dict | None = None, partitions: int | None = None) -> PipelineModel:
    p = dict(RF_SMALL, **(params or {}))
    n = int(p["featureSubsetStrategy"]) if str(p["featureSubsetStrategy"]).isdigit() else None
    if n is not None and n > len(feature_cols):
        p["featureSubsetStrategy"] = "all"
    est = RandomForestClassifier(featuresCol="features", labelCol=label_col, **p)
    return _fit(_assembled(feature_cols, est), df.select(*feature_cols, label_col), partitions, p["maxDepth"] <= SHALLOW_DEPTH)


def train_gbt(df: DataFrame, feature_cols: list[str], label_col: str,
              params: dict | None = None, partitions: int | None = None) -> PipelineModel:
    est = GBTClassifier(featuresCol="features", labelCol=label_col, **dict(GBT, **(params or {})))
    return _fit(_assembled(feature_cols, est), df.select(*feature_cols, label_col), partitions)
