"""Training, registry and scoring queries (TRN1-TRN3, REG1-REG2, PRD1-PRD4,
SPL2).  A model's numbers are not SQL-expressible; what must hold of them is:
which rows are scored, that scores are probabilities that fit the predicted
class, that the three scoring forms agree, and that models beat chance."""

from __future__ import annotations

import os

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidepool.models import leafwise, predict, registry, train
from tidepool.operators import churn, evaluate, oversample, split
from tidepool.plans.churn import DF_CLEAN_SQL
from tidepool.plans.registry import query
from tidepool.session import scratch_path, stored
from tidepool.sinks import tables as sinks
from tidepool.sources import derived

SEED = 12345
TARGET = "Exited"


def churn_frame(spark, sf_dir):
    """``df_clean`` (with its CustomerId kept for the split) from churn-shaped customers."""
    df = churn.prepare_churn(derived.churn_customers(spark, sf_dir), keep_key=True)
    bools = [f.name for f in df.schema.fields if f.dataType.simpleString() == "boolean"]
    return df.select(*[F.col(c).cast("int").alias(c) if c in bools else F.col(c) for c in df.columns])


def features_of(df):
    return [c for c in df.columns if c not in ("CustomerId", TARGET)]


def prepared(spark, sf_dir):
    """Split 60/20/20 (key hash, exact sizes), SMOTE on the training part only.
    Returns (balanced train, validation, test, feature columns)."""
    frame = churn_frame(spark, sf_dir)
    feats = features_of(frame)
    # df_clean is cut (checkpointed) inside prepare_churn; the split labels rows
    # by comparison with two selected cut rows, so it is cheap to recompute.
    f = split.split_exact(frame, ["CustomerId"], seed=SEED)
    tr = f.where(F.col("split") == "train").drop("split")
    balanced = oversample.smote(tr, TARGET, feats, "CustomerId", minority=1, k=5, seed=SEED)
    balanced = stored(balanced.drop("j", "synthetic"), "balanced")
    val = f.where(F.col("split") == "validation").drop("split")
    test = f.where(F.col("split") == "test").drop("split")
    return balanced, val, test, feats


# The split of the churn rows, from the rows that the cleaning keeps.
_PARTS_SQL = DF_CLEAN_SQL[: DF_CLEAN_SQL.index("f AS (SELECT *")] + f"""
ranked AS (SELECT CustomerId, Exited, count(*) OVER () AS n,
                  row_number() OVER (ORDER BY ('0x' || substr(md5('{SEED}|' || CAST(CustomerId AS VARCHAR)), 1, 13))::BIGINT, CustomerId) AS r
           FROM dd),
parts AS (SELECT CustomerId, Exited, CASE WHEN r <= ceil(0.2 * n) THEN 'test'
                 WHEN r <= ceil(0.2 * n) + ceil(0.25 * (n - ceil(0.2 * n))) THEN 'validation' ELSE 'train' END AS part
          FROM ranked)
"""

_SCORED_SQL = _PARTS_SQL + "SELECT CustomerId, Exited, true AS fits FROM parts WHERE part = 'validation'"


def _fit_and_score(spark, sf_dir, trainer, params):
    """Key and target of every validation row, and whether its score is a probability that fits the predicted class."""
    balanced, val, _, feats = prepared(spark, sf_dir)
    model = trainer(balanced, feats, TARGET, params)
    score = vector_to_array("probability")[1]
    fits = score.between(0, 1) & ((F.col("prediction") == 1) == (score > 0.5))
    return model.transform(val).select("CustomerId", TARGET, fits.alias("fits"))


@query("train_rf_small", "TRN1,EVL1", sql=_SCORED_SQL)
def train_rf_small(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, train.train_random_forest, train.RF_SMALL)


@query("train_rf_large", "TRN2,EVL1", sql=_SCORED_SQL)
def train_rf_large(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, train.train_random_forest, train.RF_LARGE)


@query("train_gbt", "TRN3,EVL1", sql=_SCORED_SQL)
def train_gbt(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, train.train_gbt, train.GBT)


@query("train_leafwise", "TRN3,EVL1", sql=_SCORED_SQL)
def train_leafwise(spark, sf_dir):
    """The reference's own booster, leaf-wise with its steps cut, all of its rounds; saved, loaded and scored in the JVM."""
    balanced, val, _, feats = prepared(spark, sf_dir)
    path = os.path.join(scratch_path(spark, "leafwise"), "model")
    leafwise.fit(balanced, feats, TARGET).save(spark, path)
    scored = leafwise.LeafwiseModel.load(spark, path).transform(val)
    fits = F.col("score").between(0, 1) & ((F.col("prediction") == 1) == (F.col("score") > 0.5))
    return scored.select("CustomerId", TARGET, fits.alias("fits"))


def _metrics(scored):
    long = scored.select(F.lit("m").alias("model"), F.col(TARGET).alias("y"),
                         F.col("prediction").alias("p"), "score")
    return evaluate.compare_models(long).drop("model")


@query("run_log_registry", "REG1,REG2,SPL2,D15,D16", sql=_PARTS_SQL + """
SELECT 'rfc1_sm' AS model_name, 1 AS version, m.metric, true AS above_floor, t.n AS saved_test_rows
FROM (VALUES ('validation_accuracy'), ('validation_roc_auc'), ('validation_f1'), ('train_accuracy'), ('train_roc_auc'), ('train_f1')) m(metric),
     (SELECT count(*) AS n FROM parts WHERE part = 'test') t
""")
def run_log_registry(spark, sf_dir):
    """Train, log parameters and metrics (validation and training AUC), register; load by run id."""
    base = scratch_path(spark, "registry")
    balanced, val, test, feats = prepared(spark, sf_dir)
    saved = os.path.join(base, "tables", "df_test")
    sinks.overwrite_path(test, saved)  # key + target kept (D15)
    fitted = train.train_random_forest(balanced, feats, TARGET, train.RF_SMALL)
    run_id = registry.new_run_id()
    registry.register_model(spark, base, "rfc1_sm", fitted, run_id)
    # Score with the registered copy: a freshly fitted model keeps its training
    # summary (and a session handle) in the scoring closure.
    model = registry.load_model_of_run(spark, base, run_id)
    for part, frame in (("validation", val), ("train", balanced)):
        s = model.transform(frame).select(TARGET, F.col("prediction").cast("int").alias("prediction"),
                                          vector_to_array("probability")[1].alias("score"))
        m = _metrics(s).select(*[F.col(c).alias(f"{part}_{c}") for c in ("accuracy", "roc_auc", "f1")])
        registry.log_run(spark, base, "churn", run_id, "rfc1_sm", train.RF_SMALL, m)
    runs = spark.read.parquet(os.path.join(base, "run_log"))
    versions = spark.read.parquet(os.path.join(base, "registry")).select(F.col("name").alias("model_name"), "version", "run_id")
    # Chance is 0.5 for the AUC; the others only have to be positive shares.
    floor = F.when(F.col("metric").endswith("roc_auc"), 0.5).otherwise(0.0)
    rows = spark.read.parquet(saved).agg(F.count(F.lit(1)).alias("saved_test_rows"))
    return (runs.join(versions, ["model_name", "run_id"]).crossJoin(rows)  # one row of totals
            .select("model_name", "version", "metric", ((F.col("value") > floor) & (F.col("value") <= 1)).alias("above_floor"), "saved_test_rows"))


# One training per session and input serves all scoring queries: a query then
# measures scoring.
_TRAINED: dict[tuple[str, str], tuple] = {}


def _scoring_setup(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        base = scratch_path(spark, "scoring")
        balanced, _, test, feats = prepared(spark, sf_dir)
        path = os.path.join(base, "tables", "df_test")
        sinks.overwrite_path(test, path)
        versions = {}
        for name, trainer, params in (("rfc1_sm", train.train_random_forest, train.RF_SMALL),
                                      ("gbt_sm", train.train_gbt, train.GBT)):
            model = trainer(balanced, feats, TARGET, params)
            versions[name] = registry.register_model(spark, base, name, model)
        _TRAINED[key] = (base, versions, path, feats)
    base, versions, path, feats = _TRAINED[key]
    return base, versions, spark.read.parquet(path), feats


_AGREE_SQL = _PARTS_SQL + "SELECT CustomerId, m.model, true AS agree FROM parts, (VALUES ('rfc1_sm'), ('gbt_sm')) m(model) WHERE part = 'test'"


def _agreement(spark, sf_dir, form):
    """Every test row by both models: whether ``form`` agrees with the model's own transform."""
    base, versions, df_test, feats = _scoring_setup(spark, sf_dir)
    out = None
    for name, version in versions.items():
        own = registry.load_model(spark, base, name, version).transform(df_test).select("CustomerId", "prediction")
        got = form(spark, base, name, version, df_test.select("CustomerId", *feats), feats).select("CustomerId", "predictions")
        rows = got.join(own, "CustomerId").select("CustomerId", F.lit(name).alias("model"), (F.col("prediction") == F.col("predictions")).alias("agree"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("predict_transform", "PRD1,PRD4,SRC5", sql=_AGREE_SQL)
def predict_transform(spark, sf_dir):
    """The transformer form on renamed columns, its predictions saved as a table and read back."""
    def form(spark, base, name, version, df, feats):
        other = [f"in_{i}" for i in range(len(feats))]
        transformer = predict.model_transformer(spark, base, name, version, other)
        path = os.path.join(scratch_path(spark, "predictions"), f"df_test_with_{name}")
        sinks.overwrite_path(transformer(df.select("CustomerId", *[F.col(c).alias(o) for c, o in zip(feats, other)])), path)
        return spark.read.parquet(path)

    return _agreement(spark, sf_dir, form)


@query("predict_sql", "PRD2", sql=_AGREE_SQL)
def predict_sql(spark, sf_dir):
    def form(spark, base, name, version, df, feats):
        # One function serves both models; the reference in the call picks one.
        if name == next(iter(_scoring_setup(spark, sf_dir)[1])):
            predict.register_predict_sql(spark, {f"{n}/{v}": registry.load_model(spark, base, n, v) for n, v in _scoring_setup(spark, sf_dir)[1].items()})
        return predict.predict_sql(spark, df, f"{name}/{version}", feats)

    return _agreement(spark, sf_dir, form)


@query("predict_udf", "PRD3", sql=_AGREE_SQL)
def predict_udf(spark, sf_dir):
    def form(spark, base, name, version, df, feats):
        call = predict.predict_udf(registry.load_model(spark, base, name, version))
        return df.withColumn("predictions", call(*feats))

    return _agreement(spark, sf_dir, form)
