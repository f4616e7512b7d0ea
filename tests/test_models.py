"""Training, registry and the three scoring forms."""

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidepool.models import predict, registry, train
from tidepool.operators import evaluate


def _separable(spark, n=1500):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        a, b, c = (float(x) for x in rng.normal(size=3))
        rows.append((i, a, b, c, int(a + 0.5 * b > 0)))
    return spark.createDataFrame(rows, "k long, a double, b double, c double, y int")


FEATS = ["a", "b", "c"]


def test_three_scoring_forms_agree_and_auc_floor(spark, tmp_dir):
    df = _separable(spark)
    for trainer, params in ((train.train_random_forest, {"numTrees": 20}),
                            (train.train_gbt, {"maxIter": 10, "maxDepth": 4})):
        fitted = trainer(df, FEATS, "y", params)
        v = registry.register_model(spark, tmp_dir, "m", fitted)
        model = registry.load_model(spark, tmp_dir, "m", v)
        t = predict.predict_transform(model, df, FEATS).select("k", F.col("predictions").alias("p1"))
        u = df.withColumn("p3", predict.predict_udf(model)(*FEATS)).select("k", "p3")
        predict.register_predict_sql(spark, {f"m/{v}": model})
        s = predict.predict_sql(spark, df, f"m/{v}", FEATS).select("k", F.col("predictions").alias("p2"))
        j = t.join(u, "k").join(s, "k")
        assert j.where("p1 != p2 OR p1 != p3").count() == 0
        only = predict.predict_sql(spark, df, f"m/{v}", FEATS, keep_inputs=False)
        assert only.columns == ["predictions"] and only.count() == df.count()
        assert j.count() == df.count()
        # save/load gives equal predictions
        f2 = fitted.transform(df).select("k", F.col("prediction").alias("p0"))
        assert f2.join(t, "k").where("p0 != p1").count() == 0
        scored = model.transform(df).select(F.lit("m").alias("model"), F.col("y"),
                                            vector_to_array("probability")[1].alias("score"))
        assert evaluate.roc_auc(scored).first()["roc_auc"] > 0.9


def test_run_log_rows(spark, tmp_dir):
    m = spark.createDataFrame([(0.8, 0.9)], "accuracy double, roc_auc double")
    registry.log_run(spark, tmp_dir, "exp", "r1", "rf", {"maxDepth": 4}, m)
    rows = spark.read.parquet(f"{tmp_dir}/run_log").collect()
    assert sorted((r["metric"], r["value"]) for r in rows) == [("accuracy", 0.8), ("roc_auc", 0.9)]
    assert rows[0]["params"] == {"maxDepth": "4"}


def test_scoring_after_observe_in_same_session(spark, tmp_dir):
    """A session that has used observe() must still score freshly fitted models."""
    from tidepool.sinks import tables as sinks

    df = _separable(spark, 300)
    sinks.overwrite_path(df, f"{tmp_dir}/obs")  # uses observe()
    model = train.train_random_forest(df, FEATS, "y", {"numTrees": 5})
    out = model.transform(df).select(vector_to_array("probability")[1].alias("p"))
    assert out.checkpoint(eager=True).count() == 300


def test_model_does_not_depend_on_partitions(spark):
    df = _separable(spark, 600)
    got = []
    for n in (4, 16):
        model = train.train_random_forest(df.repartition(n, F.rand(n)), FEATS, "y", {"numTrees": 10})
        got.append({r.k: r.p for r in model.transform(df).select("k", vector_to_array("probability")[1].alias("p")).collect()})
    assert got[0] == got[1]


def test_versions_runs_and_renamed_columns(spark, tmp_dir):
    import pytest

    df = _separable(spark, 200)
    one, two = (train.train_random_forest(df, FEATS, "y", {"numTrees": 3, "seed": s}) for s in (1, 2))
    assert [registry.register_model(spark, tmp_dir, "m", m, r) for m, r in ((one, "r1"), (two, "r2"))] == [1, 2]
    with pytest.raises(Exception):  # a run's model is never overwritten
        registry.register_model(spark, tmp_dir, "m", two, "r1")
    by_run, by_version = registry.load_model_of_run(spark, tmp_dir, "r2"), registry.load_model(spark, tmp_dir, "m", 2)
    with pytest.raises(KeyError):
        registry.load_model_of_run(spark, tmp_dir, "r9")
    renamed = df.select("k", F.col("a").alias("x"), F.col("b").alias("y_"), F.col("c").alias("prediction"))
    want = {r.k: r.prediction for r in by_run.transform(df).collect()}
    out = predict.predict_transform(by_version, renamed, ["x", "y_", "prediction"], "p")
    assert out.columns == [*renamed.columns, "p"] and {r.k: r.p for r in out.collect()} == want
    with pytest.raises(ValueError):
        predict.predict_transform(by_version, renamed, ["x"])
    assert predict.model_transformer(spark, tmp_dir, "m", 2, FEATS)(df).count() == 200


def test_shallow_forests_are_fitted_on_more_partitions():
    """900,000 rows of a shallow forest are work for 18 tasks, not 4; small tables and deep trees are laid out as before."""
    assert train.fit_partitions(900_000, shallow=True) == 18 and train.fit_partitions(900_000) == 4
    assert train.fit_partitions(1_000, shallow=True) == train.fit_partitions(1_000) == 4
