"""Batch scoring in three API forms (PRD1-PRD4).

* ``predict_transform`` -- the fitted ``PipelineModel.transform``;
* ``register_predict_sql`` -- a SQL function ``PREDICT('name/version', f1, ...)``
  usable in ``spark.sql`` and ``SQLTransformer``;
* ``predict_udf`` -- a function on columns, ``model(*feature_columns)``.

The SQL and column forms are the model written as one expression
(``expression``): all three run in the JVM, without Python workers, and give the
same predictions (tested row by row).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.models.expression import Ensemble, class_of, ensemble


def predict_transform(model: PipelineModel, df: DataFrame, input_cols: list[str],
                      output_col: str = "predictions") -> DataFrame:
    """PRD1: inputs plus ``output_col`` from the fitted model.

    ``input_cols`` are the model's features in its own order, whatever their
    names in ``df``.
    """
    wanted = model.stages[0].getInputCols()
    if len(input_cols) != len(wanted):
        raise ValueError(f"the model has {len(wanted)} features, {len(input_cols)} columns are given")
    row = df.select(F.struct("*").alias("_row"), *[F.col(c).alias(w) for c, w in zip(input_cols, wanted)])
    return model.transform(row).select("_row.*", F.col("prediction").alias(output_col))


def model_transformer(spark: SparkSession, base: str, name: str, version: int, input_cols: list[str],
                      output_col: str = "predictions"):
    """PRD1 as one object: a function from a table to the table with predictions of a registered model."""
    from tidepool.models.registry import load_model

    model = load_model(spark, base, name, version)
    return lambda df: predict_transform(model, df, input_cols, output_col)


def predict_udf(model: PipelineModel):
    """PRD3: ``model(*feature_columns) -> predictions``, feature columns by name, in the model's order."""
    found = ensemble(model)

    def call(*columns: str) -> Column:
        return class_of(found, list(columns))

    return call


def register_predict_sql(spark: SparkSession, models: dict[str, PipelineModel], name: str = "PREDICT") -> None:
    """PRD2: SQL function ``PREDICT('model/version', f1, f2, ...)`` of this session.

    ``models`` maps 'name/version' to loaded models of one number of features; the
    first argument picks one of them (a constant: the others are folded away), and
    an unknown one is an error.  Registering again replaces the function.
    """
    found: dict[str, Ensemble] = {ref: ensemble(m) for ref, m in models.items()}
    counts = {e.features for e in found.values()}
    if len(counts) != 1:
        raise ValueError("models of one call must have one number of features")
    parameters = [f"f{i}" for i in range(counts.pop())]
    cases = " ".join(f"WHEN {_literal(ref)} THEN {e.sql(parameters)}" for ref, e in found.items())
    body = f"CASE model {cases} ELSE raise_error(concat('model ', model, ' is not loaded for PREDICT')) END"
    declared = ", ".join(["model STRING", *[f"{p} DOUBLE" for p in parameters]])
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({declared}) RETURNS DOUBLE RETURN {body}")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def predict_sql(spark: SparkSession, df: DataFrame, model_ref: str, feature_cols: list[str],
                output_col: str = "predictions", keep_inputs: bool = True) -> DataFrame:
    """PRD2 through ``SQLTransformer`` exactly as written in SQL.

    ``keep_inputs=False`` is the reference's statement, which returns only the
    prediction column.
    """
    from pyspark.ml.feature import SQLTransformer

    lead = "*, " if keep_inputs else ""
    stmt = f"SELECT {lead}PREDICT('{model_ref}', {', '.join(feature_cols)}) AS {output_col} FROM __THIS__"
    return SQLTransformer(statement=stmt).transform(df)
