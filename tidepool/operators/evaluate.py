"""Classifier evaluation on a scored long table (EVL1-EVL6).

Input: one row per (model, example) with the true class ``y``, the predicted
class ``p`` and a score.  Classes are those found in the data (any number); the
binary forms (cells, AUC) raise on classes other than 0 and 1.  Every metric is an aggregation grouped by
model, so comparing models (EVL6) is the same job as evaluating one.  Ratios
follow the usual zero-division rule: 0 when the denominator is 0.

A null class is a class of its own: a row without a prediction counts as wrong
wherever it is counted, and has its own row and column of the matrix.  A null
model is a model like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.operators.joins import null_safe_join
from tidepool.operators.ranking import prefix_sums


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _right(y: str, p: str) -> Column:
    """Whether the prediction is there and right."""
    return F.coalesce(F.col(y) == F.col(p), F.lit(False))


def accuracy(df: DataFrame, model: str = "model", y: str = "y", p: str = "p") -> DataFrame:
    """EVL1: share of rows with p = y, per model; rows without a class or prediction are wrong."""
    return df.groupBy(model).agg((F.count_if(_right(y, p)) / F.count(F.lit(1))).alias("accuracy"))


def confusion_matrix(df: DataFrame, model: str = "model", y: str = "y", p: str = "p",
                     classes: tuple | None = None) -> DataFrame:
    """EVL3: counts per (model, actual, predicted), zero cells included.

    Classes are those that occur as actual or predicted in any model, null among
    them; a stated list raises on others.  One scan: the grid of models and classes
    comes from the cell counts and is joined back to them.
    """
    counts = df.groupBy(model, F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(F.count(F.lit(1)).alias("count"))
    kind = df.select(F.coalesce(F.col(y), F.col(p)).alias("c")).schema["c"].dataType
    if classes is None:
        each = counts.select(F.explode(F.array(F.struct(F.col("actual").cast(kind).alias("c")), F.struct(F.col("predicted").cast(kind).alias("c")))).alias("v"))
        table = each.select("v.c").distinct()
    else:
        stated = F.array(*[F.lit(c).cast(kind) for c in classes])
        other = ~(F.array_contains(stated, F.col("actual").cast(kind)) & F.array_contains(stated, F.col("predicted").cast(kind)))
        wrong = F.raise_error(F.concat(F.lit("classes beyond the stated ones: "), F.to_json(F.struct("actual", "predicted"))))
        counts = counts.withColumn("count", F.when(F.coalesce(other, F.lit(True)), wrong.cast("bigint")).otherwise(F.col("count")))
        table = df.sparkSession.range(1).select(F.explode(stated).alias("c"))
    # The grid by explosions over one row of the classes (bounded by their number), not by a join without a key.
    names = table.agg(F.collect_list(F.struct("c")).alias("classes"))
    grid = (counts.select(model).distinct().withColumn("_one", F.lit(1)).join(names.withColumn("_one", F.lit(1)), "_one")
            .select(model, "classes", F.explode("classes").alias("a")).select(model, F.col("a.c").alias("actual"), F.explode("classes").alias("b"))
            .select(model, "actual", F.col("b.c").alias("predicted")))
    cells = counts.select(model, F.col("actual").cast(kind).alias("actual"), F.col("predicted").cast(kind).alias("predicted"), "count")
    joined = null_safe_join(grid, cells, [model, "actual", "predicted"], "left")
    return joined.select(model, "actual", "predicted", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def _binary(y: str, p: str) -> Column:
    """True, or an error where a class is neither 0 nor 1 (null is neither)."""
    ok = F.coalesce(F.col(y).isin(0, 1) & F.col(p).isin(0, 1), F.lit(False))
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit("binary metrics need classes 0 and 1")).cast("boolean"))


def confusion_cells(df: DataFrame, model: str = "model", y: str = "y", p: str = "p") -> DataFrame:
    """EVL3 read out as tn, fp, fn, tp per model; other classes than 0 and 1 raise."""
    yy, pp, ok = F.col(y), F.col(p), _binary(y, p)
    return df.groupBy(model).agg(
        F.sum((ok & (yy == 0) & (pp == 0)).cast("bigint")).alias("tn"),
        F.sum((ok & (yy == 0) & (pp == 1)).cast("bigint")).alias("fp"),
        F.sum((ok & (yy == 1) & (pp == 0)).cast("bigint")).alias("fn"),
        F.sum((ok & (yy == 1) & (pp == 1)).cast("bigint")).alias("tp"))


def confusion_normalised(df: DataFrame, model: str = "model", y: str = "y", p: str = "p") -> DataFrame:
    """EVL5: confusion counts divided by their row (actual class) total."""
    cm = confusion_matrix(df, model, y, p)
    row_total = F.sum("count").over(Window.partitionBy(model, "actual"))
    return cm.withColumn("share", _ratio(F.col("count"), row_total))


def classification_report(df: DataFrame, model: str = "model", y: str = "y", p: str = "p") -> DataFrame:
    """EVL2: precision, recall, F1, support per class (any number of classes),
    the accuracy line, then macro and weighted averages."""
    cm = confusion_matrix(df, model, y, p)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0)  # never where one is null
    each = cm.select(model, F.explode(F.array(
        F.struct(F.col("actual").alias("label"), F.col("count").alias("support"), F.lit(0).cast("bigint").alias("called"), hit.alias("right")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("count").alias("called"),
                 F.lit(0).cast("bigint").alias("right")))).alias("c")).select(model, "c.*")
    sums = each.groupBy(model, "label").agg(*[F.sum(c).alias(c) for c in ("support", "called", "right")])
    rows = (sums.withColumn("precision", _ratio(F.col("right"), F.col("called")))
            .withColumn("recall", _ratio(F.col("right"), F.col("support")))
            .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
            .withColumn("label", F.coalesce(F.col("label").cast("string"), F.lit("null"))))
    weight = F.sum("support")
    summary = rows.groupBy(model).agg(
        (F.sum("precision") / F.count("label")).alias("mp"), (F.sum("recall") / F.count("label")).alias("mr"),
        (F.sum("f1") / F.count("label")).alias("mf"),
        *[_ratio(F.sum(F.col(c) * F.col("support")), weight).alias(f"w_{c}") for c in ("precision", "recall", "f1")],
        _ratio(F.sum("right"), weight).alias("acc"), weight.alias("support"))
    none = F.lit(None).cast("double")

    def line(label: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), precision.alias("precision"), recall.alias("recall"),
                        F.col("support"), f1.alias("f1"))

    # The accuracy line: f1 column holds the accuracy, support all rows.
    lines = summary.select(model, F.explode(F.array(
        line("accuracy", none, none, F.col("acc")), line("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        line("weighted avg", F.col("w_precision"), F.col("w_recall"), F.col("w_f1")))).alias("l")).select(model, "l.*")
    return rows.select(model, "label", "precision", "recall", "support", "f1").unionByName(lines)


def roc_auc(df: DataFrame, model: str = "model", y: str = "y", score: str = "score") -> DataFrame:
    """EVL4: area under the ROC curve, ties counted half (Mann-Whitney).

    AUC = sum over distinct scores s of pos(s) * (neg(< s) + neg(s) / 2), over P * N.
    Rows are first reduced to one per (model, score); the running count of
    negatives is a range-partitioned prefix sum, so no task sees all scores.
    A model whose rows are all of one class has no AUC: null.  Rows without a
    class or a score have no place in the order and are left out.
    """
    placed = df.where(F.col(y).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    per_score = placed.groupBy(model, score).agg(
        F.sum(F.col(y).cast("bigint")).alias("pos"),
        F.sum((1 - F.col(y)).cast("bigint")).alias("neg"))
    cum = prefix_sums(per_score, [score], ["neg"], [model])
    part = F.col("pos") * ((F.col("neg_cum") - F.col("neg")) + F.col("neg") * 0.5)
    return cum.groupBy(model).agg(
        F.try_divide(F.sum(part.cast("double")), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("roc_auc"))


def compare_models(df: DataFrame, model: str = "model", y: str = "y", p: str = "p",
                   score: str = "score") -> DataFrame:
    """EVL6: accuracy, ROC AUC and positive-class precision/recall/F1 per model."""
    rep = classification_report(df, model, y, p).where(F.col("label") == "1").select(
        model, "precision", "recall", "f1")
    return null_safe_join(null_safe_join(accuracy(df, model, y, p), roc_auc(df, model, y, score), [model]), rep, [model])
