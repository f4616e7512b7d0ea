"""Evaluation queries on rule-scored documents (EVL1-EVL6).

Labelled documents (labels joined to documents) are scored by three fixed
rules, giving the long table (model, doc_id, y, score, p) every metric reads.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import evaluate
from tidepool.operators.joins import null_safe_join
from tidepool.plans.registry import query
from tidepool.sources import tables

# The three scoring rules and the decision threshold.
_RULES_SQL = """
WITH d AS (
  SELECT l.doc_id, l.toxic AS y, d.n_chars, d.lang
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
s AS (
  SELECT 'len_rule' AS model, doc_id, y, n_chars / (n_chars + 1000.0) AS score FROM d
  UNION ALL SELECT 'short_rule', doc_id, y, 1000.0 / (n_chars + 1000.0) FROM d
  UNION ALL SELECT 'lang_rule', doc_id, y, CASE WHEN lang = 'en' THEN 0.7 ELSE 0.3 END FROM d),
scored AS (SELECT model, doc_id, y, CAST(score AS DOUBLE) AS score,
                  CAST(score >= 0.5 AS INTEGER) AS p FROM s)
"""


def scored(spark, sf_dir):
    labels = tables.load(spark, sf_dir, "labels", ["doc_id", "toxic"])
    docs = tables.load(spark, sf_dir, "documents", ["doc_id", "n_chars", "lang"])
    d = docs.join(labels, "doc_id").select(
        "doc_id", F.col("toxic").alias("y"), "n_chars", "lang")
    n = F.col("n_chars").cast("double")
    rules = F.array(
        F.struct(F.lit("len_rule").alias("model"), (n / (n + 1000.0)).alias("score")),
        F.struct(F.lit("short_rule").alias("model"), (F.lit(1000.0) / (n + 1000.0)).alias("score")),
        F.struct(F.lit("lang_rule").alias("model"),
                 F.when(F.col("lang") == "en", F.lit(0.7)).otherwise(F.lit(0.3)).alias("score")),
    )
    long = d.select("doc_id", "y", F.explode(rules).alias("r")).select("r.model", "doc_id", "y", "r.score")
    return long.withColumn("p", (F.col("score") >= 0.5).cast("int"))


@query("accuracy", "EVL1", sql=_RULES_SQL + """
SELECT model, sum(CASE WHEN y = p THEN 1 ELSE 0 END) / count(*) AS accuracy FROM scored GROUP BY model
""")
def accuracy(spark, sf_dir):
    return evaluate.accuracy(scored(spark, sf_dir))


@query("confusion_matrix", "EVL3", sql=_RULES_SQL + """
, grid AS (SELECT m.model, a.c AS actual, b.c AS predicted
           FROM (SELECT DISTINCT model FROM scored) m, (VALUES (0), (1)) a(c), (VALUES (0), (1)) b(c)),
cnt AS (SELECT model, y AS actual, p AS predicted, count(*) AS count FROM scored GROUP BY ALL)
SELECT g.model, g.actual, g.predicted, coalesce(c.count, 0) AS count
FROM grid g LEFT JOIN cnt c USING (model, actual, predicted)
""")
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(scored(spark, sf_dir))


_CELLS_SQL = """
, cells AS (SELECT model,
       CAST(sum(CASE WHEN y = 0 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
       CAST(sum(CASE WHEN y = 0 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
       CAST(sum(CASE WHEN y = 1 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
       CAST(sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp
  FROM scored GROUP BY model)
"""


@query("confusion_cells", "EVL3", sql=_RULES_SQL + _CELLS_SQL + "SELECT * FROM cells")
def confusion_cells(spark, sf_dir):
    return evaluate.confusion_cells(scored(spark, sf_dir))


def _div(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


_REPORT_SQL = _RULES_SQL + _CELLS_SQL + f"""
, pc AS (
  SELECT model, '0' AS label, {_div('tn', 'tn + fn')} AS precision, {_div('tn', 'tn + fp')} AS recall,
         tn + fp AS support FROM cells
  UNION ALL
  SELECT model, '1', {_div('tp', 'tp + fp')}, {_div('tp', 'tp + fn')}, tp + fn FROM cells),
pcf AS (SELECT *, {_div('2 * precision * recall', 'precision + recall')} AS f1 FROM pc),
report AS (
  SELECT model, label, precision, recall, support, f1 FROM pcf
  UNION ALL
  SELECT model, 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), tn + fp + fn + tp,
         {_div('tn + tp', 'tn + fp + fn + tp')} FROM cells
  UNION ALL
  SELECT model, 'macro avg', sum(precision) / 2, sum(recall) / 2, CAST(sum(support) AS BIGINT), sum(f1) / 2
  FROM pcf GROUP BY model
  UNION ALL
  SELECT model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         CAST(sum(support) AS BIGINT), sum(f1 * support) / sum(support)
  FROM pcf GROUP BY model)
"""


@query("classification_report", "EVL2", sql=_REPORT_SQL + "SELECT * FROM report")
def classification_report(spark, sf_dir):
    return evaluate.classification_report(scored(spark, sf_dir))


_AUC_SQL = """
, ps AS (SELECT model, score, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg
         FROM scored GROUP BY model, score),
pscum AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum FROM ps),
auc AS (SELECT model, sum(pos * ((neg_cum - neg) + neg * 0.5)) / (sum(pos) * sum(neg)) AS roc_auc
        FROM pscum GROUP BY model)
"""


@query("roc_auc", "EVL4,D16", sql=_RULES_SQL + _AUC_SQL + "SELECT model, CAST(roc_auc AS DOUBLE) AS roc_auc FROM auc")
def roc_auc(spark, sf_dir):
    return evaluate.roc_auc(scored(spark, sf_dir))


@query("confusion_normalised", "EVL5", sql=_RULES_SQL + """
, cnt AS (SELECT model, y AS actual, p AS predicted, count(*) AS count FROM scored GROUP BY ALL),
grid AS (SELECT m.model, a.c AS actual, b.c AS predicted
         FROM (SELECT DISTINCT model FROM scored) m, (VALUES (0), (1)) a(c), (VALUES (0), (1)) b(c)),
cm AS (SELECT g.model, g.actual, g.predicted, coalesce(c.count, 0) AS count
       FROM grid g LEFT JOIN cnt c USING (model, actual, predicted))
SELECT model, actual, predicted, count,
       CASE WHEN sum(count) OVER (PARTITION BY model, actual) = 0 THEN 0.0
            ELSE CAST(count AS DOUBLE) / CAST(sum(count) OVER (PARTITION BY model, actual) AS DOUBLE) END AS share
FROM cm
""")
def confusion_normalised(spark, sf_dir):
    return evaluate.confusion_normalised(scored(spark, sf_dir))


@query("model_compare", "EVL6", sql=_REPORT_SQL + _AUC_SQL + """
, acc AS (SELECT model, sum(CASE WHEN y = p THEN 1 ELSE 0 END) / count(*) AS accuracy FROM scored GROUP BY model)
SELECT acc.model, accuracy, CAST(roc_auc AS DOUBLE) AS roc_auc, r.precision, r.recall, r.f1
FROM acc JOIN auc USING (model) JOIN report r ON r.model = acc.model AND r.label = '1'
""")
def model_compare(spark, sf_dir):
    return evaluate.compare_models(scored(spark, sf_dir))


# Three classes: an order's status as actual class, a rule on its number as the
# predicted one; the model is the priority.  "P" is never predicted for urgent orders.
_ORDERS_SQL = """
WITH scored AS (SELECT substr(o_orderpriority, 1, 1) AS model, o_orderstatus AS y,
                       CASE WHEN o_orderkey % 3 = 0 THEN 'F' WHEN o_orderkey % 3 = 1 OR o_orderpriority = '1-URGENT' THEN 'O' ELSE 'P' END AS p
                FROM orders),
classes AS (SELECT y AS c FROM scored UNION SELECT p FROM scored),
cnt AS (SELECT model, y AS actual, p AS predicted, count(*) AS count FROM scored GROUP BY ALL),
cm AS (SELECT m.model, a.c AS actual, b.c AS predicted, coalesce(cnt.count, 0) AS count
       FROM (SELECT DISTINCT model FROM scored) m CROSS JOIN classes a CROSS JOIN classes b
       LEFT JOIN cnt ON cnt.model = m.model AND cnt.actual = a.c AND cnt.predicted = b.c)
"""


def _orders(spark, sf_dir):
    o = tables.load(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    third = F.pmod("o_orderkey", F.lit(3))
    p = F.when(third == 0, "F").when((third == 1) | (F.col("o_orderpriority") == "1-URGENT"), "O").otherwise("P")
    return o.select(F.substring("o_orderpriority", 1, 1).alias("model"), F.col("o_orderstatus").alias("y"), p.alias("p"))


@query("confusion_three_classes", "EVL3,EVL5", sql=_ORDERS_SQL + """
SELECT model, actual, predicted, count,
       CASE WHEN sum(count) OVER w = 0 THEN 0.0 ELSE CAST(count AS DOUBLE) / CAST(sum(count) OVER w AS DOUBLE) END AS share
FROM cm WINDOW w AS (PARTITION BY model, actual)
""")
def confusion_three_classes(spark, sf_dir):
    return evaluate.confusion_normalised(_orders(spark, sf_dir))


@query("report_three_classes", "EVL2", sql=_ORDERS_SQL + f"""
, pc AS (SELECT c.c AS label, m.model, sum(CASE WHEN actual = c AND predicted = c THEN count ELSE 0 END) AS tp,
                sum(CASE WHEN predicted = c THEN count ELSE 0 END) AS called, sum(CASE WHEN actual = c THEN count ELSE 0 END) AS support
         FROM cm m CROSS JOIN classes c GROUP BY ALL),
r AS (SELECT model, label, {_div('tp', 'called')} AS precision, {_div('tp', 'support')} AS recall, support, tp FROM pc),
f AS (SELECT *, {_div('2 * precision * recall', 'precision + recall')} AS f1 FROM r),
report AS (
  SELECT model, label, precision, recall, support, f1 FROM f
  UNION ALL SELECT model, 'accuracy', NULL, NULL, sum(support), sum(tp) / sum(support) FROM f GROUP BY model
  UNION ALL SELECT model, 'macro avg', avg(precision), avg(recall), sum(support), avg(f1) FROM f GROUP BY model
  UNION ALL SELECT model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(support), sum(f1 * support) / sum(support) FROM f GROUP BY model)
SELECT model, label, round(precision, 9) AS precision, round(recall, 9) AS recall, CAST(support AS BIGINT) AS support, round(f1, 9) AS f1 FROM report
""")
def report_three_classes(spark, sf_dir):
    rep = evaluate.classification_report(_orders(spark, sf_dir))
    return rep.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query("roc_auc_one_class", "EVL4", sql="""
WITH s AS (SELECT l_returnflag AS model, CAST(l_returnflag = 'R' OR (l_returnflag = 'A' AND l_linenumber > 2) AS INTEGER) AS y, l_quantity AS score FROM lineitem),
ps AS (SELECT model, score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY ALL),
c AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum FROM ps)
SELECT model, CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN NULL
                   ELSE round(CAST(sum(pos * (cum - neg + neg * 0.5)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 9) END AS roc_auc
FROM c GROUP BY model
""")
def roc_auc_one_class(spark, sf_dir):
    """Return flag R is all positive, N all negative: no AUC; A has both."""
    li = tables.load(spark, sf_dir, "lineitem", ["l_returnflag", "l_linenumber", "l_quantity"])
    flag = F.col("l_returnflag")
    y = (flag == "R") | ((flag == "A") & (F.col("l_linenumber") > 2))
    auc = evaluate.roc_auc(li.select(flag.alias("model"), y.cast("int").alias("y"), F.col("l_quantity").alias("score")))
    return auc.withColumn("roc_auc", F.round("roc_auc", 9))


# Rows without a class, without a prediction, and of a model without a name.
_GAPS_SQL = _RULES_SQL + """
, gaps AS (SELECT CASE WHEN model <> 'lang_rule' THEN model END AS model, CASE WHEN doc_id % 11 <> 0 THEN y END AS y, CASE WHEN doc_id % 7 <> 0 THEN p END AS p,
                  CASE WHEN doc_id % 7 <> 0 THEN score END AS score FROM scored)
"""


def scored_with_gaps(spark, sf_dir):
    named = F.when(F.col("model") != "lang_rule", F.col("model"))
    has_class, has_score = F.pmod("doc_id", F.lit(11)) != 0, F.pmod("doc_id", F.lit(7)) != 0
    return scored(spark, sf_dir).select(named.alias("model"), F.when(has_class, F.col("y")).alias("y"), F.when(has_score, F.col("p")).alias("p"),
                                        F.when(has_score, F.col("score")).alias("score"))


@query("confusion_matrix_null_classes", "EVL3,EVL5", sql=_GAPS_SQL + """
, c(c) AS (VALUES (0), (1), (NULL)),
grid AS (SELECT m.model, a.c AS actual, b.c AS predicted FROM (SELECT DISTINCT model FROM gaps) m, c a, c b),
cnt AS (SELECT model, y AS actual, p AS predicted, count(*) AS count FROM gaps GROUP BY ALL),
cm AS (SELECT g.model, g.actual, g.predicted, coalesce(n.count, 0) AS count FROM grid g LEFT JOIN cnt n
       ON g.model IS NOT DISTINCT FROM n.model AND g.actual IS NOT DISTINCT FROM n.actual AND g.predicted IS NOT DISTINCT FROM n.predicted),
t AS (SELECT *, sum(count) OVER (PARTITION BY model, actual) AS row_total FROM cm)
SELECT model, actual, predicted, count, CASE WHEN row_total = 0 THEN 0.0 ELSE count / row_total END AS share FROM t
""")
def confusion_matrix_null_classes(spark, sf_dir):
    """Unscored and unlabelled rows have a row and a column of their own; nothing leaves the matrix."""
    return evaluate.confusion_normalised(scored_with_gaps(spark, sf_dir))


@query("classification_report_null_classes", "EVL1,EVL2", sql=_GAPS_SQL + """
, k AS (SELECT m.model, c.c FROM (SELECT DISTINCT model FROM gaps) m, (VALUES (0), (1), (NULL)) c(c)),
n AS (SELECT k.model, k.c, count(*) FILTER (g.y IS NOT DISTINCT FROM k.c) AS support, count(*) FILTER (g.p IS NOT DISTINCT FROM k.c) AS called,
             count(*) FILTER (g.y = k.c AND g.p = k.c) AS hit
      FROM k JOIN gaps g ON g.model IS NOT DISTINCT FROM k.model GROUP BY k.model, k.c),
a AS (SELECT model, sum(hit) / sum(support) AS accuracy FROM n GROUP BY model)
SELECT n.model, coalesce(CAST(c AS VARCHAR), 'null') AS label, support, CASE WHEN called = 0 THEN 0.0 ELSE hit / called END AS precision,
       CASE WHEN support = 0 THEN 0.0 ELSE hit / support END AS recall, a.accuracy
FROM n JOIN a ON n.model IS NOT DISTINCT FROM a.model
""")
def classification_report_null_classes(spark, sf_dir):
    """An unscored row lowers the accuracy, of the report's line as of ``accuracy``, and the recall of its class."""
    report = evaluate.classification_report(scored_with_gaps(spark, sf_dir))
    overall = report.where("label = 'accuracy'").select("model", F.col("f1").alias("accuracy"))
    return null_safe_join(report.where("label IN ('0', '1', 'null')").select("model", "label", "support", "precision", "recall"), overall, ["model"])


@query("model_compare_null_model", "EVL4,EVL6", sql=_GAPS_SQL + """
, placed AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r FROM gaps
             WHERE y IS NOT NULL AND score IS NOT NULL WINDOW w AS (PARTITION BY model ORDER BY score)),
auc AS (SELECT model, (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) AS auc FROM placed GROUP BY model),
m AS (SELECT model, count(*) FILTER (y = p) / count(*) AS accuracy, count(*) FILTER (y = 1 AND p = 1) AS tp,
             count(*) FILTER (p = 1) AS called, count(*) FILTER (y = 1) AS pos FROM gaps GROUP BY model)
SELECT m.model, accuracy, round(auc, 9) AS roc_auc, CASE WHEN called = 0 THEN 0.0 ELSE tp / called END AS precision, CASE WHEN pos = 0 THEN 0.0 ELSE tp / pos END AS recall
FROM m JOIN auc ON m.model IS NOT DISTINCT FROM auc.model
""")
def model_compare_null_model(spark, sf_dir):
    """A model without a name is compared like the others."""
    out = evaluate.compare_models(scored_with_gaps(spark, sf_dir))
    return out.select("model", "accuracy", F.round("roc_auc", 9).alias("roc_auc"), "precision", "recall")
