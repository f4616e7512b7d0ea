"""The reference's churn table (``df_clean``) end to end on churn-shaped
customers derived from customer and orders."""

from __future__ import annotations

from tidepool.operators import binning, churn
from tidepool.plans.registry import query
from tidepool.sources import derived

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _edges(col: str, n: int, name: str) -> str:
    plist = ", ".join(repr(p) for p in binning.qcut_probs(n))
    return f"quantile_cont({col}, [{plist}]) AS {name}"


def _label(col: str, edges: str, n: int) -> str:
    return "1 + " + " + ".join(f"CAST({col} > {edges}[{i + 1}] AS INTEGER)" for i in range(1, n))


_BAL = " + ".join(f"CAST(brank > 1 + (cnt - 1) * {p!r} AS INTEGER)" for p in binning.qcut_probs(5)[1:-1])

DF_CLEAN_SQL = f"""
WITH raw AS ({derived.CHURN_SQL}),
nn AS (SELECT * FROM raw WHERE RowNumber IS NOT NULL AND CustomerId IS NOT NULL AND Surname IS NOT NULL
       AND CreditScore IS NOT NULL AND Geography IS NOT NULL AND Gender IS NOT NULL AND Age IS NOT NULL
       AND Tenure IS NOT NULL AND Balance IS NOT NULL AND NumOfProducts IS NOT NULL AND HasCrCard IS NOT NULL
       AND IsActiveMember IS NOT NULL AND EstimatedSalary IS NOT NULL AND Exited IS NOT NULL),
dd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY RowNumber, CustomerId ORDER BY RowNumber) AS rn
                      FROM nn) WHERE rn = 1),
f AS (SELECT *, CASE WHEN Age = 0 THEN NULL ELSE Tenure / Age END AS NewTenure,
             row_number() OVER (ORDER BY Balance, RowNumber) AS brank, count(*) OVER () AS cnt FROM dd),
e AS (SELECT {_edges('CreditScore', 6, 'qc')}, {_edges('Age', 8, 'qa')}, {_edges('EstimatedSalary', 10, 'qs')}
      FROM f)
SELECT CreditScore, Age, Tenure, Balance, NumOfProducts, HasCrCard, IsActiveMember, EstimatedSalary, Exited,
       NewTenure,
       {_label('CreditScore', 'qc', 6)} AS NewCreditsScore,
       {_label('Age', 'qa', 8)} AS NewAgeScore,
       1 + {_BAL} AS NewBalanceScore,
       {_label('EstimatedSalary', 'qs', 10)} AS NewEstSalaryScore,
       {", ".join(f"coalesce(Geography = '{g}', false) AS Geography_{g}" for g in _SEGMENTS)},
       coalesce(Gender = 'Female', false) AS Gender_Female, coalesce(Gender = 'Male', false) AS Gender_Male
FROM f, e
"""


@query("churn_df_clean", "FLT1,DDP1,PRJ2,PRJ4,BIN1,BIN2,BIN3,ENC2,D10,D13,D17", sql=DF_CLEAN_SQL)
def churn_df_clean(spark, sf_dir):
    return churn.prepare_churn(derived.churn_customers(spark, sf_dir))
