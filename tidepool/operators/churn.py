"""The churn table preparation of the reference as one composed plan:
clean -> ratio -> four equal-frequency scores -> one-hot (``df_clean``).

Every step is a distributed operator from this package; only bin edges and
level lists (bounded scalars) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators import binning, clean, encode
from tidepool.session import stored

KEYS = ["RowNumber", "CustomerId"]
DROP = ["RowNumber", "CustomerId", "Surname"]
TARGET = "Exited"
FEATURES_ADDED = ["NewTenure", "NewCreditsScore", "NewAgeScore", "NewBalanceScore", "NewEstSalaryScore"]
ONE_HOT = ["Geography", "Gender"]


def prepare_churn(df: DataFrame, order_col: str = "RowNumber", keep_key: bool = False) -> DataFrame:
    """``df_clean`` from raw churn rows.

    Rows: drop any-null rows, keep the first row per (RowNumber, CustomerId) in
    ``order_col`` order, drop the identifier columns.  Features: NewTenure =
    Tenure / Age (null when Age is 0), equal-frequency scores (fixed values:
    CreditScore 6 bins, Age 8, the tie-broken rank of Balance 5, EstimatedSalary
    10), indicators of Geography and Gender appended after the other columns.
    ``keep_key`` keeps ``CustomerId`` in front (for a repeatable split, D15).
    """
    rows = clean.keep_first(clean.drop_na(df), KEYS, [order_col])
    # Every edge, rank and level pass below reads these rows: cut them once.
    drop = [c for c in DROP if not (keep_key and c == "CustomerId")]
    out = stored(rows.withColumn("_order", F.col(order_col)).drop(*drop), "churn")
    out = binning.ratio(out, "Tenure", "Age", "NewTenure")
    out = binning.qcut_many(out, {"CreditScore": (6, "NewCreditsScore"), "Age": (8, "NewAgeScore"),
                                  "EstimatedSalary": (10, "NewEstSalaryScore")})
    out = binning.qcut_rank_first(out, "Balance", ["_order"], 5, "NewBalanceScore")
    lead = [c for c in out.columns if c != "_order" and c not in FEATURES_ADDED]
    return encode.one_hot(out.select(*lead, *FEATURES_ADDED), ONE_HOT)
