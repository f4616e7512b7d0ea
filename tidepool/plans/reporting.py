"""Report queries over the ``accounts`` stand-in (part table)."""

from __future__ import annotations

from tidepool.operators import report
from tidepool.plans.registry import query
from tidepool.sources import tables

_ACCOUNTS_CTE = f"WITH accounts AS ({tables.ACCOUNTS_SQL})"


@query("report_sum_desc", "AGG8,SRT1", sql=f"""
{_ACCOUNTS_CTE}
SELECT Category, Company_Name, Estimated_Revenue_USD, CAST(SUM(id) AS BIGINT) AS sum_id
FROM accounts
GROUP BY Category, Company_Name, Estimated_Revenue_USD
ORDER BY sum_id DESC, Category, Company_Name, Estimated_Revenue_USD
""")
def report_sum_desc(spark, sf_dir):
    acc = tables.accounts(spark, sf_dir)
    return report.report_table(acc, ["Category", "Company_Name", "Estimated_Revenue_USD"],
                               "id", "sum", descending=True, alias="sum_id")


@query("default_agg_by_metadata", "AGG9", sql=f"""
{_ACCOUNTS_CTE}
SELECT Category, Company_Name, CAST(SUM(id) AS BIGINT) AS sum_id
FROM accounts
GROUP BY Category, Company_Name
""")
def default_agg_by_metadata(spark, sf_dir):
    acc = tables.accounts(spark, sf_dir)
    return report.default_aggregation(acc, ["Category", "Company_Name", "id"])


@query("topn_rows", "SRT2,SRT3,SRC7", sql=f"""
{_ACCOUNTS_CTE}
SELECT * FROM accounts ORDER BY id LIMIT 5
""")
def topn_rows(spark, sf_dir):
    return report.top_n(tables.accounts(spark, sf_dir), 5, ["id"])


@query("report_formatted", "AGG9,FN13", sql=f"""
{_ACCOUNTS_CTE}
SELECT Category, CAST(CAST(SUM(id) AS BIGINT) AS VARCHAR) AS sum_id
FROM accounts
GROUP BY Category
""")
def report_formatted(spark, sf_dir):
    acc = tables.accounts(spark, sf_dir)
    return report.default_aggregation_formatted(acc, ["Category", "id"])
