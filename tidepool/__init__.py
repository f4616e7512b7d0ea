"""tidepool: lakehouse analytics as Spark DataFrame operators.

Three workloads, each a set of functions that take and return Spark
DataFrames (or streaming queries) and run on the executors:

* log ingestion  -- ``tidepool.streaming.ingest``, ``tidepool.functions.jsonlog``
* churn analytics -- ``tidepool.operators`` (clean, profile, binning, encode,
  split, oversample, evaluate)
* scoring and reporting -- ``tidepool.models`` and ``tidepool.operators.report``
"""

from tidepool.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
