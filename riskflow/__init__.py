"""Find unusual customer behaviour in transaction, payment, login and activity data with Spark.

Every public function takes and returns DataFrames or Columns, so a whole refresh is one declarative
chain that Catalyst can optimise:

    messages -> raw text -> ods (typed) -> dds (star schema) -> dm (marts) -> published marts -> detectors
"""

from riskflow.plans.anomaly import daily_profile, iqr_global, zscore_by_day, zscore_global

__all__ = ["daily_profile", "iqr_global", "zscore_by_day", "zscore_global"]
__version__ = "0.1.0"
