"""tabspark — distributed preparation, profiling, splitting, scaling, training,
evaluation and scoring of wide numeric tables on Apache Spark.

Every operator is a DataFrame transformation (or a fit/transform pair) that
runs on the executors; the driver only sees small, bounded summaries
(per-feature statistics, per-class counts, model parameters).
"""

from tabspark.schema import FEATURES, DEFECT_SCHEMA, TARGET  # noqa: F401
from tabspark.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["FEATURES", "DEFECT_SCHEMA", "TARGET", "get_session", "checkpoint_dir"]
