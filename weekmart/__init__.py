"""weekmart: weekly sales reporting on Spark.

Star-schema weekly summaries, ISO-week period algebra, column naming and
value cleaning, and idempotent per-period loads into tables, files, JDBC
stores and delivery endpoints -- all expressed as DataFrame / SQL /
Structured Streaming jobs.
"""

import sys

from pyspark import cloudpickle

from weekmart.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]

# Functions that run in Python workers travel with the job, so the package need
# not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
