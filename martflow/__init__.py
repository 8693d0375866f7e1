"""martflow: real-time commerce analytics expressed as Spark DataFrame plans.

Every transform is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` so the same code runs on batch tables and on
Structured Streaming inputs.  Actions happen only in sinks, in the
registry's callers, and in explicit size checks before a broadcast.
"""

from martflow.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
