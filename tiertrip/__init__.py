"""tiertrip: bronze -> silver -> gold trip analytics as composable Spark DataFrame functions.

Every operator is ``DataFrame -> DataFrame`` (usable with ``df.transform``) and contains no
actions; only sinks, validation and the job functions in :mod:`tiertrip.plans.medallion` act.
"""

__all__ = ["config", "schemas", "session"]
