"""paneldeck: longitudinal (subject x time) panel analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
aggregates, windows and joins.  Only small, size-bounded results (moment
matrices, per-distinct-group-size tables, coefficient rows) reach the driver.
"""

from paneldeck.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
