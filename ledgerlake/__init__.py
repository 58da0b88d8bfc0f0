"""ledgerlake: a layered banking lakehouse expressed as Spark DataFrame, SQL and
Structured Streaming jobs.

Layers: raw -> bronze -> silver -> gold marts -> dashboard queries.  Every public
function takes and returns DataFrames; nothing here creates a SparkSession except
``ledgerlake.session.build_session`` (used by tests and the benchmark).
"""

__version__ = "0.1.0"
