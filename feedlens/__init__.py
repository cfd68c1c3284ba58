"""feedlens: feedback-insight analytics as Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame``; nothing
is collected to the driver except bounded dimensions (theme catalogue,
k x d centres, rating ladders) and one-row reports.
"""

__version__ = "0.1.0"
