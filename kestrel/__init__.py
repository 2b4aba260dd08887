"""kestrel: DataFrame-first feature, graph and model analytics on Spark.

Every public operator takes and returns ``pyspark.sql.DataFrame`` objects and
is written with built-in Spark SQL functions, Spark ML and the optimizer;
nothing is pulled to the driver except bounded metadata (fitted labels,
per-class counts, metric rows).
"""

__version__ = "0.1.0"
