"""jobsmith: Spark-native job-posting analytics.

Every public function takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column``); rule tables and the clock are arguments, nothing is collected to
the driver and no Python UDF runs in the hot path.
"""

__version__ = "0.1.0"
