"""aurum — medallion analytics (landing → bronze → silver → gold) on Spark.

Every operator is a DataFrame → DataFrame function built from Spark SQL
built-ins; no Python UDF is registered anywhere in the library.
"""

from aurum.config import Settings, get_spark, checkpoint_dir

__all__ = ["Settings", "get_spark", "checkpoint_dir"]
__version__ = "0.1.0"
