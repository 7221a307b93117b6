"""txguard — Spark-native card-payment fraud analytics.

Every operator is a function from DataFrames to DataFrames; nothing is
collected to the driver except one-row gate / report results.
"""

from txguard.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
__version__ = "0.1.0"
