"""tabspark: Spark-native feature engineering, model fitting and evaluation.

Every operator takes and returns a DataFrame, aligns rows by an explicit
key column (never by position), and stays inside built-in Spark
expressions so Catalyst can prune, push down and code-generate it.
"""

__version__ = "0.1.0"
