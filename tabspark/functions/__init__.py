"""Column -> Column expressions (native Spark functions only)."""

from tabspark.functions.columns import *  # noqa: F401,F403
