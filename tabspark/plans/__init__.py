"""Named queries: Spark plans and their SQL oracles."""
