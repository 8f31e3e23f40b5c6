"""Query pipeline: all stages of the corpus pipeline."""

from __future__ import annotations

import corpus_pipeline

QUERIES = {"pipeline": corpus_pipeline.run}
SQL = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
