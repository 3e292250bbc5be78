"""Query of the whole pipeline."""

from __future__ import annotations

import corpus_pipeline

NAME = "pipeline"
SQL = corpus_pipeline.ORACLE_SQL


def query(spark, folder):
    return corpus_pipeline.run(spark, folder)
