"""A training corpus from raw documents: each stage reads what the stage before it wrote.

Null, empty and letterless texts go in the first stage. Of rows that are linked one
stays (least id, then least text; null ids count as rows of their own). With an
empty benchmark nothing is contaminated; empty documents give no rows. Columns
beyond those of documents travel along and are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from addrlink.llm import stages
from addrlink.llm.common import materialize, table

STAGES = stages.STAGES

#: Not expressible in SQL (learned language models, byte-pair ids); tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
