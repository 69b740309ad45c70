"""The corpus pipeline: documents in, token ids of the documents worth keeping out.

Each stage works on all that the one before kept, and is written as Parquet and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glossometer.llm import op4_lines, op6_sentencepiece, op7_simhash, op8_decontaminate, op9_toxicity
from glossometer.llm.common import table, written

#: (name, function of (spark, docs, sf_dir)). All but the last return the columns of documents.
STAGES = [
    ("toxicity", op9_toxicity.stage),
    ("line_dedup", op4_lines.stage),
    ("near_dedup", op7_simhash.stage),
    ("decontamination", op8_decontaminate.stage),
    ("tokens", op6_sentencepiece.stage),
]

#: A learned model decides in the first stage, and tokens come from a vocabulary file: no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
