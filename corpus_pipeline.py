"""The corpus pipeline: stages that each take and give documents, written as Parquet between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import decontaminate, jaccard, packing, pii, quality
from siltstone.llm._common import materialise, table

#: Documents that the classifier rejects go; one document of each near-duplicate group stays; documents that hold
#: benchmark passages go; personal data is replaced; what is left is packed into sequences.
STAGES = [
    ("quality", quality.stage),
    ("near_duplicates", jaccard.stage),
    ("decontamination", decontaminate.stage),
    ("personal_data", pii.stage),
    ("packing", packing.stage),
]

#: SQL can train no classifier and pack no sequences; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs)
    return docs
