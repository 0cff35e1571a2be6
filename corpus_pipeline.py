"""The corpus pipeline: five stages over ``documents``, each written and read again.

Stages: quality rules (rejected documents go), SimHash near-dedup (one
document of each group stays), secret scans (secrets are replaced in the
text), mixing sources to target weights (a row for each time a document is
taken), BPE encoding and decoding (ids and the round trip's result are added).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywise.llm.bpe_lexicon import bpe_stage
from tallywise.llm.common import drop_folder, staged, table
from tallywise.llm.mixing_tree import mixing_stage
from tallywise.llm.quality_mcd import quality_stage
from tallywise.llm.secrets_crf import secrets_stage
from tallywise.llm.simhash_tiles import dedup_stage

STAGES = [("quality", quality_stage), ("near_dedup", dedup_stage), ("secrets", secrets_stage),
          ("mixing", mixing_stage), ("bpe", bpe_stage)]

#: Trained and random stages cannot be told in SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what a stage wrote goes when the next one has been written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        docs, folder = staged(step(spark, docs, sf_dir), name)
        if before:
            drop_folder(spark, before)
        before = folder
    return docs
