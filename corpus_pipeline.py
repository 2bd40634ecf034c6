"""A training-data pipeline over `documents`, in five stages that each call one operator.

Each stage takes (spark, docs, sf_dir), reads `docs` as the stage before wrote it, and returns a table. All but the last
return the columns of `docs`. Files tell the rows of `docs` apart, so no stage copies it first. Texts that are NULL or
empty are rejected by the first stage, as it wants 20 words; repeated rows are near-duplicates and leave one; extra
columns go along; no documents give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph import session
from heliograph.llm import decontamination, packing, quality_rules, secret_scans, simhash
from heliograph.llm.common import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    judged = quality_rules.verdicts(docs)
    verdict = judged.columns[-1]
    return judged.filter(F.col(f"{verdict}.kept")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least doc_id."""
    return simhash.one_of_each(docs, from_files=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated; all others stay as they are."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), from_files=True)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced; `n_chars`, where there is one, follows the text."""
    redacted = secret_scans.redact(docs, from_files=True)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        redacted = redacted.withColumn("n_chars", F.char_length("text").cast(kind))
    return redacted


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack),
]

# Neither fingerprints nor token ids can be made in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = session.materialise(stage(spark, docs, sf_dir), name)
    return docs
