"""The corpus pipeline: documents through five stages of ``revlens.llm``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet into the shared checkpoint folder and reread as the next one's docs.
All but the last stage return rows of their docs with the same columns.

Defined results: null texts count as empty; empty, very long and repeated texts go
through every stage like others (of equal texts one row stays); extra columns ride
along unchanged, but the names ``__quality_score``, ``__file`` and ``__row`` are
taken; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlens.llm import exact_stream, mixing, near_omh, quality, queries
from revlens.llm.common import materialize, read

#: As many tokens as there are: where the shares reach the entropy target, every
#: document is drawn once; else only sources above their weight lose documents and
#: smaller ones repeat theirs, up to ``max_epochs`` times.
MIX = mixing.MixSpec(budget_part=1.0, entropy_part=0.95, max_epochs=4.0, crossing=True)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (operator 7)."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id (operator 6)."""
    return exact_stream.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (operator 9)."""
    return near_omh.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows drawn at the sources' temperature weights (operator 2)."""
    return mixing.mixed_rows(docs, MIX)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of what is left (operator 10): the columns of op10."""
    return queries.bpe_digests(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", encoding_stage),
]

#: SQL can't express the trained classifier or the near-duplicate search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{k}")
    return docs
