"""Documents to training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but
the last return the columns of ``documents``. ``run`` writes each stage's rows as Parquet to the session's shared
folder and reads them back for the next.

1. language_id      rows without a recognised language go
2. near_duplicates  of texts linked by five-word shingles (similarity 0.8) one stays
3. suffix_dedup     strings of 200 bytes that start more than once are cut (passages of 50 words are longer)
4. source_mix       rows are repeated or left out until the sources have their weights
5. packing          token sequences of 4096: one row per piece with its token ids and place; row_id tells the copies of a row apart

Null and empty texts: stage 1 drops them, as they have no language. Repeated rows: stage 2 keeps one. A row with a null
id is a document of its own in stage 2; of those linked one stays. Empty tables pass through as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.jaccard import keep_one
from tidemark.llm.langid import keep_identified
from tidemark.llm.mixing import apply_mix
from tidemark.llm.packing import pack, pieces
from tidemark.llm.shared import scratch, sf_table, small_batches, stash
from tidemark.llm.suffixes import cut_repeats

REPEAT_BYTES = 200


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, width=5, num=80, den=100, compare_all=True)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cut_repeats(docs, REPEAT_BYTES)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return apply_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with small_batches(spark):
        found = stash(pieces(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True), "pieces")
    return pack(found)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]

# SQL cannot express the trained network, the adaptive prefixes or the packing rule.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``. The tables between the stages are deleted, the last one stays."""
    docs = sf_table(spark, sf_dir, "documents")
    with scratch(spark, "pipeline"):
        for name, stage in STAGES:
            docs = stash(stage(spark, docs, sf_dir), name, keep=name == STAGES[-1][0])
    return docs
