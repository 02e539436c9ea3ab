"""Training-corpus pipeline over ``documents``: five stages, each one operator of ``slotcast.llm``.

Every stage is ``fn(spark, docs, sf_dir) -> DataFrame`` over what its predecessor kept; ``run`` writes
each result as Parquet under the shared checkpoint folder and rereads it. All but the last stage
return the columns of ``documents``; the last adds ``shard_id``.

Stages take null ids, texts, languages and sources, empty texts, repeated rows and empty tables
as their operators define: null or empty texts are scored like any text, hold no shingle and no
benchmark passage, have no tokens, and are sharded with 0 bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotcast.llm import decontaminate, mixing, near_dedup, quality, sharding
from slotcast.session import cut_lineage
from slotcast.sources.tables import read_table

# Near-duplicates: five-word shingles, similarity 0.8 or more.
SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80
# Mixing: one epoch at most, so no document is repeated; equal weights below the domains.
DOMAIN_WEIGHTS = {"family0": 3, "family1": 3, "family2": 2, "family3": 2}
TOKEN_SHARE = (9, 10)
MIX_SEED = 11
SHARD_BYTES = 4 << 20


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, fitted on the labelled ones, rejects go."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return near_dedup.drop_near_duplicates(docs, size=SHINGLE_WORDS, percent=SIMILARITY_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each domain - language - source leaf keeps the token prefix of its budget."""
    num, den = TOKEN_SHARE
    return mixing.select_rows(docs, mixing.source_family(docs["source"]), docs["lang"], docs["source"],
                              {"domain": DOMAIN_WEIGHTS}, F.floor(F.col("tokens") * num / den), max_epochs=1,
                              seed=MIX_SEED)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard."""
    return sharding.attach(docs, SHARD_BYTES)


STAGES = [("quality_filter", quality_filter), ("near_duplicates", near_duplicates),
          ("benchmark_decontamination", benchmark_decontamination), ("source_mixture", source_mixture),
          ("shards", shards)]

# Signatures, the fitted classifier and the alignment have no SQL form; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
