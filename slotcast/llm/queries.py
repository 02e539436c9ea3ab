"""The registered queries of the training-data operators (production parameters, whole tables)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from slotcast.llm import (ann, chat_format, decontaminate, language_id, license_scan, mixing, near_dedup, phrases, quality,
                          sharding, substring_dedup, token_count, vector_codes)
from slotcast.llm.common import crc_fold
from slotcast.sources.tables import read_table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return docs.withColumn("doc_id", F.col("doc_id").cast("long"))


def held_out(parts: int, fold: int):
    return F.coalesce(crc_fold(F.col("doc_id"), parts) == fold, F.lit(False)).alias("held_out")


SHARD_BYTES = 1 << 20


@query
def op1_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.assign(documents(spark, sf_dir), SHARD_BYTES)
    shard = ["shard_depth", "shard_prefix", "page"]
    shards = rows.groupBy(*shard).agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
    return rows.drop("key_hash").join(shards, shard)


ORACLES["op1_extendible_shards"] = sharding.oracle(SHARD_BYTES)

@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(documents(spark, sf_dir), words=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), size=5, percent=85)


MIX_WEIGHTS = {"domain": {"family0": 4, "family1": 3, "family2": 2, "family3": 1},
               "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}
MIX_SHARE = (3, 5)      # the budget is three fifths of the corpus's tokens
MIX_EPOCHS = 2
MIX_SEED = 7


@query
def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    num, den = MIX_SHARE
    return mixing.mix(docs, mixing.source_family(docs["source"]), docs["lang"], docs["source"], MIX_WEIGHTS,
                      F.floor(F.col("tokens") * num / den), MIX_EPOCHS, MIX_SEED)


ORACLES["op8_mixture"] = mixing.oracle(MIX_WEIGHTS, *MIX_SHARE, MIX_EPOCHS, MIX_SEED)


@query
def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return ann.search(vectors, F.col("vec_id") % 20 == 0, k=20)


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contaminated(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    dictionaries = language_id.train_dictionaries(docs, crc_fold(F.col("doc_id"), 4) != 2)
    found = language_id.identify(docs, dictionaries)
    return found.select("doc_id", held_out(4, 2), "lang_pred", "score",
                        "margin", "accepted")


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"), crc_fold(F.col("doc_id"), 3) != 1)
    scored = quality.classify(docs, model)
    return scored.select("doc_id", held_out(3, 1), "score", "predicted")


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return token_count.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


ORACLES["op11_vector_codes"] = vector_codes.oracle()

# Conversation -1: texts full of control strings.
CONTROL_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


@query
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    turns = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    rows = ", ".join(f"({c}L, {t}L, '{r}', '{x}')" for c, t, r, x in CONTROL_TURNS)
    control = spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(columns)})")
    return chat_format.digest(chat_format.format_windows(turns.union(control)))


ORACLES["op12_chat_format"] = chat_format.oracle(CONTROL_TURNS)


@query
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


ORACLES["op13_phrases"] = phrases.oracle()
