"""The pipeline against brute-force versions of its stages, and its stages on odd rows."""

from collections import Counter

import corpus_pipeline as cp
from conftest import SMALL
from pyspark.sql import functions as F
from slotcast.llm import mixing, quality, sharding
from test_decontaminate import brute_items, dc
from test_near_dedup import brute


def sql_over(df, sql):
    """Rows of a query's DuckDB SQL over ``df`` as its documents."""
    import duckdb
    documents = df.toPandas()       # noqa: F841 - read by DuckDB
    res = duckdb.connect().execute(sql)
    names = [d[0] for d in res.description]
    return [dict(zip(names, r)) for r in res.fetchall()]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    columns = docs.columns
    model = quality.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = docs.collect()
    good = {r.doc_id for r in rows if model.score(quality.stats_matrix([r.text]))[0] >= 0.5}
    s1 = cp.quality_filter(spark, docs, SMALL).cache()
    assert {r.doc_id for r in s1.collect()} == good and s1.columns == columns

    comp, _ = brute(sorted((r.doc_id, r.text) for r in s1.collect()), 80)
    s2 = cp.near_duplicates(spark, s1, SMALL).cache()
    assert {r.doc_id for r in s2.collect()} == set(comp.values()) and s2.columns == columns

    bench = [(r.item_id, dc.normalise(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    s3 = cp.benchmark_decontamination(spark, s2, SMALL).cache()
    kept = {r.doc_id for r in s3.collect()}
    assert s3.columns == columns
    for r in s2.collect():
        exact = any(t in dc.normalise(r.text) for _, t in bench)
        assert not (exact and r.doc_id in kept)
        if r.doc_id not in kept and not exact:
            assert brute_items(bench, dc.normalise(r.text))

    s4 = cp.source_mixture(spark, s3, SMALL).cache()
    words = {r.doc_id: len(r.text.encode().split()) for r in s3.collect()}
    taken = [r.doc_id for r in s4.collect()]
    assert s4.columns == columns and max(Counter(taken).values()) == 1 and set(taken) <= kept
    budget = int(sum(words.values()) * 0.9)
    assert 0.7 * budget < sum(words[d] for d in taken) <= budget
    # the same rows from plain windows over what stage 3 kept
    want = sql_over(s3, mixing.oracle({"domain": cp.DOMAIN_WEIGHTS}, *cp.TOKEN_SHARE, 1, cp.MIX_SEED))
    assert sorted(taken) == sorted(r["doc_id"] for r in want) and all(r["copies"] == 1 for r in want)

    s5 = cp.shards(spark, s4, SMALL)
    assert s5.columns == [*columns, "shard_id"]
    got = sorted((r.doc_id, r.shard_id.lower()) for r in s5.collect())
    want = sql_over(s4, sharding.oracle(cp.SHARD_BYTES))
    assert got == sorted((r["doc_id"], f"{r['shard_depth']:02d}-{r['shard_prefix']:015x}") for r in want)
    small = sql_over(s4, sharding.oracle(20_000))
    assert len({(r["shard_depth"], r["shard_prefix"]) for r in small}) > 10
    assert sorted((r.doc_id, r.shard_id.lower()) for r in sharding.attach(s4, 20_000).collect()) == sorted(
        (r["doc_id"], f"{r['shard_depth']:02d}-{r['shard_prefix']:015x}") for r in small)
    final = cp.run(spark, SMALL)
    assert sorted((r.doc_id, r.shard_id.lower()) for r in final.collect()) == got
    docs.unpersist()


def test_stages_take_odd_rows(spark):
    plain = " ".join(f"word{i}" for i in range(40))
    rows = [(None, None, None, None, None), (1, None, "en", "src1", 0), (2, "", None, None, 0), (3, plain, "en", "x", 9),
            (3, plain, "en", "x", 9), (4, plain, None, "src0", 9), (5, "very long " * 80_000, "en", "src0", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, extra in (("key", 1), ("shard", "a"), ("tokens", None), ("score", 2.0), ("budget", 1), ("item_ids", 0)):
        docs = docs.withColumn(name, F.lit(extra).cast("string"))
    for data in (docs, docs.limit(0)):
        got = data
        for name, stage in cp.STAGES:
            got = stage(spark, got, SMALL)
            assert set(data.columns) <= set(got.columns)
        n = got.count()
        assert n == 0 if data is not docs else 1 <= n <= 5
