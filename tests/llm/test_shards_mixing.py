"""op1 and op8: against their SQL, and by properties on fixtures with hot, equal and odd rows."""

import os
import sys
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SMALL
from slotcast.llm import mixing, queries, sharding

sys.path.insert(0, os.path.join(ROOT, "scripts"))
from oracle_check import rows_of  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(queries.ORACLES[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols) and len(rows) == len(want) > 0
    assert rows_of(df.columns, rows) == rows_of(cols, want)


def corpus(spark, extra=()):
    rows = [(i, f"text {i} " * (1 + i % 17), "en" if i % 3 else "de", f"src{i % 5}", i) for i in range(400)]
    rows += [(7, "same row " * 40, "en", "src0", 0)] * 60 + [(None, None, None, None, None)] * 3 + list(extra)
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, page long")


@pytest.mark.parametrize("limit", [200, 1500, 1 << 20])
def test_shards_fit_and_are_minimal(spark, limit):
    rows = sharding.assign(corpus(spark, [(1000, "long " * 2000, "en", "src0", 1)]), limit).collect()
    assert len(rows) == 464
    size, count, keys = Counter(), Counter(), defaultdict(set)
    for r in rows:
        s = (r.shard_depth, r.shard_prefix)
        size[s, r.page] += r.n_bytes
        count[s, r.page] += 1
        keys[s].add(r.key_hash)
        assert r.shard_prefix == r.key_hash >> (60 - r.shard_depth)
    assert all(b <= limit or count[k] == 1 for k, b in size.items())
    whole = Counter()
    for r in rows:
        for d in range(61):
            whole[d, r.key_hash >> (60 - d)] += r.n_bytes
    for d, p in keys:      # a parent would not have fitted
        if d:
            assert whole[d - 1, p >> 1] > limit


def test_deep_splits(spark, monkeypatch):
    monkeypatch.setattr(sharding, "STEP", 2)
    df = corpus(spark)
    a = {(r.key_hash, r.shard_depth, r.shard_prefix) for r in sharding.assign(df, 900).collect()}
    monkeypatch.undo()
    assert a == {(r.key_hash, r.shard_depth, r.shard_prefix) for r in sharding.assign(df, 900).collect()}


def test_attach_and_write(spark, tmp_path):
    df = corpus(spark).withColumn("shard_id", F.lit("old")).withColumn("b.c", F.lit(1))
    size, names = Counter(), Counter()
    for r in sharding.assign(df, 900).collect():
        size[r.shard_depth, r.shard_prefix] += r.n_bytes
        names[r.shard_depth, r.shard_prefix, r.page] += 1
    # over-full shards (equal rows) carry their page in the name
    ids = {f"{d:02d}-{p:015x}" + (f"-{page:06d}" if size[d, p] > 900 else ""): n for (d, p, page), n in names.items()}
    for bound in (1_000_000, 0):
        out = sharding.attach(df, 900, max_directory=bound)
        assert sorted(out.columns) == sorted(df.columns) and out.count() == 463
        assert Counter(r.shard_id.lower() for r in out.select("shard_id").collect()) == ids
    sharding.write_shards(df, str(tmp_path / "s"), 900)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 463 and back.select("shard_id").distinct().count() == len(ids)
    held = back.groupBy("shard_id").agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).collect()
    assert all((r.b or 0) <= 900 or r.n == 1 for r in held)
    empty = df.limit(0)
    assert sharding.assign(empty, 900).count() == 0 and sharding.attach(empty, 900).count() == 0


def test_query_sql_holds_for_repeated_rows(spark, monkeypatch, tmp_path):
    """Equal rows over the limit: pages, and bytes by page, as in the query's SQL."""
    import duckdb
    monkeypatch.setattr(queries, "SHARD_BYTES", 1500)
    df = corpus(spark, [(5000, "equal " * 100, "en", "s", 1)] * 7)
    df.coalesce(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op1_extendible_shards(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    res = con.execute(sharding.oracle(1500))
    cols = [d[0] for d in res.description]
    want = rows_of(cols, res.fetchall())
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == want
    pages = [r for r in got.collect() if r.doc_id == 5000]
    assert sorted(r.page for r in pages) == [0, 0, 1, 1, 2, 2, 3] and max(r.shard_bytes for r in pages) == 1200


def mixed(df, weights, share, epochs):
    return mixing.mix(df, mixing.source_family(df["source"]), df["lang"], df["source"], weights,
                      F.floor(F.col("tokens") * share), epochs, 3).collect()


@pytest.mark.parametrize("share,epochs", [(0.5, 1), (1.0, 1), (1.7, 3), (0.0, 2), (9.0, 2)])
def test_mix_meets_budgets(spark, share, epochs):
    df = corpus(spark)
    tokens = Counter()
    for r in df.collect():
        tokens[r.lang, r.source] += len((r.text or "").split())
    rows = mixed(df, {"lang": {"en": 3, "de": 1}}, share, epochs)
    got = Counter()
    for r in rows:
        got[r.lang, r.source] += r.n_tokens * r.copies
    total = sum(tokens.values())
    assert sum(got.values()) <= int(total * share) and all(got[k] <= epochs * tokens[k] for k in got)
    if share >= epochs:
        assert all(got[k] == epochs * tokens[k] for k in tokens)
    elif share:     # equal rows stand or fall together: 60 rows of 80 words bound what is left over
        assert sum(got.values()) >= int(total * share) - 60 * 80 - 40 * len(tokens)


def test_shortage_goes_to_siblings_first(spark):
    rows = [(i, "w " * 10, lang, src) for i, (lang, src) in enumerate(
        [("en", "a0")] * 100 + [("de", "a0")] * 10 + [("en", "a1")] * 100 + [("de", "a1")] * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = Counter()
    for r in mixed(df, {}, 1200 / 3100, 1):
        got[r.domain, r.lang] += r.n_tokens
    # each domain gets 600; family0's German has only 100, so its English takes the other 500
    assert got == {("family0", "de"): 100, ("family0", "en"): 500, ("family1", "de"): 300, ("family1", "en"): 300}


def test_select_rows_keeps_columns(spark):
    df = corpus(spark).withColumn("epochs", F.lit("x")).withColumn("cut", F.lit(0))
    args = [mixing.source_family(df["source"]), df["lang"], df["source"], {}, F.floor(F.col("tokens") * 1.4)]
    out = mixing.select_rows(df, *args, max_epochs=2, seed=3)
    assert out.columns == df.columns
    want = Counter()
    for r in mixing.mix(df, *args, max_epochs=2, seed=3).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == want
    assert mixing.select_rows(df.limit(0), *args).count() == 0
