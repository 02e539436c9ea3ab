"""op7: equal to all-pairs brute force on fixtures and on the small table; components; odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SMALL
from slotcast.llm import near_dedup as nd, queries
from slotcast.llm.components import components

MID = "/root/testdata/sf0.01"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = (text or "").translate(LOW).encode().split()
    if not words:
        return frozenset()
    n = min(5, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def brute(docs, percent):
    """Component ids from all pairs that share a shingle."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        near = {j for g in s for j in where[g] if j > i}
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    ids = {}
    for i, (d, _) in enumerate(docs):
        ids.setdefault(find(i), []).append(d)
    return {d: min(ids[find(i)]) for i, (d, _) in enumerate(docs)}, [len(s) for s in sets]


def check(rows, docs, percent):
    want, sizes = brute(docs, percent)
    assert {r.doc_id: r.component_id for r in rows} == want
    assert {r.doc_id: r.n_shingles for r in rows} == {d: n for (d, _), n in zip(docs, sizes)}
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and len(rows) == len(docs)


def test_query_equals_all_pairs(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{MID}/documents.parquet").collect())
    check(queries.op7_near_duplicates(spark, MID).collect(), docs, 85)


def test_chains_and_near_misses(spark, monkeypatch):
    monkeypatch.setattr(nd, "TILE", 7)
    monkeypatch.setattr(nd, "LOT", 40)
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(3000)]
    docs = []
    for g in range(12):         # families drift away from their first text, so components are chains
        base = [rng.choice(vocab) for _ in range(rng.choice([30, 80, 200]))]
        for c in range(25):
            docs.append((len(docs) * 3 + 1, " ".join(base).upper() if c % 4 == 0 else " ".join(base)))
            for _ in range(rng.choice([1, 1, 2, 4])):
                base[rng.randrange(len(base))] = rng.choice(vocab)
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for percent in (80, 85):
        check(nd.near_duplicates(df, percent=percent).collect(), sorted(docs), percent)


def test_sequential_test_keeps_similar_pairs():
    least = nd.least_matches(0.85, 1e-6)
    assert all(a <= b for a, b in zip(least, least[1:])) and least[-1] < 0.85 * nd.HASHES
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 32, (20000, nd.HASHES), dtype=np.uint32)
    b = np.where(rng.random(a.shape) < 0.85, a, a + np.uint32(1))
    assert len(nd.surviving(a, b, least)) >= 19990
    c = np.where(rng.random(a.shape) < 0.4, a, a + np.uint32(1))
    assert len(nd.surviving(a, c, least)) < 20


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One Two"), (5, "one  two"), (6, "two one"), (None, "one two"),
            (7, "a b c d e f g h"), (7, "a b c d e f g h"), (7, "z y x w v u"), (8, "é b c d e"), (9, "É b c d e"),
            (10, "long text here " * 60_000), (11, "long text here " * 60_001)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("x")).withColumn("key", F.lit(1))
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(df).collect()}
    assert got == {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False),
                   (6, 1, 6, True), (None, 1, 4, False), (7, 4, 7, True), (7, 2, 7, True), (8, 1, 8, True),
                   (9, 1, 9, True), (10, 3, 10, True), (11, 3, 10, False)}
    kept = nd.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, (r.text or "")[:3]) for r in kept.collect()) == [
        (1, ""), (2, ""), (3, " \n\t"), (4, "One"), (6, "two"), (7, "a b"), (7, "z y"), (8, "é b"), (9, "É b"), (10, "lon")]
    assert nd.near_duplicates(df.limit(0)).count() == 0 and nd.drop_near_duplicates(df.limit(0)).count() == 0
    alone = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert nd.drop_near_duplicates(alone).count() == 1


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(200)] + [(5, 5), (2000, 2001)]
    rng.shuffle(links)
    df = spark.createDataFrame([(f"{a:05d}".encode(), f"{b:05d}".encode()) for a, b in links], "a binary, b binary")
    got = {int(bytes(r.node)): int(bytes(r.root)) for r in components(df).collect()}
    want = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(200)} | {2000: 2000, 2001: 2000}
    assert got == want


def test_bands_follow_the_threshold(spark):
    assert nd.banding(85) == (18, 5) and nd.banding(80) == (25, 5)
    for percent in (30, 60, 70, 80, 85, 95, 100):
        bands, rows = nd.banding(percent)
        assert bands * rows <= nd.HASHES and (1 - (percent / 100) ** rows) ** bands <= 5e-5
    a = np.arange(nd.HASHES, dtype="<u4")
    b = a + np.uint32(1000)
    b[100:105] = a[100:105]         # alike in the twenty-first band only
    sigs = spark.createDataFrame([(b"a", a.tobytes()), (b"b", b.tobytes())], "node binary, sig binary")
    assert nd.bucket_members(sigs, 80).count() == 2


def test_join_totals_splits_hot_keys_and_nulls(spark):
    from slotcast.llm.common import join_totals
    rows = spark.createDataFrame([(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i}") for i in range(6000)], "id int, root string")
    totals = rows.where("root is not null").groupBy("root").agg(F.min("id").alias("first"), F.count("*").alias("held"))
    got = join_totals(rows, totals, "root", "held", 6000).collect()
    assert len(got) == 6000
    assert all(r.first == (None if r.root is None else 0 if r.root == "hot" else r.id) for r in got)
