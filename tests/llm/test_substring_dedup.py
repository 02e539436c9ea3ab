"""op5: equal to brute force; the index against plain search; hot seeds, small shards, odd rows."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SMALL
from slotcast.llm import queries, substring_dedup as sd
from slotcast.llm.fm_index import FMIndex, WaveletMatrix


def brute(docs, size=13):
    first, out = {}, {}
    for d, t in docs:
        w = (t or "").encode().split()
        for i in range(len(w) - size + 1):
            key = tuple(w[i:i + size])
            first[key] = min(first.get(key, d), d)
    for d, t in docs:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < d:
                gone[i:i + size] = [True] * size
        out[d] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def test_query_equals_brute_force(spark):
    for sf in (SMALL, "/root/testdata/sf0.01"):
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
        want = brute(docs)
        rows = queries.op5_substring_dedup(spark, sf).collect()
        assert len(rows) == len(docs) and sum(r.n_removed for r in rows) > 0
        for r in rows:
            n, m, kept = want[r.doc_id]
            assert (r.n_words, r.n_removed, r.kept_sha256) == (n, m, hashlib.sha256(kept.encode()).hexdigest())


def planted(seed=1):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(60)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passages = [prose(rng.choice([13, 14, 20, 60])) for _ in range(6)]
    docs = []
    for i in range(120):
        parts = [prose(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages).split()
            a = rng.randint(0, 3)
            parts += [rng.choice([" ", "\n", "\t "]).join(p[a:]), prose(rng.randint(0, 10))]
        docs.append((rng.randint(0, 10**9), " ".join(parts)))
    docs += [(10**9 + i, docs[3][1]) for i in range(20)] + [(10**9 + 50, "same " * 300), (10**9 + 51, "same " * 200)]
    rng.shuffle(docs)
    return docs


def test_planted_passages_on_every_route(spark, monkeypatch):
    docs = planted()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs)
    for hot, shard in ((2000, 250_000), (3, 300), (0, 10**6)):
        monkeypatch.setattr(sd, "HOT", hot)
        monkeypatch.setattr(sd, "SHARD_WORDS", shard)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in sd.remove_repeats(df).collect()}
        assert got == want


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(20))
    rows = [(1, None), (2, ""), (3, long), (4, long.replace(" ", "\n ")), (None, long), (None, long), (5, "x " + long),
            (6, "short"), (7, long), (7, long), (7, "other text"), (0, "é " * 5), (8, "big " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)).withColumn("doc", F.lit(2))
    got = sorted(((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed, r.kept[:6]) for r in sd.remove_repeats(df).collect()))
    assert got == [(-1, 20, 0, "w0 w1 "), (-1, 20, 0, "w0 w1 "), (0, 5, 0, "é é é "), (1, 0, 0, ""), (2, 0, 0, ""), (3, 20, 0, "w0 w1 "),
                   (4, 20, 20, ""), (5, 21, 20, "x"), (6, 1, 0, "short"), (7, 2, 0, "other "), (7, 20, 20, ""), (7, 20, 20, ""),
                   (8, 100_000, 0, "big bi")]
    assert sd.remove_repeats(df.limit(0)).count() == 0


def test_wavelet_rank():
    rng = np.random.default_rng(0)
    for sigma in (1, 2, 5, 300):
        s = rng.integers(0, sigma, 500)
        w = WaveletMatrix(s, sigma)
        c, at = rng.integers(0, sigma, 400), rng.integers(0, 501, 400)
        assert w.rank(c, at).tolist() == [int((s[:a] == x).sum()) for x, a in zip(c, at)]


def test_matching_statistics_of_foreign_queries():
    rng = np.random.default_rng(5)
    for k in (2, 5, 13):
        seqs = [rng.integers(1, 5, rng.integers(1, 60)) for _ in range(12)]
        text = np.concatenate([np.append(s, 0) for s in seqs])
        owner = np.repeat(np.arange(12) * 7, [len(s) + 1 for s in seqs])
        index = FMIndex(text, owner, k)
        queries_ = [rng.integers(0, 7, 40) for _ in range(8)] + [s.copy() for s in seqs]
        bounds = np.cumsum([0] + [len(q) for q in queries_])
        length, least = index.matching_statistics(np.concatenate(queries_), bounds)
        text_of = [bytes(s.astype(np.uint8)) for s in seqs]
        for q, lo in zip(queries_, bounds):
            b = bytes(q.astype(np.uint8))
            for i in range(len(q)):
                want = max((n for n in range(0, min(k, len(q) - i) + 1) if 0 not in b[i:i + n] and any(b[i:i + n] in t for t in text_of)))
                assert length[lo + i] == want
                if want == k:
                    assert least[lo + i] == min(7 * j for j, t in enumerate(text_of) if b[i:i + k] in t)
                else:
                    assert least[lo + i] == -1
