"""Nearest neighbours by largest inner product with adaptive dimension scans.

Vectors get one more coordinate so that all have the largest norm; then the nearest by Euclidean
distance are those of the largest inner product. A random rotation makes every run of coordinates a
fair sample of a distance. Rows are put in lists by k-means centroids; a query probes its nearest
lists. Within the probed lists, distances are summed over column blocks, and after each block a
hypothesis test abandons candidates whose partial distance, scaled up, exceeds the query's current
20th-best distance by more than the sampling error explains. Survivors are scored exactly, in double
precision on the original vectors.

Sample (documented bound): centroids and the number of probed lists are fitted on at most
``SAMPLE`` vectors, chosen by hash; lists are probed until they held the share ``COVERAGE`` of the
sample's own nearest neighbours. Every row is indexed. Lists are packed into tiles of about
``TILE_ROWS`` rows (a larger list is cut into several) that meet the queries in chunks, so group
sizes are bounded and one list with a third of all rows is many tiles.

Defined results: vectors null, zero, or with null or non-finite components, null ids, and vectors
of another length than the most frequent take no part; of rows that share an id the least vector stands. Equal vectors are searched once and expanded
(only their smallest ids can rank). Ties go to the smaller id. A query with fewer than k candidates
gets all of them; an empty table gives no rows. Only the id and the vector column are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from slotcast.session import cut_lineage, ship_package

SAMPLE = 20_000
SAMPLE_QUERIES = 256
COVERAGE = 0.975
MAX_LISTS = 1024
TILE_ROWS = 4096
CHUNK = 1024
COLUMNS = 16        # coordinates per column block
ROWS = 256          # rows between updates of a query's nearest distances
EPSILON = 2.1       # the test's tolerance in standard errors
SEED = 99


def valid_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part, v as doubles."""
    rows = vectors.select(vectors[id_col].alias("vec_id"), vectors[vec_col].cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad
                      & F.exists("v", lambda x: x != 0))
    rows = cut_lineage(rows.groupBy("vec_id").agg(F.min("v").alias("v")))
    width = (rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("c"))
             .orderBy(F.desc("c"), F.desc("d")).first())
    return rows.where(F.size("v") == (width["d"] if width else 0))


def rotation(width: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def lift(x: np.ndarray, norm2: float, turn: np.ndarray, query: bool) -> np.ndarray:
    """Rotated vectors with the coordinate that evens out norms (0 for queries)."""
    last = np.zeros(len(x)) if query else np.sqrt(np.maximum(norm2 - (x * x).sum(axis=1), 0.0))
    return np.hstack([x, last[:, None]]) @ turn


def centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    c = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(8):
        near = nearest_lists(sample, c, 1)[:, 0]
        size = np.bincount(near, minlength=lists)
        total = np.zeros_like(c)
        np.add.at(total, near, sample)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
    return c


def nearest_lists(x: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centroids of each row, nearest first."""
    out = []
    for i in range(0, len(x), 2048):
        d = (c * c).sum(axis=1)[None, :] - 2.0 * (x[i:i + 2048] @ c.T)
        out.append(d.argmin(axis=1)[:, None] if n == 1 else np.argsort(d, axis=1, kind="stable")[:, :n])
    return np.vstack(out)


def probes_needed(sample: np.ndarray, lifted: np.ndarray, c: np.ndarray, norm2: float, turn: np.ndarray, k: int) -> int:
    """Lists to probe so that sample queries meet ``COVERAGE`` of their nearest sample rows."""
    if len(c) == 1:
        return 1
    some = np.random.default_rng(SEED).choice(len(sample), min(SAMPLE_QUERIES, len(sample)), replace=False)
    score = sample[some] @ sample.T
    score[np.arange(len(some)), some] = -np.inf
    top = np.argsort(-score, axis=1)[:, :k]
    own = nearest_lists(lifted, c, 1)[:, 0]
    order = nearest_lists(lift(sample[some], norm2, turn, True), c, len(c))
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(c))[None, :], axis=1)
    ranks = np.sort(np.take_along_axis(rank, own[top], axis=1).ravel())
    return int(ranks[min(len(ranks) - 1, int(np.ceil(COVERAGE * len(ranks))))]) + 1


def scan(queries: np.ndarray, rows: np.ndarray, probed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Adaptive dimension scan over lifted vectors, ``ROWS`` rows at a time: the (query, row) pairs that no
    test abandons and that are within the k nearest found."""
    width, head = rows.shape[1], min(COLUMNS, rows.shape[1])
    best = np.full((len(queries), k), np.inf)       # squared distances of the k nearest so far
    found = []
    start = (queries[:, :head] ** 2).sum(axis=1)[:, None]
    for at in range(0, len(rows), ROWS):
        some, limit = rows[at:at + ROWS], best.max(axis=1)
        part = start + (some[:, :head] ** 2).sum(axis=1)[None, :] - 2.0 * queries[:, :head] @ some[:, :head].T
        seen = head
        q, r = np.nonzero(probed[:, at:at + ROWS])
        total = part[q, r]
        while True:
            share = seen / width
            allowed = 1.0 if seen == width else share * (1.0 + EPSILON / np.sqrt(seen)) ** 2
            keep = total <= (limit * allowed * (1 + 1e-9) + 1e-9)[q]
            q, r, total = q[keep], r[keep], total[keep]
            if seen == width:
                break
            cols = slice(seen, min(seen + COLUMNS, width))
            total = total + ((queries[q, cols] - some[r, cols]) ** 2).sum(axis=1)
            seen = cols.stop
        fresh = np.full((len(queries), len(some)), np.inf)
        fresh[q, r] = total
        best = np.partition(np.hstack([best, fresh]), k - 1, axis=1)[:, :k]
        found.append((q, r + at, total))
    q, r, total = (np.concatenate(x) for x in zip(*found))
    keep = total <= best.max(axis=1)[q] * (1 + 1e-9) + 1e-9
    return q[keep], r[keep]


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
           k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of the largest inner product with each row for
    which ``is_query`` (a column over ``vec_id``) holds, the query's own row excepted."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = cut_lineage(valid_vectors(vectors, id_col, vec_col).withColumn("q", is_query))
    distinct = cut_lineage(rows.groupBy("v").agg(F.min("vec_id").alias("vid"), F.max("q").alias("q")))
    named = cut_lineage(rows.join(distinct.select("v", "vid"), "v").select("vec_id", "vid", "q"))
    order = Window.partitionBy("vid").orderBy("vec_id")
    ids = named.select("vid", "vec_id", F.row_number().over(order).alias("n")).where(F.col("n") <= k + 1).drop("n")

    n = distinct.count()
    norm2 = distinct.agg(F.max(F.expr("aggregate(v, 0D, (a, x) -> a + x * x)"))).first()[0] or 0.0
    picked = distinct.orderBy(F.xxhash64("v"), "vid").limit(SAMPLE).select("v").collect()
    if not picked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.array([r["v"] for r in picked])
    turn = rotation(sample.shape[1] + 1)
    lifted = lift(sample, norm2, turn, False)
    lists = int(np.clip(round(np.sqrt(n)), 1, min(MAX_LISTS, len(sample))))
    c = centroids(lifted, lists)
    probes = probes_needed(sample, lifted, c, norm2, turn, k)

    def put(frames):
        for f in frames:
            if len(f):
                yield f.assign(list=nearest_lists(lift(np.vstack(f["v"]), norm2, turn, False), c, 1)[:, 0])

    listed = cut_lineage(distinct.mapInPandas(put, "v array<double>, vid long, q boolean, list int"))
    sizes = {r["list"]: r["c"] for r in listed.groupBy("list").agg(F.count("*").alias("c")).collect()}   # <= MAX_LISTS
    # lists packed in order into tiles; a list over the tile size starts its own run of tiles
    first, cuts, tile, room = np.zeros(lists, int), np.ones(lists, int), 0, 0
    for i in sorted(sizes):
        cuts[i] = -(-sizes[i] // TILE_ROWS)
        if sizes[i] > room:
            tile, room = tile + 1, TILE_ROWS
        first[i] = tile
        if cuts[i] > 1:
            tile, room = tile + cuts[i] - 1, 0
        else:
            room -= sizes[i]
    held = np.array([sizes.get(i, 0) for i in range(lists)])

    def spread(frames):
        """Each query once per tile it probes, with the probed lists."""
        for f in frames:
            if not len(f):
                continue
            x = np.vstack(f["v"])
            ranked = nearest_lists(lift(x, norm2, turn, True), c, lists)
            out = []
            for vid, v, near in zip(f["vid"], f["v"], ranked):
                enough = int(np.searchsorted(np.cumsum(held[near]), k + 1)) + 1
                use = near[:max(probes, enough)]
                tiles: dict[int, list[int]] = {}
                for i in use[held[use] > 0]:
                    for t in range(first[i], first[i] + cuts[i]):
                        tiles.setdefault(int(t), []).append(int(i))
                out += [(t, vid, v, p) for t, p in tiles.items()]
            yield pd.DataFrame(out, columns=["tile", "qid", "v", "lists"])

    asked = cut_lineage(listed.where("q").select("v", "vid").mapInPandas(spread, "tile int, qid long, v array<double>, lists array<int>"))
    # a tile is copied once per ``CHUNK`` queries that ask for it, and not at all if none does
    chunks = asked.groupBy("tile").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    asked = asked.join(chunks, "tile").withColumn("chunk", F.pmod(F.xxhash64("qid"), F.col("chunks"))).drop("chunks")
    places = F.create_map(*[F.lit(int(x)) for i in sizes for x in (i, first[i])]) if sizes else None
    parts = F.create_map(*[F.lit(int(x)) for i in sizes for x in (i, cuts[i])])
    stored = (listed.withColumn("tile", (places[F.col("list")] + F.pmod(F.xxhash64("vid"), parts[F.col("list")])).cast("int"))
              .join(chunks, "tile").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
              .select("tile", "chunk", "vid", "v", "list"))

    def meet(f: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"qid": pd.Series(dtype="int64"), "vid": pd.Series(dtype="int64"),
                              "score": pd.Series(dtype="float64")})
        if not len(f) or not len(g):
            return empty
        x, own = np.vstack(f["v"]), f["list"].to_numpy()
        lifted_rows, vids = lift(x, norm2, turn, False), f["vid"].to_numpy()
        out = []
        for at in range(0, len(g), 128):
            some = g.iloc[at:at + 128]
            y, qids = np.vstack(some["v"]), some["qid"].to_numpy()
            wanted = np.zeros((len(some), lists), dtype=bool)
            for i, p in enumerate(some["lists"]):
                wanted[i, np.asarray(p, dtype=int)] = True
            q, r = scan(lift(y, norm2, turn, True), lifted_rows, wanted[:, own], k + 1)
            score = np.einsum("ij,ij->i", y[q], x[r])
            best = np.lexsort((vids[r], -score, q))
            q, r, score = q[best], r[best], score[best]
            rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
            keep = rank <= k
            out.append(pd.DataFrame({"qid": qids[q[keep]], "vid": vids[r[keep]], "score": score[keep]}))
        return pd.concat(out) if out else empty

    near = stored.groupBy("tile", "chunk").cogroup(asked.groupBy("tile", "chunk")).applyInPandas(
        meet, "qid long, vid long, score double")
    by_query = Window.partitionBy("qid").orderBy(F.desc("score"), "vid")
    near = near.withColumn("n", F.row_number().over(by_query)).where(F.col("n") <= k + 1).drop("n")
    wide = near.join(ids, "vid").select("qid", "vec_id", "score")
    ranked = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    wide = wide.withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= k + 1).drop("n")
    queries = named.where("q").select(F.col("vec_id").alias("query_id"), F.col("vid").alias("qid"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (queries.join(wide, "qid").where("query_id <> vec_id")
            .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
