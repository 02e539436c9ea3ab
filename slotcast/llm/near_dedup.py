"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass over the texts gives each row the size and the digest of its set of distinct word
   shingles and a MinHash signature. Rows with the same set are one *node*.
2. Signatures are cut into bands. In each bucket with several nodes, every node is paired with the
   bucket's leader (the smallest node hash), so a bucket of g nodes gives g - 1 pairs.
3. Pairs are compared signature batch by batch. After each batch a pair is dropped when the posterior
   probability (uniform prior) that its similarity reaches the threshold is below ``MISS``.
4. Survivors are confirmed on their full sets; confirmed links give components.
5. In a bucket that still holds several components, the nodes outside the largest one meet the whole
   bucket in tiles of bounded size; steps 3 and 4 decide their pairs inside the tile, most alike
   first, and a pair whose components have met is skipped. So every pair of a bucket is either decided or
   connected, pairs are never written out, and a tile returns at most one link per node.

The bands follow from the threshold (``banding``): a pair at it shares no band with probability
``BAND_MISS`` at most, (1 - 0.85^5)^18 = 2.6e-5 at 0.85 and (1 - 0.8^5)^25 = 4.9e-5 at 0.8.

Defined results: A-Z are folded, words are runs of non-ASCII-space bytes; a text with fewer words
than a shingle has its whole word sequence as the one shingle; null texts and texts without words
have size 0 and link with nothing. Component ids are the smallest non-null id of the component (null
if all are null). Rows equal in id and text are told apart from nothing: they share their result.
Whole texts are used; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from slotcast.llm.common import gram_hashes, hashed_words, join_totals, size_checked, text_runs, written
from slotcast.llm.components import components
from slotcast.llm.sharding import key_text
from slotcast.session import ship_package

HASHES = 128
ROWS = 5
BANDS = 18
BATCH = 16
MISS = 1e-6
BAND_MISS = 5e-5
TILE = 512
LOT = 4000
_MULTIPLIERS = np.random.default_rng(77).integers(1 << 62, (1 << 64) - 1, HASHES, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, edges = hashed_words(texts, lower=True)
    out = []
    for a, b in zip(edges[:-1], edges[1:]):
        own = words[a:b]
        out.append(np.unique(gram_hashes(own, min(size, len(own)))) if len(own) else np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    best = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 4096):
        part = shingles[i:i + 4096]
        np.minimum(best, (part[None, :] * _MULTIPLIERS[:, None]).min(axis=1), out=best)
    return (best >> np.uint64(32)).astype("<u4")


def banding(percent: int) -> tuple[int, int]:
    """Number of bands and hashes in each: the longest bands of up to ROWS hashes, at least BANDS of them where
    the signature has room, with which a pair at the threshold is missed with probability BAND_MISS at most."""
    for rows in range(ROWS, 0, -1):
        unlike = 1 - (percent / 100) ** rows
        bands = max(min(BANDS, HASHES // rows), math.ceil(math.log(BAND_MISS) / math.log(unlike)) if 0 < unlike < 1 else 0)
        if bands * rows <= HASHES and unlike ** bands <= BAND_MISS:
            return bands, rows
    raise ValueError(f"{HASHES} hashes are too few for a similarity of {percent} %")


def least_matches(threshold: float, miss: float) -> list[int]:
    """For n = BATCH, 2 BATCH, ...: the fewest of n equal hashes at which the posterior
    P(similarity >= threshold) is at least ``miss``. With a uniform prior the posterior is Beta(m + 1,
    n - m + 1), whose tail is a binomial sum."""
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def surviving(a: np.ndarray, b: np.ndarray, least: list[int], i: np.ndarray | None = None,
              j: np.ndarray | None = None) -> np.ndarray:
    """Which of the pairs (row i of a, row j of b; by default row by row) no batch abandons."""
    i = np.arange(len(a)) if i is None else i
    j = i if j is None else j
    alive, equal = np.arange(len(i)), np.zeros(len(i), dtype=np.int64)
    for k, m in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        equal[alive] += (a[i[alive], part] == b[j[alive], part]).sum(axis=1)
        alive = alive[equal[alive] >= m]
    return alive


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def describe(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Written table: key (id and text), id, n_shingles, node (null: empty set), sig."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [t if isinstance(t, str) else None for t in frame["text"]]
            for a, b in text_runs(texts):
                sets = shingle_sets(texts[a:b], size)
                yield pd.DataFrame({
                    "key": frame["key"].iloc[a:b].to_numpy(), "id": frame["id"].iloc[a:b].to_numpy(),
                    "n": [len(s) for s in sets],
                    "node": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                    "sig": [signature(s).tobytes() if len(s) else None for s in sets]})

    rows = docs.select(F.unhex(key_text(docs[id_col], docs[text_col])).alias("key"), docs[id_col].alias("id"),
                       docs[text_col].cast("string").alias("text"))
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("id", docs.schema[id_col].dataType),
                           T.StructField("n", T.LongType()), T.StructField("node", T.BinaryType()),
                           T.StructField("sig", T.BinaryType())])
    return written(rows.mapInPandas(run, schema))


def bucket_members(rows: DataFrame, percent: int) -> DataFrame:
    """Written table (bucket, band, node, k, lead) of the buckets with several nodes; ``k`` is the node's
    hash and ``lead`` the bucket's smallest."""
    count, width = banding(percent)
    width *= 4
    bands = rows.where("node is not null").select(
        F.posexplode(F.expr(f"transform(sequence(0, {count - 1}), i -> xxhash64(i, substring(sig, i * {width} + 1, {width})))"))
        .alias("band", "bucket"), "node", F.xxhash64("node").alias("k"))
    several = (bands.groupBy("bucket").agg(F.min("k").alias("lead"), F.max("k").alias("last"))
               .where("lead <> last").select("bucket", "lead"))
    return written(bands.join(several, "bucket").distinct())


def full_sets(rows: DataFrame, members: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Written table (node, n, sig, shingles) of the bucket members: one text of each node is read again."""
    nodes = written(members.select("node").distinct())
    needed = written(rows.join(size_checked(nodes), "node").groupBy("node").agg(
        F.first("n").alias("n"), F.first("sig").alias("sig"), F.min("key").alias("key")))

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = list(f["text"])
            for a, b in text_runs(texts):
                yield pd.DataFrame({"key": f["key"].iloc[a:b].to_numpy(),
                                    "shingles": [s.tobytes() for s in shingle_sets(texts[a:b], size)]})

    wanted = (docs.select(F.unhex(key_text(docs[id_col], docs[text_col])).alias("key"),
                          docs[text_col].cast("string").alias("text"))
              .join(size_checked(needed.select("key")), "key").dropDuplicates(["key"]))
    return written(wanted.mapInPandas(sets, "key binary, shingles binary").join(needed, "key")
                   .select("node", "n", "sig", "shingles"))


def _side(sets: DataFrame, x: str, value: str) -> DataFrame:
    return sets.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col(value).alias(f"v_{x}"))


def verified_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold, by sequential tests and then exactly."""
    least = least_matches(percent / 100, MISS)

    def test(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                one, two = (signatures(f[c]) for c in ("v_a", "v_b"))
                yield f.iloc[surviving(one, two, least)][["a", "b"]]

    def confirm(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ok = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                  for x, y in zip(f["v_a"], f["v_b"])]
            yield f.loc[ok, ["a", "b"]]

    def both(p: DataFrame, value: str) -> DataFrame:
        return p.join(_side(sets, "b", value), "b").join(_side(sets, "a", value), "a").where(
            f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").select("a", "b", "v_a", "v_b")

    survivors = written(both(pairs, "sig").mapInPandas(test, "a binary, b binary"))
    return written(both(survivors, "shingles").mapInPandas(confirm, "a binary, b binary"))


def signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<u4").reshape(len(column), HASHES)


def closing_links(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components that still share a bucket. The nodes outside a bucket's largest
    component meet the bucket in tiles of about ``TILE`` x ``TILE`` nodes; tiles are dealt to lots of about
    ``LOT`` rows, one task call each. A tile returns only links that joined two components, so at most
    one per node."""
    placed = written(members.select("bucket", "band", "node").join(size_checked(roots), "node", "left")
                     .select("bucket", "band", "node", F.coalesce("root", "node").alias("root")))
    sizes = placed.groupBy("bucket", "root").agg(F.count("*").alias("c"))
    tiles = written(sizes.groupBy("bucket").agg(F.max(F.struct("c", "root")).alias("m"), F.sum("c").alias("all"))
                    .where("m.c < all").select("bucket", F.col("m.root").alias("main"), "all", (F.col("all") - F.col("m.c")).alias("out"))
                    .withColumns({"rows": F.ceil(F.col("out") / TILE), "cols": F.ceil(F.col("all") / TILE)}))
    lots = -(-(tiles.agg(F.sum(F.expr("all * rows + out * cols"))).first()[0] or 0) // LOT) or 1
    open_ = written(placed.join(tiles, "bucket").join(sets, "node"))
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    lot = F.pmod(F.xxhash64("bucket", "r", "c"), F.lit(lots)).alias("lot")
    columns = ["bucket", "r", "c", "node", "root", "n", "sig", "shingles"]
    others = open_.where("root <> main").withColumn("r", place("rows")).withColumn("c", every("cols"))
    bucket = open_.withColumn("c", place("cols")).withColumn("r", every("rows"))
    least = least_matches(percent / 100, MISS)

    def meet(f: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(f) and len(g):
            sides = [Side(x) for x in (f, g)]
            there = g.groupby(["bucket", "r", "c"]).indices
            main, band = f["main"].to_numpy(), f["band"].to_numpy()
            for key, rows in f.groupby(["bucket", "r", "c"]).indices.items():
                if key in there:
                    out += tile_links(*sides, rows, there[key], main[rows[0]], int(band[rows[0]]), least, percent)
        return pd.DataFrame({"a": pd.Series([o[0] for o in out], dtype=object),
                             "b": pd.Series([o[1] for o in out], dtype=object)})

    return written(others.select(lot, "main", "band", *columns).groupBy("lot").cogroup(
        bucket.select(lot, *columns).groupBy("lot")).applyInPandas(meet, "a binary, b binary").distinct())


class Side:
    """One side of a lot as arrays; shingle sets are unpacked when first needed."""

    def __init__(self, frame: pd.DataFrame):
        self.node, self.root = frame["node"].to_numpy(), frame["root"].to_numpy()
        self.n, self.sig, self.packed = frame["n"].to_numpy(), signatures(frame["sig"]), frame["shingles"].to_numpy()
        self.sets: dict[bytes, frozenset] = {}

    def shingles(self, k: int) -> frozenset:
        node = self.node[k]
        if node not in self.sets:
            self.sets[node] = frozenset(np.frombuffer(self.packed[k], np.uint64).tolist())
        return self.sets[node]


def tile_links(f: Side, g: Side, rows: np.ndarray, cols: np.ndarray, main: bytes, band: int, least: list[int],
               percent: int) -> list[tuple]:
    """Joining links of one tile. Two outside components meet once, by their order; the main one meets
    each of them. A pair is judged in the first band whose bucket it shares, on signatures and then on full
    sets, the most alike first; a pair whose components have met in the tile is skipped."""
    x = np.repeat(np.arange(len(rows)), len(cols))
    i, j = rows[x], np.tile(cols, len(rows))
    label = {r: k for k, r in enumerate(sorted({*f.root[rows], *g.root[cols]}))}
    low, high = (np.array([label[r] for r in s.root[at]]) for s, at in ((f, rows), (g, cols)))
    low, high = low[x], np.tile(high, len(rows))
    wanted = ((high == label.get(main, -1)) | (low < high)) & (low != high)
    wanted &= 100 * np.minimum(f.n[i], g.n[j]) >= percent * np.maximum(f.n[i], g.n[j])
    i, j = i[wanted], j[wanted]
    _, width = banding(percent)
    for b in range(band):
        part = slice(b * width, (b + 1) * width)
        fresh = (f.sig[i, part] != g.sig[j, part]).any(axis=1)
        i, j = i[fresh], j[fresh]
    alive = surviving(f.sig, g.sig, least, i, j)
    i, j = i[alive], j[alive]
    order = np.argsort(-(f.sig[i] == g.sig[j]).sum(axis=1), kind="stable")
    above: dict = {}

    def find(r):
        while r in above:
            r = above[r]
        return r

    out = []
    for p, q in zip(i[order].tolist(), j[order].tolist()):
        a, b = find(f.root[p]), find(g.root[q])
        if a != b:
            one, two = f.shingles(p), g.shingles(q)
            shared = len(one & two)
            if 100 * shared >= percent * (len(one) + len(two) - shared):
                above[b] = a
                out.append((f.node[p], g.node[q]))
    return out


def groups(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """Rows of ``describe`` (key, id, n) with ``root``, the component's node (null: empty set)."""
    ship_package(docs.sparkSession)
    rows = describe(docs, id_col, text_col, size)
    members = bucket_members(rows, percent)
    sets = full_sets(rows, members, docs, id_col, text_col, size)
    leaders = members.where("k = lead").select("bucket", F.col("node").alias("a"))
    pairs = written(members.where("k <> lead").join(leaders, "bucket")
                    .select("a", F.col("node").alias("b")).distinct())
    links = verified_links(pairs, sets, percent)
    roots = written(components(links))
    more = closing_links(members, roots, sets, percent)
    if not more.isEmpty():
        roots = written(components(links.unionByName(more)))
    return written(rows.select("key", "id", "n", "node").join(size_checked(roots), "node", "left")
                   .select("key", "id", "n", F.coalesce("root", "node").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                    percent: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept (the id is the component's id)."""
    rows = groups(docs, id_col, text_col, size, percent)
    least = rows.where("root is not null").groupBy("root").agg(F.min("id").alias("first"), F.count("*").alias("held"))
    # most components are one row, which is its own least; only the others are joined
    shared = written(least.where("held > 1").withColumn("shared", F.lit(True)))
    out = join_totals(rows, shared, "root", "held", rows.count()).select(
        "id", "n", F.when(F.col("shared"), F.col("first")).otherwise(F.col("id")).alias("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                         percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group: the smallest id (nulls last), then the
    smallest key; rows equal in id and text count once. Rows with empty sets all stay, but equal ones
    once."""
    rows = groups(docs, id_col, text_col, size, percent)
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("key"))
    best = written(rows.where("root is not null").groupBy("root").agg(F.min(order).alias("m"), F.count("*").alias("held"))
                   .where("held > 1").select(F.col("m.key").alias("keep"), "root", "held"))
    lost = join_totals(rows, best, "root", "held", rows.count()).where("key <> keep").select("key").distinct() \
        .withColumn("times", F.lit(0))
    again = rows.groupBy("key").agg(F.count("*").alias("times")).where("times > 1")
    # decisions only for the rows that something happens to: 0 dropped, else that many equal rows
    marks = written(lost.unionByName(again).groupBy("key").agg(F.min("times").alias("times"))
                        .select(F.col("key").alias("__key"), F.col("times").alias("__times")))
    wide = docs.withColumn("__key", F.unhex(key_text(docs[id_col], docs[text_col]))).join(
        size_checked(marks), "__key", "left")
    once = wide.where("__times > 1").dropDuplicates(["__key"])
    return wide.where("__times is null").unionByName(once).select(*[F.col(f"`{c}`") for c in docs.columns])
