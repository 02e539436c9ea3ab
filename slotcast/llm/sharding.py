"""Sharding by extendible hashing.

Every row has a 60-bit key hash. A shard is a hash prefix: the directory starts with the empty
prefix, and only buckets whose bytes exceed the limit are split on another bit, until every
shard fits. Splits are decided on histograms of fixed width (``STEP`` bits a round), so a round
costs one partial aggregation; rows of buckets that are settled take no part in the next round.

Defined results: the hash covers id and text, so only rows equal in both share it. A bucket with
one distinct hash is not split further; if it is over the limit, its rows are equal and are dealt
into overflow pages (``page`` 0, 1, ...) that each fit, or hold one row where a single row is
over the limit. Null ids and texts hash as a fixed marker and null text has 0 bytes; an empty
table gives no shards. Other columns pass untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotcast.session import cut_lineage

BITS = 60
STEP = 12
MARK = "\x00"


def key_text(id_col: Column, text: Column) -> Column:
    """md5 over id and text; equal only for rows equal in both."""
    return F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(":"),
                          F.md5(F.coalesce(text.cast("string"), F.lit(MARK)))))


def hash60(text: Column) -> Column:
    """The first 60 bits of the md5 of a string."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """Prefix of each row of ``rows`` (columns ``__h``, ``__bytes`` and any others): the rows with
    ``shard_depth`` and ``shard_prefix``. Rows are written once per round that is needed."""
    settled, pending, depth = [], rows, 0
    while True:
        top = min(BITS, depth + STEP)
        fine = (pending.groupBy(F.shiftright("__h", BITS - top).alias("__fine"))
                .agg(F.sum("__bytes").alias("b"), F.min("__h").alias("lo"), F.max("__h").alias("hi")))
        nodes = (fine.withColumn("d", F.explode(F.sequence(F.lit(depth), F.lit(top))))
                 .groupBy("d", F.expr(f"shiftright(__fine, {top} - d)").alias("p"))
                 .agg(F.sum("b").alias("b"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
        fits = nodes.where((F.col("b") <= limit) | (F.col("lo") == F.col("hi"))).select("d", "p")
        # a shard fits and its parent does not; it stands for all fine prefixes below it
        parents = fits.select((F.col("d") + 1).alias("d"), F.explode(F.array(F.col("p") * 2, F.col("p") * 2 + 1)).alias("p"))
        chosen = fits.join(parents, ["d", "p"], "left_anti").select(
            F.col("d").alias("shard_depth"),
            F.explode(F.expr(f"sequence(shiftleft(p, {top} - d), shiftleft(p + 1, {top} - d) - 1)")).alias("__fine"))
        marked = cut_lineage(
            pending.withColumn("__fine", F.shiftright("__h", BITS - top)).join(chosen, "__fine", "left").drop("__fine"))
        settled.append(marked.where("shard_depth is not null"))
        pending = marked.where("shard_depth is null").drop("shard_depth")
        if top == BITS or pending.isEmpty():
            break
        depth = top
    done = reduce(DataFrame.unionByName, settled)
    return done.withColumn("shard_prefix", F.expr(f"shiftright(__h, {BITS} - shard_depth)"))


def shard_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, hash and bytes of every row."""
    return docs.select(docs[id_col].alias("__id"), hash60(key_text(docs[id_col], docs[text_col])).alias("__h"),
                       F.coalesce(F.octet_length(docs[text_col].cast("string")), F.lit(0)).cast("long").alias("__bytes"))


def with_pages(rows: DataFrame, limit: int) -> DataFrame:
    """``page`` for the rows of over-full shards. The rows of one hash are equal, so any order deals them alike: each
    partition numbers its own, from the sum of the counts of the partitions before it."""
    rows = cut_lineage(rows.withColumn("__part", F.spark_partition_id()))
    counts = rows.groupBy("__h", "__part").agg(F.count("*").alias("__c"))
    before = Window.partitionBy("__h").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("__h", "__part", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__h", "__part").orderBy(F.lit(0))) - 1
    fits = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("__bytes")))
    return (rows.withColumn("__own", own).join(counts, ["__h", "__part"])
            .withColumn("page", F.floor((F.col("__before") + F.col("__own")) / fits).cast("long"))
            .drop("__own", "__before", "__part"))


def assign(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, shard_depth, shard_prefix, page."""
    rows = directory(cut_lineage(shard_keys(docs, id_col, text_col)), limit)
    shard = ["shard_depth", "shard_prefix"]
    full = (rows.groupBy(*shard).agg(F.sum("__bytes").alias("shard_bytes"), F.count("*").alias("shard_rows")))
    over = full.where((F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)).select(*shard)
    rest = rows.join(over, shard, "left_anti").withColumn("page", F.lit(0).cast("long"))
    paged = with_pages(rows.join(over, shard, "left_semi"), limit)
    return rest.unionByName(paged.select(rest.columns)).select(
        F.col("__id").alias(id_col), F.col("__bytes").alias("n_bytes"), *shard, "page", F.col("__h").alias("key_hash"))


def shard_name(depth: Column, prefix: Column) -> Column:
    """Readable shard id: the prefix bits after the depth."""
    return F.concat(F.lpad(depth.cast("string"), 2, "0"), F.lit("-"),
                    F.expr("lpad(conv(cast(shard_prefix as string), 10, 16), 15, '0')"))


def attach(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text",
           out_col: str = "shard_id", max_directory: int = 1_000_000) -> DataFrame:
    """``docs`` with the shard of every row in ``out_col``. A directory of at most ``max_directory`` shards is broadcast,
    one level at a time, so texts are not shuffled; a larger one is joined by key hash. Rows of an over-full shard,
    which are equal, get the shard of their overflow page: its name ends in ``-`` and the page."""
    rows = directory(cut_lineage(shard_keys(docs, id_col, text_col)), limit)
    shards = cut_lineage(rows.groupBy("shard_depth", "shard_prefix").agg(F.count("*").alias("n"), F.sum("__bytes").alias("b")))
    name = shard_name(F.col("shard_depth"), F.col("shard_prefix"))
    out = docs.withColumn("__h", hash60(key_text(docs[id_col], docs[text_col])))
    keep = [F.col(f"`{c}`") for c in docs.columns if c != out_col]
    if shards.count() > max_directory:
        by_key = rows.select("__h", name.alias("__shard")).distinct()
        return _paged(out.join(by_key, "__h"), shards, name, limit, docs[text_col], keep, "__shard", out_col)
    found = F.lit(None).cast("string")
    for d in [r[0] for r in shards.select("shard_depth").distinct().orderBy("shard_depth").collect()]:   # <= 61
        level = shards.where(F.col("shard_depth") == d).select(F.col("shard_prefix").alias(f"__p{d}"), name.alias(f"__n{d}"))
        out = out.withColumn(f"__p{d}", F.shiftright("__h", BITS - d)).join(F.broadcast(level), f"__p{d}", "left")
        found = F.coalesce(found, F.col(f"__n{d}"))
    return _paged(out.withColumn("__shard", found), shards, name, limit, docs[text_col], keep, "__shard", out_col)


def _paged(out: DataFrame, shards: DataFrame, name: Column, limit: int, text: Column, keep: list[Column], shard: str,
           out_col: str) -> DataFrame:
    """The columns ``keep`` and the shard in ``out_col``, with the page where a shard of equal rows is over-full."""
    over = shards.where((F.col("b") > limit) & (F.col("n") > 1)).select(name.alias(shard))
    if over.isEmpty():
        return out.select(*keep, F.col(shard).alias(out_col))
    size = F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).alias("__bytes")
    cols = [*keep, F.col("__h"), F.col(shard), size]
    rest = out.join(over, shard, "left_anti").select(*keep, F.col(shard).alias(out_col))
    equal = with_pages(out.join(over, shard, "left_semi").select(*cols), limit)
    paged = F.concat(F.col(shard), F.lit("-"), F.lpad(F.col("page").cast("string"), 6, "0"))
    return rest.unionByName(equal.select(*[F.col(f"`{c}`") for c in rest.columns if c != out_col], paged.alias(out_col)))


def write_shards(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the shards as Parquet folders ``shard_id=...`` under ``path``; rows meet by shard, and
    a shard is at most ``limit`` bytes, so no task holds more than its share."""
    out = attach(docs, limit, id_col, text_col)
    out.repartition("shard_id").write.mode("overwrite").partitionBy("shard_id").parquet(path)


def oracle(limit: int) -> str:
    """DuckDB SQL of ``op1``: every prefix of every length, the shortest that fits."""
    return f"""
WITH r AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(strlen(text), 0) AS b,
         CAST('0x' || substr(md5(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':'
              || md5(coalesce(text, chr(0))))), 1, 15) AS BIGINT) AS h
  FROM documents),
n AS (
  SELECT d, h >> ({BITS} - d) AS p, sum(b) AS nb, count(*) AS nr, min(h) = max(h) AS alone
  FROM r, (SELECT CAST(range AS INTEGER) AS d FROM range(0, {BITS + 1})) GROUP BY 1, 2),
c AS (
  SELECT r.doc_id, r.b, r.h, min(n.d) AS d
  FROM r JOIN n ON n.p = r.h >> ({BITS} - n.d) WHERE n.nb <= {limit} OR n.alone GROUP BY 1, 2, 3, rid),
g AS (
  SELECT c.doc_id, CAST(c.b AS BIGINT) AS n_bytes, c.d AS shard_depth, n.p AS shard_prefix,
         CASE WHEN n.nb > {limit} AND n.nr > 1 THEN CAST((row_number() OVER (PARTITION BY c.h) - 1) // greatest(1, {limit} // c.b) AS BIGINT)
              ELSE 0 END AS page
  FROM c JOIN n ON n.d = c.d AND n.p = c.h >> ({BITS} - c.d))
SELECT *, CAST(sum(n_bytes) OVER w AS BIGINT) AS shard_bytes, count(*) OVER w AS shard_rows
FROM g WINDOW w AS (PARTITION BY shard_depth, shard_prefix, page)"""
