"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from slotcast.session import ensure_checkpoint_dir

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Words are maximal runs of bytes other than ASCII white space (0x20, 0x09-0x0D).
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
SPACE_BYTES = np.zeros(256, dtype=bool)
SPACE_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (vectorised)."""
    x = x ^ (x >> np.uint64(31))
    x = x * _MIX
    return x ^ (x >> np.uint64(29))


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (start, end) of the words in a UTF-8 buffer."""
    space = SPACE_BYTES[buf]
    edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, from eight-byte blocks: each word is read as little-endian
    blocks, the last one zero-padded, and folded with its length."""
    n = ends - starts
    h = mix64(n.astype(np.uint64) * _MULT)
    if not len(n):
        return h
    padded = np.concatenate((buf, np.zeros(8, dtype=np.uint8)))
    blocks = np.lib.stride_tricks.as_strided(padded, (len(buf) + 1, 8), (1, 1))
    live = np.arange(len(n))
    at = starts.copy()
    while len(live):
        block = np.ascontiguousarray(blocks[at]).view("<u8").ravel()
        left = ends[live] - at
        keep = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64))
        h[live] = mix64((h[live] ^ (block & keep)) * _MULT)
        more = left > 8
        live, at = live[more], at[more] + 8
    return h


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` word hashes (order matters)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        h = (h ^ words[k:k + n]) * _MULT
        h ^= h >> np.uint64(32)
    return mix64(h)


def crc_fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (null id: null)."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(parts))


def id_field(df: DataFrame, name: str):
    """The input's own field of the id column, for output schemas."""
    return df.schema[name]


def size_checked(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """A written table as the small side of a join: marked for broadcast only when its counted
    rows are within ``max_rows``; a larger one stays a plain (shuffled, skew-splitting) join."""
    return F.broadcast(df) if df.count() <= max_rows else df


HOT_SHARE = 1000


def join_totals(rows: DataFrame, totals: DataFrame, key: str, n: str, size: int) -> DataFrame:
    """``rows`` (written, ``size`` of them) left-joined with ``totals``, one row per value of ``key`` with its number of
    rows in ``n``. Keys that hold more than 1 / ``HOT_SHARE`` of the rows, so ``HOT_SHARE`` of them at most, are
    broadcast; only the others are shuffled, and rows with a null key are not joined at all."""
    values = [c for c in totals.columns if c not in (key, n)]
    much = F.col(n) * HOT_SHARE > size
    hot = totals.where(much).select(key, F.lit(True).alias("__hot"), *values)
    near = rows.where(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left")
    far = near.where("__hot is null").drop("__hot", *values).join(totals.where(~much).drop(n), key, "left")
    return (near.where("__hot").drop("__hot").unionByName(far)
            .unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True))


def text_runs(texts: list, limit: int = 4_000_000):
    """Index ranges of consecutive texts of about ``limit`` characters together."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t is not None else 0
        if size >= limit or i == len(texts) - 1:
            yield start, i + 1
            start, size = i + 1, 0


def hashed_words(texts: list, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a run of texts, and the bounds of each text's words (len(texts) + 1).
    Null texts have no words. ``lower`` folds A-Z only."""
    return hashed_bytes([b"" if t is None else t.encode("utf-8", "replace") for t in texts], lower)[:2]


def hashed_bytes(raw: list, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Word hashes of a run of UTF-8 texts, the bounds of each text's words (len(raw) + 1), the byte
    spans of the words in the joined run, and that run."""
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    joined = b" ".join(raw)
    buf = np.frombuffer(joined, dtype=np.uint8)
    if lower:
        buf = np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)
    starts, ends = word_spans(buf)
    edges = np.concatenate((np.cumsum(sizes + 1) - sizes - 1, [len(buf) + 1]))
    return word_hashes(buf, starts, ends), np.searchsorted(starts, edges), starts, ends, joined


def written(df: DataFrame) -> DataFrame:
    """``cut_lineage`` for big intermediates: compact files, and the shuffles of the write are removed
    from the executors' disks when it ends (the written table no longer needs them)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/slotcast-tables/{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.parquet(path)
    out.written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete ``written`` tables that every later step has already been written from."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.written_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
