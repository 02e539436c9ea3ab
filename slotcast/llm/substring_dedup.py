"""Substring dedup with an FM-index per shard.

A *window* is ``words`` consecutive words; a window is repeated if its words also start in a document
with a smaller id. Documents are cut into *runs* of windows that share their seed: the smallest hash
among a window's ``SEED``-word grams. Equal windows have equal seeds, so a shard that holds all runs
of its seeds decides them alone, and shards grow with the text, not with pairs of documents.

1. Seeds that occur in one document only hold no repeated window; their runs go no further.
2. The remaining runs are taken as byte strings and equal ones are merged (smallest and largest id),
   so copies are indexed and searched once. Runs of a seed with more than ``HOT`` occurrences are cut
   into single windows that are dealt by their own hash, so no seed fills a shard.
3. Each shard builds an FM-index over its distinct runs and streams them through it by backward
   search; matching statistics that reach ``words`` give the interval of the window's occurrences
   and with it the smallest document that holds it.
4. Every occurrence of a run compares its document with those smallest ones; the windows found
   are gathered by document, and the words they cover are removed. Judged on the input throughout.

Words are compared by 64-bit hashes. Written tables carry the steps and go when the next is written;
nothing passes the driver, and joins are plain ones that Spark splits where a key is hot.

Defined results: null texts have no words; rows with null ids keep all their words and are no source of
repeats; rows of equal id are one document (equal rows get equal results); texts shorter than a window keep
all words; repeats inside one document stay; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from slotcast.llm.common import discard, gram_hashes, hashed_bytes, text_runs, written
from slotcast.llm.fm_index import FMIndex
from slotcast.session import ship_package

SEED = 4
HOT = 2000
RUN = 64                    # windows in a run at most
SHARD_WORDS = 250_000


def _raw(texts) -> list[bytes]:
    return [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in texts]


def window_seeds(words: np.ndarray, edges: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Seed of the window that starts at each word, and whether a whole window of one text does."""
    n = len(words)
    if n < size:
        return np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool)
    grams = gram_hashes(words, min(SEED, size))
    count = n - size + 1
    low = grams[:count].copy()
    for i in range(1, size - min(SEED, size) + 1):
        np.minimum(low, grams[i:i + count], out=low)
    low = np.concatenate((low, np.zeros(size - 1, dtype=np.uint64)))
    end = np.repeat(edges[1:], np.diff(edges))
    return low, np.arange(n) + size <= end


def runs(words: np.ndarray, edges: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of windows, seed) of the runs of a chunk of texts."""
    low, whole = window_seeds(words, edges, size)
    if not whole.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    cut = np.ones(len(words), dtype=bool)
    cut[1:] = (low[1:] != low[:-1]) | (whole[1:] != whole[:-1])
    cut[edges[:-1][edges[:-1] < len(words)]] = True
    begin = np.flatnonzero(cut)
    count = np.diff(np.append(begin, len(words)))
    ok = whole[begin]
    begin, count = begin[ok], count[ok]
    parts = -(-count // RUN)
    first = np.repeat(begin, parts)
    step = (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * RUN
    return first + step, np.minimum(RUN, np.repeat(count, parts) - step), low[first]


def run_table(rows: DataFrame, size: int) -> DataFrame:
    """Written table of all runs: seed, doc, sub, place (first word and windows packed)."""
    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            raw = _raw(f["text"])
            for a, b in text_runs(raw):
                words, edges, *_ = hashed_bytes(raw[a:b], lower=False)
                first, count, seed = runs(words, edges, size)
                owner = np.searchsorted(edges, first, side="right") - 1
                yield pd.DataFrame({"seed": seed.view(np.int64), "doc": f["doc"].to_numpy()[a:b][owner],
                                    "sub": f["sub"].to_numpy()[a:b][owner],
                                    "place": (first - edges[owner]) * 128 + count})

    return written(rows.mapInPandas(find, "seed long, doc long, sub int, place long"))


def pieces(rows: DataFrame, table: DataFrame, size: int) -> DataFrame:
    """Written table of the runs that share a seed with another document, with their bytes: doc, sub, first,
    route, body, sid. Runs of hot seeds come as single windows."""
    shared = written(table.groupBy("seed").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("c"))
                     .where("a < b").select("seed", (F.col("c") > HOT).alias("hot")))
    places = written(table.join(shared, "seed").groupBy("doc", "sub").agg(
        F.collect_list(F.struct((F.col("place") * 2 + F.col("hot").cast("int")).alias("p"), "seed")).alias("x"))
        .select("doc", "sub", F.col("x.p").alias("p"), F.col("x.seed").alias("seed")))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            raw = _raw(f["text"])
            for a, b in text_runs(raw):
                words, edges, starts, ends, joined = hashed_bytes(raw[a:b], lower=False)
                lists, routes = f["p"].to_numpy()[a:b], f["seed"].to_numpy()[a:b]
                sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
                p, owner = np.concatenate(lists), np.repeat(np.arange(len(lists)), sizes)
                route, hot, count, first = np.concatenate(routes), p & 1, (p >> 1) % 128, (p >> 1) // 128
                copies = np.where(hot == 1, count, 1)       # a hot run as its single windows
                step = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                owner, first, hot = (np.repeat(x, copies) for x in (owner, first, hot))
                count, route, first = np.where(hot == 1, 1, np.repeat(count, copies)), np.repeat(route, copies), first + step
                at = edges[owner] + first
                if (hot == 1).any():
                    own = gram_hashes(words, size).view(np.int64)
                    route = np.where(hot == 1, own[np.where(hot == 1, at, 0)], route)
                lo, hi = starts[at].tolist(), ends[at + count + size - 2].tolist()
                yield pd.DataFrame({"doc": f["doc"].to_numpy()[a:b][owner], "sub": f["sub"].to_numpy()[a:b][owner],
                                    "first": first, "route": route, "n": count + size - 1,
                                    "body": [joined[x:y] for x, y in zip(lo, hi)]})

    discard(table, shared)
    texts = rows.join(places, ["doc", "sub"]).select("doc", "sub", "text", "p", "seed")
    found = written(texts.mapInPandas(cut, "doc long, sub int, first long, route long, n int, body binary")
                    .withColumn("sid", F.unhex(F.md5("body"))))
    discard(places)
    return found


def shard_matches(found: DataFrame, size: int) -> DataFrame:
    """Written table (sid, least): for each distinct run, the smallest document of each of its windows."""
    distinct = written(found.groupBy("sid").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.first("route").alias("route"),
                                                F.first("n").alias("n"), F.first("body").alias("body")))
    total = distinct.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_WORDS))

    def match(f: pd.DataFrame) -> pd.DataFrame:
        words, edges, *_ = hashed_bytes([bytes(b) for b in f["body"]], lower=False)
        _, symbol = np.unique(words, return_inverse=True)
        sizes = np.diff(edges)
        owner = np.repeat(np.arange(len(f)), sizes)
        lo, hi = f["lo"].to_numpy(), f["hi"].to_numpy()
        place = np.arange(len(words)) + owner               # one separator after every run
        text = np.zeros(len(words) + len(f), dtype=np.int64)
        text[place] = symbol + 1
        docs = np.full(len(text), np.iinfo(np.int64).max)
        docs[place] = lo[owner]
        length, least = FMIndex(text, docs, size).matching_statistics(symbol + 1, edges)
        # a run matters if some window's smallest document is below some document that holds the run
        hit = (length == size) & (least < hi[owner])
        keep = np.flatnonzero(np.bincount(owner[hit], minlength=len(f)))
        firsts = [least[edges[i]:edges[i + 1] - size + 1] for i in keep]
        return pd.DataFrame({"sid": f["sid"].to_numpy()[keep], "least": pd.Series(firsts, dtype=object)})

    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)))
    least = written(dealt.groupBy("shard").applyInPandas(match, "sid binary, least array<long>"))
    discard(distinct)
    return least


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 13) -> DataFrame:
    """Written table (doc, sub, windows): the first words of the repeated windows of each document that has any.
    ``sub`` tells texts of equal id apart."""
    ship_package(docs.sparkSession)
    rows = _rows(docs, id_col, text_col).where("doc is not null and text is not null")
    found = pieces(rows, run_table(rows, words), words)
    least = shard_matches(found, words)
    hits = (found.select("sid", "doc", "sub", "first").join(least, "sid")
            .withColumn("w", F.expr("filter(transform(least, (x, i) -> if(x < doc, first + i, null)), x -> x is not null)"))
            .where(F.size("w") > 0))
    windows = written(hits.groupBy("doc", "sub").agg(F.flatten(F.collect_list("w")).alias("windows")))
    discard(found, least)
    return windows


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = docs[text_col].cast("string")
    return docs.select(docs[id_col].cast("long").alias("doc"), F.hash(text).alias("sub"), text.alias("text"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 13) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept (the remaining words joined by one space)."""
    windows = repeated_windows(docs, id_col, text_col, words)

    def strip(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            raw, out = _raw(f["text"]), []
            for text, w in zip(raw, f["windows"]):
                own = text.split()          # bytes: splits at 0x20 and 0x09-0x0D only
                if w is None or not len(w):
                    out.append((len(own), 0, b" ".join(own).decode("utf-8", "replace")))
                    continue
                first = np.asarray(w, dtype=np.int64)
                mark = np.zeros(len(own) + 1, dtype=np.int64)
                np.add.at(mark, first, 1)
                np.add.at(mark, first + words, -1)
                gone = np.cumsum(mark)[:-1] > 0
                kept = [x for x, g in zip(own, gone.tolist()) if not g]
                out.append((len(own), int(gone.sum()), b" ".join(kept).decode("utf-8", "replace")))
            yield pd.DataFrame({"doc": f["doc"], "n_words": [o[0] for o in out], "n_removed": [o[1] for o in out],
                                "kept": [o[2] for o in out]})

    rows = _rows(docs, id_col, text_col).join(windows, ["doc", "sub"], "left")
    schema = T.StructType([T.StructField("doc", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return rows.select("doc", "text", "windows").mapInPandas(strip, schema).select(
        F.col("doc").alias(id_col), "n_words", "n_removed", "kept")
