"""Phrase collocation mining by top-order marginalisation.

Every word starts one window: the word and its lead columns, the next three words of its piece, padded
with '' beyond the piece's end. Only these longest windows are counted; one Spark ROLLUP over (lang, w1, w2,
w3, w4) then sums them to every shorter prefix: all occurrences of a phrase are prefixes of the windows
that start with it, so phrases of all lengths, single words and the language totals come from one table.

Windows are padded early where that provably changes no result: a phrase can only reach ``min_count`` if each
run of two and of three of its words does. Scans before count pairs, then triples of such pairs, by 64-bit
hash (an upper bound, equal hashes add up) and keep those that reach it as bits of a filter; a window ends
before a run that is not in it. A filter has ``filter_bits`` bits at most (a bounded broadcast); where more runs
are frequent it only lets more windows through. Counts are exact either way: words themselves are
compared, never hashes.

A candidate of 2 to 4 words is cut after each word but the last; the cut's score is floor(2000000 a / (l + r))
with a, l and r the counts of the candidate and its two parts; the least score, then the first cut counts.
Candidates inside a longer candidate that is at least 80 % as frequent are dropped. Products are decimals.

Scale: tasks count their own pairs and windows before anything is shuffled, so a pair, phrase or language
that holds a third of all rows is one row a task and key; texts are read in runs of ``RUN_BYTES``,
longer ones in slices. The
last ranking keeps ``top`` rows a language in every task before the shuffle.

Defined results: null text is empty; null lang is ``und``; A-Z only are lower-cased; pieces end at ``.,;:!?`` and
0x0A-0x0D, words at space and tab; repeated rows count again; ties go by count, then phrase in byte order;
an empty table gives no rows. Only the text and lang columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from slotcast.llm.common import discard, mix64, word_hashes, written
from slotcast.session import ship_package

MIN_COUNT = 30
LONGEST = 4
SCORE_SCALE = 2_000_000
COVER_PERCENT = 80
TOP = 2000
UNKNOWN = "und"
RUN_BYTES = 3_000_000
FILTER_BITS = 1 << 27
BLOCK_BITS = 16         # filter bits are gathered in blocks of 2^16
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
# FIXED VALUES: A-Z to a-z, piece ends to line feed, tab to space.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
_MARK = b" \xff "        # in no UTF-8 text
_GAP = re.compile("[ \\t.,;:!?\n-\r]")
_NEXT = re.compile("(?:[ \\t]*[^ \\t.,;:!?\n-\r]+){0,%d}" % (LONGEST - 1))


class Run:
    """Words of a run of text slices: ids into ``vocab`` (-1 at piece ends), the language of each, and whether it
    belongs to its slice (the words after it are only there to fill its last windows)."""

    def __init__(self, slices: list[tuple[str, str, str]]):
        raw = [_MARK.join((own.encode("utf-8", "replace"), more.encode("utf-8", "replace"))) if more
               else own.encode("utf-8", "replace") for own, more, _ in slices]
        joined = b"\n".join(raw + [b""]).translate(_FOLD)
        words = [w for w in joined.replace(b"\n", b" \n ").split(b" ") if w]
        coded = pa.array(words, type=pa.binary()).dictionary_encode()
        self.vocab = coded.dictionary
        ids = coded.indices.to_numpy().astype(np.int64)
        stop = ids == self.vocab.index(pa.scalar(b"\n", pa.binary())).as_py()
        last = np.cumsum([r.translate(_FOLD).count(b"\n") + 1 for r in raw])     # piece ends up to each slice's end
        text = np.searchsorted(last, np.cumsum(stop), side="right")
        mark = self.vocab.index(pa.scalar(_MARK.strip(), pa.binary())).as_py()
        marks = ids == mark if mark >= 0 else np.zeros(len(ids), dtype=bool)
        beyond = np.zeros(len(ids), dtype=bool)
        for at in np.flatnonzero(marks):
            beyond[at:np.searchsorted(text, text[at], side="right")] = True
        keep = ~marks
        self.langs = sorted({name for _, _, name in slices})
        code = {name: i for i, name in enumerate(self.langs)}
        lang = np.array([code[name] for _, _, name in slices] + [0], dtype=np.int64)[text]
        self.ids, self.lang, self.own = np.where(stop, -1, ids)[keep], lang[keep], ~beyond[keep]

    def pair_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions, 64-bit hashes) of the pairs of neighbouring words of a piece and their language."""
        at = np.flatnonzero((self.ids[:-1] >= 0) & (self.ids[1:] >= 0))
        word = _hashes(self.vocab)
        name = _hashes(pa.array([x.encode("utf-8", "replace") for x in self.langs], type=pa.binary()))
        first = mix64((word[self.ids[at]] ^ name[self.lang[at]]) * _SPREAD)
        return at, mix64((first + word[self.ids[at + 1]]) * _SPREAD)


    def triple_hashes(self, at: np.ndarray, pairs: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, 64-bit hashes) of the triples whose two pairs, at positions ``at`` with hashes ``pairs``, are linked."""
        key = np.zeros(len(self.ids) + 1, dtype=np.uint64)
        key[at] = pairs
        on = np.zeros(len(self.ids) + 1, dtype=bool)
        on[at] = linked
        at = np.flatnonzero(on[:-1] & on[1:])
        return at, mix64((key[at] ^ (key[at + 1] * _SPREAD)) * _SPREAD)


@dataclass
class Filter:
    """Bits over the top bits of 64-bit hashes."""

    bits: int
    found: np.ndarray

    def holds(self, key: np.ndarray) -> np.ndarray:
        place = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        return (self.found[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1


def _hashes(words: pa.Array) -> np.ndarray:
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
    return word_hashes(data, ends[:-1], ends[1:])


def _slices(text: str, run_bytes: int) -> Iterator[tuple[str, str]]:
    """(own, more): parts of ``run_bytes`` characters cut between words, each with the words that fill the windows
    of its last ones."""
    at = 0
    while len(text) - at > run_bytes:
        cut = _GAP.search(text, at + run_bytes)
        if not cut:
            break
        yield text[at:cut.start()], _NEXT.match(text, cut.start()).group()
        at = cut.start()
    yield text[at:], ""


def _runs(batches: Iterator[pa.RecordBatch], run_bytes: int) -> Iterator[Run]:
    """Runs of about ``run_bytes`` over the (text, lang) batches of a task."""
    run, size = [], 0
    for b in batches:
        for text, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for own, more in _slices(text or "", run_bytes):
                run.append((own, more, name))
                size += len(own)
                if size >= run_bytes:
                    yield Run(run)
                    run, size = [], 0
    if run:
        yield Run(run)


def frequent_runs(rows: DataFrame, min_count: int, filter_bits: int, run_bytes: int, pairs: Filter | None = None) -> Filter:
    """Filter of the pairs whose hash reaches ``min_count``, or, given that, of the triples of such pairs."""
    shared = rows.sparkSession.sparkContext.broadcast(pairs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, run_bytes):
            at, key = run.pair_hashes()
            if shared.value is not None:
                at, key = run.triple_hashes(at, key, shared.value.holds(key))
            key, n = np.unique(key[run.own[at]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

    counted = rows.mapInArrow(count, "key long, n long").repartition("key").groupBy("key").agg(F.sum("n").alias("n"))
    kept = written(counted.where(F.col("n") >= min_count).select("key"))
    size = 1 << BLOCK_BITS
    while size < min(filter_bits, 16 * kept.count()):
        size *= 2
    bits = size.bit_length() - 1
    place = F.shiftrightunsigned("key", 64 - bits)

    def pack(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            blocks = [np.packbits(np.bincount(p, minlength=1 << BLOCK_BITS) > 0).tobytes() for p in
                      map(np.asarray, b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(blocks, type=pa.binary())], ["block", "bits"])

    blocks = kept.select(place.alias("p")).distinct().groupBy(F.shiftright("p", BLOCK_BITS).alias("block")).agg(
        F.collect_list((F.col("p") % (1 << BLOCK_BITS)).cast("int")).alias("p"))      # 2^16 places a block at most
    found = np.zeros(size // 8, dtype=np.uint8)
    step = (1 << BLOCK_BITS) // 8
    for r in blocks.mapInArrow(pack, "block long, bits binary").toLocalIterator():        # filter_bits / 8 bytes at most
        found[r["block"] * step:(r["block"] + 1) * step] = np.frombuffer(r["bits"], dtype=np.uint8)
    discard(kept)
    return Filter(bits, found)


def count_windows(rows: DataFrame, pairs: Filter, triples: Filter, run_bytes: int) -> DataFrame:
    """(lang, w1, w2, w3, w4, n): padded longest windows, counted run by run."""
    shared = rows.sparkSession.sparkContext.broadcast((pairs, triples))
    columns = ["lang"] + [f"w{k + 1}" for k in range(LONGEST)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, triples = shared.value
        for run in _runs(batches, run_bytes):
            at, key = run.pair_hashes()
            linked = pairs.holds(key)
            third, both = run.triple_hashes(at, key, linked)
            follows = np.zeros((2, len(run.ids) + LONGEST), dtype=bool)     # a pair, a triple starts here
            follows[0, at[linked]] = True
            follows[1, third[triples.holds(both)]] = True
            padded = np.concatenate((run.ids, np.full(LONGEST, -1)))
            start = np.flatnonzero((run.ids >= 0) & run.own)
            if not len(start):
                continue
            # lead columns: the next word while every pair and triple up to it is in its filter
            lead, on = [run.lang[start], run.ids[start]], np.ones(len(start), dtype=bool)
            for k in range(1, LONGEST):
                on = on & follows[0, start + k - 1]
                if k > 1:
                    on = on & follows[1, start + k - 2]
                lead.append(np.where(on, padded[start + k], -1))
            # group by column after column; codes stay below the number of windows
            code = np.zeros(len(start), dtype=np.int64)
            for column in lead:
                code = np.unique(code * (len(run.vocab) + 2) + column + 1, return_inverse=True)[1]
            _, first, n = np.unique(code, return_index=True, return_counts=True)
            words = pa.concat_arrays([run.vocab, pa.array([b""], type=pa.binary())])
            out = [pa.array(run.langs).take(pa.array(lead[0][first]))]
            for column in lead[1:]:
                some = column[first]
                out.append(words.take(pa.array(np.where(some < 0, len(words) - 1, some))).cast(pa.string()))
            yield from pa.Table.from_arrays(out + [pa.array(n.astype(np.int64))], columns + ["n"]).to_batches(64_000)

    return rows.mapInArrow(count, ", ".join(f"{c} string" for c in columns) + ", n long")


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                  filter_bits: int = FILTER_BITS, run_bytes: int = RUN_BYTES) -> DataFrame:
    """(lang, k, phrase, f): every phrase of k = 1 to 4 words that occurs ``min_count`` times or more, words joined by
    spaces; k = 0 holds each language's number of words. One ROLLUP over the windows; written once."""
    ship_package(docs.sparkSession)
    rows = docs.select(docs[text_col].cast("string").alias("text"), F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang"))
    pairs = frequent_runs(rows, min_count, filter_bits, run_bytes)
    triples = frequent_runs(rows, min_count, filter_bits, run_bytes, pairs)
    windows = count_windows(rows, pairs, triples, run_bytes)
    words = [f"w{k + 1}" for k in range(LONGEST)]
    rolled = windows.rollup("lang", *words).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    # grouping_id has one bit for every column summed away: 2^j - 1 for a prefix of 4 - j words
    k = F.lit(LONGEST) - F.bit_count("g")
    rolled = rolled.withColumn("k", k.cast("int")).where("k >= 0")
    last = F.when(F.col("k") == 0, F.lit("-"))
    for i, w in enumerate(words):
        last = last.when(F.col("k") == i + 1, F.col(w))
    return written(rolled.where((last != "") & ((F.col("f") >= min_count) | (F.col("k") == 0))).select(
        "lang", "k", F.concat_ws(" ", *words).alias("phrase"), "f"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 top: int = TOP, filter_bits: int = FILTER_BITS, run_bytes: int = RUN_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases."""
    counts = phrase_counts(docs, text_col, lang_col, min_count, filter_bits, run_bytes)
    word = F.split("phrase", " ", -1)
    joined = lambda start, n: F.array_join(F.slice(word, start, n), " ")
    candidates = counts.where("k >= 2").withColumnRenamed("f", "a")
    parts = counts.where(F.col("k").between(1, LONGEST - 1))
    cuts = candidates.select("lang", "k", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", joined(F.lit(1), F.col("cut")).alias("head"), joined(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"))
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    score = F.expr(f"CAST({SCORE_SCALE} AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(20, 0)) "
                   "div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("b"))

    inside = candidates.where("k > 2").select(
        "lang", "k", "phrase", "a", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size")).select(
        "lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("start")).select(
        "lang", joined(F.col("start"), F.col("size")).alias("phrase"), "a")
    covers = inside.groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    big = lambda c: F.col(c).cast("decimal(20,0)")
    left = scored.join(covers, ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (big("cover") * 100 < big("a") * COVER_PERCENT))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.select("lang", "phrase", "a", "b.l", "b.r", "b.score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(min_count: int = MIN_COUNT, top: int = TOP) -> str:
    """DuckDB SQL of ``op13``: plain n-grams of every length."""
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, array_to_string(list_slice(w, i, i + {k - 1}), ' ') AS phrase FROM p, "
        f"LATERAL (SELECT unnest(range(1, len(w) - {k - 2})) AS i)" for k in range(1, LONGEST + 1))
    return f"""
WITH p AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang,
           unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents)),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY 1),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {min_count}),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
s AS (
  SELECT c.lang, c.phrase, c.a, min((CAST(CAST({SCORE_SCALE} AS HUGEINT) * c.a // (x.f + y.f) AS BIGINT), cut, x.f, y.f)) AS b
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(w, 1, cut), ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(w, cut + 1, c.k), ' ') GROUP BY ALL),
i AS (
  SELECT lang, sub, max(a) AS cover FROM (
    SELECT lang, a, array_to_string(list_slice(w, j, j + z - 1), ' ') AS sub FROM (
      SELECT *, unnest(range(1, k - z + 2)) AS j FROM (SELECT *, unnest(range(2, k)) AS z FROM c))) GROUP BY ALL),
r AS (
  SELECT s.lang, s.phrase, s.a, b[3] AS l, b[4] AS r, b[1] AS score,
         row_number() OVER (PARTITION BY s.lang ORDER BY b[1] DESC, s.a DESC, s.phrase) AS rank
  FROM s LEFT JOIN i ON i.lang = s.lang AND i.sub = s.phrase WHERE cover IS NULL OR 100 * cover < {COVER_PERCENT} * s.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= {top}"""
