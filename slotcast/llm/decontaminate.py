"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts and benchmark items are normalised (lower case, white space runs as one space). Items are cut
into overlapping segments of ``SEGMENT`` and of ``PART`` characters (shorter items stay whole); a
verbatim passage of ``PART + STRIDE - 1`` characters holds a whole segment wherever it starts. Each
segment of m characters has an edit budget k of a tenth of m, lowered where the q-gram bound would
be empty. An occurrence with at most k edits shares at least m + 1 - q (k + 1) character q-grams
with its segment, all within 2 k + 1 neighbouring diagonals. Shared q-grams are counted in
overlapping diagonal bands of twice that width, first for all segments of one length in an item
together, then, where these reach the bound, for each segment. Regions that hold a segment verbatim are
settled by a plain search; for the others bit vectors bound the distance (of segments over 64 characters from
their halves), and a banded alignment computes it exactly in the regions that remain. A text is contaminated
if any segment is within its budget.

The benchmark is read in blocks of ``BLOCK_CHARS`` characters, whose indexes are bounded broadcasts; texts are
searched for ``PASS_BLOCKS`` blocks at a time, and a larger benchmark takes several passes over written
tables. Texts are never shuffled. Memory is bounded whatever a text holds: long texts are searched in
overlapping pieces, and positions whose grams have very many postings in smaller ranges of positions and
items.

Defined results: null and empty texts match nothing; items of fewer than ``SHORT`` normalised characters match
verbatim between word boundaries only; null items and items of fewer than ``min_chars`` (a word or two) are
left out; items equal after
normalisation all are reported, repeated items once; whole texts of any length are searched; repeated rows give equal
rows; without items nothing matches. Other columns pass untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from slotcast.session import cut_lineage, ship_package

Q = 8
RATE = 0.1
SEGMENT = 128
PART = 64
STRIDE = 16
MIN_SHARED = 4
SHORT = 30
MIN_CHARS = 11
BLOCK_CHARS = 4 << 20
PASS_BLOCKS = 4
ITEM_CHARS = 4096       # items are indexed in overlapping parts of this length
CHUNK_CHARS = 2_000_000
POSTINGS = 1_000_000    # (text position, item position) pairs counted at a time
COUNTERS = 22           # bits of the counting filter before the exact count
BATCH = 256
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = 12             # alignment cells hold cost << _SHIFT | start

MATCH_TYPE = T.StructType([
    T.StructField("item_ids", T.ArrayType(T.LongType())), T.StructField("starts", T.ArrayType(T.IntegerType())),
    T.StructField("ends", T.ArrayType(T.IntegerType())), T.StructField("edits", T.ArrayType(T.IntegerType()))])


def normalise(text: str) -> str:
    return " ".join(text.replace("\x00", " ").lower().split())


def edit_budget(m: int) -> int:
    """Edits allowed in m characters; negative: too short for the q-gram bound."""
    most = (m + 1 - MIN_SHARED) // Q - 1
    return min(0 if m < SHORT else int(RATE * m), most)


def layout(n: int) -> dict[int, list[int]]:
    """Starts of the segments of an item of n characters, by segment length."""
    out = {}
    for length, stride in ((SEGMENT, SEGMENT // 2), (PART, STRIDE)):
        m = min(length, n)
        out[m] = [*range(0, n - m, stride), n - m]
    return out


def segments(text: str) -> list[str]:
    return [text[s:s + m] for m, starts in layout(len(text)).items() for s in starts]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")


def grams(points: np.ndarray) -> np.ndarray:
    """Every run of Q characters as one number (characters folded to a byte each: equal grams stay
    equal, and the alignment decides on the characters themselves)."""
    small = ((points ^ (points >> 8)) & 255).astype(np.uint8)
    n = len(small) - Q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return np.ascontiguousarray(np.lib.stride_tricks.as_strided(small, (n, Q), (1, 1))).view("<u8").ravel()


@dataclass
class Index:
    """Inverted q-gram index over the items of one block; a group is the segments of one length in an item."""

    items: np.ndarray           # item id of each segment
    patterns: list              # code points of each segment
    start: np.ndarray           # of each segment in its item
    group: np.ndarray           # of each segment, ascending; starts ascend within a group
    length: np.ndarray          # segment length of each group
    budget: np.ndarray          # of each group
    need: np.ndarray            # of each group
    keys: np.ndarray            # sorted distinct grams
    first: np.ndarray           # postings of keys[i] are at first[i]:first[i + 1]
    owner: np.ndarray           # group of each posting
    offset: np.ndarray          # item offset of each posting
    bits: int
    seen: np.ndarray            # prefilter over hashed grams


def build_index(items: list[tuple[int, str]]) -> Index:
    """Index of (item id, normalised text) pairs; equal segments of an item are kept once."""
    ids, patterns, start, group, length, each = [], [], [], [], [], []
    for i, t in dict.fromkeys(items):
        whole = codes(t)
        seen: set = set()
        for at in range(0, max(1, len(whole) - SEGMENT), ITEM_CHARS - SEGMENT):
            points = whole[at:at + ITEM_CHARS]
            for m, starts in layout(len(points)).items():
                if edit_budget(m) < 0:
                    continue
                distinct: dict = {}
                for s in starts:
                    distinct.setdefault(points[s:s + m].tobytes(), s)
                distinct = {k: s for k, s in distinct.items() if k not in seen}
                seen |= distinct.keys()
                if not distinct:
                    continue
                ids += [i] * len(distinct)
                patterns += [points[s:s + m] for s in distinct.values()]
                start += distinct.values()
                group += [len(length)] * len(distinct)
                length.append(m)
                each.append(grams(points))
    budget = np.array([edit_budget(m) for m in length], dtype=np.int64)
    sizes = np.array([len(g) for g in each], dtype=np.int64)
    every = np.concatenate(each) if each else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(each)), sizes)
    off = np.arange(len(every)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.argsort(every, kind="stable")
    # of equal grams within k + 1 places of an item the first and the last stand for all: k + 1 diagonals that hold
    # another of them hold one of these (a text position counts once)
    block = off // (budget[owner] + 1) if len(owner) else off
    same = (every[order][1:] == every[order][:-1]) & (owner[order][1:] == owner[order][:-1]) & (block[order][1:] == block[order][:-1])
    inner = np.concatenate(([False], same)) & np.concatenate((same, [False]))
    order = order[~inner]
    keys, first = np.unique(every[order], return_index=True)
    bits = int(np.clip(np.ceil(np.log2(max(1, len(keys)))) + 4, 16, 26))
    seen = np.zeros(1 << bits, dtype=bool)
    seen[((keys * _SPREAD) >> np.uint64(64 - bits)).astype(np.int64)] = True
    long = np.array(length, dtype=np.int64)
    return Index(np.array(ids, dtype=np.int64), patterns, np.array(start, dtype=np.int64), np.array(group, dtype=np.int64),
                 long, budget, long + 1 - Q * (budget + 1), keys, np.append(first, len(order)), owner[order], off[order],
                 bits, seen)


def read_blocks(benchmark: DataFrame, item_col: str, text_col: str, min_chars: int) -> Iterator[Index]:
    """Indexes over blocks of the benchmark, in item order."""
    block, size = [], 0
    rows = benchmark.select(benchmark[item_col].cast("long").alias("i"), benchmark[text_col].cast("string").alias("t"))
    for r in rows.where("i is not null and t is not null").distinct().orderBy("i", "t").toLocalIterator():
        text = normalise(r["t"])
        if len(text) < min_chars:
            continue
        block.append((r["i"], text))
        size += len(text)
        if size >= BLOCK_CHARS:
            yield build_index(block)
            block, size = [], 0
    if block:
        yield build_index(block)


def _regions(index: Index, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, band) pairs whose diagonal band shares enough q-grams; ``band`` covers the diagonals
    (text minus item position) from band * w on, two widths w = 2 k + 1 wide."""
    g = grams(points)
    at = np.flatnonzero(index.seen[((g * _SPREAD) >> np.uint64(64 - index.bits)).astype(np.int64)])
    found = np.searchsorted(index.keys, g[at])
    found[found == len(index.keys)] = 0
    hit = index.keys[found] == g[at]
    at, found = at[hit], found[hit]
    groups = len(index.length)
    place = np.repeat(np.arange(len(index.keys)), np.diff(index.first)) * groups + index.owner      # ascending
    reach = int((index.length + 4 * index.budget).max(initial=0)) + 2 * Q       # text that a segment's bands cover
    pairs: list = []
    todo = [(0, len(at), 0, groups)]
    while todo:
        a, b, low, high = todo.pop()
        first = np.searchsorted(place, found[a:b] * groups + low)
        n = np.searchsorted(place, found[a:b] * groups + high) - first
        if n.sum() > POSTINGS:
            mid = (at[a] + at[b - 1]) // 2      # halves of the positions that overlap by a segment's reach
            left, right = int(np.searchsorted(at, mid + reach)), int(np.searchsorted(at, mid))
            if left - a < 0.75 * (b - a) and b - right < 0.75 * (b - a):
                todo += [(a, left, low, high), (right, b, low, high)]
                continue
            if high - low > 1:
                todo += [(a, b, low, (low + high) // 2), (a, b, (low + high) // 2, high)]
                continue
        post = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pairs.append(_banded(index, np.repeat(at[a:b], n), index.owner[post], index.offset[post]))
    if not pairs:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    both = np.unique(np.concatenate(pairs, axis=1), axis=1) if len(pairs) > 1 else pairs[0]
    return both[0], both[1]


def _banded(index: Index, at: np.ndarray, owner: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """(segment, band) pairs with enough different text positions among (text position, group, item offset)."""
    band = (at - offset) // (2 * index.budget[owner] + 1)
    span, shift = np.int64(1 << 40), np.int64(1 << 20)      # bands left of the first text are negative
    key = np.concatenate((owner * span + band + shift, owner * span + band + shift - 1))
    # most bands hold few grams: a filter of hashed counters, never below the true count, drops them unsorted
    slot = ((key.view(np.uint64) * _SPREAD) >> np.uint64(64 - COUNTERS)).astype(np.int64)
    much = np.bincount(slot, minlength=1 << COUNTERS)[slot] >= np.concatenate((index.need[owner],) * 2)
    half = len(owner)
    place = np.flatnonzero(much)
    key, place = key[place], place % half if half else place
    at, owner, offset = at[place], owner[place], offset[place]

    def enough(key: np.ndarray, at: np.ndarray, need: np.ndarray) -> np.ndarray:
        """Rows whose key has ``need`` different positions or more."""
        order = np.lexsort((at, key))
        k, p = key[order], at[order]
        fresh = np.concatenate(([True], (k[1:] != k[:-1]) | (p[1:] != p[:-1]))) if len(k) else np.zeros(0, dtype=bool)
        start = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, dtype=np.int64)
        count = np.add.reduceat(fresh.astype(np.int64), start) if len(start) else start
        out = np.zeros(len(key), dtype=bool)
        out[order] = np.repeat(count, np.diff(np.append(start, len(k)))) >= need[order]
        return out

    keep = enough(key, at, index.need[owner])
    key, at, owner, offset = key[keep], at[keep], owner[keep], offset[keep]
    order = index.group * span + index.start
    w = 2 * index.budget[owner] + 1     # the first or last of equal grams may stand for one up to w away
    low = np.searchsorted(order, owner * span + np.maximum(offset - index.length[owner] + Q - w, 0))
    n = np.searchsorted(order, owner * span + offset + w, side="right") - low
    seg = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
    key = seg * span + np.repeat(key % span, n)
    keep = enough(key, np.repeat(at, n), index.need[index.group[seg]])
    # k edits shift an occurrence by k diagonals at most: the shared grams lie on k + 1 neighbouring ones
    key, diagonal, seg = key[keep], np.repeat(at - offset, n)[keep], seg[keep]
    rank = np.unique(key, return_inverse=True)[1] if len(key) else key
    place = rank * span + diagonal + shift * shift
    order = np.argsort(place, kind="stable")
    place, group = place[order], index.group[seg[order]]
    held = np.searchsorted(place, place + index.budget[group] + 1) - np.arange(len(place))
    key = np.unique(key[order][held >= index.need[group]])
    return np.stack((key // span, key % span - shift))


def distances(patterns: list[np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Lower bound (exact but for characters folded to a byte each) of the edit distance of each pattern
    of up to 64 characters to any substring of its text, by Myers' bit vectors."""
    c, one = len(patterns), np.uint64(1)
    rows, last = np.arange(c), np.array([len(p) - 1 for p in patterns], dtype=np.uint64)
    mask = np.zeros((c, 257), dtype=np.uint64)
    p = np.full((c, max(map(len, patterns))), 256, dtype=np.int64)
    t = np.full((c, max(map(len, texts))), 256, dtype=np.int64)
    for i, (a, b) in enumerate(zip(patterns, texts)):
        p[i, :len(a)], t[i, :len(b)] = (a ^ (a >> 8)) & 255, (b ^ (b >> 8)) & 255
    for i in range(p.shape[1]):
        mask[rows, p[:, i]] |= one << np.uint64(i)
    mask[:, 256] = 0
    up, down = np.full(c, ~np.uint64(0)), np.zeros(c, dtype=np.uint64)
    score = last.astype(np.int64) + 1
    best = score.copy()
    for j in range(t.shape[1]):
        same = mask[rows, t[:, j]]
        across = (((same & up) + up) ^ up) | same
        more, less = down | ~(across | up), up & across
        score += ((more >> last) & one).astype(np.int64) - ((less >> last) & one).astype(np.int64)
        np.minimum(best, score, out=best)
        more, less, vertical = more << one, less << one, same | down
        up, down = less | ~(vertical | more), more & vertical
    return best


def align(patterns: list[np.ndarray], texts: list[np.ndarray], width: int, pad: int) -> list[tuple[int, int, int]]:
    """Banded alignment of each pattern inside its text: (edits, start, end). Column d of row i
    stands for i + d - pad consumed text positions; starts and ends in the text are free."""
    c, m, width = len(patterns), max(map(len, patterns)), width + pad
    p = np.full((c, m), 0xFFFFFFFE, dtype=np.uint32)
    t = np.full((c, m + width), 0xFFFFFFFF, dtype=np.uint32)
    for i, (a, b) in enumerate(zip(patterns, texts)):
        p[i, :len(a)], t[i, pad:pad + len(b)] = a, b[:m + width - pad]
    one, beyond = 1 << _SHIFT, np.int32(1 << 29)
    column = np.arange(width, dtype=np.int32)
    limits = np.array([len(b) for b in texts])[:, None]
    lengths = np.array([len(a) for a in patterns])

    def inside(cell: np.ndarray, i: int) -> np.ndarray:
        used = (column + i - pad)[None, :]
        return np.where((used >= 0) & (used <= limits), cell, beyond)

    cell = inside(np.tile(column - pad, (c, 1)), 0)
    out: list = [None] * c
    for i in range(m + 1):
        for j in np.flatnonzero(lengths == i):
            d = int(np.argmin(cell[j]))
            out[j] = (int(cell[j, d]) >> _SHIFT, int(cell[j, d]) & (one - 1), i + d - pad)
        if i == m:
            break
        new = cell + (t[:, i:i + width] != p[:, i:i + 1]) * np.int32(one)
        new[:, :-1] = np.minimum(new[:, :-1], cell[:, 1:] + one)
        cell = inside(np.minimum.accumulate(new - column * one, axis=1) + column * one, i + 1)
    return out


def _verbatim(pattern: np.ndarray, text: np.ndarray) -> int:
    """First place of ``pattern`` in ``text``, or -1."""
    raw, want, at = text.tobytes(), pattern.tobytes(), -1
    while True:
        at = raw.find(want, at + 1)
        if at < 0 or at % 4 == 0:
            return at // 4 if at >= 0 else -1


def _take(best: dict, index: Index, s: int, edits: int, start: int, end: int, text: str) -> None:
    """Keep a match if it is its item's best; short items match between word boundaries only."""
    m, item = len(index.patterns[s]), int(index.items[s])
    if m < SHORT and (text[max(start - 1, 0):start].isalnum() or text[end:end + 1].isalnum()):
        return
    new = (edits, -m, start, end)
    if item not in best or new < best[item]:
        best[item] = new


def _search(index: Index, texts: list[str]) -> list[list[tuple[int, int, int, int, int]]]:
    """Per normalised text the (item id, start, end, edits, segment length) of its matches, one per item: the one
    with the fewest edits, then of the longest segment, then the first."""
    best: list[dict] = [{} for _ in texts]
    if not len(index.items) or not texts:
        return [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    points = codes("\x00".join(texts) + "\x00")
    seg, band = _regions(index, points)
    jobs, last = [], (-1, 0)
    for s, b in zip(seg.tolist(), band.tolist()):
        if last == (s, b - 1):      # two neighbouring bands are one region
            last = (-1, 0)
            continue
        last = (s, b)
        k, m, x = int(index.budget[index.group[s]]), len(index.patterns[s]), int(index.start[s])
        w = 2 * k + 1
        lo, hi = b * w + x - k, (b + 3) * w + x + m + k
        d = max(0, int(np.searchsorted(begin, lo, side="right")) - 1)
        while d < len(texts) and begin[d] < hi:
            x, y = max(lo, int(begin[d])), min(hi, int(begin[d] + sizes[d]))
            if y - x >= m - k:
                jobs.append((y - x - m + k + 1, s, d, x, y))
            d += 1
    found = lambda s, d, x, edits, start, end: _take(best[d], index, s, edits, int(x - begin[d]) + start, int(x - begin[d]) + end, texts[d])
    left = []
    for job in jobs:
        _, s, d, x, y = job
        pattern = index.patterns[s]
        at = _verbatim(pattern, points[x:y])
        if at >= 0:
            found(s, d, x, 0, at, at + len(pattern))
        elif index.budget[index.group[s]]:
            left.append(job)
    left.sort()
    jobs = []
    for i in range(0, len(left), 8 * BATCH):
        some = left[i:i + 8 * BATCH]
        # a longer segment's distance is at least the sum of its parts'
        parts = [(j, k) for j, job in enumerate(some) for k in range(0, len(index.patterns[job[1]]), PART)]
        bound = np.zeros(len(some), dtype=np.int64)
        np.add.at(bound, [j for j, _ in parts], distances([index.patterns[some[j][1]][k:k + PART] for j, k in parts],
                                                          [points[some[j][3]:some[j][4]] for j, _ in parts]))
        jobs += [j for j, e in zip(some, bound.tolist()) if e <= index.budget[index.group[j[1]]]]
    for i in range(0, len(jobs), BATCH):
        some = jobs[i:i + BATCH]
        pad = max(int(index.budget[index.group[j[1]]]) for j in some)
        got = align([index.patterns[j[1]] for j in some], [points[j[3]:j[4]] for j in some], some[-1][0] + pad, pad)
        for (_, s, d, x, _), (edits, start, end) in zip(some, got):
            if edits <= index.budget[index.group[s]]:
                found(s, d, x, edits, start, end)
    return [[(i, x, y, e, -m) for i, (e, m, x, y) in sorted(b.items())] for b in best]


def _runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK_CHARS or i == len(texts) - 1:
            yield start, i + 1
            start, size = i + 1, 0


def search(index: Index, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
    """Per normalised text, of any length, the (item id, start, end, edits) of its matches, one per item: run by run,
    long texts in pieces that overlap by more than any match."""
    reach = int((index.length + 2 * index.budget).max(initial=0)) + 2
    pieces, owner, start = [], [], []
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - reach), CHUNK_CHARS - reach):
            pieces.append(t[at:at + CHUNK_CHARS])
            owner.append(i)
            start.append(at)
    best: list[dict] = [{} for _ in texts]
    for a, b in _runs(pieces):
        for j, found in zip(range(a, b), _search(index, pieces[a:b])):
            for item, x, y, edits, m in found:
                new = (edits, -m, x + start[j], y + start[j])
                if item not in best[owner[j]] or new < best[owner[j]][item]:
                    best[owner[j]][item] = new
    return [[(i, x, y, e) for i, (e, _, x, y) in sorted(b.items())] for b in best]


def match_column(docs: DataFrame, text: Column, indexes: list[Index]) -> Column:
    """Struct column of arrays item_ids, starts, ends, edits: the items of ``indexes`` found in ``text`` (offsets in the
    normalised text, one entry per item)."""
    spark = docs.sparkSession
    ship_package(spark)

    def matcher(index: Index):
        shared = spark.sparkContext.broadcast(index)

        @F.pandas_udf(MATCH_TYPE)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = search(shared.value, [normalise(t) if isinstance(t, str) else "" for t in batch])
                yield pd.DataFrame({c: [[x[k] for x in f] for f in found]
                                    for k, c in enumerate(("item_ids", "starts", "ends", "edits"))})

        return run(text.cast("string"))

    parts = [matcher(index) for index in indexes]
    if not parts:
        return F.from_json(F.lit('{"item_ids":[],"starts":[],"ends":[],"edits":[]}'), MATCH_TYPE)
    if len(parts) == 1:
        return parts[0]
    return F.struct(*[F.concat(*[p[f.name] for p in parts]).alias(f.name) for f in MATCH_TYPE.fields])


def _passes(benchmark: DataFrame, item_col: str, text_col: str, min_chars: int) -> Iterator[list[Index]]:
    """Indexes by ``PASS_BLOCKS`` blocks; one empty pass for a benchmark without items."""
    some, any_ = [], False
    for index in read_blocks(benchmark, item_col, text_col, min_chars):
        some.append(index)
        if len(some) == PASS_BLOCKS:
            yield some
            some, any_ = [], True
    if some or not any_:
        yield some


def find_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per input row: id, contaminated, item_ids, starts, ends, edits."""
    rows, before = docs.select(docs[id_col].alias("__id"), docs[text_col].alias("__text")), None
    for some in _passes(benchmark, item_col, item_text, min_chars):
        rows = rows if before is None else cut_lineage(rows)
        m = match_column(rows, rows["__text"], some)
        if before is not None:
            m = F.struct(*[F.concat(F.col(f"m.{f.name}"), m[f.name]).alias(f.name) for f in MATCH_TYPE.fields])
        rows = rows.select("__id", "__text", m.alias("m"))
        before = rows
    return rows.select(F.col("__id").alias(id_col), (F.size("m.item_ids") > 0).alias("contaminated"), "m.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark item is found."""
    passes = 0
    for some in _passes(benchmark, item_col, item_text, min_chars):
        docs = docs if passes == 0 else cut_lineage(docs)
        m = match_column(docs, docs[text_col], some)
        docs = docs.where(F.size(m["item_ids"]) == 0)
        passes += 1
    return docs
