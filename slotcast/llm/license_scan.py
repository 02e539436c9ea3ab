"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Texts and templates are normalised alike (ASCII letters lower-cased, other ASCII but digits as a
space, runs of spaces as one; offsets into the UTF-8 text are kept). Character ``K``-grams are hashed
and winnowed: in every ``W`` neighbouring hashes the smallest are fingerprints, so any shared run of
K + W - 1 characters shares one. The templates' fingerprints form an inverted index. Hits of a text
on neighbouring diagonals of a template make a candidate region, in which a banded local alignment
(match 1, mismatch and gap -2) gives the matched characters, and again before and after what it
found. Pieces of one template that follow each other in text and template, at most the template's
length apart, are chained: an occurrence is a chain, its coverage the part of the template's
characters matched in any of its pieces. Text inserted or omitted between pieces costs nothing; where
both differ, another name may stand there ("Mozilla Public" for "Apache"), so each replaced character
costs a mismatch. Chains whose coverage less that cost is at least ``min_coverage`` are licenses, all
others are reported beside them as partial, with their coverage.

Templates are a parameter with a checked size (``MAX_TEMPLATE_CHARS``); texts are never shuffled.

Defined results: null and empty texts hold nothing; templates shorter than a fingerprint run are
refused; each occurrence is reported, also of the same template, ordered by start, then name; whole
texts of any length are scanned; repeated rows give equal rows. Only the id and text columns are read.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from slotcast.llm.common import mix64, text_runs
from slotcast.session import ship_package

K = 10
W = 6
BAND = 12               # diagonals beyond the hits on either side
MISS = 2                # cost of a mismatch or gap; a match gives 1
MAX_TEMPLATE_CHARS = 8 << 20
MEMO = 20_000
ENTRY = (("licenses", 1), ("coverage", 2), ("starts", 0), ("ends", 3), ("spans", 4))     # column, place in Index.scan

# Wording of public license notices.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                      "and associated documentation files (the \"Software\"), to deal in the Software without "
                      "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
                      "distribute, sublicense, and/or sell copies of the Software",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the "
                         "License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                      "provided that the following conditions are met",
    "all-rights-reserved": "All rights reserved.",
}

_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[65:91] += 32
for _b in range(128):
    if not chr(_b).isalnum():
        _TABLE[_b] = 32


def normalise(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Normalised bytes and the offset of each in the raw text."""
    buf = _TABLE[np.frombuffer(raw, dtype=np.uint8)]
    space = buf == 32
    keep = np.flatnonzero(~(space & np.concatenate(([True], space[:-1]))))
    return buf[keep], keep


def gram_hash(buf: np.ndarray) -> np.ndarray:
    """Hash of the K bytes from each position on."""
    n = len(buf) - K + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    eight = np.ascontiguousarray(np.lib.stride_tricks.as_strided(buf, (len(buf) - 7, 8), (1, 1))).view("<u8").ravel()
    return mix64(eight[:n] * np.uint64(0x9E3779B97F4A7C15) ^ eight[K - 8:K - 8 + n])


def selected(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the positions ``at`` are fingerprints: the smallest hash of some window of W."""
    if len(h) < W:
        return h[at] == h.min() if len(h) else np.zeros(0, dtype=bool)
    padded = np.concatenate((h, np.full(W, np.iinfo(np.uint64).max, dtype=np.uint64)))
    out = np.zeros(len(at), dtype=bool)
    for back in range(W):
        start = np.clip(at - back, 0, len(h) - W)
        window = padded[start[:, None] + np.arange(W)[None, :]]
        out |= (window.min(axis=1) == h[at]) & (start <= at) & (at < start + W)
    return out


class Index:
    """Inverted index from fingerprint to (template, position)."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = sorted(templates)
        if sum(map(len, templates.values())) > MAX_TEMPLATE_CHARS:
            raise ValueError("templates are larger than the broadcast bound; scan them in several runs")
        self.patterns, keys, owner, place = [], [], [], []
        for i, name in enumerate(self.names):
            buf = normalise(templates[name].encode())[0]
            buf = buf[:-1] if len(buf) and buf[-1] == 32 else buf
            if len(buf) < K + W - 1:
                raise ValueError(f"template {name!r} is shorter than {K + W - 1} normalised characters")
            h = gram_hash(buf)
            at = np.flatnonzero(selected(h, np.arange(len(h))))
            self.patterns.append(buf)
            keys.append(h[at])
            owner.append(np.full(len(at), i))
            place.append(at)
        every = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.keys, self.first = np.unique(every[order], return_index=True)
        self.first = np.append(self.first, len(every))
        self.owner = np.concatenate(owner)[order] if owner else np.zeros(0, int)
        self.place = np.concatenate(place)[order] if place else np.zeros(0, int)
        self.seen = np.zeros(1 << 16, dtype=bool)
        self.seen[(self.keys >> np.uint64(48)).astype(np.int64)] = True
        self.memo: dict = {}

    def candidates(self, buf: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(template, lowest diagonal, highest diagonal) of the regions with hits."""
        h = gram_hash(buf)
        at = np.flatnonzero(self.seen[(h >> np.uint64(48)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return
        found = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        hit = self.keys[found] == h[at]
        at, found = at[hit], found[hit]
        ok = selected(h, at)
        at, found = at[ok], found[ok]
        n = self.first[found + 1] - self.first[found]
        post = np.repeat(self.first[found] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        owner, diagonal = self.owner[post], np.repeat(at, n) - self.place[post]
        for t in np.unique(owner):
            d = np.unique(diagonal[owner == t])
            cut = np.flatnonzero(np.diff(d) > BAND)
            for lo, hi in zip(np.append(0, cut + 1), np.append(cut, len(d) - 1)):
                yield int(t), int(d[lo]), int(d[hi])

    def scan(self, text: str | None) -> list[tuple[int, str, float, int, list[int], float]]:
        """(start, template, coverage, end, spans, coverage less the cost of replaced characters) of every
        occurrence, whole or partial; starts, ends and the spans' alternating starts and ends are byte offsets
        into the text."""
        raw = (text or "").encode("utf-8", "replace")
        buf, offset = normalise(raw)
        pieces: dict[int, set] = {}
        for t, lo, hi in self.candidates(buf):
            pattern = self.patterns[t]
            a = max(0, lo - BAND)
            region = buf[a:max(a, min(len(buf), hi + len(pattern) + BAND))]
            key = (t, lo - a, hi - lo, region.tobytes())
            if key not in self.memo:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[key] = stretches(pattern, region, lo - a - BAND, hi - lo + 2 * BAND + 1)
            pieces.setdefault(t, set()).update((a + x, a + y, hit) for x, y, hit in self.memo[key])
        out = []
        for t, some in pieces.items():
            m = len(self.patterns[t])
            for chain in chained(sorted(some), m):
                matched = len(set().union(*(hit for _, _, hit in chain)))
                spans = [v for x, y, _ in chain for v in (int(offset[x]), int(offset[y - 1]) + 1)]
                replaced = sum(max(0, min(q[0] - p[1], q[2][0] - p[2][-1] - 1)) for p, q in zip(chain, chain[1:]))
                out.append((spans[0], self.names[t], matched / m, spans[-1], spans, (matched - MISS * replaced) / m))
        return sorted(out)


def stretches(pattern: np.ndarray, text: np.ndarray, low: int, width: int) -> list[tuple[int, int, tuple]]:
    """(start, end, matched pattern positions) of the best alignment on the diagonals, then of those before and
    after it that match at least the run that a fingerprint is sure to mark."""
    out = []
    parts = [(0, len(pattern), 0, len(text), 1)]
    while parts:
        i, j, a, b, least = parts.pop()
        x, y, hit = trace(pattern[i:j], text[a:b], low - a + i, width)
        if y <= x or len(hit) < least:
            continue
        out.append((a + x, a + y, tuple(i + h for h in hit)))
        for part in ((i, i + hit[0], a, a + x), (i + hit[-1] + 1, j, a + y, b)):
            if min(part[1] - part[0], part[3] - part[2]) >= K + W - 1:
                parts.append((*part, K + W - 1))
    return out


def chained(pieces: list[tuple[int, int, tuple]], m: int) -> list[list[tuple[int, int, tuple]]]:
    """Pieces (start, end, matched positions), in text order, of a template of m characters as disjoint chains,
    the fullest first. Neighbours in a chain may overlap by what an alignment can run on by chance; a piece
    inside another of an earlier chain is the same text and left out."""
    best, back = [], []
    for q, (x, y, hit) in enumerate(pieces):
        value, link = len(hit), -1
        for p in range(q - 1, -1, -1):
            u, v, other = pieces[p]
            if x - u > 3 * m:
                break
            if u < x and v < y and x - v <= m and other[0] < hit[0] and other[-1] < hit[-1]:
                overlap = max(0, v - x, other[-1] + 1 - hit[0])
                if overlap <= min(BAND, len(other) - K, len(hit) - K):
                    total = best[p] + len(hit) - overlap - MISS
                    if total > value:
                        value, link = total, p
        best.append(value)
        back.append(link)
    out, used = [], set()
    taken: list[tuple[int, int]] = []
    for q in sorted(range(len(pieces)), key=lambda k: (-best[k], k)):
        chain = []
        while q >= 0 and q not in used:
            chain.append(pieces[q])
            used.add(q)
            q = back[q]
        chain = [c for c in chain[::-1] if not within(c, taken)]
        if chain:
            out.append(chain)
            for x, y, _ in chain:
                insort(taken, (x, y))
    return out


def within(piece: tuple[int, int, tuple], taken: list[tuple[int, int]]) -> bool:
    """Whether the piece lies in the taken span that starts last before it (spans in order of their starts)."""
    k = bisect_right(taken, (piece[0], 1 << 62)) - 1
    return k >= 0 and taken[k][1] >= piece[1]


def trace(pattern: np.ndarray, text: np.ndarray, low: int, width: int) -> tuple[int, int, list[int]]:
    """Banded local alignment over the diagonals low .. low + width - 1 (text minus pattern position):
    (start, end in the text, matched pattern positions) of the best-scoring stretch."""
    m, column = len(pattern), np.arange(width)
    cells = np.zeros((m + 1, width), dtype=np.int32)    # score after pattern[:i], text up to i + low + d
    padded = np.full(m + width, 256, dtype=np.int32)    # text position p is at p - low
    src = np.arange(m + width) + low
    ok = (src >= 0) & (src < len(text))
    padded[ok] = text[src[ok]]
    for i in range(m):
        here = padded[i:i + width]
        step = np.where(here == pattern[i], 1, -MISS)
        new = cells[i] + step
        new[:-1] = np.maximum(new[:-1], cells[i, 1:] - MISS)
        new = np.maximum(np.maximum.accumulate(new + MISS * column) - MISS * column, 0)
        new[here == 256] = 0
        cells[i + 1] = new
    i, d = np.unravel_index(int(cells.argmax()), cells.shape)
    end, matched = i + low + d, []
    while cells[i, d] > 0:
        score = cells[i, d]
        same = i > 0 and padded[i - 1 + d] == pattern[i - 1]
        if i > 0 and score == cells[i - 1, d] + (1 if same else -MISS):
            i -= 1
            if same:
                matched.append(int(i))
        elif d > 0 and score == cells[i, d - 1] - MISS:
            d -= 1
        elif i > 0 and d + 1 < width and score == cells[i - 1, d + 1] - MISS:
            i, d = i - 1, d + 1
        else:
            break
    return int(i + low + d), int(end), matched[::-1]


def align(pattern: np.ndarray, text: np.ndarray, low: int, width: int) -> tuple[int, int, int]:
    """(matched characters, start, end in the text) of ``trace``."""
    start, end, matched = trace(pattern, text, low, width)
    return len(matched), start, end


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text", min_coverage: float = 0.8) -> DataFrame:
    """One row per input row: id, licensed, and the arrays licenses, coverage, starts, ends, spans with an entry
    per occurrence (byte offsets into the UTF-8 text; spans: starts and ends of its pieces in turn), then the same
    arrays as partial_* for what does not reach ``min_coverage``. Only the first make a text licensed."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(Index(templates))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for f in frames:
            texts = [t if isinstance(t, str) else None for t in f["__text"]]
            for a, b in text_runs(texts):
                found = [index.scan(t) for t in texts[a:b]]
                out = {"__id": f["__id"].iloc[a:b].to_numpy()}
                for prefix, whole in (("", True), ("partial_", False)):
                    some = [[x for x in g if (x[5] >= min_coverage) == whole] for g in found]
                    out |= {prefix + c: [[x[k] for x in g] for g in some] for c, k in ENTRY}
                yield pd.DataFrame(out)

    kinds = {"licenses": T.StringType(), "coverage": T.DoubleType(), "spans": T.ArrayType(T.LongType())}
    columns = [(prefix + c, kinds.get(c, T.LongType())) for prefix in ("", "partial_") for c, _ in ENTRY]
    schema = T.StructType([T.StructField("__id", docs.schema[id_col].dataType),
                           *[T.StructField(c, T.ArrayType(kind)) for c, kind in columns]])
    rows = docs.select(docs[id_col].alias("__id"), docs[text_col].cast("string").alias("__text"))
    return rows.mapInPandas(run, schema).select(
        F.col("__id").alias(id_col), (F.size("licenses") > 0).alias("licensed"), *[c for c, _ in columns])
