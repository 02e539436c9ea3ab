"""op3: every occurrence found with its span; alignment equal to the full table; odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SMALL
from slotcast.llm import license_scan as ls, queries

MID = "/root/testdata/sf0.01"


def full_score(pattern, text):
    """Best local alignment score from the whole table."""
    best, row = 0, [0] * (len(text) + 1)
    for c in pattern:
        new = [0]
        for j, t in enumerate(text):
            new.append(max(0, row[j] + (1 if c == t else -2), row[j + 1] - 2, new[j] - 2))
        row = new
        best = max(best, max(row))
    return best


def test_alignment_equals_full_table():
    rng = random.Random(2)
    for _ in range(60):
        p = bytes(rng.choice(b"abcd ") for _ in range(rng.randint(15, 60)))
        q = bytearray(p)
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(q))
            q[at:at + rng.randint(0, 1)] = bytes([rng.choice(b"abcde")]) * rng.randint(0, 2)
        t = bytes(rng.choice(b"wxyz") for _ in range(10)) + bytes(q) + b"wwww"
        a, b = np.frombuffer(p, np.uint8), np.frombuffer(t, np.uint8)
        matched, x, y = ls.align(a, b, -len(p), len(p) + len(t))
        assert 0 <= x < y <= len(t) and matched <= min(len(p), y - x)
        score = full_score(p, t)
        assert score <= matched <= len(p)
        assert full_score(p, t[x:y]) == score
        narrow, u, v = ls.align(a, b, 10 - ls.BAND, 2 * ls.BAND + 1)
        assert (narrow, u, v) == (matched, x, y)


def test_winnowing_guarantee():
    rng = np.random.default_rng(3)
    for _ in range(100):
        shared = rng.integers(97, 105, ls.K + ls.W - 1).astype(np.uint8)
        marks = []
        for _ in range(2):
            buf = np.concatenate((rng.integers(97, 123, 50).astype(np.uint8), shared, rng.integers(97, 123, 40).astype(np.uint8)))
            h = ls.gram_hash(buf)
            at = np.arange(len(h))
            windows = np.lib.stride_tricks.sliding_window_view(h, ls.W).min(axis=1)
            mine = ls.selected(h, at)
            assert (mine == np.array([any(windows[s] == h[p] for s in range(max(0, p - ls.W + 1), min(p, len(h) - ls.W) + 1))
                                      for p in at])).all()
            marks.append(set(h[mine].tolist()))
        assert marks[0] & marks[1]


def test_query_finds_every_notice(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    rows = queries.op3_license_scan(spark, MID).collect()
    assert len(rows) == len(docs)
    planted = 0
    for r in rows:
        raw = docs[r.doc_id].encode()
        for name in ("mit-notice", "apache-2.0-notice", "gpl-3.0-notice", "cc-by-nc-4.0-notice", "all-rights-reserved"):
            needle = ls.TEMPLATES[name].rstrip(".").encode()
            where = [i for i in range(len(raw)) if raw.startswith(needle, i)] if needle in raw else []
            got = {s: e for n, s, e in zip(r.licenses, r.starts, r.ends) if n == name}
            pattern = ls.normalise(ls.TEMPLATES[name].encode())[0].tobytes().rstrip()
            assert set(where) <= set(got)
            assert all(got[s] == s + len(needle) for s in where)
            for s, e in got.items():        # other spellings (case, punctuation) also align
                part = ls.normalise(raw[s:e])[0].tobytes().rstrip()
                assert full_score(pattern, part) >= 0.4 * len(pattern)
            planted += len(where)
        assert r.licensed == bool(r.licenses)
    assert planted > 10


def test_edited_wrapped_and_odd_rows(spark):
    mit = ls.TEMPLATES["mit-permission"]
    wrapped = "// " + mit.replace(" ", "  \n * ").replace("restriction", "restrictions").upper()
    half = mit[:len(mit) // 2]
    rows = [(1, "pre " + wrapped + " post"), (2, half), (3, None), (4, ""), (None, "Released under the MIT License."),
            (5, "Released under the MIT License.\n" * 2000), (6, "x " * 200_000 + "ALL RIGHTS   RESERVED"), (7, "reserved all"),
            (7, "reserved all"), (8, "é" * 50 + " Licensed under CC BY-NC 4.0.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licenses", F.lit(1))
    got = {r.doc_id: r for r in ls.scan_licenses(df).collect()}
    assert got[1].licenses == ["mit-permission"] and got[1].coverage[0] > 0.97
    assert got[2].licenses == got[3].licenses == got[4].licenses == got[7].licenses == []
    assert got[None].licenses == ["mit-notice"] and got[6].licenses == ["all-rights-reserved"]
    assert len(got[5].licenses) == 2000 and got[5].starts == [32 * i for i in range(2000)]
    assert got[8].licenses == ["cc-by-nc-4.0-notice"] and got[8].starts == [101]
    assert ls.scan_licenses(df, min_coverage=0.4).where("doc_id = 2").first().licenses == ["mit-permission"]
    assert ls.scan_licenses(df.limit(0)).count() == 0
    assert ls.scan_licenses(df, {}).where("licensed").count() == 0


def test_pieces_of_a_template_are_summed(spark):
    mit = ls.TEMPLATES["mit-permission"]
    at = int(len(mit) * 0.68)
    inserted = mit[:at] + " [as changed by the vendor] " + mit[at:]
    omitted = mit[:150] + mit[190:]
    replaced = mit[:220] + "q7" * 20 + mit[260:]
    rows = [(1, "pre " + inserted + " post"), (2, omitted), (3, replaced), (4, mit[:len(mit) // 2]),
            (5, "Released under the terms of the MIT License."), (6, "Licensed under the Apache License 2.0"),
            (7, mit[at:] + " " + mit[:at]), (8, inserted + "\n" + inserted),
            (9, "Licensed under the Mozilla Public License, version 2.0"), (10, ls.TEMPLATES["gpl-3.0-notice"])]
    got = {r.doc_id: r for r in ls.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].licenses == ["mit-permission"] and got[1].coverage[0] > 0.98 and got[1].licensed
    assert got[1].starts == [4] and got[1].ends == [4 + len(inserted)] and len(got[1].spans[0]) == 4
    assert got[2].licenses == ["mit-permission"] and 0.8 < got[2].coverage[0] < 0.9
    assert got[3].licenses == [] and 0.8 < max(got[3].partial_coverage) < 0.9
    assert got[9].licenses == [] and "apache-2.0-notice" in got[9].partial_licenses
    assert got[10].licenses == ["gpl-3.0-notice"]
    assert got[5].licenses == ["mit-notice"] and got[5].spans == [[0, 19, 27, 43]]
    for i, name, low in ((4, "mit-permission", 0.45), (6, "apache-2.0-notice", 0.7)):
        r = got[i]
        assert not r.licensed and r.licenses == []
        assert low < dict(zip(r.partial_licenses, r.partial_coverage))[name] < 0.8
    assert got[7].licenses == [] and sorted(round(c, 1) for n, c in zip(got[7].partial_licenses, got[7].partial_coverage)
                                            if n == "mit-permission" and c > 0.1) == [0.3, 0.7]
    assert got[8].licenses == ["mit-permission"] * 2 and got[8].starts == [0, len(inserted) + 1]
