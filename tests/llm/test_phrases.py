"""op13: its SQL (test_shards_mixing runs it on the given table), and a plain version on odd rows."""

import random
import re
from collections import Counter, defaultdict

import pytest

from slotcast.llm import phrases as ph

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_count, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        rows = []
        for p, a in cand.items():
            score, _, l, r = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def corpus():
    rng = random.Random(2)
    words = ["the", "The", "a", "of", "né", "x\x0by", "q.r", "\x1c", "\xa0", "ß", "𝄞𝄞", "u-u", "~", "''", "\xff"]
    rows = []
    for i in range(300):
        n = rng.choice([0, 1, 3, 40, 400])
        text = "".join(rng.choice(words) + rng.choice([" "] * 8 + ["\t", ". ", "\r\n", "  "]) for _ in range(n))
        if i % 3 == 0:
            text += " new york city council met" * rng.choice([1, 3])
        rows.append((None if i % 50 == 7 else text, ["en", "fr", None, ""][i % 4]))
    return rows + [("same words here again", "en")] * 40 + [("one " * 3000, "fr"), ("", "zz"), (None, "yy"), ("lonely", "ww")]


def table(spark, rows):
    return spark.createDataFrame([(t, lang, 1, "p") for t, lang in rows], "text string, lang string, n int, phrase string")


@pytest.mark.parametrize("run_bytes,filter_bits", [(ph.RUN_BYTES, ph.FILTER_BITS), (500, 1 << 16), (7, 1 << 16)])
def test_equals_plain_version(spark, run_bytes, filter_bits):
    rows = corpus() if run_bytes > 7 else corpus()[:60] + corpus()[-44:]
    got = ph.collocations(table(spark, rows), min_count=12, top=25, filter_bits=filter_bits,
                          run_bytes=run_bytes).collect()
    want = plain(rows, 12, 25)
    assert sorted(map(tuple, got)) == want and len(want) >= 30


def test_empty(spark):
    for rows in ([], [(None, None)], [("", "en")], [(" . ", "en")]):
        assert ph.collocations(table(spark, rows)).count() == 0


def test_large_counts_are_exact(spark):
    """The score's product passes 64 bits."""
    big = 9_000_000_000_000_000
    expr = (f"CAST({ph.SCORE_SCALE} AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(20, 0)) "
            "div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    df = spark.createDataFrame([(big, big + 1, big + 2)], "a long, l long, r long").selectExpr(f"{expr} AS s")
    assert df.first()["s"] == 2000000 * big // (2 * big + 3)
