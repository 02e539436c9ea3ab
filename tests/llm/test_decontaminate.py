"""op4: equal to brute-force semi-global edit distance; planted passages with edits; odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SMALL
from slotcast.llm import decontaminate as dc, queries


def brute(pattern: str, text: str) -> int:
    """Smallest edit distance of the pattern to any substring of the text."""
    row = np.zeros(len(text) + 1, dtype=int)
    ramp = np.arange(len(text) + 1)
    chars = dc.codes(text)
    for i, c in enumerate(dc.codes(pattern)):
        new = np.minimum(np.append(i + 1, row[:-1] + (chars != c)), row + 1)
        row = np.minimum.accumulate(new - ramp) + ramp
    return int(row.min())


def brute_items(items, text):
    found = []
    for i, t in items:
        for s in dc.segments(t):
            if dc.edit_budget(len(s)) >= 0 and brute(s, text) <= dc.edit_budget(len(s)):
                found.append(i)
                break
    return found


def edit(rng, text, n):
    out = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcdexyz")
        elif kind == 1:
            out.insert(at, rng.choice("abcdexyz"))
        else:
            del out[at]
    return "".join(out)


def test_search_equals_brute_force():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "in", "é"]) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.choice([8, 15, 25, 60]))) for i in range(25)]
    texts = []
    for j in range(120):
        i, t = items[j % 25]
        part = rng.choice(dc.segments(t))
        n = rng.choice([0, 1, dc.edit_budget(len(part)), dc.edit_budget(len(part)) + 1, len(part) // 5])
        texts.append(dc.normalise(rng.choice(["", prose(20)]) + " " + edit(rng, part, max(0, n)) + " " + rng.choice(["", prose(30)])))
    texts += ["", "x", prose(400)]
    got = dc.search(dc.build_index(items), texts)
    hits = 0
    for text, found in zip(texts, got):
        want = brute_items(items, text)
        assert [f[0] for f in found] == want, text
        hits += len(want)
        for item, start, end, edits in found:
            assert 0 <= start <= end <= len(text)
    assert 60 < hits < 400


def test_query_finds_planted_items(spark):
    docs = {r.doc_id: dc.normalise(r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    bench = [(r.item_id, dc.normalise(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = queries.op4_decontaminate(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        exact = {i for i, t in bench if t in docs[r.doc_id]}
        assert exact <= set(r.item_ids) and r.contaminated == bool(r.item_ids)
        for i, e, x, y in zip(r.item_ids, r.edits, r.starts, r.ends):
            part = docs[r.doc_id][x:y]
            text = dict(bench)[i]
            assert min(brute(s, part) for s in dc.segments(text)) == e
    clean = [r.doc_id for r in rows if not r.contaminated][:40]
    assert all(brute_items(bench, docs[d]) == [] for d in clean)


def test_blocks_and_edges(spark, monkeypatch):
    a, b = "the quick brown fox jumps over the lazy dog again", "une phrase assez longue pour servir de question ici"
    bench = spark.createDataFrame([(1, a), (2, b), (2, b), (3, None), (None, a), (4, "short"), (5, a.upper())],
                                  "item_id long, text string")
    rows = [(1, "x " * 30 + a.replace(" ", "\n\n") + " y" * 30), (2, None), (3, ""), (None, b.replace("assez", "asez")),
            (4, "nothing here at all"), (4, "nothing here at all"), (5, "pad " * 100_000 + b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("m", F.lit(1)).withColumn("item_ids", F.lit("z"))
    want = {(1, (1, 5)), (2, ()), (3, ()), (None, (2,)), (4, ()), (5, (2,))}
    assert {(r.doc_id, tuple(sorted(r.item_ids))) for r in dc.find_contaminated(docs, bench).collect()} == want
    monkeypatch.setattr(dc, "BLOCK_CHARS", 10)
    assert {(r.doc_id, tuple(sorted(r.item_ids))) for r in dc.find_contaminated(docs, bench).collect()} == want
    kept = dc.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 4]
    assert dc.drop_contaminated(docs, bench.limit(0)).count() == 7
    assert dc.find_contaminated(docs.limit(0), bench).count() == 0


def test_verbatim_passages_at_every_offset():
    rng = random.Random(8)
    item = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n)).replace("  ", "qr").strip()
    items = [(i, dc.normalise(item(n))) for i, n in enumerate((95, 110, 128, 140, 260, 517))]
    index = dc.build_index(items)
    texts, want = [], []
    for size in (dc.PART + dc.STRIDE - 1, 110):
        for i, t in items:
            for s in range(len(t) - size + 1):
                texts.append(dc.normalise("zz " * 9 + t[s:s + size] + " yy" * 9))
                want.append(i)
    assert len(want) > 1000
    assert [[f[0] for f in found] for found in dc.search(index, texts)] == [[i] for i in want]


def short_hits(items, text):
    out = []
    for i, t in items:
        at = -1
        while (at := text.find(t, at + 1)) >= 0:
            if not (text[at - 1:at] if at else "").isalnum() and not text[at + len(t):at + len(t) + 1].isalnum():
                out.append(i)
                break
    return out


def test_short_items_match_verbatim_between_word_boundaries():
    rng = random.Random(3)
    items = [(i, dc.normalise("".join(rng.choice("abcde fgh") for _ in range(n)) + "z")) for i, n in enumerate(list(range(10, 29)) * 3)]
    items = [(i, t) for i, t in items if dc.MIN_CHARS <= len(t) < dc.SHORT]
    texts = []
    for _ in range(300):
        _, t = rng.choice(items)
        t = edit(rng, t, 1) if rng.random() < .3 else t
        texts.append(dc.normalise(f"some words {rng.choice(['', 'x', '('])}{t}{rng.choice(['', 'y', '.', ' more'])}"))
    got = [[f[0] for f in found] for found in dc.search(dc.build_index(items), texts)]
    want = [short_hits(items, t) for t in texts]
    assert got == want and sum(map(bool, want)) > 80 and not all(want)


def test_repetitive_texts_in_bounded_memory():
    """A run of one character against an item that holds such a run: counted range by range, and still found."""
    import tracemalloc
    item = "abc " + "_" * 56 + " the quick brown fox jumps over the lazy dog again and again until the evening comes"
    index = dc.build_index([(1, item), (2, "_" * 300)])
    text = "_" * 150_000 + " " + item
    tracemalloc.start()
    found = dc.search(index, [text, "_" * 40])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [f[0] for f in found[0]] == [1, 2] and found[0][0][3] == 0 and not found[1]
    assert peak < 700e6


def test_ranges_and_pieces_change_nothing(monkeypatch):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "in"]) for _ in range(rng.randint(1, 3)))
    items = [(i, " ".join(word() for _ in range(rng.choice([12, 40, 200])))) for i in range(20)]
    texts = [" ".join(word() for _ in range(60)) + " " + edit(rng, t[:rng.choice([90, 300])], rng.choice([0, 3])) + " " + word() * 9 for _, t in items]
    texts.append(" ".join(texts))
    whole = dc.search(dc.build_index(items), texts)
    assert sum(map(len, whole)) > 20
    monkeypatch.setattr(dc, "POSTINGS", 300)
    monkeypatch.setattr(dc, "CHUNK_CHARS", 700)
    monkeypatch.setattr(dc, "ITEM_CHARS", 400)
    parts = dc.search(dc.build_index(items), texts)
    assert [[f[0] for f in a] for a in parts] == [[f[0] for f in a] for a in whole]


def test_several_passes_equal_one(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    texts = [r.text for r in bench.limit(3).collect()]
    docs = docs.unionByName(spark.createDataFrame([(1000 + i, "pre " + t + " post", None, None, 0) for i, t in enumerate(texts)], docs.schema))
    rows = lambda: sorted((r.doc_id, r.contaminated, tuple(sorted(zip(r.item_ids, r.starts, r.ends, r.edits))))
                          for r in dc.find_contaminated(docs, bench).collect())
    one, left = rows(), sorted(r.doc_id for r in dc.drop_contaminated(docs, bench).collect())
    monkeypatch.setattr(dc, "BLOCK_CHARS", 2500)
    monkeypatch.setattr(dc, "PASS_BLOCKS", 1)
    assert len(list(dc._passes(bench, "item_id", "text", dc.MIN_CHARS))) > 2
    assert rows() == one and sorted(r.doc_id for r in dc.drop_contaminated(docs, bench).collect()) == left
    assert len(left) + sum(c for _, c, _ in one) == 63
