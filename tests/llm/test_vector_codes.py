"""op11: its SQL (test_shards_mixing runs it on the given table), and a plain version on odd rows."""

import hashlib

import numpy as np
import pytest

from slotcast.llm import vector_codes as vc


def plain(rows, parts=4, entries=256, rounds=4):
    kept = [(i, label, [int(np.floor(1024 * x)) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ids = sorted({i for i, _, _ in kept if i is not None})[:entries]
    start = [min(v for j, _, v in kept if j == i) for i in ids]
    cuts = vc.part_slices(len(start[0]), parts)
    books = [[list(v[c]) for v in start] for c in cuts]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, c in enumerate(cuts):
            groups = {}
            for _, _, v in kept:
                groups.setdefault(near(v[c], books[p])[1], []).append(v[c])
            for k, g in groups.items():
                books[p][k] = [sum(col) // len(g) for col in zip(*g)]
    out = []
    for i, label, v in kept:
        got = [near(v[c], books[p]) for p, c in enumerate(cuts)]
        out.append((i, "".join(f"{k:02x}" for _, k in got), sum(d for d, _ in got), label))
    total = {}
    for _, _, e, label in out:
        total[label] = total.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, total[label], sha) for i, c, e, label in out), key=repr)


def table(spark, rows):
    # columns with names the operator uses inside
    return spark.createDataFrame([(i, v, label, 0, "x") for i, v, label in rows],
                                 "vec_id long, embedding array<float>, label int, v int, code string")


@pytest.mark.parametrize("entries", [4, 256])
def test_equals_plain_version(spark, entries):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(0, 0.2, 10))], int(i) % 5 or None) for i in rng.permutation(300)]
    rows += [(7, rows[3][1], 1), (7, rows[3][1], 1), (1000, [0.0] * 10, 2), (1001, [0.25] * 10, None)]      # repeated id, ties
    rows += [(2000, None, 1), (2001, [None] * 10, 1), (2002, [float("nan")] + [0.1] * 9, 1), (2003, [float("inf")] * 10, 1)]
    rows += [(None, [0.5] * 10, 3)]
    got = vc.compress(table(spark, rows), entries=entries).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, entries=entries)


def test_other_lengths_and_empty(spark):
    rows = [(i, [0.1 * i] * 8, 0) for i in range(5)] + [(9, [0.1] * 3, 0), (10, [], 0)]
    assert sorted(r.vec_id for r in vc.compress(table(spark, rows)).collect()) == [0, 1, 2, 3, 4]
    for few in ([], [(1, None, 1)], [(None, [0.1] * 4, 1)]):
        out = vc.compress(table(spark, few))
        assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.count() == 0


def test_too_large_is_refused(spark):
    with pytest.raises(Exception, match="after scaling"):
        vc.compress(table(spark, [(1, [1e30] * 4, 1)])).collect()


def test_orchard_is_exact():
    rng = np.random.default_rng(1)
    for spread in (3, 50, 2000):        # small spreads give many ties and equal entries
        entries = rng.integers(-spread, spread, (200, 6))
        x = np.vstack([rng.integers(-spread, spread, (500, 6)), entries])
        d = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
        index, distance = vc.Orchard(entries).nearest(x)
        assert (index == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()


def test_hot_labels_and_many_labels(spark):
    coded = spark.createDataFrame([(i, 1 if i < 3000 else i, "00", i % 7) for i in range(9000)] + [(9000, None, "00", 5)],
                                  "vec_id long, label int, code string, error long")
    want = {}
    for i in range(9000):
        want[1 if i < 3000 else i] = want.get(1 if i < 3000 else i, 0) + i % 7
    got = vc.add_label_error(coded).collect()
    assert len(got) == 9001
    assert all(r.label_error == (5 if r.label is None else want[r.label]) for r in got)
