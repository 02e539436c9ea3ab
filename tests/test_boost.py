"""Vector-leaf trees against a plain numpy booster."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotcast.operators import boost as B


def data(n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 7, n), rng.integers(0, 12, n), rng.integers(0, 2, n)])
    y = np.column_stack([3.0 * (x[:, 0] > 4) + x[:, 1], 10.0 - 2 * (x[:, 0] > 4) * x[:, 2]]) + rng.normal(0, .2, (n, 2))
    return x, y


def plain(x, y, trees, depth, rate, l2=1.0, min_weight=1.0):
    pred = np.tile(y.mean(axis=0), (len(y), 1))
    for _ in range(trees):
        g = pred - y

        def grow(rows, d):
            s, h = g[rows].sum(axis=0), len(rows)
            best = (1e-12, None)
            if d < depth:
                for f in range(x.shape[1]):
                    for v in np.unique(x[:, f])[:-1]:
                        a = rows[x[rows, f] <= v]
                        b = rows[x[rows, f] > v]
                        if len(a) < min_weight or len(b) < min_weight:
                            continue
                        gain = ((g[a].sum(0) ** 2).sum() / (len(a) + l2) + (g[b].sum(0) ** 2).sum() / (len(b) + l2) - (s ** 2).sum() / (h + l2))
                        if gain > best[0] + 1e-9:
                            best = (gain, (a, b))
            if best[1] is None:
                pred[rows] -= rate * s / (h + l2)
            else:
                grow(best[1][0], d + 1)
                grow(best[1][1], d + 1)
        grow(np.arange(len(y)), 0)
    return pred


def frame(spark, x, y, name="m"):
    return spark.createDataFrame([(name, *map(int, a), *map(float, b)) for a, b in zip(x, y)], "name string, f0 int, f1 int, f2 int, a double, b double")


FEATURES = ["f0", "f1", "f2"]


def test_equals_plain_booster(spark):
    x, y = data()
    x2, y2 = data(150, 5)
    df = frame(spark, x, y).unionByName(frame(spark, x2, y2, "other"))
    edges = B.bin_edges(df, FEATURES)
    assert edges["f1"] == [float(v) for v in range(11)]
    params = B.Params(trees=3, depth=3, rate=0.5)
    rows = B.training_rows(df, F.col("name"), FEATURES, [F.col("a"), F.col("b")], edges)
    models = B.fit(rows, 3, B.MAX_BINS, params)
    assert sorted(models) == ["m", "other"]
    asked = df.withColumns({"model": F.col("name"), "bins": B.with_bins(df, FEATURES, edges)})
    got = B.predict(asked, models, params, ["name", "f0", "f1", "f2", "a"]).collect()
    for name, xs, ys in (("m", x, y), ("other", x2, y2)):
        want = plain(xs, ys, 3, 3, 0.5)
        by = {(r["f0"], r["f1"], r["f2"], round(r["a"], 9)): r["pred"] for r in got if r["name"] == name}
        for xi, yi, w in zip(xs, ys, want):
            assert by[(*map(int, xi), round(float(yi[0]), 9))] == pytest.approx(w, abs=1e-6)


def test_one_split_by_brute_force():
    rng = np.random.default_rng(2)
    hist = np.column_stack([rng.normal(0, 3, (9, 2)), rng.integers(0, 4, 9)])
    gain, at, left, whole = B.best_splits(hist, B.Params(min_weight=2.0))
    best = -np.inf
    for b in range(9):
        lo, hi = hist[:b + 1].sum(0), hist[b + 1:].sum(0)
        if lo[2] >= 2 and hi[2] >= 2:
            v = (lo[:2] ** 2).sum() / (lo[2] + 1) + (hi[:2] ** 2).sum() / (hi[2] + 1) - ((lo + hi)[:2] ** 2).sum() / ((lo + hi)[2] + 1)
            if v > best:
                best, arg = v, b
    assert gain == pytest.approx(best) and at == arg and np.allclose(left + (whole - left), hist.sum(0))


def test_sampling_is_seeded_and_learns(spark):
    x, y = data(800, 3)
    df = frame(spark, x, y)
    edges = B.bin_edges(df, FEATURES)
    params = B.Params(trees=8, depth=3, rate=0.4, subsample=0.7, colsample=0.67)
    rows = B.training_rows(df, F.lit("m"), FEATURES, [F.col("a"), F.col("b")], edges)
    one, two = (B.fit(rows, 3, B.MAX_BINS, params)["m"] for _ in range(2))
    bins = np.array([[min(int(v), 63) for v in r] for r in x])
    assert np.allclose(one.predict(bins, 3), two.predict(bins, 3))
    assert ((one.predict(bins, 3) - y) ** 2).mean() < 0.4 * y.var(axis=0).mean()
    share = B.importances({"m": one}, FEATURES)
    assert sum(v for _, _, v in share) == pytest.approx(1)


def test_tasks_without_drawn_rows(spark):
    """A task may hold only rows that the tree's sample leaves out, or that are in finished leaves."""
    x, y = data(30, 7)
    df = frame(spark, x, y)
    edges = B.bin_edges(df, FEATURES)
    params = B.Params(trees=4, depth=4, rate=0.5, subsample=0.5)
    rows = B.training_rows(df, F.lit("m"), FEATURES, [F.col("a"), F.col("b")], edges)
    bins = np.array([[min(int(v), 63) for v in r] for r in x])
    many, one = (B.fit(r, 3, B.MAX_BINS, params)["m"] for r in (rows.repartition(30, "bins"), rows.coalesce(1)))
    assert len(many.trees) == 4 and np.allclose(many.predict(bins, 4), one.predict(bins, 4))


def test_many_values_nulls_and_empty(spark):
    df = spark.createDataFrame([("m", float(i), float(i > 500)) for i in range(1000)] + [("m", None, 0.0), ("m", 1.0, None)], "name string, f double, y double")
    edges = B.bin_edges(df, ["f"])
    assert 50 <= len(edges["f"]) <= 63
    params = B.Params(trees=5, depth=2, rate=0.5)
    models = B.fit(B.training_rows(df, F.col("name"), ["f"], [F.col("y")], edges), 1, B.MAX_BINS, params)
    got = B.predict(df.withColumns({"model": F.col("name"), "bins": B.with_bins(df, ["f"], edges)}), models, params, ["f"]).collect()
    assert len(got) == 1002 and all(abs(r["pred"][0] - (r["f"] > 500)) < .3 for r in got if r["f"] is not None and abs(r["f"] - 500) > 40)
    empty = df.where("false")
    e = B.bin_edges(empty, ["f"])
    assert B.fit(B.training_rows(empty, F.col("name"), ["f"], [F.col("y")], e), 1, B.MAX_BINS, params) == {}
