"""The seasonal models against dense row-wise computations on small synthetic stores."""

import datetime as dt
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotcast.operators import seasonal as S
from slotcast.sources import dims

SPEC = S.Spec(yearly=3, weekly=2, changepoints=8, holidays=("a_0", "a_1", "b_0"), regressors=("reg",), changepoint_scale=0.05,
              season_scale=5.0, holiday_scale=2.0)
KEYS = ["store_id"]


def synthetic(stores=3, days=700, future=0, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for s in range(stores):
        t = np.arange(days + future)
        e = 19000 + 13 * s + t
        reg = ((t // 90) % 3).astype(float)
        terms = [([0] if x % 50 == 3 else []) + ([1] if x % 50 == 4 else []) + ([2] if x % 77 == 5 else []) for x in t]
        y = (100 + 0.05 * t + 0.2 * np.maximum(t - 300, 0) + 8 * np.sin(2 * np.pi * e / 7) + 15 * np.cos(2 * np.pi * e / 365.25)
             + 20 * np.array([0 in x for x in terms]) - 9 * np.array([2 in x for x in terms]) + 4 * reg + rng.normal(0, 3, len(t)))
        y = np.where(t < days, y, np.nan)
        y[40 + s:41 + s] = np.nan          # not observed
        out.append(pd.DataFrame({"store_id": s, "date": [dt.date(1970, 1, 1) + dt.timedelta(int(x)) for x in e], "t": t, "e": e,
                                 "hist": days, "terms": [x or None for x in terms], "reg": reg, "y": y, "is_future": (t >= days).astype(int)}))
    return pd.concat(out, ignore_index=True)


def frame(spark, pdf):
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in
            pdf.astype(object).itertuples(index=False)]
    return spark.createDataFrame([(int(a), b, int(c), int(d), int(e), f, float(g), h, int(i)) for a, b, c, d, e, f, g, h, i in rows],
                                 "store_id int, date date, t int, e int, hist int, terms array<int>, reg double, y double, is_future int")


def hist(df):
    return df.groupBy("store_id").agg(F.max("hist").alias("hist"))


def scaled_rows(pdf):
    """Scaled design and y of the observed rows, by the definitions of the paper."""
    seen = pdf["y"].notna() & (pdf["is_future"] == 0)
    z, y = S.design(SPEC, pdf[seen]), pdf["y"][seen].to_numpy()
    span = max(pdf["t"][seen].max(), 1)
    z[:, 1:2 + SPEC.changepoints] /= span
    z[:, -1] = (z[:, -1] - z[:, -1].mean()) / z[:, -1].std()
    return z, y / np.abs(y).max(), np.abs(y).max()


def check_optimal(z, y, theta, sigma2, spec=SPEC, blocked=()):
    """Optimality conditions of the maximum a posteriori fit, from the rows themselves."""
    slope = z.T @ (y - z @ theta) / sigma2
    scales, jumps = spec.scales(), np.arange(z.shape[1])[spec.jumps]
    for j in range(z.shape[1]):
        if j in blocked:
            assert theta[j] == 0
        elif j in jumps:
            limit = 1.0 / spec.changepoint_scale
            assert abs(slope[j]) <= limit * (1 + 1e-4) + 1e-3
            if abs(theta[j]) > 1e-9:
                assert slope[j] == pytest.approx(np.sign(theta[j]) * limit, rel=1e-4)
        else:
            assert slope[j] == pytest.approx(theta[j] / scales[j] ** 2, rel=1e-3, abs=2e-3)
    rss = ((y - z @ theta) ** 2).sum()
    assert sigma2 == pytest.approx((np.sqrt(len(y) ** 2 + 16 * rss) - len(y)) / 8, rel=1e-5)


def raw_to_scaled(coef, pdf, unit, spec=SPEC):
    seen = pdf["y"].notna() & (pdf["is_future"] == 0)
    c = np.asarray(coef) / unit
    c[1:2 + spec.changepoints] *= max(pdf["t"][seen].max(), 1)
    reg = pdf["reg"][seen]
    c[0] += c[-1] * reg.mean()
    c[-1] *= reg.std(ddof=0)
    return c


def test_fit_is_the_dense_optimum_of_three_stores(spark):
    pdf = synthetic()
    df = frame(spark, pdf)
    stats = S.grams(df.withColumn("b", (F.col("t") % 3).cast("int")), KEYS, "b", SPEC)      # buckets add up to the whole
    models = S.fit(stats, KEYS, "b", SPEC, hist(df)).collect()
    assert len(models) == 3
    for m in models:
        own = pdf[pdf["store_id"] == m["store_id"]]
        z, y, unit = scaled_rows(own)
        theta = raw_to_scaled(m["coef"], own, unit)
        theta[np.abs(theta) < 1e-13] = 0
        check_optimal(z, y, theta, (m["sigma"] / unit) ** 2)
        assert m["n"] == 699 and 2 < m["sigma"] < 4
        hol = m["coef"][2 + 8 + 10:][:3]
        assert hol[0] == pytest.approx(20, abs=3) and hol[1] == pytest.approx(0, abs=3) and hol[2] == pytest.approx(-9, abs=3)


def test_windows_are_terms():
    assert {"semester_break_0", "semester_break_1", "Neujahr_0"} <= set(dims.holiday_terms("B"))
    assert "Semester_Break_1" not in dims.holiday_terms("A")


@pytest.mark.parametrize("mode", [S.UP_TO, S.FROM, S.OTHERS])
def test_windows_of_buckets_equal_refits(spark, mode):
    pdf = synthetic(stores=1)
    df = frame(spark, pdf).withColumn("b", F.floor(F.col("t") / 180).cast("int"))
    bucket = pdf["t"] // 180
    stats = S.grams(df, KEYS, "b", SPEC)
    got = {m["b"]: m for m in S.fit(stats, KEYS, "b", SPEC, hist(df), [0, 1, 2, 3], mode).collect()}
    assert sorted(got) == [0, 1, 2, 3]
    for k, m in got.items():
        train = pdf[{S.UP_TO: bucket <= k, S.FROM: bucket >= k, S.OTHERS: bucket != k}[mode]]
        z, y, unit = scaled_rows(train)
        theta = raw_to_scaled(m["coef"], train, unit)
        theta[np.abs(theta) < 1e-13] = 0
        late = SPEC.knots(700) > SPEC.changepoint_range * (train["t"].max() + 1) - 1
        check_optimal(z, y, theta, (m["sigma"] / unit) ** 2, blocked=set(2 + np.flatnonzero(late)))
        assert m["n"] == len(y)


def test_grid_equals_direct_solves():
    pdf = synthetic(stores=1)
    z, y, unit = scaled_rows(pdf)
    seen = pdf["y"].notna()
    both = np.column_stack([S.design(SPEC, pdf[seen]), pdf["y"][seen]])
    s = S.scale_systems(SPEC, (both.T @ both)[None], np.array([len(y)]), np.array([unit]), np.array([699.0]), 700)
    settings = [(c, a, h) for c in (0.001, 0.05, 0.5) for a in (1.0, 20.0) for h in (1.0, 10.0)]
    got = S.grid_coefficients(s, SPEC, np.array([0.001]), settings)
    for i, (c, a, h) in enumerate(settings):
        scales = replace(SPEC, season_scale=a, holiday_scale=h).scales()
        scales[SPEC.jumps] = np.sqrt(2) * c
        want = np.linalg.solve(z.T @ z + 0.001 * np.diag(1 / scales ** 2), z.T @ y)
        assert np.allclose(z @ got[0, i], z @ want, atol=1e-8)


def test_search_scores_equal_direct_scores(spark):
    pdf = synthetic(stores=2, days=300)
    df = frame(spark, pdf).withColumn("b", (F.col("t") % 4).cast("int"))
    settings = [(0.01, 5.0, 1.0), (0.5, 10.0, 2.0)]
    rows = S.search(S.grams(df, KEYS, "b", SPEC), df, KEYS, "b", "b", SPEC, hist(df), [0, 1, 2, 3], settings, S.OTHERS).collect()
    assert len(rows) == 2 * 4 * 2 and sum(r["n"] for r in rows) == 2 * 2 * 299
    for r in rows[:5]:
        own = pdf[pdf["store_id"] == r["store_id"]]
        train, test = own[own["t"] % 4 != r["b"]], own[(own["t"] % 4 == r["b"]) & own["y"].notna()]
        seen = train["y"].notna()
        both = np.column_stack([S.design(SPEC, train[seen]), train["y"][seen]])
        s = S.scale_systems(SPEC, (both.T @ both)[None], np.array([seen.sum()]), np.array([train["y"].abs().max()]),
                            np.array([float(train["t"][seen].max())]), 300)
        coef = S.grid_coefficients(s, SPEC, S.solve(s, SPEC)[1], [settings[r["setting"]]])[0, 0]
        error = S.design(SPEC, test) @ (s.back[0] @ coef) * s.y_max[0] - test["y"]
        assert r["abs_error"] == pytest.approx(np.abs(error).sum()) and r["sq_error"] == pytest.approx((error ** 2).sum())


def test_lasso_meets_its_conditions():
    rng = np.random.default_rng(4)
    x = np.maximum(np.linspace(0, 1, 400)[:, None] - np.linspace(0, .8, 25), 0)      # hinges: strongly correlated
    y = rng.normal(0, .1, (6, 400)) + 2 * np.maximum(np.linspace(0, 1, 400) - .4, 0)
    a, c, mu = np.tile(x.T @ x, (6, 1, 1)), y @ x, np.array([0.0, 1e-3, 0.01, 0.1, 1.0, 1e3])
    got = S.lasso(a, c, mu, np.zeros((6, 25)))
    assert not got[5].any()
    for i in range(1, 5):
        slope = c[i] - a[i] @ got[i]
        assert (np.abs(slope) <= mu[i] * (1 + 1e-4) + 1e-9).all()
        on = got[i] != 0
        assert np.allclose(slope[on], mu[i] * np.sign(got[i][on]), rtol=1e-4, atol=1e-9)


def test_multiplicative_recovers_planted_series(spark):
    rng = np.random.default_rng(1)
    t = np.arange(800)
    e = 19000 + t
    trend = 50 + 0.1 * t + 0.15 * np.maximum(t - 280, 0)      # a change point of the model
    factor = 1 + 0.3 * np.sin(2 * np.pi * e / 7) + 0.2 * np.cos(2 * np.pi * e / 365.25)
    pdf = pd.DataFrame({"store_id": 0, "date": [dt.date(1970, 1, 1) + dt.timedelta(int(x)) for x in e], "t": t, "e": e, "hist": 700,
                        "terms": None, "reg": 0.0, "y": np.where(t < 700, trend * factor + rng.normal(0, .5, 800), np.nan),
                        "is_future": (t >= 700).astype(int)})
    spec = S.Spec(yearly=2, weekly=2, daily=1, changepoints=10, changepoint_scale=0.1)
    out = S.multiplicative(frame(spark, pdf), KEYS, spec, ["t", "is_future"]).orderBy("t").toPandas()
    truth = trend * factor
    assert np.abs(out["yhat"] - truth)[:700].max() < 1.5
    assert np.abs(out["yhat"] / truth - 1)[700:].max() < 0.05
    ratio = (out["yhat"] / out["trend"])[:700] / factor[:700]
    assert ratio.std() / ratio.mean() < 0.02 and out["sigma"].iloc[0] == pytest.approx(.5, rel=.2)


def test_simulated_intervals_cover(spark):
    days = 60
    future = spark.createDataFrame([(0, dt.date(2025, 1, 1) + dt.timedelta(i), 700 + i, 100.0) for i in range(days)],
                                   "store_id int, date date, t int, yhat double")
    models = spark.createDataFrame([(0, 2.0, 25 / 699, 0.05, 699.0)], "store_id int, sigma double, jump_rate double, jump_size double, t_last double")
    got = S.simulate(future, models, KEYS, paths=4000).orderBy("date").collect()
    assert len(got) == days
    again = S.simulate(future, models, KEYS, paths=4000).orderBy("date").collect()
    assert got == again
    rng = np.random.default_rng(9)
    t = 700 + np.arange(days)
    ahead = t.max() - 699.0
    paths = np.zeros((40000, days))
    for i, k in enumerate(rng.poisson(25 / 699 * ahead, len(paths))):
        at = 699 + ahead * rng.random(k)
        paths[i] = (rng.laplace(0, 0.05, k)[:, None] * np.maximum(t - at[:, None], 0)).sum(axis=0)
    paths += 100 + rng.normal(0, 2, paths.shape)
    inside = [(paths[:, i] >= r["lower"]).mean() - (paths[:, i] > r["upper"]).mean() for i, r in enumerate(got)]
    assert abs(np.mean(inside) - 0.8) < 0.01 and min(inside) > 0.77 and max(inside) < 0.83
    assert got[-1]["upper"] - got[-1]["lower"] > got[0]["upper"] - got[0]["lower"]


def test_unobserved_and_empty(spark):
    df = frame(spark, synthetic(stores=1, days=5))
    none = df.withColumn("y", F.lit(None).cast("double")).withColumn("b", F.lit(0))
    assert S.fit(S.grams(none, KEYS, "b", SPEC), KEYS, "b", SPEC, hist(none)).count() == 0
    empty = none.where("false")
    assert S.fit(S.grams(empty, KEYS, "b", SPEC), KEYS, "b", SPEC, hist(empty)).count() == 0
    few = df.withColumn("b", F.lit(0))      # fewer rows than terms
    model = S.fit(S.grams(few, KEYS, "b", SPEC), KEYS, "b", SPEC, hist(few))
    scored = S.predict(few, model, KEYS, SPEC, ["date"]).collect()
    assert len(scored) == 5 and all(np.isfinite(r["yhat"]) for r in scored)
