"""Operator tests on small literal fixtures (FIXTURES.md §3) against brute-force numpy /
pandas versions, plus properties from SURVEY §5."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotcast.functions import calendar as cal
from slotcast.functions.timecols import time_columns
from slotcast.operators import clean, grid, hierarchy as H, learn, lookup, reconcile as R, smooth, splits
from slotcast.sources import dims


def D(s):
    return dt.date.fromisoformat(s)


def TS(s):
    return dt.datetime.fromisoformat(s)


# --- W5, P19, F2/F3 ---------------------------------------------------------------------------------------

def test_ema_gap_rule(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([1.0, None, None, 4.0, 5.0])],
                               "s int, t int, y double")
    out = smooth.ema(df, "y", ["s"], "t", 7).orderBy("t").collect()
    assert [round(r["ema"], 6) for r in out] == [1.0, 1.0, 1.0, 2.116279, 2.837209]


def test_half_even_and_clip(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.4,)], "p double")
    got = [r[0] for r in df.select(clean.post_process_predictions("p")).collect()]
    assert got == [0.0, 2.0, 2.0, 0.0]


def test_iso_week_and_weekday(spark):
    df = spark.createDataFrame([(TS("2024-12-30 12:00:00"),)], "datetime timestamp_ntz")
    tc = time_columns("datetime")
    r = df.select(tc["year"], tc["week"], tc["weekday"]).first()
    assert tuple(r) == (2024, 1, 0)


# --- J10/L1/L2 -----------------------------------------------------------------------------------------------

def test_closest_previous_slot(spark):
    reqs = ["2024-01-10T11:29:00", "2024-01-10T11:30:00", "2024-01-10T11:44:59", "2024-01-10T14:44:00", "bad"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(reqs)], "request_id int, request string")
    out = {r["request_id"]: r for r in lookup.resolve(df).collect()}
    assert out[0]["slot_start"] == TS("2024-01-09 14:00:00")
    assert out[1]["slot_start"] == TS("2024-01-10 11:30:00")
    assert out[2]["slot_start"] == TS("2024-01-10 11:30:00")
    assert out[3]["slot_start"] == TS("2024-01-10 14:00:00")
    assert out[3]["slot_end"] == TS("2024-01-10 14:15:00")
    assert out[4]["is_valid"] == 0 and out[4]["slot_start"] is None


# --- M14 / W7 -------------------------------------------------------------------------------------------------

def test_expanding_folds_blocks(spark):
    dates = [(D("2020-01-01") + dt.timedelta(days=i),) for i in range(103)]
    df = spark.createDataFrame(dates, "date date")
    f = splits.expanding_folds(df, 5).toPandas()
    rank = {d: i for i, (d,) in enumerate(dates)}
    f["rank"] = f["date"].map(rank)
    tests = f[f.role == "test"].groupby("fold")["rank"].agg(["min", "count"])
    assert list(tests["min"]) == [18, 35, 52, 69, 86]
    assert list(tests["count"]) == [17] * 5
    for fold, g in f.groupby("fold"):
        tr = g[g.role == "train"]["rank"]
        te = g[g.role == "test"]["rank"]
        assert tr.max() < te.min() and len(tr) == te.min()      # train = every earlier rank


def test_hash_kfold_partitions_dates(spark):
    df = spark.createDataFrame([(D("2020-01-01") + dt.timedelta(days=i),) for i in range(200)], "date date")
    f = splits.hash_kfold(df, 5, 3, 42).toPandas()
    assert f.groupby("repeat")["date"].nunique().eq(200).all()     # each date in exactly one fold per repeat
    assert f.groupby(["repeat", "date"]).size().eq(1).all()


# --- grids ---------------------------------------------------------------------------------------------------

def test_dense_grid_count_and_off_grid(spark):
    rows = [(1, TS("2024-01-02 11:30:00"), 3), (1, TS("2024-01-05 11:37:00"), 9), (2, TS("2024-01-05 12:00:00"), 4)]
    df = spark.createDataFrame(rows, "store_id int, datetime timestamp_ntz, MAIN bigint")
    g = grid.dense_grid(df, "interval", ["MAIN"])
    assert g.count() == 2 * 96 * 2                          # dates x slots x stores
    assert g.agg(F.sum("MAIN")).first()[0] == 7             # the 11:37 row is off-grid and dropped
    p = grid.dense_grid(df, "period", ["MAIN"], start="2024-01-01", end="2024-01-07")
    # observed dates 2 and 5 + days before (1) and after (6, 7); the inner gap (3, 4) stays
    assert sorted({r[0] for r in p.select("date").collect()}) == [D("2024-01-0%d" % i) for i in (1, 2, 5, 6, 7)]


# --- calendar ----------------------------------------------------------------------------------------------

def test_semester_boundary_literal_vs_date(spark):
    df = spark.createDataFrame([(TS("2024-01-06 12:00:00"),), (TS("2024-01-06 00:00:00"),)], "datetime timestamp_ntz")
    by_date = cal.add_calendar_columns(df).orderBy("datetime").collect()
    literal = cal.add_calendar_columns(df, literal=True).orderBy("datetime").collect()
    assert [r["semester_phase_uni"] for r in by_date] == [0, 0]
    assert [r["semester_phase_uni"] for r in literal] == [0, 2]


def test_holiday_and_open(spark):
    df = spark.createDataFrame([(TS("2024-01-01 12:00:00"),), (TS("2024-01-02 12:00:00"),), (TS("2024-01-02 12:07:00"),)],
                               "datetime timestamp_ntz")
    r = cal.add_calendar_columns(df).orderBy("datetime").collect()
    assert [x["holiday"] for x in r] == [1, 0, 0]
    assert [x["open"] for x in r] == [0, 1, 0]


def test_missing_year_raises(spark):
    df = spark.createDataFrame([(TS("2030-01-02 12:00:00"),)], "datetime timestamp_ntz")
    with pytest.raises(Exception):
        cal.add_calendar_columns(df).collect()


# --- W1-W4 -------------------------------------------------------------------------------------------------

def test_rolling_edges(spark):
    df = spark.createDataFrame([(1, i, float(i * i)) for i in range(9)], "s int, t int, y double")
    out = df.select("t", "y", smooth.centred_mean("y", ["s"], "t", 21).alias("m"),
                    smooth.centred_median("y", ["s"], "t", 7).alias("md")).orderBy("t").toPandas()
    assert out["m"].isna().all()                                 # never a full 21-row window
    ref = pd.Series(out["y"]).rolling(7, center=True).median()
    exp = np.where(ref.notna(), ref, out["y"])
    assert np.allclose(out["md"], exp)


# --- P2, P10 (Q3) ----------------------------------------------------------------------------------------------

def test_zero_columns_and_never_sold(spark):
    rows = [(1, TS("2024-01-02 11:30:00"), 0, 2), (1, TS("2024-01-02 11:45:00"), 0, 0)]
    df = spark.createDataFrame(rows, "store_id int, datetime timestamp_ntz, SOUP bigint, MAIN bigint")
    assert clean.drop_zero_columns(df, ["SOUP", "MAIN"]).columns == ["store_id", "datetime", "MAIN"]
    fs = {r["category"]: r["first_sold"] for r in clean.first_time_sold(df, ["SOUP", "MAIN"]).collect()}
    assert fs["SOUP"] is None and fs["MAIN"] == TS("2024-01-02 11:30:00")


# --- grouped least squares vs numpy -------------------------------------------------------------------------

def test_grouped_ols_matches_lstsq(spark):
    rng = np.random.default_rng(7)
    rows = []
    truth = {}
    for g in range(3):
        x = rng.normal(size=(50, 3))
        y = 1.5 + x @ np.array([0.5, -2.0, 3.0]) + rng.normal(scale=0.1, size=50)
        truth[g] = (x, y)
        rows += [(g, *map(float, xi), float(yi)) for xi, yi in zip(x, y)]
    df = spark.createDataFrame(rows, "g int, a double, b double, c double, y double")
    coefs = learn.solve_groups(learn.normal_equations(df, ["g"], ["a", "b", "c"], "y"), ["g"], ["a", "b", "c"])
    for r in coefs.collect():
        x, y = truth[r["g"]]
        ref, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)
        assert np.allclose([r["intercept"], *r["coef"]], ref, atol=1e-8)


# --- reconciliation -------------------------------------------------------------------------------------------

TREE = [(None, None), ("A", None), ("B", None), ("A", "x"), ("A", "y"), ("A", "z"), ("B", "x"), ("B", "y")]


def _tree_frames(spark, seed=3, dates=3):
    rng = np.random.default_rng(seed)
    rows, ids = [], []
    for s, c in TREE:
        sid = f"{s or '*'}|{c or '*'}"
        ids.append(sid)
        for d in range(dates):
            rows.append((sid, s, c, d, float(rng.normal(10, 3))))
    base = spark.createDataFrame(rows, "series_id string, store_id string, category string, date int, yhat double")
    w = {sid: float(rng.uniform(0.5, 3.0)) for sid in ids}
    weights = spark.createDataFrame(list(w.items()), "series_id string, w double")
    return base, weights, ids, w


def _summing(ids):
    leaves = [i for i in ids if "*" not in i]
    S = np.zeros((len(ids), len(leaves)))
    for r, sid in enumerate(ids):
        s, c = sid.split("|")
        for j, leaf in enumerate(leaves):
            ls, lc = leaf.split("|")
            if (s == "*" or s == ls) and (c == "*" or c == lc):
                S[r, j] = 1
    return S


def test_tree_wls_equals_dense_formula(spark):
    base, weights, ids, w = _tree_frames(spark)
    got = R.reconcile_tree(base, weights).toPandas()
    S = _summing(ids)
    Winv = np.diag([1 / w[i] for i in ids])
    G = np.linalg.solve(S.T @ Winv @ S, S.T @ Winv)
    for d, g in got.groupby("date"):
        y = g.set_index("series_id").loc[ids, "yhat"].to_numpy()
        ref = S @ G @ y
        assert np.allclose(g.set_index("series_id").loc[ids, "yhat_rec"].to_numpy(), ref)


def test_coherence_and_bu(spark):
    base, weights, ids, _ = _tree_frames(spark)
    for rec in (R.reconcile_tree(base, weights), R.reconcile_bu(base)):
        p = rec.toPandas()
        for d, g in p.groupby("date"):
            v = g.set_index("series_id")["yhat_rec"]
            assert np.isclose(v["A|*"], v["A|x"] + v["A|y"] + v["A|z"])
            assert np.isclose(v["*|*"], v["A|*"] + v["B|*"])
    bu = R.reconcile_bu(base).toPandas()
    leaves = bu[bu.series_id.str.contains(r"^[AB]\|[xyz]$")]
    assert np.allclose(leaves["yhat"], leaves["yhat_rec"])


def _shrinkage_by_pairs(rows):
    """Schaefer-Strimmer intensity, pair by pair: the variance of the mean standardised product, summed
    over all pairs, against the sum of squared correlations."""
    count, width = len(rows), len(rows[0])
    scale = [(sum(r[k] ** 2 for r in rows) / count) ** 0.5 for k in range(width)]
    spread = strength = 0.0
    for p in range(width):
        for q in range(p):
            products = [r[p] * r[q] / (scale[p] * scale[q]) for r in rows]
            mean = sum(products) / count
            spread += sum((x - mean) ** 2 for x in products) / (count * (count - 1))
            strength += mean ** 2
    return min(1.0, max(0.0, spread / strength))


def test_lambda_aggregate_form(spark):
    rng = np.random.default_rng(11)
    E = rng.normal(size=(40, 6)) @ rng.normal(size=(6, 6))
    rows = [(f"s{j}", i, float(E[i, j])) for i in range(40) for j in range(6)]
    res = spark.createDataFrame(rows, "series_id string, date int, e double")
    index = R.series_index(res.select("series_id").distinct().withColumn("gid", F.lit(0)))
    gram = H.partial_gram(res, index)
    lam = R.shrinkage_lambda(gram).first()["lambda"]
    assert 0.0 <= lam <= 1.0
    assert np.isclose(lam, _shrinkage_by_pairs(E.tolist()))


def _labelled_residuals(spark, base, ids, E):
    res = spark.createDataFrame([(ids[j], i, float(E[i, j])) for i in range(len(E)) for j in range(len(ids))],
                                "series_id string, date int, e double")
    return res.join(base.select("series_id", *H.LABELS).distinct(), "series_id")


@pytest.mark.parametrize("method", ["MinTSh", "MinTSa"])
def test_mint_matches_dense(spark, method):
    base, _, ids, _ = _tree_frames(spark, seed=5, dates=2)
    rng = np.random.default_rng(5)
    E = rng.normal(size=(60, len(ids)))
    got = R.reconcile_mint(base, _labelled_residuals(spark, base, ids, E), method).toPandas()
    W = E.T @ E / 60
    if method == "MinTSh":
        lam = _shrinkage_by_pairs(E.tolist())
        W = lam * np.diag(np.diag(W)) + (1 - lam) * W
    S, Wi = _summing(ids), np.linalg.inv(W)
    G = np.linalg.inv(S.T @ Wi @ S) @ S.T @ Wi
    assert got["date"].nunique() == 2
    for d, g in got.groupby("date"):
        y = g.set_index("series_id").loc[ids, "yhat"].to_numpy()
        assert np.allclose(g.set_index("series_id").loc[ids, "yhat_rec"].to_numpy(), S @ G @ y, rtol=1e-4, atol=1e-3)


def test_lambda_by_dates_matches_pairs(spark):
    base, _, ids, _ = _tree_frames(spark, seed=8, dates=1)
    E = np.random.default_rng(8).normal(size=(25, len(ids))) + np.arange(25)[:, None] / 5
    E[:, 2] = 0         # dropped (P20)
    got = R.lambda_by_dates(_labelled_residuals(spark, base, ids, E)).first()
    assert got["lambda"] == pytest.approx(_shrinkage_by_pairs(np.delete(E, 2, axis=1).tolist())) and got["n_dates"] == 25


def test_mint_with_more_series_than_dates(spark):
    """1,200 series on 12 residual dates: equal to the dense formula, with a zero-residual store and bottom."""
    rng = np.random.default_rng(3)
    bottoms = [(s, f"c{c}") for s in range(40) for c in range(29)]
    nodes = [(None, None)] + [(s, None) for s in range(40)] + bottoms
    ids = ["|".join("*" if x is None else str(x) for x in n) for n in nodes]
    y = rng.normal(50, 10, (len(nodes), 3))
    E = rng.normal(size=(12, len(nodes))) + rng.normal(size=(12, 1))
    E[:, 5] = 0
    base = spark.createDataFrame([(ids[i], *nodes[i], d, float(y[i, d])) for i in range(len(nodes)) for d in range(3)],
                                 "series_id string, store_id int, category string, date int, yhat double")
    got = R.reconcile_mint(base, _labelled_residuals(spark, base, ids, E), "MinTSh").toPandas().pivot(
        index="series_id", columns="date", values="yhat_rec").loc[ids].to_numpy()
    live = np.delete(np.arange(len(ids)), 5)
    W = E[:, live].T @ E[:, live] / 12
    lam = float(R.lambda_by_dates(_labelled_residuals(spark, base, ids, E)).first()["lambda"])
    W = lam * np.diag(np.diag(W)) + (1 - lam) * W
    S = np.array([[a[0] in (None, b[0]) and a[1] in (None, b[1]) for b in bottoms] for a in nodes], dtype=float)
    X = np.linalg.solve(W, S[live])
    b = np.linalg.solve(S[live].T @ X, X.T @ y[live])
    assert 0 < lam < 1 and np.allclose(got, S @ b, rtol=1e-6, atol=1e-6)


def test_single_child_parent_is_not_bottom(spark):
    rows = [(D("2024-01-01"), "A", "x", 1), (D("2024-01-01"), "B", "x", 2), (D("2024-01-01"), "B", "y", 3)]
    df = spark.createDataFrame(rows, "date date, store_id string, category string, items bigint")
    n = H.nodes(H.all_levels(df, "items")).toPandas().set_index("series_id")
    assert n.loc["A|*", "gid"] == 1 and n.loc["A|*", "n_leaves"] == 1
    assert n.loc["*|*", "n_leaves"] == 3 and (n["gid"] == 0).sum() == 3


def test_method_enum():
    with pytest.raises(ValueError):
        R.check_method("MintSh")


def test_global_rank_matches_row_number(spark):
    rng = np.random.default_rng(2)
    days = sorted({int(x) for x in rng.integers(0, 3000, size=700)})
    df = spark.createDataFrame([(D("2000-01-01") + dt.timedelta(days=d),) for d in days], "date date")
    r = splits.ranked_dates(df).toPandas().sort_values("date")
    assert list(r["rank"]) == list(range(len(days))) and (r["n"] == len(days)).all()
    s = splits.sample_dates(df, 0.5, 7).count()
    assert s == len(days) // 2


def test_impute_variant_a_matches_pandas(spark):
    """M1/M3 on the sf0.001 fixture against a pandas + numpy lstsq re-computation."""
    from conftest import SMALL
    from slotcast.operators import impute
    from slotcast.plans import slots as SL

    fx = SL.fixture(spark, SMALL)
    got = impute.impute_variant_a(fx, dims.LATE_CATEGORIES, k=7).toPandas()
    pdf = fx.toPandas()
    late = dims.LATE_CATEGORIES
    cand = [c for c in dims.CATEGORIES if c not in late]
    expect = pdf.copy()
    for (store, t), g in [((s, t), pdf[pdf.store_id == s]) for s in sorted(pdf.store_id.unique()) for t in late]:
        nz = g[g[t] != 0]
        if nz.empty:
            continue
        cut = nz.datetime.min()
        after = g[g.datetime >= cut].copy()
        after["OTHER"] = after["OTHER"] + after[late].sum(axis=1)
        corr = {c: after[t].corr(after[c]) for c in cand if after[c].std() > 0}
        top = sorted(corr, key=lambda c: (-corr[c], c))[:7]
        X = np.column_stack([np.ones(len(after))] + [after[c].to_numpy(float) for c in top])
        beta, *_ = np.linalg.lstsq(X, after[t].to_numpy(float), rcond=None)
        before = g[g.datetime < cut]
        Xb = np.column_stack([np.ones(len(before))] + [before[c].to_numpy(float) for c in top])
        pred = np.maximum(np.rint(Xb @ beta), 0)
        expect.loc[before.index, t] = pred
    key = ["store_id", "datetime"]
    m = expect.merge(got, on=key, suffixes=("_exp", "_got"))
    assert len(m) == len(got) == len(pdf)
    for t in late:
        assert (m[f"{t}_exp"].astype(int) == m[f"{t}_got"].astype(int)).all()
    assert (got[dims.TOTAL] == got[dims.CATEGORIES].sum(axis=1)).all()      # P4
    assert (got[late] >= 0).all().all()


def _days(spark, n):
    return spark.createDataFrame([(D("2018-01-01") + dt.timedelta(days=i),) for i in range(n)], "date date")


def test_date_hash_depends_on_the_seed(spark):
    df = _days(spark, 1826)
    folds = splits.hash_kfold(df, 5, 3, 42).toPandas().pivot(index="date", columns="repeat", values="fold")
    for a, b in ((0, 1), (0, 2), (1, 2)):
        table = [[int(((folds[a] == i) & (folds[b] == j)).sum()) for j in range(5)] for i in range(5)]
        assert all(40 <= x <= 110 for row in table for x in row)        # independent: about 73 each
    ten = splits.hash_kfold(df, 10, 1, 7).toPandas()["fold"].value_counts()
    assert len(ten) == 10 and ten.min() > 130
    picked = [{r.date for r in splits.sample_dates(df, 0.5, s).collect()} for s in (1, 42, 43, 999)]
    for i, a in enumerate(picked):
        assert len(a) == 913
        for b in picked[i + 1:]:
            assert 0.4 < len(a & b) / 913 < 0.6


@pytest.mark.parametrize("n", [345, 587, 1761])
def test_hash_draws_spread_over_the_dates(spark, n):
    draws = _days(spark, 1).select(F.explode(F.sequence(F.lit(1), F.lit(40))).alias("s"), "date").select(
        F.pmod(splits.date_hash("date", F.col("s") + 42), F.lit(n)).alias("r"))
    assert draws.distinct().count() >= 30


def test_cap_targets_equals_numpy(spark):
    from slotcast.operators import rollup
    rng = np.random.default_rng(3)
    x = rng.gamma(2.0, 10.0, size=(200, 2))
    df = spark.createDataFrame([(int(i), float(a), float(b)) for i, (a, b) in enumerate(x)], "i int, a double, b double")
    got = rollup.cap_targets(df, ["a", "b"]).toPandas().sort_values("i")
    for c, v in zip("ab", x.T):
        assert np.allclose(got[c], np.clip(v, np.percentile(v, 1), np.percentile(v, 99)))


def test_ema_equals_pandas(spark):
    import pandas as pd
    from slotcast.operators import smooth
    y = [None, 3.0, None, None, 5.0, 1.0, None, 8.0]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(y)] + [(2, 0, 4.0)], "s int, t int, y double")
    got = smooth.ema(df, "y", ["s"], "t", 7).where("s = 1").orderBy("t").toPandas()["ema"].astype(float)
    want = pd.Series(y, dtype=float).ewm(span=7, adjust=False, ignore_na=False).mean()
    assert np.allclose(got, want, equal_nan=True)


def test_bootstrap_draws_and_sign(spark):
    from conftest import SMALL
    from slotcast.plans import hier
    ctx = hier.Context(spark, SMALL)
    full = hier.bootstrap(spark, SMALL, ctx=ctx).toPandas().set_index(["series_id", "date"]).sort_index()
    some = hier.bootstrap(spark, SMALL, samples=60, ctx=ctx).toPandas().set_index(["series_id", "date"]).sort_index()
    assert (full.q_lo <= full.q_mid).all() and (full.q_mid <= full.q_hi).all() and list(full.index) == list(some.index)
    width = (some.q_hi - some.q_lo).mean() / (full.q_hi - full.q_lo).mean()
    assert 0.7 < width < 1.2
    mint = hier.bootstrap(spark, SMALL, method="MinTSa", ctx=ctx).toPandas()
    assert len(mint) == len(full) and (mint.q_lo <= mint.q_hi).all()
    cover = ((full.y >= full.q_lo) & (full.y <= full.q_hi)).mean()
    assert cover > 0.8


def test_iso_requests(spark):
    texts = ["2024-01-05T12:40:00", "2024-01-05T12:40", "2024-01-05 12:40:10", "2024-01-05", "2024-01-05T12:40:00.250", "x", "", None,
             "2024-13-01", "05.01.2024", "2024-01-05T12:40:00x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, request string")
    got = {r.i: (r.is_valid, r.slot_start) for r in lookup.resolve(df).collect()}
    assert [got[i][0] for i in range(len(texts))] == [1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0]
    assert got[1][1] == dt.datetime(2024, 1, 5, 12, 30) and got[3][1] == dt.datetime(2024, 1, 4, 14, 0)


def test_requests_are_parsed_once(spark):
    """Each format is tried once a request in the whole look-up, and only on texts of its shape."""
    texts = ["2024-01-05T12:40:00", "2024-01-06 12:40", "+02024-01-05", "2024-01-05t12:40:00.5", "2024-01-05T24:00:00", "2024-02-30",
             "x", "2024-01-05T12:40:00x", None]
    df = spark.createDataFrame([(i, 1, t) for i, t in enumerate(texts)], "i int, store_id int, request string").coalesce(1)
    plain = F.coalesce(*[F.try_to_timestamp("request", F.lit(f)).cast("timestamp_ntz") for f in lookup.ISO_FORMATS])
    rows = df.select("i", lookup.parse_request(F.col("request"))[1].alias("ts"), plain.alias("want")).collect()
    assert [r.ts for r in rows] == [r.want for r in rows] and [r.ts is not None for r in rows] == [True] * 4 + [False] * 5
    history = spark.createDataFrame([(1, TS("2024-01-05 12:30:00"), 7), (1, None, 9)], f"store_id int, datetime timestamp_ntz, {dims.TOTAL} int")
    profile = spark.createDataFrame([(1, 5, "12:30", 3.0)], "store_id int, weekday int, slot_label string, mean_total double")
    out = lookup.attach_forecast(lookup.resolve(df), history, profile)
    assert out.columns == ["store_id", "slot_start", "i", "request", "is_valid", "slot_end", "source", "value", "available"]
    got = {r.i: (r.source, r.value, r.available, r.is_valid) for r in out.collect()}
    seven, none = ("history", 7.0, 1, 1), (None, None, 0, 0)
    assert [got[i] for i in range(len(texts))] == [seven, ("profile", 3.0, 1, 1), (None, None, 0, 1), seven] + [none] * 5
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("gettimestamp(") <= 2 * len(lookup.ISO_FORMATS)


def test_input_checks(spark):
    day = D("2024-01-01")
    ok = spark.createDataFrame([("a", day, 1.0), ("b", day, 2.0)], "series_id string, date date, yhat double")
    res = ok.withColumnRenamed("yhat", "e")
    R.check_inputs(ok, res)
    null = spark.createDataFrame([("a", day, None)], ok.schema)
    for base, e in ((ok.unionByName(ok.limit(1)), None), (null, None), (ok, res.where("series_id = 'a'")), (ok, res.union(res))):
        with pytest.raises(ValueError):
            R.check_inputs(base, e)


def test_tree_keeps_subtree_of_unweighted_node(spark):
    base, weights, ids, _ = _tree_frames(spark)
    got = R.reconcile_tree(base, weights.where("series_id <> 'A|*'")).toPandas()
    assert got["yhat_rec"].notna().all()
    for _, g in got.groupby("date"):
        v = g.set_index("series_id")["yhat_rec"]
        assert np.isclose(v["A|*"], v["A|x"] + v["A|y"] + v["A|z"]) and np.isclose(v["*|*"], v["A|*"] + v["B|*"])


def test_null_rows_are_no_observations(spark):
    rows = [(1, float(x), 2.0 * x + 1.0) for x in range(20)]
    df = spark.createDataFrame(rows + [(1, None, 5.0), (1, 3.0, None), (1, float("nan"), 1.0), (1, float("inf"), 1.0)],
                               "g int, x double, y double")
    c = learn.solve_groups(learn.normal_equations(df, ["g"], ["x"], "y"), ["g"], ["x"], with_sigma=True).first()
    assert np.isclose(c["intercept"], 1.0) and np.isclose(c["coef"][0], 2.0) and c["sigma"] < 1e-6
