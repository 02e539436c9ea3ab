"""Library surface without a registered query of its own: readers/writers, model
interface, experiment configs, run grids, step chains."""

import datetime as dt
import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from slotcast.functions.timecols import parse_model_name
from slotcast.operators import clean, learn, search
from slotcast.sources import dims, io


def test_store_csv_scan_tolerant_and_partitioned_sink(spark):
    d = tempfile.mkdtemp(prefix="slotcast-csv-")
    with open(os.path.join(d, "cleaned_store1.csv"), "w") as f:
        f.write("time,MAIN,SIDE\n2024-01-02 11:30:00,3,1\n2024-01-02 11:45:00,2,0\nnot-a-time,x,1\n")
    with open(os.path.join(d, "cleaned_store2.csv"), "w") as f:
        f.write("time,MAIN,SIDE\n2024-01-02 11:30:00,5,5\n")
    df = io.read_store_csv(spark, [os.path.join(d, "cleaned_store1.csv"), os.path.join(d, "cleaned_store2.csv"),
                                   os.path.join(d, "missing_store3.csv")], ["MAIN", "SIDE"], tolerant=True)
    rows = df.collect()
    assert len(rows) == 4
    assert {r["store_id"] for r in rows} == {1, 2}
    bad = io.count_bad_timestamps(df.withColumn("raw", F.lit("x")), "raw", "datetime").first()[0]
    assert bad == 1
    out = tempfile.mkdtemp(prefix="slotcast-sink-")
    io.write_table(df.where(F.col("datetime").isNotNull()), out, partition_by=["store_id"], sort_within=["datetime"])
    one = spark.read.parquet(out).where(F.col("store_id") == 1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and one.count() == 2      # partition pruning (S3)


def test_params_roundtrip(spark):
    p = tempfile.mkdtemp(prefix="slotcast-params-")
    io.save_params(spark, {"lambda": 0.3, "labels": ["hour", "interval", "store_id", "category"]}, p)
    back = io.load_params(spark, p)
    assert back["lambda"] == 0.3 and back["labels"] == "hour,interval,store_id,category"


def test_model_interface_save_load(spark):
    rng = np.random.default_rng(1)
    rows = [(g, float(x), float(2 * x + g + rng.normal(scale=0.01))) for g in (1, 2) for x in rng.normal(size=30)]
    df = spark.createDataFrame(rows, "store_id int, x double, y double")
    m = learn.GroupedLinearModel(["store_id"], ["x"], "y").fit(df)
    path = tempfile.mkdtemp(prefix="slotcast-model-")
    m.save(path)
    m2 = learn.GroupedLinearModel.load(spark, path, ["store_id"], "y")
    ev = m2.eval(df).collect()
    assert all(r["rmse"] < 0.05 for r in ev)


def test_run_grid_and_random_runs(spark):
    g = search.run_grid(spark, {"temporal_level": ["day", "week"]}, search.TREE_SPACE)
    assert g.count() == 2 * 3 * 3 * 4 * 4 * 4
    assert g.select("run_id").distinct().count() == g.count()
    r = search.random_runs(g, 10, seed=1)
    assert r.count() == 10
    assert sorted(x[0] for x in r.collect()) == sorted(x[0] for x in search.random_runs(g, 10, seed=1).collect())
    f = search.run_grid(spark, {}, {"max_depth": [4]}, features=["a", "b", "c", "d"], n_features=2)
    assert f.count() == 6


def test_feature_expansion_and_model_names():
    assert search.expand_features(["year", "semester_phase"], [1, 2]) == \
        ["year", "semester_phase_uni", "semester_phase_hs", "store_id"]
    assert search.expand_features(["year"], None) == ["year"]
    assert parse_model_name("int_all_total") == {"temporal": "interval", "per_store": True, "per_category": False}


def test_experiment_yaml(tmp_path):
    p = tmp_path / "exp.yaml"
    p.write_text("meta:\n  name: t\nexperiment:\n  seed: 1\n  store_ids: None\n  n_runs: 3\n")
    cfg = search.load_experiment(str(p))
    assert cfg["experiment"]["store_ids"] is None and cfg["meta"]["name"] == "t"


def test_step_chain_and_replace_column(spark):
    rows = [(1, dt.datetime(2024, 1, 2, 10, 0), 1, 0), (1, dt.datetime(2024, 1, 2, 12, 0), 2, 3)]
    df = spark.createDataFrame(rows, "store_id int, datetime timestamp_ntz, MAIN bigint, SIDE bigint")
    chain = clean.StepChain().add_step(clean.add_total, ["MAIN", "SIDE"]).add_step(clean.opening_hours)
    out = chain.run(df).collect()
    assert len(out) == 1 and out[0][dims.TOTAL] == 5
    other = df.select("store_id", "datetime", (F.col("SIDE") * 10).alias("SIDE"))
    rep = clean.replace_column(df, other, "SIDE", ["store_id", "datetime"]).orderBy("datetime").collect()
    assert [r["SIDE"] for r in rep] == [0, 30]


def test_metrics_sink_is_rerunnable(spark, tmp_path):
    p = str(tmp_path / "metrics")
    rows = lambda run, v: spark.createDataFrame([("exp", run, f, "mae", v + f) for f in range(3)],
                                                "experiment string, run_id string, fold int, metric string, value double")
    io.write_metrics(rows("a", 1.0).unionByName(rows("b", 5.0)), p)
    io.write_metrics(rows("a", 2.0), p)
    io.write_metrics(rows("a", 2.0), p)
    got = sorted((r.run_id, r.fold, r.value) for r in spark.read.parquet(p).collect())
    assert got == [("a", f, 2.0 + f) for f in range(3)] + [("b", f, 5.0 + f) for f in range(3)]


def test_saved_state_reconciles_like_memory(spark, tmp_path):
    import datetime as dt
    import numpy as np
    from slotcast.operators import hierarchy as H, reconcile as R
    rng = np.random.default_rng(1)
    labels = [(None, None), (1, None), (2, None), (1, "a"), (1, "b"), (2, "a")]
    rows = [("|".join("*" if x is None else str(x) for x in n), *n, dt.date(2024, 1, 1 + d), float(rng.normal(10, 2)), float(rng.normal()))
            for n in labels for d in range(12)]
    df = spark.createDataFrame(rows, "series_id string, store_id int, category string, date date, yhat double, e double")
    base, resid = df.where("date > '2024-01-10'").drop("e"), df.where("date <= '2024-01-10'").drop("yhat")
    gid = F.when(F.col("category").isNotNull(), 0).when(F.col("store_id").isNotNull(), 1).otherwise(3).alias("gid")
    nodes = df.select("series_id", gid, "store_id", "category").distinct()
    lam = R.lambda_by_dates(resid).first()["lambda"]
    for _ in range(2):
        io.save_state(spark, str(tmp_path / "s"), resid, nodes, H.summing_edges(nodes), **{"lambda": lam, "labels": H.LABELS})
    state = io.load_state(spark, str(tmp_path / "s"))
    assert state["lambda"] == lam and state["edges"].count() == 9 and state["nodes"].count() == 6 and state["residuals"].count() == 60
    one = {(r.series_id, r.date): r.yhat_rec for r in R.reconcile_mint(base, resid, "MinTSh").collect()}
    two = {(r.series_id, r.date): r.yhat_rec for r in R.reconcile_mint(base, state["residuals"], "MinTSh").collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-9 for k in one)


def test_columns_by_name_pattern(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, "x")], "store_id int, BAKED_GOOD int, GOODS_2 int, MAIN int, BAKED_NAME string")
    assert clean.columns_like(df, "GOOD") == ["BAKED_GOOD", "GOODS_2"]
    assert clean.columns_like(df, "^MAIN$", "2") == ["GOODS_2", "MAIN"] and clean.columns_like(df, "zzz") == []


def test_asof_join_against_pandas(spark):
    import datetime as dt
    import numpy as np
    import pandas as pd
    from slotcast.operators.asof import asof_join
    rng = np.random.default_rng(0)
    day = lambda s: dt.datetime(2024, 3, 1) + dt.timedelta(seconds=int(s))
    key = lambda: "hot" if rng.random() < .4 else f"k{rng.integers(5)}"
    left = [(i, key(), day(rng.integers(0, 500_000))) for i in range(600)]
    right = [(key(), day(rng.integers(100_000, 400_000)), i) for i in range(150)]
    right += [(k, t, v + 1000) for k, t, v in right[:20]] + [("hot", left[0][2], 5000)]        # ties: the larger value; same time counts
    odd = [(900, None, day(1)), (901, "hot", None), (902, "none", day(400_000)), (900, None, day(1))]
    lt = spark.createDataFrame(left + odd, "id int, k string, at timestamp_ntz")
    rt = spark.createDataFrame(right + [(None, day(5), 1), ("hot", None, 2)], "k string, since timestamp_ntz, v int")
    pl = pd.DataFrame(left, columns=["id", "k", "at"]).sort_values("at")
    pr = pd.DataFrame(right, columns=["k", "since", "v"]).sort_values(["since", "v"]).drop_duplicates(["k", "since"], keep="last")
    for tolerance in (None, 20_000):
        want = pd.merge_asof(pl, pr, left_on="at", right_on="since", by="k",
                             tolerance=None if tolerance is None else pd.Timedelta(seconds=tolerance)).set_index("id")["v"]
        got = asof_join(lt, rt, ["k"], "at", "since", bucket_seconds=7200, tolerance_seconds=tolerance).collect()
        assert len(got) == 604 and all(r.v is None for r in got if r.id >= 900)
        for r in got:
            if r.id < 900:
                assert r.v == (None if pd.isna(want[r.id]) else want[r.id])
    assert asof_join(lt.limit(0), rt, ["k"], "at", "since").count() == 0
    assert asof_join(lt, rt.limit(0), ["k"], "at", "since").where("v is null").count() == 604
