"""Hierarchy and reconciliation queries over adapter B (orders): total -> store ->
store x category, daily. Base forecast = value 7 days earlier + level offset; residual
dates = a seeded half of the dates (O5), the other half is the forecast horizon."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hierarchy as H
from ..operators import lookup
from ..operators import reconcile as R
from ..operators import splits
from ..session import cut_lineage
from ..sources import adapters
from . import sqlparts as S
from .registry import query

SEED = 42


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- Spark side ---------------------------------------------------------------------------------

def levels(spark, sf_dir):
    d = adapters.daily_sales_long(spark, sf_dir)
    return H.all_levels(H.bottom_grid(d, "items"), "items")


def base(spark, sf_dir):
    return H.base_forecast(levels(spark, sf_dir))


def fitted(spark, sf_dir):
    """Base forecasts of a model per series (H5): y on the value a week earlier, fitted on the sampled
    half of the dates, predictions cleaned (P19)."""
    lv = cut_lineage(H.with_lag(levels(spark, sf_dir)))
    return H.fit_lag_model(lv, cut_lineage(splits.sample_dates(lv, 0.5, SEED)))


def parts(spark, sf_dir, forecast=base):
    """(base, residual dates, residuals with zero series dropped, horizon rows)."""
    # The base-forecast table is what a forecasting job would write once; reading it
    # back from the checkpoint folder keeps the reconciliation plans short.
    b = cut_lineage(forecast(spark, sf_dir))
    rd = cut_lineage(splits.sample_dates(b, 0.5, SEED))   # used by both split sides: rank once
    inres, hz = splits.split_by_dates(b, rd)
    res = inres.select("series_id", "date", (F.col("yhat") - F.col("y")).alias("e"))
    return b, rd, _drop_zero(res), hz


def _drop_zero(res):
    from ..operators.clean import drop_zero_series
    return drop_zero_series(res, ["series_id"], "e")


def nodes(spark, sf_dir, base_df=None):
    """Node table; from the (checkpointed) base table when given, so the reconciliation
    plans do not re-derive the hierarchy from the raw tables."""
    src = base_df if base_df is not None else levels(spark, sf_dir)
    return H.nodes(src)


# --- SQL side -------------------------------------------------------------------------------------

HASH = S.date_hash_sql("date", str(SEED))
OFFSET_SQL = "CASE gid WHEN 0 THEN 1.0 WHEN 1 THEN 2.0 WHEN 3 THEN 4.0 ELSE 0.0 END"
LEVEL_CTES = (
    S.daily_long_cte(),
    "bb AS (SELECT min(date) AS d0, max(date) AS d1 FROM daily)",
    "bd AS (SELECT CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS date FROM bb)",
    "bs AS (SELECT DISTINCT store_id, category FROM daily)",
    "bg AS (SELECT bd.date, bs.store_id, bs.category, CAST(coalesce(d.items, 0) AS BIGINT) AS items FROM bd CROSS JOIN bs "
    "LEFT JOIN daily d ON d.date = bd.date AND d.store_id = bs.store_id AND d.category = bs.category)",
    "lv AS (SELECT date, store_id, category, CAST(sum(items) AS BIGINT) AS y, CAST(GROUPING(store_id, category) AS INTEGER) AS gid "
    "FROM bg GROUP BY GROUPING SETS ((date, store_id, category), (date, store_id), (date)))",
    "lv2 AS (SELECT *, concat_ws('|', coalesce(CAST(store_id AS VARCHAR), '*'), coalesce(category, '*')) AS series_id, "
    "CASE gid WHEN 0 THEN 'store_id_category' WHEN 1 THEN 'store_id' WHEN 3 THEN 'total' END AS level FROM lv)",
    "lg AS (SELECT * FROM (SELECT *, lag(y, 7) OVER (PARTITION BY series_id ORDER BY date) AS x FROM lv2) WHERE x IS NOT NULL)",
)
LAG_BASE = (
    f"base AS (SELECT * FROM (SELECT *, CAST(lag(y, 7) OVER (PARTITION BY series_id ORDER BY date) AS DOUBLE) + {OFFSET_SQL} AS yhat "
    "FROM lv2) WHERE yhat IS NOT NULL)",
)
RD_SQL = (f"rd AS (SELECT date FROM (SELECT date, row_number() OVER (ORDER BY {HASH}, date) AS r, count(*) OVER () AS n "
          "FROM (SELECT DISTINCT date FROM lg)) WHERE r <= floor(n * 0.5))")
FIT_BASE = (
    "co AS (SELECT series_id, CASE WHEN var_pop(x) > 0 THEN regr_slope(y, x) ELSE 0.0 END AS b, "
    "CASE WHEN var_pop(x) > 0 THEN regr_intercept(y, x) ELSE avg(y) END AS a FROM lg WHERE date IN (SELECT date FROM rd) GROUP BY series_id)",
    "base AS (SELECT lg.* EXCLUDE (x), round_even(greatest(round(co.a + co.b * lg.x, 9), 0.0), 0) AS yhat FROM lg JOIN co ON lg.series_id = co.series_id)",
)
TAIL_CTES = (
    "res0 AS (SELECT series_id, date, yhat - y AS e FROM base WHERE date IN (SELECT date FROM rd))",
    "res AS (SELECT * FROM res0 WHERE series_id IN (SELECT series_id FROM res0 GROUP BY series_id "
    "HAVING max(CASE WHEN e <> 0 THEN 1 ELSE 0 END) = 1))",
    "hz AS (SELECT * FROM base WHERE date NOT IN (SELECT date FROM rd))",
    "nodes AS (SELECT DISTINCT series_id, gid, level, store_id, category FROM lv2)",
)


def _base(*more: str, model=LAG_BASE) -> str:
    return _with(*LEVEL_CTES, RD_SQL, *model, *TAIL_CTES, *more)


# --- H1-H4, J9 ----------------------------------------------------------------------------------------

@query("hierarchy_nodes", "H1 H3 H4",
       _base() + "SELECT n.series_id, n.gid, n.level, n.store_id, n.category, CAST((SELECT count(*) FROM bs WHERE "
       "(n.store_id IS NULL OR bs.store_id = n.store_id) AND (n.category IS NULL OR bs.category = n.category)) AS BIGINT) AS n_leaves "
       "FROM nodes n")
def hierarchy_nodes(spark, sf_dir):
    return nodes(spark, sf_dir)


@query("summing_edges", "H2 J9",
       _base() + "SELECT n.series_id, b.series_id AS bottom_id FROM nodes n JOIN nodes b ON b.gid = 0 "
       "AND (n.store_id IS NULL OR n.store_id = b.store_id) AND (n.category IS NULL OR n.category = b.category)")
def summing_edges(spark, sf_dir):
    return H.summing_edges(nodes(spark, sf_dir))


@query("level_index", "H3 H4",
       _base() + "SELECT level, gid, count(*) AS n_series FROM nodes GROUP BY level, gid")
def level_index(spark, sf_dir):
    return nodes(spark, sf_dir).groupBy("level", "gid").agg(F.count(F.lit(1)).alias("n_series"))


# --- H7-H9, A20, A22, H17 ---------------------------------------------------------------------------------

@query("assemble_levels", "H5 H6 H7 U2",
       _base() + "SELECT series_id, level, store_id, category, date, y, yhat FROM hz")
def assemble_levels(spark, sf_dir):
    _, _, _, hz = parts(spark, sf_dir)
    return hz.select("series_id", "level", "store_id", "category", "date", "y", "yhat")


@query("residuals_long", "H8 H9 P20 P16",
       _base() + "SELECT series_id, date, round(e, 6) AS e FROM res")
def residuals_long(spark, sf_dir):
    _, _, res, _ = parts(spark, sf_dir)
    return res.withColumn("e", F.round("e", 6))


class Context:
    """Inputs shared by every reconciliation method of one query: base, residual dates,
    residuals, horizon and nodes are computed (and written) once, the Gram table lazily."""

    def __init__(self, spark, sf_dir, forecast=base):
        self.spark, self.sf_dir = spark, sf_dir
        self.b, self.rd, self.res, self.hz = parts(spark, sf_dir, forecast)
        self.nd = nodes(spark, sf_dir, self.b)
        self.vectors = self.b.join(self.rd, "date", "left_semi").withColumn("e", F.col("yhat") - F.col("y"))
        R.check_inputs(self.hz, self.vectors)       # H22
        self._gram = None

    def gram(self):
        if self._gram is None:
            self._gram = gram_and_index(self.spark, self.sf_dir, self)
        return self._gram


def gram_and_index(spark, sf_dir, ctx: "Context | None" = None):
    if ctx is None:
        b, _, res, hz = parts(spark, sf_dir)
        nd = nodes(spark, sf_dir, b)
    else:
        res, hz, nd = ctx.res, ctx.hz, ctx.nd
    live = nd.join(res.select("series_id").distinct(), "series_id", "left_semi")
    # The Gram table and the series index are hierarchy-sized; writing them to the
    # checkpoint folder cuts the long lineage they are reused from (solve, lambda, apply).
    index = cut_lineage(R.series_index(live))
    gram = cut_lineage(H.partial_gram(res, index))
    return gram, index, nd, res, hz


@query("residual_moments", "A20",
       _base() + "SELECT a.series_id AS series_i, b.series_id AS series_j, round(sum(a.e * b.e) / count(*), 6) AS w "
       "FROM res a JOIN res b ON a.date = b.date AND a.series_id <= b.series_id GROUP BY ALL")
def residual_moments(spark, sf_dir):
    gram, index, *_ = gram_and_index(spark, sf_dir)
    t = gram.where("i = -1").select("w_sum").scalar()
    ii = index.select(F.col("idx").alias("i"), F.col("series_id").alias("series_i"))
    jj = index.select(F.col("idx").alias("j"), F.col("series_id").alias("series_j"))
    return gram.where("i >= 0").join(ii, "i").join(jj, "j").select(
        "series_i", "series_j", F.round(F.col("w_sum") / t, 6).alias("w"))


@query("residual_checks", "A22 H22",
       _base() + "SELECT (SELECT count(DISTINCT series_id) FROM res0) AS n_series, "
       "(SELECT count(*) FROM (SELECT series_id FROM res0 GROUP BY series_id HAVING sum(e * e) = 0)) AS n_zero_var, "
       "(SELECT count(DISTINCT date) FROM res0) AS n_dates")
def residual_checks(spark, sf_dir):
    b, rd, _, _ = parts(spark, sf_dir)
    e = F.col("yhat") - F.col("y")
    per = b.join(rd, "date", "left_semi").groupBy("series_id").agg(F.sum(e * e).alias("ss"))
    return per.agg(F.count(F.lit(1)).alias("n_series"), F.count_if(F.col("ss") == 0).alias("n_zero_var")) \
              .withColumn("n_dates", rd.select(F.count("date")).scalar())


LAMBDA_SQL = _base(
    "t AS (SELECT count(DISTINCT date) AS t FROM res)",
    "dg AS (SELECT series_id, sum(e * e) / (SELECT t FROM t) AS d FROM res GROUP BY series_id)",
    "pr AS (SELECT a.series_id AS si, b.series_id AS sj, sum(a.e * b.e) / (SELECT t FROM t) AS w, sum(a.e * a.e * b.e * b.e) AS q "
    "FROM res a JOIN res b ON a.date = b.date AND a.series_id < b.series_id GROUP BY ALL)",
    "rr AS (SELECT pr.*, di.d AS di, dj.d AS dj, pr.w / sqrt(di.d * dj.d) AS r FROM pr JOIN dg di ON di.series_id = pr.si "
    "JOIN dg dj ON dj.series_id = pr.sj)",
    "agg AS (SELECT sum((q / (di * dj) - (SELECT t FROM t) * r * r) / ((SELECT t FROM t) * ((SELECT t FROM t) - 1))) AS sv, "
    "sum(r * r) AS sr FROM rr)")


@query("shrinkage_lambda", "H17 H25",
       LAMBDA_SQL + "SELECT round(greatest(least(sv / sr, 1.0), 0.0), 6) AS lambda, (SELECT t FROM t) AS n_dates FROM agg")
def shrinkage_lambda(spark, sf_dir):
    gram, *_ = gram_and_index(spark, sf_dir)
    return R.shrinkage_lambda(gram).withColumn("lambda", F.round("lambda", 6))


# --- R1 / BU ---------------------------------------------------------------------------------------------

def reconciled(spark, sf_dir, method: str, ctx: Context | None = None, rows=None):
    """Reconcile ``rows`` (default: the horizon) with the weights of ``ctx``."""
    R.check_method(method)
    ctx = ctx or Context(spark, sf_dir)
    rows = ctx.hz if rows is None else rows
    if method in ("MinTSa", "MinTSh"):
        return R.reconcile_mint(rows, ctx.vectors, method)
    if method == "BU":
        return R.reconcile_bu(rows)
    w = R.diagonal_weights(method, ctx.nd, ctx.res)
    return R.reconcile_tree(rows, w)


def _out(df):
    return df.select("series_id", "date", F.round("yhat", 6).alias("yhat"), F.round("yhat_rec", 6).alias("yhat_rec"))


WEIGHT_SQL = {
    "OLS": "wt AS (SELECT series_id, 1.0 AS w FROM nodes)",
    "SS": "wt AS (SELECT n.series_id, CAST((SELECT count(*) FROM bs WHERE (n.store_id IS NULL OR bs.store_id = n.store_id) "
          "AND (n.category IS NULL OR bs.category = n.category)) AS DOUBLE) AS w FROM nodes n)",
    "VS": "wt AS (SELECT series_id, avg(e * e) AS w FROM res GROUP BY series_id)",
}


def _rec_ctes(method: str) -> tuple[str, ...]:
    if method == "BU":
        return ("rec AS (SELECT concat_ws('|', coalesce(CAST(store_id AS VARCHAR), '*'), coalesce(category, '*')) AS sid, date, "
                "sum(yhat) AS bval FROM hz WHERE gid = 0 GROUP BY GROUPING SETS ((date, store_id, category), (date, store_id), (date)))",)
    return (
        WEIGHT_SQL[method],
        "b AS (SELECT hz.series_id, hz.store_id, hz.category, hz.gid, hz.date, hz.yhat, wt.w FROM hz JOIN wt ON hz.series_id = wt.series_id)",
        "l2 AS (SELECT store_id, category, date, yhat AS m, w AS v FROM b WHERE gid = 0)",
        "a1 AS (SELECT store_id, date, sum(m) AS bigm, sum(v) AS bigv FROM l2 GROUP BY store_id, date)",
        "n1 AS (SELECT b.store_id, b.date, a1.bigm, a1.bigv, 1 / (1 / b.w + 1 / a1.bigv) AS v, "
        "(1 / (1 / b.w + 1 / a1.bigv)) * (b.yhat / b.w + a1.bigm / a1.bigv) AS m "
        "FROM b JOIN a1 ON b.store_id = a1.store_id AND b.date = a1.date WHERE b.gid = 1)",
        "a0 AS (SELECT date, sum(m) AS bigm, sum(v) AS bigv FROM n1 GROUP BY date)",
        "n0 AS (SELECT b.date, a0.bigm, a0.bigv, (1 / (1 / b.w + 1 / a0.bigv)) * (b.yhat / b.w + a0.bigm / a0.bigv) AS m "
        "FROM b JOIN a0 ON b.date = a0.date WHERE b.gid = 3)",
        "d1 AS (SELECT n1.store_id, n1.date, n1.m + n1.v / n0.bigv * (n0.m - n0.bigm) AS bval FROM n1 JOIN n0 ON n1.date = n0.date)",
        "d2 AS (SELECT l2.store_id, l2.category, l2.date, l2.m + l2.v / n1.bigv * (d1.bval - n1.bigm) AS bval FROM l2 "
        "JOIN n1 ON l2.store_id = n1.store_id AND l2.date = n1.date JOIN d1 ON d1.store_id = l2.store_id AND d1.date = l2.date)",
        "rec AS (SELECT '*|*' AS sid, date, m AS bval FROM n0 UNION ALL "
        "SELECT concat_ws('|', CAST(store_id AS VARCHAR), '*'), date, bval FROM d1 UNION ALL "
        "SELECT concat_ws('|', CAST(store_id AS VARCHAR), category), date, bval FROM d2)",
    )


def _rec_sql(method: str) -> str:
    return (_base(*_rec_ctes(method))
            + "SELECT hz.series_id, hz.date, round(hz.yhat, 6) AS yhat, round(rec.bval, 6) AS yhat_rec "
              "FROM hz LEFT JOIN rec ON hz.series_id = rec.sid AND hz.date = rec.date")


def _make_rec(method):
    def q(spark, sf_dir):
        return _out(reconciled(spark, sf_dir, method))
    return q


for _m, _ids in (("bu", "H12 H18"), ("ols", "H11 H18 R1"), ("ss", "H13 R1"), ("vs", "H14 R1")):
    query(f"reconcile_{_m}", _ids, _rec_sql(_m.upper()))(_make_rec(_m.upper()))
query("reconcile_mint_sample", "H15 R2")(_make_rec("MinTSa"))
query("reconcile_mint_shrink", "H16 R2 H24")(_make_rec("MinTSh"))


# --- H19, H20, H23 ------------------------------------------------------------------------------------

R1_METHODS = ["BU", "OLS", "SS", "VS"]


def _scores_sql() -> str:
    parts_ = []
    for m in R1_METHODS:
        ctes = _rec_ctes(m)
        body = ("SELECT '" + m + "' AS method, hz.level, round(avg(abs(hz.yhat - hz.y)), 6) AS mae_base, "
                "round(avg(abs(rec.bval - hz.y)), 6) AS mae_rec, round(sqrt(avg((hz.yhat - hz.y) * (hz.yhat - hz.y))), 6) AS rmse_base, "
                "round(sqrt(avg((rec.bval - hz.y) * (rec.bval - hz.y))), 6) AS rmse_rec "
                "FROM hz JOIN rec ON hz.series_id = rec.sid AND hz.date = rec.date GROUP BY hz.level")
        parts_.append("(" + "WITH " + ",\n".join(ctes) + "\n" + body + ")")
    return _base() + "\nUNION ALL\n".join(f"SELECT * FROM {p}" for p in parts_)


def _score(df, method):
    return df.groupBy("level").agg(
        F.round(F.avg(F.abs(F.col("yhat") - F.col("y"))), 6).alias("mae_base"),
        F.round(F.avg(F.abs(F.col("yhat_rec") - F.col("y"))), 6).alias("mae_rec"),
        F.round(F.sqrt(F.avg(F.pow(F.col("yhat") - F.col("y"), 2))), 6).alias("rmse_base"),
        F.round(F.sqrt(F.avg(F.pow(F.col("yhat_rec") - F.col("y"), 2))), 6).alias("rmse_rec"),
    ).withColumn("method", F.lit(method))


@query("recon_scores", "H19 A10 A11", _scores_sql())
def recon_scores(spark, sf_dir):
    out = None
    ctx = Context(spark, sf_dir)
    for m in R1_METHODS:
        s = _score(reconciled(spark, sf_dir, m, ctx), m)
        out = s if out is None else out.unionByName(s)
    return out.select("method", "level", "mae_base", "mae_rec", "rmse_base", "rmse_rec")


CROSS_SHARE = 0.25


def _cross_sql() -> str:
    one = []
    for m in R1_METHODS:
        body = ("SELECT hz.date, hz.y, hz.yhat, rec.bval FROM hz JOIN rec ON hz.series_id = rec.sid AND hz.date = rec.date")
        one.append("SELECT '" + m + "' AS method, * FROM (WITH " + ",\n".join(_rec_ctes(m)) + "\n" + body + ")")
    rank = f"row_number() OVER (ORDER BY {HASH.replace(str(SEED), str(SEED + 1))}, date)"
    return _base("al AS (" + "\nUNION ALL\n".join(one) + ")",
                 f"sm AS (SELECT date FROM (SELECT date, {rank} AS r, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM hz)) WHERE r <= floor(n * {CROSS_SHARE}))",
                 "pd AS (SELECT method, date, date IN (SELECT date FROM sm) AS sampled, avg(abs(yhat - y)) AS ab, avg(abs(bval - y)) AS ar, "
                 "avg((yhat - y) * (yhat - y)) AS sb, avg((bval - y) * (bval - y)) AS sr FROM al GROUP BY ALL)",
                 "sc AS (SELECT 'all' AS scope, * FROM pd UNION ALL SELECT 'sampled' AS scope, * FROM pd WHERE sampled)").replace(
                     "hz AS (", "hz AS MATERIALIZED (").replace("base AS (", "base AS MATERIALIZED (") + (
        "SELECT method, scope, round(avg(ab), 6) AS mase_base, round(avg(ar), 6) AS mase_rec, round(avg(sb), 6) AS mse_base, round(avg(sr), 6) AS mse_rec, "
        "round(avg(sqrt(sb)), 6) AS rmse_base, round(avg(sqrt(sr)), 6) AS rmse_rec, count(*) AS n_dates FROM sc GROUP BY method, scope")


@query("recon_cross_scores", "H19 H20", _cross_sql())
def recon_cross_scores(spark, sf_dir):
    """Mean over forecast dates of each date's scores over all series, on all dates and on a seeded sample
    of them. ``mase`` is the mean absolute error, as the scores are defined; mse is a mean square (Q19)."""
    ctx = Context(spark, sf_dir)
    some = cut_lineage(splits.sample_dates(ctx.hz, CROSS_SHARE, SEED + 1)).withColumn("sampled", F.lit(True))
    rows = None
    for m in R1_METHODS:
        part = reconciled(spark, sf_dir, m, ctx).select(F.lit(m).alias("method"), "date", "y", "yhat", "yhat_rec")
        rows = part if rows is None else rows.unionByName(part)
    b, r = F.col("yhat") - F.col("y"), F.col("yhat_rec") - F.col("y")
    per = rows.where("yhat_rec is not null").groupBy("method", "date").agg(
        F.avg(F.abs(b)).alias("ab"), F.avg(F.abs(r)).alias("ar"), F.avg(b * b).alias("sb"), F.avg(r * r).alias("sr"))
    scope = F.explode(F.when(F.col("sampled"), F.array(F.lit("all"), F.lit("sampled"))).otherwise(F.array(F.lit("all")))).alias("scope")
    out = per.join(some, "date", "left").select("*", scope).groupBy("method", "scope").agg(
        *[F.round(F.avg(c), 6).alias(n) for c, n in (("ab", "mase_base"), ("ar", "mase_rec"), ("sb", "mse_base"), ("sr", "mse_rec"))],
        F.round(F.avg(F.sqrt("sb")), 6).alias("rmse_base"), F.round(F.avg(F.sqrt("sr")), 6).alias("rmse_rec"), F.count("*").alias("n_dates"))
    return out


@query("recon_method_compare", "H20 H23")
def recon_method_compare(spark, sf_dir):
    """Per-date RMSE over all series (cross_score), averaged over dates, per method."""
    out = None
    ctx = Context(spark, sf_dir)
    for m in R.METHODS:
        r = reconciled(spark, sf_dir, m, ctx)
        per_date = r.groupBy("date").agg(F.sqrt(F.avg(F.pow(F.col("yhat_rec") - F.col("y"), 2))).alias("rmse"),
                                         F.avg(F.abs(F.col("yhat_rec") - F.col("y"))).alias("mae"))
        s = per_date.agg(F.round(F.avg("rmse"), 6).alias("mean_rmse"), F.round(F.avg("mae"), 6).alias("mean_mae"),
                         F.count(F.lit(1)).alias("n_dates")).withColumn("method", F.lit(m))
        out = s if out is None else out.unionByName(s)
    return out


# --- H21, A19, A23 --------------------------------------------------------------------------------------

def bootstrap(spark, sf_dir, samples: int | None = None, alpha: float = 0.1, method: str = "OLS",
              centred: bool = True, ctx: Context | None = None):
    """Intervals from reconciled forecasts perturbed by whole residual vectors. Reconciling is
    linear, so the horizon and the residual vectors are reconciled once each and added; nothing is
    replicated before the tree passes, and any method works. By default every residual date is
    a draw, so the draws' quantiles are one aggregate per series; ``samples`` instead picks that many
    residual dates per horizon date by seeded hash. A residual is forecast minus actual: ``centred``
    subtracts it, else it is added (which doubles a bias)."""
    ctx = ctx or Context(spark, sf_dir)
    rec = reconciled(spark, sf_dir, method, ctx).select("series_id", "level", "date", "y", F.col("yhat_rec").alias("m"))
    vectors = ctx.vectors.withColumn("yhat", F.col("e")).drop("e")
    sign = F.lit(-1.0 if centred else 1.0)
    e = reconciled(spark, sf_dir, method, ctx, vectors).select("series_id", F.col("date").alias("rdate"),
                                                               (sign * F.col("yhat_rec")).alias("e"))
    probs = F.array(F.lit(alpha / 2), F.lit(0.5), F.lit(1 - alpha / 2))
    if samples is None:
        q = rec.join(e.groupBy("series_id").agg(F.percentile("e", probs).alias("q")), "series_id")
    else:
        ranked = splits.ranked_dates(ctx.rd).select(F.col("date").alias("rdate"), "rank")
        n = ctx.rd.select(F.count("date")).scalar()
        draws = rec.select("date").distinct().select("date", F.explode(F.sequence(F.lit(1), F.lit(samples))).alias("s"))
        draws = draws.select("date", F.pmod(splits.date_hash("date", F.col("s") + SEED), n).alias("rank"))
        q = draws.join(ranked, "rank").join(e, "rdate").groupBy("date", "series_id").agg(F.percentile("e", probs).alias("q"))
        q = rec.join(q, ["date", "series_id"])
    return q.select("series_id", "level", "date", "y", *[F.round(F.col("m") + F.col("q")[i], 6).alias(c)
                                                         for i, c in enumerate(("q_lo", "q_mid", "q_hi"))])


def _boot_ctes() -> tuple[str, ...]:
    ctes = ",\n".join(_rec_ctes("OLS"))
    return ("he AS (SELECT * EXCLUDE (yhat), yhat - y AS yhat FROM base WHERE date IN (SELECT date FROM rd))",
            f"rech AS (SELECT * FROM (WITH {ctes} SELECT sid, date, bval FROM rec))",
            f"rece AS (SELECT * FROM (WITH {ctes.replace('hz', 'he')} SELECT sid, date, bval FROM rec))",
            "rq AS (SELECT sid, quantile_cont(-bval, 0.05) AS lo, quantile_cont(-bval, 0.5) AS mid, quantile_cont(-bval, 0.95) AS hi "
            "FROM rece GROUP BY sid)",
            "iv AS (SELECT hz.series_id, hz.level, hz.date, hz.y, round(r.bval + rq.lo, 6) AS q_lo, round(r.bval + rq.mid, 6) AS q_mid, "
            "round(r.bval + rq.hi, 6) AS q_hi FROM hz JOIN rech r ON hz.series_id = r.sid AND hz.date = r.date JOIN rq ON rq.sid = hz.series_id)")


@query("bootstrap_intervals", "H21 A19", _base(*_boot_ctes()) + "SELECT * FROM iv")
def bootstrap_intervals(spark, sf_dir):
    return bootstrap(spark, sf_dir)


@query("interval_miss_counts", "A23 A14",
       _base(*_boot_ctes()) + "SELECT level, count(*) FILTER (WHERE y < q_lo) AS n_below, count(*) FILTER (WHERE y > q_hi) AS n_above, "
       "round(avg(CAST(y BETWEEN q_lo AND q_hi AS DOUBLE)), 6) AS coverage, count(*) AS n FROM iv GROUP BY level")
def interval_miss_counts(spark, sf_dir):
    b = bootstrap(spark, sf_dir)
    return b.groupBy("level").agg(F.count_if(F.col("y") < F.col("q_lo")).alias("n_below"),
                                  F.count_if(F.col("y") > F.col("q_hi")).alias("n_above"),
                                  F.round(F.avg(F.col("y").between(F.col("q_lo"), F.col("q_hi")).cast("double")), 6).alias("coverage"),
                                  F.count(F.lit(1)).alias("n"))


# --- H5, H8, H10: a fitted model per series, its residuals, and its reconciliation ---------------------------

@query("level_forecasts", "H5 H8 H10 P19",
       _base(model=FIT_BASE) + "SELECT series_id, level, date, y, yhat FROM hz")
def level_forecasts(spark, sf_dir):
    _, _, _, hz = parts(spark, sf_dir, fitted)
    return hz.select("series_id", "level", "date", "y", "yhat")


@query("level_residuals", "H8 H9 P19 P20",
       _base(model=FIT_BASE) + "SELECT series_id, date, round(e, 6) AS e FROM res")
def level_residuals(spark, sf_dir):
    _, _, res, _ = parts(spark, sf_dir, fitted)
    return res.withColumn("e", F.round("e", 6))


def _make_fitted_rec(method):
    def q(spark, sf_dir):
        return _out(reconciled(spark, sf_dir, method, Context(spark, sf_dir, fitted)))
    return q


for _m, _ids in (("ols", "H10 H11 R1"), ("vs", "H10 H14 R1")):
    query(f"reconcile_fitted_{_m}", _ids,
          _base(*_rec_ctes(_m.upper()), model=FIT_BASE)
          + "SELECT hz.series_id, hz.date, round(hz.yhat, 6) AS yhat, round(rec.bval, 6) AS yhat_rec "
            "FROM hz LEFT JOIN rec ON hz.series_id = rec.sid AND hz.date = rec.date")(_make_fitted_rec(_m.upper()))
query("reconcile_fitted_mint", "H10 H16 R2")(_make_fitted_rec("MinTSh"))


# --- H24, J12, L4: serve the reconciled forecast ---------------------------------------------------------------

@query("lookup_reconciled", "H24 J12 L4 L6",
       _base(*_rec_ctes("OLS"),
             "rq AS (SELECT o.o_orderkey AS request_id, CAST(o.o_orderdate AS DATE) AS date, CAST(n.n_regionkey AS INTEGER) AS store_id "
             "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)",
             "sv AS (SELECT * FROM (SELECT hz.store_id, hz.date, rec.bval AS v FROM hz JOIN rec ON hz.series_id = rec.sid AND hz.date = rec.date "
             "WHERE hz.gid = 1))",
             "hi AS (SELECT store_id, date, CAST(y AS DOUBLE) AS v FROM lv2 WHERE gid = 1)", model=FIT_BASE)
       + "SELECT rq.request_id, rq.store_id, rq.date, CASE WHEN sv.v IS NOT NULL THEN 'forecast' WHEN hi.v IS NOT NULL THEN 'history' END AS source, "
         "round(coalesce(sv.v, hi.v), 6) AS value, CAST(coalesce(sv.v, hi.v) IS NOT NULL AS INTEGER) AS available FROM rq "
         "LEFT JOIN sv ON sv.store_id = rq.store_id AND sv.date = rq.date LEFT JOIN hi ON hi.store_id = rq.store_id AND hi.date = rq.date")
def lookup_reconciled(spark, sf_dir):
    """Every order is a request for its store and day: the reconciled forecast where there is one, else
    the day's actual, else available = 0."""
    ctx = Context(spark, sf_dir, fitted)
    served = reconciled(spark, sf_dir, "OLS", ctx).where("gid = 1").select("store_id", "date", F.col("yhat_rec").alias("_f"))
    history = levels(spark, sf_dir).where("gid = 1").select("store_id", "date", F.col("y").cast("double").alias("_h"))
    return lookup.serve(adapters.order_requests(spark, sf_dir), served, history)


# --- O8, O2: seeded sample of at most five series per level, for export -----------------------------------

@query("series_sample_export", "O8 O2 O1",
       _base() + "SELECT level, series_id, store_id, category, CAST(rk AS INTEGER) AS rank FROM (SELECT *, row_number() OVER "
       "(PARTITION BY level ORDER BY md5(series_id), series_id) AS rk FROM nodes) WHERE rk <= 5")
def series_sample_export(spark, sf_dir):
    """A sampling operator: up to 5 series per level, ordered by a seeded-free stable hash
    (``md5``); windows are partitioned by level over the node table (hierarchy-sized)."""
    from pyspark.sql import Window
    n = nodes(spark, sf_dir)
    w = Window.partitionBy("level").orderBy(F.md5("series_id"), "series_id")
    return n.select("level", "series_id", "store_id", "category", F.row_number().over(w).cast("int").alias("rank")) \
            .where("rank <= 5")


# --- J8, F11: attach actuals to forecast rows by date; day-month-year key -----------------------------------

@query("forecast_date_keys", "J8 F11 H6",
       _base("tot AS (SELECT date, y FROM lv2 WHERE gid = 3)").replace("lv2 AS (", "lv2 AS MATERIALIZED (").replace(
           "rd AS (", "rd AS MATERIALIZED (").replace("base AS (", "base AS MATERIALIZED (")
       + "SELECT hz.series_id, hz.date, concat_ws('-', CAST(day(hz.date) AS VARCHAR), CAST(month(hz.date) AS VARCHAR), "
         "CAST(year(hz.date) AS VARCHAR)) AS date_key, hz.yhat, tot.y AS total_actual FROM hz LEFT JOIN tot ON hz.date = tot.date "
         "WHERE hz.gid = 3")
def forecast_date_keys(spark, sf_dir):
    _, _, _, hz = parts(spark, sf_dir)
    key = F.concat_ws("-", F.dayofmonth("date").cast("string"), F.month("date").cast("string"), F.year("date").cast("string"))
    # actuals of dates before the first forecast date are not in ``b``: take them from the levels
    lv = levels(spark, sf_dir).where("gid = 3").select("date", F.col("y").alias("total_actual"))
    return hz.where("gid = 3").select("series_id", "date", key.alias("date_key"), "yhat").join(lv, "date", "left")
