"""Model operators (2.13) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.keys import CAR
from paceline.operators import features as fe, models as mo, stats as st
from paceline.operators.ranks import normalise_in_race
from paceline.plans import bindings as b
from paceline.plans.features import LINES, dataset
from paceline.plans.registry import query
from paceline.plans.statistics import SCORED, scored
from paceline.session import scratch_path

R = "race_date, place_code, race_no"
# The features of the models that the driver tables bind.
NUMERIC = ["age", "heikin_tokuten", "nige_cnt", "makuri_cnt", "sasi_cnt", "syouritu", "rentairitu2", "rentairitu3", "car_no",
           "syouritu_rank", "rentairitu2_rank", "rentairitu3_rank", "heikin_tokuten_rank", "age_rank", "syouritu_gap", "rentairitu2_gap",
           "heikin_tokuten_gap", "race_n_cars", "race_mean_syouritu", "race_std_syouritu", "n_nige_in_race", "n_oikomi_in_race",
           "n_ryouten_in_race", "n_S_class_in_race"]
LINE_NUMERIC = ["line_size", "line_pos", "is_line_head", "is_line_second", "is_line_third_plus", "is_tanki", "pos_ratio", "n_lines_in_race",
                "max_line_size", "is_in_largest_line", "line_size_rank", "n_tanki_in_race", "head_nige_propensity"]
CATEGORICAL = ["place_code", "grade", "kyuhan", "kyaku"]

ANCHOR = {
    **SCORED,
    "anchor": f"""SELECT * FROM (SELECT {R}, car_no, y_win AS win, (p_win + p_top2) / sum(p_win + p_top2) OVER w AS mkt_win, p_win FROM scored
      WINDOW w AS (PARTITION BY {R})) WHERE p_win > 0 QUALIFY sum(win) OVER (PARTITION BY {R}) = 1""",
    "logs": f"""SELECT *, ln(least(greatest(mkt_win, 1e-9), 1)) AS q, ln(least(greatest(p_win, 1e-9), 1)) AS m FROM anchor""",
}


def anchor(spark, sf):
    """Market = mean of two scores, model = the first of them, races with one winner."""
    s = scored(spark, sf)
    market = normalise_in_race(s.select(*CAR, (F.col("p_win") + F.col("p_top2")).alias("p")), "p", "mkt_win")
    return mo.anchor_frame(s, b.results(spark, sf), market)


def nll_sql(a: str, z: str) -> str:
    return f"SELECT race_date, race_no, ln(sum(exp({a} * q + {z} * m))) - sum(win * ({a} * q + {z} * m)) AS l FROM logs GROUP BY 1, 2"


@query("cond_logit_nll", f"SELECT count(*) AS n_races, avg(l) AS nll FROM ({nll_sql('0.9', '0.2')})", dbl="nll", ctes=ANCHOR)
def _(spark, sf):
    return mo.cond_logit_nll(mo.race_rows(anchor(spark, sf)), 0.9, 0.2)


@query("cond_logit_step", """
WITH t AS (SELECT race_no, sum(e) AS s, sum(e * q) / sum(e) AS mq, sum(e * m) / sum(e) AS mm, sum(e * q * q) / sum(e) AS qq, sum(e * q * m) / sum(e) AS qm,
  sum(e * m * m) / sum(e) AS m2, sum(win * q) AS wq, sum(win * m) AS wm FROM (SELECT *, exp(q) AS e FROM logs) GROUP BY 1),
d AS (SELECT avg(ln(s) - wq) AS nll, avg(mq - wq) AS ga, avg(mm - wm) AS gb, avg(qq - mq * mq) AS haa, avg(qm - mq * mm) AS hab, avg(m2 - mm * mm) AS hbb FROM t)
SELECT *, 1 - (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a_next, 0 - (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b_next FROM d""",
       dbl="nll ga gb haa hab hbb a_next b_next", ctes=ANCHOR)
def _(spark, sf):
    return mo.newton_step(mo.race_rows(anchor(spark, sf)), 1.0, 0.0)


def cond_newton_sql(steps: int = 25) -> dict[str, str]:
    """Newton steps of the two exponents from (1, 0), each a query over the one before; ``fit_<steps>`` is the last."""
    clip = lambda x: f"greatest(-2, least(2, {x}))"
    out = {"fit_0": "SELECT 1.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS nll, 0::BIGINT AS n_races"}
    for k in range(1, steps + 1):
        out[f"fit_{k}"] = f"""SELECT a - {clip("((hbb + 1e-12) * ga - hab * gb) / ((haa + 1e-12) * (hbb + 1e-12) - hab * hab)")} AS a,
      b - {clip("((haa + 1e-12) * gb - hab * ga) / ((haa + 1e-12) * (hbb + 1e-12) - hab * hab)")} AS b, nll, n_races FROM (
      SELECT any_value(a) AS a, any_value(b) AS b, count(*) AS n_races, avg(ln(s) - a * wq - b * wm) AS nll, avg(mq - wq) AS ga, avg(mm - wm) AS gb,
        avg(qq - mq * mq) AS haa, avg(qm - mq * mm) AS hab, avg(m2 - mm * mm) AS hbb FROM (
        SELECT race_no, any_value(a) AS a, any_value(b) AS b, sum(e) AS s, sum(e * q) / sum(e) AS mq, sum(e * m) / sum(e) AS mm, sum(e * q * q) / sum(e) AS qq,
          sum(e * q * m) / sum(e) AS qm, sum(e * m * m) / sum(e) AS m2, sum(win * q) AS wq, sum(win * m) AS wm
        FROM (SELECT *, exp(a * q + b * m) AS e FROM logs, fit_{k - 1}) GROUP BY 1))"""
    return out


@query("cond_logit_fit", "SELECT a, b, nll, n_races, true AS converged FROM fit_25", dbl="a b nll", ctes={**ANCHOR, **cond_newton_sql()})
def _(spark, sf):
    return mo.cond_logit_fit(mo.race_rows(anchor(spark, sf)))


@query("bootstrap_coef")
def _(spark, sf):
    return mo.bootstrap_coef(mo.race_rows(anchor(spark, sf)), replicates=100)


def empty_history(spark):
    return spark.createDataFrame([], mo.HISTORY)


@query("monthly_refit")
def _(spark, sf):
    frame = anchor(spark, sf)
    days = b.races(spark, sf).agg(F.min("race_date").alias("lo"), F.max("race_date").alias("hi")).first()
    return mo.monthly_refit(frame, empty_history(spark), f"{days.lo:%Y-%m}", str(days.hi)[:10])


COEF = {
    **ANCHOR,
    "coef": """SELECT strftime(race_date, '%Y-%m') AS month, 1 + count(*) / 10000 AS alpha, 1 - count(*) / 5000 AS a, count(*) / 20000 AS z
      FROM races WHERE race_date >= DATE '1996-01-01' GROUP BY 1""",
    "losses": """SELECT strftime(race_date, '%Y-%m') AS month, race_no, ln(sum(exp(m))) - sum(win * m) AS l_model, ln(sum(exp(q))) - sum(win * q) AS l_mkt,
      ln(sum(exp(alpha * q))) - sum(win * alpha * q) AS l_alpha, ln(sum(exp(a * q + z * m))) - sum(win * (a * q + z * m)) AS l_blend
      FROM logs JOIN coef ON strftime(race_date, '%Y-%m') = month GROUP BY 1, 2""",
}


@query("forward_eval_monthly", """
WITH r AS (SELECT coalesce(month, 'total') AS month, count(*) AS n_races, avg(l_model) AS rl_model, avg(l_mkt) AS rl_mkt, avg(l_alpha) AS rl_mkt_alpha,
  avg(l_blend) AS rl_blend FROM losses GROUP BY ROLLUP (month)),
w AS (SELECT coalesce(mon, 'total') AS month, count(*) AS n_rows,
  avg(-(win * ln(least(greatest(p_win, 1e-6), 1 - 1e-6)) + (1 - win) * ln(1 - least(greatest(p_win, 1e-6), 1 - 1e-6)))) AS bl_model,
  avg(-(win * ln(least(greatest(mkt_win, 1e-6), 1 - 1e-6)) + (1 - win) * ln(1 - least(greatest(mkt_win, 1e-6), 1 - 1e-6)))) AS bl_mkt
  FROM (SELECT *, strftime(race_date, '%Y-%m') AS mon FROM anchor) WHERE mon IN (SELECT month FROM coef) GROUP BY ROLLUP (mon))
SELECT * FROM r JOIN w USING (month)""", dbl="rl_model rl_mkt rl_mkt_alpha rl_blend bl_model bl_mkt", ctes=COEF)
def _(spark, sf):
    n = F.count(F.lit(1))
    history = b.races(spark, sf).where(F.col("race_date") >= F.lit("1996-01-01").cast("date")).groupBy(
        F.date_format("race_date", "yyyy-MM").alias("apply_month")).agg(
        (1 + n / 10000).alias("alpha"), (1 - n / 5000).alias("blend_a"), (n / 20000).alias("blend_b"))
    return mo.forward_eval_monthly(anchor(spark, sf), history)


def blend_newton_sql(rows: str, steps: int = 15) -> dict[str, str]:
    """Newton steps of the blend (an intercept and two slopes, C = 1) for each ``fit`` of ``rows``; ``blend_<steps>`` is the last."""
    h = {"h00": "sum(v)", "h01": "sum(v * x1)", "h02": "sum(v * x2)", "h11": "sum(v * x1 * x1) + 1", "h12": "sum(v * x1 * x2)", "h22": "sum(v * x2 * x2) + 1"}
    adj = {"00": "h11 * h22 - h12 * h12", "01": "h02 * h12 - h01 * h22", "02": "h01 * h12 - h02 * h11", "11": "h00 * h22 - h02 * h02",
           "12": "h01 * h02 - h00 * h12", "22": "h00 * h11 - h01 * h01"}
    cell = lambda i, j: f"({adj[f'{min(i, j)}{max(i, j)}']})"
    out = {"blend_0": f"SELECT DISTINCT fit, 0.0::DOUBLE AS c0, 0.0::DOUBLE AS c1, 0.0::DOUBLE AS c2 FROM {rows}"}
    for k in range(1, steps + 1):
        step = [" + ".join(f"{cell(i, j)} * g{j}" for j in range(3)) for i in range(3)]
        news = ", ".join(f"c{i} - greatest(-2, least(2, ({step[i]}) / det)) AS c{i}" for i in range(3))
        out[f"blend_{k}"] = f"""SELECT fit, {news} FROM (SELECT *, h00 * {cell(0, 0)} + h01 * {cell(0, 1)} + h02 * {cell(0, 2)} AS det FROM (
      SELECT fit, any_value(c0) AS c0, any_value(c1) AS c1, any_value(c2) AS c2, sum(p - y) AS g0, sum((p - y) * x1) + any_value(c1) AS g1,
        sum((p - y) * x2) + any_value(c2) AS g2, {", ".join(f"{f} AS {n}" for n, f in h.items())}
      FROM (SELECT *, p * (1 - p) AS v FROM (SELECT *, 1 / (1 + exp(-(c0 + c1 * x1 + c2 * x2))) AS p FROM {rows} JOIN blend_{k - 1} USING (fit))) GROUP BY 1))"""
    return out


def _logit_sql(p: str) -> str:
    return f"ln(least(greatest({p}, 1e-4), 1 - 1e-4) / (1 - least(greatest({p}, 1e-4), 1 - 1e-4)))"


BLEND = {**ANCHOR, "xy": f"SELECT 0 AS fit, {_logit_sql('p_win')} AS x1, {_logit_sql('mkt_win')} AS x2, CAST(win AS DOUBLE) AS y FROM anchor", **blend_newton_sql("xy")}


@query("blend_logit", "SELECT c0 AS intercept, c1 AS coef_model, c2 AS coef_market FROM blend_15", dbl="intercept coef_model coef_market", ctes=BLEND)
def _(spark, sf):
    c = mo.blend_logit(anchor(spark, sf), "p_win", "mkt_win", "win")
    return spark.createDataFrame([tuple(c.values())], "intercept double, coef_model double, coef_market double")


WALK = {
    **ANCHOR,
    "blocked": f"""SELECT {_logit_sql('p_win')} AS x1, {_logit_sql('mkt_win')} AS x2, CAST(win AS DOUBLE) AS y, p_win, mkt_win, blk FROM anchor JOIN (
      SELECT {R}, CAST(floor((row_number() OVER (ORDER BY {R}) - 1) * 5 / count(*) OVER ()) AS INT) AS blk FROM (SELECT DISTINCT {R} FROM anchor)) USING ({R})""",
    "earlier": "SELECT fit, x1, x2, y FROM blocked JOIN (SELECT unnest(range(1, 5)) AS fit) ON blk < fit",
    **blend_newton_sql("earlier"),
    "oof": "SELECT blk, y, p_win, mkt_win, 1 / (1 + exp(-(c0 + c1 * x1 + c2 * x2))) AS blend FROM blocked JOIN blend_15 ON blk = fit",
}
WALK_SCORES = ", ".join(
    f"avg(-(y * ln(least(greatest({p}, 1e-4), 1 - 1e-4)) + (1 - y) * ln(1 - least(greatest({p}, 1e-4), 1 - 1e-4)))) AS ll_{n}, avg(({p} - y) * ({p} - y)) AS brier_{n}"
    for n, p in (("model", "p_win"), ("market", "mkt_win"), ("blend", "blend")))


@query("walk_forward", f"SELECT CAST(blk AS BIGINT) AS blk, count(*) AS n, {WALK_SCORES} FROM oof GROUP BY 1",
       dbl="ll_model brier_model ll_market brier_market ll_blend brier_blend", ctes=WALK)
def _(spark, sf):
    return mo.walk_forward_scores(mo.walk_forward(anchor(spark, sf), "p_win", "mkt_win", "win"), "p_win", "mkt_win", "win")


ISOTONIC = {
    **SCORED,
    "numbered": f"SELECT {R}, floor((row_number() OVER (ORDER BY {R}) - 1) * 2 / count(*) OVER ()) AS blk FROM (SELECT DISTINCT {R} FROM scored)",
    "halves": "SELECT y_win, round(p_win * 1000) / 1000 AS p, blk FROM scored JOIN numbered USING (race_date, place_code, race_no)",
    "points": """SELECT p, row_number() OVER (ORDER BY p) AS i, sum(n) OVER (ORDER BY p) AS cn, sum(y) OVER (ORDER BY p) AS cy
      FROM (SELECT p, count(*) AS n, sum(y_win) AS y FROM halves WHERE blk = 0 GROUP BY 1)""",
    # The fit at i is the largest, over all starts j up to i, of the smallest mean from j to any end k from i on.
    "lows": """SELECT k.i, min((k.cy - coalesce(b.cy, 0)) / (k.cn - coalesce(b.cn, 0))) OVER (PARTITION BY j.i ORDER BY k.i DESC) AS low
      FROM points j JOIN points k ON k.i >= j.i LEFT JOIN points b ON b.i = j.i - 1""",
    "fitted": "SELECT p, v, lead(p) OVER (ORDER BY p) AS q, lead(v) OVER (ORDER BY p) AS w FROM points JOIN (SELECT i, max(low) AS v FROM lows GROUP BY 1) USING (i)",
    "cal": """SELECT y_win AS y, h.p AS r, coalesce(f.v + (coalesce(f.w, f.v) - f.v) * coalesce((h.p - f.p) / (f.q - f.p), 0), (SELECT min(v) FROM fitted)) AS c
      FROM (SELECT * FROM halves WHERE blk = 1) h ASOF LEFT JOIN fitted f ON h.p >= f.p""",
}


def _loss_sql(p: str) -> str:
    q = f"least(greatest({p}, 1e-6), 1 - 1e-6)"
    return f"avg(-(y * ln({q}) + (1 - y) * ln(1 - {q})))"


@query("isotonic_calibrate", f"""
SELECT count(*) AS n, {_loss_sql("r")} AS ll_raw, {_loss_sql("c")} AS ll_calibrated, avg((r - y) * (r - y)) AS brier_raw, avg((c - y) * (c - y)) AS brier_calibrated FROM cal""",
       dbl="ll_raw ll_calibrated brier_raw brier_calibrated", ctes=ISOTONIC)
def _(spark, sf):
    """Scores in per mille, so that the SQL's pairs of scores stay few."""
    rows = scored(spark, sf).withColumn("p_win", F.round(F.col("p_win") * 1000) / 1000)
    return mo.isotonic_calibrate(rows, "y_win", "p_win")


RESIDUAL = {
    **LINES, **SCORED,
    "covered": f"""SELECT s.race_date, s.place_code, s.race_no, s.car_no, y_win AS win, p_win / sum(p_win) OVER (PARTITION BY s.race_date, s.place_code, s.race_no) AS mkt_win,
      line_size, pos_ratio FROM scored s JOIN real_lines l ON s.race_no = l.race_no AND s.car_no = l.car_no""",
}


def residual(spark, sf):
    r = b.runners(spark, sf)
    market = b.predictions(spark, sf).select(*CAR, F.col("p_win").alias("mkt_win"))
    return mo.residual_dataset(market, fe.real_line_features(b.narabi(spark, sf), r), b.results(spark, sf))


@query("residual_dataset", f"SELECT {R}, car_no, win, mkt_win, line_size, pos_ratio FROM covered QUALIFY sum(win) OVER (PARTITION BY {R}) = 1",
       dbl="mkt_win pos_ratio", dt="race_date", ctes=RESIDUAL)
def _(spark, sf):
    return residual(spark, sf).select(*CAR, "win", "mkt_win", "line_size", "pos_ratio")


@query("market_residual_model")
def _(spark, sf):
    feats = ["line_size", "line_pos", "is_line_head", "pos_ratio", "n_lines_in_race", "is_in_largest_line", "head_nige_propensity"]
    return mo.market_residual_model(residual(spark, sf), feats, "1998-12-31", "1999-12-31")


_SAVED: dict[tuple[str, str], str] = {}


def trained(spark, sf):
    """Boosters on the races before 2000, fitted once per application, saved and loaded from there.

    Rounds, depth and patience are the operator's defaults. The candidate ``line`` has the line features
    too and is fitted for the win target, which is what it is compared on.
    """
    df = dataset(spark, sf)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SAVED:
        train = fe.split_by_date(df, "1999-12-31", "2000-01-01").where(F.col("split") == "train")
        path = scratch_path(spark, "boosters")
        arms = {"line": ("y_win", [*NUMERIC, *LINE_NUMERIC], CATEGORICAL)}
        mo.save_boosters(mo.train_targets(train, NUMERIC, CATEGORICAL, arms=arms), spark, path)
        _SAVED[key] = path
    return mo.load_boosters(spark, _SAVED[key]), df.where(F.col("race_date") >= F.lit("2000-01-01").cast("date"))


@query("score_batch")
def _(spark, sf):
    return mo.score_batch(*trained(spark, sf))


@query("train_targets")
def _(spark, sf):
    models, test = trained(spark, sf)
    rows = mo.score_batch(models, test, [*CAR, "y_win", "y_top2", "y_top3", "y_rank"])
    return rows.agg(
        F.count(F.lit(1)).alias("n"), *[st.log_loss(F.col(y), F.col(p)).alias(f"ll_{p}") for y, p in mo.CLF_TARGETS.items()],
        st.mae(F.col("y_rank"), F.col("pred_rank")).alias("mae_rank"), *[F.lit(len(m.trees)).alias(f"rounds_{y}") for y, m in models.items()])


@query("feature_importance")
def _(spark, sf):
    models, _ = trained(spark, sf)
    return mo.feature_importance(spark, {y: models[y] for y in (*mo.CLF_TARGETS, "y_rank")}, [*NUMERIC, *CATEGORICAL])


@query("ab_score")
def _(spark, sf):
    models, test = trained(spark, sf)
    return mo.ab_score(models["y_win"], models["line"], test)
