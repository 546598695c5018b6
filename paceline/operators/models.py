"""Model operators (2.13): conditional logit, blends, boosted trees, residual model."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paceline.functions.numeric import logit, sigmoid
from paceline.keys import CAR, RACE, in_race
from paceline.operators import ranks
from paceline.operators.boosting import Booster, Fit as Boost, Shape, fit_boosters, load_boosters, save_boosters, scored
from paceline.operators.cleaning import where_over
from paceline.operators.conditional import (
    HISTORY, Fit, anchor_frame, bootstrap_coef, cond_logit_fit, cond_logit_nll, fit_all, forward_eval_monthly, interval,
    monthly_refit, newton_step, race_blocks, race_nll, race_rows, resampled)
from paceline.operators.isotonic import calibrated, isotonic_blocks
from paceline.operators.stats import auc, brier, log_loss
from paceline.session import staged

__all__ = [
    "HISTORY", "anchor_frame", "bootstrap_coef", "cond_logit_fit", "cond_logit_nll", "forward_eval_monthly", "monthly_refit",
    "newton_step", "race_nll", "race_rows", "save_boosters", "load_boosters"]

# --- blends ------------------------------------------------------------------------------------


def blend_fits(rows: DataFrame, model: str, market: str, y: str, c: float = 1.0, max_iter: int = 50, tol: float = 1e-11) -> dict[int, np.ndarray]:
    """Logistic regressions on both logits, one per value of ``fit`` (a few whole numbers), all in the same Newton passes.

    The sum of the losses plus the squares of the two slopes over 2 C is least. Nine sums per fit and
    pass reach the driver. A pass with a step of less than ``tol`` is the last.
    """
    xy = staged(rows.select("fit", logit(F.col(model)).alias("x1"), logit(F.col(market)).alias("x2"), F.col(y).cast("double").alias("y")), "blend")
    ridge, found = np.diag([0.0, 1 / c, 1 / c]), {}
    live = {r["fit"]: np.zeros(3) for r in xy.select("fit").distinct().collect()}
    for _ in range(max_iter):
        if not live:
            break
        at = F.create_map(*[x for k, v in live.items() for x in (F.lit(k), F.array(*[F.lit(float(u)) for u in v]))])
        z = F.get("_c", 0) + F.get("_c", 1) * F.col("x1") + F.get("_c", 2) * F.col("x2")
        p = xy.withColumn("_c", F.element_at(at, F.col("fit"))).where("_c IS NOT NULL").withColumn("p", sigmoid(z))
        x, d, v = [F.lit(1.0), F.col("x1"), F.col("x2")], F.col("p") - F.col("y"), F.col("p") * (1 - F.col("p"))
        pairs = [(i, j) for i in range(3) for j in range(i, 3)]
        sums = p.groupBy("fit").agg(*[F.sum(d * x[i]).alias(f"g{i}") for i in range(3)], *[F.sum(v * x[i] * x[j]).alias(f"h{i}{j}") for i, j in pairs]).collect()
        for r in sums:
            w, h = live[r["fit"]], np.zeros((3, 3))
            for i, j in pairs:
                h[i, j] = h[j, i] = r[f"h{i}{j}"]
            step = np.clip(np.linalg.solve(h + ridge + 1e-12 * np.eye(3), np.array([r[f"g{i}"] for i in range(3)]) + ridge @ w), -2.0, 2.0)
            live[r["fit"]] = found[r["fit"]] = w - step
            if np.abs(step).max() < tol:
                del live[r["fit"]]
    return found


def _coefficients(w: np.ndarray) -> dict[str, float]:
    return {"intercept": float(w[0]), "coef_model": float(w[1]), "coef_market": float(w[2])}


def blend_logit(df: DataFrame, model: str, market: str, y: str, c: float = 1.0) -> dict[str, float]:
    """Logistic regression on both logits with the L2 weight 1/C."""
    return _coefficients(blend_fits(df.withColumn("fit", F.lit(0)), model, market, y, c)[0])


def apply_blend(model: str, market: str, c: dict[str, float]) -> Column:
    return sigmoid(c["intercept"] + c["coef_model"] * logit(F.col(model)) + c["coef_market"] * logit(F.col(market)))


def walk_forward(df: DataFrame, model: str, market: str, y: str, k: int = 5) -> DataFrame:
    """``k`` ordered blocks of races: fit on the earlier ones, score the next. Rows of blocks 1..k-1; the fits run side by side."""
    blocks = ranks.block_split(df.select(*RACE), k).select(*RACE, "blk")
    rows = staged(df.join(blocks, RACE), "blocks")
    earlier = rows.where(F.col("blk") < k - 1).withColumn("fit", F.explode(F.sequence(F.col("blk").cast("int") + 1, F.lit(k - 1))))
    blend = F.lit(None).cast("double")
    for i, w in blend_fits(earlier, model, market, y).items():
        blend = F.when(F.col("blk") == i, apply_blend(model, market, _coefficients(w))).otherwise(blend)
    return rows.where(F.col("blk") > 0).withColumn("blend", blend)


def walk_forward_scores(oof: DataFrame, model: str, market: str, y: str) -> DataFrame:
    label = F.col(y)
    cols = []
    for name, p in (("model", model), ("market", market), ("blend", "blend")):
        cols += [log_loss(label, F.col(p), 1e-4).alias(f"ll_{name}"), brier(label, F.col(p)).alias(f"brier_{name}")]
    return oof.groupBy("blk").agg(F.count(F.lit(1)).alias("n"), *cols)


def isotonic_calibrate(df: DataFrame, y: str, p: str) -> DataFrame:
    """Fit on the earlier half of the races, compare raw and calibrated scores on the later half."""
    halves = ranks.block_split(df.select(*RACE), 2).select(*RACE, "blk")
    rows = staged(df.select(*RACE, F.col(y).cast("double").alias("label"), F.col(p).alias("score")).join(halves, RACE), "halves")
    blocks = isotonic_blocks(rows.where("blk = 0").select("score", "label", F.lit(1.0).alias("weight")))
    later = calibrated(rows.where("blk = 1"), "score", blocks, "calibrated")
    return later.agg(
        F.count(F.lit(1)).alias("n"), log_loss(F.col("label"), F.col("score")).alias("ll_raw"), log_loss(F.col("label"), F.col("calibrated")).alias("ll_calibrated"),
        brier(F.col("label"), F.col("score")).alias("brier_raw"), brier(F.col("label"), F.col("calibrated")).alias("brier_calibrated"))


# --- boosted trees -----------------------------------------------------------------------------

CLF_TARGETS = {"y_win": "p_win", "y_top2": "p_top2", "y_top3": "p_top3"}


def train_targets(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], shape: Shape = Shape(),
    arms: dict[str, tuple[str, Sequence[str], Sequence[str]]] | None = None,
) -> dict[str, Booster]:
    """Three boosted classifiers and one L1 regressor, each kept up to its best round on the last tenth of the dates.

    Classifiers are judged by their held-out AUC, the regressor by its mean absolute error. ``arms``
    adds classifiers by name, each with its label, numbers and categories; all are fitted side by side.
    """
    rows = ranks.cum_tail_split(df, 0.9)
    own = (*numeric, *categorical)
    fits = [*[Boost(y, y, "log", own, "auc") for y in CLF_TARGETS], Boost("y_rank", "y_rank", "l1", own)]
    for name, (y, numbers, categories) in (arms or {}).items():
        fits.append(Boost(name, y, "log", (*numbers, *categories), "auc"))
        numeric, categorical = dict.fromkeys([*numeric, *numbers]), dict.fromkeys([*categorical, *categories])
    return fit_boosters(rows, fits, list(numeric), list(categorical), F.col("part") == "valid", shape)


def score_batch(models: dict[str, Booster], df: DataFrame, keep: Sequence[str] = CAR) -> DataFrame:
    """Probabilities and predicted rank per car."""
    names = {**CLF_TARGETS, "y_rank": "pred_rank"}
    return scored({names[y]: models[y] for y in names if y in models}, df, keep)


def ab_score(a: Booster, z: Booster, df: DataFrame, y: str = "y_win") -> DataFrame:
    """The same rows scored by two models, with their scores side by side in one table."""
    both = scored({"A": a, "B": z}, df, [y])
    rows = both.select(y, F.explode(F.array(*[F.struct(F.lit(n).alias("arm"), F.col(n).alias("p")) for n in "AB"])).alias("x")).select(y, "x.*")
    area = auc(rows, y, "p", ["arm"])
    loss = rows.groupBy("arm").agg(F.count(F.lit(1)).alias("n"), log_loss(F.col(y), F.col("p")).alias("log_loss"))
    return area.select("arm", "auc").join(loss, "arm")


def feature_importance(spark: SparkSession, models: dict[str, Booster], features: Sequence[str]) -> DataFrame:
    """Share of the gain and number of splits per feature and target (features are a short, fixed list), and the totals."""
    rows = []
    for y, model in models.items():
        found = model.importance()
        gain = sum(found[f][0] for f in features)
        rows += [(y, f, found[f][0] / gain if gain else 0.0, found[f][1]) for f in features]
    long = spark.createDataFrame(rows, "target string, feature string, importance double, splits long")
    wide = long.groupBy("feature").agg(
        *[F.max(F.when(F.col("target") == y, F.col("importance"))).alias(y) for y in models],
        *[F.max(F.when(F.col("target") == y, F.col("splits"))).alias(f"{y}_splits") for y in models])
    total = sum((F.col(y) for y in models), F.lit(0.0))
    return wide.withColumn("total", total / len(models)).withColumn("total_splits", sum((F.col(f"{y}_splits") for y in models), F.lit(0)))


# --- market residual ---------------------------------------------------------------------------


def residual_dataset(market: DataFrame, lines: DataFrame, results: DataFrame) -> DataFrame:
    """Market × line-up × result rows of races in which every finisher row is covered; market mass one."""
    res = results.groupBy(*CAR).agg(F.min("tyaku").alias("tyaku")).withColumn(
        "win", F.coalesce(F.col("tyaku") == 1, F.lit(False)).cast("int"))
    res = res.withColumn("n_res", F.count(F.lit(1)).over(in_race()))
    rows = res.join(market, CAR).join(lines, CAR)
    full = (F.count(F.lit(1)).over(in_race()) == F.col("n_res")) & (F.sum("win").over(in_race()) == 1)
    out = where_over(rows, full)
    return out.withColumn("mkt_win", F.col("mkt_win") / F.sum("mkt_win").over(in_race())).drop("n_res", "tyaku")


#: Small, strongly held back trees: what they add to the market has to show on most of their rows.
RESIDUAL_SHAPE = Shape(rounds=600, depth=3, rate=0.03, patience=50, min_rows=300, l2=10.0, feature_share=0.9, row_share=1.0)


def market_residual_model(
    df: DataFrame, features: Sequence[str], train_end: str, calib_end: str, replicates: int = 100, shape: Shape = RESIDUAL_SHAPE
) -> DataFrame:
    """Boosted trees that start from the market logit, and what their margin adds to the market.

    Trees are fitted on races up to ``train_end`` and stopped by the log loss of its last month. On the
    races after that up to ``calib_end`` the market's exponent alone (``alpha``) and the pair (``a``,
    ``c_calib``; c is the exponent of the margin) are fitted, and race losses are taken on the races
    after ``calib_end``. ``c_oos`` and its 95% interval come from all races after ``train_end``, by
    resampled races. One row; columns of a period without races are NULL.
    """
    spark, day = df.sparkSession, F.col("race_date")
    edge, calib = F.lit(train_end).cast("date"), F.lit(calib_end).cast("date")
    rows = staged(df.select(*CAR, "win", "mkt_win", *[F.col(f).cast("double").alias(f) for f in features])
                  .withColumn("off", logit(F.col("mkt_win"), 1e-6)), "residual")
    fit = Boost("line", "win", "log", tuple(features), "loss", "off")
    model = fit_boosters(rows.where(day <= edge), [fit], features, [], day > F.add_months(edge, -1), shape)["line"]
    later = rows.where(day > edge)
    scored_rows = staged(scored({"f": model}, later, [*CAR, "win", "mkt_win"], margin=True), "margin")
    top = scored_rows.agg(F.max("f")).first()[0]
    # The logit within a race does not see a constant, so the margins are shifted to 0 at most.
    races = staged(race_rows(scored_rows.withColumn("p_win", F.exp(F.col("f") - F.lit(top or 0.0)))), "races")
    blocks = race_blocks(races, F.when(day <= calib, 0).otherwise(1), replicates, "residual")
    alpha, pair, whole = fit_all(blocks, [Fit(before=1, with_model=False), Fit(before=1), Fit()])
    low, high = interval(resampled(blocks, whole, replicates) if whole.n else [])
    n = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*RACE).alias("races"), F.count_distinct(
        F.when(day <= edge, F.struct(*RACE))).alias("train")).first()
    value = lambda f, x: F.lit(x).cast("double") if f.n else F.lit(None).cast("double")
    loss = lambda a, b: F.avg(race_nll(F.lit(float(a)), F.lit(float(b))))
    test = races.where(day > calib).agg(
        F.count(F.lit(1)).alias("test_races"), loss(1, 0).alias("ll_market"), loss(alpha.a, 0).alias("ll_market_alpha"), loss(pair.a, pair.b).alias("ll_market_plus_line"))
    return test.select(
        F.lit(n["rows"]).alias("n_rows"), F.lit(n["races"]).alias("n_races"), F.lit(n["train"]).alias("train_races"), F.lit(int(pair.n)).cast("long").alias("calib_races"),
        "test_races", F.lit(len(model.trees)).alias("best_iter"), value(alpha, alpha.a).alias("alpha"), value(pair, pair.a).alias("a"), value(pair, pair.b).alias("c_calib"),
        value(whole, whole.b).alias("c_oos"), F.lit(low).cast("double").alias("c_ci_low"), F.lit(high).cast("double").alias("c_ci_high"),
        *[F.when(F.lit(pair.n > 0), F.col(c)).alias(c) for c in ("ll_market", "ll_market_alpha", "ll_market_plus_line")])
