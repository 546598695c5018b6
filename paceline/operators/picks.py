"""Picks, settlement and back-tests (2.11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paceline.functions.moments import monday_of
from paceline.functions.numeric import clip, settle
from paceline.functions.rows import inline_rows
from paceline.functions.text import join_cars, pair_of
from paceline.keys import COMBO, RACE
from paceline.operators.ordered import distribution, positions
from paceline.session import staged

# Share of races bought by confidence, price thresholds, stake.
TOP_SHARES = [1.0, 0.50, 0.25, 0.10, 0.05]
EV_THRESHOLDS = [1.0, 1.2, 1.5]
GRID_THRESHOLDS = [1.0, 1.2, 1.5, 2.0]
STAKE = 100
TICKETS = ["SH2", "ST2", "RH3", "RT3", "W1", "W2", "W3"]
MAIN_BETS = ["SH2", "ST2", "RH3", "RT3"]
_BET_OF = {"W1": "W", "W2": "W", "W3": "W"}


def by_score(score: str) -> Column:
    """Cars of a race, best score first, car number on ties."""
    best = F.sort_array(F.collect_list(F.struct((-F.col(score)).alias("s"), F.col("car_no").alias("c"))))
    return best.alias(f"_{score}")


def make_picks(probs: DataFrame) -> DataFrame:
    """Seven tickets and their confidences per race of at least three scored cars."""
    races = probs.groupBy(*RACE).agg(by_score("p_win"), by_score("p_top2"), by_score("p_top3"))
    races = races.where(F.size("_p_win") >= 3)

    def cars(col: str, k: int | None = None) -> Column:
        all_cars = F.transform(F.col(col), lambda x: x["c"])
        return F.slice(all_cars, 1, k) if k else all_cars

    def total(col: str, k: int) -> Column:
        return settle(-F.aggregate(F.slice(F.col(col), 1, k), F.lit(0.0), lambda acc, x: acc + x["s"]))

    first = F.get(cars("_p_win"), F.lit(0))
    second = F.get(F.filter(cars("_p_top2"), lambda c: c != first), F.lit(0))
    t3 = cars("_p_top3", 3)

    def wide(i: int, j: int) -> Column:
        return join_cars(F.array_sort(F.array(F.get(t3, F.lit(i)), F.get(t3, F.lit(j)))), "=")

    return races.select(
        *RACE,
        join_cars(F.array_sort(cars("_p_top2", 2)), "=").alias("SH2"),
        F.concat_ws("-", first, second).alias("ST2"),
        join_cars(F.array_sort(t3), "=").alias("RH3"),
        join_cars(cars("_p_win", 3), "-").alias("RT3"),
        wide(0, 1).alias("W1"), wide(0, 2).alias("W2"), wide(1, 2).alias("W3"),
        total("_p_top2", 2).alias("conf_SH2"),
        total("_p_win", 3).alias("conf_ST2"),
        total("_p_top3", 3).alias("conf_RH3"),
        total("_p_win", 3).alias("conf_RT3"),
        total("_p_top3", 3).alias("conf_W"),
    )


def tickets_of(picks: DataFrame) -> DataFrame:
    """One row per bought ticket with its bet type and confidence."""
    rows = inline_rows(
        ["bet_type", "kumi_ban", "conf"],
        *[[_BET_OF.get(t, t), F.col(t), F.col(f"conf_{_BET_OF.get(t, t)}")] for t in TICKETS],
    )
    return picks.select(*RACE, rows)


def settle_tickets(tickets: DataFrame, payouts: DataFrame) -> DataFrame:
    """Left join to the payouts: a miss pays 0, duplicated winner rows count with the largest."""
    best = payouts.groupBy(*COMBO).agg(F.max("payout").alias("payout"))
    return tickets.join(best, COMBO, "left").withColumn("payout", F.coalesce("payout", F.lit(0)))


def roi_columns() -> list[Column]:
    n, hits, paid = F.count(F.lit(1)), F.count(F.when(F.col("payout") > 0, 1)), F.sum("payout")
    return [
        n.alias("n_bets"), hits.alias("n_hits"), (hits / n).alias("hit_rate"), paid.alias("total_payout"),
        (n * STAKE).alias("total_cost"), (paid / (n * STAKE) - 1).alias("roi"),
    ]


def backtest(picks: DataFrame, payouts: DataFrame) -> DataFrame:
    return settle_tickets(tickets_of(picks), payouts).groupBy("bet_type").agg(*roi_columns())


def _per_race(picks: DataFrame, payouts: DataFrame) -> DataFrame:
    return settle_tickets(tickets_of(picks), payouts).groupBy(*RACE, "bet_type").agg(
        F.max("conf").alias("conf"), F.count(F.lit(1)).alias("n_tickets"),
        F.count(F.when(F.col("payout") > 0, 1)).alias("hits"), F.sum("payout").alias("paid"),
    )


def backtest_topfrac(picks: DataFrame, payouts: DataFrame, shares: Sequence[float] = TOP_SHARES) -> DataFrame:
    """The same on the most confident share of races; ties go to the earlier race."""
    ranked = positions(
        _per_race(picks, payouts), ["bet_type"], [F.desc("conf"), *[F.col(c) for c in RACE]]
    )
    bought = F.array(*[F.lit(s) for s in shares])
    within = F.filter(bought, lambda s: F.col("pos") <= F.greatest(F.lit(1), F.floor(F.col("pos_all") * s)))
    rows = ranked.withColumn("share", F.explode(within))
    cost = F.sum("n_tickets") * STAKE
    return rows.groupBy("bet_type", (F.col("share") * 100).cast("int").alias("threshold_pct")).agg(
        F.count(F.lit(1)).alias("n_races"), F.sum("hits").alias("n_hits"), F.sum("paid").alias("total_payout"),
        cost.alias("total_cost"), (F.sum("paid") / cost - 1).alias("roi"),
    )


def top_share_races(picks: DataFrame, conf: str, share: float) -> DataFrame:
    ranked = positions(picks.select(*RACE, conf), [], [F.desc(conf), *[F.col(c) for c in RACE]])
    return ranked.where(F.col("pos") <= F.greatest(F.lit(1), F.floor(F.col("pos_all") * share)))


def annotate_payouts(picks: DataFrame, payouts: DataFrame) -> DataFrame:
    """Payout per pick and bet type; W is the sum over its three tickets."""
    paid = settle_tickets(tickets_of(picks), payouts)
    bets = [*MAIN_BETS, "W"]
    return paid.groupBy(*RACE).agg(
        *[F.sum(F.when(F.col("bet_type") == x, F.col("payout")).otherwise(0)).alias(f"pay_{x}") for x in bets])


def quantile_edges(df: DataFrame, by: Sequence[str], value: str, bins: int) -> DataFrame:
    """Distinct quantile edges per group as a sorted array (equal edges merge).

    The edges (one row per group) are written out, so the planner knows their size when it joins
    them to the rows and broadcasts them only below its threshold.
    """
    probs = {f"e{i}": i / bins for i in range(bins + 1)}
    out = distribution(df, by, F.col(value), probs)
    edges = F.array_sort(F.array_distinct(F.array(*[settle(F.col(e)) for e in probs])))
    return staged(out.select(*by, edges.alias("edges")), "edges")


def bin_of(value: Column, edges: Column) -> Column:
    """Right-closed bin number from 1, the lowest edge included; outside the edges NULL."""
    below = F.size(F.filter(edges, lambda e: e < value))
    inside = (value >= F.element_at(edges, 1)) & (value <= F.element_at(edges, -1))
    return F.when(inside, F.greatest(below, F.lit(1)))


def bin_calibrate_select(picks: DataFrame, payouts: DataFrame, calibration_end: str, bins: int = 20) -> DataFrame:
    """Confidence bins that paid above cost before ``calibration_end``, bought afterwards."""
    races = _per_race(picks, payouts).withColumn("cal", F.col("race_date") <= F.lit(calibration_end).cast("date"))
    edges = quantile_edges(races.where("cal"), ["bet_type"], "conf", bins)
    binned = races.join(edges, "bet_type").withColumn("bin", bin_of(F.col("conf"), F.col("edges")))
    cost = F.when(F.col("bet_type") == "W", 3).otherwise(1) * STAKE
    good = binned.where("cal AND bin IS NOT NULL").groupBy("bet_type", "bin").agg(
        F.avg("paid").alias("_mean")).where(F.col("_mean") > cost).select("bet_type", "bin", F.lit(1).alias("good"))
    rows = binned.join(good, ["bet_type", "bin"], "left")
    later, chosen = ~F.col("cal"), ~F.col("cal") & F.col("good").isNotNull()
    n_all, n_sel = F.count(F.when(later, 1)), F.count(F.when(chosen, 1))
    paid_all, paid_sel = F.sum(F.when(later, F.col("paid"))), F.sum(F.when(chosen, F.col("paid")))
    unit = F.max(cost)
    out = rows.groupBy("bet_type").agg(
        F.count(F.when(F.col("cal"), 1)).alias("n_cal"), n_all.alias("n_eval"), n_sel.alias("n_selected"),
        F.try_divide(paid_all, n_all * unit).alias("all_ret"), F.try_divide(paid_sel, n_sel * unit).alias("sel_ret"),
        F.count(F.when(chosen & (F.col("paid") > 0), 1)).alias("selected_hits"),
        F.countDistinct(F.when(F.col("good").isNotNull(), F.col("bin"))).alias("n_profitable_bins"),
    )
    return out.select("bet_type", "n_cal", "n_eval", "n_profitable_bins", "n_selected",
                      (F.col("all_ret") - 1).alias("all_roi"), (F.col("sel_ret") - 1).alias("selected_roi"), "selected_hits")


def head_tail_bins(picks: DataFrame, payouts: DataFrame, bet: str, bins: int = 20, k: int = 3) -> DataFrame:
    """Best and worst confidence bins by return (at most ``bins`` rows are ranked)."""
    from pyspark.sql import Window

    races = _per_race(picks, payouts).where(F.col("bet_type") == bet)
    edges = quantile_edges(races, ["bet_type"], "conf", bins)
    stats = races.join(edges, "bet_type").withColumn("bin", bin_of(F.col("conf"), F.col("edges"))).groupBy("bet_type", "bin").agg(
        F.count(F.lit(1)).alias("n"), (F.sum("paid") / (F.count(F.lit(1)) * STAKE) - 1).alias("roi"))
    w = Window.partitionBy("bet_type")
    best, worst = F.row_number().over(w.orderBy(F.desc("roi"), "bin")), F.row_number().over(w.orderBy("roi", "bin"))
    ranked = stats.withColumns({"_best": best, "_worst": worst})
    return ranked.where((F.col("_best") <= k) | (F.col("_worst") <= k)).select(
        "bin", "n", "roi", F.when(F.col("_best") <= k, "best").otherwise("worst").alias("side"))


def ev_threshold_roi(priced: DataFrame, payouts: DataFrame, thresholds: Sequence[float] = EV_THRESHOLDS) -> DataFrame:
    """Buy every combination at or above each EV threshold."""
    rows = settle_tickets(priced, payouts)
    levels = F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: F.col("ev") >= t)
    return rows.withColumn("ev_thr", F.explode(levels)).groupBy("bet_type", "ev_thr").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("payout") > 0, 1)).alias("hit"),
        (F.sum("payout") / F.count(F.lit(1))).alias("roi_pct"))


def grid_bets(combos: DataFrame, odds: DataFrame, payouts: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Bought combinations per offset, bet type and threshold, with their payouts."""
    priced = settle_tickets(combos.join(odds.where(F.col("odds") > 0), COMBO), payouts).withColumn(
        "ev", settle(F.col("p_combo") * F.col("odds")))
    levels = F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: F.col("ev") >= t)
    return priced.withColumn("ev_thr", F.explode(levels))


GRID = ["target_offset_min", "bet_type", "ev_thr"]


def grid_days(bets: DataFrame) -> DataFrame:
    """Stake and return per grid cell and day."""
    return bets.groupBy(*GRID, "race_date").agg(
        F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) * STAKE).alias("stake"), F.sum("payout").alias("ret"))


def ev_offset_grid(bets: DataFrame, min_bets: int = 30, min_days: int = 5) -> DataFrame:
    cells = grid_days(bets).groupBy(*GRID).agg(
        F.sum("n").alias("n_bets"), F.count(F.lit(1)).alias("days"), (F.sum("ret") / F.sum("stake") * 100).alias("roi_pct"))
    return cells.where((F.col("n_bets") >= min_bets) & (F.col("days") >= min_days))


def policy_grid(bets: DataFrame, grid: DataFrame, complete: DataFrame) -> DataFrame:
    """Per pre-registered policy: races, bets, weeks, ROI and the t statistic of the net per race.

    Only races in ``complete`` count: in a race without its results and payouts a bet is open, not lost.
    """
    per_race = bets.join(complete.select(*RACE), RACE, "left_semi").groupBy(*GRID, *RACE).agg(F.sum("payout").alias("pay"), F.count(F.lit(1)).alias("n"))
    per_race = per_race.withColumn("net", F.col("pay") - STAKE * F.col("n"))
    stats = per_race.groupBy(*GRID).agg(
        F.count(F.lit(1)).alias("n_races"), F.sum("n").alias("n_bets"), F.countDistinct(monday_of(F.col("race_date"))).alias("weeks"),
        (F.sum("pay") / (F.sum("n") * STAKE) - 1).alias("roi"), F.avg("net").alias("net_mean"), F.stddev_samp("net").alias("net_sd"))
    out = grid.join(stats, GRID, "left")
    zero = F.lit(0).cast("long")
    return out.withColumns({c: F.coalesce(c, zero) for c in ["n_races", "n_bets", "weeks"]})


def policy_cells(spark, bets: Sequence[str], thresholds: Sequence[float], offsets: Sequence[float]) -> DataFrame:
    """The fixed grid of policies (a few dozen rows)."""
    rows = [(o, x, t) for o in offsets for x in bets for t in thresholds]
    return spark.createDataFrame(rows, "target_offset_min double, bet_type string, ev_thr double")


def forward_metrics(scored: DataFrame, payouts: DataFrame, complete: DataFrame) -> DataFrame:
    """Log loss against a constant baseline, hit rate and payout/cost, by week and in total, over the races in ``complete``."""
    from paceline.operators.features import targets
    from paceline.operators.stats import log_loss

    scored = scored.join(complete.select(*RACE), RACE, "left_semi")
    cars = targets(scored).withColumn("week", monday_of(F.col("race_date")))
    eps = 1e-6
    agg: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    for t in ("win", "top2", "top3"):
        m = clip(F.avg(f"y_{t}"), eps, 1 - eps)
        rate = F.avg(f"y_{t}")
        agg += [log_loss(F.col(f"y_{t}"), F.col(f"p_{t}")).alias(f"ll_{t}"),
                (-(rate * F.ln(m) + (1 - rate) * F.ln(1 - m))).alias(f"ll_{t}_base")]
    losses = cars.rollup("week").agg(*agg)
    paid = settle_tickets(tickets_of(make_picks(scored)), payouts).where(F.col("bet_type").isin(MAIN_BETS))
    hits = []
    for x in MAIN_BETS:
        mine = F.col("bet_type") == x
        hits += [F.avg(F.when(mine, (F.col("payout") > 0).cast("int"))).alias(f"{x}_hit"),
                 (F.avg(F.when(mine, F.col("payout"))) / STAKE).alias(f"{x}_roi")]
    n_races = F.count(F.when(F.col("bet_type") == "SH2", 1)).alias("n_races")
    returns = paid.withColumn("week", monday_of(F.col("race_date"))).rollup("week").agg(n_races, *hits)
    label = F.coalesce(F.date_format("week", "yyyy-MM-dd"), F.lit("total"))
    return losses.withColumn("week", label).join(returns.withColumn("week", label), "week", "left")


def top_pair(runners: DataFrame, score: str, name: str) -> DataFrame:
    """The two best-scored cars of a race as ``lo=hi``; races with fewer than two have no pair."""
    races = runners.where(F.col(score).isNotNull()).groupBy(*RACE).agg(by_score(score)).where(F.size(f"_{score}") >= 2)
    two = F.array_sort(F.transform(F.slice(F.col(f"_{score}"), 1, 2), lambda x: x["c"]))
    return races.select(*RACE, join_cars(two, "=").alias(name))


def quinella_pair_frame(runners: DataFrame, payouts: DataFrame) -> DataFrame:
    """Champion and candidate top-two bets on the races both can bet.

    A race without any payout row has NULL returns (left out later), a miss returns 0, and in a dead
    heat every paid pair wins.
    """
    both = top_pair(runners, "p_champion", "champ_pair").join(top_pair(runners, "p_candidate", "cand_pair"), RACE)
    pair = pair_of(F.col("kumi_ban"))
    paid = payouts.where(F.col("bet_type") == "SH2").withColumn("_p", pair).where(F.col("_p").isNotNull()).select(
        *RACE, F.concat_ws("=", "_p.lo", "_p.hi").alias("pair"), "payout")
    best = paid.groupBy(*RACE, "pair").agg((F.max("payout") / 100).alias("odds"))
    settled = best.groupBy(*RACE).agg(F.lit(1).alias("settled"))

    def ret(side: str) -> DataFrame:
        return best.withColumnsRenamed({"pair": f"{side}_pair", "odds": f"{side}_ret"})

    out = both.join(ret("champ"), [*RACE, "champ_pair"], "left").join(ret("cand"), [*RACE, "cand_pair"], "left")
    out = out.join(settled, RACE, "left")
    value = lambda c: F.when(F.col("settled") == 1, F.coalesce(c, F.lit(0.0)))
    return out.select(*RACE, "champ_pair", "cand_pair", value("champ_ret").alias("champ_ret"), value("cand_ret").alias("cand_ret"))


def compare_runs(runs: dict[str, DataFrame], payouts: DataFrame) -> DataFrame:
    """Back-tests of named runs side by side, with differences to the first."""
    names = list(runs)
    parts = [backtest(make_picks(p), payouts).withColumn("run", F.lit(n)) for n, p in runs.items()]
    all_runs = parts[0]
    for p in parts[1:]:
        all_runs = all_runs.unionByName(p)
    wide = all_runs.groupBy("bet_type").agg(*[
        F.max(F.when(F.col("run") == n, F.col(m))).alias(f"{m}_{n}") for n in names for m in ("hit_rate", "roi")])
    return wide.withColumns({
        f"{m}_diff_{n}": F.col(f"{m}_{n}") - F.col(f"{m}_{names[0]}") for n in names[1:] for m in ("hit_rate", "roi")})


def pivot_threshold(topfrac: DataFrame, shares: Sequence[float] = TOP_SHARES) -> DataFrame:
    """Bet type × threshold matrix of ROI."""
    levels = [int(s * 100) for s in shares]
    return topfrac.groupBy("bet_type").pivot("threshold_pct", levels).agg(F.first("roi")).withColumnsRenamed(
        {str(x): f"roi_{x}" for x in levels})


