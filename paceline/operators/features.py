"""Feature frames per car (2.9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paceline.functions.numeric import front_run_ratio, position_ratio
from paceline.functions.regions import add_region, strip_spaces
from paceline.keys import CAR, RACE, in_race
from paceline.operators import ranks

# Fixed value: a position gap of two or more starts a new line.
LINE_BREAK_GAP = 2


def reconstruct_lines(narabi: DataFrame) -> DataFrame:
    """Lines from positions: a new line starts where the bundle changes or the position jumps."""
    rows = narabi.dropna(subset=["car_no", "narabi_x", "narabi_y"])
    w = in_race().orderBy("narabi_y", "narabi_x", "car_no")
    px, py = F.lag("narabi_x").over(w), F.lag("narabi_y").over(w)
    breaks = px.isNotNull() & ((F.col("narabi_y") != py) | (F.col("narabi_x") - px >= LINE_BREAK_GAP))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = in_race("line_id")
    return (
        rows.withColumn("_brk", F.when(breaks, 1).otherwise(0).cast("long"))
        .withColumn("line_id", F.sum("_brk").over(upto))
        .withColumn("line_pos", F.row_number().over(line.orderBy("narabi_y", "narabi_x", "car_no")).cast("long"))
        .withColumn("line_size", F.count(F.lit(1)).over(line))
        .drop("_brk")
    )


def weak_line_features(runners: DataFrame) -> DataFrame:
    """Six proxies for the line-up from style, region and record."""
    zero = F.lit(0)
    n, m = F.coalesce("nige_cnt", zero), F.coalesce("makuri_cnt", zero)
    style = F.coalesce("kyaku", F.lit(""))
    leader = (style == "逃") | ((style == "両") & (n >= m))
    df = add_region(runners).withColumn("_pref", strip_spaces(F.coalesce("prefecture", F.lit(""))))
    df = ranks.support_excl_self(df, "region", "same_region_support_count")
    df = ranks.support_excl_self(df, "_pref", "same_pref_support_count")
    partner = F.col("same_region_support_count") > 0
    return df.select(
        *CAR,
        leader.cast("int").alias("is_probable_line_leader"),
        "same_region_support_count",
        partner.cast("int").alias("has_clear_regional_partner"),
        (leader & ~partner).cast("int").alias("is_likely_tanki"),
        "same_pref_support_count",
        front_run_ratio(F.col("nige_cnt"), F.col("makuri_cnt"), F.col("sasi_cnt")).alias("nige_propensity"),
    )


def real_line_features(narabi: DataFrame, stats: DataFrame) -> DataFrame:
    """Thirteen features from reconstructed lines; missing records count as no front running."""
    lines = reconstruct_lines(narabi)
    tempo = stats.select(
        *CAR, front_run_ratio(F.col("nige_cnt"), F.col("makuri_cnt"), F.col("sasi_cnt")).alias("_tempo")
    )
    size, pos, race = F.col("line_size"), F.col("line_pos"), in_race()
    head = (pos == 1) & (size >= 2)
    df = lines.withColumns({
        # Line ids count up from zero, so the largest one gives the number of lines.
        "n_lines_in_race": F.max("line_id").over(race) + 1,
        "max_line_size": F.max("line_size").over(race),
        "line_size_rank": F.dense_rank().over(race.orderBy(F.desc("line_size"))).cast("long"),
        "n_tanki_in_race": F.sum((size == 1).cast("long")).over(race),
    })
    return df.join(tempo, CAR, "left").select(
        *CAR, "line_size", "line_pos",
        head.cast("int").alias("is_line_head"),
        (pos == 2).cast("int").alias("is_line_second"),
        (pos >= 3).cast("int").alias("is_line_third_plus"),
        (size == 1).cast("int").alias("is_tanki"),
        position_ratio(pos, size).alias("pos_ratio"),
        "n_lines_in_race", "max_line_size",
        (size == F.col("max_line_size")).cast("int").alias("is_in_largest_line"),
        "line_size_rank", "n_tanki_in_race",
        F.when(head, F.coalesce("_tempo", F.lit(0.0))).otherwise(F.lit(0.0)).alias("head_nige_propensity"),
    )


def group_guess(runners: DataFrame) -> DataFrame:
    """Guessed line-ups: riders of a region together, leaders first, then by car number."""
    df = add_region(runners)
    leader = F.when(F.col("kyaku").isin("逃", "両"), 0).otherwise(1)
    return df.select(
        *CAR, "region",
        F.row_number().over(in_race("region").orderBy(leader, "car_no")).alias("group_pos"),
        F.count(F.lit(1)).over(in_race("region")).alias("group_size"),
    )


def race_relative(runners: DataFrame) -> DataFrame:
    """Ranks, gaps, moments and style counts; all share one sort per race."""
    return ranks.race_style_counts(ranks.race_moments(ranks.gap_to_leader(ranks.rank_in_race(runners))))


def targets(df: DataFrame) -> DataFrame:
    """win / top-2 / top-3 flags and rank; no finish gives 0 and rank 8."""
    t = F.col("tyaku")

    def flag(cond: Column) -> Column:
        return F.coalesce(cond, F.lit(False)).cast("int")

    return df.withColumns({
        "y_win": flag(t == 1), "y_top2": flag(t.between(1, 2)), "y_top3": flag(t.between(1, 3)),
        "y_rank": F.coalesce(t, F.lit(8)),
    })


def market_marginals(odds: DataFrame) -> DataFrame:
    """Per-car market features from ST2, SH2 and W prices (one row per combination).

    Every combination is turned into one row per car in it; a combination that is not two car
    numbers is skipped. The three implied probabilities add up to one in a race.
    """
    from paceline.functions.text import car_at

    sep = F.when(F.col("bet_type") == "ST2", "-").otherwise("=")
    live = (
        odds.where(F.col("bet_type").isin("ST2", "SH2", "W") & (F.col("odds") > 0))
        .where(F.size(F.split("kumi_ban", "[-=]")) == 2)
        .where(F.contains("kumi_ban", sep))
        .withColumn("a", car_at(F.col("kumi_ban"), 1)).withColumn("z", car_at(F.col("kumi_ban"), 2))
        .where(F.col("a").isNotNull() & F.col("z").isNotNull())
    )
    per_car = live.select(
        *RACE, "bet_type", "odds", "max_odds", "popularity",
        F.posexplode(F.array("a", "z")).alias("_at", "car_no"),
    )
    first = (F.col("bet_type") == "ST2") & (F.col("_at") == 0)
    sh2, w = F.col("bet_type") == "SH2", F.col("bet_type") == "W"
    inverse, spread = 1 / F.col("odds"), F.col("max_odds") - F.col("odds")
    agg = per_car.groupBy(*CAR).agg(
        F.sum(F.when(first, inverse)).alias("_st2"),
        F.sum(F.when(sh2, inverse)).alias("_sh2"),
        F.sum(F.when(w, inverse)).alias("_w"),
        F.min(F.when(first, F.col("popularity"))).alias("pop_rank_st2_1st"),
        F.min(F.when(sh2, F.col("popularity"))).alias("pop_rank_sh2_min"),
        F.min(F.when(first, F.col("odds"))).alias("odds_min_st2_1st"),
        F.count(F.when(first, 1)).alias("n_st2_first"),
        F.max(F.when(first | sh2, 1).otherwise(0)).alias("has_odds"),
        F.min(F.when(w, F.col("popularity"))).alias("pop_rank_w_min"),
        F.avg(F.when(w, F.col("odds"))).alias("w_odds_min_avg"),
        F.avg(F.when(w & (F.col("max_odds") != 0), spread)).alias("w_odds_range_avg"),
        F.max(F.when(w, 1).otherwise(0)).alias("has_w_odds"),
    )

    def share(col: str) -> Column:
        total = F.sum(col).over(in_race())
        return F.when(total > 0, F.col(col) / total).otherwise(F.col(col))

    return agg.select(
        *CAR,
        share("_st2").alias("imp_winprob_st2"), share("_sh2").alias("imp_top2prob_sh2"),
        "pop_rank_st2_1st", "pop_rank_sh2_min", "odds_min_st2_1st",
        F.ln("odds_min_st2_1st").alias("log_odds_min_st2_1st"), "n_st2_first",
        (F.col("n_st2_first") < F.count(F.lit(1)).over(in_race()) - 1).cast("int").alias("is_incomplete_st2"),
        "has_odds", share("_w").alias("imp_top3prob_w"), "pop_rank_w_min", "w_odds_min_avg", "w_odds_range_avg",
        "has_w_odds",
    )


def mispricing(df: DataFrame) -> DataFrame:
    """Where market rank and record disagree; needs market marginals and race ranks."""
    pop = ranks.dense_rank_in_race("pop_rank_st2_1st", descending=False)
    total = F.sum("syouritu").over(in_race())
    implied = F.col("syouritu") / F.when(total == 0, F.lit(1.0)).otherwise(total)
    df = df.withColumn("pop_rank_car_in_race", pop).withColumn("stats_implied_prob", implied)
    rank, win = F.col("pop_rank_car_in_race"), F.col("syouritu_rank")

    def flag(cond: Column) -> Column:
        return F.coalesce(cond, F.lit(False)).cast("int")

    return df.withColumns({
        "pop_minus_syouritu_rank": rank - win,
        "pop_minus_rentairitu2_rank": rank - F.col("rentairitu2_rank"),
        "pop_minus_heikin_tokuten_rank": rank - F.col("heikin_tokuten_rank"),
        "imp_winprob_residual": F.col("imp_winprob_st2") - F.col("stats_implied_prob"),
        "is_underpriced_stats_top": flag((rank >= 3) & (win <= 2)),
        "is_overpriced_market_top": flag((rank <= 2) & (win >= 5)),
    })


def assemble(
    stats: DataFrame, meta: DataFrame, odds_features: DataFrame, weak: DataFrame, real: DataFrame, results: DataFrame
) -> DataFrame:
    """The training table: left joins on the car key, race features, targets.

    Cars without prices get ``has_odds`` 0 and ``is_incomplete_st2`` 1; real line features stay NULL
    where no line-up is known.
    """
    from paceline.keys import VENUE_DAY

    df = (
        stats.join(meta.select(*VENUE_DAY, "grade"), VENUE_DAY, "left")
        .join(odds_features, CAR, "left").join(weak, CAR, "left").join(real, CAR, "left")
        .join(results.select(*CAR, "tyaku"), CAR, "left")
    )
    df = df.withColumns({
        "has_odds": F.coalesce("has_odds", F.lit(0)),
        "has_w_odds": F.coalesce("has_w_odds", F.lit(0)),
        "is_incomplete_st2": F.coalesce("is_incomplete_st2", F.lit(1)),
    })
    return targets(mispricing(race_relative(df)))


def split_by_date(df: DataFrame, train_end: str, test_start: str, date: str = "race_date") -> DataFrame:
    day = F.col(date)
    return df.withColumn(
        "split", F.when(day <= F.lit(train_end).cast("date"), "train").when(day >= F.lit(test_start).cast("date"), "test")
    )
