"""Scores, calibration, multiple testing and resampling (2.12)."""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from paceline.functions.numeric import clip, settle
from paceline.functions.rows import inline_rows
from paceline.operators.ordered import distribution, running
from paceline.operators.picks import bin_of, quantile_edges
from paceline.session import staged


def log_loss(y: Column, p: Column, eps: float = 1e-6) -> Column:
    q = clip(p, eps, 1 - eps)
    return F.avg(-(y * F.ln(q) + (1 - y) * F.ln(1 - q)))


def brier(y: Column, p: Column) -> Column:
    return F.avg((p - y) * (p - y))


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def auc(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve from rank sums over distinct scores; ties count half.

    All rows count: those without a score are one tie above all scores, where SQL's ``rank`` has them.
    """
    by = list(by)
    counts = df.groupBy(*by, F.col(p).alias("v")).agg(
        F.sum(F.col(y).cast("long")).alias("pos"), F.sum((1 - F.col(y)).cast("long")).alias("neg"))
    runs = running(counts, by, [F.col("v").asc_nulls_last()], {"neg_cum": ("sum", F.col("neg"))})
    below = F.col("neg_cum") - F.col("neg") / 2
    out = runs.groupBy(*by).agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum(F.col("pos") * below).alias("_area"))
    area = F.try_divide("_area", F.col("n_pos").cast("double") * F.col("n_neg"))
    return out.withColumn("auc", area).drop("_area")


def ece(df: DataFrame, y: str, p: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Expected calibration error over quantile bins; equal edges merge."""
    keys = list(by)
    rows = df.select(*keys, F.col(y).alias("y"), F.col(p).alias("p"))
    edges = quantile_edges(rows, keys, "p", bins)
    edged = rows.join(edges, keys) if keys else rows.withColumn("edges", edges.scalar())
    per_bin = edged.groupBy(*keys, bin_of(F.col("p"), F.col("edges")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("my"), F.avg("p").alias("mp"))
    weight = F.sum(F.col("n") * F.abs(F.col("my") - F.col("mp"))) / F.sum("n")
    return per_bin.groupBy(*keys).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_bins"), weight.alias("ece"))


def reliability_table(df: DataFrame, y: str, p: str, width: float = 0.1) -> DataFrame:
    """Predicted against realised rate by probability band."""
    band = F.least(F.floor(F.col(p) / width), F.lit(round(1 / width) - 1))
    return df.groupBy(band.alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_p"), F.avg(y).alias("rate"))


# --- multiple testing -------------------------------------------------------------------------


def bh_qvalues(tests: DataFrame, by: Sequence[str], key: Sequence[str], p: str = "p") -> DataFrame:
    """Benjamini–Hochberg step-up q values within each family ``by``.

    The rank counts from the small end, the running minimum from the large end; both are slab-wise,
    so a family may have any number of tests.
    """
    one = F.lit(1).cast("long")
    ranked = running(tests, by, [F.col(p), *[F.col(k) for k in key]], {"rank": ("sum", one)})
    raw = ranked.withColumn("_raw", F.col(p) * F.col("rank_all") / F.col("rank"))
    down = running(raw, by, [F.desc("rank")], {"q": ("min", F.col("_raw"))})
    return down.withColumn("q", F.least("q", F.lit(1.0))).drop("_raw", "q_all")


def bh_rowwise(tests: DataFrame, by: Sequence[str], key: Sequence[str], p: str = "p", q: float = 0.10) -> DataFrame:
    """Row-wise rule ``p <= i/m·q`` without the step-up."""
    ranked = running(tests, by, [F.col(p), *[F.col(k) for k in key]], {"rank": ("sum", F.lit(1).cast("long"))})
    return ranked.withColumn("passes", F.col(p) <= F.col("rank") / F.col("rank_all") * q)


#: Panels and nodes per panel of the integral behind the Student tail.
TAIL_PANELS, TAIL_NODES = 8, 16
#: Scaled angle beyond which the integrand is nothing (below e^-70).
_TAIL_END = 12.0


def student_tail(t: Column, df: Column) -> Column:
    """P(T > t): the integral of cos^(df - 1) up to atan(t / sqrt(df)), by Gauss's rule at a fixed number of nodes.

    The angle is scaled by sqrt(df), so the integrand has the same width at any degrees of freedom, and
    the number of races of a policy does not enter the cost.
    """
    x, w = np.polynomial.legendre.leggauss(TAIL_NODES)
    at = np.concatenate([(p + (x + 1) / 2) / TAIL_PANELS for p in range(TAIL_PANELS)])
    weights = np.tile(w / 2 / TAIL_PANELS, TAIL_PANELS)
    root, half = F.sqrt(df), df / 2
    end = F.least(F.atan(F.abs(t) / root) * root, F.lit(_TAIL_END))
    parts = F.zip_with(F.lit(at), F.lit(weights), lambda u, v: v * F.pow(F.cos(end * u / root), df - 1))
    integral = F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v) * end / root
    # Γ(half + 1/2) / Γ(half): sixteen steps of the recurrence, then the asymptotic series.
    z, steps = half + 16, F.lit(1.0)
    for k in range(16):
        steps = steps * (half + k) / (half + k + 0.5)
    series = F.exp(F.log(z) / 2 - 1 / (8 * z) + 1 / (192 * z**3) - 1 / (640 * z**5) + 17 / (14336 * z**7))
    inside = steps * series / math.sqrt(math.pi) * integral
    return F.lit(0.5) - F.signum(t) * inside


def t_pvalues(stats: DataFrame) -> DataFrame:
    """One-sided p value of a mean above zero from ``n_races``, ``net_mean``, ``net_sd``.

    Fewer than two races give 1, zero spread gives 0 or 1 by the sign of the mean.
    """
    n, mean, sd = F.col("n_races"), F.col("net_mean"), F.col("net_sd")
    tail = student_tail(mean / (sd / F.sqrt(n)), n - 1)
    p = (
        F.when(n.isNull() | (n < 2) | mean.isNull(), 1.0)
        .when(sd.isNull() | (sd == 0), F.when(mean > 0, 0.0).otherwise(1.0))
        .otherwise(F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0)))
    )
    return stats.withColumn("p", p)


# --- resampling -------------------------------------------------------------------------------

# Poisson(1) cut points on a 20-bit draw: P(K<=0), P(K<=1), … as whole numbers of 2^-20, as far as the
# draw can tell them from 1 (weights up to 9).
DRAW_BITS = 20
DRAWS_PER_DIGEST = 6
_CUMULATED = [round(2**DRAW_BITS * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(16)]
POISSON_CUTS = [c for c in _CUMULATED if c < 2**DRAW_BITS]


def _draw_words(clusters: DataFrame, key: Column, replicates: int, seed: str) -> DataFrame:
    """One row per cluster and block of six replicates, with two 60-bit words of the digest."""
    blocks = -(-replicates // DRAWS_PER_DIGEST)
    # A small cluster table would be read by one task and then multiplied there; the key text is built
    # once per cluster, below the explode.
    tasks = max(int(clusters.sparkSession.conf.get("spark.sql.shuffle.partitions")), clusters.sparkSession.sparkContext.defaultParallelism)
    named = clusters.withColumn("_key", F.concat_ws("|", F.lit(seed), key)).repartition(tasks, "_key")
    hashed = named.withColumn("_blk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn(
        "_h", F.md5(F.concat_ws("|", "_key", "_blk"))).drop("_key")
    word = lambda at: F.conv(F.substring("_h", at, 15), 16, 10).cast("long")
    return hashed.select("*", word(1).alias("_w0"), word(17).alias("_w1")).drop("_h")


def _slot_weight(slot: int) -> Column:
    """Poisson(1) weight of one of the six replicates of a block."""
    bits = F.shiftright(F.col("_w0" if slot < 3 else "_w1"), slot % 3 * DRAW_BITS).bitwiseAND(F.lit(2**DRAW_BITS - 1))
    weight = F.lit(0)
    for cut in POISSON_CUTS:
        weight = weight + (bits >= cut).cast("int")
    return weight


def poisson_weights(clusters: DataFrame, key: Column, replicates: int, seed: str) -> DataFrame:
    """Add ``rep`` and a Poisson(1) weight ``w`` per cluster and replicate; weight 0 is left out.

    A draw depends on the cluster key alone, so a recomputed task gives the same weights.
    """
    slots = inline_rows(["_slot", "w"], *[[s, _slot_weight(s)] for s in range(DRAWS_PER_DIGEST)])
    draws = _draw_words(clusters, key, replicates, seed).select("*", slots)
    draws = draws.withColumn("rep", F.col("_blk") * DRAWS_PER_DIGEST + F.col("_slot"))
    return draws.where((F.col("rep") < replicates) & (F.col("w") > 0)).drop("_blk", "_w0", "_w1", "_slot")


@functools.cache
def _weight_of_bits() -> np.ndarray:
    return np.searchsorted(POISSON_CUTS, np.arange(2**DRAW_BITS), side="right").astype(np.uint8)


def poisson_matrix(keys: Sequence[str], replicates: int) -> np.ndarray:
    """Poisson(1) weights (clusters by replicates), the draws of ``poisson_weights``; ``keys`` begin with the seed."""
    blocks = -(-replicates // DRAWS_PER_DIGEST)
    ends = [f"|{k}".encode() for k in range(blocks)]
    digests = b"".join([hashlib.md5(key + end).digest() for key in (k.encode() for k in keys) for end in ends])
    # Each half of a digest holds a word: its first 15 hexadecimal digits, the first draw in the last of them.
    words = np.frombuffer(digests, ">u8").astype(np.uint64).reshape(len(keys), -1, 1) >> np.uint64(4)
    bits = (words >> (np.arange(3, dtype=np.uint64) * np.uint64(DRAW_BITS))) & np.uint64(2**DRAW_BITS - 1)
    return _weight_of_bits()[bits.reshape(len(keys), -1)[:, :replicates].astype(np.int64)]


#: Clusters whose weights a task holds at a time, and groups whose sums it holds.
_DRAWN_ROWS, _HELD_GROUPS = 1024, 512


def replicate_sums(
    clusters: DataFrame, key: Column, by: Sequence[str], sums: dict[str, Column], replicates: int, seed: str
) -> DataFrame:
    """Weighted sums per group and replicate (``rep``); replicates without any weight are left out.

    A task draws the weights of its clusters as a matrix and multiplies it with their values, so one
    row per group and replicate leaves it, whatever the clusters.
    """
    names, by, spark = list(sums), list(by), clusters.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = clusters.select(
        *by, F.concat_ws("|", F.lit(seed), key).alias("_key"), *[v.cast("double").alias(f"_v_{n}") for n, v in sums.items()]
    ).repartition(tasks, "_key")
    kinds = [rows.schema[c] for c in by]
    out = StructType([*kinds, StructField("rep", LongType()), StructField("_weight", LongType()), *[StructField(n, DoubleType()) for n in names]])
    groups = to_arrow_schema(StructType(kinds))

    def given(held: dict[tuple, list]) -> Iterator[pa.RecordBatch]:
        for group, (total, known) in held.items():
            columns = [pa.array([v] * replicates, f.type) for v, f in zip(group, groups, strict=True)]
            columns += [pa.array(np.arange(replicates)), pa.array(total[:, 0].astype(np.int64))]
            columns += [pa.array(total[:, i + 1]) if known[i] else pa.nulls(replicates, pa.float64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, [*by, "rep", "_weight", *names])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, _DRAWN_ROWS):
                part = batch.slice(at, _DRAWN_ROWS)
                weights = poisson_matrix(part.column("_key").to_pylist(), replicates).astype(float)
                known = np.stack([part.column(f"_v_{n}").is_valid().to_numpy(zero_copy_only=False) for n in names], axis=1)
                values = np.stack([np.ones(part.num_rows), *[
                    part.column(f"_v_{n}").fill_null(0.0).to_numpy(zero_copy_only=False) for n in names]], axis=1)
                members: dict[tuple, list[int]] = {}
                for i, group in enumerate(zip(*[part.column(c).to_pylist() for c in by], strict=True) if by else [()] * part.num_rows):
                    members.setdefault(group, []).append(i)
                for group, own in members.items():
                    total, seen = weights[own].T @ values[own], known[own].any(axis=0)
                    had = held.get(group)
                    held[group] = [total, seen] if had is None else [had[0] + total, had[1] | seen]
            if len(held) > _HELD_GROUPS:
                yield from given(held)
                held = {}
        yield from given(held)

    long = rows.mapInArrow(work, out).groupBy(*by, "rep").agg(*[F.sum(c).alias(c) for c in ("_weight", *names)])
    return long.where(F.col("_weight") > 0).select(*by, "rep", "_weight", *names)


def bootstrap_days(days: DataFrame, by: Sequence[str], replicates: int = 2000, seed: str = "days") -> DataFrame:
    """ROI per group by resampling days: point value, 95% interval and P(ROI <= 100)."""
    days = staged(days, "days")
    sums = {"r": F.col("ret"), "s": F.col("stake")}
    reps = replicate_sums(days, F.concat_ws("|", *by, "race_date"), by, sums, replicates, seed).withColumn(
        "roi", F.col("r") / F.col("s") * 100)
    spread = distribution(reps, by, settle(F.col("roi"), 6), {"ci_low": 0.025, "ci_high": 0.975}, [
        (F.sum(F.when(F.col("v") <= 100, F.col("c")).otherwise(0)) / F.sum("c")).alias("p_le100")])
    point = days.groupBy(*by).agg(F.count(F.lit(1)).alias("days"), (F.sum("ret") / F.sum("stake") * 100).alias("roi"))
    return point.join(spread, list(by))


# Replicates of an interval are few (at most some thousand per group), their clusters are not.
_INTERVAL = {"ci_low": 0.025, "ci_high": 0.975}
_RACE_KEY = ("race_date", "place_code", "race_no")


def bootstrap_race_cluster(races: DataFrame, replicates: int = 1000, seed: str = "races") -> DataFrame:
    """Difference of log losses with races as clusters; needs ``lla``, ``llb``, ``n`` per race."""
    races = staged(races.withColumn("_k", F.lit(1)), "clusters")
    sums = {"gap": F.col("lla") - F.col("llb"), "rows": F.col("n")}
    reps = replicate_sums(races, F.concat_ws("|", *_RACE_KEY), ["_k"], sums, replicates, seed).withColumn(
        "d", F.col("gap") / F.col("rows"))
    point = races.groupBy("_k").agg(((F.sum("lla") - F.sum("llb")) / F.sum("n")).alias("delta"), F.count(F.lit(1)).alias("n_races"))
    return point.join(distribution(reps, ["_k"], settle(F.col("d"), 6), _INTERVAL), "_k").drop("_k")


def bootstrap_paired(
    pairs: DataFrame, replicates: int = 2000, seed: str = "pairs", by: Sequence[str] = (), key: Sequence[str] = _RACE_KEY
) -> DataFrame:
    """Paired difference of mean returns, candidate − champion, in points of ROI, per run ``by``."""
    keys = [*by, "_k"]
    rows = staged(pairs.where("champ_ret IS NOT NULL AND cand_ret IS NOT NULL").withColumn("_k", F.lit(1)), "pairs")
    gain = F.col("cand_ret") - F.col("champ_ret")
    reps = replicate_sums(rows, F.concat_ws("|", *key), keys, {"gain": gain}, replicates, seed).withColumn(
        "d", F.col("gain") / F.col("_weight") * 100)
    point = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_bets"), (F.avg("champ_ret") * 100).alias("roi_champion"),
        (F.avg("cand_ret") * 100).alias("roi_candidate"), (F.avg(gain) * 100).alias("roi_delta_pt"))
    spread = distribution(reps, keys, settle(F.col("d"), 6), _INTERVAL).withColumnsRenamed(
        {"ci_low": "roi_ci_low", "ci_high": "roi_ci_high"})
    return point.join(spread, keys, "left").drop("_k")
