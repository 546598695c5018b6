"""Licence scan: Dice coefficient over word bigrams against licence templates, with size bounds.

A text's units are its lines, the text as a whole, and runs of consecutive parts: a part is a sentence of
a line, so runs hold notices that are wrapped over lines and notices inside a longer line. Each is
normalised to lower-case words; two bigram sets of a and b members with s in common have the Dice
coefficient 2 s / (a + b). As s is at most the smaller size, a coefficient of t needs sizes within a factor
of (2 - t) / t of each other: templates out of these bounds are no candidates for a unit, and a unit that
fits no template's bounds is left before its bigrams are looked up. A long unit is left even earlier: k
different words make k - 1 different bigrams at least, so a beginning with too many words settles it. Runs
are built only round seeds: so many bigrams of each template that no unit without one of them can reach the
coefficient. Everything is DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

DICE = 0.8
#: Template bigrams that are broadcast at most.
BROADCAST_BIGRAMS = 200_000

#: Customary licence notices, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This software is released under the MIT License, see the LICENSE file for details."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def normalised(text: Column) -> Column:
    """Runs of letters and digits in lower case, one blank between them."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def bigrams(words: Column) -> Column:
    """The distinct bigrams of a list of words; none for fewer than two."""
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(pairs)


def once(value: Column) -> Column:
    """A column that is computed once however often it is used; the optimiser copies expressions into their uses."""
    return F.explode(F.array(value))


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(``license``, ``text``) rows as a table for ``license_matches``."""
    return spark.createDataFrame(list(templates), "license string, text string")


def seed_pairs(texts: Sequence[str], dice: float) -> list[tuple[str, str]]:
    """Bigrams of which every unit that matches a template holds one; the texts are normalised.

    A unit with s bigrams of a template's b has a coefficient of 2 s / (s + b) at most, so it needs
    s >= dice / (2 - dice) b. The longest bigrams are taken until fewer are left.
    """
    seeds: set[tuple[str, str]] = set()
    for text in texts:
        words = text.split()
        left = sorted(set(zip(words[:-1], words[1:], strict=True)), key=lambda p: (len(p[0]) + len(p[1]), p))
        need = dice / (2 - dice) * len(left) - 1e-9
        while left and len(left) >= need:
            seeds.add(left.pop())
    return sorted(seeds)


def part_runs(docs: DataFrame, id_col: str, text_col: str, seeds: Sequence[tuple[str, str]] | None, low: float, most: int) -> DataFrame:
    """Runs of consecutive parts of a text with at most ``most`` words and more than ``low`` that hold a seed.

    Only texts that hold a seed are cut, and of these only parts within ``most`` words of a seed stay. The
    rows of a text meet in one window over its parts, which spills; a frame holds the words of one run.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    any_seed = r"(?<![\p{L}\p{N}])(?:" + "|".join(rf"{x}[^\p{{L}}\p{{N}}]+{y}" for x, y in seeds or []) + ")"
    seeded = (lambda c: c.rlike(any_seed)) if seeds is not None else (lambda c: F.lit(True))
    held = docs.where(seeded(F.lower(text))).select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("_d"), text.alias("text"))
    lines = held.select("doc_id", "_d", F.posexplode(F.split("text", "\n", -1)).alias("line", "raw"))
    parts = lines.select("doc_id", "_d", F.col("line") + 1, F.posexplode(F.split("raw", r"(?<=[.!?;:])[ \t]+", -1)).alias("nth", "raw"))
    parts = parts.toDF("doc_id", "_d", "line", "nth", "raw").select("doc_id", "_d", "line", "nth", once(normalised(F.col("raw"))).alias("norm"))
    parts = parts.where(F.col("norm") != "").distinct().withColumn("k", F.size(F.split("norm", " ")))

    text_window = Window.partitionBy("doc_id", "_d")
    ordered = text_window.orderBy("line", "nth")
    # A seed that goes on in the next part belongs to the part that it begins in.
    parts = parts.withColumn("seed", seeded(F.concat_ws(" ", "norm", F.substring_index(F.lead("norm").over(ordered), " ", 1))))
    parts = parts.withColumns({"pos": F.row_number().over(ordered), "end": F.sum("k").over(ordered), "of_line": F.count("k").over(Window.partitionBy("doc_id", "_d", "line"))})
    parts = parts.withColumns({"begin": F.col("end") - F.col("k"), "of_text": F.count("k").over(text_window)})
    place = text_window.orderBy("begin")
    before = F.max(F.when(F.col("seed"), F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, 0))
    behind = F.min(F.when(F.col("seed"), F.col("begin"))).over(place.rowsBetween(0, Window.unboundedFollowing))
    parts = parts.withColumns({"before": before, "behind": behind})
    parts = parts.where((F.col("begin") - F.col("before") <= most) | (F.col("behind") - F.col("end") <= most))
    frame = place.rangeBetween(0, most)
    listed = parts.withColumn("run", F.collect_list(F.struct("pos", "line", "end", "seed", "norm")).over(frame))
    spans = listed.select("doc_id", "_d", "pos", "line", "begin", "of_line", "of_text", "run", F.explode(F.sequence(F.lit(1), F.size("run"))).alias("n"))
    last = F.element_at("run", F.col("n"))
    words = last["end"] - F.col("begin")
    spans = spans.where((last["pos"] - F.col("pos") == F.col("n") - 1) & (words <= most) & (words > low))
    taken = F.slice("run", 1, F.col("n"))
    spans = spans.where(F.exists(taken, lambda r: r["seed"]))
    # Whole lines and whole texts are units of their own; here they only compete with the runs.
    whole = ((last["line"] == F.col("line")) & (F.col("n") == F.col("of_line"))) | (F.col("n") == F.col("of_text"))
    return spans.select(
        "doc_id", "_d", F.col("line").alias("unit"), last["line"].alias("last_line"), F.col("pos").alias("first_part"), last["pos"].alias("last_part"),
        whole.alias("whole"), F.array_join(F.transform(taken, lambda r: r["norm"]), " ").alias("norm"))


def best_runs(runs: DataFrame, most: int) -> DataFrame:
    """Runs without a better one of the same licence that overlaps them.

    Better is a larger coefficient, then fewer parts, then an earlier beginning. A run has at most ``most``
    parts, so overlapping runs begin in the same or in neighbouring cells of that width.
    """
    rank = F.struct("dice", F.col("first_part") - F.col("last_part"), -F.col("first_part"))
    cell = F.floor(F.col("first_part") / most)
    mine = runs.withColumns({"_cell": cell, "_rank": rank})
    other = runs.select(F.col("doc_id").alias("o_id"), F.col("_d").alias("o_d"), F.col("license").alias("o_license"), F.col("first_part").alias("o_first"),
                        F.col("last_part").alias("o_last"), rank.alias("o_rank"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("o_cell"))
    beaten = (F.col("_d") == F.col("o_d")) & F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("license") == F.col("o_license")) & (F.col("_cell") == F.col("o_cell")) & (
        F.col("o_first") <= F.col("last_part")) & (F.col("o_last") >= F.col("first_part")) & (F.col("o_rank") > F.col("_rank"))
    return mine.join(other, beaten, "left_anti").where(~F.col("whole"))


def license_matches(
    docs: DataFrame, templates: DataFrame, dice: float = DICE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per unit of a document and licence that it matches.

    Returns ``doc_id``, ``unit`` (0: the whole text, k: its k-th line), ``license``, ``dice`` (best over
    the licence's templates, at least the parameter) and ``n_bigrams``. The whole text is a unit if it
    has several lines. A run of parts (sentences of lines) has the line that it begins in as its unit, and
    ``last_line``, ``first_part`` and ``last_part`` (numbers of the parts that have words, over the text),
    which are null for the other units. A run has at most one word more than the largest template allows
    bigrams; of overlapping runs of a licence the best is given, and none that is a whole line or text. Units of fewer than two words match nothing, and so do null and empty texts and
    templates. Null ids are carried; rows repeated under one id give their rows once. Columns other
    than these are not carried. An empty table on either side gives an empty result.

    A unit is looked up by its bigrams, so only templates that share one are compared.
    """
    shape = templates.select(F.col("license"), bigrams(F.split(normalised(F.col("text")), " ")).alias("g")).where((F.size("g") > 0) & F.col("license").isNotNull())
    shape = shape.distinct().withColumn("template", F.xxhash64("license", "g")).withColumn("b", F.size("g"))
    slack = (2 - dice) / dice
    bounds = shape.agg(F.min("b").alias("lo"), F.max("b").alias("hi"), F.sum("b").alias("all")).first()
    low, high = (bounds.lo / slack, bounds.hi * slack) if bounds.lo else (1, 0)
    few = (bounds.all or 0) <= BROADCAST_BIGRAMS
    lookup = shape.select("license", "template", "b", F.explode("g").alias("bigram"))
    # Small tables of templates go to every task; with others the units' bigrams are shuffled to them.
    lookup = F.broadcast(lookup) if few else lookup

    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n", -1)
    units = F.when(F.size(lines) > 1, F.concat(F.array(text), lines)).otherwise(F.concat(F.array(F.lit("")), lines))
    read = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(units).alias("unit", "raw"))
    # A set of k bigrams takes at least 2 k + 1 characters and k + 1 words.
    read = read.where(F.length("raw") > 2 * low)
    # The last word of the beginning may be cut off and is not counted.
    begin = math.ceil(16 * high)
    different = F.size(F.array_distinct(F.split(normalised(F.left("raw", F.lit(begin))), " "))) - 1
    read = read.where((F.length("raw") <= begin) | (different - 1 <= high)).select("doc_id", "unit", once(normalised(F.col("raw"))).alias("norm"))
    read = read.where(F.length("norm") - F.length(F.replace(F.col("norm"), F.lit(" "), F.lit(""))) >= low - 1e-9)
    near = (F.col("a") <= F.col("b") * slack + 1e-9) & (F.col("b") <= F.col("a") * slack + 1e-9)

    def scored(units: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The best coefficient per unit and licence; ``keys`` name a unit with the text ``norm``."""
        words = units.select(*keys, once(F.split("norm", " ")).alias("w"))
        sets = words.select(*keys, once(bigrams(F.col("w"))).alias("g")).withColumn("a", F.size("g"))
        sets = sets.where((F.col("a") >= low - 1e-9) & (F.col("a") <= high + 1e-9))
        met = sets.select(*keys, "a", F.explode("g").alias("bigram")).join(lookup, "bigram").where(near).distinct()
        shared = met.groupBy(*keys, "a", "license", "template", "b").agg(F.count(F.lit(1)).alias("s"))
        found = shared.withColumn("dice", 2 * F.col("s") / (F.col("a") + F.col("b"))).where(F.col("dice") >= dice - 1e-9)
        return found.groupBy(*keys, "license").agg(F.max(F.struct("dice", "a")).alias("m")).select(
            *keys, "license", F.col("m.dice").alias("dice"), F.col("m.a").alias("n_bigrams"))

    best = scored(read.withColumn("_u", F.xxhash64("norm")), ["doc_id", "unit", "_u"])
    best = best.groupBy("doc_id", "unit", "license").agg(F.max(F.struct("dice", "n_bigrams")).alias("m")).select(
        "doc_id", "unit", "license", "m.dice", "m.n_bigrams", *[F.lit(None).cast("int").alias(c) for c in ("last_line", "first_part", "last_part")])
    if not bounds.lo:
        return best
    seeds = None
    if few:
        named = templates.where(F.col("license").isNotNull()).select(normalised(F.col("text")).alias("norm"))
        seeds = seed_pairs([r.norm for r in named.distinct().collect()], dice)
    most = math.floor(high + 1e-9) + 1
    runs = scored(part_runs(docs, id_col, text_col, seeds, low - 1e-9, most), ["doc_id", "_d", "unit", "last_line", "first_part", "last_part", "whole"])
    return best.unionByName(best_runs(runs, most).select(*best.columns).distinct())
