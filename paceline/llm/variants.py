"""Spelling variants: exact neighbours at one edit through a dictionary of trie-node pairs.

The words, sorted, are the trie of their prefixes; sorted by their mirror images they are the trie of
their suffixes. The nodes of both tries are numbered while running down the sorted slabs: a word opens
the nodes below its longest common prefix with the word before it. Nodes that reach over the edge of a
slab take the number they have in the slab before, from one row per slab.

A word with a letter skipped is then a pair of integers (prefix node before it, suffix node behind it),
and a word with a gap between two letters is one too. Words that differ in one letter share a skip
pair; a word with one letter more has a skip pair that is a gap pair of the shorter word. Equal pairs
are equal texts, so nothing has to be verified. A run of equal letters is skipped at its first letter
only, so that every neighbour is met once.

A pair has at most one gap word and as many skip words as the alphabet has letters. Neighbours are
counted and the best one is taken inside the pair, by windows over these few rows; pairs of words are
never written out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from paceline.llm import words as W
from paceline.session import staged

#: Different words a task gathers before it hands its counts on.
GATHERED = 400_000
#: One run in so many loses a letter.
MANGLED = 97


def _runs(raw: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased and everything but A-Z, a-z and U+00C0 to U+00FF blank."""
    lower = raw.copy()
    lower[(raw >= 65) & (raw <= 90)] += 32
    wide = raw == 0xC3
    letter = ((lower >= 97) & (lower <= 122)) | wide
    letter[1:] |= wide[:-1]
    lower[~letter] = 32
    return lower


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(``word``, ``n``): the words of all texts after the mangling, long and frequent enough.

    A run whose crc32 (of ``<doc_id>:<run>``) is divisible by 97 loses one letter. Runs of one document
    that are equal are mangled alike, so the check is made once for each of them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def rows() -> pa.RecordBatch:
            kept = [(w, n) for w, n in ((b.decode(), n) for b, n in total.items()) if n > 0 and len(w) >= least_length]
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

        for batch in batches:
            for part in W.slices(batch, "text"):
                raw, bounds = W.text_buffer(part.column("text"))
                clean = _runs(raw).tobytes()
                for k, doc in enumerate(part.column("doc_id").to_pylist()):
                    found = clean[bounds[k] : bounds[k + 1]].split()
                    if not found:
                        continue
                    total.update(found)
                    begin = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                    for word in set(found):
                        h = zlib.crc32(word, begin)
                        if h % MANGLED == 0:
                            letters, n = word.decode(), found.count(word)
                            at = h % len(letters)
                            total[word] -= n
                            total[(letters[:at] + letters[at + 1 :]).encode()] += n
                    if len(total) > GATHERED:
                        yield rows()
        yield rows()

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = read.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- trie nodes ----------------------------------------------------------------------------------


def _descent(rows: DataFrame, text: str, slabs: int) -> DataFrame:
    """``rows`` sorted by ``text`` in slabs, with ``slab``, ``place`` and the local ``nodes`` from the root to the text.

    The nodes of a slab's first text are numbered by their depth, 0 for the root.
    """
    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab, before, path, fresh, place = TaskContext.get().partitionId(), None, [], 0, 0
        for batch in batches:
            out = []
            for word in batch.column(text).to_pylist():
                shared = 0
                if before is None:
                    path, fresh = list(range(len(word) + 1)), len(word) + 1
                else:
                    most = min(len(word), len(before))
                    while shared < most and word[shared] == before[shared]:
                        shared += 1
                    more = len(word) - shared
                    path, fresh = path[: shared + 1] + list(range(fresh, fresh + more)), fresh + more
                out.append(path)
                before = word
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([slab] * n, pa.int64()), pa.array(range(place, place + n), pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                [*batch.schema.names, "slab", "place", "nodes"])
            place += n

    return rows.repartitionByRange(slabs, text).sortWithinPartitions(text).mapInArrow(number, f"{kinds}, slab bigint, place bigint, nodes array<bigint>")


def numbered(rows: DataFrame, text: str, nodes: str, label: str) -> DataFrame:
    """``rows`` with the numbers of the trie nodes from the root to ``text`` as ``nodes``, and ``rank`` in sorted order from 0.

    ``text`` has to be distinct. One row per slab (first and last text, the last one's path, counts) goes
    through the driver and joins the slabs.
    """
    spark = rows.sparkSession
    local = staged(_descent(rows, text, int(spark.conf.get("spark.sql.shuffle.partitions"))), label)
    ends = local.groupBy("slab").agg(
        F.min_by(text, "place").alias("first"), F.max_by(text, "place").alias("last"), F.max_by("nodes", "place").alias("path"),
        F.count(F.lit(1)).alias("n"), F.max(F.array_max("nodes")).alias("most")).orderBy("slab").collect()
    joins, before, offset, rank, path = [], "", 0, 0, []
    for e in ends:
        shared = -1 if not joins else 0
        while 0 <= shared < min(len(before), len(e["first"])) and before[shared] == e["first"][shared]:
            shared += 1
        alias = path[: shared + 1]
        joins.append((e["slab"], alias, offset, rank))
        path = [alias[x] if x < len(alias) else offset + x for x in e["path"]]
        before, offset, rank = e["last"], offset + e["most"] + 1, rank + e["n"]
    edges = spark.createDataFrame(joins, "slab long, _alias array<long>, _offset long, _rank long")
    known = F.transform("nodes", lambda x: F.coalesce(F.get("_alias", x.cast("int")), F.col("_offset") + x))
    out = local.join(F.broadcast(edges), "slab").withColumn("_nodes", known).withColumn("rank", F.col("_rank") + F.col("place"))
    return out.drop("slab", "place", "nodes", *edges.columns[1:]).withColumnRenamed("_nodes", nodes)


# --- neighbours ----------------------------------------------------------------------------------


def _slots(words: DataFrame) -> DataFrame:
    """Skip and gap pairs of all words: ``p``, ``s``, ``no``, ``n``, ``skip``, ``whole`` (the first of equal letters)."""
    size = F.length("word")
    letter = lambda i: F.substring("word", i + 1, F.lit(1))
    p, s = (lambda i: F.get("p", i)), (lambda i: F.get("s", size - i))
    skip = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        p(i).alias("p"), s(i + 1).alias("s"), F.lit(True).alias("skip"), ((i == 0) | (letter(i) != letter(i - 1))).alias("whole")))
    gap = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        p(i).alias("p"), s(i).alias("s"), F.lit(False).alias("skip"), F.lit(False).alias("whole")))
    return words.select("no", "n", F.explode(F.concat(skip, gap)).alias("x")).select("no", "n", "x.*")


def neighbours(words: DataFrame) -> DataFrame:
    """Per word with neighbours: ``no``, ``n_near`` and ``best`` (count and number of the most frequent one).

    ``words`` holds ``no`` (in code-point order), ``word``, ``n`` and the paths ``p`` and ``s``.
    """
    strength = F.struct(F.col("n").alias("n"), (-F.col("no")).alias("after"))
    pair = Window.partitionBy("p", "s")
    ranked = pair.orderBy(F.desc("skip"), F.desc("n"), F.asc("no")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    count = lambda c: F.sum(c.cast("int")).over(ranked)
    rows = _slots(words).select(
        "no", "n", "skip", "whole", count(F.col("skip")).alias("skips"), count(F.col("whole")).alias("wholes"), count(~F.col("skip")).alias("gaps"),
        F.first(strength).over(ranked).alias("one"), F.nth_value(strength, 2).over(ranked).alias("two"),
        F.max(F.when(F.col("whole"), strength)).over(ranked).alias("longer"), F.max(F.when(~F.col("skip"), strength)).over(ranked).alias("shorter"))
    alike = F.col("skips") > 1
    other = F.when(F.col("skip") & alike, F.when(F.col("one.after") == -F.col("no"), F.col("two")).otherwise(F.col("one")))
    from_skip = F.greatest(other, F.when(F.col("whole"), F.col("shorter")))
    near = F.when(F.col("skip"), F.col("skips") - 1 + F.when(F.col("whole"), F.col("gaps")).otherwise(0)).otherwise(F.col("wholes"))
    best = F.when(F.col("skip"), from_skip).otherwise(F.col("longer"))
    found = rows.select("no", near.alias("near"), best.alias("best")).where("near > 0")
    return found.groupBy("no").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(``no``, ``root``) by following ``form`` to its end; the way doubles with each round.

    Counts at least double from word to form, so there are no circles and few rounds.
    """
    now = staged(forms.where("form IS NOT NULL").select("no", F.col("form").alias("root")), "variant-roots")
    while True:
        onward = now.select(F.col("no").alias("root"), F.col("root").alias("further"))
        new = staged(now.join(onward, "root", "left").select(
            "no", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variant-roots")
        now = new.drop("moved")
        if new.where("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3, factor: int = 2) -> DataFrame:
    """One row per word: ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of at least ``least_length`` letters
    and ``least_count`` occurrences in all texts; in the runs that a checksum picks a letter is left out
    first. Two words are near at one inserted, deleted or replaced letter. ``form`` is the near word of
    largest count (ties: the first in code-point order), if that is at least ``factor`` times the word's,
    else null; ``root`` is where the forms lead to. A null id counts as empty text in the checksum, a null
    text has no words; repeated rows count each. Other columns are not carried. An empty table, or one
    without frequent words, gives an empty result. Ids are whole numbers.
    """
    counts = staged(word_counts(docs, id_col, text_col, least_length, least_count), "word-counts")
    words = numbered(counts, "word", "p", "trie-forward").withColumnRenamed("rank", "no")
    words = staged(words, "words")
    mirrored = numbered(words.select("no", F.reverse("word").alias("mirror")), "mirror", "s", "trie-backward")
    found = neighbours(words.join(mirrored.select("no", "s"), "no"))
    strong = F.col("best.n") >= factor * F.col("n")
    linked = words.select("no", "word", "n").join(found, "no", "left").select(
        "no", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, -F.col("best.after")).alias("form"), F.when(strong, F.col("best.n")).alias("form_n"))
    linked = staged(linked, "word-forms")
    names = linked.select("no", "word")
    rooted = linked.join(_roots(linked), "no", "left")
    form, root = (names.select(F.col("no").alias(c), F.col("word").alias(f"{c}_word")) for c in ("form", "root"))
    return rooted.join(form, "form", "left").join(root, "root", "left").select(
        "word", "n", "n_near", F.col("form_word").alias("form"), "form_n", F.coalesce("root_word", "word").alias("root"))
