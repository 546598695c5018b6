"""Secret scan: candidate strings judged by a random forest that removes false positives.

Candidates are long runs of key characters. A forest trained on labelled findings judges each by its
length, its character transitions, how much of it dictionary words cover, the path it comes from and
the words next to it. The dictionary and the transition model are counted over all texts.
Everything is DataFrame functions and Spark ML.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from paceline.session import staged

#: Shortest run of key characters that is looked at.
LEAST = 16
#: A word counts as dictionary word if it occurs this often in all texts.
DICTIONARY_COUNT = 5
#: Labelled findings the forest is grown on, at most (those of smallest hash).
TRAIN_FINDINGS = 20_000
_RUN = rf"[A-Za-z0-9+/_\-]{{{LEAST},}}={{0,2}}"
# Words that name a secret, words that name a sample, and paths of tests and samples.
_NAMED = r"(?i)pass|pwd|secret|token|api|key|auth|cred|bearer|private"
_SAMPLE = r"(?i)example|sample|dummy|test|fake|placeholder|changeme"
_SAMPLE_PATH = r"(?i)test|example|sample|mock|fixture|doc|vendor"
FEATURES = [
    "length", "digits", "uppers", "symbols", "switches", "variety", "transition", "coverage", "whole_word", "path_depth", "path_sample",
    "path_hidden", "named_before", "assigned", "quoted", "sample_near", "inside",
]


def words_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"\s+")


def corpus_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(``word``, ``n``): how often each run of three or more ASCII letters, in lower case, occurs in all texts."""
    runs = F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(r"[a-z]{3,}"), F.lit(0)))
    return docs.select(runs.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _pairs(text: Column) -> Column:
    """The neighbouring characters of a string, two by two."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - 1, F.lit(1))), lambda i: F.substring(text, i, 2))


def transition_model(words: DataFrame) -> DataFrame:
    """(``pair``, ``logp``): log probability of the second character of a pair after the first, in the corpus."""
    counts = words.select(F.explode(_pairs(F.col("word"))).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
    first = counts.groupBy(F.substring("pair", 1, 1).alias("first")).agg(F.sum("n").alias("all"))
    joined = counts.withColumn("first", F.substring("pair", 1, 1)).join(first, "first")
    return joined.select("pair", F.log(F.col("n") / F.col("all")).alias("logp"))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row per candidate: ``doc_id``, ``path``, ``word_no``, ``nth``, ``word``, ``found``, and its neighbours.

    A candidate is a run of 16 or more letters, digits and ``+/_-`` inside a word; small letters
    alone, the first perhaps a capital, are none.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(path_col).cast("string").alias("path"), words_of(F.col(text_col)).alias("w"))
    at = F.filter(F.sequence(F.lit(1), F.size("w")), lambda i: (F.octet_length(F.element_at("w", i)) >= LEAST) & F.element_at("w", i).rlike(_RUN))
    read = read.withColumn("word_no", F.explode(at))
    around = lambda k: F.coalesce(F.try_element_at("w", F.when(F.col("word_no") + k > 0, F.col("word_no") + k)), F.lit(""))
    near = read.select("doc_id", "path", "word_no", around(0).alias("word"), around(-1).alias("before"), around(-2).alias("before2"), around(1).alias("after"))
    each = near.select("*", F.posexplode(F.regexp_extract_all("word", F.lit(_RUN), F.lit(0))).alias("nth", "found"))
    plain = F.col("found").rlike(r"^[A-Z]?[a-z]+$")
    return each.where(~plain)


def with_features(found: DataFrame, words: DataFrame, transitions: DataFrame) -> DataFrame:
    """Add the columns of ``FEATURES`` to the candidates."""
    f, n = F.col("found"), F.length("found").cast("double")
    share = lambda kind: (F.length(F.regexp_replace(f, f"[^{kind}]", "")) / n).cast("double")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(f, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0"), "[^aA0]+", "-")
    flag = lambda c: c.cast("double")
    lead = F.expr("substring_index(word, found, 1)")
    path = F.coalesce("path", F.lit(""))
    out = found.withColumns({
        "cand": F.xxhash64("found"),
        "length": n, "digits": share("0-9"), "uppers": share("A-Z"), "symbols": share("+/_=\\-"),
        "switches": F.length(kinds) / n, "variety": F.size(F.array_distinct(F.split(f, ""))) / n,
        "path_depth": F.size(F.split(path, "/")).cast("double"), "path_sample": flag(path.rlike(_SAMPLE_PATH)), "path_hidden": flag(path.rlike(r"(^|/)\.")),
        "named_before": flag(lead.rlike(_NAMED) | F.col("before").rlike(_NAMED) | F.col("before2").rlike(_NAMED)),
        "assigned": flag(lead.rlike("[=:]") | F.col("before").rlike("[=:]$")), "quoted": flag(F.col("word").rlike("[\"'`]")),
        "sample_near": flag(F.concat_ws(" ", "word", "before", "before2", "after").rlike(_SAMPLE)),
        "inside": flag(F.length("word") > F.length(f) + 2),
    })
    # Each different string is measured against the corpus once.
    strings = staged(out.select("cand", "found").distinct(), "strings")
    low = F.lower("found")
    pairs = strings.select("cand", F.explode(_pairs(low)).alias("pair")).join(F.broadcast(transitions), "pair", "left")
    paired = pairs.groupBy("cand").agg(F.avg(F.coalesce("logp", F.lit(-9.0))).alias("transition"))
    runs = strings.select("cand", F.length("found").alias("len"), F.explode(F.regexp_extract_all(low, F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    known = words.where(F.col("n") >= DICTIONARY_COUNT).select("word", F.lit(1).alias("known"))
    covered = runs.join(known, "word", "left").groupBy("cand").agg(
        (F.sum(F.when(F.col("known") == 1, F.length("word")).otherwise(0)) / F.first("len")).alias("coverage"),
        F.max(F.when((F.col("known") == 1) & (F.length("word") == F.col("len")), 1.0).otherwise(0.0)).alias("whole_word"),
    )
    measured = strings.select("cand").join(paired, "cand", "left").join(covered, "cand", "left").na.fill(0.0, ["transition", "coverage", "whole_word"])
    return out.join(measured, "cand").drop("cand")


def known_kind() -> Column:
    """1 or 0 for findings whose form settles the matter, else null: the stand-in for a table of labelled findings.

    1: an access key of a fixed prefix, or a hexadecimal string of 18 or more digits assigned to a name
    of a secret. 0: digits alone, or letters with at most one digit.
    """
    found, before, before2 = F.col("found"), F.col("before"), F.col("before2")
    named = F.expr("substring_index(word, found, 1)").rlike(r"(?i)(password|passwd|token|secret|api_?key)\s*[=:]") | (before.rlike("^[=:]$") & before2.rlike(_NAMED))
    secret = found.rlike(r"^AKIA[0-9A-Z]{16}$") | (found.rlike("^[0-9a-f]{16,}$") & found.rlike("[a-f]") & named)
    harmless = found.rlike("^[0-9]+$") | ~found.rlike("[0-9].*[0-9]")
    return F.when(secret, 1.0).when(harmless, 0.0)


def train(labelled: DataFrame, trees: int = 40, depth: int = 6, most: int = TRAIN_FINDINGS) -> PipelineModel | None:
    """Grow the forest on findings with ``FEATURES`` and ``label``; null labels are left out.

    At most about ``most`` findings of each label, those of smallest hash, are used. Without findings
    of both labels there is no model.
    """
    known = staged(labelled.where(F.col("label").isNotNull()).select("label", "found", *FEATURES), "labelled")
    sizes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    share = F.lit(0.0)
    for label, size in sizes.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, most / size))).otherwise(share)
    drawn = known.where(F.pmod(F.xxhash64(*known.columns), F.lit(1 << 20)) < share * (1 << 20))
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=17)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features")
    return PipelineModel([assembled, forest.fit(assembled.transform(drawn))])


def secret_scan(
    docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source"
) -> DataFrame:
    """One row per candidate: ``doc_id``, ``word_no``, ``nth``, ``length``, ``found_sha256``, ``probability``, ``is_secret``.

    ``word_no`` counts the white-space separated words of the text from 1, ``nth`` the candidates in
    that word from 0; the string itself is not repeated, only its SHA-256. ``labelled`` holds
    (``doc_id``, ``word_no``, ``nth``, ``label``) of judged findings; without it ``known_kind`` judges
    those whose form settles the matter. Where no model can be grown, the probability is null and
    nothing is a secret. Null texts and paths count as empty; null ids are carried but have no labels;
    rows repeated under one id give their candidates each. An empty table gives an empty result.
    """
    words = staged(corpus_words(docs, text_col), "corpus-words")
    transitions = transition_model(words)
    found = staged(with_features(candidates(docs, id_col, text_col, path_col), words, transitions), "findings")
    if labelled is None:
        judged = found.withColumn("label", known_kind())
    else:
        verdicts = labelled.groupBy("doc_id", "word_no", "nth").agg(F.max("label").cast("double").alias("label"))
        judged = found.join(verdicts, ["doc_id", "word_no", "nth"])
    model = train(judged)
    out = ["doc_id", "word_no", "nth", F.col("length").cast("long").alias("length"), F.sha2("found", 256).alias("found_sha256")]
    if model is None:
        return found.select(*out, F.lit(None).cast("double").alias("probability"), F.lit(False).alias("is_secret"))
    scored = model.transform(found).withColumn("p", vector_to_array("probability")[1])
    return scored.select(*out, F.col("p").alias("probability"), (F.col("p") >= 0.5).alias("is_secret"))
