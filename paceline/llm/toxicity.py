"""Document toxicity by multiple-instance learning over sentences.

Labels are known per document only. Each sentence gets a probability from a logistic model over the
words in it and their beginnings, and a document's score is the noisy-or of its sentences: it is toxic if at least one of
them is. The model is trained through that combination from document labels, so it learns which
sentences are to blame and can point at them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from paceline.llm import words as W
from paceline.session import staged

#: A feature is the low bits of the hash of a word or of its first bytes; beginnings stand for inflected forms.
FEATURE_BITS = 20
PREFIXES = (5, 4)
#: Labelled documents that the classifier is fitted on, at most (the rows of smallest hash).
TRAIN_DOCS = 8_000
#: A feature enters the model if it is in this many training documents at least.
MIN_DOCS = 3
#: Standard deviations by which a feature has to stand out in toxic documents.
SCREEN = 3.0
THRESHOLD = 0.3
SLICE = 1 << 20
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


class Bags(NamedTuple):
    """Distinct features per sentence of several documents, end to end."""

    feature: np.ndarray
    sentence: np.ndarray  # number of the sentence, over all documents
    owner: np.ndarray  # document of each sentence
    begin: np.ndarray  # first byte of each sentence's first word, within its document
    docs: int


def sentences(texts: pa.Array) -> Bags:
    """Split whole texts at ``. ! ?`` and line ends; sentences without words do not count."""
    lowered = pc.utf8_lower(texts)
    hashes, starts, edges = W.located_words(lowered, W.alphanumeric(), PREFIXES)
    raw, bounds = W.text_buffer(lowered)
    owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    if not len(starts):
        nothing = np.zeros(0, np.int64)
        return Bags(nothing.astype(np.int32), nothing, nothing, nothing, len(bounds) - 1)
    ends = np.flatnonzero(_ENDS[raw])
    mark = np.searchsorted(ends, starts)
    fresh = np.empty(len(starts), bool)
    fresh[0] = True
    fresh[1:] = (np.diff(mark) > 0) | (np.diff(owner) > 0)
    number = np.cumsum(fresh) - 1
    feature = np.concatenate(hashes) & np.uint64((1 << FEATURE_BITS) - 1)
    pairs = np.unique((np.tile(number.astype(np.uint64), len(hashes)) << np.uint64(FEATURE_BITS)) | feature)
    first = np.flatnonzero(fresh)
    return Bags(
        (pairs & np.uint64((1 << FEATURE_BITS) - 1)).astype(np.int32), (pairs >> np.uint64(FEATURE_BITS)).astype(np.int64),
        owner[first], starts[first] - bounds[owner[first]], len(bounds) - 1,
    )


def sentence_logits(bags: Bags, model: Model) -> np.ndarray:
    return np.bincount(bags.sentence, model.weights[bags.feature], len(bags.owner)) + model.bias


def noisy_or(logits: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
    """1 - prod(1 - p) per document, from the logits of p; a document without sentences scores 0."""
    return -np.expm1(-np.bincount(owner, np.logaddexp(0, logits), docs))


def by_document(bags: Bags) -> Iterator[np.ndarray]:
    """The features of each document."""
    first = np.searchsorted(bags.sentence, np.searchsorted(bags.owner, np.arange(bags.docs + 1)))
    return (bags.feature[begin:end] for begin, end in zip(first[:-1], first[1:], strict=True))


def screened(documents: Iterable[np.ndarray], toxic: np.ndarray, least: float) -> np.ndarray:
    """Features that stand out in toxic documents by ``least`` standard deviations of their count there."""
    counts, bad = np.zeros((2, 1 << FEATURE_BITS), np.int32)
    for features, label in zip(documents, toxic, strict=True):
        present = np.unique(features)
        counts[present] += 1
        if label:
            bad[present] += 1
    rate = max(float((toxic > 0).mean()), 1e-9) if len(toxic) else 0.0
    spread = np.sqrt(np.maximum(counts * rate * (1 - rate), 1e-12))
    return np.flatnonzero((counts >= MIN_DOCS) & (bad - counts * rate >= least * spread))


def fit(
    bags: Bags, toxic: np.ndarray, rounds: int = 100, rate: float = 0.15, ridge: float = 5e-4, screen: float = SCREEN,
    used: np.ndarray | None = None,
) -> Model:
    """Minimise the log loss of the noisy-or score over the documents by full-batch Adam steps.

    With s the sum of softplus(logit) over a document's sentences the score is 1 - exp(-s): the loss
    is s for a clean document and -log(1 - exp(-s)) for a toxic one. Sentences that already look
    toxic take most of the gradient. Without documents of both kinds the model scores near the share
    of toxic documents everywhere.
    """
    used = screened(by_document(bags), toxic, screen) if used is None else used
    place = np.full(1 << FEATURE_BITS, -1, np.int32)
    place[used] = np.arange(len(used))
    kept = np.flatnonzero(place[bags.feature] >= 0)
    at, inside, owner = place[bags.feature[kept]], bags.sentence[kept], bags.owner
    n, y = max(len(toxic), 1), toxic.astype(bool)
    theta = np.zeros(len(used) + 1)
    theta[-1] = -4.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        logits = np.bincount(inside, theta[at], len(owner)) + theta[-1]
        total = np.bincount(owner, np.logaddexp(0, logits), len(toxic))
        pull = np.where(y, -1 / np.maximum(np.expm1(np.minimum(total, 50)), 1e-6), 1.0)
        slope = pull[owner] / (1 + np.exp(-logits))
        grad = np.append(np.bincount(at, slope[inside], len(used)), slope.sum()) / n
        grad[:-1] += ridge * theta[:-1] / 10
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(1 << FEATURE_BITS, np.float32)
    weights[used] = theta[:-1]
    return Model(weights, float(theta[-1]))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``text`` and ``toxic`` of at most about ``most`` labelled documents outside the held-out part.

    Of several labels of a document the largest counts; null labels and null ids are left out. Which
    documents are taken depends on a hash of their id alone.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = staged(known.where(~held_out(F.col("doc_id"))), "toxic-labels")
    share = min(1.0, most / max(known.count(), 1))
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # The broadcast side has about ``most`` rows of two numbers.
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Model:
    """Fit the model on a bounded sample; features are made in all tasks, the steps run in one."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", SLICE):
                bags = sentences(part.column("text"))
                per_doc = np.searchsorted(bags.owner, np.arange(bags.docs + 1))
                cut = np.searchsorted(bags.sentence, per_doc)
                lists = [
                    pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x.astype(np.int32)))
                    for x in (bags.feature, bags.sentence)
                ]
                yield pa.RecordBatch.from_arrays([part.column("toxic"), *lists], ["toxic", "feature", "sentence"])

    def steps(rows: pa.Table) -> pa.Table:
        def pieces() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            """Features, sentences and the documents' ends in both, without copying the table."""
            for batch in rows.to_batches():
                feature, inside = (batch.column(c).flatten().to_numpy() for c in ("feature", "sentence"))
                yield feature, inside, np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("feature")).to_numpy())])

        toxic = rows.column("toxic").to_numpy()
        documents = (f[begin:end] for f, _, ends in pieces() for begin, end in zip(ends[:-1], ends[1:], strict=True))
        used = screened(documents, toxic, SCREEN)
        wanted = np.zeros(1 << FEATURE_BITS, bool)
        wanted[used] = True
        feature, inside, counts, base = [], [], [], 0
        for f, s, ends in pieces():
            # A document's sentences are numbered on from where its slice began: number them from 0 over all.
            some = np.flatnonzero(np.diff(ends))
            number = np.zeros(len(ends) - 1, np.int64)
            number[some] = s[ends[some + 1] - 1] - s[ends[some]] + 1
            shift = np.zeros(len(ends) - 1, np.int64)
            shift[some] = base + np.cumsum(number)[some] - number[some] - s[ends[some]]
            kept = np.flatnonzero(wanted[f])
            feature.append(f[kept])
            inside.append(s[kept] + shift[np.searchsorted(ends, kept, "right") - 1])
            counts.append(number)
            base += int(number.sum())
        if not base:
            return pa.table({"weights": pa.array([], pa.binary()), "bias": pa.array([], pa.float64())})
        owner = np.repeat(np.arange(len(toxic)), np.concatenate(counts))
        model = fit(Bags(np.concatenate(feature), np.concatenate(inside), owner, np.zeros(0), len(toxic)), toxic, used=used)
        W.release()
        return pa.table({"weights": pa.array([model.weights.tobytes()], pa.binary()), "bias": [model.bias]})

    rows = training_rows(docs, labels, most).mapInArrow(features, "toxic int, feature array<int>, sentence array<int>")
    got = rows.withColumn("fold", F.lit("all")).groupBy("fold").applyInArrow(steps, "weights binary, bias double").collect()
    if not got:
        return Model(np.zeros(1 << FEATURE_BITS, np.float32), -np.inf)
    return Model(np.frombuffer(got[0].weights, np.float32), got[0].bias)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``score``, ``predicted``, ``n_sentences``, ``offending``.

    ``offending`` lists, for predicted documents, the sentences that alone reach the threshold, or
    the likeliest one: byte position in the lower-cased text and probability. Only the text enters a
    score. Null and empty texts have no sentence and score 0. Repeated rows get a row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.tobytes(), model.bias))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Model(np.frombuffer(shared.value[0], np.float32), shared.value[1])
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("probability", pa.float64())]))
        for batch in batches:
            for part in W.slices(batch, "text", SLICE):
                bags = sentences(part.column("text"))
                logits = sentence_logits(bags, mine)
                total = noisy_or(logits, bags.owner, bags.docs)
                p = 1 / (1 + np.exp(-np.maximum(logits, -700)))
                best = np.zeros(bags.docs)
                np.maximum.at(best, bags.owner, p)
                blamed = (total >= threshold)[bags.owner] & (p >= np.minimum(best[bags.owner], threshold))
                at = np.flatnonzero(blamed)
                edges = np.searchsorted(bags.owner[at], np.arange(bags.docs + 1))
                found = pa.StructArray.from_arrays([pa.array(bags.begin[at].astype(np.int64)), pa.array(p[at])], ["begin", "probability"])
                counts = np.bincount(bags.owner, minlength=bags.docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(total), pa.array((total >= threshold).astype(np.int32)),
                        pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), found).cast(kind),
                    ],
                    ["doc_id", "score", "predicted", "n_sentences", "offending"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(
        work, f"doc_id {kind}, score double, predicted int, n_sentences bigint, offending array<struct<begin:bigint,probability:double>>"
    )


def toxicity(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """Train on the labels outside the held-out part and score every document.

    Returns the columns of ``score`` with ``held_out`` behind the id. Without usable labels every
    score is 0. Other columns of both tables are not read.
    """
    out = score(docs, train(docs, labels, most))
    rest = [c for c in out.columns if c != "doc_id"]
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *rest)


def drop_toxic(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    model = train(docs, labels, most)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.tobytes(), model.bias))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Model(np.frombuffer(shared.value[0], np.float32), shared.value[1])
        for batch in batches:
            for part in W.slices(batch, "text", SLICE):
                bags = sentences(part.column("text"))
                total = noisy_or(sentence_logits(bags, mine), bags.owner, bags.docs)
                yield part.filter(pa.array(total < THRESHOLD))

    return docs.mapInArrow(work, docs.schema)
