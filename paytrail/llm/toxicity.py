"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct lower-case words and their first four and five letters, hashed. On a
bounded sample of labelled rows the terms that tell most about the label are chosen, and a
second-order factorization machine is fitted: besides a weight each term has a vector, and the
product of two vectors weighs the pair, so an insult beside a group's name can count for
more than the two apart. Scoring reads every text once, without a shuffle.
"""

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytrail.llm.common import shipped, store, unused

#: Labelled rows used for fitting, at most: those whose doc_id has the smallest hashes.
SAMPLE = 30_000
#: Hash range of terms, terms in the model, and documents a term must occur in.
BUCKETS = 1 << 22
TERMS = 4096
LEAST = 3
#: Log-likelihood ratio a term must reach; by chance one in 100,000 terms does.
EVIDENCE = 20.0
FACTORS = 8
EPOCHS = 12
#: Updates at least, so that a small sample is gone through more often.
STEPS = 400
BATCH = 256
RATE = 0.1
DECAY = 1e-5
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W_]+")


def term(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) % BUCKETS


def word_terms(word: str) -> list[int]:
    """Hashed terms of a word: itself and its beginnings."""
    found = [term(word)]
    if len(word) > 4:
        found.append(term("4" + word[:4]))
    if len(word) > 5:
        found.append(term("5" + word[:5]))
    return found


class _Cache(dict):
    """Word -> what ``find`` says of it, emptied when it gets large."""

    def __init__(self, find):
        self.find = find

    def __missing__(self, word):
        if len(self) > 200_000:
            self.clear()
        value = self[word] = self.find(word)
        return value


def terms_of(text: str | None, cache: _Cache) -> list[int]:
    words = set(_WORD.findall(text.lower())) if text else ()
    return sorted({t for word in words for t in cache[word]})


def fit(rows: list[list[int]], labels: np.ndarray, size: int, seed: int = 7):
    """Bias, weights and vectors of a factorization machine, by AdaGrad on the logistic loss."""
    rng = np.random.default_rng(seed)
    bias, weights = 0.0, np.zeros(size)
    vectors = rng.normal(0, 0.01, (size, FACTORS))
    past_b, past_w, past_v = 1e-8, np.full(size, 1e-8), np.full((size, FACTORS), 1e-8)
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // max(1, len(rows))) if rows else 0)):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            ids = np.concatenate([np.empty(0, np.int64), *(rows[i] for i in pick)]).astype(np.int64)
            doc = np.repeat(np.arange(len(pick)), [len(rows[i]) for i in pick])
            sums = _sums(doc, vectors[ids], len(pick))
            error = _probability(bias, weights, vectors, ids, doc, sums, len(pick)) - labels[pick]
            own = error[doc]
            grad_w = np.bincount(ids, own, size).astype(float)
            grad_v = _sums(ids, own[:, None] * (sums[doc] - vectors[ids]), size)
            seen = np.bincount(ids, minlength=size) > 0
            grad_w[seen] += DECAY * len(pick) * weights[seen]
            grad_v[seen] += DECAY * len(pick) * vectors[seen]
            past_b += error.sum() ** 2
            past_w += grad_w**2
            past_v += grad_v**2
            bias -= RATE * error.sum() / np.sqrt(past_b)
            weights -= RATE * grad_w / np.sqrt(past_w)
            vectors -= RATE * 0.3 * grad_v / np.sqrt(past_v)
    return bias, weights, vectors


def _sums(index, values, size):
    return np.stack([np.bincount(index, values[:, f], size) for f in range(FACTORS)], axis=1, dtype=float)


def _probability(bias, weights, vectors, ids, doc, sums, count):
    own = np.bincount(doc, weights[ids] - 0.5 * (vectors[ids] ** 2).sum(axis=1), count).astype(float)
    return 1 / (1 + np.exp(-np.clip(bias + own + 0.5 * (sums**2).sum(axis=1), -30, 30)))


def training_rows(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of at most SAMPLE labelled rows outside the held-out fold."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)


def held_out(doc_id) -> F.Column:
    """crc32 of the doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def evidence(hits, n, share: float) -> F.Column:
    """Log-likelihood ratio of ``hits`` toxic among ``n`` documents against the overall share.

    Rare words pass a normal approximation by luck; this they pass only with enough documents.
    """
    def part(seen, expected):
        return F.when((seen > 0) & (expected > 0), seen * F.log(seen / expected)).otherwise(0.0)

    return 2 * (part(hits, n * share) + part(n - hits, n * (1 - share)))


def train(docs: DataFrame, labels: DataFrame):
    """(term -> position, bias, weights, vectors) from ``docs`` and ``labels`` (doc_id, toxic)."""

    def hashed(batches):
        cache = _Cache(word_terms)
        for batch in batches:
            lists = [terms_of(text, cache) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(lists, pa.list_(pa.int32()))],
                ["doc_id", "toxic", "terms"],
            )

    # At most SAMPLE rows of two numbers: small enough to send to every executor.
    sample = F.broadcast(training_rows(labels))
    rows = store(
        shipped(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")
        .select("doc_id", "toxic", "text").mapInArrow(hashed, "doc_id long, toxic int, terms array<int>"),
        "toxicity-terms",
    )
    total, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counts = rows.select(F.explode("terms").alias("term"), "toxic").groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits")
    )
    told = counts.where(F.col("n") >= LEAST).withColumn(
        "gain", evidence(F.col("hits"), F.col("n"), positive / total if total else 0.0)
    ).where(F.col("gain") >= EVIDENCE)
    chosen = told.orderBy(F.desc("gain"), "term").limit(TERMS).collect()
    place = {row.term: i for i, row in enumerate(sorted(chosen, key=lambda r: r.term))}

    def fitted(batches):
        ids, marks, texts = [], [], []
        for batch in batches:
            ids += batch.column("doc_id").to_pylist()
            marks += batch.column("toxic").to_pylist()
            texts += [
                np.array([place[t] for t in found if t in place], np.int64)
                for found in batch.column("terms").to_pylist()
            ]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], marks[i], texts[i].tolist()))
        bias, weights, vectors = fit(
            [texts[i] for i in order], np.array([marks[i] for i in order], float), max(1, len(place))
        )
        values = np.concatenate([[bias], weights, vectors.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([values.tolist()])], ["model"])

    # The sample is bounded, so one task fits the model.
    values = np.array(rows.coalesce(1).mapInArrow(fitted, "model array<double>").collect()[0].model)
    size = max(1, len(place))
    return place, values[0], values[1 : size + 1], values[size + 1 :].reshape(size, FACTORS)


def score(docs: DataFrame, model, column: str = "score") -> DataFrame:
    """``docs`` with one more column, the probability that the label is 1.

    Only ``text`` is looked at. Null and empty texts get the model's bias alone.
    """
    place, bias, weights, vectors = model

    def run(batches):
        cache = _Cache(lambda word: tuple(place[t] for t in word_terms(word) if t in place))
        for batch in batches:
            found = [terms_of(text, cache) for text in batch.column("text").to_pylist()]
            ids = np.concatenate([np.empty(0, np.int64), *found]).astype(np.int64)
            doc = np.repeat(np.arange(len(found)), list(map(len, found)))
            sums = _sums(doc, vectors[ids], len(found))
            values = _probability(bias, weights, vectors, ids, doc, sums, len(found))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64())], [*batch.schema.names, column]
            )

    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    return shipped(docs).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs``.

    A row of ``docs`` without a label is scored alike; repeated rows get equal scores; without
    any labels every score is one half. A doc_id labelled twice counts as toxic if it ever is.
    """
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    name = unused(docs, "_toxicity")
    return score(docs, train(docs, labels), name).where(F.col(name) < THRESHOLD).drop(name)
