"""Document quality from weak labels: EM over heuristic labellers, then a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import batch_tokens, byte_batches, mix, stage

#: Votes of a labeller: good, bad, none.
GOOD, BAD, NONE = 1, 0, 2
#: (name, what it measures, good up to, bad from) or, reversed, (good from, bad up to).
LABELLERS = (
    ("symbols", "symbol", 0.05, 0.15),
    ("plain_words", "plain", 0.9, 0.8),
    ("repeats", "repeat", 0.05, 0.15),
    ("near_repeats", "near", 0.3, 0.5),
    ("capitals", "capital", 0.1, 0.3),
    ("exclamations", "exclamation", 0.05, 0.2),
    ("short_words", "short", 0.15, 0.12),
    ("sentences", "stop", 0.02, 0.01),
)
SYMBOLS = b"#$%&*|<>{}[]\\^~_=+@/"
#: A document of fewer tokens gets no votes.
LEAST_TOKENS = 5
EM_ROUNDS = 200
#: Hashed features, and the documents, about, on whose posterior labels the scorer is trained.
BUCKETS = 1 << 16
SAMPLE_DOCUMENTS = 4000
#: Features of all of them together: of the sample, in order of text hash, what fits is learned from.
SAMPLE_FEATURES = 3_000_000
TRAIN_ROUNDS = 150
REJECT_BELOW = 0.5
#: A document of fewer tokens weighs as if it had so many: little text is little evidence.
FULL_EVIDENCE = 40


def _shares(column: pa.Array):
    """Per document the shares of token kinds and the token count; per token its row and features."""
    data, rows, hashes, starts, ends = batch_tokens(column)
    count = np.diff(rows)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return {name: np.zeros(len(count)) for _, name, _, _ in LABELLERS}, count, none, none
    row = np.repeat(np.arange(len(count)), count)
    first, last, middle = data[starts], data[ends - 1], data[(starts + ends) // 2]
    before_last = data[np.maximum(ends - 2, starts)]
    length = ends - starts
    upper = lambda b: (b >= 65) & (b <= 90)
    symbol = np.isin(last, np.frombuffer(SYMBOLS, np.uint8))
    repeat = np.zeros(len(row), bool)
    repeat[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    capital = (upper(first) | (first >= 128)) & upper(middle)
    letter = lambda b: (b >= 128) | (b >= 97) & (b <= 122)
    near = np.zeros(len(row), bool)  # also one of the eight tokens before
    for back in range(1, 9):
        near[back:] |= (hashes[back:] == hashes[:-back]) & (row[back:] == row[:-back])
    plain = letter(last) | np.isin(last, np.frombuffer(b".,;:?", np.uint8)) & (letter(before_last) | upper(before_last))
    kinds = {
        "symbol": symbol, "plain": plain | (length == 1) & upper(first), "repeat": repeat, "near": near, "capital": capital,
        "exclamation": last == 33, "short": (length <= 3) & (letter(first) | upper(first)) & ~repeat, "stop": last == 46,
    }
    of = np.maximum(count, 1)
    shares = {name: np.bincount(row, weights=kind, minlength=len(count)) / of for name, kind in kinds.items()}
    kind_of = lambda b: np.select([upper(b), (b >= 97) & (b <= 122), b >= 128, (b >= 48) & (b <= 57)], [1, 2, 3, 4], b.astype(np.int64))
    shape = ((kind_of(first) * 256 + kind_of(before_last)) * 256 + kind_of(last)) * 16 + np.minimum(length, 7) * 2 + repeat
    with np.errstate(over="ignore"):
        features = np.stack([mix(shape.astype(np.uint64)), hashes], 1) % np.uint64(BUCKETS)
    return shares, count, np.repeat(row, 2), features.reshape(-1).astype(np.int64)


def _votes(shares: dict[str, np.ndarray], count: np.ndarray) -> np.ndarray:
    """The votes of all labellers as one base-3 number a document."""
    code = np.zeros(len(count), np.int64)
    for _, kind, good, bad in LABELLERS:
        value = shares[kind]
        is_good, is_bad = (value <= good, value >= bad) if good < bad else (value >= good, value <= bad)
        vote = np.where(is_good, GOOD, np.where(is_bad, BAD, NONE))
        code = code * 3 + np.where(count >= LEAST_TOKENS, vote, NONE)
    return code


def vote_counts(documents: DataFrame) -> DataFrame:
    """(votes, documents) over all documents; no more rows than vote patterns."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3 ** len(LABELLERS), np.int64)
        for batch in byte_batches(batches, "text"):
            shares, tokens, _, _ = _shares(batch["text"])
            np.add.at(total, _votes(shares, tokens), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["votes", "n"])

    counted = documents.select("text").mapInArrow(count, "votes long, n long")
    return counted.groupBy("votes").agg(F.sum("n").alias("documents"))


def estimate(votes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Per pattern the posterior of good; per labeller and class its rates of bad and good
    votes; the share of good.

    A vote not cast says nothing. Expectation maximisation of a two-class mixture in which labellers vote independently given the
    class. It starts from any vote for bad as bad: each labeller knows one kind of bad document and
    finds nothing wrong with the other kinds.
    """
    n = len(LABELLERS)
    each = votes[:, None] // 3 ** np.arange(n - 1, -1, -1)[None, :] % 3
    posterior = np.where((each == BAD).any(1), 0.1, 0.9)
    rates, prior = np.full((n, 2, 2), 1 / 2), 0.5
    total = max(counts.sum(), 1)
    for _ in range(EM_ROUNDS):
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        prior = float(np.clip(weight[1].sum() / total, 1e-6, 1 - 1e-6))
        log = np.full((2, len(votes)), np.log([[1 - prior], [prior]]))
        for i in range(n):
            cast = np.stack([weight[:, each[:, i] == v].sum(1) for v in (BAD, GOOD)], 1) + 0.5
            rates[i] = cast / cast.sum(1, keepdims=True)
            voted = each[:, i] != NONE
            log[:, voted] += np.log(rates[i][:, each[voted, i]])
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
        moved, posterior = np.abs(new - posterior).max(initial=0), new
        if moved < 1e-9:
            break
    return posterior, rates, prior


def _sparse(row: np.ndarray, features: np.ndarray, count: np.ndarray):
    """(row, bucket, weight): the square root of a bucket's share of the document's tokens."""
    pair, times = np.unique(row * BUCKETS + features, return_counts=True)
    at = pair // BUCKETS
    return at, pair % BUCKETS, np.sqrt(times / np.maximum(count[at], FULL_EVIDENCE))


def train(documents: DataFrame) -> dict:
    """The scorer: weights, intercept, and the labellers' estimated rates.

    The labellers' counts cover all documents. The scorer learns from a sample of about
    ``SAMPLE_DOCUMENTS``, those whose text hash falls in a fixed part of the whole, of which
    ``SAMPLE_FEATURES`` bounds what the driver holds.
    """
    spark = documents.sparkSession
    patterns = stage(vote_counts(documents), "votes").orderBy("votes").collect()
    votes, counts = (np.array([row[c] for row in patterns], np.int64) for c in ("votes", "documents"))
    posterior, rates, prior = estimate(votes, counts)
    of_pattern = np.full(3 ** len(LABELLERS), 0.5)
    of_pattern[votes] = posterior

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "text"):
            shares, count, row, found = _shares(batch["text"])
            at, bucket, weight = _sparse(row, found, count)
            cuts = np.searchsorted(at, np.arange(len(count) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["place"],
                    pa.array(of_pattern[_votes(shares, count)]),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(bucket.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(weight.astype(np.float32))),
                ],
                names=["place", "label", "buckets", "weights"],
            )

    total = max(int(counts.sum()), 1)
    sample = documents.select("text").where(F.pmod(F.xxhash64("text"), F.lit(total)) < SAMPLE_DOCUMENTS)
    distinct = sample.dropDuplicates(["text"]).orderBy(F.xxhash64("text"), "text").limit(SAMPLE_DOCUMENTS)
    placed = distinct.select("text", F.xxhash64("text").alias("place"))
    rows = stage(placed.mapInArrow(features, "place long, label double, buckets array<int>, weights array<float>"), "quality-sample")
    upto = F.sum(F.size("buckets")).over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    table = rows.withColumn("upto", upto).where(F.col("upto") <= SAMPLE_FEATURES).drop("place", "upto").toArrow()
    labels = table["label"].to_numpy()
    sizes = np.array([len(x) for x in table["buckets"]], np.int64)
    row = np.repeat(np.arange(len(labels), dtype=np.int32), sizes)
    bucket = table["buckets"].combine_chunks().flatten().to_numpy() if len(labels) else np.zeros(0, np.int32)
    weight = table["weights"].combine_chunks().flatten().to_numpy() if len(labels) else np.zeros(0)
    weights, intercept = _fit(labels, row, bucket, weight, prior)
    del table, row, bucket, weight
    pa.default_memory_pool().release_unused()
    return {"weights": weights, "intercept": intercept, "rates": rates, "prior": prior}


def _fit(labels, row, bucket, weight, prior) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by adaptive gradient steps over the whole sample."""
    weights, intercept = np.zeros(BUCKETS), float(np.log(prior / (1 - prior)))
    if not len(labels):
        return weights, intercept
    seen, seen_bias = np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(TRAIN_ROUNDS):
        score = intercept + np.bincount(row, weights=weights[bucket] * weight, minlength=len(labels))
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels) / len(labels)
        slope = np.bincount(bucket, weights=error[row] * weight, minlength=BUCKETS) + 1e-6 * weights
        seen += slope**2
        seen_bias += error.sum() ** 2
        weights -= 0.3 * slope / np.sqrt(seen)
        intercept -= 0.3 * error.sum() / np.sqrt(seen_bias)
    return weights, intercept


def _scores(column: pa.Array, weights: np.ndarray, intercept: float) -> np.ndarray:
    _, count, row, features = _shares(column)
    at, bucket, weight = _sparse(row, features, count)
    score = intercept + np.bincount(at, weights=weights[bucket] * weight, minlength=len(count))
    return np.where(count > 0, np.round(1 / (1 + np.exp(-np.clip(score, -30, 30))), 6), 0.0)


def score_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, score, keep) of every document; ``keep`` where the score reaches one half.

    Null and empty texts and those of white space alone score 0. Equal texts score alike.
    """
    model = train(documents)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "text"):
            scores = _scores(batch["text"], model["weights"], model["intercept"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores), pa.array(scores >= REJECT_BELOW)], names=["doc_id", "score", "keep"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, score double, keep boolean")


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, with all their columns."""
    model = train(documents)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "text"):
            scores = _scores(batch["text"], model["weights"], model["intercept"])
            yield batch.filter(pa.array(scores >= REJECT_BELOW))

    return documents.mapInArrow(keep, documents.schema)
