"""Helpers that several corpus operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.session import run_dir

#: Odd multipliers of the polynomial fingerprints, modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: Bytes whose fingerprints are worked out at a time.
CHUNK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(frame: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write a step to the shared folder and read it back: later steps survive lost executors and
    see the same rows, whatever is computed again."""
    path = run_dir(frame.sparkSession, name)
    frame.write.option("compression", compression).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_key(text: Column) -> Column:
    """128-bit key of a text; null for a null text."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def plain_words(text: Column) -> Column:
    """Lower-cased letters and digits, one space between words; a null text has no words."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\p{M}]+", " "))


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(size + 1, base, np.uint64)) * np.uint64(inverse)
        down = np.cumprod(np.full(size + 1, inverse, np.uint64)) * np.uint64(base)
    return up, down


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to size; kept between calls."""
    if base not in _POWERS or len(_POWERS[base][0]) <= size:
        _POWERS[base] = _powers(base, max(size, CHUNK))
    up, down = _POWERS[base]
    return up[: size + 1], down[: size + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a fingerprint over all 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefix_sums(data: np.ndarray, base: int) -> np.ndarray:
    """P with P[j] - P[i] the sum of (byte + 1) * base**position over [i, j)."""
    up, _ = powers(base, len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string or binary column and the offsets of its rows; null is empty."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at.astype(np.int64)


def _tokens(data: np.ndarray, starts_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the tokens between white space; a token also starts at starts_at.

    A token's hash adds up one well-mixed value for each byte and its place in the token: no algebra
    links the values, as powers modulo 2**64 do, where some texts collide for every base.
    """
    letter = data > 32
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    first[starts_at] = letter[starts_at]
    starts = np.flatnonzero(first)
    last = letter.copy()
    last[:-1] &= ~letter[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    sizes = ends - starts
    at = np.flatnonzero(letter)
    place = (at - np.repeat(starts, sizes)).astype(np.uint64)
    values = mix(place * np.uint64(BASES[0]) + (data[at].astype(np.uint64) + np.uint64(1)) * np.uint64(BASES[1]))
    sums = np.add.reduceat(values, np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    return mix(sums + sizes.astype(np.uint64) * np.uint64(BASES[0])), starts, ends


def batch_tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, rows, hashes, starts, ends) of the tokens of a string column; ``rows`` are the
    offsets of the rows in the last three.

    Works through the bytes in chunks cut at white space or a row's end, so that memory follows the
    number of tokens, not 8-byte copies of all bytes.
    """
    data, rows = string_bytes(column)
    parts, at, end = [], int(rows[0]), int(rows[-1])
    with np.errstate(over="ignore"):
        while at < end:
            stop = min(at + CHUNK, end)
            if stop < end:
                row_end = int(rows[np.searchsorted(rows, stop, "right") - 1])
                spaces = np.flatnonzero(data[max(at, row_end) : stop] <= 32)
                cut = max(at, row_end) + int(spaces[-1]) + 1 if len(spaces) else row_end
                next_row = int(rows[np.searchsorted(rows, at, "right")])
                stop = cut if cut > at else min(end, next_row)
            inner = rows[(rows >= at) & (rows < stop)] - at
            hashes, starts, ends = _tokens(data[at:stop], inner)
            parts.append((hashes, starts + at, ends + at))
            at = stop
    if not parts:
        none = np.zeros(0, np.int64)
        return data, np.zeros(len(rows), np.int64), np.zeros(0, np.uint64), none, none
    hashes, starts, ends = (np.concatenate(x) for x in zip(*parts))
    return data, np.searchsorted(starts, rows), hashes, starts, ends


def batch_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows of a column of plain_words, and the offsets of the rows in them."""
    _, rows, hashes, _, _ = batch_tokens(column)
    return hashes, rows


def batch_shingles(words: np.ndarray, offsets: np.ndarray, size: int, padded: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each row and the rows' offsets in them; a row of
    fewer words, but not of none, has one run: all its words. ``padded`` gives the hashes that texts
    of just these words have as rows of fewer than ``padded`` words."""
    lengths = np.diff(offsets)
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    out = np.concatenate([[0], np.cumsum(counts)])
    if not out[-1]:
        return np.zeros(0, np.uint64), out
    row = np.repeat(np.arange(len(lengths)), counts)
    start = offsets[row] + np.arange(out[-1]) - out[row]
    stop = np.minimum(start + size, offsets[row + 1])
    with np.errstate(over="ignore"):
        total = np.zeros(len(start), np.uint64)
        for i in range(size):
            here = start + i
            word = np.where(here < stop, words[np.minimum(here, len(words) - 1)], np.uint64(0))
            total = total * np.uint64(BASES[1]) + word
        for _ in range(size, padded or size):
            total = total * np.uint64(BASES[1])
        return mix(total), out


def record_batches(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def byte_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of one column; a longer row comes alone."""
    for batch in batches:
        _, rows = string_bytes(batch[column])
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(rows, rows[at] + most, "right")) - 1)
            yield batch.slice(at, stop - at)
            at = stop


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); label is the least node of the component.

    Each round lowers every node to the least label among itself and its neighbours, then follows
    labels once more, so the rounds follow the logarithm of a chain's length. Labels only fall, so it
    ends. Rounds are written tables: both join sides are plain scans, which adaptive execution splits where one node is hot.
    """
    both = stage(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        seen = both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), "label").unionByName(labels)
        lower = stage(seen.groupBy("node").agg(F.min("label").alias("label")), "labels")
        up = lower.select(F.col("node").alias("at"), F.col("label").alias("next"))
        jumped = lower.join(up, lower.label == up["at"]).select("node", F.col("next").alias("label"))
        jumped = stage(jumped, "labels")
        old = labels.select("node", F.col("label").alias("old"))
        moved = jumped.join(old, "node").where("label <> old").limit(1).count()
        labels = jumped
        if not moved:
            return labels


def posterior_keep(threshold: float, tolerance: float, hashes: int) -> np.ndarray:
    """For n compared MinHash values, the fewest agreements that keep a pair.

    With a flat prior the similarity given m of n agreements is Beta(m + 1, n - m + 1); it reaches
    the threshold with the chance of at most m successes in n + 1 trials.
    """
    least = np.zeros(hashes + 1, np.int64)
    for n in range(1, hashes + 1):
        chance, m = 0.0, -1
        while chance < tolerance and m < n:
            m += 1
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        least[n] = m
    return least
