"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import BASES, batch_shingles, batch_words, byte_batches, mix, plain_words, powers, stage, text_key

#: Words of a seed, so of the shortest tile, and of the shortest items: those between the two are
#: held where all their words stand in a row.
SEED_WORDS, LEAST_WORDS = 5, 3
#: Share of an item's words that tiles must cover for a document to hold the item.
COVERAGE = 0.5
#: Bits of the filter for seeds and bits set for each: a fixed size, whatever the benchmark's.
FILTER_BITS = 1 << 24
FILTER_SHIFTS = (0, 20, 40)

TILES_DDL = "text_id binary, item_no long, covered long, words long, tiles int"


class _Words:
    """Words of a text, of which some are marked, with running hashes of the windows over the others."""

    def __init__(self, words: np.ndarray, places: np.ndarray):
        self.words, self.places, self.free = words, places, np.ones(len(words), bool)
        up, self.down = powers(BASES[0], len(words))
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=self.sums[1:])
        self._measure()

    def _measure(self) -> None:
        """How many words that follow each other are free from every word on."""
        at = np.arange(len(self.words))
        ends = np.append(np.flatnonzero(~self.free[:-1] | ~self.free[1:] | (np.diff(self.places) != 1)), len(at) - 1)
        self.room = np.where(self.free, ends[np.searchsorted(ends, at)] - at + 1, 0)

    def mark(self, start: int, size: int) -> None:
        self.free[start : start + size] = False
        self._measure()

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(self.room >= size)
        return starts, mix((self.sums[starts + size] - self.sums[starts]) * self.down[starts])


def _common(ours: _Words, theirs: _Words, size: int) -> tuple[int, int] | None:
    """Start in both of the first run of ``size`` free words that both hold, by their hashes; the words
    themselves are compared."""
    starts, hashes = ours.windows(size)
    others, other_hashes = theirs.windows(size)
    for i in np.flatnonzero(np.isin(hashes, other_hashes)):
        words = ours.words[starts[i] : starts[i] + size]
        for b in others[other_hashes == hashes[i]]:
            if (theirs.words[b : b + size] == words).all():
                return int(starts[i]), int(b)
    return None


def tile(item: np.ndarray, document: np.ndarray, least: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """(item position, document position, words) of greedy tiles of at least ``least`` words.

    Words that lie in no window of ``least`` words of the other text can't be in a tile and go first.
    Then the longest run of unmarked words in both is looked for with running hashes, the length
    found by halving, and marked; of equals the first in the item, then in the document; until none
    is left. Order plays no part, so passages in another order are all found. No list of pairs is
    made: memory follows the words, whatever they repeat.
    """
    if len(item) < least or len(document) < least:
        return []
    with np.errstate(over="ignore"):
        wanted, _ = batch_shingles(item, np.array([0, len(item)]), least)
        held, _ = batch_shingles(document, np.array([0, len(document)]), least)
        hits = np.flatnonzero(np.isin(held, wanted))
        if not len(hits):
            return []
        cover = np.zeros(len(document) + 1, np.int64)
        cover[hits] += 1
        np.subtract.at(cover, hits + least, 1)
        places = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        ours, theirs = _Words(item, np.arange(len(item))), _Words(document[places], places)
        tiles, most = [], len(item)
        while True:
            low, high, best = least, min(most, int(ours.room.max()), int(theirs.room.max())), None
            size = high  # the next tile is often as long as the one before
            while low <= high:
                found = _common(ours, theirs, size)
                if found:
                    best, low = (*found, size), size + 1
                else:
                    high = size - 1
                size = (low + high + 1) // 2
            if best is None:
                return tiles
            a, b, most = best
            tiles.append((a, int(places[b]), most))
            ours.mark(a, most)
            theirs.mark(b, most)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_no, item_id, words) of the distinct items with at least ``LEAST_WORDS`` words."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), plain_words(F.col("text")).alias("words"))
    items = items.where(F.size(F.split("words", " ")) >= LEAST_WORDS).distinct()
    return stage(items.withColumn("item_no", F.monotonically_increasing_id()), "benchmark-items")


def _document_seeds(words: np.ndarray, offsets: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all runs of five words and of those of the given lesser sizes, which are hashed as
    the seed of an item of so many words is."""
    rows, seeds = [], []
    for size in [SEED_WORDS, *sizes]:
        shingles, at = batch_shingles(words, offsets, size, SEED_WORDS)
        rows.append(np.repeat(np.arange(len(offsets) - 1), np.diff(at)))
        seeds.append(shingles)
    return np.concatenate(rows), np.concatenate(seeds)


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_batches(batches, "words"):
        shingles, offsets = batch_shingles(*batch_words(batch["words"]), SEED_WORDS)
        item = np.repeat(batch["item_no"].to_numpy(), np.diff(offsets))
        yield pa.RecordBatch.from_arrays([pa.array(shingles.view(np.int64)), pa.array(item)], names=["seed", "item_no"])


def _bits(seeds: np.ndarray) -> list[np.ndarray]:
    return [(seeds >> np.uint64(shift)) & np.uint64(FILTER_BITS - 1) for shift in FILTER_SHIFTS]


def _filter(seeds: DataFrame) -> np.ndarray:
    """Bits of all seeds: at most ``FILTER_BITS`` of them, whatever the number of seeds."""
    bit = lambda shift: F.shiftrightunsigned("seed", shift).bitwiseAND(FILTER_BITS - 1)
    bits = seeds.select(F.explode(F.array(*[bit(s) for s in FILTER_SHIFTS])).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS int))")).alias("mask")
    )
    table, out = words.toArrow(), np.zeros(FILTER_BITS // 64, np.uint64)
    out[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


def contaminated_texts(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(text_id, item_id, coverage, tiles) of the pairs of text and item above the threshold.

    Seeds of the benchmark go through a filter of fixed size to all tasks; it only saves work. Texts
    with a hit are joined with the seeds exactly, and each pair that shares one is tiled.
    """
    spark = documents.sparkSession
    items = benchmark_items(benchmark)
    seeds = stage(items.select("item_no", "words").mapInArrow(_seeds, "seed long, item_no long").distinct(), "seeds")
    sizes = items.select(F.size(F.split("words", " ")).alias("n")).where(F.col("n") < SEED_WORDS).distinct()
    held, short = spark.sparkContext.broadcast(_filter(seeds)), sorted(r.n for r in sizes.collect())

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = held.value
        for batch in byte_batches(batches, "words"):
            row, shingles = _document_seeds(*batch_words(batch["words"]), short)
            at = np.arange(len(shingles))
            for shift in range(len(FILTER_SHIFTS)):
                at = at[present[_bits(shingles[at])[shift]]]
            row = row[at]
            keep = np.unique(row)
            pairs = np.unique(np.stack([row, shingles[at].view(np.int64)], 1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
            cuts = np.append(np.searchsorted(pairs[:, 0], keep), len(pairs)).astype(np.int32)
            picked = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [picked["text_id"], picked["words"], pa.ListArray.from_arrays(pa.array(cuts), pa.array(pairs[:, 1]))],
                names=["text_id", "words", "seeds"],
            )

    texts = documents.where("text IS NOT NULL").select(text_key(F.col("text")).alias("text_id"), plain_words(F.col("text")).alias("words"))
    hits = texts.mapInArrow(candidates, "text_id binary, words string, seeds array<long>")
    hits = stage(hits.groupBy("text_id").agg(F.first("words").alias("words"), F.first("seeds").alias("seeds")), "seed-hits")
    pairs = hits.select("text_id", F.explode("seeds").alias("seed")).join(seeds, "seed").select("text_id", "item_no").distinct()
    pairs = stage(pairs, "seed-pairs")
    wanted = pairs.join(items.select("item_no", F.col("words").alias("item_words")), "item_no")
    both = stage(wanted, "item-pairs").join(hits.select("text_id", "words"), "text_id")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "words"):
            words, rows = batch_words(batch["words"])
            own, ends = batch_words(batch["item_words"])
            found = []
            for n, (text_id, item_no) in enumerate(zip(batch["text_id"].to_pylist(), batch["item_no"].to_pylist())):
                item = own[ends[n] : ends[n + 1]]
                marks = tile(item, words[rows[n] : rows[n + 1]], min(SEED_WORDS, len(item)))
                found.append((text_id, item_no, sum(m[2] for m in marks), len(item), len(marks)))
            columns = list(zip(*found)) or [()] * 5
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in TILES_DDL.split(", ")])

    tiled = both.select("text_id", "item_no", "words", "item_words").mapInArrow(tiles, TILES_DDL)
    held_items = tiled.where(F.col("covered") >= COVERAGE * F.col("words")).select(
        "text_id", "item_no", F.round(F.col("covered") / F.col("words"), 6).alias("coverage"), "tiles"
    )
    held_items = stage(held_items, "contaminated-texts")
    return held_items.join(items.select("item_no", "item_id"), "item_no").select("text_id", "item_id", "coverage", "tiles")


def find_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, coverage, tiles) of every document and benchmark item it holds.

    Words are compared lower-cased and without punctuation. Items of fewer than ``LEAST_WORDS`` words,
    null texts and items among them, are held by nothing, items of fewer than ``SEED_WORDS`` where all
    their words stand in a row; null and empty documents hold nothing.
    Repeated documents each have their rows; a repeated item counts once. Null ids are kept as null.
    """
    found = stage(contaminated_texts(documents, benchmark), "leaks")
    ids = documents.select("doc_id", text_key(F.col("text")).alias("text_id"))
    return ids.join(found, "text_id").select("doc_id", "item_id", "coverage", "tiles")


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that hold no benchmark item."""
    found = stage(contaminated_texts(documents, benchmark).select(F.col("text_id").alias("_leak_id")).distinct(), "leaks")
    return documents.join(found, text_key(F.col("text")) == F.col("_leak_id"), "left_anti")
