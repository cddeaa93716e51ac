"""N-gram Jaccard join: MinHash bands propose pairs, Bayesian pruning drops most, exact sets decide."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import (
    batch_shingles,
    batch_words,
    byte_batches,
    components,
    plain_words,
    posterior_keep,
    stage,
    text_key,
)

WORDS = 5
#: Similarity that links two documents: NUMERATOR / DENOMINATOR, compared in whole numbers.
NUMERATOR, DENOMINATOR = 4, 5
#: 32 bands of 5 MinHash values: a pair of similarity 0.8 misses all bands with a chance of 3 in a million.
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Values compared before the posterior is looked at again, and the posterior below which a pair goes.
STEP, TOLERANCE = 16, 1e-6
#: Shingles of a block: a component of more is cut into blocks, compared two at a time.
BLOCK_SHINGLES = 400_000

_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_BAND_FACTORS = _RANDOM.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SETS_DDL = "doc_id long, text_id binary, set_id binary, shingles long, bands array<long>"
LINKS_DDL = "class_no long, links long, root long"


def signatures(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The MinHash values, upper 32 bits, of rows of shingles; rows without any get zeros."""
    out = np.zeros((len(offsets) - 1, HASHES), np.uint32)
    filled = np.flatnonzero(np.diff(offsets) > 0)
    with np.errstate(over="ignore"):
        at = 0
        while at < len(filled):  # rows that fit a processor's cache together
            stop = max(at + 1, int(np.searchsorted(offsets[filled], offsets[filled[at]] + 32768)))
            rows = filled[at:stop]
            low, high = offsets[rows[0]], offsets[rows[-1] + 1]
            part, starts = shingles[low:high], offsets[rows] - low
            for i in range(HASHES):
                values = ((part * _FACTORS[i] + _TERMS[i]) >> np.uint64(32)).astype(np.uint32)
                out[rows, i] = np.minimum.reduceat(values, starts)
            at = stop
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each row and band; the band is part of the key."""
    with np.errstate(over="ignore"):
        parts = signature.reshape(-1, BANDS, ROWS).astype(np.uint64) + np.uint64(1)
        keys = (parts * _BAND_FACTORS[None]).sum(axis=2, dtype=np.uint64)
        keys ^= keys >> np.uint64(29)
        keys = keys * np.uint64(0xBF58476D1CE4E5B9) + np.arange(BANDS, dtype=np.uint64)[None, :]
    return keys.view(np.int64)


def _unique_sets(shingles: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's shingles sorted and without repeats."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((shingles, row))
    sorted_shingles = shingles[order]
    new = np.ones(len(order), bool)
    new[1:] = (sorted_shingles[1:] != sorted_shingles[:-1]) | (row[1:] != row[:-1])
    kept = row[new]
    return sorted_shingles[new], np.searchsorted(kept, np.arange(len(offsets)))


def shingle_sets(documents: DataFrame) -> DataFrame:
    """(doc_id, text_id, set_id, shingles, bands) of every document.

    ``set_id`` is a 128-bit digest of the set of word shingles, or of the text where it has no
    words; null for a null or empty text.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "words", 2 << 20):
            sets, offsets = _unique_sets(*batch_shingles(*batch_words(batch["words"]), WORDS))
            keys = band_keys(signatures(sets, offsets))
            count, ids = np.diff(offsets), batch["text_id"].to_pylist()
            set_ids = [
                hashlib.md5(sets[a:b].tobytes()).digest() if b > a else text_id
                for a, b, text_id in zip(offsets[:-1], offsets[1:], ids)
            ]
            filled = count > 0
            ends = np.concatenate([[0], np.cumsum(filled * BANDS)]).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[filled].reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_id"], pa.array(set_ids, pa.binary()), pa.array(count), bands],
                names=["doc_id", "text_id", "set_id", "shingles", "bands"],
            )

    text_id = F.when(F.col("text") != "", text_key(F.col("text")))
    columns = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_id.alias("text_id"), plain_words(F.col("text")).alias("words"))
    return columns.mapInArrow(build, SETS_DDL)


def exact_shingles(words: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's set of runs of ``size`` words, as numbers that are equal only if all words are, and
    the rows' offsets; a row of fewer words has one run. Rows must have words."""
    split = pc.split_pattern(words, " ")
    rows = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    word, kinds = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1, len(coded.dictionary) + 1
    counts = np.maximum(np.diff(rows) - size + 1, 1)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(counts)), counts)
    start = rows[row] + np.arange(offsets[-1]) - offsets[row]
    stop = np.minimum(start + size, rows[row + 1])
    code = word[start]
    for i in range(1, size):
        following = np.where(start + i < stop, word[np.minimum(start + i, len(word) - 1)], 0)
        code = np.unique(code * kinds + following, return_inverse=True)[1]
    return _unique_sets(code, offsets)


def _links_in_cell(cell: pa.Table) -> pa.Table:
    """Verified links among the classes of a cell: links a class (weighted by documents) and its root.

    Hashes only prune; what is left is compared by the words themselves. A pair is looked at once: where two bands agree it is still one pair. In a cell of two blocks
    only pairs between the blocks count.
    """
    cell = cell.combine_chunks()
    n = cell.num_rows
    sets, offsets = _unique_sets(*batch_shingles(*batch_words(cell["words"].chunk(0)), WORDS))
    codes, exact = exact_shingles(cell["words"].chunk(0), WORDS)
    flags = np.zeros(int(codes.max(initial=0)) + 1, bool)
    signature, least = signatures(sets, offsets), posterior_keep(NUMERATOR / DENOMINATOR, TOLERANCE, HASHES)
    keys, size, offsets = band_keys(signature), np.diff(exact), exact
    number, copies = cell["class_no"].to_numpy(), cell["copies"].to_numpy()
    block, between = cell["block"].to_numpy(), cell["low"][0].as_py() != cell["high"][0].as_py()
    partners = []  # for each band the rows in order of key, and where a row's key starts and ends
    for b in range(BANDS):
        order = np.argsort(keys[:, b], kind="stable")
        ordered = keys[order, b]
        partners.append((order, np.searchsorted(ordered, keys[:, b]), np.searchsorted(ordered, keys[:, b], "right")))
    several = np.zeros(n, bool)
    for _, low, high in partners:
        several |= high - low > 1
    links, label, linked = np.zeros(n, np.int64), np.arange(n), np.zeros(n, bool)
    mask = np.zeros(n, bool)
    for x in np.flatnonzero(several):
        for order, low, high in partners:
            if high[x] - low[x] > 1:
                mask[order[low[x] : high[x]]] = True
        ys = np.flatnonzero(mask)
        mask[ys] = False
        ys = ys[ys > x]
        if between:
            ys = ys[block[ys] != block[x]]
        agreed = np.zeros(len(ys), np.int64)
        for at in range(0, HASHES, STEP):
            if not len(ys):
                break
            agreed += (signature[ys, at : at + STEP] == signature[x, at : at + STEP]).sum(axis=1)
            likely = agreed >= least[at + STEP]
            ys, agreed = ys[likely], agreed[likely]
        if not len(ys):
            continue
        own = codes[offsets[x] : offsets[x + 1]]
        flags[own] = True
        gathered = np.concatenate([codes[offsets[y] : offsets[y + 1]] for y in ys])
        starts = np.concatenate([[0], np.cumsum(size[ys])[:-1]])
        shared = np.add.reduceat(flags[gathered].astype(np.int64), starts)
        flags[own] = False
        ys = ys[DENOMINATOR * shared >= NUMERATOR * (size[x] + size[ys] - shared)]
        links[x] += copies[ys].sum()
        links[ys] += copies[x]
        linked[x] |= len(ys) > 0
        linked[ys] = True
        for other in np.unique(label[ys]):
            if other != label[x]:
                label[label == other] = label[x]
    rows = np.flatnonzero(linked)
    _, first, group = np.unique(label[rows], return_index=True, return_inverse=True)
    return pa.table({"class_no": number[rows], "links": links[rows], "root": number[rows][first][group] if len(rows) else number[rows]})


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links, text_id, label) of every document.

    Two documents are linked if their sets of five-word shingles have a Jaccard similarity of 0.8 or
    more. ``class_id`` is the least doc_id of all documents that links join, directly or by others;
    ``n_links`` is the number of documents linked to this one, copies included. A text of one to four
    words has one shingle; texts without words are linked if equal; null and empty texts to nothing.
    Null ids never name a class of others. Repeated rows are copies.

    Equal sets become one class before any comparison. Band keys that several classes share join
    them into candidate components; each component's texts go to one cell, or, by blocks of bounded
    size, to one cell for each two blocks, so that a component of a third of all documents is spread
    over tasks. Pairs live inside a task; what leaves it is a sum and a root for each class.
    """
    sets = stage(shingle_sets(documents), "shingle-sets")
    classes = sets.where("set_id IS NOT NULL").groupBy("set_id").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id"), F.min("text_id").alias("text_id"),
        F.first("shingles").alias("shingles"), F.first("bands").alias("bands"),
    )
    classes = stage(classes.withColumn("class_no", F.monotonically_increasing_id()), "classes")

    keyed = classes.select("class_no", F.explode("bands").alias("band"))
    shared = keyed.groupBy("band").agg(F.min("class_no").alias("root"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    shared = stage(shared, "shared-bands")
    # A class is joined with the least of its bands' roots, and so are those roots: one edge a class and
    # a few among roots, where an edge for each band would be up to 32 times as many.
    roots = keyed.join(shared, "band").groupBy("class_no").agg(F.collect_set("root").alias("roots"))  # one for each band at most
    nodes = F.explode(F.array_union(F.array("class_no"), "roots")).alias("a")
    edges = roots.select(nodes, F.array_min("roots").alias("b")).where("a <> b").distinct()
    parts = components(edges).select(F.col("node").alias("class_no"), F.col("label").alias("part"))
    cells = stage(_cells(classes, parts), "cells")

    texts = documents.where("text <> ''").select(text_key(F.col("text")).alias("text_id"), plain_words(F.col("text")).alias("words"))
    texts = texts.groupBy("text_id").agg(F.first("words").alias("words"))
    placed = texts.join(cells, "text_id").select("part", "low", "high", "block", "class_no", "copies", "words")
    found = stage(placed.groupBy("part", "low", "high").applyInArrow(_links_in_cell, LINKS_DDL), "links")

    links = found.groupBy("class_no").agg(F.sum("links").alias("links"))
    joined = components(found.where("class_no <> root").select(F.col("class_no").alias("a"), F.col("root").alias("b")))
    named = classes.select("set_id", "class_no", "copies", "least_id").join(links, "class_no", "left").join(
        joined.withColumnRenamed("node", "class_no"), "class_no", "left"
    ).withColumn("label", F.coalesce("label", "class_no"))
    named = stage(named, "class-labels")
    least = stage(named.groupBy("label").agg(F.min("least_id").alias("class_id")), "class-names")
    named = stage(
        named.join(least, "label").select(
            "set_id", "label", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        ),
        "named-classes",
    )
    return sets.select("doc_id", "text_id", "set_id").join(named, "set_id", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "text_id",
        "label",
    )


def _cells(classes: DataFrame, parts: DataFrame) -> DataFrame:
    """(part, low, high, block, class_no, copies, text_id): which classes meet in which cell.

    Components within one block share cells of about a block's size: no band key joins two of them,
    so they do not mix. Larger ones get a cell for each pair of blocks.
    """
    members = stage(classes.select("class_no", "copies", "text_id", "shingles").join(parts, "class_no"), "members")
    sizes = members.groupBy("part").agg(F.sum("shingles").alias("all"))
    sizes = stage(sizes.withColumn("blocks", F.ceil(F.col("all") / BLOCK_SHINGLES).cast("int")), "part-sizes")
    small = sizes.where("blocks = 1").agg(F.sum("all")).first()[0] or 0
    pools = int(small // BLOCK_SHINGLES + 1)
    block = F.pmod(F.xxhash64("class_no"), F.col("blocks")).cast("int")
    pooled = F.when(F.col("blocks") == 1, -1 - F.pmod(F.xxhash64("part"), F.lit(pools))).otherwise(F.col("part"))
    dealt = members.join(sizes, "part").withColumn("block", block).withColumn("part", pooled)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return dealt.select("*", other).select(
        "part", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "class_no", "copies", "text_id"
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents, all columns, with one left of each near-duplicate class: that of the least
    doc_id, or of a row with it. Null and empty texts all stay."""
    found = stage(near_duplicates(documents).where("label IS NOT NULL"), "near-duplicates")
    first = found.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_id"))["text_id"].alias("text_id"))
    first = stage(first.select("text_id"), "kept-texts")
    others = [c for c in documents.columns if c != "text"]
    kept = documents.where("text <> ''").groupBy(text_key(F.col("text")).alias("_text_id")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("_none"), *[F.col(f"`{c}`") for c in ["doc_id", *[o for o in others if o != "doc_id"]]])).alias("_row"),
        F.first("text").alias("text"),
    )
    chosen = kept.join(first, F.col("_text_id") == F.col("text_id"), "left_semi").select(
        *[F.col("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in documents.columns]
    )
    return chosen.unionByName(documents.where("text IS NULL OR text = ''"))
