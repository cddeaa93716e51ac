"""Repeated byte strings by sorted suffixes.

A string of a fixed length is repeated if it starts at two places. Sorting every suffix of a corpus
would move each byte hundreds of times, so suffixes are taken at anchors: of the seeds (short strings)
inside a window of that length the one of least hash, the first of equals, is its anchor. Equal
windows have equal anchors at equal distance. Of a run of windows with one anchor, all hold the same
core (the bytes common to all windows that the anchor could have), and together they span one string.

One level sorts (core, span) digests, the leading tokens of these suffixes (cryptographic ones, 128 bits
together, so that equal digests mean equal bytes): sampled splitters
range-partition them, a bucket is sorted by multikey quicksort and neighbours are compared; groups at
a bucket's ends are settled with those of the buckets beside it. A core that nobody shares has no
repeated window. A span that two share is repeated as a whole. Only spans that share a core but not
the span go to the next level, where the run is cut into shorter runs on a grid around the anchor,
down to single windows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import BASES, CHUNK, byte_batches, mix, powers, prefix_sums, stage, string_bytes, text_key
from tallybrook.session import run_dir


@dataclass(frozen=True)
class Window:
    """Bytes of a repeated string and of the seeds in it; at most 512 windows may share an anchor."""

    length: int
    seed: int

    @property
    def reach(self) -> int:
        """Windows that one anchor can have."""
        return self.length - self.seed + 1


#: The strings of ``remove_repeats``, and those that passages of natural language are made of.
STRINGS = Window(400, 64)
PASSAGES = Window(200, 32)
#: A repeated passage is cut from so many words on, or so many bytes where words are not spaced.
PASSAGE_WORDS, PASSAGE_BYTES = 50, 400
#: The grids of the levels after the first.
WIDTHS = (42, 6, 1)
#: Bytes of text, about, in one bucket of the table of texts; suffixes in one range partition.
BUCKET_BYTES = 64 << 20
PART_ROWS = 1 << 20

#: core, span: fingerprints. owner: 2 * text number + 1 if it stands for several equal ones.
#: place: anchor << 18 | greatest << 9 | least distance from a window's start to the anchor.
#: Rows of owner < 0 are runs known to be repeated: core and span are the first and last start.
ITEMS_DDL = "core long, span long, owner long, place long"
REPEATED, DEEPER, AT_BOUNDARY = 0, 1, 2
FOUND_DDL = f"kind int, {ITEMS_DDL}"
CUT_DDL = "text_id binary, n_removed long, n_spans long, cut_sha256 string, kept_text string, n_passages long, n_passage_bytes long"


def _digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: bytes) -> np.ndarray:
    """64 bits of a digest of every data[start:end]; of another digest for another kind."""
    view, blake = memoryview(data), hashlib.blake2b
    parts = [blake(view[a:b], digest_size=8, person=kind).digest() for a, b in zip(starts.tolist(), ends.tolist())]
    return np.frombuffer(b"".join(parts), np.uint64)


def _runs(data: np.ndarray, rows: np.ndarray, window: Window) -> tuple[np.ndarray, ...]:
    """(row, anchor, first start, last start) of the runs of windows with one anchor.

    A run also ends with a chunk; the parts are then told apart on the next level.
    """
    found, length, seed, reach = [], window.length, window.seed, window.reach
    for at in range(int(rows[0]), int(rows[-1]), CHUNK):
        stop = min(at + CHUNK, int(rows[-1]) - length + 1)
        if stop <= at:
            break
        part = data[at : stop + length - 1]
        # This hash only picks anchors: equal seeds have equal ones, and nothing else hangs on it.
        sums, (_, down) = prefix_sums(part, BASES[0]), powers(BASES[0], len(part))
        seeds = len(part) - seed + 1
        least = mix((sums[seed:] - sums[:seeds]) * down[:seeds])
        bits = np.uint64(CHUNK.bit_length() + 1)
        least = (least >> bits << bits) | np.arange(seeds, dtype=np.uint64)
        width = 1
        while width * 2 <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: stop - at], least[reach - width : reach - width + stop - at])
        anchor = (least & np.uint64((1 << int(bits)) - 1)).astype(np.int64) + at
        start = np.arange(at, stop)
        row = np.searchsorted(rows, start, "right") - 1
        new = np.ones(len(start), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        row, anchor, first, last = row[first], anchor[first], start[first], start[last]
        last = np.minimum(last, rows[row + 1] - length)  # windows end with their text
        whole = last >= first
        found.append((row[whole], anchor[whole], first[whole], last[whole]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found))


def _items(core, span, owner, place) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64)) for x in (core, span, owner, place)],
        names=["core", "span", "owner", "place"],
    )


def _emit(row, number, copies, anchor, first, last, core, span, starts) -> pa.RecordBatch:
    """Items of runs. Equal runs of one text are repeated already: they leave as known runs, joined
    where they touch, and one of them stands for all."""
    order = np.lexsort((span, core, row))
    row, anchor, first, last, core, span, copies = (x[order] for x in (row, anchor, first, last, core, span, copies))
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (core[1:] != core[:-1]) | (span[1:] != span[:-1])
    lead = np.flatnonzero(new)
    size = np.diff(np.append(lead, len(row)))
    several = np.repeat(size > 1, size)
    owner = number[row[lead]] * 2 + ((size > 1) | (copies[lead] > 1))
    a = anchor[lead]
    place = ((a - starts[row[lead]]) << 18) | ((a - first[lead]) << 9) | (a - last[lead])
    known = np.flatnonzero(several)
    known = known[np.lexsort((first[known], row[known]))]
    r, f, t = row[known], first[known], last[known]
    if len(known):
        gap = np.ones(len(known), bool)
        gap[1:] = (r[1:] != r[:-1]) | (f[1:] > t[:-1] + 1)
        head = np.flatnonzero(gap)
        r, f, t = r[head], f[head], np.maximum.reduceat(t, head)
    core, span = core[lead].view(np.int64), span[lead].view(np.int64)
    zero = np.zeros(len(r), np.int64)
    return _items(
        np.concatenate([core, f - starts[r]]), np.concatenate([span, t - starts[r]]),
        np.concatenate([owner, -1 - number[r]]), np.concatenate([place, zero]),
    )


def _first_level(window: Window):
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in byte_batches(batches, "data"):
                data, rows = string_bytes(batch["data"])
                row, anchor, first, last = _runs(data, rows, window)
                core = _digests(data, anchor, anchor + window.seed, b"core")
                span = _digests(data, first, last + window.length, b"span")
                number, copies = batch["text_no"].to_numpy(), batch["copies"].to_numpy()
                yield _emit(row, number, copies[row], anchor, first, last, core, span, rows)

    return expand


def _next_level(window: Window, width: int):
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in byte_batches(batches, "data"):
                data, rows = string_bytes(batch["data"])
                sizes = np.array([len(x) for x in batch["places"]], np.int64)
                row = np.repeat(np.arange(batch.num_rows), sizes)
                place = batch["places"].flatten().to_numpy()
                several = batch["several"].flatten().to_numpy()
                anchor, most, least = place >> 18, (place >> 9) & 511, place & 511
                count = most // width - least // width + 1
                item = np.repeat(np.arange(len(place)), count)
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + (least // width)[item]
                low, high = np.maximum(step * width, least[item]), np.minimum(step * width + width - 1, most[item])
                at = anchor[item] + rows[row[item]]
                core = _digests(data, at - step * width, at - (step * width + width - 1) + window.length, b"core")
                core = mix(core + step.astype(np.uint64))
                span = _digests(data, at - high, at - low + window.length, b"span")
                yield _emit(
                    row[item], batch["text_no"].to_numpy(), several[item] + 1, at, at - high, at - low, core, span, rows
                )

    return expand


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """The order of rows by several keys: three-way quicksort, one key deeper among equals.

    Small parts are left to a library sort by the keys that are still open.
    """
    out, at = np.empty(len(keys[0]), np.int64), 0
    parts = [(np.arange(len(keys[0])), 0)]
    while parts:
        rows, depth = parts.pop()
        if depth == len(keys) or len(rows) <= 4096:
            if depth < len(keys):
                rows = rows[np.lexsort([k[rows] for k in keys[depth:]][::-1])]
            out[at : at + len(rows)] = rows
            at += len(rows)
            continue
        key = keys[depth][rows]
        sample = np.sort(key[:: max(1, len(key) // 63)])
        pivot = sample[len(sample) // 2]
        parts += [(rows[key > pivot], depth), (rows[key == pivot], depth + 1), (rows[key < pivot], depth)]
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort a bucket and compare neighbours; groups of its first and last core are left open."""
    batches = list(batches)
    if not batches:
        return
    core, span, owner, place = (np.concatenate([b[c].to_numpy() for b in batches]) for c in ("core", "span", "owner", "place"))
    out = []

    def add(kind, rows):
        out.append((np.full(len(rows), kind, np.int32), core[rows], span[rows], owner[rows], place[rows]))

    add(REPEATED, np.flatnonzero(owner < 0))
    order = multikey_order([core, span, owner, place])
    order = order[owner[order] >= 0]
    core_, span_ = core[order], span[order]
    if len(order):
        new_core = np.append(True, core_[1:] != core_[:-1])
        new_span = new_core | np.append(True, span_[1:] != span_[:-1])
        span_head, core_head = np.flatnonzero(new_span), np.flatnonzero(new_core)
        weight = np.add.reduceat(1 + (owner[order] & 1), span_head)
        span_of = np.cumsum(new_span) - 1
        core_of_span = np.cumsum(new_core)[span_head] - 1
        first_span = np.searchsorted(core_of_span, np.arange(len(core_head)))
        spans, single = np.bincount(core_of_span), np.minimum.reduceat(weight, first_span) == 1
        open_core = np.zeros(len(core_head), bool)
        open_core[[0, -1]] = True
        is_open = open_core[np.cumsum(new_core) - 1]
        add(AT_BOUNDARY, order[is_open])
        add(REPEATED, order[~is_open & (weight[span_of] > 1)])
        deeper = (~open_core & (spans > 1) & single)[core_of_span]
        heads = order[span_head[deeper]]
        owner[heads] |= (weight[deeper] > 1).astype(np.int64)  # rows added before are copies
        add(DEEPER, heads)
    columns = [np.concatenate(x) for x in zip(*out)]
    for at in range(0, len(columns[0]), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 50_000]) for c in columns], names=[f.split()[0] for f in FOUND_DDL.split(", ")])


def compare_suffixes(items: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """(runs that are repeated, runs to look at more closely) of a level's items.

    The items are written first: sampling the splitters then reads them instead of making them twice.
    """
    splits = stage(items, "suffix-items").repartitionByRange(parts, "core", "span", "owner", "place")
    found = stage(splits.mapInArrow(_compare, FOUND_DDL), "suffix-groups")
    boundary = found.where(F.col("kind") == AT_BOUNDARY)
    spans = boundary.groupBy("core", "span").agg(
        F.sum(1 + F.col("owner").bitwiseAND(1)).alias("weight"), F.min(F.struct("owner", "place")).alias("lead")
    )
    spans = stage(spans, "boundary-spans")
    cores = spans.groupBy("core").agg(F.count(F.lit(1)).alias("spans"), F.min("weight").alias("least"))
    cores = cores.where("spans > 1 AND least = 1").select("core")
    again = boundary.join(spans.where("weight > 1").select("core", "span"), ["core", "span"], "left_semi")
    repeated = found.where(F.col("kind") == REPEATED).select("core", "span", "owner", "place").unionByName(
        again.select("core", "span", "owner", "place")
    )
    # Two cores a bucket at most: a table as small as the number of buckets.
    leads = spans.join(F.broadcast(cores), "core", "left_semi").select(
        (F.shiftright("lead.owner", 1) * 2 + F.greatest((F.col("weight") > 1).cast("long"), F.col("lead.owner").bitwiseAND(1))).alias("owner"),
        F.col("lead.place").alias("place"),
    )
    deeper = found.where(F.col("kind") == DEEPER).select("owner", "place").unionByName(leads)
    known = F.col("owner") < 0
    anchor = F.shiftright("place", 18)
    runs = repeated.select(
        F.when(known, -1 - F.col("owner")).otherwise(F.shiftright("owner", 1)).alias("text_no"),
        F.when(known, F.col("core")).otherwise(anchor - F.shiftright("place", 9).bitwiseAND(511)).alias("first"),
        F.when(known, F.col("span")).otherwise(anchor - F.col("place").bitwiseAND(511)).alias("last"),
    )
    return runs, deeper


def _passage(data: memoryview, first: int, stop: int) -> tuple[int, int] | None:
    """The whole words of a repeated run, as a range; None if it is no passage."""
    inside = bytes(data[first:stop])
    low, high = 0, len(inside)
    if first and data[first - 1] > 32 and inside[:1].strip():
        cut = re.search(rb"\s", inside)
        low = cut.start() if cut else low
    if stop < len(data) and data[stop] > 32 and inside[-1:].strip():
        cut = re.search(rb"\s\S*\Z", inside[-4096:])
        high = high - len(cut.group()) if cut else high
    if high > low and len(inside[low:high].split()) >= PASSAGE_WORDS:
        return first + low, first + high
    return (first, stop) if stop - first >= PASSAGE_BYTES else None


def _merged(runs: list[dict], length: int) -> list[tuple[int, int]]:
    """The maximal ranges of bytes that runs of windows cover."""
    merged = []
    for first, last in sorted((r["first"], r["last"]) for r in runs):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], last + length)
        else:
            merged.append([first, last + length])
    return [(a, b) for a, b in merged]


def _cut(strings: bool):
    """Remove the bytes that repeated strings cover or, without ``strings``, the passages; count the
    passages. ``kept_text`` leaves out the parts of a character that a cut splits."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text_id, data, whole, parts in zip(batch["text_id"], batch["data"], batch["strings"], batch["passages"]):
                data, kept, at = memoryview(data.as_buffer()), [], 0
                passages = [p for p in (_passage(data, *m) for m in _merged(parts.as_py(), PASSAGES.length)) if p]
                gone = _merged(whole.as_py(), STRINGS.length) if strings else passages
                for first, stop in gone:
                    kept.append(bytes(data[at:first]))
                    at = stop
                kept.append(bytes(data[at:]))
                text = "".join(part.decode("utf-8", "ignore") for part in kept)
                size = lambda ranges: sum(b - a for a, b in ranges)
                rows.append((text_id.as_py(), size(gone), len(gone), hashlib.sha256(b"".join(kept)).hexdigest(), text, len(passages), size(passages)))
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in CUT_DDL.split(", ")])

    return cut


def repeated_runs(texts: DataFrame, window: Window, parts: int) -> DataFrame:
    """(text_no, first, last): the starts of the first and last of consecutive windows that are all
    repeated, for texts in a table bucketed by ``text_id``."""
    numbers = texts.select("text_no", "text_id")
    items = texts.where(F.octet_length("data") >= window.length).select("text_no", "copies", "data").mapInArrow(_first_level(window), ITEMS_DDL)
    runs, deeper = compare_suffixes(items, parts)
    for width in WIDTHS:
        places = deeper.groupBy(F.shiftright("owner", 1).alias("text_no")).agg(
            F.collect_list(F.struct("place", F.col("owner").bitwiseAND(1).alias("several"))).alias("wanted")
        )
        wanted = numbers.join(places, "text_no").select("text_id", "wanted.place", "wanted.several")
        asked = texts.join(wanted.hint("shuffle_hash"), "text_id").select(
            "text_no", "data", F.col("place").alias("places"), "several"
        )
        more, deeper = compare_suffixes(asked.mapInArrow(_next_level(window, width), ITEMS_DDL), parts)
        runs = runs.unionByName(more)
    return runs


def cut_repeats(documents: DataFrame, strings: bool = True, passages: bool = True, with_text: bool = False) -> DataFrame:
    """(text_id, n_bytes, n_removed, n_spans, kept_sha256, n_passages, n_passage_bytes) of every distinct
    text, for a join by ``text_key``; ``with_text`` adds what stays as ``kept_text``, null where that is
    the whole text.

    With ``strings`` strings of 400 bytes that start twice go, else the passages do. A passage is what
    repeated strings of 200 bytes cover together, its whole words, if these are ``PASSAGE_WORDS`` or
    their bytes ``PASSAGE_BYTES``; without ``passages`` none is looked for. Equal texts are worked on
    once, and count as repeats of each other. Null texts have no row here; shorter texts have nothing
    to lose. Texts are kept in a table bucketed by their id in the shared folder, so the levels join
    with it without moving texts again; the table goes in the end, whatever happens.
    """
    spark = documents.sparkSession
    data = F.encode("text", "UTF-8")
    sizes = documents.select(F.octet_length("text").cast("long").alias("n")).agg(F.sum("n"), F.count(F.lit(1))).first()
    total, default = sizes[0] or 0, int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(default, total // BUCKET_BYTES + 1)
    texts = documents.where("text IS NOT NULL").groupBy(text_key(F.col("text")).alias("text_id")).agg(
        F.count(F.lit(1)).alias("copies"), F.first(data).alias("data")
    )
    name = f"suffix_texts_{uuid.uuid4().hex}"
    texts = texts.withColumn("text_no", F.monotonically_increasing_id()).withColumn("kept_sha256", F.sha2("data", 256))
    try:
        texts.write.option("compression", "zstd").option("path", run_dir(spark, "suffix-texts")).bucketBy(buckets, "text_id").saveAsTable(name)
        texts = spark.table(name)
        numbers = texts.select("text_no", "text_id")
        wanted = [("strings", STRINGS)] * strings + [("passages", PASSAGES)] * passages
        runs = None
        for kind, window in wanted:
            found = repeated_runs(texts, window, max(default, total // (window.reach // 2) // PART_ROWS + 1)).withColumn("kind", F.lit(kind))
            runs = found if runs is None else runs.unionByName(found)
        of_kind = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.struct("first", "last"))).alias(kind)
        per_text = runs.groupBy("text_no").agg(of_kind("strings"), of_kind("passages"))
        per_text = numbers.join(per_text, "text_no").select("text_id", "strings", "passages")
        cut = texts.join(per_text.hint("shuffle_hash"), "text_id").select("text_id", "data", "strings", "passages").mapInArrow(_cut(strings), CUT_DDL)
        cut = stage(cut.where("n_removed > 0 OR n_passages > 0").drop(*([] if with_text else ["kept_text"])), "cut-texts", "zstd")
        counts, zero = ("n_removed", "n_spans", "n_passages", "n_passage_bytes"), F.lit(0).cast("long")
        whole = texts.select("text_id", F.octet_length("data").cast("long").alias("n_bytes"), "kept_sha256")
        done = whole.join(cut, "text_id", "left").select(
            "text_id", "n_bytes", *[F.coalesce(c, zero).alias(c) for c in counts], F.coalesce("cut_sha256", "kept_sha256").alias("kept_sha256"),
            *([F.when(F.col("n_removed") > 0, F.col("kept_text")).alias("kept_text")] if with_text else []),
        )
        return stage(done, "suffix-results", "zstd")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def remove_repeats(documents: DataFrame, passages: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document.

    A byte goes if a string of 400 bytes that covers it also starts anywhere else, in this or another
    text; all is judged on the input. With ``passages`` there are also n_passages and n_passage_bytes:
    the repeated passages of 50 words and more, which may be shorter than 400 bytes and so stay. A null
    text counts as empty. Repeated rows are copies of each other. Ids may be null or repeated: results
    go by text.
    """
    done = cut_repeats(documents, passages=passages)
    ids = documents.select("doc_id", text_key(F.coalesce(F.col("text"), F.lit(""))).alias("text_id"))
    zero = F.lit(0).cast("long")
    counts = ("n_bytes", "n_removed", "n_spans"), ("n_passages", "n_passage_bytes") if passages else ()
    return ids.join(done, "text_id", "left").select(
        "doc_id", *[F.coalesce(c, zero).alias(c) for c in counts[0]],
        F.coalesce("kept_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("kept_sha256"), *[F.coalesce(c, zero).alias(c) for c in counts[1]],
    )


def without_repeats(documents: DataFrame) -> DataFrame:
    """The documents, all columns, without the passages of 50 words and more that occur twice among
    them; ``n_chars`` follows, if there.

    A passage is what repeated strings of 200 bytes cover together: 50 words, or 400 bytes where words
    are not spaced, are enough. The words are cut whole.
    """
    done = cut_repeats(documents, strings=False, with_text=True).where("kept_text IS NOT NULL")
    cut = done.select(F.col("text_id").alias("_cut_id"), F.col("kept_text").alias("_kept_text"))
    joined = documents.join(cut, text_key(F.col("text")) == F.col("_cut_id"), "left").drop("_cut_id")
    joined = joined.withColumn("text", F.coalesce("_kept_text", "text"))
    if "n_chars" in documents.columns:
        length = F.when(F.col("_kept_text").isNotNull(), F.length("_kept_text")).otherwise(F.col("n_chars"))
        joined = joined.withColumn("n_chars", length.cast(documents.schema["n_chars"].dataType))
    return joined.select(*[F.col(f"`{c}`") for c in documents.columns])
