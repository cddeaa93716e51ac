"""Fill-in-the-middle: every byte of a batch moves by a shift found from difference arrays.

A text is cut into lines; two cuts give prefix, middle and suffix. In the joined bytes of a batch each
part moves as a whole, so the shift changes only where a part starts: those changes are written
into a difference array, its cumulative sum is every byte's shift, and one numpy scatter builds all
outputs. Restoring finds the sentinels in the outputs alone, builds the shifts in the same way and
gathers the bytes back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import CHUNK, byte_batches, string_bytes

PLAIN, PSM, SPM = "plain", "psm", "spm"
OUTPUT_DDL = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Setting:
    """Seed of the draws, share in percent of texts that are transformed, share of these whose suffix
    comes first, and the three sentinels: none is empty, part of another, or can overlap another."""

    seed: int = 7
    rate: int = 100
    spm_rate: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = [m.encode() for m in (self.prefix, self.suffix, self.middle)]
        for i, a in enumerate(marks):
            for j, b in enumerate(marks):
                overlap = any(a.endswith(b[:k]) for k in range(1, len(b)))
                if not a or overlap or (i != j and b in a):
                    raise ValueError("sentinels must not be empty or overlap")

    @property
    def marks(self) -> list[np.ndarray]:
        return [np.frombuffer(m.encode(), np.uint8) for m in (self.prefix, self.suffix, self.middle)]


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four whole numbers below 2**32 from the document's id; a null id is the empty string."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def scatter(source: np.ndarray, out: np.ndarray, starts: np.ndarray, ends: np.ndarray, targets: np.ndarray, gather: bool = False) -> None:
    """Move source[start:end] to out[target:] for ascending, touching parts.

    Works through the bytes in chunks, so that the shifts take a bounded amount of memory however
    long a text is. With ``gather`` the parts ascend in ``out`` and are fetched from ``source``.
    """
    lead = starts if not gather else targets
    full = ends > starts
    starts, ends, targets, lead = starts[full], ends[full], targets[full], lead[full]
    if not len(lead):
        return
    shift = targets - starts if not gather else starts - targets
    change = np.diff(shift, prepend=0)
    begin, stop = int(lead[0]), int(lead[-1] + ends[-1] - starts[-1])
    carry = 0
    for at in range(begin, stop, CHUNK):
        upto = min(at + CHUNK, stop)
        difference = np.zeros(upto - at, np.int64)
        low, high = np.searchsorted(lead, [at, upto])
        difference[lead[low:high] - at] = change[low:high]
        difference[0] += carry
        shifts = np.cumsum(difference)
        carry = int(shifts[-1])
        here = np.arange(at, upto)
        if gather:
            out[at:upto] = source[here + shifts]
        else:
            out[here + shifts] = source[at:upto]


def chars_in(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points of each part of UTF-8 bytes, whose parts ascend; found in chunks."""
    if not len(starts):
        return np.zeros(0, np.int64)
    edges, back = np.unique(np.concatenate([starts, ends]), return_inverse=True)
    upto, total, at = np.zeros(len(edges), np.int64), 0, int(edges[0])
    while at <= int(edges[-1]):
        stop = min(at + CHUNK, int(edges[-1]))
        counts = np.concatenate([[0], np.cumsum((data[at:stop] & 0xC0) != 0x80)])
        low, high = np.searchsorted(edges, at), np.searchsorted(edges, stop, "right")
        upto[low:high] = total + counts[edges[low:high] - at]
        total += int(counts[-1])
        if stop == int(edges[-1]):
            break
        at = stop
    return upto[back[len(starts) :]] - upto[back[: len(starts)]]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    wide = int(offsets[-1]) >= 1 << 31
    kind = pa.large_string() if wide else pa.string()
    at = offsets.astype(np.int64 if wide else np.int32)
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])


def _positions(data: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Where a sentinel stands; its first byte is looked for before the others."""
    last = len(data) - len(mark) + 1
    at = np.flatnonzero(data[: max(0, last)] == mark[0])
    for i in range(1, len(mark)):
        at = at[data[at + i] == mark[i]]
    return at


def build(texts: pa.Array, h: list[np.ndarray], setting: Setting) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(lines, form, whether transformed, prefix_chars, middle_chars, output) of a batch of texts."""
    data, rows = string_bytes(texts)
    data, rows = data[rows[0] : rows[-1]], rows - rows[0]
    size, start, end = np.diff(rows), rows[:-1], rows[1:]
    breaks = np.flatnonzero(data == 10)
    first, after = np.searchsorted(breaks, start), np.searchsorted(breaks, end)
    whole = after - first
    closed = (size > 0) & (data[np.maximum(end, 1) - 1] == 10) if len(data) else np.zeros(len(size), bool)
    n = whole + ((size > 0) & ~closed)
    marked = np.zeros(len(size), bool)
    for mark in setting.marks:
        found = _positions(data, mark)
        row = np.searchsorted(rows, found, "right") - 1
        inside = found + len(mark) <= rows[row + 1]
        marked[row[inside]] = True
    moved = (size > 0) & ~marked & (h[2] % 100 < setting.rate)
    spm = moved & (h[3] % 100 < setting.spm_rate)
    a, b = h[0] % (n + 1), h[1] % (n + 1)

    def place(units: np.ndarray) -> np.ndarray:
        """Byte at which the first ``units`` lines end."""
        if not len(breaks):
            return np.where(units > 0, end, start)
        line_end = breaks[np.minimum(first + np.maximum(units, 1) - 1, len(breaks) - 1)] + 1
        return np.where(units == 0, start, np.where(units <= whole, line_end, end))

    one, two = place(np.minimum(a, b)), place(np.maximum(a, b))
    marks = setting.marks
    p, s, m = (len(x) for x in marks)
    out_rows = np.concatenate([[0], np.cumsum(size + moved * (p + s + m))])
    base = out_rows[:-1]
    prefix, middle, suffix = one - start, two - one, end - two
    to_prefix = base + moved * p + spm * (s + suffix)
    to_suffix = np.where(spm, base + s, base + p + prefix + s)
    to_middle = base + p + s + m + prefix + suffix
    to_middle, to_suffix = np.where(moved, to_middle, base + prefix), np.where(moved, to_suffix, base + prefix + middle)
    out = np.empty(int(out_rows[-1]), np.uint8)
    parts = lambda x, y, z: np.stack([x, y, z], 1).reshape(-1)
    scatter(data, out, parts(start, one, two), parts(one, two, end), parts(to_prefix, to_middle, to_suffix))
    for mark, at in zip(marks, (to_prefix - p, to_suffix - s, to_middle - m)):
        at = at[moved]
        for i, byte in enumerate(mark):
            out[at + i] = byte
    form = [SPM if x else PSM if y else PLAIN for x, y in zip(spm.tolist(), moved.tolist())]
    return n, form, moved, chars_in(data, start, one), chars_in(data, one, two), _strings(out, out_rows)


def restore(outputs: pa.Array, forms: list[str], setting: Setting) -> pa.Array:
    """The texts that outputs were made of, found by the sentinels in them."""
    data, rows = string_bytes(outputs)
    data, rows = data[rows[0] : rows[-1]], rows - rows[0]
    start, end = rows[:-1], rows[1:]
    form = np.array(forms, object)
    moved, spm = form != PLAIN, form == SPM
    marks = setting.marks
    p, s, m = (len(x) for x in marks)
    at = []
    for mark in marks:
        found = _positions(data, mark)
        row = np.searchsorted(rows, found, "right") - 1
        found, row = found[moved[row]], row[moved[row]]
        place = start.copy()
        place[row] = found
        at.append(place)
    at_p, at_s, at_m = at
    prefix = (np.where(moved, at_p + p, start), np.where(spm, at_m, np.where(moved, at_s, end)))
    suffix = (np.where(moved, at_s + s, end), np.where(spm, at_p, np.where(moved, at_m, end)))
    middle = (np.where(moved, at_m + m, end), end)
    sizes = [y - x for x, y in (prefix, middle, suffix)]
    out_rows = np.concatenate([[0], np.cumsum(sum(sizes))])
    base = out_rows[:-1]
    targets = (base, base + sizes[0], base + sizes[0] + sizes[1])
    parts = lambda three: np.stack(three, 1).reshape(-1)
    out = np.empty(int(out_rows[-1]), np.uint8)
    scatter(
        data, out, parts([x for x, _ in (prefix, middle, suffix)]), parts([y for _, y in (prefix, middle, suffix)]), parts(targets), gather=True
    )
    return _strings(out, out_rows)


def transform(documents: DataFrame, setting: Setting = Setting()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document.

    ``n`` lines, whole texts; a null text counts as empty. Form ``plain`` leaves the text as it is: an
    empty one, one that holds a sentinel, or one that the rate leaves out; its part lengths are
    null. A null id draws as an empty one, and repeated ids draw alike. Rows stay where they are:
    nothing is shuffled, and a text of any length is moved in chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "text"):
            h = [batch[c].to_numpy() for c in ("h1", "h2", "h3", "h4")]
            n, form, moved, prefix, middle, output = build(batch["text"], h, setting)
            lengths = [pa.array(x, pa.int64(), mask=~moved) for x in (prefix, middle)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(form, pa.string()), *lengths, output],
                names=[c.split()[0] for c in OUTPUT_DDL.split(", ")],
            )

    drawn = [h.alias(f"h{i + 1}") for i, h in enumerate(draws(F.col("doc_id"), setting.seed))]
    columns = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *drawn)
    return columns.mapInArrow(run, OUTPUT_DDL)


def restored(outputs: DataFrame, setting: Setting = Setting()) -> DataFrame:
    """The rows with ``text``, rebuilt from ``output`` and ``form`` alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "output"):
            text = restore(batch["output"], batch["form"].to_pylist(), setting)
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, "text"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema)
    return outputs.mapInArrow(run, f"{ddl}, text string")
