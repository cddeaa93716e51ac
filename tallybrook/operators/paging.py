"""Ordered paging: the rows of pages k, k+1, ... up to a total."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook import fixed_values as fv
from tallybrook.session import shared_dir

#: Rows within which a page's keys may go through one task; an order key and a hash each.
TOP_KEYS = 10_000
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row number in the low 33 bits


def paged_top_n(
    df: DataFrame,
    order_col: str,
    page_size: int = fv.DEFAULT_PAGE_SIZE,
    total: int | None = None,
    start_page: int = 1,
    max_pages: int | None = fv.DEFAULT_MAX_PAGES,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Newest first, in that order, from the 1-based ``start_page`` on, cut at ``total`` rows and
    ``max_pages`` pages; None for either means no cut by it. Nulls come last.

    Only order keys and a hash of the row are ranked; the keys of the page's first and last row then
    filter the rows themselves, and what is left, the page, is sorted. For a page that ends within the
    first ``TOP_KEYS`` rows Spark keeps the best keys of every task; for a deeper or larger one all keys
    are sorted, over all tasks, and written to the shared folder. The bounds are worked out when the
    frame is made.
    """
    if total is not None and total <= 0:
        return df.limit(0)
    if page_size <= 0:
        raise ValueError("page_size must be > 0")
    limits = [n for n in (total, None if max_pages is None else page_size * max_pages) if n is not None]
    take, skip = min(limits, default=None), (start_page - 1) * page_size
    if take is not None and take <= 0:
        return df.limit(0)
    key = F.struct(*[F.col(c) for c in (order_col, *tiebreak)], _row_hash(df).alias("_hash"))
    keyed = df.withColumn("_key", key)
    if take is None and skip == 0:
        return keyed.orderBy(F.desc("_key")).drop("_key")
    keys = df.select(key.alias("_key"))
    few = take is not None and skip + take <= TOP_KEYS
    bounds = _top_bounds(keys, skip, take) if few else _bounds(keys, skip, take)
    if bounds is None:
        return df.limit(0)
    (first, n_first), (last, n_last) = bounds
    # Rows equal in key and hash are alike: any of them will do, but not more of them than the page has.
    parts = [keyed.filter((F.col("_key") <= first) & (F.col("_key") >= last))]
    if n_first is not None:
        parts = [keyed.filter((F.col("_key") < first) & (F.col("_key") > last)), keyed.filter(F.col("_key") == first).limit(n_first)]
        if n_last:
            parts.append(keyed.filter(F.col("_key") == last).limit(n_last))
    return reduce(DataFrame.unionAll, parts).orderBy(F.desc("_key")).drop("_key")


def _row_hash(df: DataFrame) -> Column:
    def hashable(field: T.StructField) -> Column:
        name = F.col(f"`{field.name}`")
        return F.to_json(name) if isinstance(field.dataType, T.VariantType) else name

    return F.xxhash64(*[hashable(f) for f in df.schema if not isinstance(f.dataType, T.MapType)])


Bounds = tuple[tuple[Column, int | None], tuple[Column, int]]


def _literal(keys: DataFrame, row) -> Column:
    kind = keys.schema["_key"].dataType
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields])


def _top_bounds(keys: DataFrame, skip: int, take: int) -> Bounds | None:
    """As ``_bounds``, from the first keys in order; one more than needed tells whether a tie is cut."""
    top = [r["_key"] for r in keys.orderBy(F.desc("_key")).limit(skip + take + 1).collect()]
    page = top[skip : skip + take]
    if not page:
        return None
    first, last = page[0], page[-1]
    cut_before = skip > 0 and top[skip - 1] == first
    cut_after = len(top) > skip + take and top[skip + take] == last
    counts = (page.count(first), 0 if first == last else page.count(last)) if cut_before or cut_after else (None, 0)
    return (_literal(keys, first), counts[0]), (_literal(keys, last), counts[1])


def _bounds(keys: DataFrame, skip: int, take: int | None) -> Bounds | None:
    """(key, rows with it on the page) of the first and the last row of the page, as literals; the
    second count is 0 if both are one key, the first is None if the page holds all rows of both. None
    if the page is empty.

    Struct order is that of its fields, nulls least, so descending is newest first, nulls last. The
    sorted keys are checkpointed so that positions stay put; a key's rank is its position plus the rows
    in earlier partitions, one number for each.
    """
    shared_dir(keys.sparkSession)  # names a checkpoint folder when the session has none
    placed = keys.orderBy(F.desc("_key")).checkpoint()
    position = F.monotonically_increasing_id()
    placed = placed.select(
        "_key", F.shiftright(position, _ROW_BITS).alias("_part"), position.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row")
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    )
    ranked = placed.join(F.broadcast(starts), "_part").select("_key", (F.col("_start") + F.col("_row")).alias("_rank"))
    on_page = F.col("_rank") >= skip
    if take is not None:
        on_page = on_page & (F.col("_rank") < skip + take)
    ends = ranked.filter(on_page).agg(F.max("_key").alias("first"), F.min("_key").alias("last")).first()
    if ends["first"] is None:
        return None
    first, last = _literal(keys, ends["first"]), _literal(keys, ends["last"])
    is_first, is_last = F.col("_key") == first, F.col("_key") == last
    held = ranked.filter(is_first | is_last).agg(
        F.count_if(is_first & on_page).alias("first"), F.count_if(is_last & on_page).alias("last"), F.count_if(~on_page).alias("cut")
    ).first()
    return (first, held["first"] if held["cut"] else None), (last, 0 if ends["first"] == ends["last"] else held["last"])
