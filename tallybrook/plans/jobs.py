"""Whole runs: pages to lake, table to models, models to quality results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook import fixed_values as fv
from tallybrook.operators import contract, quality
from tallybrook.operators.load import read_table
from tallybrook.operators.paging import paged_top_n
from tallybrook.plans import models, suites
from tallybrook.sources import lake
from tallybrook.sources.items import (
    item_field,
    item_tags,
    items_of,
    malformed_pages,
    normalize_items,
    read_pages,
)


@dataclass(frozen=True)
class PageRequest:
    """Which items of the landed pages to take. No tag means any; no total and no ``max_pages`` mean
    all from ``start_page`` on."""

    tag: str | None = None
    page_size: int = fv.DEFAULT_PAGE_SIZE
    total: int | None = None
    start_page: int = 1
    max_pages: int | None = None


def requested_items(items: DataFrame, request: PageRequest) -> DataFrame:
    """Items of one tag, newest first, cut to the requested pages."""
    if request.tag is not None:
        items = items.filter(F.array_contains(item_tags(), request.tag))
    if request.total is None and request.max_pages is None and request.start_page == 1:
        return items
    keyed = items.select(
        "item",
        item_field("creation_date", "bigint").alias("_created"),
        item_field("question_id", "bigint").alias("_id"),
        item_field("link", "string").alias("_link"),
    )
    max_pages = fv.DEFAULT_MAX_PAGES if request.max_pages is None and request.total is not None else request.max_pages
    taken = paged_top_n(
        keyed, "_created", request.page_size, request.total, request.start_page,
        max_pages, tiebreak=("_id", "_link"),
    )
    return taken.select("item")


def ingest_pages(
    spark: SparkSession,
    pages: str,
    lake_dir: str,
    source: str,
    request: PageRequest = PageRequest(),
    run: str | None = None,
    add_bad_record: bool = False,
    multi_line: bool = False,
) -> dict[tuple[str, str | None], int]:
    """Read landed pages, check every record, write good ones to the lake and the rest, unreadable
    pages among them, to dead letters. Returns the number of rows per route and reason.

    The rows are written under a run name that follows from pages, source and tag: a rerun replaces
    its own rows, another source adds to the lake. A ``run`` of one's own is refused if it stands for
    another origin already.
    """
    origin = "\n".join((source, pages, request.tag or ""))
    run = lake.run_of(origin) if run is None else run
    lake.claim_run(spark, lake_dir, run, origin)
    landed = read_pages(spark, pages, multi_line).persist(StorageLevel.MEMORY_AND_DISK)
    records = normalize_items(requested_items(items_of(landed), request))
    if add_bad_record:
        records = contract.with_bad_record(records)
    routed = contract.with_route(contract.check_contract(records))
    routed = routed.withColumn("original", F.when(F.col("route") == "dead_letter", F.col("original")))
    placed = lake.with_hour_partitions(lake.with_event_time(routed))
    kept = lake.spread_by_hour(placed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = {(r.route, r.reason): r.n_records for r in contract.route_counts(kept).collect()}
        good = kept.filter("route = 'ok'")
        lake.write_raw(good, f"{lake_dir}/raw", run)
        lake.write_processed(good, f"{lake_dir}/processed", run)
        letters = contract.to_dead_letter(
            kept.filter("route = 'dead_letter'"), F.col("reason"), F.col("error"), source, request.tag or ""
        )
        broken = malformed_pages(landed, source, request.tag or "")
        if n_broken := broken.count():
            counts[("dead_letter", fv.PAGE_MALFORMED)] = n_broken
        lake.write_dead_letters(letters.unionByName(broken), f"{lake_dir}/dead_letters", run)
    finally:
        kept.unpersist()
        landed.unpersist()
    return counts


def build_models(
    spark: SparkSession, table: str, silver_path: str, gold_path: str, view: str = "bronze_questions"
) -> None:
    """Rebuild silver from the loaded table, then gold from the written silver. Each is replaced when
    its rebuild is complete; the version before stays for readers that are still at it."""
    silver = models.silver(models.bronze(read_table(spark, table), view), wide=True)
    models.write_silver(silver, silver_path, keep=1)
    written = models.read_model(spark, silver_path, silver.schema)
    models.write_gold(models.gold(written), gold_path, keep=1)


def validate_models(
    spark: SparkSession, table: str, silver_path: str, results_path: str, max_rows: int = fv.ROW_COUNT_MAX
) -> dict[str, bool]:
    """Run the four suites on the loaded table and the written silver, keep the results, and say
    which suites passed. ``max_rows`` is the row count that the suites accept at most."""
    bronze = models.bronze(read_table(spark, table))
    results = quality.run_suites(bronze, suites.with_max_rows(suites.BRONZE_SUITES, max_rows)).unionByName(
        quality.run_suites(models.read_model(spark, silver_path), suites.with_max_rows(suites.SILVER_SUITES, max_rows))
    )
    stamp = quality.write_results(results, results_path)
    kept = spark.read.schema(quality.RESULT_DDL).json(results_path).filter(F.col("run_stamp") == stamp)
    return {r.suite: r.success for r in quality.suite_success(kept).collect()}
