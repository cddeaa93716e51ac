"""Bronze, silver, gold, ad-hoc."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions.metrics import engagement, zero_if_null
from tallybrook.functions.text import clean_text, has_text
from tallybrook.functions.time import epoch_date, epoch_ts, hours_between
from tallybrook.operators.trends import (
    change_from_previous,
    daily,
    previous,
    rank_within,
    rolling_sum,
    rolling_sum_of_days,
)
from tallybrook.plans import models
from tallybrook.registry import sql
from tallybrook.registry.base import query
from tallybrook.registry.derived import questions_raw
from tallybrook.session import run_dir


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.silver(questions_raw(spark, sf_dir))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(_silver(spark, sf_dir))


@query("bronze_scan", sql.on_raw("SELECT * FROM raw"))
def bronze_scan(spark, sf_dir):
    models.bronze(questions_raw(spark, sf_dir), view="bronze_questions")
    return spark.table("bronze_questions")


@query("silver_dedup", sql.on_dedup(f"SELECT {sql.RECORD} FROM ranked WHERE rn = 1 AND question_id IS NOT NULL"))
def silver_dedup(spark, sf_dir):
    return models.latest_versions(questions_raw(spark, sf_dir), wide=True).filter("question_id is not null")


@query("silver_filter", sql.on_usable(f"SELECT {sql.RECORD} FROM usable"))
def silver_filter(spark, sf_dir):
    return models.usable_latest(questions_raw(spark, sf_dir), wide=True)


@query(
    "clean_title",
    sql.on_raw(
        f"SELECT link, {sql.CLEAN_TITLE} AS title_clean, coalesce({sql.HAS_TEXT}, false) AS has_text FROM raw"
    ),
)
def clean_title(spark, sf_dir):
    title = F.col("title")
    return questions_raw(spark, sf_dir).select(
        "link", clean_text(title).alias("title_clean"), has_text(title).alias("has_text")
    )


@query(
    "epoch_to_ts",
    sql.on_raw(
        f"SELECT link, {sql.ts('creation_date')} AS created_ts, {sql.ts('last_activity_date')} AS last_activity_ts FROM raw"
    ),
)
def epoch_to_ts(spark, sf_dir):
    return questions_raw(spark, sf_dir).select(
        "link",
        epoch_ts(F.col("creation_date")).alias("created_ts"),
        epoch_ts(F.col("last_activity_date")).alias("last_activity_ts"),
    )


@query(
    "epoch_to_date",
    sql.on_raw(
        f"SELECT link, CAST({sql.ts('creation_date')} AS DATE) AS created_date, "
        f"CAST({sql.ts('raw.last_activity_date')} AS DATE) AS last_activity_day FROM raw"
    ),
)
def epoch_to_date(spark, sf_dir):
    return questions_raw(spark, sf_dir).select(
        "link",
        epoch_date(F.col("creation_date")).alias("created_date"),
        epoch_date(F.col("last_activity_date")).alias("last_activity_day"),
    )


@query(
    "closed_fields",
    sql.on_raw(
        f"SELECT link, {sql.ts('raw.closed_date')} AS closed_ts, CAST({sql.ts('raw.closed_date')} AS DATE) AS closed_day FROM raw"
    ),
)
def closed_fields(spark, sf_dir):
    return questions_raw(spark, sf_dir).select(
        "link",
        epoch_ts(F.col("closed_date")).alias("closed_ts"),
        epoch_date(F.col("closed_date")).alias("closed_day"),
    )


@query("is_closed", sql.on_raw("SELECT link, closed_date IS NOT NULL AS is_closed FROM raw"))
def is_closed(spark, sf_dir):
    return questions_raw(spark, sf_dir).select("link", F.col("closed_date").isNotNull().alias("is_closed"))


@query(
    "fill_counts",
    sql.on_raw(
        "SELECT link, coalesce(score, 0) AS score_filled, coalesce(answer_count, 0) AS answer_count_filled, "
        "coalesce(view_count, 0) AS view_count_filled FROM raw"
    ),
)
def fill_counts(spark, sf_dir):
    return questions_raw(spark, sf_dir).select(
        "link",
        *[zero_if_null(F.col(c)).alias(f"{c}_filled") for c in ("score", "answer_count", "view_count")],
    )


@query("sentiment_bucket", sql.on_raw(f"SELECT link, {sql.ENGAGEMENT} AS sentiment FROM raw"))
def sentiment_bucket(spark, sf_dir):
    label = engagement(F.col("view_count"), F.col("answer_count"), F.col("score"))
    return questions_raw(spark, sf_dir).select("link", label.alias("sentiment"))


@query(
    "hours_to_close",
    sql.on_raw(
        f"SELECT link, date_sub('hour', {sql.ts('creation_date')}, {sql.ts('closed_date')}) AS hours_to_close FROM raw"
    ),
)
def hours_to_close(spark, sf_dir):
    hours = hours_between(F.col("creation_date"), F.col("closed_date"))
    return questions_raw(spark, sf_dir).select("link", hours.alias("hours_to_close"))


@query("silver", sql.on_silver("SELECT * FROM silver"))
def silver(spark, sf_dir):
    return models.silver(questions_raw(spark, sf_dir), wide=True)


@query("write_silver", sql.on_silver("SELECT * FROM silver"))
def write_silver(spark, sf_dir):
    path, frame = run_dir(spark, "silver"), models.silver(questions_raw(spark, sf_dir), wide=True)
    models.write_silver(frame, path)
    return models.read_model(spark, path, frame.schema)


@query("daily_counts", sql.on_daily("SELECT report_date, sentiment, post_count FROM daily"))
def daily_counts(spark, sf_dir):
    return _daily(spark, sf_dir).select("report_date", "sentiment", "post_count")


@query(
    "daily_averages",
    sql.on_daily("SELECT report_date, sentiment, avg_score, avg_views, avg_answers FROM daily"),
)
def daily_averages(spark, sf_dir):
    return _daily(spark, sf_dir).select("report_date", "sentiment", "avg_score", "avg_views", "avg_answers")


@query("daily_rates", sql.on_daily("SELECT report_date, sentiment, answered_rate, closed_rate FROM daily"))
def daily_rates(spark, sf_dir):
    return _daily(spark, sf_dir).select("report_date", "sentiment", "answered_rate", "closed_rate")


@query("daily_time_to_close", sql.on_daily("SELECT report_date, sentiment, avg_hours_to_close FROM daily"))
def daily_time_to_close(spark, sf_dir):
    return _daily(spark, sf_dir).select("report_date", "sentiment", "avg_hours_to_close")


def _counts(spark, sf_dir):
    return daily_counts(spark, sf_dir)


@query(
    "rolling_7d",
    sql.on_gold("SELECT report_date, sentiment, post_count, rolling_7d_post_count FROM gold"),
)
def rolling_7d(spark, sf_dir):
    return rolling_sum(
        _counts(spark, sf_dir), "post_count", ["sentiment"], "report_date", "rolling_7d_post_count"
    )


@query(
    "rolling_7d_calendar",
    sql.on_daily(
        """SELECT report_date, sentiment, post_count, CAST(sum(post_count) OVER (PARTITION BY sentiment ORDER BY report_date
             RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_7d_calendar_post_count
           FROM daily WHERE dayofyear(report_date) % 4 <> 2"""
    ),
)
def rolling_7d_calendar(spark, sf_dir):
    """Optional extension: seven days, not rows; every fourth day is left out, so that the two differ."""
    some_days = _counts(spark, sf_dir).filter(F.dayofyear("report_date") % 4 != 2)
    return rolling_sum_of_days(some_days, "post_count", ["sentiment"], "report_date", "rolling_7d_calendar_post_count")


@query("prev_day", sql.on_gold("SELECT report_date, sentiment, post_count, prev_post_count FROM windowed"))
def prev_day(spark, sf_dir):
    return previous(_counts(spark, sf_dir), "post_count", ["sentiment"], "report_date", "prev_post_count")


@query(
    "day_over_day",
    sql.on_gold("SELECT report_date, sentiment, post_count, day_over_day_change_pct FROM gold"),
)
def day_over_day(spark, sf_dir):
    return change_from_previous(
        _counts(spark, sf_dir), "post_count", ["sentiment"], "report_date", "day_over_day_change_pct"
    )


@query("gold", sql.on_gold("SELECT * FROM gold"))
def gold(spark, sf_dir):
    return models.gold(_silver(spark, sf_dir))


@query("write_gold", sql.on_gold("SELECT * FROM gold"))
def write_gold(spark, sf_dir):
    path, frame = run_dir(spark, "gold"), gold(spark, sf_dir)
    models.write_gold(frame, path)
    return models.read_model(spark, path, frame.schema)


@query("total_rows", sql.on_raw("SELECT count(*) AS total_rows FROM raw"))
def total_rows(spark, sf_dir):
    return models.total_rows(questions_raw(spark, sf_dir))


@query(
    "latest_records",
    sql.on_raw(
        "SELECT question_id, title, creation_date FROM raw "
        "ORDER BY creation_date DESC NULLS LAST, question_id DESC NULLS LAST, link DESC LIMIT 10"
    ),
)
def latest_records(spark, sf_dir):
    return models.latest_records(questions_raw(spark, sf_dir))


@query(
    "hourly_trend",
    sql.on_usable(
        f"SELECT {sql.ts('creation_date - creation_date % 3600')} AS report_hour, {sql.ENGAGEMENT} AS sentiment, "
        "count(*) AS post_count FROM usable GROUP BY ALL"
    ),
)
def hourly_trend(spark, sf_dir):
    return models.hourly(questions_raw(spark, sf_dir))


@query("sentiment_counts", sql.on_silver("SELECT sentiment, count(*) AS post_count FROM silver GROUP BY 1"))
def sentiment_counts(spark, sf_dir):
    return _silver(spark, sf_dir).groupBy("sentiment").agg(F.count("*").alias("post_count"))


@query(
    "sentiment_rank",
    sql.on_daily(
        "SELECT report_date, sentiment, post_count, "
        "CAST(rank() OVER w AS INTEGER) AS rank, CAST(dense_rank() OVER w AS INTEGER) AS dense_rank "
        "FROM daily WINDOW w AS (PARTITION BY report_date ORDER BY post_count DESC)"
    ),
)
def sentiment_rank(spark, sf_dir):
    return rank_within(_counts(spark, sf_dir), "post_count", ["report_date"])
