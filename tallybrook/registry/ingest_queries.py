"""Item pages, envelopes, contract and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.operators import contract as c
from tallybrook.operators.paging import paged_top_n
from tallybrook.registry import sql
from tallybrook.registry.base import query
from tallybrook.registry.derived import envelopes, items_json, land_item_pages, table
from tallybrook.schemas import RECORD_COLUMNS
from tallybrook.session import run_dir
from tallybrook.sources import envelopes as env
from tallybrook.sources.items import (
    item_field,
    item_tags,
    normalize_items,
    parse_items,
    read_item_pages,
    read_pages,
)

TAG, SOURCE = "purchase", "questions-topic"


@query(
    "scan_items",
    sql.on_versions(
        "SELECT question_id, title, link, creation_date, owner_user_id, event_type AS tags FROM versions"
    ),
)
def scan_items(spark, sf_dir):
    return read_item_pages(spark, land_item_pages(spark, sf_dir)).select(
        item_field("question_id", "bigint").alias("question_id"),
        item_field("title", "string").alias("title"),
        item_field("link", "string").alias("link"),
        item_field("creation_date", "bigint").alias("creation_date"),
        item_field("owner.user_id", "bigint").alias("owner_user_id"),
        F.array_join(item_tags(), ",").alias("tags"),
    )


@query(
    "malformed_pages",
    """SELECT CASE event_id % 5 WHEN 1 THEN 'page:not_json' WHEN 2 THEN 'items:not_a_list'
         WHEN 4 THEN 'page:not_an_object' END AS page_issue,
         count(*) AS n_pages, count(*) FILTER (WHERE event_id % 5 = 0) AS n_items FROM events GROUP BY 1""",
)
def malformed_pages(spark, sf_dir):
    """A page for each event: sound, cut off, without a list, without items, or no object."""
    path = run_dir(spark, "broken-pages")
    table(spark, sf_dir, "events").selectExpr(
        """CASE event_id % 5 WHEN 0 THEN concat('{"items":[{"question_id":', event_id, '}]}') WHEN 1 THEN '{"items": ['
           WHEN 2 THEN '{"items":"oops"}' WHEN 3 THEN '{"other":1}' ELSE '[1]' END AS value"""
    ).write.text(path)
    return read_pages(spark, path).groupBy("page_issue").agg(
        F.count("*").alias("n_pages"), F.sum(F.coalesce(F.array_size("items"), F.lit(0))).alias("n_items")
    )


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_items(items_json(spark, sf_dir).drop("event_id"), "item_json")


@query(
    "paged_top_n",
    sql.on_versions(
        "SELECT creation_date, question_id, link FROM versions WHERE event_type = 'purchase' "
        "ORDER BY creation_date DESC NULLS LAST, question_id DESC NULLS LAST, link DESC LIMIT 120 OFFSET 50"
    ),
)
def paged(spark, sf_dir):
    tagged = (
        _items(spark, sf_dir)
        .filter(F.array_contains(item_tags(), TAG))
        .select(
            item_field("creation_date", "bigint").alias("creation_date"),
            item_field("question_id", "bigint").alias("question_id"),
            item_field("link", "string").alias("link"),
        )
    )
    return paged_top_n(
        tagged, "creation_date", page_size=50, total=120, start_page=2, tiebreak=("question_id", "link")
    )


@query(
    "paged_deep",
    sql.on_versions(
        "SELECT creation_date, question_id, link FROM versions "
        "ORDER BY creation_date DESC NULLS LAST, question_id DESC NULLS LAST, link DESC LIMIT 1000 OFFSET 400"
    ),
)
def paged_deep(spark, sf_dir):
    """Pages 3 to 7 of 200 over every item, no total."""
    every = _items(spark, sf_dir).select(
        item_field("creation_date", "bigint").alias("creation_date"),
        item_field("question_id", "bigint").alias("question_id"),
        item_field("link", "string").alias("link"),
    )
    return paged_top_n(every, "creation_date", page_size=200, start_page=3, max_pages=5, tiebreak=("question_id", "link"))


@query("normalize_items", sql.on_records(f"SELECT {sql.RECORD}, issues FROM records"))
def normalized(spark, sf_dir):
    return normalize_items(_items(spark, sf_dir)).select(
        *RECORD_COLUMNS, F.array_join("normalize_issues", "; ").alias("issues")
    )


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.check_contract(normalize_items(_items(spark, sf_dir)))


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = c.with_bad_record(normalize_items(_items(spark, sf_dir)))
    return c.with_route(c.check_contract(records))


@query("contract_check", sql.on_records("SELECT link, missing AS violations FROM records"))
def contract_check(spark, sf_dir):
    return _checked(spark, sf_dir).select("link", F.array_join("violations", "; ").alias("violations"))


@query(
    "dead_letter_split",
    sql.on_records("SELECT link, CASE WHEN missing = '' THEN 'valid' ELSE 'dead' END AS side FROM records"),
)
def dead_letter_split(spark, sf_dir):
    routed = c.with_route(_checked(spark, sf_dir))
    return routed.select("link", F.when(F.col("route") == "ok", "valid").otherwise("dead").alias("side"))


@query(
    "dead_letter_payload",
    sql.on_records(
        f"""SELECT '{{"reason":"normalize_failed","error":' || to_json(missing) || ',"record":'
            || {sql.json_object(nulls=True)} || '}}' AS payload,
          'normalize_failed' AS reason, '{SOURCE}' AS source_topic, '{TAG}' AS stack_tag
        FROM records WHERE missing <> ''"""
    ),
)
def dead_letter_payload(spark, sf_dir):
    routed = c.with_route(_checked(spark, sf_dir)).filter("route = 'dead_letter'")
    letters = c.to_dead_letter(routed, F.col("reason"), F.col("error"), SOURCE, TAG)
    attributes = [F.col("attributes")[name].alias(name) for name in ("reason", "source_topic", "stack_tag")]
    return letters.select("payload", *attributes)


_ERRORS = (
    "Schema VALIDATION error", "400 INVALID_BINARY_AVRO_MESSAGE", "message failed schema check",
    "504 deadline exceeded", "schema not found",
)
_STAGES = (c.ENCODE, c.PUBLISH, c.NORMALIZE, c.MANUAL)


def _by_residue(value: str, texts: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{text}'" for i, text in enumerate(texts))
    return f"CASE {value} {cases} END"


@query(
    "dead_letter_reason",
    f"""SELECT event_id, CASE stage
          WHEN 'manual' THEN 'manual_bad_message' WHEN 'normalize' THEN 'normalize_failed'
          WHEN 'encode' THEN 'avro_encode_failed'
          WHEN 'publish' THEN CASE WHEN error ILIKE '%schema%' AND error ILIKE '%validation%'
              OR error ILIKE '%invalid_binary_avro_message%' OR error ILIKE '%failed schema%'
            THEN 'publish_schema_rejected' ELSE 'publish_failed' END END AS reason
        FROM (SELECT event_id, {_by_residue('user_id % 4', _STAGES)} AS stage,
                {_by_residue('event_id % 6', _ERRORS)} AS error FROM events)""",
)
def dead_letter_reason(spark, sf_dir):
    failures = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"{_by_residue('user_id % 4', _STAGES)} as stage",
        f"{_by_residue('event_id % 6', _ERRORS)} as error",
    )
    return failures.select("event_id", c.classify_reason(F.col("stage"), F.col("error")).alias("reason"))


_ROUTED_SQL = """SELECT CASE WHEN missing = '' THEN 'ok' ELSE 'dead_letter' END AS route,
    CASE WHEN missing <> '' THEN 'normalize_failed' END AS reason, false AS injected FROM records
  UNION ALL SELECT 'dead_letter', 'manual_bad_message', true"""


@query(
    "route_counts",
    sql.on_records(f"SELECT route, reason, count(*) AS n_records FROM ({_ROUTED_SQL}) GROUP BY ALL"),
)
def route_counts(spark, sf_dir):
    return c.route_counts(_routed(spark, sf_dir))


@query(
    "inject_bad_record",
    sql.on_records(f"SELECT injected, route, count(*) AS n_records FROM ({_ROUTED_SQL}) GROUP BY ALL"),
)
def inject_bad_record(spark, sf_dir):
    return _routed(spark, sf_dir).groupBy("injected", "route").agg(F.count("*").alias("n_records"))


@query(
    "parse_envelope",
    sql.on_messages(
        """SELECT event_id, NOT junk AS has_message, CASE WHEN NOT junk THEN given_id END AS raw_message_id,
             NOT junk AND data <> '' AS has_data, sha256(payload) AS payload_hash,
             length(payload) AS payload_length
           FROM (SELECT *, CASE WHEN junk OR data = '*bad' THEN NULL WHEN data = '' THEN ''
                   ELSE record_json END AS payload FROM messages)"""
    ),
)
def parse_envelope(spark, sf_dir):
    return env.parse_envelope(envelopes(spark, sf_dir)).select(
        "event_id", "has_message", "raw_message_id", "has_data",
        F.sha2("payload", 256).alias("payload_hash"),
        F.length("payload").cast("bigint").alias("payload_length"),
    )


@query(
    "wrong_typed_texts",
    """SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN 't' END AS title, CASE WHEN event_id % 4 <> 1 THEN 'l' END AS link,
         CASE event_id % 4 WHEN 0 THEN 'title:wrong_type' WHEN 1 THEN 'link:wrong_type'
           WHEN 2 THEN 'content_license:wrong_type' ELSE '' END AS type_issues FROM events""",
)
def wrong_typed_texts(spark, sf_dir):
    """Records whose text fields hold a number, a boolean or an object."""
    payloads = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """concat('{"question_id":', event_id, ',"title":', if(event_id % 4 = 0, '7', '"t"'), ',"link":',
             if(event_id % 4 = 1, 'true', '"l"'), ',"content_license":', if(event_id % 4 = 2, '{"a":1}', 'null'), '}') AS payload""",
    )
    return env.parse_records(payloads).select("event_id", "title", "link", F.array_join("type_issues", "; ").alias("type_issues"))


@query("message_id", sql.on_messages("SELECT event_id, message_id FROM identified"))
def message_id(spark, sf_dir):
    parsed = env.parse_envelope(envelopes(spark, sf_dir))
    return env.with_message_id(parsed).select("event_id", "message_id")


@query(
    "delivery_outcome",
    sql.on_messages("SELECT outcome, count(*) AS n_messages FROM messages GROUP BY 1"),
)
def delivery_outcome(spark, sf_dir):
    return env.outcome_counts(env.decode_messages(envelopes(spark, sf_dir)))


@query(
    "message_dedup",
    sql.on_messages(f"SELECT DISTINCT message_id, {sql.RECORD} FROM identified WHERE outcome = 'stored'"),
)
def message_dedup(spark, sf_dir):
    return env.stored_once(envelopes(spark, sf_dir)).select("message_id", *RECORD_COLUMNS)


