"""Items, envelopes, contract, dead letters."""

import base64
import json

from pyspark.sql import functions as F

from tallybrook.operators import contract as c
from tallybrook.registry import QUERIES
from tallybrook.schemas import RECORD_COLUMNS, RECORD_DDL
from tallybrook.sources import envelopes as env
from tallybrook.sources.items import item_tags, normalize_items, parse_items, read_item_pages

GOOD = {
    "question_id": 5, "title": "t", "link": "l", "creation_date": 100, "is_answered": True,
    "owner": {"user_id": 9, "display_name": "Ana"}, "tags": ["python"],
}
RECORD = {
    "question_id": 5, "title": "t", "link": "l", "creation_date": 100, "last_activity_date": 100,
    "is_answered": True, "score": 0, "answer_count": 0, "view_count": 0,
}


def normalized(spark, *items):
    texts = [(i, item if isinstance(item, str) else json.dumps(item)) for i, item in enumerate(items)]
    frame = parse_items(spark.createDataFrame(texts, "i int, j string"), "j")
    return c.check_contract(normalize_items(frame)).orderBy("i")


def test_pages_without_items_yield_nothing(spark, tmp_path):
    pages = [{"items": [GOOD, {**GOOD, "question_id": 6}]}, {"has_more": False}, {"items": []}]
    (tmp_path / "page.json").write_text("\n".join(json.dumps(p) for p in pages))
    items = read_item_pages(spark, str(tmp_path))
    assert items.filter(F.array_contains(item_tags(), "python")).count() == items.count() == 2


def test_pretty_printed_page(spark, tmp_path):
    (tmp_path / "page.json").write_text(json.dumps({"items": [GOOD]}, indent=2))
    assert read_item_pages(spark, str(tmp_path), multi_line=True).count() == 1


def test_defaults_apply_to_absent_keys_only(spark):
    rows = normalized(
        spark,
        GOOD,
        {**GOOD, "owner": None, "score": 7, "last_activity_date": 200},
        {**GOOD, "score": None},
        {k: v for k, v in GOOD.items() if k != "title"},
        {**GOOD, "is_answered": "false"},
        {**GOOD, "question_id": "12", "view_count": 5.9},
        {**GOOD, "answer_count": "many"},
    ).collect()
    assert (rows[0].score, rows[0].last_activity_date, rows[0].owner_user_id) == (0, 100, 9)
    assert (rows[1].score, rows[1].last_activity_date, rows[1].owner_user_id) == (7, 200, None)
    assert [r.normalize_issues for r in rows] == [
        [], [], ["score:not_a_number"], ["title:missing"], ["is_answered:not_boolean"], [],
        ["answer_count:not_a_number"],
    ]
    assert (rows[5].question_id, rows[5].view_count) == (12, 5)


def test_contract_edges(spark):
    rows = normalized(
        spark,
        GOOD,
        {**GOOD, "closed_date": None, "content_license": None},
        {**GOOD, "closed_date": "yesterday"},
        {**GOOD, "content_license": 4},
        {**GOOD, "score": 2**31},
        {**GOOD, "score": -(2**31)},
        "not json",
    ).collect()
    assert [r.violations for r in rows[:6]] == [
        [], [], ["closed_date:wrong_type"], ["content_license:wrong_type"], ["score:out_of_range"], [],
    ]
    assert "question_id:missing" in rows[6].violations


def test_routes_and_reasons(spark):
    checked = normalized(spark, GOOD, {**GOOD, "score": None}, {**GOOD, "view_count": 2**40}).drop("violations")
    routed = c.with_route(c.check_contract(c.with_bad_record(checked)))
    counts = {(r.route, r.reason): r.n_records for r in c.route_counts(routed).collect()}
    assert counts == {
        ("ok", None): 1,
        ("dead_letter", "normalize_failed"): 1,
        ("dead_letter", "avro_encode_failed"): 1,
        ("dead_letter", "manual_bad_message"): 1,
    }
    valid, dead = c.split_contract(c.check_contract(c.with_bad_record(checked)))
    assert (valid.count(), dead.count()) == (1, 3)
    assert valid.columns == RECORD_COLUMNS


def test_rejection_texts(spark):
    errors = [
        "Schema VALIDATION failed", "x INVALID_BINARY_AVRO_MESSAGE", "Failed schema", "schema", "timeout", None,
    ]
    frame = spark.createDataFrame([(e,) for e in errors], "e string")
    got = frame.select(c.classify_reason(F.lit(c.PUBLISH), F.col("e"))).collect()
    assert [r[0] for r in got] == ["publish_schema_rejected"] * 3 + ["publish_failed"] * 3


def test_dead_letter_body(spark):
    df = spark.createDataFrame([tuple([1, "čaj"] + [None] * 12)], RECORD_DDL)
    row = c.to_dead_letter(df, F.lit("r"), F.lit("e"), "topic", "python").first()
    body = json.loads(row.payload)
    assert (body["reason"], body["error"]) == ("r", "e")
    assert body["record"] == json.loads(row.record)
    assert list(body["record"]) == RECORD_COLUMNS and body["record"]["link"] is None
    assert "čaj" in row.payload
    assert row.attributes == {"reason": "r", "source_topic": "topic", "stack_tag": "python"}


def envelope(record, message_id="m1"):
    text = record if isinstance(record, str) else json.dumps(record)
    message = {"data": base64.b64encode(text.encode()).decode()}
    if message_id is not None:
        message["messageId"] = message_id
    return json.dumps({"message": message})


def decoded(spark, *values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    return env.decode_messages(frame).orderBy("i")


def test_outcomes(spark):
    rows = decoded(
        spark,
        "junk",
        '{"x": 1}',
        '{"message": {}}',
        '{"message": {"data": "", "messageId": "m"}}',
        '{"message": {"data": "*bad", "messageId": "m"}}',
        envelope(RECORD),
        envelope("{broken"),
        envelope({**RECORD, "question_id": "five"}),
        envelope({**RECORD, "score": 1.5, "title": 7}),
        envelope({**RECORD, "closed_date": None, "owner_display_name": "Č"}),
        envelope({k: v for k, v in RECORD.items() if k != "link"}),
    ).collect()
    assert [r.outcome for r in rows] == [
        "ack_no_message", "ack_no_message", "ack_no_data", "ack_no_data", "failed", "stored", "dead",
        "dead", "dead", "stored", "dead",
    ]
    assert rows[6].violations[0] == "record:malformed"
    assert rows[7].violations[0] == "question_id:wrong_type"
    assert rows[8].violations[0] == "score:wrong_type"
    assert rows[9].owner_display_name == "Č"
    assert rows[10].violations == ["link:missing"]


def test_message_ids(spark):
    body = envelope(RECORD, None)
    rows = decoded(spark, body, body, envelope(RECORD, ""), envelope(RECORD, "m1"), '{"message": {"messageId": 5}}').collect()
    assert rows[0].message_id == rows[1].message_id != rows[2].message_id
    assert rows[0].message_id.startswith("no-id-") and rows[2].message_id.startswith("no-id-")
    assert [r.message_id for r in rows[3:]] == ["m1", "5"]


def test_dedup_keeps_one_row_per_message(spark):
    values = [envelope(RECORD)] * 5 + [envelope(RECORD, "m2"), envelope({**RECORD, "title": "z"}, "m2")]
    rows = env.dedup_messages(decoded(spark, *values)).orderBy("message_id").collect()
    assert [(r.message_id, r.title) for r in rows] == [("m1", "t"), ("m2", "z")]


def test_parsing_is_not_repeated_by_a_filter(spark):
    frame = spark.createDataFrame([(envelope(RECORD),)], "value string")
    stored = env.decode_messages(frame).filter("outcome = 'stored'").select(*RECORD_COLUMNS)
    text = stored._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(StructField(question_id") == 1
    assert "Python" not in text


def test_only_repeated_messages_are_shuffled(spark, sf_dir):
    dead, newer = {**RECORD, "link": None}, {**RECORD, "title": "z"}
    values = [envelope(RECORD, f"m{i}") for i in range(300)] + [envelope(RECORD, "m5")] * 4 + [envelope(newer, "m6"), envelope(dead, "m7"), envelope(dead, "d")]
    values += [envelope(RECORD, None)] * 3 + ["junk", "junk", None, None, '{"message": {"data": "*bad", "messageId": "m8"}}']
    frame = spark.createDataFrame([(v,) for v in values], "value string").repartition(5)
    whole = env.dedup_messages(env.decode_messages(frame).filter(F.col("outcome") == env.STORED))
    once = env.stored_once(frame)
    assert once.columns == whole.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, whole.collect())) and once.count() == 301
    assert env.stored_once(frame.limit(0)).count() == 0
    text = QUERIES["message_dedup"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    singles, rest = text.split("Window [", 1)[0], text.split("Window [", 1)[1]
    assert "Union" in singles and "NOT" in singles and "bitmap_construct_agg" in singles and "Generate" in rest
