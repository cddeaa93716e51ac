"""From landed pages to validated models."""

import json

from tallybrook.operators.load import load_new_folders
from tallybrook.plans.jobs import PageRequest, build_models, ingest_pages, validate_models
from tallybrook.sources.lake import read_processed
from test_ingest import GOOD


def test_pages_to_validated_models(spark, tmp_path):
    pages, lake, table, manifest, silver, gold, results = (
        str(tmp_path / n) for n in ("pages", "lake", "table", "manifest", "silver", "gold", "results")
    )
    items = [
        {**GOOD, "question_id": i, "link": f"l{i}", "creation_date": 86400 * (i % 3) + i, "view_count": 600 * i}
        for i in range(6)
    ]
    other = {**GOOD, "question_id": 99, "tags": ["java"]}
    broken = {**GOOD, "question_id": 50, "score": None}
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "1.json").write_text(
        "\n".join(json.dumps({"items": page}) for page in (items[:3], [*items[3:], other, broken], []))
    )
    request = PageRequest(tag="python")
    for _ in range(2):  # a rerun replaces the batch
        counts = ingest_pages(spark, pages, lake, "topic", request, add_bad_record=True)
        assert counts == {
            ("ok", None): 6,
            ("dead_letter", "normalize_failed"): 1,
            ("dead_letter", "manual_bad_message"): 1,
        }
    assert read_processed(spark, f"{lake}/processed").count() == 6
    assert spark.read.json(f"{lake}/dead_letters").count() == 2

    assert len(load_new_folders(spark, f"{lake}/processed", table, manifest)) == 3
    build_models(spark, table, silver, gold)
    assert spark.table("bronze_questions").count() == 6
    days = spark.read.parquet(gold).orderBy("report_date", "sentiment").collect()
    assert [(r.sentiment, r.post_count) for r in days] == [
        ("HIGH_ENGAGEMENT", 1), ("NEUTRAL", 1), ("HIGH_ENGAGEMENT", 1), ("NEUTRAL", 1), ("HIGH_ENGAGEMENT", 2),
    ]
    passed = validate_models(spark, table, silver, results)
    assert passed == dict.fromkeys(("bronze_strict", "bronze_monitoring", "silver_strict", "silver_full"), True)
    few = validate_models(spark, table, silver, results, max_rows=5)  # in the same second: its own verdicts
    assert few == {"bronze_strict": False, "bronze_monitoring": False, "silver_strict": True, "silver_full": True}


def test_requested_pages(spark, tmp_path):
    items = [{**GOOD, "question_id": i, "creation_date": i} for i in range(10)]
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "1.json").write_text(json.dumps({"items": items}))
    request = PageRequest(tag="python", page_size=3, total=4, start_page=2)
    counts = ingest_pages(spark, str(tmp_path / "pages"), str(tmp_path / "lake"), "topic", request)
    assert counts == {("ok", None): 4}
    ids = sorted(r.question_id for r in read_processed(spark, str(tmp_path / "lake/processed")).collect())
    assert ids == [3, 4, 5, 6]


def test_broken_pages_are_told_of_and_sources_add_up(spark, tmp_path):
    lake = str(tmp_path / "lake")
    good = json.dumps({"items": [{**GOOD, "question_id": 1}]})
    for name, lines, multi_line, broken in (
        ("lines", [good, '{"items": [', '{"items":"oops"}', '{"other": 1}', "[1]", ""], False, 3),
        ("whole", [json.dumps({"items": [{**GOOD, "question_id": 2}]}, indent=2)], True, 0),
    ):
        (tmp_path / name).mkdir()
        (tmp_path / name / "1.json").write_text("\n".join(lines))
        counts = ingest_pages(spark, str(tmp_path / name), lake, "topic", multi_line=multi_line)
        assert counts == {("ok", None): 1, **({("dead_letter", "page_malformed"): broken} if broken else {})}
    assert sorted(r.question_id for r in read_processed(spark, f"{lake}/processed").collect()) == [1, 2]
    letters = {r.original: r.error for r in spark.read.json(f"{lake}/dead_letters").collect()}
    assert letters == {'{"items": [': "page:not_json", '{"items":"oops"}': "items:not_a_list", "[1]": "page:not_an_object"}


def test_letters_of_items_hold_the_item(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    items = [{**GOOD, "creation_date": 10**15}, {**GOOD, "question_id": "five"}, GOOD]
    (tmp_path / "pages" / "1.json").write_text(json.dumps({"items": items}))
    counts = ingest_pages(spark, str(tmp_path / "pages"), str(tmp_path / "lake"), "topic")
    assert counts[("ok", None)] == 1
    letters = {r.error: json.loads(r.original) for r in spark.read.json(str(tmp_path / "lake" / "dead_letters")).collect()}
    assert letters == {"creation_date:out_of_range; last_activity_date:out_of_range": items[0], "question_id:missing": items[1]}
