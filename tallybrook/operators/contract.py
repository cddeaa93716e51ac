"""Record contract: check, split, dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook import fixed_values as fv
from tallybrook.operators.once import with_columns_once
from tallybrook.schemas import CONTRACT, RECORD_COLUMNS, Field

ENCODE, PUBLISH, NORMALIZE, MANUAL = "encode", "publish", "normalize", "manual"
_NO_ISSUES = "cast(array() as array<string>)"


def issue_list(checks: Sequence[tuple[Column, str]]) -> Column:
    """Names of the failed checks. Sound rows take a compiled boolean path and build no array."""
    failed = F.lit(False)
    for bad, _ in checks:
        failed = failed | bad
    names = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for bad, name in checks]))
    return F.when(failed, names).otherwise(F.expr(_NO_ISSUES))


def _outside(name: str, least: int, most: int) -> Column:
    return F.coalesce(~F.col(name).between(least, most), F.lit(False))


def check_contract(
    df: DataFrame,
    contract: Sequence[Field] = CONTRACT,
    found_earlier: Sequence[str] = ("normalize_issues", "type_issues"),
) -> DataFrame:
    """Add ``violations``: required fields that are null, 32-bit and epoch fields out of range, and
    whatever the parsing step already listed in the ``found_earlier`` columns."""
    checks = []
    for field in contract:
        if field.required:
            checks.append((F.col(field.name).isNull(), f"{field.name}:missing"))
        if field.int32:
            checks.append((_outside(field.name, fv.INT32_MIN, fv.INT32_MAX), f"{field.name}:out_of_range"))
        if field.name in fv.EPOCH_FIELDS:
            checks.append((_outside(field.name, fv.EPOCH_MIN, fv.EPOCH_MAX), f"{field.name}:out_of_range"))
    earlier = [F.coalesce(F.col(c), F.expr(_NO_ISSUES)) for c in found_earlier if c in df.columns]
    violations = issue_list(checks)
    if earlier:
        violations = F.array_distinct(F.concat(*earlier, violations))
    return with_columns_once(df, {"violations": violations})


def is_valid() -> Column:
    return F.size("violations") == 0


def split_contract(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid records, rejected rows) of a checked frame. Persist it first if both sides are written."""
    return df.filter(is_valid()).select(*RECORD_COLUMNS), df.filter(~is_valid())


def schema_rejected(error: Column) -> Column:
    """Whether an error text says that the topic refused the record's schema."""
    text = F.lower(error)
    rejected = F.lit(False)
    for words in fv.SCHEMA_REJECTION_WORDS:
        group = F.lit(True)
        for word in words:
            group = group & F.contains(text, F.lit(word))
        rejected = rejected | group
    return F.coalesce(rejected, F.lit(False))


def classify_reason(stage: Column, error: Column) -> Column:
    """Dead-letter reason from the stage that failed and its error text."""
    return (
        F.when(stage == MANUAL, fv.MANUAL_BAD_MESSAGE)
        .when(stage == NORMALIZE, fv.NORMALIZE_FAILED)
        .when(stage == ENCODE, fv.AVRO_ENCODE_FAILED)
        .when((stage == PUBLISH) & schema_rejected(error), fv.PUBLISH_SCHEMA_REJECTED)
        .when(stage == PUBLISH, fv.PUBLISH_FAILED)
    )


def failure_stage(df: DataFrame) -> Column:
    """Stage of a rejected row: injected, not normalisable, or not encodable."""
    stage = F.lit(ENCODE)
    if "normalize_issues" in df.columns:
        found = F.col("normalize_issues").isNotNull() & (F.size("normalize_issues") > 0)
        stage = F.when(found, NORMALIZE).otherwise(stage)
    if "injected" in df.columns:
        stage = F.when(F.coalesce(F.col("injected"), F.lit(False)), MANUAL).otherwise(stage)
    return stage


def with_route(df: DataFrame) -> DataFrame:
    """Add ``route`` (ok or dead_letter), ``reason`` and ``error`` to a checked frame."""
    error = F.when(~is_valid(), F.array_join("violations", "; "))
    return df.withColumns(
        {
            "route": F.when(is_valid(), "ok").otherwise("dead_letter"),
            "reason": F.when(~is_valid(), classify_reason(failure_stage(df), error)),
            "error": error,
        }
    )


def _as_text(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("string")
    variant = isinstance(df.schema[name].dataType, T.VariantType)
    return F.to_json(name) if variant else F.col(name).cast("string")


def to_dead_letter(
    df: DataFrame,
    reason: Column,
    error: Column,
    source: str,
    tag: str,
    record: Sequence[str] = RECORD_COLUMNS,
) -> DataFrame:
    """``reason, error, record, payload, original, message_id, attributes``; the payload is the JSON
    body, nulls kept. ``original`` is the input as it came (message body or item), as far as the frame
    carries one, so that a letter can be repaired and sent again."""
    keep_nulls = {"ignoreNullFields": "false"}
    body = F.struct(*record)
    return df.select(
        reason.alias("reason"),
        error.alias("error"),
        F.to_json(body, keep_nulls).alias("record"),
        F.to_json(
            F.struct(reason.alias("reason"), error.alias("error"), body.alias("record")), keep_nulls
        ).alias("payload"),
        _as_text(df, "original").alias("original"),
        _as_text(df, "message_id").alias("message_id"),
        F.create_map(
            F.lit("reason"), reason,
            F.lit("source_topic"), F.lit(source),
            F.lit("stack_tag"), F.lit(tag),
        ).alias("attributes"),
    )


def route_counts(routed: DataFrame) -> DataFrame:
    """How many rows took which route, and why."""
    return routed.groupBy("route", "reason").agg(F.count("*").alias("n_records"))


def with_bad_record(df: DataFrame) -> DataFrame:
    """Append one record that has only a title, marked ``injected``, to exercise the dead-letter route."""
    bad = df.sparkSession.range(1).select(
        F.lit(fv.BAD_RECORD_TITLE).alias("title"), F.lit(True).alias("injected")
    )
    return df.withColumn("injected", F.lit(False)).unionByName(bad, allowMissingColumns=True)
