"""Schemas derived from the record contract."""

from __future__ import annotations

from dataclasses import dataclass

from tallybrook import fixed_values as fv


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool
    int32: bool


CONTRACT = tuple(Field(*f) for f in fv.RECORD_FIELDS)
RECORD_COLUMNS = [f.name for f in CONTRACT]

# DDL text rather than StructType objects, which need a running session to be parsed.
# Stored columns are all nullable: parquet carries no not-null flag, so later layers check for themselves.
RECORD_DDL = ", ".join(f"{f.name} {f.type}" for f in CONTRACT)

# Hour columns stay strings, so month=01 reads back as '01' whatever the session infers.
HOUR_DDL = ", ".join(f"{c} string" for c in fv.HOUR_COLUMNS)
LAKE_DDL = f"{RECORD_DDL}, run string, batch_id bigint, {HOUR_DDL}"
DEAD_LETTER_DDL = (
    "reason string, error string, record string, original string, message_id string, "
    "attributes map<string,string>, run string, batch_id bigint"
)
MANIFEST_DDL = "folder string, loaded_at timestamp, batch_id bigint"
TABLE_DDL = f"{RECORD_DDL}, run string, batch_id bigint"
ENVELOPE_DDL = "message struct<data: string, messageId: string>"
