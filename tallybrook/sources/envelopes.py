"""Message envelopes: ``{"message": {"data": <base64 of a record>, "messageId": <id>}}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook import fixed_values as fv
from tallybrook.operators.contract import check_contract, is_valid, issue_list
from tallybrook.operators.latest import latest_by_key
from tallybrook.operators.membership import with_membership
from tallybrook.operators.once import with_columns_once, with_struct_columns
from tallybrook.schemas import CONTRACT, ENVELOPE_DDL, RECORD_COLUMNS

ACK_NO_MESSAGE, ACK_NO_DATA = "ack_no_message", "ack_no_data"
FAILED, DEAD, STORED = "failed", "dead", "stored"
OUTCOMES = (ACK_NO_MESSAGE, ACK_NO_DATA, FAILED, DEAD, STORED)


def parse_envelope(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``has_message``, ``raw_message_id``, ``has_data``, ``payload`` (null if not base64 of UTF-8)
    and ``payload_error``, which says why it is null."""
    return _parse_payload(with_struct_columns(df, F.from_json(value_col, ENVELOPE_DDL)))


def _parse_payload(opened: DataFrame) -> DataFrame:
    data = F.col("message.data")
    opened = with_columns_once(opened, {"_bytes": F.try_to_binary(data, F.lit("base64"))})
    sound = F.is_valid_utf8(F.col("_bytes").cast("string"))
    return with_columns_once(
        opened,
        {
            "has_message": F.col("message").isNotNull(),
            "raw_message_id": F.col("message.messageId"),
            "has_data": F.coalesce(data != "", F.lit(False)),
            "payload": F.when(sound, F.col("_bytes").cast("string")),
            "payload_error": F.when(F.col("_bytes").isNull(), "payload is not base64").when(
                ~sound, "payload is not UTF-8"
            ),
        },
    ).drop("message", "_bytes")


def with_message_id(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``message_id``: the sender's id, else a hash of the body, so that a redelivery of a
    message without id gets the same id again."""
    given = F.when(F.col("raw_message_id") != "", F.col("raw_message_id"))
    made = F.concat(F.lit(fv.NO_ID_PREFIX), F.sha2(F.col(value_col), 256))
    return df.withColumn("message_id", F.coalesce(given, made))


def parse_records(df: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Add the record's columns and ``type_issues`` from its JSON text.

    The typed parse refuses values of another JSON type and reports the row as corrupt. Only such
    rows are parsed again, as text, to name the fields that have a value the typed parse lost. A text
    field would take any JSON value as its text, so those are parsed as VARIANT and keep their type.
    """
    texts = [f.name for f in CONTRACT if f.type == "string"]
    ddl = ", ".join(f"{f.name} {'variant' if f.name in texts else f.type}" for f in CONTRACT)
    typed = F.from_json(payload_col, f"{ddl}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    names = F.array(*[F.lit(name) for name in RECORD_COLUMNS])
    understood = F.array_compact(
        F.array(*[F.when(F.col(name).isNotNull(), F.lit(name)) for name in RECORD_COLUMNS])
    )
    as_text = F.from_json(payload_col, "map<string,string>")
    given = F.map_keys(F.map_filter(as_text, lambda _, text: text.isNotNull()))
    lost = F.array_except(F.array_intersect(names, given), understood)
    issues = F.transform(lost, lambda name: F.concat(name, F.lit(":wrong_type")))
    malformed = F.array(F.lit("record:malformed"))
    none = F.expr("cast(array() as array<string>)")
    not_text = issue_list([(_not_text(name), f"{name}:wrong_type") for name in texts])
    found = F.when(F.col("_corrupt").isNull(), not_text).otherwise(
        F.coalesce(F.nullif(F.array_union(issues, not_text), none), malformed)
    )
    parsed = with_columns_once(with_struct_columns(df, typed), {"type_issues": found}).drop("_corrupt")
    return parsed.withColumns({name: F.when(~_not_text(name), F.try_variant_get(name, "$", "string")) for name in texts})


def _not_text(name: str) -> Column:
    value = F.col(name)
    other = ~F.is_variant_null(value) & (F.schema_of_variant(value) != "STRING")
    return F.coalesce(other, F.lit(False))


def classify_delivery(df: DataFrame) -> DataFrame:
    """Add ``outcome``: what happens to the message, first match wins."""
    return df.withColumn(
        "outcome",
        F.when(~F.col("has_message"), ACK_NO_MESSAGE)
        .when(~F.col("has_data"), ACK_NO_DATA)
        .when(F.col("payload").isNull(), FAILED)
        .when(~is_valid(), DEAD)
        .otherwise(STORED),
    )


def decode_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Envelope text to record columns, ``message_id``, ``violations`` and ``outcome``; the envelope
    itself stays as ``original``.

    The same expressions serve batch and streaming frames.
    """
    return _decode_opened(_opened(df, value_col))


def _opened(df: DataFrame, value_col: str = "value") -> DataFrame:
    return with_message_id(parse_envelope(df, value_col), value_col).withColumnRenamed(value_col, "original")


def _decode_opened(opened: DataFrame) -> DataFrame:
    return classify_delivery(check_contract(parse_records(opened)))


def outcome_counts(decoded: DataFrame) -> DataFrame:
    """Messages per outcome; count before dropping redeliveries."""
    return decoded.groupBy("outcome").agg(F.count("*").alias("n_messages"))


def dedup_messages(df: DataFrame, tiebreak: tuple[str, ...] = ("payload",)) -> DataFrame:
    """One row per message id. Redeliveries carry the same body; should bodies differ, the greatest
    in ``tiebreak`` order is kept, so a retried task makes the same choice."""
    return latest_by_key(df, ["message_id"], [F.col(c).desc() for c in tiebreak])


def stored_once(df: DataFrame, value_col: str = "value") -> DataFrame:
    """What ``dedup_messages`` leaves of the stored messages of a batch frame, without a shuffle of all of them.

    Ids that came more than once are broadcast as a bitmap; messages of other ids stay in their tasks. The few that
    the bitmap holds by chance are deduplicated like redelivered ones, which makes no difference to them. The
    envelopes are read once for the ids and once for each side, every record is parsed once.
    """
    opened = _opened(df, value_col)
    repeated = opened.groupBy("message_id").agg(F.count("*").alias("n")).filter("n > 1").select("message_id")
    marked = with_membership(opened, repeated, "_repeated")
    stored = _decode_opened(marked).filter(F.col("outcome") == STORED)
    return stored.filter(~F.col("_repeated")).unionByName(dedup_messages(stored.filter("_repeated"))).drop("_repeated")


def _keyed(lines: DataFrame, value_col: str) -> DataFrame:
    """``message_id`` of the opened envelopes, whose payloads are left alone."""
    opened = with_struct_columns(lines, F.from_json(value_col, ENVELOPE_DDL))
    return with_message_id(opened.withColumn("raw_message_id", F.col("message.messageId")), value_col).drop("raw_message_id")


def doubtful_ids(lines: DataFrame, ids: DataFrame, value_col: str = "value") -> DataFrame:
    """``message_id`` of the lines that may not be taken as they are: those that came more than once, and those that are
    not, or not once, among ``ids``. Only ids are shuffled."""
    came = _keyed(lines, value_col).select("message_id", F.lit(1).alias("came"), F.lit(0).alias("known"))
    known = ids.select("message_id", F.lit(0).alias("came"), F.lit(1).alias("known"))
    counts = came.unionByName(known).groupBy("message_id").agg(F.sum("came").alias("came"), F.sum("known").alias("known"))
    return counts.filter("came <> 1 OR known <> 1").select("message_id")


def _once_each(keyed: DataFrame, ids: DataFrame, columns: list[str], value_col: str) -> DataFrame:
    """The decoded messages of ``ids`` among others; of several that are the same one, that with the greatest digest."""
    keys = ["outcome", "message_id"]
    decoded = _decode_opened(_parse_payload(keyed).withColumnRenamed(value_col, "original"))
    rows = decoded.select(*dict.fromkeys([*keys, *columns]), F.xxhash64("original").alias("_body")).join(ids.select(*keys), keys, "left_semi")
    return latest_by_key(rows, keys, [F.col("_body").desc()]).select(*columns)


def messages_of(lines: DataFrame, ids: DataFrame, doubtful: DataFrame, outcome: str, columns: list[str], value_col: str = "value") -> DataFrame:
    """One decoded message of this outcome for each of its ``ids`` (``outcome, message_id``), which all stand in ``lines``.

    ``doubtful`` ids, as ``doubtful_ids`` tells them, are broadcast as a bitmap; messages of other ids stay in their
    tasks, as there is one of each and it is among ``ids``. The others, and the few that the bitmap holds by chance, are
    compared with ``ids``. A repeated batch makes the same choice. Envelopes are opened on both sides, payloads once.
    """
    marked = with_membership(_keyed(lines, value_col), doubtful, "_doubtful")
    sure = _decode_opened(_parse_payload(marked.filter(~F.col("_doubtful"))).withColumnRenamed(value_col, "original"))
    once = _once_each(marked.filter("_doubtful"), ids.filter(F.col("outcome") == outcome), columns, value_col)
    return sure.filter(F.col("outcome") == outcome).select(*columns).unionByName(once)


def few_messages_of(lines: DataFrame, ids: DataFrame, columns: list[str], value_col: str = "value") -> DataFrame:
    """As ``messages_of``, where ``ids`` are few of those in ``lines``: only their messages are decoded, and shuffled."""
    marked = with_membership(_keyed(lines, value_col), ids.select("message_id"), "_wanted")
    return _once_each(marked.filter("_wanted"), ids, columns, value_col)
