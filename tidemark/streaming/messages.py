"""Decoding metric messages. Everything here works on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.live import KEYS
from tidemark.plans.metrics import CONCENTRATION, RISK
from tidemark.schemas import ENVELOPE_DDL

ALLOWED_TYPES = [CONCENTRATION, RISK]

# Row fields a message of each type must bring to change the state.
REQUIRED_FIELDS = {
    CONCENTRATION: ["ocean_region", "environment_type", "avg_concentration", "total_observations", "unit"],
    RISK: ["ocean_region", "environment_type", "avg_pollution", "species_count", "risk_index"],
}


def encode(*columns: str | Column) -> Column:
    """The JSON text of the columns, nulls written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def message_time(text: str | Column) -> Column:
    """The time a message states, or now when it states none that can be read."""
    value = F.col(text) if isinstance(text, str) else text
    return F.coalesce(value.try_cast("timestamp"), F.current_timestamp())


def parse(raw: DataFrame) -> DataFrame:
    """Add the decoded message. Text that is not a JSON object decodes to null, without failing."""
    looks_like_object = F.col("value").rlike(r"^\s*\{")
    return raw.withColumn("m", F.when(looks_like_object, F.from_json("value", ENVELOPE_DDL)))


def decode(raw: DataFrame) -> DataFrame:
    """Messages of the allowed types with their parts; others are skipped."""
    return decode_parsed(parse(raw))


def decode_parsed(parsed: DataFrame) -> DataFrame:
    """As :func:`decode`, of messages that :func:`parse` has read."""
    carried = [c for c in parsed.columns if c not in ("value", "m")]
    allowed = parsed.where(F.col("m.metric_type").isin(ALLOWED_TYPES))
    return allowed.select(
        *carried, "value", "m.metric_type", "m.year", "m.timestamp",
        message_time("m.timestamp").alias("sent_at"), "m.data", "m.record_count",
    )


def rejected(raw: DataFrame) -> DataFrame:
    """What :func:`decode` skips, with the reason."""
    return rejected_parsed(parse(raw))


def rejected_parsed(parsed: DataFrame) -> DataFrame:
    """As :func:`rejected`, of messages that :func:`parse` has read."""
    unreadable = F.col("m.metric_type").isNull()
    reason = F.when(unreadable, "unreadable").otherwise("unknown type")
    keep = F.coalesce(F.col("m.metric_type").isin(ALLOWED_TYPES), F.lit(False))
    return parsed.where(~keep).select("value", reason.alias("reason"))


def has_required_fields(message_value: str = "value") -> Column:
    """Whether the rows of the message together name every field its type requires.

    The decoded row cannot tell a missing field from a null one, the JSON text can. The
    test looks at the text alone: a test of decoded fields would be pushed below the
    decoding and parse the message again for each of them.
    """
    rows = F.from_json(F.get_json_object(message_value, "$.data"), "array<map<string,string>>")
    fields = F.flatten(F.transform(rows, lambda r: F.map_keys(r)))
    test = F.lit(False)
    for metric, names in REQUIRED_FIELDS.items():
        wanted = F.array(*[F.lit(n) for n in names])
        complete = F.size(F.array_except(wanted, fields)) == 0
        test = F.when(F.col("metric_type") == metric, F.coalesce(complete, F.lit(False))).otherwise(test)
    return test


def _usable(messages: DataFrame, metric: str) -> tuple[DataFrame, list[str]]:
    """Messages of one type that have a year and the required fields, and the columns their rows carry."""
    usable = messages.where((F.col("metric_type") == metric) & F.col("year").isNotNull() & has_required_fields())
    return usable, [c for c in messages.columns if c not in ("value", "data", "metric_type", "record_count", "timestamp")]


def explode_rows(messages: DataFrame, metric: str) -> DataFrame:
    """Rows of the messages of one type, stamped with the message's year and order."""
    usable, carried = _usable(messages, metric)
    return usable.select(*carried, F.inline("data"))


def explode_keys(messages: DataFrame, metric: str) -> DataFrame:
    """For each message of one type and each key in it, the rows the message has of the key.

    A message replaces the earlier rows of its keys, and all its own rows stay, also several of one key.
    """
    usable, carried = _usable(messages, metric)
    key, values = KEYS[metric]
    parts = [k for k in key if k != "year"]

    def part_of(row: Column) -> Column:
        return F.struct(*[row[k].alias(k) for k in parts])

    each = usable.select(*carried, "data", F.explode(F.array_distinct(F.transform("data", part_of))).alias("_k"))
    own = F.filter("data", lambda row: part_of(row).eqNullSafe(F.col("_k")))
    rows = F.transform(own, lambda row: F.struct(*[row[v].alias(v) for v in values]))
    return each.select(*carried, "_k.*", rows.alias("rows"))
