"""Fixed schemas at every boundary. Every field may be null: checks are queries, not schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DecimalType, IntegerType, LongType, StringType, StructType,
    TimestampType,
)

TEXT, BIGINT = StringType(), LongType()
TEXTS = ArrayType(TEXT)


def record(**fields: DataType) -> StructType:
    schema = StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    return schema


def extend(schema: StructType, **fields: DataType) -> StructType:
    return StructType(schema.fields + record(**fields).fields)


def columns(schema: StructType) -> list[str]:
    return schema.fieldNames()


SOURCES = record(id=BIGINT, channel_id=TEXT, platform=TEXT, channel_name=TEXT)

RAW_DISCORD = record(
    channel_id=TEXT, id=TEXT, timestamp=TEXT, content=TEXT, author=record(username=TEXT, id=TEXT),
    embeds=ArrayType(record(url=TEXT)),
)

RAW_TELEGRAM = record(
    channel_id=TEXT, id=BIGINT, date=TEXT, text=TEXT, message=TEXT,
    from_id=record(kind=TEXT, user_id=BIGINT), peer_id=record(channel_id=BIGINT),
    entities=ArrayType(record(kind=TEXT, url=TEXT)),
)

MESSAGES = record(
    id=TEXT, text=TEXT, timestamp=TimestampType(), author=TEXT, channel_id=TEXT, platform=TEXT,
    links=TEXTS,
)

# Messages of the look-back window before greetings are dropped.
COLLECTED = extend(MESSAGES, low_value=BooleanType())

LABEL_ITEMS = record(id=TEXT, text=TEXT, platform=TEXT, channel_id=TEXT, links=TEXTS)

LABELS = record(id=TEXT, platform=TEXT, channel_id=TEXT, keep=TEXT, score=TEXT, tags=TEXTS)

LABEL_RESPONSES = record(batch_id=BIGINT, attempt=IntegerType(), body=TEXT)

DIGEST = extend(MESSAGES, score=DecimalType(3, 2), tags=TEXTS)

# Digests of earlier runs as found in JSON files.
ARCHIVE = record(
    id=TEXT, text=TEXT, timestamp=TEXT, author=TEXT, channel_id=TEXT, platform=TEXT, links=TEXTS,
    score=TEXT, tags=TEXTS,
)

LOAD_ERRORS = record(channel_id=TEXT, platform=TEXT, http_status=IntegerType(), error=TEXT)

ALERTS = record(kind=TEXT, channel_id=TEXT, platform=TEXT, message=TEXT)
