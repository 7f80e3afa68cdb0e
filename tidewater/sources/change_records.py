"""Change records: ``{"eventName": .., "dynamodb": {"Keys", "NewImage", "OldImage"}}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewater.functions.attributes import decode_image, encode_image, wire_image
from tidewater.operators.latest import DELETE, OP, SEQ

UPSERT = "U"


def landed_schema(schema: T.StructType, sequence: bool = False) -> T.StructType:
    """Schema of landed changes: the columns, the operation and, on demand, the order."""
    extra = [OP, SEQ] if sequence else [OP]
    return T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in extra)])


def record_type(schema: T.StructType) -> T.StructType:
    """Struct of one JSON record whose images carry the schema's columns."""
    image = wire_image(schema)
    images = T.StructType(
        [
            *(T.StructField(name, image) for name in ("Keys", "NewImage", "OldImage")),
            T.StructField("SequenceNumber", T.StringType()),
        ]
    )
    return T.StructType(
        [T.StructField("eventName", T.StringType()), T.StructField("dynamodb", images)]
    )


def parse_changes(df: DataFrame, schema: T.StructType, value: str, mode: str, corrupt: str | None = None) -> DataFrame:
    """``df`` with its JSON text parsed once, as ``_record``.

    ``corrupt`` names a field of the record that holds the text where it doesn't fit.
    """
    wanted, options = record_type(schema), {"mode": mode}
    if corrupt:
        wanted = T.StructType([*wanted.fields, T.StructField(corrupt, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt
    record = F.from_json(F.col(value), wanted, options)
    # as a generator the parse runs once per row; as a plain column Catalyst would
    # copy it into every expression and filter that looks at it
    return df.select("*", F.explode(F.array(record)).alias("_record"))


def picked_image(event: Column, deletes: str) -> tuple[Column, Column]:
    """The image of ``_record`` that an event asks for, and its operation."""
    if deletes not in ("tombstone", "as_rows"):
        raise ValueError(f"unknown deletes option: {deletes}")
    removed = event == "remove"
    old: Column = F.col("_record.dynamodb.OldImage")
    if deletes == "tombstone":
        old = F.coalesce(old, F.col("_record.dynamodb.Keys"))
    image = F.when(event.isin("insert", "modify"), F.col("_record.dynamodb.NewImage")).when(removed, old)
    op = F.when(removed, DELETE).otherwise(UPSERT) if deletes == "tombstone" else F.lit(UPSERT)
    return image, op


def decode_changes(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    deletes: str = "tombstone",
    mode: str = "FAILFAST",
    sequence: bool = False,
) -> DataFrame:
    """Rows of a JSON text column, typed by ``schema``, batch or streaming.

    INSERT and MODIFY take the new image, REMOVE the old one; the event name is
    trimmed and matched without case.  A record without the image it needs is
    dropped.  Columns of ``df`` other than ``value`` are kept, and ``_op`` tells
    upserts (``U``) from deletes (``D``).

    ``deletes="tombstone"`` also accepts a REMOVE that carries its keys only.
    ``deletes="as_rows"`` re-emits the removed row as a live one.
    ``sequence`` adds ``_seq``, the record's place in its stream as digits; an upsert
    of several changes of one key goes by it before anything else.
    ``mode="PERMISSIVE"`` lets broken JSON fall out; ``sort_out`` keeps it and tells why.
    """
    kept = [F.col(c) for c in df.columns if c != value]
    event = F.lower(F.trim(F.col("_record.eventName")))
    image, op = picked_image(event, deletes)
    parsed = parse_changes(df, schema, value, mode).drop(value)
    more = [F.col("_record.dynamodb.SequenceNumber").alias(SEQ)] if sequence else []
    picked = parsed.select(*kept, image.alias("_image"), op.alias(OP), *more)
    return picked.where(F.col("_image").isNotNull()).select(
        *kept, *decode_image(F.col("_image"), schema), OP, *([SEQ] if sequence else [])
    )


def malformed_changes(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows whose text is no JSON object, for a quarantine table."""
    envelope = T.StructType([T.StructField("eventName", T.StringType())])
    name = F.from_json(F.col(value), envelope, {"mode": "PERMISSIVE"})
    return df.where(name["eventName"].isNull())


def encode_changes(
    df: DataFrame,
    schema: T.StructType,
    event_name: Column,
    keys: tuple[str, ...] = (),
    old_image: bool = True,
    sequence: Column | None = None,
    kept: tuple[str, ...] = (),
) -> DataFrame:
    """Rows as change-record JSON in a ``value`` column; other columns but ``kept`` are dropped.

    A REMOVE carries its old image, or only ``keys`` when ``old_image`` is off.
    ``sequence`` gives the record's place in its stream, as digits.
    """
    row = F.struct(*encode_image(None, schema))
    removed = F.lower(F.trim(event_name)) == "remove"
    parts = [F.when(~removed, row).alias("NewImage")]
    if old_image:
        parts.append(F.when(removed, row).alias("OldImage"))
    if keys:
        key_schema = T.StructType([schema[k] for k in keys])
        parts.append(F.struct(*encode_image(None, key_schema)).alias("Keys"))
    if sequence is not None:
        parts.append(sequence.cast("string").alias("SequenceNumber"))
    record = F.struct(event_name.alias("eventName"), F.struct(*parts).alias("dynamodb"))
    return df.select(*kept, F.to_json(record).alias("value"))
