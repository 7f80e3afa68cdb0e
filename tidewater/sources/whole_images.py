"""Change records whose images are kept whole, attributes that no schema names included.

An image is parsed once into a VARIANT, which Parquet stores.  Attributes are typed when they
are read: by a schema that is given, or by the one that all images together have, found in
one aggregate.  So a column that producers add half way is not lost on the way in, and rows
that landed before anybody named it have it as well.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T

from tidewater.functions.attributes import decode_value, wire_type
from tidewater.operators.latest import DELETE, OP, SEQ
from tidewater.sources.change_records import UPSERT

IMAGE = "image"


def whole_images(df: DataFrame, value: str = "value", sequence: bool = False) -> DataFrame:
    """Rows of a JSON text column as ``image`` (VARIANT) and ``_op``, batch or streaming.

    As :func:`~tidewater.sources.change_records.decode_changes` with tombstones, but for any
    attributes.  Lines that are no change records, other events and images that are no
    objects are left out; ``sort_out`` accounts for them.
    """
    kept = [F.col(c) for c in df.columns if c != value]
    # as a generator the parse runs once per line
    lines = df.select(*kept, F.explode(F.array(F.try_parse_json(value))).alias("_line"))

    def part(path: str, kind: str = "variant"):
        return F.try_variant_get("_line", f"$.{path}", kind)

    event = F.lower(F.trim(part("eventName", "string")))
    removed = event == "remove"
    image = F.when(event.isin("insert", "modify"), part("dynamodb.NewImage")).when(
        removed, F.coalesce(part("dynamodb.OldImage"), part("dynamodb.Keys"))
    )
    more = [part("dynamodb.SequenceNumber", "string").alias(SEQ)] if sequence else []
    rows = lines.select(*kept, image.alias(IMAGE), F.when(removed, DELETE).otherwise(UPSERT).alias(OP), *more)
    return rows.where(F.startswith(F.schema_of_variant(IMAGE), F.lit("OBJECT")))


def _plain(tagged: T.DataType) -> T.DataType:
    """The type of an attribute, given that of its tagged value."""
    tags = {f.name: f.dataType for f in tagged} if isinstance(tagged, T.StructType) else {}
    tags.pop("NULL", None)
    if len(tags) != 1:
        return T.StringType()  # untagged, only null, or of several kinds
    tag, inner = tags.popitem()
    if tag == "M" and isinstance(inner, T.StructType):
        return schema_of_tagged(inner) if len(inner) else T.StringType()
    if tag == "L" and isinstance(inner, T.ArrayType):
        return T.ArrayType(_plain(inner.elementType))
    if tag in ("SS", "NS"):
        return T.ArrayType(T.StringType() if tag == "SS" else T.DoubleType())
    return {"N": T.DoubleType(), "BOOL": T.BooleanType()}.get(tag, T.StringType())


def schema_of_tagged(image: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in image])


def discover_schema(images: DataFrame) -> T.StructType:
    """The schema of all images together: names in order, numbers as doubles.

    One aggregate with a partial step; only the merged type reaches the driver.  An
    attribute of several kinds is text.
    """
    found = images.agg(F.schema_of_variant_agg(IMAGE)).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType()
    tagged = T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", found))
    return schema_of_tagged(tagged)


def _path(name: str) -> str:
    if "'" not in name:
        return f"$['{name}']"
    if '"' in name:
        raise ValueError(f"a name with both kinds of quotes: {name}")
    return f'$["{name}"]'


def typed(images: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns of every image, beside the other columns; absent ones are null."""
    columns = []
    for field in schema:
        wire = F.try_variant_get(IMAGE, _path(field.name), wire_type(field.dataType).simpleString())
        columns.append(decode_value(wire, field.dataType).alias(field.name))
    return images.select(*[F.col(c) for c in images.columns if c != IMAGE], *columns)
