"""Typed attribute values, the wire form of change records.

A value travels as an object with one type tag: ``{"S": "x"}``, ``{"N": "1.5"}``,
``{"BOOL": true}``, ``{"NULL": true}``, ``{"M": {name: value}}``, ``{"L": [value]}``,
``{"SS": [..]}``, ``{"NS": [..]}``.

Both directions are driven by the Spark type of the column.  ``wire_type`` turns
a schema into the exact nested struct of its wire form, so one ``from_json`` (or
``to_json``) per record handles any depth and skips attributes nobody asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_TEXT = T.StringType()


def _tags(**tags: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(tag, dtype) for tag, dtype in tags.items()])


def wire_type(dtype: T.DataType) -> T.StructType:
    """Struct that holds one attribute value of the given type."""
    if isinstance(dtype, T.StructType):
        return _tags(M=wire_image(dtype))
    if isinstance(dtype, T.MapType):
        return _tags(M=T.MapType(_TEXT, wire_type(dtype.valueType)))
    if isinstance(dtype, T.ArrayType):
        return _tags(
            L=T.ArrayType(wire_type(dtype.elementType)),
            SS=T.ArrayType(_TEXT),
            NS=T.ArrayType(_TEXT),
        )
    if isinstance(dtype, T.BooleanType):
        return _tags(BOOL=T.BooleanType(), S=_TEXT)
    if isinstance(dtype, T.StringType):
        # a nested value that lands in a string column stays JSON text
        return _tags(S=_TEXT, N=_TEXT, BOOL=T.BooleanType(), M=_TEXT, L=_TEXT)
    return _tags(N=_TEXT, S=_TEXT)


def wire_image(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, wire_type(f.dataType)) for f in schema])


def decode_value(value: Column, dtype: T.DataType) -> Column:
    """Plain value of a tagged one; null for NULL, absent or unreadable values."""
    if isinstance(dtype, T.StructType):
        image = value["M"]
        return F.when(image.isNotNull(), F.struct(*decode_image(image, dtype)))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value["M"], lambda _, v: decode_value(v, dtype.valueType))
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        return F.coalesce(
            F.transform(value["L"], lambda v: decode_value(v, element)),
            value["SS"].try_cast(T.ArrayType(element)),
            value["NS"].try_cast(T.ArrayType(element)),
        )
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(value["BOOL"], value["S"].try_cast(dtype))
    if isinstance(dtype, T.StringType):
        return F.coalesce(
            value["S"], value["N"], value["BOOL"].cast("string"), value["M"], value["L"]
        )
    return F.coalesce(value["N"], value["S"]).try_cast(dtype)


def decode_image(image: Column, schema: T.StructType) -> list[Column]:
    return [decode_value(image[f.name], f.dataType).alias(f.name) for f in schema]


def _tagged(value: Column, dtype: T.DataType) -> tuple[str, Column]:
    if isinstance(dtype, T.StructType):
        return "M", F.struct(*encode_image(value, dtype))
    if isinstance(dtype, T.MapType):
        return "M", F.transform_values(value, lambda _, v: encode_value(v, dtype.valueType))
    if isinstance(dtype, T.ArrayType):
        return "L", F.transform(value, lambda v: encode_value(v, dtype.elementType))
    if isinstance(dtype, T.BooleanType):
        return "BOOL", value
    if isinstance(dtype, T.NumericType):
        return "N", value.cast("string")
    return "S", value.cast("string")


def encode_value(value: Column, dtype: T.DataType) -> Column:
    """Tagged struct of a plain value; ``to_json`` drops the tag that stays null."""
    tag, plain = _tagged(value, dtype)
    return F.struct(
        F.when(value.isNotNull(), plain).alias(tag),
        F.when(value.isNull(), F.lit(True)).alias("NULL"),
    )


def encode_image(row: Column | None, schema: T.StructType) -> list[Column]:
    """Tagged columns of a struct, or of top-level columns when ``row`` is None."""
    return [
        encode_value(F.col(f.name) if row is None else row[f.name], f.dataType).alias(f.name)
        for f in schema
    ]
