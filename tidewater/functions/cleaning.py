"""Null and sentinel handling, typing, flattening, surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# fixed values: the placeholder and the texts that count as missing
MISSING = "n/a"
MISSING_TEXTS = ("None", "null", "")


def fill_nulls(
    df: DataFrame, columns: Sequence[str] | None = None, value: str = MISSING
) -> DataFrame:
    """Null becomes the placeholder in string columns; other types keep null."""
    return df.na.fill(value, None if columns is None else list(columns))


def clean_text(df: DataFrame) -> DataFrame:
    """Every column as a string, with null and the missing texts replaced.

    The match is exact: no trimming, no case folding.
    """
    cleaned = []
    for field in df.schema:
        text = F.col(f"`{field.name}`").cast("string")
        missing = text.isNull() | text.isin(*MISSING_TEXTS)
        cleaned.append(F.when(missing, MISSING).otherwise(text).alias(field.name))
    return df.select(cleaned)


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns with its types; a value that does not fit becomes null.

    Columns the input lacks come out as null, so a partial image still lines up.
    Run this before :func:`fill_nulls`: the placeholder is no number and no date.
    """
    have = set(df.columns)
    typed = [
        F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
        if f.name in have
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    extra = [F.col(f"`{c}`") for c in df.columns if c not in set(schema.fieldNames())]
    return df.select(*typed, *extra)


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    found = []
    for field in schema:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            found.extend(_leaves(field.dataType, here))
        else:
            found.append(here)
    return found


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """One top-level column per struct leaf, named by its path.

    Two leaves of one name are an error: take another separator.
    """
    leaves = _leaves(df.schema)
    names = [sep.join(path) for path in leaves]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"several columns would be named {twice}")
    return df.select(
        [F.col(".".join(f"`{part}`" for part in path)).alias(name) for path, name in zip(leaves, names)]
    )


def surrogate_key(*columns: str | Column) -> Column:
    """SHA-256 hex of one column, or of the JSON list of several.

    Nulls and separators inside values keep their place in the list, so different rows
    have different texts.
    """
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.sha2(parts[0] if len(parts) == 1 else F.to_json(F.array(*parts)), 256)


def sql_transform(df: DataFrame, query: str, view: str = "temp") -> DataFrame:
    """Run user SQL over the rows, which the query sees as view ``temp``.

    A view of that name that the caller has is there again afterwards.
    """
    spark = df.sparkSession
    known = spark.catalog.tableExists(view) and spark.catalog.getTable(view).isTemporary
    own = spark.table(view) if known else None
    df.createOrReplaceTempView(view)
    try:
        # resolved here, so the result doesn't look at the view again
        return spark.sql(query)
    finally:
        spark.catalog.dropTempView(view) if own is None else own.createOrReplaceTempView(view)


def split_names(names: str | Sequence[str]) -> tuple[str, ...]:
    """``"driver_id,ride_id"`` or a sequence of names, as a tuple."""
    parts = names.split(",") if isinstance(names, str) else names
    return tuple(part.strip() for part in parts if part.strip())
