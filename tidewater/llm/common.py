"""Small helpers of the operators in this folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewater.session import shared_dir

#: What separates words: the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back, so that its lineage
    ends there and a lost executor costs no recomputation."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def not_broadcast(df: DataFrame) -> DataFrame:
    """The frame as a side of a join that may grow with the table and is sorted, not broadcast.

    Catalyst sizes a frame by stored bytes and by types: an array counts as one element, an
    explode as no rows more, compressed columns as what they take in the file.  So it may
    broadcast many times what it may, and adaptive execution, which learns the true size,
    keeps a broadcast where any other join takes one more exchange.
    """
    return df.hint("merge")


def n_words(text: Column | str) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def parts(rows: int, each: int) -> int:
    """How many groups of at most about ``each`` rows hold ``rows``."""
    return max(1, -(-rows // each))


def held_out(doc_id: Column | str, modulus: int, remainder: int) -> Column:
    """Whether ``crc32`` of the id as text leaves this remainder; false for a null id."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    crc = F.crc32(doc_id.cast("string"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


def slices(batches: Iterable[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The batches cut into pieces of at most ``rows`` rows; bounds what a step holds."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.iloc[start : start + rows]


def whole_columns(pdf: pd.DataFrame) -> pd.DataFrame:
    """Text columns as plain objects: those of several Arrow batches can't be handed back in
    pieces."""
    return pdf.astype({c: object for c, kind in pdf.dtypes.items() if pd.api.types.is_string_dtype(kind)})
