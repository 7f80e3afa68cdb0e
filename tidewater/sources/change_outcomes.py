"""What becomes of every line of a change stream, decided in one parse.

====================  ===========  ==========================================================
outcome               reason       line
====================  ===========  ==========================================================
landed                landed       decoded, its key is there
quarantined           malformed    no JSON object, or a record or image of another shape
quarantined           no_event     a record that names no event
quarantined           no_key       a key attribute is missing or unreadable
ignored               other_event  an event that is no insert, modify or remove
ignored               no_image     an event without the image that it needs
====================  ===========  ==========================================================
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewater.functions.attributes import decode_image
from tidewater.operators.latest import OP, SEQ
from tidewater.sources.change_records import landed_schema, parse_changes, picked_image

OUTCOME, REASON, LINE = "_outcome", "_reason", "_line"
LANDED, QUARANTINED, IGNORED = "landed", "quarantined", "ignored"
REASONS = {
    "landed": LANDED, "malformed": QUARANTINED, "no_event": QUARANTINED, "no_key": QUARANTINED,
    "other_event": IGNORED, "no_image": IGNORED,
}


def sort_out(
    df: DataFrame,
    schema: T.StructType,
    keys: Sequence[str],
    value: str = "value",
    deletes: str = "tombstone",
    sequence: bool = False,
) -> DataFrame:
    """Every line of ``df`` with its ``_outcome`` and ``_reason``, batch or streaming.

    Landed lines are decoded as by :func:`decode_changes`; of the others the decoded columns
    are null and ``_line`` holds the text.  No line is lost or doubled.
    """
    kept = [F.col(c) for c in df.columns if c != value]
    # under a name of its own, as the schema may have a column like the text's
    lines = df.select(*kept, F.col(value).alias(LINE))
    parsed = parse_changes(lines, schema, LINE, "PERMISSIVE", corrupt="_broken")
    event = F.lower(F.trim(F.col("_record.eventName")))
    image, op = picked_image(event, deletes)
    rows = parsed.select(
        *kept, LINE, event.alias("_event"), image.alias("_image"), op.alias(OP),
        (F.col("_record").isNull() | F.col("_record._broken").isNotNull()).alias("_bad"),
        F.col("_record.dynamodb.SequenceNumber").alias(SEQ),
    )
    no_image = F.col("_image").isNull().alias("_no_image")
    decoded = rows.select(*kept, LINE, "_event", no_image, "_bad", OP, SEQ, *decode_image(F.col("_image"), schema))
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(f"`{key}`").isNull()
    reason = (
        F.when(F.col("_bad"), "malformed").when(F.col("_event").isNull(), "no_event")
        .when(~F.col("_event").isin("insert", "modify", "remove"), "other_event")
        .when(F.col("_no_image"), "no_image").when(no_key, "no_key").otherwise("landed")
    )
    decoded = decoded.withColumn(REASON, reason)
    landed = F.col(REASON) == "landed"

    def only(name: str) -> Column:
        return F.when(landed, F.col(f"`{name}`")).alias(name)

    return decoded.select(
        *kept, *[only(f.name) for f in schema], only(OP), *([only(SEQ)] if sequence else []),
        F.when(~landed, F.col(LINE)).alias(LINE), _outcome(REASON).alias(OUTCOME), REASON,
    )


def _outcome(reason: str) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair]), F.col(reason))


def read_landed(spark: SparkSession, target: str, schema: T.StructType, sequence: bool = False) -> DataFrame:
    """The decoded lines below the folder of an accounted landing."""
    stored = T.StructType([*landed_schema(schema, sequence).fields, T.StructField(OUTCOME, T.StringType())])
    rows = spark.read.schema(stored).option("basePath", target).parquet(target)
    return rows.where(F.col(OUTCOME) == LANDED).drop(OUTCOME)


def read_set_aside(spark: SparkSession, target: str) -> DataFrame:
    """The text, outcome and reason of the lines that were quarantined or ignored."""
    rows = spark.read.schema(f"{LINE} string, {REASON} string, {OUTCOME} string").option("basePath", target).parquet(target)
    return rows.where(F.col(OUTCOME) != LANDED)


def read_accounts(spark: SparkSession, accounts: str) -> DataFrame:
    """``batch, outcome, reason, lines`` of every landed micro-batch."""
    found = spark.read.schema("batch long, counts map<string, long>").json(accounts)
    return found.select("batch", F.explode("counts").alias("reason", "lines")).select(
        "batch", _outcome("reason").alias("outcome"), "reason", "lines"
    )
