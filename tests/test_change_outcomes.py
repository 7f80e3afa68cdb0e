"""What becomes of each line of a change stream, and images that are kept whole."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import plan, rows
from tidewater import paths
from tidewater.functions import cleaning
from tidewater.operators.keyed_table import KeyedTable
from tidewater.sources.change_outcomes import LANDED, OUTCOME, REASON, REASONS, read_accounts, read_landed, read_set_aside, sort_out
from tidewater.sources.change_records import decode_changes, landed_schema
from tidewater.sources.whole_images import discover_schema, typed, whole_images
from tidewater.streaming.ingest import ingest_stream, new_files
from tidewater.streaming.landing import change_stream, land_accounted, land_images

WIRE = T.StructType().add("ride_id", "string").add("value", "string").add("fare", "decimal(18,2)")


def record(event, image="NewImage", **values):
    tagged = {k: {"N" if k == "fare" else "S": v} for k, v in values.items()}
    return json.dumps({"eventName": event, "dynamodb": {image: tagged, "SequenceNumber": "7"}})


LINES = {
    record("INSERT", ride_id="r1", value="x", fare="1.5"): "landed",
    record(" remove ", "OldImage", ride_id="r2", fare="2"): "landed",
    record("REMOVE", "Keys", ride_id="r3"): "landed",
    record("Modify", ride_id="r4", fare="not a number"): "landed",
    "{broken": "malformed",
    "": "malformed",
    "null": "malformed",
    "[1, 2]": "malformed",
    '{"eventName":"INSERT","dynamodb":"oops"}': "malformed",
    '{"eventName":"INSERT","dynamodb":{"NewImage":[1]}}': "malformed",
    '{"eventName":"INSERT","dynamodb":{"NewImage":{"ride_id":"c"}}}': "malformed",
    '{"eventName":"INSERT","dynamodb":{"NewImage":{"ride_id":{"NULL":true}}}}': "no_key",
    '{"eventName":"INSERT","dynamodb":{"NewImage":{"fare":{"N":"1"}}}}': "no_key",
    '{"dynamodb":{"NewImage":{"ride_id":{"S":"a"}}}}': "no_event",
    '{"k":"c"}': "no_event",
    record("TRUNCATE", ride_id="r5"): "other_event",
    '{"eventName":"MODIFY","dynamodb":{}}': "no_image",
    '{"eventName":"MODIFY"}': "no_image",
    record("INSERT", "OldImage", ride_id="r6"): "no_image",
}


def text(spark, lines):
    return spark.createDataFrame([(x, i) for i, x in enumerate(lines)], "value string, n int")


def test_every_kind_of_line(spark):
    found = sort_out(text(spark, LINES), WIRE, ["ride_id"], sequence=True).collect()
    assert len(found) == len(LINES)
    for row, (line, reason) in zip(sorted(found, key=lambda r: r.n), LINES.items()):
        assert (row[REASON], row[OUTCOME]) == (reason, REASONS[reason]), line
        # landed lines are decoded, of the others the text is kept
        assert (row["_line"] is None) == (reason == "landed") == (row.ride_id is not None) == (row["_op"] is not None)
        assert row["_line"] in (None, line)
    decoded = decode_changes(text(spark, [x for x, r in LINES.items() if r == "landed"]), WIRE, sequence=True)
    same = ["ride_id", "value", "fare", "_op", "_seq"]
    landed = spark.createDataFrame(found, sort_out(text(spark, []), WIRE, ["ride_id"], sequence=True).schema).where(F.col(OUTCOME) == LANDED)
    assert rows(landed.select(same)) == rows(decoded.select(same))


def test_null_lines_and_empty_batches(spark):
    nulls = spark.createDataFrame([(None,), (None,)], "value string")
    assert [r[REASON] for r in sort_out(nulls, WIRE, ["ride_id"]).collect()] == ["malformed"] * 2
    assert sort_out(nulls.limit(0), WIRE, ["ride_id"]).collect() == []


def test_one_parse(spark):
    found = plan(sort_out(text(spark, LINES), WIRE, ["ride_id"]))
    assert found.count("from_json(") == found.count("Generate explode(") == 1


def landing(spark, folder, **options):
    return land_accounted(
        change_stream(spark, f"{folder}/changes", max_files=1), WIRE, ["ride_id"], f"{folder}/raw", f"{folder}/accounts",
        f"{folder}/state", **options,
    )


def test_accounts_add_up_and_nothing_is_lost(spark, folder):
    for i in range(3):
        text(spark, LINES).select("value").coalesce(1).write.mode("append").text(f"{folder}/changes")
    for _ in range(2):
        landing(spark, folder).awaitTermination()
    accounts = read_accounts(spark, f"{folder}/accounts").collect()
    assert {r.batch for r in accounts} == {0, 1, 2}
    assert Counter({r.reason: 0 for r in accounts}) + Counter(LINES.values()) == Counter({r.reason: r.lines for r in accounts if r.batch == 1})
    assert {r.reason: r.outcome for r in accounts} == REASONS
    aside = [r["_line"] for r in read_set_aside(spark, f"{folder}/raw").collect()]
    assert Counter(aside) == Counter([x for x, r in LINES.items() if r != "landed"] * 3)
    assert Counter(r.ride_id for r in read_landed(spark, f"{folder}/raw", WIRE).collect()) == {f"r{i}": 3 for i in range(1, 5)}


def test_repeated_batch_replaces_itself(spark, folder, monkeypatch):
    """The batch is written, then the stream dies before its accounts are."""
    text(spark, LINES).select("value").coalesce(1).write.text(f"{folder}/changes")

    def crash(*args):
        raise OSError("lost driver")

    with monkeypatch.context() as patch:
        patch.setattr(paths, "write_json", crash)
        with pytest.raises(Exception, match="lost driver"):
            landing(spark, folder).awaitTermination()
    landing(spark, folder).awaitTermination()
    assert read_landed(spark, f"{folder}/raw", WIRE).count() == 4
    assert sum(r.lines for r in read_accounts(spark, f"{folder}/accounts").collect()) == len(LINES)


def test_landed_lines_go_on_into_a_table(spark, folder):
    text(spark, LINES).select("value").write.text(f"{folder}/changes")
    landing(spark, folder, sequence=True).awaitTermination()
    table = KeyedTable.create(spark, f"{folder}/silver", WIRE, "ride_id", "ride_id", ordered=True)
    files = new_files(spark, f"{folder}/raw/*/{OUTCOME}={LANDED}", landed_schema(WIRE, sequence=True))
    ingest_stream(files, table, f"{folder}/state2").awaitTermination()
    assert rows(table.snapshot().select("ride_id")) == [("r1",), ("r4",)]


# ---- whole images ----------------------------------------------------------------------


NEW = json.dumps({"eventName": "INSERT", "dynamodb": {"NewImage": {
    "ride_id": {"S": "r9"}, "fare": {"N": "2.5"}, "o'k x": {"S": "odd name"}, "on": {"BOOL": True}, "gone": {"NULL": True},
    "place": {"M": {"city": {"S": "X"}, "at": {"M": {"lat": {"N": "1.25"}}}}}, "tags": {"SS": ["a", "b"]}, "sizes": {"L": [{"N": "1"}, {"N": "2"}]},
    "mixed": {"N": "1"}, "none": {"M": {}},
}}})
OTHER = json.dumps({"eventName": "MODIFY", "dynamodb": {"NewImage": {"ride_id": {"S": "r8"}, "mixed": {"S": "one"}, "on": {"NULL": True}}}})


def test_schema_of_all_images(spark):
    images = whole_images(text(spark, [NEW, OTHER, *LINES]))
    schema = discover_schema(images)
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    assert kinds == {
        "ride_id": "string", "fare": "double", "value": "string", "o'k x": "string", "on": "boolean", "gone": "string",
        "place": "struct<at:struct<lat:double>,city:string>", "tags": "array<string>", "sizes": "array<double>", "mixed": "string", "none": "string",
    }
    found = {r.ride_id: r for r in typed(images, schema).collect() if r.ride_id}
    new, other = found["r9"], found["r8"]
    assert (new.fare, new["o'k x"], new.on, new.gone, new.mixed, new.none) == (2.5, "odd name", True, None, "1", "{}")
    assert new.place["at"].lat == 1.25 and new.place.city == "X" and new.tags == ["a", "b"] and new.sizes == [1.0, 2.0]
    assert (other.mixed, other.on, other.place) == ("one", None, None)
    # lines that land elsewhere have no image here
    assert set(found) == {"r9", "r8", "r1", "r2", "r3", "r4"} and found["r2"]["_op"] == "D"


def test_no_images_have_no_schema(spark):
    images = whole_images(text(spark, ["{broken"]))
    assert discover_schema(images) == T.StructType() and typed(images, discover_schema(images)).collect() == []


def test_attribute_of_rows_that_landed_before_anybody_named_it(spark, folder):
    for line in (NEW, OTHER):
        spark.createDataFrame([(line,)], "value string").write.mode("append").text(f"{folder}/changes")
        land_images(change_stream(spark, f"{folder}/changes"), f"{folder}/raw", f"{folder}/state", sequence=True).awaitTermination()
    images = spark.read.parquet(f"{folder}/raw")
    old = T.StructType().add("ride_id", "string")
    assert rows(typed(images, old).select("ride_id")) == [("r8",), ("r9",)]
    later = T.StructType([*old.fields, T.StructField("place", T.StructType().add("city", "string"))])
    assert rows(typed(images, later).select("ride_id", "place.city")) == [("r8", None), ("r9", "X")]


# ---- small functions -------------------------------------------------------------------


def test_flatten_refuses_equal_names(spark):
    df = spark.sql("SELECT 1 AS a_b, struct(2 AS b) AS a")
    with pytest.raises(ValueError, match="a_b"):
        cleaning.flatten(df)
    assert cleaning.flatten(df, sep=".").columns == ["a_b", "a.b"]


def test_to_schema_takes_names_with_dots(spark):
    df = spark.createDataFrame([("1", "2")], "`a.b` string, `c.d` string")
    found = cleaning.to_schema(df, T.StructType().add("a.b", "integer").add("e.f", "string"))
    assert [tuple(r) for r in found.collect()] == [(1, None, "2")] and found.columns == ["a.b", "e.f", "c.d"]


def test_sql_transform_gives_the_view_back(spark):
    spark.range(3).createOrReplaceTempView("temp")
    df = spark.createDataFrame([("x",)], "k string")
    assert rows(cleaning.sql_transform(df, "SELECT upper(k) AS k FROM temp;")) == [("X",)]
    assert spark.table("temp").count() == 3
    with pytest.raises(Exception, match="nowhere"):
        cleaning.sql_transform(df, "SELECT nowhere FROM temp")
    assert spark.table("temp").count() == 3
    spark.catalog.dropTempView("temp")
    cleaning.sql_transform(df, "SELECT k FROM temp")
    assert not spark.catalog.tableExists("temp")
