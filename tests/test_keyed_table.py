import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from tests.conftest import plan, rows
from tidewater import paths
from tidewater.operators import catalog, maintenance
from tidewater.operators.keyed_table import HistoryLost, KeyedTable
from tidewater.operators.latest import latest_per_key, newest_first

DDL = "k string, state string, v int, seq int"


@pytest.fixture
def make(spark, folder):
    def build(name="t", schema=DDL, key="k", precombine="seq", **options):
        fields = spark.createDataFrame([], schema).schema
        return KeyedTable.create(spark, f"{folder}/{name}", fields, key, precombine, **options)

    return build


def batch(spark, *values, schema=DDL):
    return spark.createDataFrame(list(values), schema)


def test_upsert_updates_and_inserts(spark, make):
    t = make()
    assert t.upsert(batch(spark, ("a", "CA", 1, 1), ("b", "CA", 2, 1))) == 1
    assert t.upsert(batch(spark, ("b", "CA", 20, 0), ("c", "TX", 3, 1))) == 2
    assert rows(t.snapshot().select("k", "v")) == [("a", 1), ("b", 20), ("c", 3)]


def test_batch_keeps_greatest_precombine(spark, make):
    t = make()
    t.upsert(batch(spark, ("a", "CA", 1, 1), ("a", "CA", 3, 3), ("a", "CA", 2, 2), ("a", "CA", 0, None)))
    assert rows(t.snapshot()) == [("a", "CA", 3, 3)]


def test_tie_break_does_not_depend_on_row_order(spark, make):
    versions = [("a", "CA", v, 1) for v in range(20)]
    for name, order in (("up", versions), ("down", versions[::-1])):
        t = make(name)
        t.upsert(batch(spark, *order).repartition(5))
        assert rows(t.snapshot()) == [("a", "CA", 19, 1)]


def test_upsert_is_idempotent(spark, make):
    t = make()
    df = batch(spark, ("a", "CA", 1, 1), ("b", "TX", 2, 1))
    t.upsert(df)
    before = rows(t.snapshot())
    t.upsert(df)
    assert rows(t.snapshot()) == before


def test_empty_batch_writes_nothing(spark, make):
    t = make(partition_fields="state")
    assert t.upsert(batch(spark)) is None
    assert t.commits() == [] and t.snapshot().isEmpty()
    t.upsert(batch(spark, ("a", "CA", 1, 1)))
    assert t.upsert(batch(spark)) is None
    assert t.commits() == [1]


def test_global_and_partition_scope(spark, make):
    first, second = batch(spark, ("a", "CA", 1, 1)), batch(spark, ("a", "TX", 2, 2))
    for scope, expected in (("global", [("a", "TX")]), ("partition", [("a", "CA"), ("a", "TX")])):
        t = make(scope, partition_fields="state", scope=scope)
        t.upsert(first)
        maintenance.compact(t)
        t.upsert(second)
        assert rows(t.snapshot().select("k", "state")) == expected


def test_null_partition_value_is_one_partition(spark, make):
    t = make(partition_fields="state", scope="partition")
    t.upsert(batch(spark, ("a", None, 1, 1)))
    maintenance.compact(t)
    t.upsert(batch(spark, ("a", None, 2, 2)))
    assert rows(t.snapshot()) == [("a", None, 2, 2)]


def test_partition_text_keeps_its_zeros(spark, make):
    t = make(partition_fields="state")
    t.upsert(batch(spark, ("a", "007", 1, 1)))
    maintenance.compact(t)
    assert rows(t.snapshot()) == [("a", "007", 1, 1)]


def test_composite_key(spark, make):
    t = make(key="k,state")
    t.upsert(batch(spark, ("a", "CA", 1, 1), ("a", "TX", 2, 1)))
    t.upsert(batch(spark, ("a", "TX", 3, 2)))
    assert rows(t.snapshot().select("k", "state", "v")) == [("a", "CA", 1), ("a", "TX", 3)]


def test_null_key_is_refused(spark, make):
    t = make()
    with pytest.raises(PySparkException, match="null in record key"):
        t.upsert(batch(spark, (None, "CA", 1, 1)))
    assert t.commits() == []
    t.upsert(batch(spark, ("a", "CA", 1, 1)))
    assert t.snapshot().count() == 1


def test_delete_by_value(spark, make):
    t = make()
    t.upsert(batch(spark, ("a", "CA", 1, 1), ("b", "CA", 2, 1), ("it's", "CA", 3, 1)))
    assert t.delete("k", "it's") == 2
    assert t.delete("k", "it's") is None
    maintenance.compact(t)
    assert t.delete("v", 1) == 3
    assert rows(t.snapshot().select("k")) == [("b",)]
    t.upsert(batch(spark, ("a", "TX", 9, 9)))
    assert rows(t.snapshot().select("k")) == [("a",), ("b",)]


def test_delete_keys(spark, make):
    t = make()
    t.upsert(batch(spark, *[(f"k{i}", "CA", i, 1) for i in range(20)]))
    t.delete_keys(t.snapshot().where("v % 2 = 0").select("k"))
    assert t.snapshot().count() == 10


def test_batch_may_carry_deletes(spark, make):
    t = make()
    t.upsert(batch(spark, ("a", "CA", 1, 1), ("b", "CA", 2, 1)))
    changes = batch(spark, ("a", None, None, 2, "D"), ("b", "CA", 3, 2, "D"), ("b", "CA", 4, 3, "U"),
                    schema=DDL + ", _op string")
    t.upsert(changes)
    assert rows(t.snapshot().select("k", "v")) == [("b", 4)]


def test_incremental(spark, make):
    t = make()
    t.upsert(batch(spark, ("a", "CA", 1, 1), ("b", "CA", 2, 1)))
    t.upsert(batch(spark, ("b", "CA", 3, 2), ("c", "CA", 4, 2)))
    t.delete("k", "a")
    t.upsert(batch(spark, ("c", "CA", 5, 3)))
    assert rows(t.incremental(1).select("k", "v")) == [("b", 3), ("c", 5)]
    assert rows(t.incremental(1, 2).select("k", "v")) == [("b", 3), ("c", 4)]
    assert rows(t.incremental(2, deletes=True).select("k", "_op")) == [("a", "D"), ("c", "U")]
    assert t.incremental(4).isEmpty()
    assert rows(t.incremental(0)) == rows(t.snapshot())
    assert rows(t.incremental(None)) == rows(t.snapshot())
    assert rows(t.before_images(1).select("k", "v")) == [("a", 1), ("b", 2)]


def test_as_of_is_stable(spark, make):
    t = make()
    seen = {}
    for c in range(1, 6):
        t.upsert(batch(spark, (f"k{c % 3}", "CA", c, c), ("x", "TX", c, c)))
        if c == 4:
            t.delete("k", "k0")
        if c in (2, 4):
            maintenance.compact(t)
        seen[t.last_commit()] = rows(t.snapshot())
    for commit, expected in seen.items():
        assert rows(t.snapshot(commit)) == expected


def test_compaction_and_clustering_leave_the_rows(spark, make):
    t = make(partition_fields="state", cluster_columns="v")
    t.upsert(batch(spark, *[(f"k{i}", f"s{i % 3}", i % 7, i) for i in range(200)]))
    t.upsert(batch(spark, *[(f"k{i}", f"s{i % 2}", i, i) for i in range(50)]))
    t.delete("k", "k7")
    before = rows(t.snapshot(with_commit=True))
    assert maintenance.compact(t) and maintenance.compact(t) is None
    assert rows(t.snapshot(with_commit=True)) == before
    assert maintenance.cluster(t).rev == 2
    assert rows(t.snapshot(with_commit=True)) == before
    t.upsert(batch(spark, ("k1", "s0", 5, 500)))
    assert t.snapshot().count() == len(before)


def test_clustering_splits_a_hot_value(spark, make):
    t = make()
    t.upsert(spark.range(6000).select(
        F.col("id").cast("string").alias("k"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("s"), F.col("id"))).otherwise("hot").alias("state"),
        F.col("id").cast("int").alias("v"), F.lit(1).alias("seq")))
    base = maintenance.cluster(t, "state", target_file_bytes=t.usage([1])[0].bytes // 6)
    written = spark.read.parquet(base.path).withColumn("f", F.input_file_name())
    per_file = [r["count"] for r in written.groupBy("f").count().collect()]
    assert len(per_file) >= 5 and max(per_file) < 6000 / 3
    hot_files = written.where("state = 'hot'").select("f").distinct().count()
    assert hot_files >= 3


@pytest.mark.parametrize("job", ["compact", "cluster"])
def test_one_task_sorts_a_bounded_part(spark, make, monkeypatch, job):
    t = make()
    t.upsert(spark.range(6000).repartition(8).select(
        F.col("id").cast("string").alias("k"), F.concat(F.lit("s"), F.col("id") % 7).alias("state"),
        F.col("id").cast("int").alias("v"), F.lit(1).alias("seq")))
    before = rows(t.snapshot())
    for i in range(12):  # a commit each, so many small files
        t.upsert(batch(spark, (str(i), "CA", -i, 2)))
    stored = sum(part.bytes for part in t.usage(t.commits()))
    # the files may be larger than what one task sorts
    monkeypatch.setattr(maintenance, "SORTED_BYTES", stored // 4)
    base = maintenance.cluster(t, "state") if job == "cluster" else maintenance.compact(t)
    per_file = [r["count"] for r in spark.read.parquet(base.path).groupBy(F.input_file_name()).count().collect()]
    assert 4 <= len(per_file) <= 5 and max(per_file) < 6000 / 2
    changed = {str(i): (str(i), "CA", -i, 2) for i in range(12)}
    assert rows(t.snapshot()) == sorted((changed.get(r[0], r) for r in before), key=repr)


def test_commits_are_ranked_without_a_sort_before_the_exchange(spark, make):
    t = make()
    t.upsert(batch(spark, ("a", "CA", 1, 1), ("b", "CA", 1, 1), ("c", "CA", 1, 1)))
    t.upsert(batch(spark, ("a", "CA", 2, 0), ("d", "CA", 2, 1)))
    t.delete("k", "b")
    assert rows(t.snapshot()) == [("a", "CA", 2, 0), ("c", "CA", 1, 1), ("d", "CA", 2, 1)]
    assert rows(t.incremental(1)) == [("a", "CA", 2, 0), ("d", "CA", 2, 1)]
    # a key has a row in each commit at most, so a sort on the way there takes none away
    assert "WindowGroupLimit" not in plan(t.snapshot())
    # rows that nobody has counted by key are cut down first
    some = batch(spark, *[("a", "CA", v, v) for v in range(9)])
    ranked = latest_per_key(some, ["k"], newest_first(some, ["k"], ["seq"]))
    assert "WindowGroupLimit" in plan(ranked) and rows(ranked) == [("a", "CA", 8, 8)]


def test_commit_listing(spark, make):
    t = make()
    assert maintenance.show_commits(t).isEmpty()
    for i in range(7):
        t.upsert(batch(spark, ("a", "CA", i, i), (f"b{i}", "CA", i, i)))
    t.delete("k", "a")
    listed = maintenance.show_commits(t).collect()
    assert [r["commit"] for r in listed] == [8, 7, 6, 5, 4]
    assert [(r.upserts, r.deletes) for r in listed] == [(0, 1)] + [(2, 0)] * 4
    assert all(r.committed_at is not None for r in listed)
    assert maintenance.show_commits(t, 100).count() == 8


def test_savepoint_survives_vacuum(spark, make):
    t = make()
    for i in range(1, 9):
        t.upsert(batch(spark, ("a", "CA", i, i), (f"b{i}", "CA", i, i)))
        if i == 3:
            pinned = rows(t.snapshot())
            assert maintenance.create_savepoint(t, "keep") == 3
        if i == 7:
            seventh = rows(t.snapshot())
        if i in (2, 5, 6, 7):
            maintenance.compact(t)
    before = rows(t.snapshot())
    assert len(t.bases()) == 4
    gone = maintenance.vacuum(t, keep=2)
    assert [b.upto for b in t.bases()] == [2, 6, 7]
    assert t.commits() == [3, 7, 8] and len(gone) == 6
    assert rows(t.snapshot()) == before
    assert rows(t.snapshot(3)) == pinned
    assert rows(t.snapshot(7)) == seventh
    with pytest.raises(HistoryLost):
        t.snapshot(4)
    with pytest.raises(HistoryLost):
        t.incremental(5)
    assert rows(t.incremental(7).select("k", "v")) == [("a", 8), ("b8", 8)]
    with pytest.raises(HistoryLost):
        maintenance.create_savepoint(t, "late", commit=4)
    assert rows(maintenance.show_savepoints(t)) == [("keep", 3)]


def test_vacuum_keeps_three_versions_by_default(spark, make):
    t = make()
    for i in range(1, 6):
        t.upsert(batch(spark, ("a", "CA", i, i)))
        maintenance.compact(t)
        maintenance.vacuum(t)
    assert [b.upto for b in t.bases()] == [3, 4, 5]
    assert t.upsert(batch(spark, ("a", "CA", 6, 6))) == 6
    assert rows(t.snapshot()) == [("a", "CA", 6, 6)]


def test_unfinished_commit_is_invisible(spark, make):
    t = make()
    t.upsert(batch(spark, ("a", "CA", 1, 1)))
    t.upsert(batch(spark, ("a", "CA", 2, 2)))
    paths.delete(spark, f"{t.commit_path(2)}/_SUCCESS")
    assert rows(t.snapshot()) == [("a", "CA", 1, 1)]
    assert t.upsert(batch(spark, ("b", "CA", 3, 3))) == 3
    assert rows(t.snapshot().select("k")) == [("a",), ("b",)]


def test_replayed_batch_is_written_once(spark, make):
    t = make()
    df = batch(spark, ("a", "CA", 1, 1))
    assert t.upsert(df, source=("s", 0)) == 1
    assert t.upsert(df, source=("s", 0)) is None
    assert t.upsert(batch(spark, ("a", "CA", 2, 2)), source=("s", 1)) == 2
    assert t.upsert(df, source=("s", 0)) is None
    maintenance.compact(t)
    maintenance.vacuum(t, keep=1)
    assert t.upsert(df, source=("s", 1)) is None
    assert rows(t.snapshot()) == [("a", "CA", 2, 2)]


def test_broken_off_batch_is_repeated(spark, make, monkeypatch):
    def broken(*args):
        raise OSError("lost")

    t = make()
    df = batch(spark, ("a", "CA", 1, 1))
    for attempt in range(2):
        with monkeypatch.context() as patch:
            patch.setattr(t, "_append", broken)
            with pytest.raises(OSError):
                t.upsert(df, source=("s", 0))
    assert t.commits(finished=False) == [1]  # both attempts had the same number
    # another commit and a compaction pass it by, so it gets a number after them
    assert t.upsert(batch(spark, ("b", "CA", 2, 2))) == 2
    maintenance.compact(t)
    maintenance.vacuum(t, keep=1)
    assert t.upsert(df, source=("s", 0)) == 3
    assert t.upsert(df, source=("s", 0)) is None
    assert rows(t.snapshot().select("k")) == [("a",), ("b",)]
    assert rows(t.incremental(2).select("k")) == [("a",)]


def test_table_definition_is_checked(spark, make):
    make()
    assert make().record_key == ("k",)
    with pytest.raises(ValueError, match="another definition"):
        make(key="v")
    with pytest.raises(ValueError, match="not in the schema"):
        make("u", key="nope")
    with pytest.raises(ValueError, match="scope"):
        make("u", scope="bloom")


def test_register_in_catalog(spark, make, folder):
    t = make(partition_fields="state")
    t.upsert(batch(spark, ("a", "007", 1, 1), ("b", "TX", 2, 1)))
    name = catalog.register(t, "silver_test", "t", f"{folder}/db")
    assert rows(spark.sql(f"SELECT k, state, v FROM {name}")) == [("a", "007", 1), ("b", "TX", 2)]
    t.upsert(batch(spark, ("b", "TX", 3, 2)))
    catalog.register(t, "silver_test", "t")
    assert rows(spark.sql(f"SELECT k, state, v FROM {name}")) == [("a", "007", 1), ("b", "TX", 3)]
    catalog.unregister(t, "silver_test", "t")
    assert not spark.catalog.tableExists(name) and t.snapshot().count() == 2
    spark.sql("DROP DATABASE silver_test CASCADE")


@pytest.mark.parametrize("options", [{}, {"partition_fields": "state"}])
def test_catalog_name_follows_compaction_and_retention(spark, make, folder, options):
    t = make(name="it's", **options)
    t.upsert(batch(spark, ("a", "CA", 1, 1)))
    name = catalog.register(t, "silver_follow", "t", f"{folder}/db")
    spark.sql("CREATE OR REPLACE VIEW silver_follow.total AS SELECT sum(v) AS v FROM silver_follow.t")
    for i in range(2, 6):
        t.upsert(batch(spark, (f"k{i}", "TX", i, 1)))
        maintenance.compact(t)
        maintenance.vacuum(t, keep=1)
        assert rows(spark.sql(f"SELECT * FROM {name}")) == rows(t.snapshot())
    maintenance.cluster(t, "v")
    assert spark.sql("SELECT v FROM silver_follow.total").first().v == 15
    assert len(spark.catalog.listTables("silver_follow", "t_upto_*")) == 1
    spark.sql("DROP DATABASE silver_follow CASCADE")


def test_vacuum_spares_a_shown_base(spark, make):
    t = make()
    for i in range(1, 3):
        t.upsert(batch(spark, ("a", "CA", i, i)))
        maintenance.compact(t)
    entry = {"database": "d", "name": "t", "location": None, "base": [1, 1]}
    paths.write_json(spark, f"{t.path}/registered.json", {"`d`.`t`": entry})
    maintenance.vacuum(t, keep=1)
    assert [(b.upto, b.rev) for b in t.bases()] == [(1, 1), (2, 1)]


def test_vacuum_removes_broken_off_bases(spark, make):
    t = make()
    t.upsert(batch(spark, ("a", "CA", 1, 1)))
    half = f"{t.path}/base/upto=1/rev=1"
    paths.make_dir(spark, half)
    base = maintenance.compact(t)
    running = f"{t.path}/base/upto=1/rev=3"
    paths.make_dir(spark, running)
    gone = maintenance.vacuum(t, keep=1)
    assert base.rev == 2 and len(gone) == 2 and not paths.exists(spark, half)
    assert paths.exists(spark, running) and t.snapshot().count() == 1


def test_lost_retention_file_is_an_error(spark, make):
    t = make()
    for i in range(1, 4):
        t.upsert(batch(spark, ("a", "CA", i, i)))
        maintenance.compact(t)
    maintenance.vacuum(t, keep=1)
    paths.delete(spark, f"{t.path}/retention.json")
    with pytest.raises(HistoryLost):
        t.incremental(1)
    assert t.snapshot().count() == 1
    maintenance.vacuum(t, keep=1)
    assert t.floor() == 3


def test_state_is_written_in_place_on_object_stores(spark, folder, monkeypatch):
    monkeypatch.setattr(paths, "OBJECT_STORES", ("file",))
    for value in ({"a": 1}, {"a": 2}):
        paths.write_json(spark, f"{folder}/deep/state.json", value)
        assert paths.read_json(spark, f"{folder}/deep/state.json") == value
    assert len(paths.glob(spark, f"{folder}/deep/*")) == 1


def test_clustered_commit_has_ranges(spark, make):
    """Files of one commit don't overlap in the clustered column, but for a hot value."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t = make(cluster_columns="state")
        t.upsert(spark.range(4000).select(
            F.col("id").cast("string").alias("k"),
            F.format_string("s%04d", F.hash("id") % 1000 + 1000).alias("state"),
            F.col("id").cast("int").alias("v"), F.lit(1).alias("seq")))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    stored = t.read_log([1]).groupBy(F.input_file_name().alias("f"))
    bounds = sorted((r.lo, r.hi) for r in stored.agg(F.min("state").alias("lo"), F.max("state").alias("hi")).collect())
    assert len(bounds) > 1
    assert all(left[1] <= right[0] for left, right in zip(bounds, bounds[1:]))


def test_files_are_partitioned_and_compressed(spark, make):
    t = make(partition_fields="state", max_records_per_file=10)
    t.upsert(batch(spark, *[(f"k{i}", "CA", i, 1) for i in range(35)]))
    files = paths.glob(spark, f"{t.commit_path(1)}/state=CA/*.gz.parquet")
    assert len(files) >= 4


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    shown = plan(latest_per_key(df, ["k"], newest_first(df, ["k"], ["v"])))
    partial, exchange = shown.index("Partial"), shown.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in shown and exchange < partial  # printed from the top down


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of the rows share a key; hardly any of them reach the reducer."""
    n = 30_000
    df = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    out = latest_per_key(df, ["k"], newest_first(df, ["k"], ["v"]))
    assert out.count() == n * 2 // 3 + 1
    assert out.where("k = 'hot'").first().v == n - 3


def test_snapshot_does_not_shuffle_the_base(spark, make):
    t = make()
    t.upsert(batch(spark, *[(f"k{i}", "CA", i, 1) for i in range(100)]))
    maintenance.compact(t)
    t.upsert(batch(spark, ("k1", "CA", 5, 5)))
    shown = plan(t.snapshot())
    assert "Exchange hashpartitioning" not in shown and "LeftAnti" in shown


def test_incremental_reads_only_new_commits(spark, make):
    t = make()
    for i in range(4):
        t.upsert(batch(spark, (f"k{i}", "CA", i, 1)))
    files = t.incremental(2).inputFiles()
    assert files and all("_commit=3" in f or "_commit=4" in f for f in files)


def test_filter_and_columns_reach_the_scan(spark, make):
    t = make(partition_fields="state")
    t.upsert(batch(spark, ("a", "CA", 1, 1), ("b", "TX", 2, 1)))
    maintenance.compact(t)
    shown = plan(t.snapshot().where("state = 'CA' AND v > 0").select("k"))
    assert "PartitionFilters: [isnotnull(state" in shown and "GreaterThan(v,0)" in shown
    assert "seq" not in shown.split("ReadSchema")[1]


def test_large_log_spares_untouched_partitions(spark, make, monkeypatch):
    t = make(partition_fields="state", scope="partition")
    t.upsert(batch(spark, *[(f"k{i}", f"s{i % 5}", i, 1) for i in range(50)], ("n", None, 1, 1)))
    maintenance.compact(t)
    t.upsert(batch(spark, ("k1", "s1", -1, 2), ("k1", "s2", -2, 2), ("n", None, -3, 2)))
    t.delete("k", "k6")
    small = rows(t.snapshot())
    monkeypatch.setattr(t, "_broadcast_bytes", lambda: 0)
    assert rows(t.snapshot()) == small and len(small) == 51
    shown = plan(t.snapshot())
    assert shown.count("LeftSemi") == 1
    # the semi join reads only the partitions that the log touches
    assert "dynamicpruning" in shown


def test_bucketed_table_equals_a_plain_one(spark, make):
    ddl = "k string, n int, v int, seq int"
    plain = make("plain", schema=ddl, key="k,n")
    bucketed = make("bucketed", schema=ddl, key="k,n", buckets=4, bucket_by="k", cluster_columns="v")
    for i in range(4):
        changes = batch(spark, *[(f"k{j}", j % 3, i, i) for j in range(i, i + 12)], schema=ddl)
        for t in (plain, bucketed):
            t.upsert(changes)
            t.delete_keys(spark.createDataFrame([(f"k{i + 1}", (i + 1) % 3)], "k string, n int"))
            if i == 1:
                maintenance.compact(t)
            if i == 2:
                maintenance.cluster(t, "v")
        for as_of in range(1, plain.last_commit() + 1):
            assert rows(bucketed.snapshot(as_of)) == rows(plain.snapshot(as_of))
    assert rows(bucketed.incremental(2, deletes=True)) == rows(plain.incremental(2, deletes=True))
    assert rows(bucketed.before_images(3)) == rows(plain.before_images(3))
    assert bucketed.snapshot().columns == plain.snapshot().columns
    with pytest.raises(ValueError, match="another definition"):
        make("bucketed", schema=ddl, key="k,n", buckets=8, bucket_by="k", cluster_columns="v")
    for wrong in ({"buckets": 4, "partition_fields": "v"}, {"buckets": 4, "bucket_by": "v"}, {"buckets": -1}):
        with pytest.raises(ValueError, match="bucket"):
            make("wrong", schema=ddl, key="k,n", **wrong)


def test_snapshot_shuffles_touched_buckets_only(spark, make, folder):
    t = make(buckets=8)
    t.upsert(batch(spark, *[(f"k{i}", "CA", i, 1) for i in range(100)]))
    base = maintenance.compact(t)
    t.upsert(batch(spark, ("k1", "CA", -1, 2)))
    (touched,) = t.buckets_of(batch(spark, ("k1", "CA", 0, 0)))
    assert len(paths.glob(spark, f"{base.path}/_bucket=*")) == 8
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        shown = plan(t.snapshot())
        got = rows(t.snapshot())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 100 and ("k1", "CA", -1, 2) in got
    # the buckets that the log leaves alone are a branch of their own, without an exchange
    spared, _, joined = shown.partition("SortMergeJoin")
    assert "Exchange" not in spared and f"NOT (_bucket#" in spared
    assert f"= {touched})" in joined.split("PartitionFilters")[1]
    # a caller's keys of another type may hash otherwise: all buckets are read
    assert t.buckets_of(spark.createDataFrame([(1,)], "k int")) is None
    assert t.buckets_of(spark.createDataFrame([(1,)], "v int")) is None
    name = catalog.register(t, "bucket_test", "t", f"{folder}/db")
    assert rows(spark.sql(f"SELECT * FROM {name}")) == got
    spark.sql("DROP DATABASE bucket_test CASCADE")


def test_added_columns_are_null_in_stored_rows(spark, make, folder):
    wide = f"{DDL}, note string, fare decimal(9,2)"
    t = make(partition_fields="state")
    t.upsert(batch(spark, ("a", "CA", 1, 1), ("b", "CA", 2, 1)))
    name = catalog.register(t, "evolve_test", "t", f"{folder}/db")
    with pytest.raises(ValueError, match="another definition"):
        make(schema=wide, partition_fields="state")
    t = make(schema=wide, partition_fields="state", cluster_columns="v", codec="zstd", evolve=True)
    t.upsert(batch(spark, ("b", "TX", 3, 2, "new", None), schema=wide))
    now = [("a", "CA", 1, 1, None, None), ("b", "TX", 3, 2, "new", None)]
    assert rows(t.snapshot()) == now
    assert rows(t.snapshot(as_of=1)) == [("a", "CA", 1, 1, None, None), ("b", "CA", 2, 1, None, None)]
    maintenance.compact(t)
    assert rows(t.snapshot()) == rows(spark.sql(f"SELECT k, state, v, seq, note, fare FROM {name}")) == now
    spark.sql("DROP DATABASE evolve_test CASCADE")
    # nothing else may change: order and types of columns, keys, partitions
    for schema, options in (
        (DDL, {"partition_fields": "state"}),
        (wide.replace("v int", "v long"), {"partition_fields": "state"}),
        (f"fresh int, {wide}", {"partition_fields": "state"}),
        (wide, {}),
        (wide, {"partition_fields": "state", "scope": "partition"}),
        (f"{wide}, must int not null", {"partition_fields": "state"}),
    ):
        with pytest.raises(ValueError, match="another definition"):
            make(schema=schema, evolve=True, **options)


def test_compaction_merges_small_files(spark, make):
    t = make()
    for i in range(4):
        t.upsert(batch(spark, *[(f"k{j}", "CA", i, i) for j in range(i, i + 20)]))
    assert maintenance.compact(t, min_commits=5) is None
    base = maintenance.compact(t, min_commits=4)
    assert len(paths.glob(spark, f"{base.path}/*.parquet")) == 1
    t.upsert(batch(spark, ("k1", "CA", 9, 9)))
    kept = maintenance.compact(t, small_file_bytes=1)
    assert len(paths.glob(spark, f"{kept.path}/*.parquet")) >= 2
    assert t.snapshot().count() == 23


def test_vacuum_removes_broken_off_commits(spark, make):
    t = make()
    paths.make_dir(spark, t.commit_path(1))
    assert t.upsert(batch(spark, ("a", "CA", 1, 1))) == 2
    paths.make_dir(spark, t.commit_path(3))
    maintenance.compact(t)
    assert maintenance.vacuum(t, keep=1) == [t.commit_path(1), t.commit_path(2)]
    assert t.commits(finished=False) == [3] and t.snapshot().count() == 1


def test_empty_and_null_partition_values_are_one(spark, folder):
    schema = T.StructType().add("k", "string").add("at", "integer").add("state", "string")
    table = KeyedTable.create(spark, f"{folder}/t", schema, "k", "at", partition_fields="state", scope="partition")
    table.upsert(spark.createDataFrame([("a", 1, ""), ("a", 2, None), ("b", 1, "CA")], schema))
    assert sorted((r.k, r.at, r.state) for r in table.snapshot().collect()) == [("a", 2, None), ("b", 1, "CA")]


@pytest.mark.parametrize("options", [
    {}, {"scope": "partition", "partition_fields": "state"}, {"buckets": 4}, {"join_buckets": 3}, {"ordered": True},
])
def test_rows_of_some_keys_only(spark, make, options, monkeypatch):
    """In the log and in the base, also of a table whose log is spared most partitions."""
    t = make(**options)
    for i in range(3):
        t.upsert(batch(spark, *((f"k{j}", None if j == 4 else "CA", 10 * i + j, i) for j in range(2 * i, 8))))
        t.delete("k", f"k{i + 1}")
    wanted = spark.createDataFrame([("k0",), ("k1",), ("k4",), ("k4",), ("k7",), ("none",)], "k string")
    expected = [r for r in rows(t.snapshot()) if r[0] in ("k0", "k1", "k4", "k7")]
    assert rows(t.snapshot(only=wanted)) == expected and len(expected) == 3
    for _ in range(2):
        maintenance.compact(t)
        assert rows(t.snapshot(only=wanted)) == expected
        t.upsert(batch(spark, ("k5", "CA", 5, 9), ("k7", "CA", 77, 9)))
        expected = [*(r for r in expected if r[0] != "k7"), ("k7", "CA", 77, 9)]
        assert rows(t.snapshot(only=wanted)) == expected
        with monkeypatch.context() as patch:
            patch.setattr(t, "_broadcast_bytes", lambda: 0)
            assert rows(t.snapshot(only=wanted)) == expected
    with pytest.raises(ValueError, match="not all in the key"):
        t.snapshot(only=t.snapshot().select("v"))


def test_only_looked_up_keys_are_ranked(spark, make):
    t = make()
    for i in range(3):
        t.upsert(batch(spark, *((f"k{j}", "CA", i, i) for j in range(i, i + 4))))
    shown = plan(t.before_images(2))  # printed from the top down
    assert 0 <= shown.index("Window") < shown.index("LeftSemi")
    assert rows(t.before_images(2).select("k", "v")) == [("k2", 1), ("k3", 1), ("k4", 1)]
