"""The stages one by one and together, and the queries that have SQL."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from checks.compare import database, difference
from tests.conftest import plan
from tests.llm.conftest import awkward_rows
from tests.llm.test_documents import broadcast_parts, brute_components, copies
from tidewater.llm import minhash, pii, sql

SF = "/root/testdata/sf0.001"


@pytest.fixture
def labelled(labels, folder):
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(sql.registered()))
def test_query_with_sql(spark, name):
    ours = contract.queries()[name](spark, SF).toPandas()
    assert len(ours) and difference(ours, database(SF).execute(contract.oracle_sql()[name]).df()) is None


def test_every_query_is_registered():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in contract.queries()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_awkward_tables(spark, clashing, labelled, name, stage):
    out = stage(spark, clashing, labelled)
    rows = out.collect()
    if name != "best-fit packing":
        assert out.columns == clashing.columns
    assert stage(spark, clashing.limit(0), labelled).collect() == []
    if name == "MinHash near-dedup":
        # 1, 2 and 2 again are one document; rows without an id are documents each
        assert Counter(r.doc_id for r in rows) == {None: 2} | {i: 1 for i in (1, 3, 4, 5, 6, 7, 8)}
    if name == "PII":
        assert len(rows) == len(awkward_rows()) and any(r.text and "[EMAIL]" in r.text for r in rows)


def test_dedup_stage_broadcasts_nothing_sized_too_low(spark, monkeypatch):
    """In no step of the stage an exploded or a signature side, whatever sizes Spark believes in."""
    plans, stored = [], minhash.stored
    monkeypatch.setattr(minhash, "stored", lambda df, name: plans.append(plan(df)) or stored(df, name))
    docs, texts = copies(spark)
    left = {r.doc_id for r in corpus_pipeline.dedup_stage(spark, docs, SF).collect()}
    assert left == set(brute_components(texts, 5, 80).values()) and len(left) < len(texts)
    parts = [part for text in plans for part in broadcast_parts(text)]
    assert not [part for part in parts if "Generate" in part or "hub_signature" in part]


def test_different_texts_of_a_repeated_id(spark):
    """Each goes on its own links: a copy of another document, the first of a group, a text of its own."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(3, a, 1), (5, a, 1), (5, b, 2), (5, b, 1), (9, b, 1), (7, c, 1), (7, d, 1), (None, a, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    left = [tuple(r) for r in corpus_pipeline.dedup_stage(spark, docs, SF).collect()]
    assert Counter(left) == Counter([(3, a, 1), (5, b, 1), (7, c, 1), (7, d, 1)])


def test_copies_without_an_id(spark):
    """One of a group stays, the one that has an id if there is any."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(None, a, 1), (None, a, 2), (None, a + " more", 3), (None, b, 4), (8, b, 5), (None, c, 6), (None, None, 7), (None, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    left = [tuple(r) for r in corpus_pipeline.dedup_stage(spark, docs, SF).collect()]
    assert len(left) == 5 and (8, b, 5) in left and (None, c, 6) in left
    assert sum(r[2] in (1, 2, 3) for r in left) == 1 and sum(r[1] is None for r in left) == 2


def test_mix_of_rows_without_ids(spark):
    """The words that come out are those of the targets, with and without ids."""
    from tidewater.llm import mixing

    for ids in (range(130), [None] * 130, [7] * 130):
        rows = [(i, f"{n} " * 10, "a" if n < 100 else "b") for n, i in enumerate(ids)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        target = {r.source: r.target for r in mixing.served(docs).select("source", "target").distinct().collect()}
        taken = Counter(r.source for r in corpus_pipeline.mixing_stage(spark, docs, SF).collect())
        assert all(abs(10 * taken[s] - target[s]) <= 10 for s in target)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = corpus_pipeline.quality_stage(spark, docs, SF)
    kept = {r.doc_id: r.text for r in good.collect()}
    known = [i for i, q in truth.items() if q is not None]
    assert sum((i in kept) == (truth[i] == 1) for i in known) >= 0.95 * len(known)
    single = corpus_pipeline.dedup_stage(spark, good, SF)
    left = {r.doc_id: r.text for r in single.collect()}
    expected = brute_components(kept, 5, 80)
    assert set(left) == {i for i in kept if expected[i] == i} and all(left[i] == kept[i] for i in left)
    clean = {r.doc_id: r.text for r in corpus_pipeline.pii_stage(spark, single, SF).collect()}
    assert clean == {i: pii.redact(t, pii.find(t)) for i, t in left.items()}


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    words = sum((Counter({r.doc_id: r.n_words}) for r in rows), Counter())
    assert rows and len(words) > 50
    bins = Counter()
    for r in rows:
        bins[r.bin_id] += r.n_words
    assert max(bins.values()) <= 2048
