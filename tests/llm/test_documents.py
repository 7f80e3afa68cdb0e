"""Operators over documents against brute force, and on awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan
from tests.llm.conftest import LONG, awkward_rows
from tidewater.llm import language, minhash, mixing, packing, pii, quality, tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---- near duplicates -------------------------------------------------------------------


def shingles(text: str | None, width: int) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words)} if len(words) < width else {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute_components(texts: dict[int, str | None], width: int, percent: int) -> dict[int, int]:
    sets = {i: shingles(t, width) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("width, percent, block", [(3, 85, 512), (5, 80, 512), (3, 85, 8)])
def test_near_duplicates_like_brute_force(spark, monkeypatch, width, percent, block):
    """Groups of edited copies around the threshold; with small blocks the groups are cut."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(3)
    texts: dict[int, str | None] = {0: None, 1: "", 2: "one two", 3: "ONE two", 4: "one"}
    for group in range(6):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice((20, 60, 150)))]
        for _ in range(14):
            copy = [w if rng.random() > 0.03 else "x" + w for w in words]
            texts[len(texts)] = " ".join(copy)
    frame = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    found = minhash.near_duplicates(frame, width=width, similarity=percent / 100).collect()
    expected = brute_components(texts, width, percent)
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(shingles(t, width)) for i, t in texts.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def edited(rng: random.Random, words: list[str], copies: int) -> list[str]:
    """Copies that differ in one word."""
    return [" ".join([*words[:at], f"new{i}", *words[at + 1 :]]) for i in range(copies) for at in [rng.randrange(len(words))]]


def test_large_linked_group_in_bounded_tasks(spark, monkeypatch, tmp_path):
    """Rows of one task group, and of all, where one group of near copies has many blocks."""
    from pyspark.sql.group import GroupedData

    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "TASK_ROWS", 32)
    apply, log = GroupedData.applyInPandas, str(tmp_path / "rows")

    def watched(self, func, schema):
        def counted(pdf):
            with open(log, "a") as out:
                out.write(f"{int('text' in pdf)} {len(pdf)}\n")
            return func(pdf)

        return apply(self, counted, schema)

    monkeypatch.setattr(GroupedData, "applyInPandas", watched)
    rng = random.Random(5)
    texts = edited(rng, [f"w{i}" for i in range(120)], 400) + edited(rng, [f"v{i}" for i in range(120)], 3)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame).collect()}
    assert found == brute_components(dict(enumerate(texts)), 5, 80)
    rows = [tuple(map(int, line.split())) for line in open(log)]
    assert max(n for _, n in rows) <= 100  # a pair of blocks, or a block and the hubs
    assert sum(n for text, n in rows if text) <= 5 * len(texts)  # not once for each of 25 blocks


def broadcast_parts(text: str) -> list[str]:
    """What stands below each broadcast of a plan."""
    lines = [(len(line) - len(line.lstrip(" :|+-")), line) for line in text.splitlines()]
    found = []
    for at, (depth, line) in enumerate(lines):
        if "BroadcastExchange" in line:
            below = [(d, text) for d, text in lines[at + 1 :]]
            end = next((i for i, (d, _) in enumerate(below) if d <= depth), len(below))
            found.append("\n".join(text for _, text in below[:end]))
    return found


def copies(spark):
    """Documents with a near copy each, far below what Spark may broadcast."""
    rng = random.Random(9)
    texts = [t for i in range(8) for t in edited(rng, [f"w{i}-{j}" for j in range(60)], 2)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), dict(enumerate(texts))


def test_nothing_sized_too_low_is_broadcast(spark, monkeypatch):
    """Neither the tokens, which an explode makes of the classes, nor signatures, whose array counts as one number."""
    plans, stored = {}, minhash.stored
    monkeypatch.setattr(minhash, "stored", lambda df, name: plans.setdefault(name, plan(df)) and stored(df, name))
    docs, texts = copies(spark)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert found == brute_components(texts, 5, 80) and len(set(found.values())) < len(found)
    assert "BroadcastExchange" not in plans["posted"] + plans["near_hub"]
    assert not [part for part in broadcast_parts(plans["left_over"]) if "signature" in part]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "u long, v long")
    found = {r.node: r.component for r in minhash.components(edges).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_near_duplicates_awkward(clashing, no_documents):
    found = minhash.near_duplicates(clashing, width=3, similarity=0.85).collect()
    assert len(found) == len(awkward_rows())
    assert Counter(r.component_id for r in found if r.doc_id in (1, 2)) == {1: 3}
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id in (3, 4, 5)} == {
        i: (0, i, True) for i in (3, 4, 5)
    }
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)] * 2
    assert minhash.near_duplicates(no_documents).collect() == []


# ---- personal data ---------------------------------------------------------------------


def naive_spans(text: str) -> list[tuple[int, int, int]]:
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [
        (m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m[0].split("."))
    ]
    out += [
        (m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
        if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))
    ]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(list("a@.-+1 (0)9é") + ["12.3.4.5", "a@b.c", "4111 1111 1111 1111", "+1 (619) 555-1368", "0255"]), max_size=30).map("".join))
def test_base_spans_like_plain_patterns(text):
    assert [(s.start, s.order, s.end) for s in pii.base_spans(text)] == naive_spans(text)


def test_checksums_and_context():
    kinds = lambda t: [s.kind for s in pii.find(t)]
    assert kinds("IBAN GB82 WEST 1234 5698 7654 32 is mine") == ["iban"]
    assert kinds("IBAN GB82 WEST 1234 5698 7654 33 is mine") == []
    assert kinds("call my phone 030 1234 5678 now") == ["phone"]
    assert kinds("rows 030 1234 5678 now") == []
    assert kinds("SSN 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    assert kinds("card 4111 1111 1111 1111") == ["card"] and kinds("4111 1111 1111 1112") == []
    text = "mail a.b@example.com or 10.0.0.1"
    assert pii.redact(text, pii.find(text)) == "mail [EMAIL] or [IP]"


@pytest.mark.parametrize(
    "text, redacted",
    [
        ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFF", "IBAN [IBAN] BIC COBADEFF"),
        ("DE89370400440532013000 500 EUR", "[IBAN] 500 EUR"),
        ("GB29NWBK60161331926819 A note", "[IBAN] A note"),
        ("REF AB12 DE89 3704 0044 0532 0130 00 OK", "REF AB12 [IBAN] OK"),  # a head that is none comes before
        ("ZZ22 3704 0044 0532 0130 00 TO PAY", "[IBAN] TO PAY"),  # no prescribed length
    ],
)
def test_accounts_end_where_they_end(text, redacted):
    assert pii.redact(text, pii.find(text)) == redacted


def test_account_with_a_card_inside():
    text = "pay DK58 0040 4440 1162 54 now"
    assert [s.kind for s in pii.base_spans(text)] == ["card"]
    assert pii.redact(text, pii.find(text)) == "pay [IBAN] now"


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("ssn phone 123-45-6789 12 34", ["ssn"]),  # one span, not one of each kind
        ("megaphone" + " " * 31 + "030 1234 5678", []),  # the window begins within a word
        ("030 1234 5678" + " " * 36 + "phonebook", []),  # or ends in one
        ("030 1234 5678" + " " * 36 + "phone", ["phone"]),
        ("phone: meeting 2024-01-15 10.30", []),
        ("phone: 2024-01-15 10.30", []),
        ("my phone and the invoice 030 1234 5678", []),
        ("invoice by phone 030 1234 5678", ["phone"]),
        ("serial GB82WEST12345698765432", []),  # context decides on accounts too
        ("serial of the iban GB82WEST12345698765432", ["iban"]),
        ("here GB82WEST12345698765432", ["iban"]),
    ],
)
def test_the_nearest_whole_word_decides(text, kinds):
    found = pii.find(text)
    assert [s.kind for s in found] == kinds
    assert all(a.end <= b.start for a, b in zip(found, found[1:]))


@pytest.mark.parametrize("run", ["1" * 200_000, "a" * 200_000, "a@" * 50_000, "+1" * 50_000, "1." * 50_000, "AB12" * 40_000])
def test_long_runs_stay_linear(run):
    assert isinstance(pii.find(run), list)


def test_pii_table(clashing, no_documents):
    found = pii.digest(pii.find_pii(clashing)).collect()
    assert len(found) == len(awkward_rows()) and sum(r.n_email for r in found) == 1
    blank = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == blank and r.spans == "" for r in found if r.doc_id in (3, 4, 5, 6))
    assert pii.find_pii(no_documents).collect() == []


def test_pii_query_on_whole_texts(spark, documents):
    from tidewater.llm.queries import op2_pii

    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    for r in op2_pii(spark, SF).collect():
        spans = naive_spans(texts[r.doc_id])
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert set(text.split(",")) <= set(r.spans.split(","))


# ---- mixing ----------------------------------------------------------------------------


def brute_targets(sizes: dict) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weight[s] > 3 * sizes[s]]
        if not over:
            return capped | {s: level * weight[s] for s in open_}
        capped |= {s: 3 * sizes[s] for s in over}


def check_mix(rows):
    sizes, target, taken = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        target[r.source] = r.target
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and r.whole * r.size <= r.taken
    expected = brute_targets(sizes)
    assert target == pytest.approx(expected)
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    assert all(r.source_size == sizes[r.source] for r in rows)


def test_mixing_meets_targets(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.choice((0, 1, 5, 40, 900)), rng.choice(["a"] * 9 + ["b", "é", "Z", None])) for i in range(400)]
    rows.append((400, "w", "tiny"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.served(frame).collect()
    assert len(found) == len(rows)
    check_mix(found)
    again = mixing.served(frame.repartition(5)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))


def test_mix_rows(spark):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 11 == 0]) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    times = Counter(r.doc_id for r in mixing.mix(frame).collect())
    for r in mixing.served(frame).collect():
        assert abs(times[r.doc_id] - r.taken / r.size) <= 0.5


def test_mixing_awkward(clashing, no_documents):
    found = mixing.served(clashing).collect()
    assert len(found) == len(awkward_rows())
    check_mix(found)
    mixed = mixing.mix(clashing)
    assert mixed.columns == clashing.columns and mixed.count() > 0
    assert mixing.served(no_documents).collect() == [] and mixing.mix(no_documents).collect() == []


# ---- packing ---------------------------------------------------------------------------


def brute_best_fit(sizes, sources, clusters, capacity, per_source):
    bins, out = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        fit = [
            (b["room"], i) for i, b in enumerate(bins)
            if b["room"] >= size and b["sources"][source] < per_source and cluster not in b["clusters"]
        ]
        i = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append({"room": capacity, "sources": Counter(), "clusters": set()})
        bins[i]["room"] -= size
        bins[i]["sources"][source] += 1
        bins[i]["clusters"].add(cluster)
        out.append(i)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 4), st.integers(0, 9)), max_size=120), st.integers(1, 3))
def test_best_fit_like_brute_force(items, per_source):
    items.sort(reverse=True)
    sizes, sources, clusters = (np.array([x[i] for x in items], np.int64) for i in range(3))
    found = packing.best_fit(sizes, sources, clusters, 20, per_source)
    assert found.tolist() == brute_best_fit(sizes, sources, clusters, 20, per_source)


def check_packing(rows, words: Counter, capacity: int, per_source: int = 4):
    assert Counter({k: v for k, v in words.items() if v}) == Counter(
        {k: v for k, v in sum((Counter({r.doc_id: r.n_words}) for r in rows), Counter()).items() if v}
    )
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    for held in bins.values():
        assert sum(r.n_words for r in held) == held[0].bin_words <= capacity
        assert max(Counter(r.cluster for r in held).values()) == 1
        assert max(Counter(r.source for r in held).values()) <= per_source


def test_packing_query(spark, documents):
    from tidewater.llm.queries import op1_packing

    words = Counter({r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in documents.collect()})
    rows = op1_packing(spark, SF).collect()
    check_packing(rows, words, 2048)
    assert {r.doc_id for r in rows} == set(words)
    assert sorted(map(repr, rows)) == sorted(map(repr, op1_packing(spark, SF).collect()))


def test_packing_awkward(clashing, no_documents):
    rows = packing.pack(clashing, capacity=100, shard_rows=50).collect()
    words = Counter()
    for doc_id, text, *_ in awkward_rows():
        words[doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    check_packing(rows, words, 100)
    assert packing.pack(no_documents).collect() == []


# ---- token counts ----------------------------------------------------------------------

tokenizer = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer.path("byte_bpe_50k.json"))


def counted(docs, **more):
    return tokens.count_tokens(docs, tokenizer_file=tokenizer.path("byte_bpe_50k.json"), pattern=tokenizer.PATTERN, **more)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "Word", " ", "\n", "\t", "'s", "'", "12", "é", "中", "\U0001f600", "<|endoftext|>", "<|", " ", "!?", "\x1c", "́"]), max_size=25).map("".join))
def test_counter_like_the_library(library, text):
    count = test_counter_like_the_library.__dict__.setdefault("c", tokens.Counter(tokenizer.path("byte_bpe_50k.json"), tokenizer.PATTERN))
    assert count(text) == len(library.encode(text, add_special_tokens=False))


def test_token_cache(spark, awkward, library, folder):
    cache = folder + "/cache"
    rows = counted(awkward, cache=cache).collect()
    texts = [t or "" for _, t, *_ in awkward_rows()]
    expected = Counter((i, len(t.encode()), len(library.encode(t, add_special_tokens=False))) for (i, *_), t in zip(awkward_rows(), texts))
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == expected
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows)
    stored = spark.read.parquet(cache)
    assert stored.count() == len(set(texts))
    more = awkward.unionAll(spark.createDataFrame([(50, "a new text", None, None, 1)], awkward.schema))
    assert counted(more, cache=cache).count() == len(texts) + 1
    assert spark.read.parquet(cache).count() == len(set(texts)) + 1  # only the miss was appended


def test_tokens_query(spark, documents, library):
    from tidewater.llm.queries import op10_tokens

    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    found = {r.doc_id: r.n_tokens for r in op10_tokens(spark, SF).collect()}
    assert found == {i: len(library.encode(t, add_special_tokens=False)) for i, t in texts.items()}


def test_tokens_awkward(clashing, no_documents):
    assert counted(clashing).count() == len(awkward_rows()) and counted(no_documents).collect() == []


# ---- language --------------------------------------------------------------------------


def test_language_held_out(spark, documents):
    from tidewater.llm.queries import op7_language

    truth = {r.doc_id: r.lang for r in documents.collect()}
    rows = op7_language(spark, SF).collect()
    assert len(rows) == len(truth)
    out = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_awkward(clashing, no_documents, documents):
    model = language.fit(documents)
    found = language.predict(clashing, model).collect()
    assert len(found) == len(awkward_rows())
    assert {r.doc_id: (r.lang_pred, r.score) for r in found if r.doc_id in (3, 4, 5, 7)} == {i: ("und", 0.0) for i in (3, 4, 5, 7)}
    assert language.predict(no_documents, model).collect() == []
    assert language.fit(no_documents)("some text") == ("und", 0.0)
    assert language.fit(clashing)("some text")[0] in ("en", "fr")


def test_a_repeated_id_counts_once(spark):
    """What comes to the driver is bounded by ids, however often one is repeated."""
    from tidewater.llm import language as module

    seen = []
    rows = [(1, f"the cat number {i}", "en") for i in range(3000)] + [(i, f"le chat {i}", "fr") for i in range(2, 40)]
    docs = spark.createDataFrame(rows + [(None, "no id", "en")], "doc_id long, text string, lang string")
    model, module.Model = module.Model, lambda x, langs: seen.append((len(x), sorted(set(langs))))
    try:
        module.fit(docs, per_language=20)
    finally:
        module.Model = model
    assert seen == [(21, ["en", "fr"])]

    marks = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    trained, quality.trained = quality.trained, lambda texts, labels, max_lines: (texts, labels)
    try:
        texts, labels = quality.fit(docs, marks)
    finally:
        quality.trained = trained
    assert texts == ["the cat number 0", "le chat 2", "le chat 3"] and labels == [1, 0, 0]


def test_families_then_pairs():
    texts = {"de": "der und die", "en": "the and of", "fr": "le et les", "xx": "qqq zzz"}
    langs = [k for k in texts for _ in range(3)]
    model = language.Model(np.vstack([language.counts(texts[k]) for k in langs]), langs)
    assert model.families == ["germanic", "romance", "xx"] and model.pairs == [("de", "en")]
    assert {k: model(t)[0] for k, t in texts.items()} == {k: k for k in texts}


# ---- quality ---------------------------------------------------------------------------


def test_quality_held_out(spark):
    from tidewater.llm.queries import op9_quality

    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op9_quality(spark, SF).collect()
    out = [r for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.9 * len(out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_field_like_enumeration():
    """Marginals against the sum over all labellings."""
    rng = np.random.default_rng(1)
    field = quality.Field(links=rng.normal(size=(2, 2)))
    emit, mask = rng.normal(size=(2, 4)), np.array([[True] * 4, [True, True, True, False]])
    good, pairs, whole = field.marginals(emit, mask)
    for d, n in enumerate((4, 3)):
        total, marginal = 0.0, np.zeros(n)
        for code in range(2**n):
            y = [(code >> i) & 1 for i in range(n)]
            w = np.exp(sum(emit[d, i] * y[i] for i in range(n)) + sum(field.links[a, b] for a, b in zip(y, y[1:])))
            total += w
            marginal += w * np.array(y)
        assert np.allclose(good[d, :n], marginal / total) and np.isclose(whole[d], np.log(total))
    assert np.isclose(pairs.sum(), 5)


def test_quality_awkward(clashing, no_documents, labels):
    field = quality.fit(clashing, labels)
    found = quality.score(clashing, field).collect()
    assert len(found) == len(awkward_rows())
    assert all(r.score == 0 for r in found if r.doc_id in (3, 4, 5))
    assert quality.score(no_documents, field).collect() == []
    assert quality.keep_good(clashing, field).columns == clashing.columns
    assert quality.fit(no_documents, labels.limit(0)).scores(["a line"]) == [0.5]
