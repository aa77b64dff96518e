"""Vocabularies, ids in text order and subwords against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import features

TEXTS = [(0, "Tea tea cup, été"), (1, "tea pot Straße x"), (2, None), (3, ""), (4, "pot " * 50 + "lid"), (5, "unseen once")]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string")


def plain_words(text):
    return re.findall(r"\w{2,}", (text or "").lower())


def plain_vocabulary(min_count):
    counts = Counter(w for _, t in TEXTS for w in plain_words(t))
    kept = sorted((w for w, n in counts.items() if n >= min_count), key=lambda w: (-counts[w], w.encode()))
    return {w: (i + features.FIRST_TERM, counts[w]) for i, w in enumerate(kept)}


@pytest.mark.parametrize("parts", [1, 7])
def test_vocabulary_is_dense_and_equal_on_any_layout(spark, texts, parts):
    for least in (1, 2):
        found = features.vocabulary(texts.repartition(parts), "text", min_count=least)
        assert {r.term: (r.id, r.n) for r in found.terms.collect()} == plain_vocabulary(least)
        assert found.size == len(plain_vocabulary(least))
    cut = features.vocabulary(texts, "text", max_terms=2).terms.collect()
    assert {r.term for r in cut} == {"pot", "tea"}


def test_places_are_numbered_without_one_task(spark):
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_000).alias("v"))
    placed = features.numbered(df.repartition(13), F.desc("v"))
    assert placed.where(F.col("place") != 49_999 - F.col("v")).count() == 0
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "rangepartitioning" not in plan  # the sorted rows are written, not moved again
    assert features.numbered(df.limit(0), "v").count() == 0


@pytest.mark.parametrize("bytes", [0, 1 << 20])
def test_ids_in_text_order(spark, texts, monkeypatch, bytes):
    monkeypatch.setattr(features, "BROADCAST_BYTES", bytes)
    terms, want = features.vocabulary(texts, "text", min_count=2), plain_vocabulary(2)
    found = {r.doc_id: r.ids for r in features.vocabulary_ids(texts.repartition(3), "doc_id", "text", terms).collect()}
    assert found == {i: [want.get(w, (features.UNKNOWN,))[0] for w in plain_words(t)] for i, t in TEXTS}
    counts = {(r.doc_id, r.id): r.tf for r in features.vocabulary_counts(texts, "doc_id", "text", terms).collect()}
    assert counts == Counter((i, want[w][0]) for i, t in TEXTS for w in plain_words(t) if w in want)


def test_a_large_vocabulary_is_not_broadcast(spark, texts, monkeypatch):
    monkeypatch.setattr(features, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(features, "_looked_up", None)
    terms = features.vocabulary(texts, "text")
    assert features.vocabulary_ids(texts, "doc_id", "text", terms).count() == len(TEXTS)


def plain_subwords(word, pieces, unknown):
    ids, at = [], 0
    while at < len(word):
        for end in range(len(word), at, -1):
            piece = ("##" if at else "") + word[at:end]
            if piece in pieces:
                ids.append(pieces[piece])
                at = end
                break
        else:
            return [unknown]
    return ids


def test_subwords_equal_plain_longest_match(spark):
    rnd = random.Random(2)
    names = {"".join(rnd.choices("abcé", k=rnd.randint(1, 4))) for _ in range(40)}
    pieces = {p: i + 10 for i, p in enumerate(sorted(names | {"##" + n for n in names if rnd.random() < 0.8} | {",", "##"}))}
    texts = [(i, " ".join("".join(rnd.choices("abcéz" if rnd.random() < 0.1 else "abcé", k=rnd.randint(1, 9))) for _ in range(30)) + ", ##!") for i in range(40)]
    texts += [(90, None), (91, ""), (92, "a" * 101), (93, "A" * 100), (94, "ABC, cÉ")]
    df = spark.createDataFrame(texts, "id long, text string").repartition(3)
    found = {r.id: r.ids for r in features.subword_ids(df, "id", "text", pieces, 1, longest_word=100).collect()}
    for i, t in texts:
        listed = re.findall(r"\w+|[^\w\s]", (t or "").lower())
        assert found[i] == [x for w in listed for x in ([1] if len(w) > 100 else plain_subwords(w, pieces, 1))], t
    cut = {r.id: r.ids for r in features.subword_ids(df, "id", "text", pieces, 1, begin=2, end=3, max_length=6).collect()}
    assert cut == {i: [2, *ids[:4], 3] for i, ids in found.items()}


def test_term_weights_with_and_without_a_broadcast(spark, texts, monkeypatch):
    import math

    rows = {i: Counter(plain_words(t)) for i, t in TEXTS}
    spread = Counter(w for words in rows.values() for w in words)
    want = {}
    for i, words in rows.items():
        raw = {w: n * (math.log((1 + len(TEXTS)) / (1 + spread[w])) + 1) for w, n in words.items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        want |= {(i, w): v / length for w, v in raw.items()}
    for bytes in (1 << 20, 0):
        monkeypatch.setattr(features, "BROADCAST_BYTES", bytes)
        found = features.tfidf(texts.repartition(3), "doc_id", "text")
        got = {(r.doc_id, r.term): r.weight for r in found.collect()}
        assert got == pytest.approx(want, abs=1e-12)
    # In place: nothing moves but what `repartition` moves.
    monkeypatch.setattr(features, "BROADCAST_BYTES", 1 << 20)
    assert "Exchange" not in features.tfidf(texts, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert features.tfidf(texts.limit(0), "doc_id", "text").count() == 0


def test_terms_are_counted_where_texts_lie_unless_keys_repeat(spark, texts):
    alone = features.term_counts(texts, "doc_id", "text")
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
    want = Counter((i, w) for i, t in TEXTS for w in plain_words(t))
    assert {(r.doc_id, r.term): r.tf for r in alone.collect()} == want
    twice = features.term_counts(texts.union(texts).repartition(3), "doc_id", "text")
    assert {(r.doc_id, r.term): r.tf for r in twice.collect()} == {k: 2 * n for k, n in want.items()}


def test_a_long_text_is_put_back_by_position(spark, monkeypatch):
    monkeypatch.setattr(features, "BROADCAST_BYTES", 0)
    df = spark.createDataFrame([(1, " ".join(f"w{i % 300}x" for i in range(3000)) + " once"), (2, None), (3, "")], "doc_id long, text string")
    terms = features.vocabulary(df, "text", min_count=2)
    found = features.vocabulary_ids(df, "doc_id", "text", terms)
    assert "map_from_entries" not in found._jdf.queryExecution().toString()
    known = {r.term: r.id for r in terms.terms.collect()}
    ids = {r.doc_id: r.ids for r in found.collect()}
    assert ids == {1: [known[f"w{i % 300}x"] for i in range(3000)] + [features.UNKNOWN], 2: [], 3: []}


@pytest.mark.parametrize("bytes", [0, 1 << 20])
def test_python_steps_see_few_rows_at_a_time(spark, monkeypatch, bytes):
    import pyarrow as pa
    from corpusmill.functions import slices

    monkeypatch.setattr(slices, "SLICE_BYTES", bytes)
    sizes = [len(part) for part in slices.slices(pa.array(["ab" * 50_000] * 30))]
    assert sum(sizes) == 30 and max(sizes) == (10 if bytes else 1)
    assert [len(part) for part in slices.slices(pa.array([], pa.string()))] == [0]
    seen = slices.sliced("int", lambda rows: pa.array([len(rows)] * len(rows), pa.int32()))
    df = spark.range(500).repartition(2).select(F.repeat(F.lit("x"), 10_000).alias("t"))
    assert df.select(seen("t").alias("n")).agg(F.max("n")).first()[0] < 250


def plain_tfidf(texts):
    counts = {i: Counter(plain_words(t)) for i, t in texts}
    spread = Counter(w for c in counts.values() for w in c)
    raw = {i: {w: n * (math.log((1 + len(texts)) / (1 + spread[w])) + 1) for w, n in c.items()} for i, c in counts.items()}
    return {(i, w): v / math.sqrt(sum(x * x for x in r.values())) for i, r in raw.items() for w, v in r.items()}


@pytest.mark.parametrize("bytes", [0, 300, 600, 1 << 20])
def test_weights_with_some_terms_sent(spark, monkeypatch, bytes):
    monkeypatch.setattr(features, "BROADCAST_BYTES", bytes)
    monkeypatch.setattr(features, "heavy_join", None)  # rows of frequent terms are not moved
    many = [(i, f"all even{i % 2} third{i % 3} seven{i % 7} own{i} own{i} " * (1 + i % 3)) for i in range(30)]
    texts = [*((i + 100, t) for i, t in TEXTS), *many, (None, "all of no key")]
    found = features.tfidf(spark.createDataFrame(texts, "doc_id long, text string").repartition(5), "doc_id", "text")
    weights = {(r.doc_id, r.term): r.weight for r in found.collect()}
    assert weights == pytest.approx(plain_tfidf(texts)) and len(weights) == found.count()


def test_few_rows_are_moved_for_weights(spark, monkeypatch):
    monkeypatch.setattr(features, "BROADCAST_BYTES", 2000)
    moved = []
    counted = features._counted
    monkeypatch.setattr(features, "_counted", lambda *a: moved.append(counted(*a)) or moved[-1])
    rows = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("some frequent words stay here own"), "id").alias("text"))
    assert features.tfidf(rows, "doc_id", "text").count() == 1200
    assert [m.count() for m in moved] == [200]


def test_repeated_keys_are_weighed_together(spark, monkeypatch):
    monkeypatch.setattr(features, "BROADCAST_BYTES", 0)
    found = features.tfidf(spark.createDataFrame([(1, "one two"), (1, "two")], "doc_id long, text string"), "doc_id", "text")
    assert sorted(r.term for r in found.collect()) == ["one", "two"]
