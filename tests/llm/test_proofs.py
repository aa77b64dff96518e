"""Scores, overlaps and the pipeline against plain versions written with loops."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from corpusmill.llm import decontaminate, grams, rules, toxicity

BLANK = re.compile(r"[\x20\x09-\x0D]+")
TEXTS = [
    None,
    "",
    " \n\t ",
    "One word. ONE WORD! $$$ é\n\nsecond line, 42 42 42",
    "ÄÖÜ über straße ABCd ABC12345 a#b c@d",
    "x" * 5000 + " " + "y z " * 3000,
    "same line\nsame line\nother\n" * 40,
    "漢字かな " * 30,
]


def plain_statistics(text):
    data = (text or "").encode()
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", data) if w]
    lines = [ln for ln in data.split(b"\n") if ln]
    upper = lambda w: sum(65 <= c <= 90 for c in w)
    symbols, stops = b"!#$%&*+/<=>@[\\]^_`{|}~", b".,;:'\"?-()"
    share = lambda test: sum(map(test, data)) / max(len(data), 1)
    n = max(len(words), 1)
    return {
        "words": math.log1p(len(words)),
        "word_bytes": sum(map(len, words)) / n,
        "upper": upper(data) / max(len(data), 1),
        "digit": share(lambda c: 48 <= c <= 57),
        "stops": share(lambda c: c in stops),
        "symbol": share(lambda c: c in symbols),
        "accent": share(lambda c: 128 <= c < 192),
        "distinct": len(set(words)) / n,
        "top_word": max(Counter(words).values(), default=0) / n,
        "lines": math.log1p(len(lines)),
        "distinct_lines": len(set(lines)) / max(len(lines), 1),
        "line_words": len(words) / max(len(lines), 1),
        "all_caps": sum(upper(w) >= 2 and 2 * upper(w) > len(w) for w in words) / n,
        "symbol_words": sum(any(c in symbols for c in w) for w in words) / n,
    }


def test_quality_statistics_and_compiled_rules(spark):
    rnd = random.Random(1)
    texts = TEXTS + ["".join(rnd.choice("aB 1.\n$é") for _ in range(rnd.randint(1, 300))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["id"]: r for r in rules.measured(df, df["doc_id"], df["text"]).collect()}
    want = {i: plain_statistics(t) for i, t in enumerate(texts)}
    for i, stats in want.items():
        assert {s: got[i][s] for s in rules.STATS} == pytest.approx(stats, abs=1e-9), texts[i]
    x = np.array([[want[i][s] for s in rules.STATS] for i in want])
    y = np.array([(want[i]["upper"] > 0.1) != (want[i]["words"] > 2) for i in want], float)
    found, weights, intercept = rules.fit(x, y, trees=10, penalty=1e-3)
    assert 0 < len(found)
    scored = rules.measured(df, df["doc_id"], df["text"]).withColumn("score", rules.compiled(found, weights, intercept))
    for r in scored.collect():
        total = intercept
        for rule, weight in zip(found, weights):
            if all((r[rules.STATS[c]] > cut) == above for c, above, cut in rule):
                total += weight
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)


def plain_toxicity(model, text):
    """Every window on its own, one step at a time."""
    data, offsets = grams.buffers(pa.array([text], pa.string()))
    number, *parts = toxicity.inputs(data, toxicity.read_words(data, offsets))
    x = toxicity.embedded(model, *parts)[0].astype(float)[number]
    m = {k: v.astype(float) for k, v in model.items()}
    worst = -math.inf
    for a in range(max(len(x) - toxicity.WINDOW, 0) + 1 if len(x) else 0):
        window, states = x[a : a + toxicity.WINDOW], {}
        for d in "fb":
            h, out = np.zeros(toxicity.HIDDEN), []
            for v in window if d == "f" else window[::-1]:
                g = v @ m[f"w{d}"] + m[f"c{d}"] + h @ m[f"u{d}"]
                g = g / (1 + np.abs(g))
                z, c = 0.5 + 0.5 * g[: toxicity.HIDDEN], g[toxicity.HIDDEN :]
                h = z * h + (1 - z) * c
                out.append(h)
            states[d] = out if d == "f" else out[::-1]
        both = np.concatenate([states["f"], states["b"]], axis=1)
        key = both @ m["att"] + m["att_c"]
        weight = np.exp((key / (1 + np.abs(key))) @ m["query"])
        worst = max(worst, float(weight / weight.sum() @ both @ m["out"] + m["out_c"][0]))
    return 1 / (1 + math.exp(-worst)) if worst > -math.inf else 0.0


def test_toxicity_scores_equal_a_loop_over_windows(monkeypatch):
    rnd, rng = random.Random(2), np.random.default_rng(2)
    monkeypatch.setattr(toxicity.swept, "__defaults__", (37,))  # windows cross chunks
    model = {k: (v + 0.4 * rng.normal(size=v.shape)).astype(np.float32) for k, v in toxicity.new_model().items()}
    texts = [*TEXTS[:5], TEXTS[6], TEXTS[7]] + [" ".join(rnd.choices([f"w{i}é" for i in range(50)], k=n)) for n in (1, 23, 24, 25, 60, 131)]
    got = toxicity.text_scores(model, pa.array([t or "" for t in texts]))
    assert got.tolist() == pytest.approx([plain_toxicity(model, t or "") for t in texts], abs=1e-5)


def plain_overlaps(docs, items):
    """Spans of a document that match a span of an item, by comparing every pair of spans."""
    cut = lambda t: re.findall(r"[a-z0-9é]+", (t or "").lower())
    spans = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    out = {}
    for (doc, text), (item, item_text) in itertools.product(docs, items):
        a, b = cut(text), cut(item_text)
        if len(b) >= decontaminate.SPAN:
            theirs = spans(b, decontaminate.SPAN)
            hits = {s for s in spans(a, decontaminate.SPAN) if any(sum(x != y for x, y in zip(s, t)) <= 2 for t in theirs)}
        else:
            hits = {s for s in spans(a, len(b)) if s == tuple(b)} if b and (len(b) >= decontaminate.SHORTEST or len(a) == len(b)) else set()
        if hits:
            out[doc, item] = len(hits)
    return out


def test_overlaps_equal_a_comparison_of_all_spans(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["é1", "x"]
    items = [(i, " ".join(rnd.choices(words, k=n))) for i, n in enumerate([1, 3, 4, 5, 7, 12, 13, 13, 14, 20, 40, 40])] + [(50, None), (51, ""), (52, "repeated " * 30)]
    docs = []
    for k in range(120):
        held = rnd.choices(words, k=rnd.randint(0, 40))
        for _ in range(rnd.randint(0, 2)):
            copy = rnd.choice(items)[1]
            copy = (copy or "").split()
            for _ in range(rnd.randint(0, 4)):
                if copy:
                    copy[rnd.randrange(len(copy))] = rnd.choice(["other", "x"])
            a = rnd.randrange(len(held) + 1)
            held[a:a] = [w.upper() if rnd.random() < 0.2 else w for w in copy]
        docs.append((k, rnd.choice([" ", ", ", "; ", "\n"]).join(held)))
    docs += [(900 + i, t) for i, t in items] + [(990, None)]
    tables = [spark.createDataFrame(rows, schema) for rows, schema in ((docs, "doc_id long, text string"), (items, "item_id long, text string"))]
    got = {(r["doc_id"], r["item_id"]): r["spans"] for r in decontaminate.overlaps(tables[0].repartition(4), tables[1]).collect()}
    assert got == plain_overlaps(docs, items) and len(got) > 60


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string"


def pipeline_input(spark, folder, docs, labels=()):
    rnd = random.Random(4)
    item = " ".join(rnd.choices([f"b{i}" for i in range(99)], k=40))
    spark.createDataFrame(docs(item), SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_pipeline_on_odd_documents(spark, tmp_path):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    base = [" ".join(rnd.choices(words, k=60)) for _ in range(40)]

    def docs(item):
        rows = [(i, t, "en", f"s{i % 3}", 0, "big", None) for i, t in enumerate(base)]
        rows += [(100 + i, base[0], "en", "s0", 0, "copy", "x") for i in range(30)]  # copies of one document
        rows += [(200, base[1] + " " + item, "en", "s1", 0, None, None), (201, None, None, None, None, None, None), (202, "", "en", "s1", 0, "", "")]
        return rows + [rows[3], rows[3], (None, base[5] + " tail", "en", None, 0, "null id", None)]

    pipeline_input(spark, tmp_path, docs)
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert {"input_size", "input_shard", "shard", "slot", "size"} <= set(got.columns)
    rows = got.collect()
    texts = Counter(r["text"] for r in rows)
    known = set(base) | {base[5] + " tail", None, ""}
    assert set(texts) <= known and not any(t and "b1 " in t for t in texts)
    assert len({r["doc_id"] for r in rows if r["text"] == base[0]}) <= 1  # one of the copies
    places = {}
    for r in rows:
        places.setdefault(r["shard"], []).append(r["slot"])
        assert r["size"] == len((r["text"] or "").encode()) + 1
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_pipeline_of_nothing(spark, tmp_path):
    pipeline_input(spark, tmp_path, lambda item: [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    pipeline_input(spark, tmp_path, lambda item: [(1, "some text", "en", "s", 9, "a", "b"), (None, None, None, None, None, None, None)])
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
