import os
import subprocess
import sys

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import prompts
from corpusmill.operators import answers as ans
from corpusmill.operators import classify, udfs
from corpusmill.operators import metrics as met
from corpusmill.operators.features import tfidf, token_ids
from corpusmill.plans.tables import ARMS
from corpusmill.streaming import batches


def test_generate_keeps_failures(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, None), (4, "fine")], "i int, p string")

    def model(asked):
        if (asked == "bad").any():
            raise RuntimeError("no")
        return asked.str.upper()

    got = ans.generate(df.coalesce(1), "p", model).orderBy("i").collect()
    assert [(r.answer, r.error) for r in got] == [
        ("OK", None), (ans.FAILED, "RuntimeError: no"), (None, None), ("FINE", None),
    ]


def test_failed_rows_do_not_reach_the_dataset(spark):
    df = spark.createDataFrame([("t", "q", "é ok", None), ("t", "q2", ans.FAILED, "x")], "topic string, question string, answer string, error string")
    assert [tuple(r) for r in ans.clean_pairs(df).collect()] == [("t", "q", "  ok")]


def test_best_sentence(spark):
    df = spark.createDataFrame([("When was it founded?", "It is big. It was founded in 2009. Founded it was.")], "q string, c string")
    assert df.select(ans.best_sentence(F.col("q"), F.col("c")).alias("a")).first().a == "It was founded in 2009."


def test_arm_prompts(spark):
    df = spark.createDataFrame([(1, "why?", "because")], "query_id long, question string, context string")
    got = {r.arm: r.prompt for r in ans.arm_prompts(df, ARMS).collect()}
    assert set(got) == {a for a, _, _ in ARMS}
    for arm, _, retrieval in ARMS:
        assert got[arm].startswith("Context: because\n") == retrieval
        assert got[arm].endswith("Answer:")


def test_retrieve_fewer_chunks_than_k(spark):
    chunks = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [0.0, 1.0], "b")], "id long, vector array<double>, page_content string")
    asked = spark.createDataFrame([(7, "q", [0.1, 1.0])], "query_id long, question string, vector array<double>")
    got = ans.retrieval_prompts(asked, chunks, k=3).first()
    assert got.context == "b\n\na" and got.prompt.startswith("Context: b\n\na\nQuestion: q\n")


def test_lists_are_topped_up_and_capped(spark):
    df = spark.createDataFrame([("x",)], "topic string")
    short = lambda asked: pd.Series(["one,,,two,,, "] * len(asked), index=asked.index)
    got = ans.generate_lists(df, "questions", "topic", 3, short).first()
    assert got["items"] == ["one", "two", "one"] and got.error is None


def test_no_topic_is_lost(spark):
    df = spark.createDataFrame([("slow",), ("mute",), ("bad",), (None,)], "topic string")

    def model(asked):
        if asked.str.contains("bad").any():
            raise ValueError("down")
        return asked.map(lambda a: "one" if "slow" in a else "")

    got = {r.topic: (r["items"], r.error) for r in ans.generate_lists(df, "questions", "topic", 4, model).collect()}
    assert got["slow"] == (["one"] * 4, None)
    assert got["mute"] == ([], "only 0 of 4")
    assert got["bad"] == ([], "ValueError: down")
    assert got[None][0] == [] and got[None][1] is not None


def test_too_few_answers_become_errors(spark):
    df = spark.createDataFrame([("a",), ("b",)], "p string")
    got = ans.generate(df, "p", lambda asked: asked[asked != "b"]).collect()
    assert {r.p: (r.answer, r.error) for r in got} == {"a": ("a", None), "b": (ans.FAILED, "ValueError: 0 answers to 1 prompts")}


def test_question_ids_beyond_turn_1000(spark, tmp_path):
    from corpusmill.plans import retrieval

    rows = [(1, 1001, "user", "x"), (2, 1, "user", "y")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert retrieval.questions(spark, str(tmp_path)).select("query_id").distinct().count() == 2


def test_judge_prompt_and_scores(spark):
    df = spark.createDataFrame([("q", "a")], "question string, response string")
    reply = lambda asked: pd.Series(["Accuracy: [4]\nRelevance: 3\nEvaluation: Groundedness?"] * len(asked))
    got = ans.judge_scores(ans.judge(df, reply)).first()
    assert (got.accuracy_judge, got.relevance_judge, got.groundedness_judge) == (4, 3, None)
    prompt = df.select(prompts.judge_request(F.col("question"), F.col("response")).alias("p")).first().p
    assert prompt.endswith("Question: q\nAnswer: a") and "Groundedness: [grade]" in prompt


def test_model_scores_load_once_per_task(spark):
    df = spark.createDataFrame([("good",), ("bad",)], "t string").coalesce(1)

    def load():
        calls = []

        def model(texts):
            calls.append(1)
            return [("POS" if t == "good" else "NEG", float(len(calls))) for t in texts]

        return model

    got = {r.t: (r.Label, r.Score) for r in ans.score_with(df, "t", load).collect()}
    assert got == {"good": ("POS", 1.0), "bad": ("NEG", 1.0)}


def test_lexicon(spark):
    df = spark.createDataFrame([("good good bad",), ("bad",), ("what",), ("Good bad",)], "t string")
    got = [tuple(r.s) for r in df.select(ans.lexicon_label(F.col("t"), ["good"], ["bad"]).alias("s")).collect()]
    assert got == [("POS", pytest.approx(1 / 3)), ("NEG", 1.0), ("NEU", 0.0), ("NEU", 0.0)]


def test_classifier_learns_and_keeps_rows(spark, tmp_path):
    rows = [(i, "nice kind day" if i % 2 else "awful mean night", i % 2) for i in range(60)]
    df = spark.createDataFrame(sorted(rows, key=lambda r: r[2]), "id long, text string, label int")
    model = classify.train(df, buckets=1 << 10)
    scored = classify.predict(model, df)
    assert scored.columns == ["id", "text", "label", "predicted"] and scored.count() == 60
    assert met.binary_metrics(scored, "label", "predicted").first().f1 == 1.0
    classify.write_model(model, spark, str(tmp_path / "m"))
    back = classify.read_model(spark, str(tmp_path / "m"))
    assert (back.weights == model.weights).all() and (back.idf == model.idf).all()
    assert back.intercept == model.intercept


def test_training_is_repeatable(spark):
    df = spark.createDataFrame([(f"w{i % 7} w{i % 5}", i % 2) for i in range(50)], "text string, label int")
    a, b = (classify.train(df, buckets=256) for _ in range(2))
    assert (a.weights == b.weights).all()


def test_model_does_not_depend_on_cores_or_layout(tmp_path):
    script = tmp_path / "fit.py"
    script.write_text(
        """
import sys
from corpusmill.operators import classify
from corpusmill.session import get_session

cores, parts = sys.argv[1:]
spark = get_session("fit", f"local[{cores}]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": parts})
rows = [(f"w{i % 17} w{i % 11} w{i % 5}", int(i % 3 == 0)) for i in range(300)] + [("same words", 1)] * 90
model = classify.train(spark.createDataFrame(rows, "text string, label int").repartition(int(parts)), buckets=256)
print("MODEL", model.weights.tobytes().hex(), model.intercept)
"""
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    said = [
        subprocess.run(
            [sys.executable, script, *args], env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=300
        ).stdout.split("MODEL")
        for args in (("2", "3"), ("4", "5"))
    ]
    assert len(said[0]) == 2 and said[0][1] == said[1][1]


def test_retraining_helps_on_new_words(spark):
    old = spark.createDataFrame([("nice kind", 1), ("awful mean", 0)] * 20, "text string, label int")
    new = spark.createDataFrame([("splendid", 1), ("dreadful", 0)] * 20, "text string, label int")
    before, after = classify.retrain(old, new, buckets=1 << 10)
    accuracy = lambda m: met.binary_metrics(classify.predict(m, new), "label", "predicted").first().accuracy
    assert accuracy(before) <= 0.5 < accuracy(after) == 1.0


def plain_training(rows, buckets):
    """The steps of `train` row by row in whole numbers."""
    import hashlib
    import math
    import re
    from collections import Counter

    def ids(text):
        return [int(hashlib.md5(w.encode()).hexdigest()[:7], 16) % buckets for w in re.findall(r"\w{2,}", (text or "").lower())]

    rows = [(Counter(ids(text)), 1 if label else -1) for text, label in rows if label is not None]
    df = Counter(b for words, _ in rows for b in words)
    idf = [math.log((1 + len(rows)) / (1 + df[b])) + 1 for b in range(buckets)]
    x = []
    for words, _ in rows:
        raw = {b: n * idf[b] for b, n in words.items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        x.append({b: math.floor(v / length * classify.VALUE + 0.5) for b, v in raw.items()})
    w, c = [0] * buckets, 0
    twice = {y: 2 * max(1, sum(s == y for _, s in rows)) for y in (1, -1)}
    for length, intercept in classify.step_lengths():
        asked, count = {1: Counter(), -1: Counter()}, Counter()
        for values, (_, y) in zip(x, rows):
            if y * (sum(w[b] * v for b, v in values.items()) + c * classify.VALUE) < classify.WEIGHT * classify.VALUE:
                asked[y].update(values)
                count[y] += 1
        for y in (1, -1):
            for b, v in asked[y].items():
                w[b] += y * (v * length // twice[y])
            c += y * (count[y] * intercept // twice[y])
    return w, c


def test_training_equals_plain_steps(spark):
    rows = [(f"w{i % 17} w{i % 11} w{i % 11} w{i % 5}", int(i % 3 == 0)) for i in range(300)]
    rows += [("same words", 1)] * 90 + [(None, 0), ("", 1), ("no label", None)]
    model = classify.train(spark.createDataFrame(rows, "text string, label int").repartition(7), buckets=256)
    weights, intercept = plain_training(rows, 256)
    assert model.weights.tolist() == weights and model.intercept == intercept


def test_training_on_one_class_and_on_nothing(spark):
    for rows in ([], [("only this", 1)] * 3):
        df = spark.createDataFrame(rows, "text string, label int")
        model = classify.train(df, buckets=64)
        assert classify.predict(model, df).where("predicted <> label").count() == 0


def test_a_step_moves_sums_that_meet_before_the_driver(spark):
    """Partial sums are combined by bucket; nothing lists the tasks' results."""
    import inspect

    assert "collect_list" not in inspect.getsource(classify)
    assert classify._scaled([2**60, 3], 1 << 10, 1 << 12).tolist() == [2**57, 0]


def test_classifier_weights_equal_relational_tfidf(spark):
    df = spark.createDataFrame([(0, "tea tea cup", 1), (1, "tea pot", 0), (2, "pot pot pot lid", 1)], "id long, text string, label int")
    ids = df.select("id", (F.col("label") > 0).alias("positive"), token_ids(F.col("text"), 1 << 12).alias("ids"))
    positive, negative, idf = classify._document_weights(ids, 1 << 12)
    assert (positive, negative) == (2, 1)
    weighed = classify.features(ids.select("id", "ids"), "ids", spark.sparkContext.broadcast(idf))
    got = {r.id: sorted(x / classify.VALUE for x in r.value) for r in weighed.collect()}
    for r in tfidf(df, "id", "text").groupBy("id").agg(F.sort_array(F.collect_list("weight")).alias("w")).collect():
        assert got[r.id] == pytest.approx(r.w, abs=1 / classify.VALUE)


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([("a", "good"), ("b", "bad"), ("a", "bad")] * 5, "lang string, text string")
    for i in range(3):
        df.write.mode("append").parquet(str(tmp_path / "in"))
    score = lambda b: b.select("lang", F.upper("text").alias("predicted"))
    stream = batches.arriving(spark, str(tmp_path / "in"), df.schema, files_per_batch=1)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    batches.score_batches(stream, score, "lang", "predicted", out, state).awaitTermination()
    whole = lambda: sorted(tuple(r) for r in spark.read.parquet(out).groupBy("actual", "predicted").agg(F.sum("n")).collect())
    want = [("a", "BAD", 15), ("a", "GOOD", 15), ("b", "BAD", 15)]
    assert whole() == want
    # A restart with nothing new changes nothing; a new file is added.
    again = batches.arriving(spark, str(tmp_path / "in"), df.schema, files_per_batch=1)
    batches.score_batches(again, score, "lang", "predicted", out, state).awaitTermination()
    assert whole() == want


def test_batch_metrics_equal_metrics_of_the_rows(spark):
    rows = [(b, a, p) for b in (0, 1) for a, p in [("x", "x"), ("x", "y"), ("y", "y"), ("z", "x")] for _ in range(b + 2)]
    df = spark.createDataFrame(rows, "batch long, actual string, predicted string")
    counts = met.confusion(df, "actual", "predicted", ["batch"])
    want = {r.batch: tuple(r)[1:] for r in met.weighted_metrics(df, "actual", "predicted", ["batch"]).collect()}
    got = {r.batch: tuple(r)[1:] for r in batches.batch_metrics(counts).collect()}
    assert got == want


def test_user_metric_gets_counts_only(spark):
    df = spark.createDataFrame([("r", "a", "a")] * 1000 + [("r", "a", "b")] * 10, "run string, actual string, predicted string")

    def accuracy(counts):
        assert len(counts) == 2
        right = counts.loc[counts.actual == counts.predicted, "n"].sum()
        return pd.DataFrame({"run": ["r"], "value": [right / counts["n"].sum()]})

    got = udfs.metric(df, "actual", "predicted", accuracy, "run string, value double").first()
    assert got.value == pytest.approx(1000 / 1010)


@pytest.mark.parametrize("fan_in", [2, 64])
def test_merged_metric_of_hot_and_null_groups(spark, fan_in):
    rows = [("hot", i % 7, i % 5) for i in range(3000)] + [("cold", 1, 2), (None, 3, 3)]
    df = spark.createDataFrame(rows, "run string, a int, b int").repartition(11)

    def partial(part):
        assert list(part.columns) == ["a", "b"]
        return [(part.a - part.b).abs().max(), len(part)]

    def merge(x, y):
        return [max(x[0], y[0]), x[1] + y[1]]

    got = {r.run: r.value for r in udfs.merged_metric(df, ["a", "b"], partial, merge, lambda s: s[0] * 10_000 + s[1], fan_in=fan_in).collect()}
    assert got == {"hot": 63000.0, "cold": 10001.0, None: 1.0}
    assert udfs.merged_metric(df.limit(0), ["a", "b"], partial, merge, lambda s: s[0]).count() == 0


def test_scored_rows_are_kept_once_and_meet_late_labels(spark, tmp_path):
    schema, names = "id long, text string", {n: str(tmp_path / n) for n in ("in", "out", "state", "labels", "labelled", "lstate")}
    score = lambda b: b.select("id", F.upper("text").alias("said"))

    def run_rows():
        stream = batches.arriving(spark, names["in"], spark.createDataFrame([], schema).schema)
        batches.keep_scored(stream, score, names["out"], names["state"]).awaitTermination()

    def run_labels():
        stream = batches.arriving(spark, names["labels"], spark.createDataFrame([], "id long, label string").schema)
        batches.keep_labelled(stream, names["out"], "id", names["labelled"], names["lstate"]).awaitTermination()

    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.mode("append").parquet(names["in"])
    run_rows()
    spark.createDataFrame([(1, "A"), (9, "?")], "id long, label string").write.mode("append").parquet(names["labels"])
    run_labels()
    spark.createDataFrame([(3, "c")], schema).write.mode("append").parquet(names["in"])
    run_rows()
    run_rows()
    spark.createDataFrame([(3, "X"), (2, "B")], "id long, label string").write.mode("append").parquet(names["labels"])
    run_labels()
    assert sorted(tuple(r) for r in batches.kept(spark, names["out"]).select("batch", "id", "said").collect()) == [(0, 1, "A"), (0, 2, "B"), (1, 3, "C")]
    got = sorted(tuple(r) for r in batches.kept(spark, names["labelled"]).select("batch", "scored_batch", "id", "said", "label").collect())
    assert got == [(0, 0, 1, "A", "A"), (1, 0, 2, "B", "B"), (1, 1, 3, "C", "X")]
    # A batch that is written again replaces its folder.
    again = batches.arriving(spark, names["in"], spark.createDataFrame([], schema).schema)
    batches.keep_scored(again, score, names["out"], str(tmp_path / "fresh")).awaitTermination()
    assert batches.kept(spark, names["out"]).where("batch = 0").count() == 3


def test_answers_by_arm_are_one_write(spark, tmp_path):
    from corpusmill.sources import readers

    rows = [("q1?", ["c1", "c2"], "c1\n\nc2"), ("q2?", None, None)]
    asked = spark.createDataFrame(rows, "question string, contexts array<string>, context string")
    model = lambda p: p + " Answer: " + p.str.contains("c1").astype(str)
    ans.write_answers(ans.arm_prompts(asked, ARMS), model, str(tmp_path / "a"))
    got = readers.read_results(spark, str(tmp_path / "a"), "query string, contexts string, answer string").collect()
    assert {(r.query, r.contexts, r.answer, r.source) for r in got} == {
        (q, '["c1","c2"]' if rag and q == "q1?" else "[]", str(rag and q == "q1?"), arm) for q in ("q1?", "q2?") for arm, _, rag in ARMS
    }


def test_a_model_gets_prompts_alone_and_once(spark, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()

    def model(asked):
        import uuid

        (log / uuid.uuid4().hex).write_text("\n".join(asked))
        return asked.str.upper()

    df = spark.createDataFrame([(i, f"p{i}" if i % 3 else None, "wide" * 100) for i in range(40)], "id long, prompt string, wide string")
    got = ans.generate(df, "prompt", model).filter("error IS NULL AND answer IS NOT NULL").select("id", "answer")
    assert {r.id: r.answer for r in got.collect()} == {i: f"P{i}" for i in range(40) if i % 3}
    asked = [line for f in log.iterdir() for line in f.read_text().split("\n")]
    assert sorted(asked) == sorted(f"p{i}" for i in range(40) if i % 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and plan.count("ArrowEvalPython") == 1
