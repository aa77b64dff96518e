"""One end-to-end run per lifecycle."""

import pandas as pd
from pyspark.sql import functions as F

from corpusmill.functions import text
from corpusmill.operators import aggregates as agg
from corpusmill.operators import answers as ans
from corpusmill.operators import chunks as ch
from corpusmill.operators import classify, ranks
from corpusmill.operators import documents as doc
from corpusmill.operators import metrics as met
from corpusmill.operators import relational as rel
from corpusmill.operators import vectors as vec
from corpusmill.plans.stats import three_way
from corpusmill.plans.tables import ARMS
from corpusmill.session import table
from corpusmill.sources import readers, writers


def test_classification(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    rows = rows.select("doc_id", "text", F.col("quality").alias("label")).withColumn("split", three_way(F.col("doc_id")))
    sizes = {r.split: r.n for r in agg.count_by(rows, "split").collect()}
    assert set(sizes) == {"train", "validation", "test"} and sum(sizes.values()) == rows.count()
    train = readers.read_split(rows, "train", "text", "label")
    model = classify.train(train, buckets=1 << 14)
    scored = classify.predict(model, rows.filter("split <> 'train'"))
    trained = {r.split: r.accuracy for r in met.binary_metrics(scored, "label", "predicted", by=["split"]).collect()}
    base = agg.with_majority(rows.filter("split <> 'train'"), train, "label")
    majority = {r.split: r.accuracy for r in met.binary_metrics(base, "label", "predicted", by=["split"]).collect()}
    assert trained.keys() == majority.keys() == {"validation", "test"}
    report = met.class_report(base, "label", "predicted", by=["split"], zero_division=1)
    assert report.filter("label = 'accuracy'").count() == 2
    gap = met.split_gap(classify.predict(model, rows), "split", "label", "predicted").first()
    assert abs(gap.train - gap.validation - gap.gap_validation) < 1e-12


def test_forum_sentiment(spark, sf, tmp_path):
    posts = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Id"), F.col("o_orderpriority").alias("Title"), F.col("o_orderdate").alias("Created")
    )
    comments = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("Id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("CommentId"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("Comment"),
        F.col("l_shipdate").alias("CommentCreated"),
    ).dropDuplicates(["CommentId"])
    joined = rel.inner_join(comments, posts, "Id")
    assert joined.count() == comments.count()
    since = F.lit("1998-01-01").cast("timestamp_ntz")
    unified = rel.union_all(
        posts.select(F.col("Id").cast("string"), F.col("Title").alias("Text"), "Created").filter(F.col("Created") >= since),
        comments.select(
            F.col("CommentId").alias("Id"), F.col("Comment").alias("Text"), F.col("CommentCreated").alias("Created")
        ).filter(F.col("Created") >= since),
    )
    label = ans.lexicon_label(F.col("Text"), ["low", "not", "specified"], ["urgent", "high"])["label"]
    scored = unified.withColumn("Label", label)
    first, last = agg.time_range((scored, "Created")).first()
    assert first.year == 1998 and first <= last
    writers.write_csv(rel.newest_first(scored, "Created", "Id"), str(tmp_path / "unified"))
    schema = "Id string, Text string, Created timestamp_ntz, Label string"
    back = readers.read_csv(spark, str(tmp_path / "unified"), schema)
    assert back.count() == scored.count()
    # A person labels the newest 500; here the human sees only one thing differently.
    batch = rel.newest(back, "Created", "Id", 500).withColumn(
        "HumanLabel", F.when(F.col("Text") == "5-LOW", "NEG").otherwise(F.col("Label"))
    )
    numbered = batch.withColumn("key", F.abs(F.xxhash64("Id")))
    one, two = rel.position_split(numbered, ["Created", "key"], 250)
    assert (one.count(), two.count()) == (250, 250)
    assert one.join(two, "Id").count() == 0
    assert one.agg(F.max("Created")).first()[0] <= two.agg(F.min("Created")).first()[0]
    report = met.class_report(one, actual="HumanLabel", predicted="Label")
    assert report.filter("label = 'weighted avg'").first().support == 250
    ids = {"POS": 1, "NEG": 0, "NEU": 0}
    ready = [rel.lookup(b, ids, "HumanLabel", "label").select(F.col("Text").alias("text"), "label") for b in (one, two)]
    model = classify.train(ready[0], buckets=1 << 12)
    assert classify.predict(model, ready[1]).count() == 250


def test_retrieval_answers_and_judging(spark, sf, tmp_path):
    web = doc.with_nodes(table(spark, sf, "pages"))
    articles = doc.regions(web, tag="article").select(
        F.col("page_id").alias("doc_id"),
        text.clean_paragraphs(F.col("page_content")).alias("text"),
        F.create_map(F.lit("source"), F.col("url"), F.lit("category"), F.lit("web")).alias("metadata"),
    )
    pieces = ch.chunk_corpus(articles)
    store = pieces.select(
        ch.chunk_id(F.col("doc_id"), F.col("chunk_index")).alias("id"),
        vec.hashed_embedding(F.col("page_content"), 64).alias("vector"),
        "page_content",
        "metadata",
    )
    writers.write_vectors(store, str(tmp_path / "store"))
    chunks = spark.read.parquet(str(tmp_path / "store"))
    assert chunks.count() == chunks.select("page_content").distinct().count()
    asked = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"),
        text.parse_question(F.col("text"))["query"].alias("question"),
        vec.hashed_embedding(F.col("text"), 64).alias("vector"),
    )
    prompts = ans.retrieval_prompts(asked, chunks, k=3)
    grid = ans.arm_prompts(prompts, ARMS)
    answered = ans.generate(grid, "prompt", lambda p: p.str.len().astype(str) + " Answer: because Answer: yes ")
    final = answered.withColumn("answer", text.after_last(F.col("answer"), "Answer:"))
    for arm, _, _ in ARMS:
        part = final.filter(F.col("arm") == arm).select(F.col("question").alias("query"), "answer")
        writers.write_csv(part, str(tmp_path / "out" / f"results_{arm}.csv"))
    results = readers.read_results(spark, str(tmp_path / "out"), "query string, answer string")
    assert {r.source: r.n for r in agg.count_by(results, "source").collect()} == {
        arm: asked.count() for arm, _, _ in ARMS
    }
    named = results.withColumnsRenamed({"query": "question", "answer": "response"})
    judge = lambda p: pd.Series([f"Accuracy: [{1 + len(t) % 5}]\nRelevance: 3\n" for t in p], index=p.index)
    judged = ans.judge_scores(ans.judge(named, judge))
    means = agg.arm_means(judged, "source", ["accuracy_judge", "relevance_judge"]).collect()
    assert len(means) == 4 and all(r.mean_relevance_judge == 3 for r in means)
    human = judged.withColumn("human", F.col("accuracy_judge") * 2)
    assert abs(ranks.spearman(human, "accuracy_judge", "human").first().rho - 1) < 1e-12
