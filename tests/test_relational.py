import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import aggregates as agg
from corpusmill.operators import relational as rel


def test_inner_join_drops_both_sides_and_repeats_posts(spark):
    posts = spark.createDataFrame([("a", "A"), ("b", "B")], "Id string, Title string")
    comments = spark.createDataFrame([("a", 1), ("a", 2), ("x", 3)], "Id string, CommentId int")
    rows = rel.inner_join(comments, posts, "Id").collect()
    assert sorted((r.Id, r.CommentId, r.Title) for r in rows) == [("a", 1, "A"), ("a", 2, "A")]


def test_skewed_join_is_split(spark):
    """A key with a third of all rows: adaptive execution splits its partition."""
    keep = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    old = {k: spark.conf.get(k, None) for k in keep}
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        many = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("Id"),
            F.col("id").alias("CommentId"),
        )
        one = spark.range(200_000).select(F.col("id").alias("Id"), F.col("id").alias("t"))
        joined = rel.inner_join(many, one, "Id")
        assert joined.count() == 200_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_heavy_join_equals_plain_join(spark):
    many = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("k"), "id"
    )
    one = many.groupBy("k").agg(F.count("*").alias("n"))
    got = rel.heavy_join(many, one, "k", "n").select("k", "id", "n")
    assert got.exceptAll(many.join(one, "k").select("k", "id", "n")).count() == 0
    assert got.count() == 10_000


def test_lookup_fails_on_unknown_label(spark):
    df = spark.createDataFrame([("POS",), ("ODD",)], "Label string")
    good = rel.lookup(df.filter("Label = 'POS'"), {"POS": 2}, "Label", "label")
    assert good.first().label == 2
    with pytest.raises(Exception, match="unknown label: ODD"):
        rel.lookup(df, {"POS": 2}, "Label", "label").collect()


@pytest.mark.parametrize("n", [0, 1, 999, 3000, 6666, 9999, 10_000, 20_000])
def test_position_split_with_hot_value(spark, monkeypatch, n):
    # A third of the rows share one time; the cut falls inside, before and after it.
    monkeypatch.setattr(rel, "SMALL", 50)
    monkeypatch.setattr(rel, "BINS", 16)
    random.seed(3)
    rows = [(i, 500_000 if i % 3 == 0 else random.randint(-10**9, 10**9)) for i in range(10_000)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, t long")
    first, rest = rel.position_split(df, ["t", "id"], n)
    want = sorted(rows, key=lambda r: (r[1], r[0]))[:n]
    assert {r.id for r in first.collect()} == {r[0] for r in want}
    assert first.count() + rest.count() == 10_000


def test_position_split_by_timestamp_reaches_the_scan(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts")
    first, _ = rel.position_split(events, ["ts", "event_id"], 250)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(ts" in plan
    assert first.count() == 250


@pytest.mark.parametrize("small", [3, 10_000])
@pytest.mark.parametrize("n", [1, 3, 4, 5, 19])
def test_position_split_keeps_null_keys_first(spark, monkeypatch, n, small):
    monkeypatch.setattr(rel, "SMALL", small)
    rows = [(i, None if i % 5 == 0 else 100 - i) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, t long")
    first, rest = rel.position_split(df, ["t", "id"], n)
    want = [r[0] for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))]
    assert {r.id for r in first.collect()} == set(want[:n]) and {r.id for r in rest.collect()} == set(want[n:])


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_position_split_in_any_zone(spark, zone, kind):
    # Around the hour that New York skips.
    before = spark.conf.get("spark.sql.session.timeZone")
    times = ["2024-03-10 02:30:00.25", "2024-03-10 03:10:00", "2024-03-10 03:40:00"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stated = "" if kind == "timestamp_ntz" else "Z"
        rows = [(i, t + stated) for i, t in enumerate(times, 1)]
        df = spark.createDataFrame(rows, "id long, t string").withColumn("t", F.col("t").cast(kind))
        for n in (1, 2):
            first, rest = rel.position_split(df, ["t", "id"], n)
            assert sorted(r.id for r in first.select("id").collect()) == [1, 2][:n]
            assert sorted(r.id for r in rest.select("id").collect()) == [1, 2, 3][n:]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_ties_on_all_keys_are_refused(spark, monkeypatch):
    monkeypatch.setattr(rel, "SMALL", 5)
    df = spark.range(100).select(F.lit(1).cast("long").alias("t"))
    with pytest.raises(ValueError):
        rel.position_split(df, ["t"], 10)
    monkeypatch.setattr(rel, "SMALL", 1000)
    with pytest.raises(ValueError):
        rel.position_split(df, ["t"], 10)


def test_sample_split_is_exact_disjoint_and_seeded(spark):
    df = spark.range(1003)
    train, test = rel.sample_split(df, "id", 0.8, seed=42)
    a, b = {r.id for r in train.collect()}, {r.id for r in test.collect()}
    assert len(a) == round(0.8 * 1003) and not a & b and len(a | b) == 1003
    again, _ = rel.sample_split(df, "id", 0.8, seed=42)
    other, _ = rel.sample_split(df, "id", 0.8, seed=7)
    assert {r.id for r in again.collect()} == a != {r.id for r in other.collect()}


def test_majority_tie_takes_lowest(spark):
    df = spark.createDataFrame([(2,), (1,), (2,), (1,), (3,)], "label int")
    assert agg.majority(df, "label").first().label == 1


def test_answer_pairs_across_blocks_and_gaps(spark, monkeypatch):
    monkeypatch.setattr(agg, "TURN_BLOCK", 3)
    turns = [(1, t, "user" if i % 2 == 0 else "assistant", f"t{t}") for i, t in enumerate([0, 1, 2, 3, 7, 8, 20, 31])]
    turns += [(2, 0, "user", "alone"), (3, 5, "assistant", "x"), (3, 6, "user", "y"), (3, 40, "assistant", "z")]
    got = agg.answer_pairs(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    assert sorted((r.conv_id, r.turn, r.question, r.answer) for r in got.collect()) == [
        (1, 0, "t0", "t1"),
        (1, 2, "t2", "t3"),
        (1, 7, "t7", "t8"),
        (1, 20, "t20", "t31"),
        (3, 6, "y", "z"),
    ]


def test_pages_of_a_long_document_in_order(spark, monkeypatch):
    monkeypatch.setattr(agg, "PART_BLOCK", 4)
    pages = [(1, i, f"<{i}>") for i in range(25)] + [(2, 0, "only")]
    random.shuffle(pages)
    df = spark.createDataFrame(pages, "d long, p long, t string")
    got = {r.d: r.page_content for r in agg.text_without_last_page(df, "d", "p", "t").collect()}
    assert got == {1: "".join(f"<{i}>" for i in range(24)), 2: ""}


def test_last_pages_do_not_reorder_numbers(spark):
    df = spark.createDataFrame([(1, i, str(i)) for i in (10, 9, 2, 1, 11)], "d long, p long, t string")
    assert agg.text_without_last_page(df, "d", "p", "t").first().page_content == "12910"
