import random

import numpy as np
import pandas as pd
import pytest

from corpusmill.operators import metrics as met
from corpusmill.operators import ranks


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "a string, p string")


def rows(df):
    return {r.label: (r.precision, r.recall, r.f1, r.support) for r in df.collect()}


def test_report_by_hand(spark):
    pairs = [("x", "x"), ("x", "y"), ("y", "y"), ("y", "y"), ("z", "x")]
    got = rows(met.class_report(frame(spark, pairs), "a", "p"))
    assert got["x"] == (0.5, 0.5, 0.5, 2)
    assert got["y"] == pytest.approx((2 / 3, 1.0, 0.8, 2))
    assert got["z"] == (0.0, 0.0, 0.0, 1)
    assert got["accuracy"] == (None, None, 0.6, 5)
    assert got["macro avg"] == pytest.approx(((0.5 + 2 / 3) / 3, 0.5, 1.3 / 3, 5))
    assert got["weighted avg"] == pytest.approx(((1 + 4 / 3) / 5, 0.6, 2.6 / 5, 5))


def test_zero_division(spark):
    pairs = [("only_actual", "only_predicted"), ("x", "x")]
    for value in (0.0, 1.0):
        got = rows(met.class_report(frame(spark, pairs), "a", "p", zero_division=value))
        assert got["only_actual"] == (value, 0.0, 0.0, 1)
        assert got["only_predicted"] == (0.0, value, 0.0, 0)


def test_single_class(spark):
    got = rows(met.class_report(frame(spark, [("x", "x")] * 3), "a", "p"))
    assert got["x"] == (1, 1, 1, 3) and got["accuracy"][2] == 1


def test_actual_and_predicted_are_not_swapped(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (1, 0), (0, 0)], "a int, p int")
    got = met.binary_metrics(df, "a", "p").first()
    assert (got.precision, got.recall) == (1.0, pytest.approx(1 / 3))


def test_binary_without_positives(spark):
    df = spark.createDataFrame([(0, 0)], "a int, p int")
    assert tuple(met.binary_metrics(df, "a", "p").first()) == (1.0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("range_rows", [7, 600, 500_000])
def test_average_ranks_with_a_hot_tie(spark, monkeypatch, range_rows):
    monkeypatch.setattr(ranks, "RANGE_ROWS", range_rows)
    random.seed(1)
    values = [0.5 if i % 3 == 0 else random.choice([random.random(), 2.0]) for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.v: r.avg_rank for r in ranks.average_ranks(df, "v").collect()}
    want = pd.Series(values).rank()
    assert got == dict(zip(values, want))


def test_spearman_like_pandas(spark):
    random.seed(2)
    rows = [(random.randint(1, 5), random.randint(1, 5)) for _ in range(500)] + [(None, 3)]
    got = ranks.spearman(spark.createDataFrame(rows, "x int, y int"), "x", "y").first()
    full = pd.DataFrame(rows, columns=["x", "y"]).dropna()
    want = np.corrcoef(full.x.rank(), full.y.rank())[0, 1]
    assert got.n == 500 and got.rho == pytest.approx(want, abs=1e-12)


def test_spearman_of_constant_is_null(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "x int, y int")
    assert ranks.spearman(df, "x", "y").first().rho is None


@pytest.mark.parametrize("range_rows", [3, 500_000])
def test_ranks_and_agreement_by_group(spark, monkeypatch, range_rows):
    monkeypatch.setattr(ranks, "RANGE_ROWS", range_rows)
    rnd = random.Random(4)
    rows = [(rnd.choice(["x", "y", None]), rnd.randint(1, 9), rnd.choice([None, 1, 2, 3, 4]), rnd.randint(1, 3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, a int, b int, c int")
    frame = pd.DataFrame(rows, columns=["g", "a", "b", "c"])
    got = {(r.g, r.a): r.avg_rank for r in ranks.average_ranks(df, "a", by=["g"]).collect()}
    for g, part in frame.groupby("g", dropna=False):
        for a, rank in zip(part.a, part.a.rank()):
            assert got[None if pd.isna(g) else g, a] == rank
    found = {r.criterion: (r.n, r.rho) for r in ranks.agreement(df, {"one": ("a", "b"), "two": ("a", "c")}).collect()}
    for name, other in (("one", "b"), ("two", "c")):
        both = frame[["a", other]].dropna()
        assert found[name][0] == len(both)
        assert found[name][1] == pytest.approx(np.corrcoef(both.a.rank(), both[other].rank())[0, 1], abs=1e-12)
    assert ranks.spearman(df.limit(0), "a", "b").first().n == 0
    assert ranks.agreement(df.limit(0), {"one": ("a", "b")}).count() == 0
