import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import vectors as vec


def brute(corpus, queries, k, metric):
    rows = []
    for q, a in queries:
        scored = []
        for i, b in corpus:
            a_, b_ = np.array(a, float), np.array(b, float)
            if metric == "cosine":
                n = np.linalg.norm(a_) * np.linalg.norm(b_)
                score = round(float(a_ @ b_ / n), 6) if n else 0.0
                scored.append((-score, i, score))
            else:
                score = round(float(((a_ - b_) ** 2).sum()), 6)
                scored.append((score, i, score))
        rows += [(q, i, s, r + 1) for r, (_, i, s) in enumerate(sorted(scored)[:k])]
    return sorted(rows)


def make(seed, n, copies):
    rng = np.random.default_rng(seed)
    data = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(n)]
    # A third of the corpus is one vector, so ties reach far beyond k.
    return [(i, [1.0, 2.0, 0.0, -1.0, 0.5, 0.0] if copies and i % 3 == 0 else v) for i, v in data] + [(n, [0.0] * 6)]


@pytest.fixture(scope="module")
def data(spark):
    corpus, queries = make(1, 300, True), make(2, 40, False)
    c = spark.createDataFrame(corpus, "id long, vector array<float>").repartition(5)
    q = spark.createDataFrame(queries, "query_id long, vector array<float>").repartition(3)
    return corpus, queries, c, q


def found(df):
    return sorted((r.query_id, r.id, r.score, r["rank"]) for r in df.collect())


def same(got, want):
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], atol=2e-6)


@pytest.mark.parametrize("metric", vec.METRICS)
@pytest.mark.parametrize("k", [1, 5, 150])
def test_every_plan_equals_brute_force(data, monkeypatch, metric, k):
    corpus, queries, c, q = data
    want = brute(corpus, queries, k, metric)
    same(found(vec.nearest(c, q, k, metric)), want)
    monkeypatch.setattr(vec, "TILE_ROWS", 60)
    same(found(vec.nearest(c, q, k, metric, broadcast_bytes=500)), want)
    index = vec.cell_index(c, cells=9, metric=metric)
    same(found(vec.nearest_pruned(index, q, k, metric, tile_rows=40, query_rows=15)), want)
    forced = vec.nearest_pruned(index, q, k, metric, tile_rows=40, query_rows=15, min_saving=0)
    same(found(forced), want)


def test_small_score_blocks(data, monkeypatch):
    corpus, queries, c, q = data
    monkeypatch.setattr(vec, "SCORE_CELLS", 100)
    same(found(vec.nearest(c, q, 4)), brute(corpus, queries, 4, "cosine"))


def test_fewer_rows_than_k_and_no_queries(spark, data):
    _, _, c, q = data
    few = c.filter("id < 2")
    assert vec.nearest(few, q, 5).groupBy("query_id").count().agg(F.max("count")).first()[0] == 2
    assert vec.nearest(c, q.limit(0), 5).count() == 0


@pytest.fixture(scope="module")
def clusters(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 100, (40, 16))
    rows = [(i, (centres[i % 40] + rng.normal(0, 1, 16)).tolist()) for i in range(4000)]
    return spark.createDataFrame(rows, "id long, vector array<double>").repartition(4)


@pytest.mark.parametrize("metric", vec.METRICS)
@pytest.mark.parametrize("bytes", [0, 1 << 20])
def test_pruning_engages_on_clusters(spark, clusters, monkeypatch, metric, bytes):
    asked = clusters.filter("id % 20 = 0").withColumnRenamed("id", "query_id")
    want = found(vec.nearest(clusters, asked, 3, metric))
    index = vec.cell_index(clusters, metric=metric)
    assert len(index.cells) > 40
    local = np.array([r.vector for r in asked.limit(50).collect()])
    local = vec._unit(local) if metric == "cosine" else local
    q, c = vec._visits(vec._bounds(index), local, 3, 6)
    assert len(c) / 50 < 0.3 * len(index.cells)
    monkeypatch.setattr(vec, "nearest", None)
    assert found(vec.nearest_pruned(index, asked, 3, metric, broadcast_bytes=bytes)) == want


def test_lists_of_cells_count_as_what_is_sent(clusters, monkeypatch):
    # 200 queries of 16 numbers fit in the limit, with the cells they visit they do not.
    asked = clusters.filter("id % 20 = 0").withColumnRenamed("id", "query_id")
    want, index = found(vec.nearest(clusters, asked, 3, "l2")), vec.cell_index(clusters, metric="l2")
    monkeypatch.setattr(vec, "_in_place", None)
    assert found(vec.nearest_pruned(index, asked, 3, "l2", broadcast_bytes=200 * (8 * 16 + 8))) == want


def test_merging_often_keeps_the_best(clusters, monkeypatch):
    asked = clusters.filter("id % 20 = 0").withColumnRenamed("id", "query_id")
    want, index = found(vec.nearest(clusters, asked, 3, "l2")), vec.cell_index(clusters, metric="l2")
    monkeypatch.setattr(vec, "PAIRS", 1)
    monkeypatch.setattr(vec, "PIVOT_CELLS", 1)
    assert found(vec.nearest_pruned(index, asked, 3, "l2")) == want


def test_cells_grow_with_the_corpus_within_a_bound(clusters, monkeypatch):
    assert len(vec.cell_index(clusters.limit(400), metric="l2").cells) <= 20 < len(vec.cell_index(clusters, metric="l2").cells)
    monkeypatch.setattr(vec, "PIVOT_BYTES", 8 * 16 * 5)
    assert len(vec.cell_index(clusters, metric="l2").cells) <= 5


def test_few_queries_do_not_move_the_index(clusters):
    asked = clusters.filter("id < 3").withColumnRenamed("id", "query_id")
    plan = vec.nearest_pruned(vec.cell_index(clusters, metric="l2"), asked, 3, "l2")._jdf.queryExecution().executedPlan().toString()
    assert "PythonCoGroup" not in plan and "FlatMapCoGroups" not in plan and "BroadcastHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in plan


def test_the_tree_places_rows_near_the_best_pivot(clusters):
    x = np.array([r.vector for r in clusters.collect()])
    tree = vec.pivot_tree(x[:200])
    cell, reach = vec._descend(tree, x)
    assert np.allclose(np.linalg.norm(x - tree.pivots[cell], axis=1), reach, atol=1e-4)
    best = vec._distances(x, tree.pivots).min(axis=1)
    assert (reach <= best + 1e-6).mean() > 0.9


def test_text_ids(spark):
    rows = [(f"k{i}", [float(i), 1.0]) for i in range(30)]
    c = spark.createDataFrame(rows, "id string, vector array<double>")
    got = vec.nearest(c, c.withColumnRenamed("id", "query_id"), 2, "l2").filter("query_id = 'k10'").orderBy("rank").collect()
    assert [(r.id, r.score) for r in got] == [("k10", 0.0), ("k11", 1.0)]
    tiled = vec.nearest(c, c.withColumnRenamed("id", "query_id"), 2, "l2", broadcast_bytes=100)
    assert found(tiled) == found(vec.nearest(c, c.withColumnRenamed("id", "query_id"), 2, "l2"))


def test_an_empty_corpus_has_no_neighbours(spark, clusters):
    index = vec.cell_index(clusters.limit(0), metric="l2")
    assert vec.nearest_pruned(index, clusters.withColumnRenamed("id", "query_id").limit(3), 3, "l2").count() == 0


def test_hashed_embedding_counts_words(spark):
    df = spark.createDataFrame([("Tea tea cup", ), ("",)], "t string")
    a, b = [r.v for r in df.select(vec.hashed_embedding(F.col("t"), 16).alias("v")).collect()]
    assert sorted(a, reverse=True)[:2] in ([2.0, 1.0], [3.0, 0.0]) and sum(a) == 3 and sum(b) == 0 and len(b) == 16


def test_large_searches_send_rows_to_few_tasks(data, clusters, monkeypatch):
    _, _, c, q = data
    sent = []
    count = lambda corpus, queries: sent.append((corpus.select(F.sum(F.size("blocks"))).first()[0], queries.count()))
    monkeypatch.setattr(vec, "_by_tiles", lambda corpus, queries, *options: count(corpus, queries))
    vec.nearest(c, q, 3, broadcast_bytes=100)
    assert sent.pop() == (301, 41)
    # 200 queries in blocks of 15, but few of them in a cell.
    asked = clusters.filter("id % 20 = 0").withColumnRenamed("id", "query_id")
    vec.nearest_pruned(vec.cell_index(clusters, metric="l2"), asked, 3, "l2", query_rows=15, broadcast_bytes=0)
    assert sent.pop()[0] < 2 * 4000


@pytest.mark.parametrize("metric", vec.METRICS)
@pytest.mark.parametrize("k", [1, 5, 150])
def test_packed_rows_equal_brute_force(data, monkeypatch, metric, k):
    corpus, queries, c, q = data
    monkeypatch.setattr(vec, "COPIES", 0)
    monkeypatch.setattr(vec, "TILE_BYTES", 8 * 6 * 60)
    monkeypatch.setattr(vec, "PACK_ROWS", 7)
    monkeypatch.setattr(vec, "ASKED_ROWS", 9)
    same(found(vec.nearest(c, q, k, metric, broadcast_bytes=500)), brute(corpus, queries, k, metric))
    # Ids and queries that come twice, in double precision.
    twice = c.union(c).withColumn("vector", F.col("vector").cast("array<double>"))
    got = found(vec.nearest(twice, q.union(q), k, metric, broadcast_bytes=500))
    monkeypatch.setattr(vec, "COPIES", 1e9)
    assert got == found(vec.nearest(twice, q.union(q), k, metric, broadcast_bytes=500))


def test_packed_rows_with_text_ids(clusters, monkeypatch):
    named = clusters.withColumn("id", F.concat(F.lit("k"), "id"))
    asked = named.withColumnRenamed("id", "query_id")
    want = found(vec.nearest(named, asked, 3))
    monkeypatch.setattr(vec, "COPIES", 0)
    assert found(vec.nearest(named, asked, 3, broadcast_bytes=100)) == want


def test_searches_of_many_pieces_move_packs(clusters, monkeypatch):
    monkeypatch.setattr(vec, "TILE_ROWS", 200)
    asked = clusters.withColumnRenamed("id", "query_id")
    moved = []
    monkeypatch.setattr(vec, "_by_packs", lambda corpus, queries, *rest: moved.append((corpus.rows, queries.rows, *rest[3:5])))
    monkeypatch.setattr(vec, "_by_tiles", None)
    vec.nearest(clusters, asked, 3, broadcast_bytes=100)
    corpus, queries, tiles, blocks = moved.pop()
    assert corpus.select(F.sum(F.size("names")), F.sum("size")).first() == (4000, 4000 * 16 * 8)
    assert corpus.count() <= 4000 // 10 and queries.count() <= 4000 // 10
    # Plain tiles of 200 rows would send each row of either side 20 times.
    assert tiles + blocks <= 20


def test_scores_found_before_narrow_the_search():
    rng = np.random.default_rng(9)
    rows, ids = rng.normal(0, 1, (6000, 16)).astype("float32"), np.arange(6000)
    for metric in vec.METRICS:
        want = vec._scored_best(rows[:50], 0, ids, rows, 3, metric, 6)
        best, worst = None, None
        for a in range(0, 6000, 2000):
            new = vec._block_best(rows[:50], ids[a : a + 2000], rows[a : a + 2000], 3, metric, 6, worst)
            assert worst is None or len(new[0]) < 150
            best = new if best is None else vec._merged(best, new, 3, metric)
            worst = vec._worst(best, 50, 3)
        assert np.array_equal(best[0], want[0]) and np.array_equal(best[1], want[1]) and np.allclose(best[2], want[2], atol=2e-6)


def test_pieces_give_all_cores_work_within_memory():
    assert vec._pieces(300, 40, 6, 8) == (1, 1)
    tiles, blocks = vec._pieces(50_000, 50_000, 64, 12)
    assert tiles * blocks >= 48 and max(tiles, blocks) <= 8
    assert vec._pieces(6_000_000, 400_000, 64, 12) == (120, 8)


@pytest.mark.parametrize("metric", vec.METRICS)
@pytest.mark.parametrize("kind", ["counts", "far", "copies", "zeros"])
def test_screened_scores_equal_all_scores(metric, kind, monkeypatch):
    rng = np.random.default_rng(3)
    rows = {
        "counts": rng.poisson(2.0, (3000, 16)).astype("float32"),
        "far": rng.normal(1000, 1, (3000, 16)),
        "copies": np.repeat(rng.normal(0, 1, (10, 16)), 300, axis=0),
        "zeros": np.zeros((3000, 16)),
    }[kind]
    asked, ids = np.r_[rows[:20], rng.normal(0, 3, (20, 16))], rng.permutation(3000)
    want = vec._scored_best(asked, 0, ids, rows, 5, metric, 6)
    monkeypatch.setattr(vec, "SCORE_CELLS", 10_000)
    monkeypatch.setattr(vec, "_scored_best", None)
    got = vec._block_best(asked, ids, rows, 5, metric, 6)
    assert np.array_equal(got[0], want[0]) and np.allclose(got[2], want[2], rtol=1e-9, atol=2e-6)
    if kind != "far":
        assert np.array_equal(got[1], want[1])


def test_numbers_beyond_single_precision(monkeypatch):
    rows = np.random.default_rng(4).normal(0, 1, (2000, 4)) * 1e30
    q, ids, scores = vec._block_best(rows[:3], np.arange(2000), rows, 2, "cosine", 6)
    assert ids[::2].tolist() == [0, 1, 2] and scores[::2].tolist() == [1.0, 1.0, 1.0]


def test_embeddings_hash_words_once_by_the_rule_of_token_ids(spark):
    from corpusmill.operators.features import token_ids

    rows = [("Tea tea cup été 4711",), ("",), (None,), ("cup " * 500,)]
    df = spark.createDataFrame(rows, "t string").coalesce(1).select("t", vec.hashed_embedding(F.col("t"), 16).alias("v"))
    assert "md5" not in df._jdf.queryExecution().executedPlan().toString()
    for row, (ids,) in zip(df.collect(), df.select(token_ids(F.col("t"), 16)).collect()):
        assert row.v == [float((ids or []).count(i + 1)) for i in range(16)]
