"""Embeddings and exact nearest neighbours.

All searches return (query_id, id, score, rank) and rank by the score rounded to
`digits`, then by id, so every plan gives the same answer. Pairs are scored as
matrix blocks inside tasks; only the best k per query leave a task.
"""

import math
from hashlib import md5
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.arrays import let
from corpusmill.functions.slices import sliced
from corpusmill.functions.text import words
from corpusmill.session import scratch_path, written

METRICS = ("cosine", "l2")
# Kinds of ids.
ARROW = {"long": pa.int64(), "string": pa.string()}

# A query block of this many bytes is broadcast; larger query sets are tiled.
BROADCAST_BYTES = 16 << 20
# Scores held at once by one task.
SCORE_CELLS = 4 << 20
TILE_ROWS = 50_000
# The vectors of one side of a task's pairs, as doubles.
TILE_BYTES = 64 << 20
# A search is cut into this many tasks a core at least, so that no task is much longer than the others.
TASKS_A_CORE = 4
# Rows whose largest product stands for them, pairs scored at once, and numbers whose squares single precision holds.
GROUP, PAIRS, SINGLE_MOST = 32, 1 << 18, 1e15
# Rows and queries multiplied at once: their products stay in a core's cache.
CACHED_ROWS, CACHED_QUERIES = 1024, 512
# A search that would move its rows more often than this on average packs them first: rows of a pack, and packs of a piece,
# so that pieces are about equal. Queries that a task compares with a part of its corpus piece at once.
COPIES, PACK_ROWS, PACKS, ASKED_ROWS, PACKING = 2, 8192, 16, 16_384, "zstd"


# --- embeddings -----------------------------------------------------------


def hashed_embedding(text: Column, width=64) -> Column:
    """Word counts in `width` hash buckets, those of `token_ids`: an embedding without a model.

    A word is hashed once for all its places in some texts.
    """

    def count(lists):
        coded = lists.flatten().dictionary_encode()
        bucket = np.array([int(md5(w.encode()).hexdigest()[:7], 16) % width for w in coded.dictionary.to_pylist()], np.int64)
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        counts = np.bincount(row * width + bucket[coded.indices.to_numpy()], minlength=len(lists) * width).astype("float32")
        return pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1) * width, pa.int32()), pa.array(counts))

    return sliced("array<float>", count)(words(text))


def embed(df: DataFrame, text: str, make_model, target="embedding") -> DataFrame:
    """Embed with a caller's model; `make_model()` runs once per task and returns texts -> vectors."""
    from collections.abc import Iterator

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for texts in batches:
            yield pd.Series([np.asarray(v, dtype="float32") for v in model(list(texts))])

    return df.withColumn(target, run(text))


# --- scoring blocks -------------------------------------------------------


def _unit(v):
    length = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return np.divide(v, length, out=np.zeros_like(v), where=length > 0)


def _matrix(values):
    return np.stack([np.asarray(v, dtype="float64") for v in values])


def _arrow_matrix(column, kind="float64"):
    """Rows of equal length as one matrix, without a Python object per row; `kind` None leaves the numbers as they are."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return (values if kind is None else values.astype(kind)).reshape(len(column), -1)


def _names(column):
    """Ids as an array that sorts like the column: whole numbers, or texts by code points."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False).astype("int64")
    return np.array(column.to_pylist(), dtype="U") if len(column) else np.zeros(0, "U1")


def _kind(df: DataFrame, name: str) -> str:
    """long for any whole number, string for the rest."""
    kind = dict(df.dtypes)[name]
    return "long" if kind in ("tinyint", "smallint", "int", "bigint") else "string"


def _result(corpus: DataFrame, queries: DataFrame):
    """(Spark schema, Arrow schema) of scored pairs."""
    kinds = {"query_id": _kind(queries, "query_id"), "id": _kind(corpus, "id")}
    spark = ", ".join([*(f"{n} {k}" for n, k in kinds.items()), "score double"])
    return spark, pa.schema([*((n, ARROW[k]) for n, k in kinds.items()), ("score", pa.float64())])


def _pairs(schema, names, q, ids, scores):
    return [pa.array(a, t.type) for a, t in zip((names[q], ids, scores), schema)]


def _keep_best(q, ids, scores, k, sign):
    """The k best (score, then id) of every query in flat arrays."""
    order = np.lexsort((ids, -sign * scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    starts = np.r_[0, np.flatnonzero(np.diff(q)) + 1] if len(q) else np.zeros(0, int)
    place = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
    keep = place < k
    return q[keep], ids[keep], scores[keep]


def _block_best(queries, ids, vectors, k, metric, digits, worst=None):
    """Flat (query row, id, score) of the best k of one block.

    All pairs are multiplied in single precision; only those that its error bound leaves among the best k are scored in
    double precision. Blocks with numbers that single precision has no room for are scored in full. `worst` has the
    k-th best score that every query has found elsewhere, or nan: pairs beyond it are left out.
    """
    queries, vectors = np.asarray(queries), np.asarray(vectors)
    largest = max((float(np.abs(m).max()) if m.size else 0.0) for m in (queries, vectors))
    # Else nothing is gained, or (nan) nothing is known.
    if len(ids) < 4 * k * GROUP or not largest < SINGLE_MOST:
        step = max(1, SCORE_CELLS // max(1, len(ids)))
        return _joined([_scored_best(queries[i : i + step], i, ids, vectors, k, metric, digits) for i in range(0, len(queries), step)])
    asked, answers, slack, floor = _screens(queries, vectors, metric, digits, worst)
    groups, width = len(answers) // GROUP, answers.shape[1]
    step, lists = max(1, min(CACHED_QUERIES, SCORE_CELLS // groups)), max(1, PAIRS // (4 * GROUP))
    room = np.empty(CACHED_ROWS * step, "float32")
    lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype="float64"))
    found = []
    for low in range(0, len(queries), step):
        part = asked[low : low + step]
        tops = np.empty((groups, len(part)), "float32")
        for a in range(0, len(answers), CACHED_ROWS):
            rows = answers[a : a + CACHED_ROWS]
            near = np.matmul(rows, part.T, out=room[: len(rows) * len(part)].reshape(len(rows), len(part)))
            near.reshape(-1, GROUP, len(part)).max(axis=1, out=tops[a // GROUP : (a + len(rows)) // GROUP])
        # Where the scores found elsewhere leave many groups or are not known: k groups reach the k-th largest of the
        # groups' maxima, so k pairs do.
        border = floor[low : low + step].copy()
        wide = np.flatnonzero(np.isnan(border) | ((tops >= border).sum(axis=0) > 4 * k))
        own = np.partition(np.ascontiguousarray(tops.T[wide]), groups - k, axis=1)[:, groups - k]
        border[wide] = np.fmax(border[wide], own - slack[low : low + step][wide])
        row, group = np.nonzero(tops.T >= border[:, None])
        for a in range(0, len(row), lists):
            q, g = row[a : a + lists], group[a : a + lists]
            near = np.matmul(answers.reshape(groups, GROUP, width)[g], part[q][:, :, None])[:, :, 0]
            pair, place = np.nonzero(near >= border[q, None])
            q, column = q[pair] + low, g[pair] * GROUP + place
            q, column = q[column < len(ids)], column[column < len(ids)]
            parts = [_pair_scores(queries, vectors, lengths, q[b : b + PAIRS], column[b : b + PAIRS], metric) for b in range(0, len(q), PAIRS)]
            scores = np.round(np.concatenate([np.zeros(0), *parts]), digits) + 0.0
            found.append(_keep_best(q, ids[column], scores, k, 1 if metric == "cosine" else -1))
    # A query's groups may lie in two parts.
    return _keep_best(*_joined(found), k, 1 if metric == "cosine" else -1)


def _worst(best, n, k):
    """The k-th best score of each of n queries, nan where fewer are found."""
    q, _, scores = best
    counts = np.bincount(q, minlength=n)
    return np.where(counts == k, np.r_[scores, np.nan][np.cumsum(counts) - 1], np.nan)


def _merged(best, new, k, metric):
    return _keep_best(*(np.concatenate(p) for p in zip(best, new)), k, 1 if metric == "cosine" else -1)


def _joined(found):
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(column) for column in zip(*found))


def _screens(queries, vectors, metric, digits, worst=None):
    """Single-precision (queries, vectors, slack and least product of each query): the larger a product, the nearer the pair.

    Products of two pairs that differ by more than the slack are in the order of their rounded scores. Rows are filled
    up to whole groups by ones that no pair comes near. No pair as good as the `worst` score has less than the least product.
    """
    lengths = lambda m: np.sqrt(np.einsum("ij,ij->i", m, m, dtype="float64"))
    width = queries.shape[1]
    # Half of the last digit up and down, and twice the error of a product with room to spare.
    error = 2 * (width + 8) * 2.0**-23
    worst = np.full(len(queries), np.nan) if worst is None else worst
    if metric == "cosine":
        left, right = _unit(queries.astype("float64")), _unit(vectors.astype("float64"))
        last, far = np.zeros(len(right)), -8.0
        slack = np.full(len(left), error + 10.0**-digits)
        floor = worst - slack
    else:
        # Distances stay when all are moved; smaller numbers lose less.
        middle = vectors.mean(axis=0, dtype="float64")
        left, right = queries - middle, vectors - middle
        sizes = lengths(right)
        last = -0.5 * sizes * sizes
        far = -4.0 * (1 + sizes.max() + lengths(left).max()) ** 2
        slack = error * (lengths(left) + sizes.max()) ** 2 + 10.0**-digits
        # The scores themselves are rounded at the size of what they are sums of.
        slack += 2.0**-44 * (lengths(queries) + lengths(vectors).max()) ** 2
        floor = 0.5 * (lengths(left) ** 2 - worst) - slack
    answers = np.zeros((-(-len(right) // GROUP) * GROUP, width + 1), "float32")
    answers[: len(right), :width] = right
    answers[: len(right), width], answers[len(right) :, width] = last, far
    asked = np.ones((len(left), width + 1), "float32")
    asked[:, :width] = left
    return asked, answers, slack.astype("float32") * np.float32(1.001), floor.astype("float32")


def _pair_scores(queries, vectors, lengths, q, column, metric):
    a, b = queries[q].astype("float64"), vectors[column].astype("float64")
    if metric == "l2":
        return ((a - b) ** 2).sum(axis=1)
    size = np.sqrt((a * a).sum(axis=1)) * lengths[column]
    return np.divide((a * b).sum(axis=1), size, out=np.zeros(len(q)), where=size > 0)


def _scored_best(part, low, ids, vectors, k, metric, digits):
    """The best k of a block with all its scores, ties at the border included until the ids are compared."""
    part, vectors = part.astype("float64"), vectors.astype("float64")
    if metric == "cosine":
        part, vectors = _unit(part), _unit(vectors)
    scores = part @ vectors.T
    if metric == "l2":
        scores = (part * part).sum(1)[:, None] + (vectors * vectors).sum(1)[None] - 2 * scores
        scores = np.maximum(scores, 0)
    scores = np.round(scores, digits) + 0.0
    costs = -scores if metric == "cosine" else scores
    if k < len(ids):
        border = np.partition(costs, k - 1, axis=1)[:, k - 1 : k]
        rows, columns = np.nonzero(costs <= border)
    else:
        rows, columns = (a.ravel() for a in np.indices(costs.shape))
    return _keep_best(rows + low, ids[columns], scores[rows, columns], k, 1 if metric == "cosine" else -1)


def _final(parts: DataFrame, k: int, metric: str) -> DataFrame:
    better = F.desc("score") if metric == "cosine" else F.asc("score")
    order = Window.partitionBy("query_id").orderBy(better, F.asc("id"))
    ranked = parts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "id", "score", "rank")


# --- exact search ---------------------------------------------------------


def nearest(corpus: DataFrame, queries: DataFrame, k=5, metric="cosine", digits=6, broadcast_bytes=BROADCAST_BYTES) -> DataFrame:
    """Exact k nearest `corpus(id, vector)` rows for every `queries(query_id, vector)` row.

    The query side is measured first. A small one is broadcast and the corpus is
    read in place. A larger one is cut into blocks, and every (block, corpus
    tile) pair becomes one group of bounded size; a row is sent to as many groups
    as the other side has pieces, which are few and large. Where that is often,
    rows are packed first: what is moved takes less, and pieces can be larger.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    rows, width = queries.agg(F.count("*"), F.max(F.size("vector"))).first()
    if rows * (width or 0) * 8 <= broadcast_bytes:
        return _by_broadcast(corpus, queries, k, metric, digits)
    corpus_rows, cores = corpus.count(), corpus.sparkSession.sparkContext.defaultParallelism
    tiles, blocks = _pieces(corpus_rows, rows, width, cores)
    if rows * tiles + corpus_rows * blocks > COPIES * (rows + corpus_rows):
        numbers = max(_numbers(corpus).itemsize, _numbers(queries).itemsize)
        tiles, blocks = _pieces(corpus_rows, rows, width, cores, TILE_BYTES // (numbers * width))
        most = min(PACK_ROWS, TILE_BYTES // (PACKS * numbers * width))
        corpus = _packed(corpus, "id", max(1, min(most, corpus_rows // (PACKS * tiles))))
        queries = _packed(queries, "query_id", max(1, min(most, rows // (PACKS * blocks))))
        return _by_packs(corpus, queries, k, metric, digits, tiles, blocks, max(1, min(TILE_ROWS, TILE_BYTES // (8 * width))))
    tiled = corpus.withColumn("tile", F.pmod(F.xxhash64("id"), F.lit(tiles)))
    listed = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    asked = queries.withColumns({"tiles": listed(tiles), "block": F.pmod(F.xxhash64("query_id"), F.lit(blocks))})
    return _by_tiles(tiled.withColumn("blocks", listed(blocks)), asked, k, metric, digits, tiles * blocks)


def _pieces(corpus_rows: int, query_rows: int, width: int, cores: int, most=None) -> tuple[int, int]:
    """(tiles, blocks): as few pieces as memory allows, then more until all cores have work, on the side that moves less.

    A piece has `most` rows on average, by default those that Arrow can hand over row by row.
    """
    most = max(1, min(TILE_ROWS, TILE_BYTES // (8 * width)) if most is None else most)
    tiles, blocks = max(1, math.ceil(corpus_rows / most)), max(1, math.ceil(query_rows / most))
    while tiles * blocks < min(TASKS_A_CORE * cores, corpus_rows * query_rows // SCORE_CELLS):
        if query_rows * tiles <= corpus_rows * blocks:
            tiles *= 2
        else:
            blocks *= 2
    return tiles, blocks


def _cast(df: DataFrame, name: str) -> Column:
    return F.col(name).cast(_kind(df, name)).alias(name)


def _by_broadcast(corpus, queries, k, metric, digits):
    spark = corpus.sparkSession
    kinds, schema = _result(corpus, queries)
    local = queries.select(_cast(queries, "query_id"), "vector").toArrow()  # measured by the caller
    if not local.num_rows:
        return _final(spark.createDataFrame([], kinds), k, metric)
    shared = spark.sparkContext.broadcast((_names(local.column("query_id")), _arrow_matrix(local.column("vector"))))

    def scan(batches):
        names, vectors = shared.value
        best, worst = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = _names(batch.column("id"))
            new = _block_best(vectors, ids, _arrow_matrix(batch.column("vector")), k, metric, digits, worst)
            best = _merged(best, new, k, metric) if best is not None else new
            worst = _worst(best, len(names), k)
        if best is not None:
            yield pa.RecordBatch.from_arrays(_pairs(schema, names, *best), schema=schema)

    parts = corpus.select(_cast(corpus, "id"), "vector")
    return _final(parts.mapInArrow(scan, kinds), k, metric)


def _by_tiles(corpus, queries, k, metric, digits, pairs=None):
    """Corpus rows have a `tile` and the query `blocks` that search in it, queries a `block` and the `tiles` they search in.

    Where the number of `pairs` of a tile and a block is known, the shuffle has partitions enough that few share one: a pair
    is little to move and much to multiply.
    """

    kinds, schema = _result(corpus, queries)

    def search(left, right):
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        names = _names(right.column("query_id"))
        best = _block_best(
            _arrow_matrix(right.column("vector"), None),
            _names(left.column("id")),
            _arrow_matrix(left.column("vector"), None),
            k,
            metric,
            digits,
        )
        return pa.Table.from_arrays(_pairs(schema, names, *best), schema=schema)

    left = corpus.select(_cast(corpus, "id"), "vector", "tile", F.explode("blocks").alias("block"))
    right = queries.select(_cast(queries, "query_id"), "vector", F.explode("tiles").alias("tile"), "block")
    if pairs:
        left, right = (side.repartition(2 * pairs, "tile", "block") for side in (left, right))
    found = (
        left.groupBy("tile", "block").cogroup(right.groupBy("tile", "block")).applyInArrow(search, kinds)
    )
    return _final(found, k, metric)


def _numbers(df: DataFrame) -> np.dtype:
    return np.dtype("float32" if dict(df.dtypes)["vector"] == "array<float>" else "float64")


class Packs(NamedTuple):
    rows: DataFrame  # pack: neighbours have neighbouring numbers; names, vectors: the bytes of a matrix, compressed; size: their number before
    kind: str  # of the names
    numbers: np.dtype


def _packed(df: DataFrame, name: str, most: int) -> Packs:
    """Up to `most` rows as one, packed where they lie; written, so that a repeated task finds the same packs."""
    kind, numbers = _kind(df, name), _numbers(df)
    schema = pa.schema([("pack", pa.int32()), ("names", pa.list_(ARROW[kind])), ("vectors", pa.binary()), ("size", pa.int64())])

    def pack(batches):
        held, n, made = [], 0, 0

        def row():
            rows = pa.Table.from_batches(held)
            names = pa.ListArray.from_arrays([0, n], rows.column(0).combine_chunks())
            vectors = _arrow_matrix(rows.column(1), numbers).tobytes()
            columns = [[TaskContext.get().partitionId() + made], names, [pa.compress(vectors, PACKING, asbytes=True)], [len(vectors)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) if isinstance(c, list) else c for c, t in zip(columns, schema)], schema=schema)

        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, most - n))
                batch = batch.slice(most - n)
                n += held[-1].num_rows
                if n == most:
                    yield row()
                    held, n, made = [], 0, made + 1
        if n:
            yield row()

    rows = df.select(_cast(df, name), "vector").mapInArrow(pack, f"pack int, names array<{kind}>, vectors binary, size long")
    return Packs(written(rows, "packs"), kind, numbers)


def _runs(packs, numbers, most):
    """(names, vectors) of runs of packs, each up to `most` rows or one pack."""
    run, n = [], 0
    for names, vectors, size in zip(packs.column("names"), packs.column("vectors"), packs.column("size")):
        names, vectors = _names(names.values), pa.decompress(vectors.as_buffer(), size.as_py(), PACKING)
        if run and n + len(names) > most:
            yield [np.concatenate(p) for p in zip(*run)]
            run, n = [], 0
        run.append((names, np.frombuffer(vectors, numbers).reshape(len(names), -1)))
        n += len(names)
    if run:
        yield [np.concatenate(p) for p in zip(*run)]


def _by_packs(corpus, queries, k, metric, digits, tiles, blocks, most):
    """Packs of the corpus are dealt to tiles, those of the queries to blocks; every pair of a tile and a block is a group."""
    kinds = f"query_id {queries.kind}, id {corpus.kind}, score double"
    schema = pa.schema([("query_id", ARROW[queries.kind]), ("id", ARROW[corpus.kind]), ("score", pa.float64())])
    left_numbers, right_numbers = corpus.numbers, queries.numbers

    def search(left, right):
        found = [schema.empty_table()]
        for names, asked in _runs(right, right_numbers, ASKED_ROWS):
            best, worst = None, None
            for ids, vectors in _runs(left, left_numbers, most):
                new = _block_best(asked, ids, vectors, k, metric, digits, worst)
                best = _merged(best, new, k, metric) if best is not None else new
                worst = _worst(best, len(names), k)
            if best is not None:
                found.append(pa.Table.from_arrays(_pairs(schema, names, *best), schema=schema))
        return pa.concat_tables(found)

    # Packs are dealt in turn, so pieces are about equal; every group has a partition of its own.
    def dealt(packs, pieces, others, pair):
        met = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("other")
        rows = packs.rows.select("names", "vectors", "size", F.pmod("pack", F.lit(pieces)).alias("own"), met)
        grouped = rows.select(pair.cast("int").alias("pair"), "names", "vectors", "size")
        return grouped.repartitionById(tiles * blocks, "pair").groupBy("pair")

    left = dealt(corpus, tiles, blocks, F.col("own") * blocks + F.col("other"))
    right = dealt(queries, blocks, tiles, F.col("other") * blocks + F.col("own"))
    return _final(left.cogroup(right).applyInArrow(search, kinds), k, metric)


# --- exact search with pruning --------------------------------------------


def _unit_column(v: Column) -> Column:
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))
    scaled = lambda n: F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(0.0))
    return let(length, scaled)


class PivotTree(NamedTuple):
    """Pivot vectors in two levels: the pivots of top t are those from bounds[t] to bounds[t + 1]."""

    tops: np.ndarray
    pivots: np.ndarray
    bounds: np.ndarray


class CellIndex(NamedTuple):
    rows: DataFrame  # id, vector, cell, reach: one cell per pivot
    tree: PivotTree
    cells: pd.DataFrame  # cell, rows, radius, close: the smallest reaches


KEPT_REACHES = 32
#: Pivots take at most this much memory in a task, so at 64 numbers a vector there are 131,072 cells at most.
PIVOT_BYTES = 64 << 20
#: Tops whose pivots a row is compared with, and cells whose rows bound a query's k-th neighbour.
PROBES, NEAR_CELLS = 2, 16
#: Distances to pivots held at once, and what a visit takes in a task: a cell's and a query's number.
PIVOT_CELLS, VISIT_BYTES = 1 << 20, 8


def pivot_tree(sample: np.ndarray) -> PivotTree:
    """A tree over sampled vectors: the first root-of-n are tops, and every vector belongs to its nearest top."""
    tops = sample[: max(1, math.isqrt(len(sample)))]
    owner = _nearest_row(sample, tops)
    order = np.argsort(owner, kind="stable")
    return PivotTree(tops, sample[order], np.searchsorted(owner[order], np.arange(len(tops) + 1)))


def _nearest_row(a, b):
    step = max(1, SCORE_CELLS // max(1, len(b)))
    return np.concatenate([_distances(a[i : i + step], b).argmin(axis=1) for i in range(0, len(a), step)])


def _descend(tree: PivotTree, x) -> tuple[np.ndarray, np.ndarray]:
    """(cell, distance to its pivot): the nearest of the pivots below the PROBES nearest tops."""
    cell, reach = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
    gaps = _distances(x, tree.tops)
    probes = min(PROBES, len(tree.tops))
    for tops in np.argpartition(gaps, probes - 1, axis=1)[:, :probes].T:
        for top in np.unique(tops):
            a, b = tree.bounds[top], tree.bounds[top + 1]
            mine = np.flatnonzero(tops == top)
            if a == b:
                continue
            distances = _distances(x[mine], tree.pivots[a:b])
            best = distances.argmin(axis=1)
            near = distances[np.arange(len(mine)), best]
            better = near < reach[mine]
            cell[mine[better]], reach[mine[better]] = a + best[better], near[better]
    return cell, reach


def cell_index(corpus: DataFrame, cells=None, metric="cosine", path=None) -> CellIndex:
    """Rows grouped around pivot vectors, written once as the table searches read, cell by cell.

    The number of cells grows with the root of the corpus (`cells` sets it), so that neither a query's list of cells nor a
    cell's rows grow like the corpus. Pivots are rows picked by the hash of their id; `reach` is the distance of a row to
    its pivot. Cosine search uses unit vectors, where order by distance is order by cosine. `path` is a new folder; by
    default one in the shared folder.
    """
    spark = corpus.sparkSession
    vectors = corpus.select(
        _cast(corpus, "id"),
        (_unit_column(F.col("vector")) if metric == "cosine" else F.col("vector")).alias("vector"),
    )
    rows, width = corpus.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    cells = min(cells or math.isqrt(rows), max(1, PIVOT_BYTES // (8 * max(1, width))))
    picked = vectors.orderBy(F.xxhash64("id"), "id").limit(max(1, cells)).select("vector").toArrow()  # PIVOT_BYTES at most
    tree = pivot_tree(_arrow_matrix(picked.column("vector"))) if picked.num_rows else PivotTree(np.zeros((1, 1)), np.zeros((1, 1)), np.array([0, 1]))
    shared = spark.sparkContext.broadcast(tree)

    @F.pandas_udf("cell int, reach double")
    def place(column: pd.Series) -> pd.DataFrame:
        if not len(column):
            return pd.DataFrame({"cell": np.zeros(0, "int32"), "reach": np.zeros(0)})
        cell, reach = _descend(shared.value, _matrix(column))
        return pd.DataFrame({"cell": cell.astype("int32"), "reach": reach})

    path = path or scratch_path(spark, "cells")
    placed = vectors.withColumn("p", place("vector")).select("id", "vector", "p.cell", "p.reach")
    # Ranges of cells: a file holds few cells, whose numbers in its footer let a search skip it.
    placed.repartitionByRange("cell", "reach").sortWithinPartitions("cell").write.parquet(path)
    rows = spark.read.parquet(path)
    order = Window.partitionBy("cell").orderBy("reach", "id")
    # The limit on the row number is applied in every task before the shuffle.
    close = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= KEPT_REACHES)
    close = close.groupBy("cell").agg(F.collect_list("reach").alias("close"))
    sizes = rows.groupBy("cell").agg(F.count("*").alias("rows"), F.max("reach").alias("radius"))
    return CellIndex(rows, tree, sizes.join(close, "cell").toPandas())  # one row per cell


def _distances(a, b):
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


class Bounds(NamedTuple):
    """What a task knows of the cells that have rows."""

    pivots: np.ndarray
    radius: np.ndarray
    close: np.ndarray  # KEPT_REACHES smallest reaches a cell, infinite where it has fewer


def _bounds(index: CellIndex) -> Bounds:
    cells = index.cells
    close = np.full((len(cells), KEPT_REACHES), np.inf)
    for i, reaches in enumerate(cells["close"]):
        close[i, : len(reaches)] = np.sort(reaches)
    return Bounds(index.tree.pivots[cells["cell"].to_numpy()], cells["radius"].to_numpy(), close)


def _visits(bounds: Bounds, x, k: int, digits: int):
    """(query row, cell row) of every cell that can hold one of the k nearest.

    The k-th smallest sum of query-pivot and pivot-row distance over the nearest cells bounds the k-th neighbour from
    above; the triangle inequality bounds a cell's rows from below, on either side of its ring.
    """
    rows, cells = [], []
    near = min(len(bounds.pivots), NEAR_CELLS + -(-4 * k // KEPT_REACHES))
    step = max(1, PIVOT_CELLS // (len(bounds.pivots) + near * KEPT_REACHES))
    for low in range(0, len(x), step):
        gap = _distances(x[low : low + step], bounds.pivots)
        closest = np.argpartition(gap, near - 1, axis=1)[:, :near]
        upper = (np.take_along_axis(gap, closest, 1)[:, :, None] + bounds.close[closest]).reshape(len(gap), -1)
        # Too few kept reaches give no bound: every cell is searched.
        limit = np.partition(upper, k - 1, axis=1)[:, k - 1] if k <= upper.shape[1] else np.full(len(gap), np.inf)
        # Rows that tie with the k-th one after rounding must be searched too; distances of long vectors lose digits.
        rounding = np.sqrt(1e-14 * ((x[low : low + step] ** 2).sum(axis=1).max() + (bounds.pivots**2).sum(axis=1).max()))
        limit = limit[:, None] + 10.0 ** (1 - digits) + 1e-6 + rounding
        q, c = np.nonzero((gap - bounds.radius <= limit) & (bounds.close[:, 0] - gap <= limit))
        rows.append(q + low)
        cells.append(c)
    return np.concatenate(rows) if rows else np.zeros(0, int), np.concatenate(cells) if cells else np.zeros(0, int)


def nearest_pruned(index: CellIndex, queries: DataFrame, k=5, metric="cosine", digits=6, tile_rows=TILE_ROWS, query_rows=20_000, min_saving=0.5, broadcast_bytes=BROADCAST_BYTES) -> DataFrame:
    """The result of `nearest`, computing only cells that can hold a neighbour.

    The saving is measured first: vectors without clusters are searched in full by `nearest`, which then moves less. Few
    queries with few cells go to the index, whose rows stay where they are; only cells that some query visits are read. Many queries are
    dealt to the cells they visit, and large cells are cut into tiles, so no cell lands in one task.
    """
    spark, cells = queries.sparkSession, index.cells
    vector = F.col("vector")
    asked = queries.select(_cast(queries, "query_id"), (_unit_column(vector) if metric == "cosine" else vector).alias("vector"))
    if not len(cells):
        return nearest(index.rows, asked, k, metric, digits)
    shared = spark.sparkContext.broadcast(_bounds(index))
    names = cells["cell"].to_numpy()

    @F.pandas_udf("array<int>")
    def cells_for(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        q, c = _visits(shared.value, _matrix(vectors), k, digits)
        return pd.Series(np.split(names[c].astype("int32"), np.searchsorted(q, np.arange(1, len(vectors)))))

    searched = written(asked.withColumn("cells", cells_for("vector")), "searched")
    layout = spark.createDataFrame([(int(c), int(n)) for c, n in zip(cells["cell"], cells["rows"])], "cell int, n long")
    pairs = searched.select("query_id", F.explode("cells").alias("cell")).join(F.broadcast(layout), "cell")
    rows, width = searched.agg(F.count("*"), F.max(F.size("vector"))).first()
    seen, visits = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first() if rows else (0, 0)
    if not rows or seen > (1 - min_saving) * int(cells["rows"].sum()) * rows:
        return nearest(index.rows, asked, k, metric, digits)
    # Each worker has them all: a query's id and vector, and its cells, which are the larger part of short vectors.
    if rows * (8 * width + 8) + visits * VISIT_BYTES <= broadcast_bytes:
        return _in_place(index.rows, searched, k, metric, digits)
    # A cell's queries are cut into blocks by their own number, so that a row is sent to the few that search in its cell.
    visits = pairs.groupBy("cell").agg(F.count("*").alias("asked"))
    layout = written(layout.join(visits, "cell").select("cell", F.ceil(F.col("n") / tile_rows).cast("long").alias("parts"), F.ceil(F.col("asked") / query_rows).cast("long").alias("blocks")), "layout")
    listed = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    named = lambda part: F.col("cell") * (1 << 32) + part
    corpus = index.rows.join(F.broadcast(layout), "cell")
    corpus = corpus.withColumns({"tile": named(F.pmod(F.xxhash64("id"), F.col("parts"))), "blocks": listed("blocks")})
    counted = searched.select("query_id", "vector", F.explode("cells").alias("cell")).join(F.broadcast(layout), "cell")
    block = F.pmod(F.xxhash64("query_id"), F.col("blocks"))
    return _by_tiles(corpus, counted.withColumns({"tiles": F.transform(listed("parts"), named), "block": block}), k, metric, digits)


def _in_place(rows: DataFrame, searched: DataFrame, k: int, metric: str, digits: int) -> DataFrame:
    """Queries with their cells sent to the index: no row of it is moved, and only visited cells are read."""
    spark = searched.sparkSession
    kinds, schema = _result(rows, searched)
    local = searched.toArrow()  # measured by the caller
    lists = local.column("cells").combine_chunks()
    query = np.repeat(np.arange(local.num_rows, dtype="int32"), np.diff(lists.offsets.to_numpy()))
    cell = lists.flatten().to_numpy()
    order = np.argsort(cell, kind="stable")
    shared = spark.sparkContext.broadcast((_names(local.column("query_id")), _arrow_matrix(local.column("vector")), cell[order], query[order]))
    sign = 1 if metric == "cosine" else -1

    def merged(parts):
        return [_keep_best(*(np.concatenate(p) for p in zip(*parts)), k, sign)]

    def scan(batches):
        names, vectors, cells, asking = shared.value
        parts, held, most = [], 0, PAIRS
        for batch in batches:
            ids, at, x = _names(batch.column("id")), batch.column("cell").to_numpy(), _arrow_matrix(batch.column("vector"))
            for c in np.unique(at):
                mine = at == c
                who = asking[np.searchsorted(cells, c) : np.searchsorted(cells, c, "right")]
                if not len(who):
                    continue
                q, found, scores = _block_best(vectors[who], ids[mine], x[mine], k, metric, digits)
                parts.append((who[q], found, scores))
                held += len(q)
                if held > most:
                    # What is held stays within some times the best of the queries met, and each pair is sorted few times.
                    parts = merged(parts)
                    held, most = 0, max(PAIRS, len(parts[0][0]))
        if parts:
            yield pa.RecordBatch.from_arrays(_pairs(schema, names, *merged(parts)[0]), schema=schema)

    wanted = F.broadcast(spark.createDataFrame([(int(c),) for c in np.unique(cell)], "cell int"))
    near = rows.where(F.col("cell").between(int(cell.min()), int(cell.max()))).join(wanted, "cell", "left_semi")
    return _final(near.select("id", "cell", "vector").mapInArrow(scan, kinds), k, metric)
