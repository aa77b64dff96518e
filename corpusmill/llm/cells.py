"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Centres are fitted on a bounded sample; every vector is assigned to its nearest centre, its home, and visits the cells
whose centres are nearly as close. Inside a cell, the vectors at home are multiplied with all members block by block; only
counts and a spanning set of links leave a task. Equal vectors are one node.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.graph import components
from corpusmill.session import written

#: Vectors that the centres are fitted on, at most, and centres at most.
SAMPLE, CENTRES = 20_000, 4000
#: Rows of one side of a block product.
BLOCK = 2048


def margin_of(length: int) -> float:
    """A vector visits the cells whose centre's cosine is this close to that of its home's.

    The fewer numbers a vector has, the farther a vector at the least cosine may lie beyond its neighbour's home. On
    unclustered vectors with planted pairs at 0.903 this finds 1.000 of them at 4, 8, 16, 32, 64 and 128 numbers (of 2000).
    """
    return min(0.3, 0.12 + 1.5 / max(1, length))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spherical_k_means(x: np.ndarray, k: int, rounds=12, seed=5) -> np.ndarray:
    """k unit centres of unit vectors; an emptied centre starts again at the vector that fits worst."""
    centres = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        dots = np.concatenate([part @ centres.T for part in np.array_split(x, max(1, len(x) * k // 4_000_000))])
        home = dots.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        empty = np.bincount(home, minlength=k) == 0
        sums[empty] = x[np.argsort(dots[np.arange(len(x)), home])[: empty.sum()]]
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres)
    return centres


def _matrix(column) -> np.ndarray:
    """Rows of a list column, all of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _assigned(shared, margin):
    def run(batches):
        centres = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(_matrix(batch.column("vector")))
            for a in range(0, len(x), 2048):
                dots = x[a : a + 2048] @ centres.T
                best = dots.max(axis=1)
                near = dots >= best[:, None] - margin
                home = dots.argmax(axis=1)
                counts = near.sum(axis=1)
                cell = np.nonzero(near)[1].astype(np.int32)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                part = batch.slice(a, len(home))
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("weight"), part.column("vector"), pa.array(home.astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(cell))],
                    ["node", "weight", "vector", "home", "cells"],
                )

    return run


def _links(least):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Links between vectors at home in a cell (left) and a block of its members (right), each link of a cell pair once."""
        empty = pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        if not left.num_rows or not right.num_rows:
            return empty
        cell = left.column("cell")[0].as_py()
        a, b = left.column("node").to_numpy(), right.column("r_node").to_numpy()
        home = right.column("r_home").to_numpy()
        ok = unit(_matrix(left.column("vector"))) @ unit(_matrix(right.column("r_vector"))).T >= least
        at_home = home == cell
        ok &= ~at_home[None, :] | (a[:, None] < b[None, :])
        # A pair with two homes may meet in both cells; it counts in the lower one.
        lists = left.column("cells").combine_chunks()
        visited = np.zeros((len(a), int(max(home.max(), cell)) + 1), bool)
        row = np.repeat(np.arange(len(a)), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten().to_numpy()
        inside = flat < visited.shape[1]
        visited[row[inside], flat[inside]] = True
        ok &= ~(visited[:, home] & (home < cell)[None, :])
        i, j = np.nonzero(ok)
        if not len(i):
            return empty
        weight_a, weight_b = left.column("weight").to_numpy(), right.column("r_weight").to_numpy()
        node, number = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
        links = np.bincount(number, np.concatenate([weight_b[j], weight_a[i]]), len(node)).astype(np.int64)
        one, two = number[: len(i)], number[len(i) :]
        root = np.arange(len(node))
        while True:  # the smallest number along links, with shortened paths
            low = root.copy()
            np.minimum.at(low, one, root[two])
            np.minimum.at(low, two, root[one])
            low = low[low]
            if (low == root).all():
                break
            root = low
        return pa.table({"node": node, "links": links, "root": node[root]})

    return run


def near_duplicates(vectors: DataFrame, least=0.9, margin=None, id="vec_id", vector="embedding") -> DataFrame:
    """One row per vector: `id`, n_links, component_id, kept.

    Vectors are linked at a cosine of `least` or more, in double precision. n_links counts the other vectors linked
    directly, component_id is the smallest id reachable by links (null ids last), kept says that it is the row's own.
    Vectors that are null, empty or zero, or hold null or non-finite components, or differ in length from the commonest
    valid length, link with nothing. Equal vectors are linked. An empty table gives an empty result. Other columns are
    not read.

    Found links are exact; a link is missed when each end's home is outside of the other's margin (the tests measure
    recall). Cells follow the root of the number of vectors; a cell of many rows is dealt out in blocks.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id].dataType.simpleString()
    values = F.transform(vector, lambda v: v.cast("double"))
    sound = F.coalesce(F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    sound = sound & F.exists("vector", lambda v: v != 0)
    rows = vectors.select(F.col(id).alias("id"), values.alias("vector")).withColumn("sound", F.coalesce(sound, F.lit(False)))
    # Adding 0 makes a negative zero a zero.
    content = F.array_join(F.transform("vector", lambda v: (v + 0.0).cast("string")), ",")
    rows = rows.withColumn("digest", F.when(F.col("sound"), F.md5(content.cast("binary"))))
    rows = written(rows, "vectors")
    good = rows.where("sound")
    length = good.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    order = F.struct(F.col("id").isNull().alias("none"), "id")
    node = F.conv(F.substring("digest", 1, 16), 16, -10).cast("long").alias("node")
    classes = good.where(F.size("vector") == (length["n"] if length else 0)).groupBy("digest").agg(F.count("*").alias("weight"), F.min(order).alias("first"), F.first("vector").alias("vector"))
    classes = written(classes.select(node, "digest", "weight", "first", "vector"), "vector-classes")
    count = classes.count()
    alone = rows.select("id", "digest")
    if count:
        k = int(min(max(1, round(count**0.5)), CENTRES, max(1, SAMPLE // 4)))
        sample = classes.orderBy(F.xxhash64("node")).select("vector").limit(max(SAMPLE, 1)).toArrow()  # bounded
        centres = spherical_k_means(unit(_matrix(sample.column("vector"))), min(k, sample.num_rows))
        shared = spark.sparkContext.broadcast(centres)  # at most CENTRES rows
        placed = classes.select("node", "weight", "vector").mapInArrow(_assigned(shared, margin_of(length["n"]) if margin is None else margin), "node long, weight long, vector array<double>, home int, cells array<int>")
        placed = written(placed, "cells")
        sizes = (
            placed.select("home", F.explode("cells").alias("cell"))
            .groupBy("cell")
            .agg(F.ceil(F.count("*") / BLOCK).alias("right_blocks"), F.ceil(F.greatest(F.sum((F.col("home") == F.col("cell")).cast("int")), F.lit(1)) / BLOCK).alias("left_blocks"))
        )
        sizes = written(sizes, "cell-sizes")  # one row per centre
        part = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
        left = (
            placed.withColumn("cell", F.col("home")).join(F.broadcast(sizes), "cell")
            .select("cell", part("left_blocks").alias("i"), F.explode(F.sequence(F.lit(0), (F.col("right_blocks") - 1).cast("int"))).alias("j"), "node", "weight", "vector", "cells")
        )
        right = (
            placed.withColumn("cell", F.explode("cells")).join(F.broadcast(sizes), "cell")
            .select("cell", F.explode(F.sequence(F.lit(0), (F.col("left_blocks") - 1).cast("int"))).alias("i"), part("right_blocks").alias("j"), "node", "weight", "vector", "home")
        )
        right = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])  # both sides come from one table
        found = left.groupBy("cell", "i", "j").cogroup(right.groupBy("r_cell", "r_i", "r_j")).applyInArrow(_links(least), "node long, links long, root long")
        found = written(found, "vector-links")
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        labels = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
        named = classes.drop("vector").join(links, "node", "left").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        lowest = named.groupBy("label").agg(F.min("first").alias("low"))
        named = named.join(lowest, "label").select(F.col("digest").alias("digest_"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"), F.col("low.id").alias("low"), F.lit(True).alias("known"))
    else:
        named = spark.createDataFrame([], f"digest_ string, n long, low {id_type}, known boolean")
    out = alone.join(named, F.col("digest") == F.col("digest_"), "left").withColumn("component_id", F.when(F.col("known"), F.col("low")).otherwise(F.col("id")))
    return out.select(F.col("id").alias(id), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
