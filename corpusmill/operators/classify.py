"""Linear text classifier: hinge loss on TF-IDF, trained by full-batch steps in whole numbers.

A step adds up, per word bucket, what the rows inside the margin ask for. Feature values, weights and step lengths are
whole numbers (fixed point), so the sums are exact: partial sums per task may meet in any order, and the model has the same
bits on any layout and any cluster. A step is one job that reads narrow written features and moves one row per bucket and
task; both classes weigh the same, however rare one is. Words are hashed to a fixed number of buckets, so neither the model
nor anything that meets on the driver grows with the corpus.
"""

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.slices import sliced, slices
from corpusmill.operators.features import token_ids
from corpusmill.session import written

BUCKETS = 1 << 18
# Fixed point: feature values and weights are multiples of these.
VALUE, WEIGHT = 1 << 14, 1 << 20
STEPS, RATE = 8, 30.0
# The intercept, a feature of every row, learns this much slower.
INTERCEPT_RATE = 0.02


class LinearModel(NamedTuple):
    idf: np.ndarray
    weights: np.ndarray
    intercept: int


def step_lengths(steps=STEPS, rate=RATE) -> list[tuple[int, int]]:
    """Whole-number lengths (weights, intercept) of each step, falling with its root."""
    each = [rate / (t + 1) ** 0.5 for t in range(steps)]
    return [(round(r * WEIGHT / VALUE), round(r * INTERCEPT_RATE * WEIGHT)) for r in each]


def _sparse(column, idf):
    """Word ids 1..n of a batch as (row, bucket, whole-number value): TF-IDF of unit length, rows and buckets rising."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    key = np.repeat(np.arange(len(column)), lengths) * len(idf) + column.flatten().to_numpy().astype(np.int64) - 1
    key, counts = np.unique(key, return_counts=True)
    row, bucket = np.divmod(key, len(idf))
    raw = counts * idf[bucket]
    length = np.sqrt(np.bincount(row, raw * raw, minlength=len(column)))
    return row, bucket, np.floor(raw / length[row] * VALUE + 0.5).astype(np.int64)


def features(rows: DataFrame, ids: str, idf) -> DataFrame:
    """`rows` with `ids` replaced by its buckets and values, one sparse row each; `idf` is a broadcast array."""
    keep = [c for c in rows.columns if c != ids]

    def weigh(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            row, bucket, value = _sparse(batch.column(ids), idf.value)
            starts = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    pa.ListArray.from_arrays(starts, pa.array(bucket, pa.int32())),
                    pa.ListArray.from_arrays(starts, pa.array(value, pa.int64())),
                ],
                [*keep, "bucket", "value"],
            )

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, ids).mapInArrow(weigh, f"{kinds}, bucket array<int>, value array<bigint>")


def _margins(batch, weights, intercept):
    """(row of each entry, bucket, value, weighted sums of the rows), all exact."""
    lists = batch.column("bucket")
    row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    bucket = lists.flatten().to_numpy()
    value = batch.column("value").flatten().to_numpy()
    sums = np.zeros(batch.num_rows, np.int64)
    np.add.at(sums, row, weights[bucket] * value)
    return row, bucket, value, sums + intercept * VALUE


def _document_weights(ids: DataFrame, buckets: int):
    """(rows per class, ln((1 + n) / (1 + df)) + 1 per bucket); at most `buckets` rows reach the driver."""
    spread = ids.select(F.explode(F.array_distinct("ids")).alias("b")).groupBy("b").count()
    sides = {r["positive"]: r["count"] for r in ids.groupBy("positive").count().collect()}
    counts, local = np.zeros(buckets), spread.toPandas()
    counts[local["b"].to_numpy() - 1] = local["count"]
    return sides.get(True, 0), sides.get(False, 0), np.log((1 + sum(sides.values())) / (1 + counts)) + 1


def _asked(data: DataFrame, weights, intercept: int) -> pd.DataFrame:
    """What rows inside the margin ask for: (bucket, positive, negative) sums; bucket -1 counts the rows."""
    spark = data.sparkSession
    shared = spark.sparkContext.broadcast((weights, intercept))

    def run(batches):
        w, b = shared.value
        sums = np.zeros((2, len(w)), np.int64)
        rows = [0, 0]
        for batch in (part for whole in batches for part in slices(whole)):
            row, bucket, value, margin = _margins(batch, w, b)
            positive = batch.column("positive").to_numpy(zero_copy_only=False)
            inside = np.where(positive, margin, -margin) < WEIGHT * VALUE
            for side, mine in enumerate((positive & inside, ~positive & inside)):
                picked = mine[row]
                np.add.at(sums[side], bucket[picked], value[picked])
                rows[side] += int(mine.sum())
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, at]), pa.array(np.r_[rows[0], sums[0, at]]), pa.array(np.r_[rows[1], sums[1, at]])],
            ["bucket", "positive", "negative"],
        )

    parts = data.mapInArrow(run, "bucket long, positive long, negative long")
    # One row per bucket: the size of the model, whatever the corpus.
    found = parts.groupBy("bucket").agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative")).toPandas()
    shared.unpersist()
    return found


def _scaled(sums, length: int, rows: int):
    """sums * length / (2 * rows), rounded down; wide where a long would not do."""
    sums = np.asarray(sums, np.int64)
    if len(sums) and int(sums.max()) * length >= 2**63:
        return np.array([int(s) * length // (2 * rows) for s in sums], np.int64)
    return sums * length // (2 * rows)


def train(df: DataFrame, text="text", label="label", buckets=BUCKETS, steps=STEPS, rate=RATE) -> LinearModel:
    """Fit on (text, label 0/1). Rows without a label are left out; a null text has no words."""
    spark = df.sparkSession
    named = df.where(F.col(label).isNotNull()).select(
        (F.col(label).cast("int") > 0).alias("positive"), token_ids(F.coalesce(text, F.lit("")), buckets).alias("ids")
    )
    ids = written(named, "ids")
    positive, negative, idf = _document_weights(ids, buckets)
    data = written(features(ids, "ids", spark.sparkContext.broadcast(idf)), "features")
    weights, intercept = np.zeros(buckets, np.int64), 0
    for length, intercept_length in step_lengths(steps, rate):
        asked = _asked(data, weights, intercept).set_index("bucket")
        rows = asked.loc[[-1]] if -1 in asked.index else pd.DataFrame({"positive": [0], "negative": [0]})
        asked = asked.drop(index=-1, errors="ignore")
        for side, sign, n in (("positive", 1, max(1, positive)), ("negative", -1, max(1, negative))):
            weights[asked.index] += sign * _scaled(asked[side], length, n)
            intercept += sign * (int(rows[side].iloc[0]) * intercept_length // (2 * n))
    return LinearModel(idf, weights, intercept)


def predict(model: LinearModel, df: DataFrame, text="text", target="predicted") -> DataFrame:
    """`df` with the predicted label 0 or 1; a narrow transformation."""
    shared = df.sparkSession.sparkContext.broadcast(tuple(model))

    def decide(rows):
        idf, weights, intercept = shared.value
        row, bucket, value = _sparse(rows, idf)
        sums = np.zeros(len(rows), np.int64)
        np.add.at(sums, row, weights[bucket] * value)
        return pa.array((sums + intercept * VALUE > 0).astype("int32"))

    return df.withColumn(target, sliced("int", decide)(token_ids(F.coalesce(text, F.lit("")), len(model.weights))))


def retrain(old: DataFrame, batch: DataFrame, **options):
    """(model on old data, model on old data and the newly labelled batch)."""
    return train(old, **options), train(old.unionByName(batch), **options)


def write_model(model: LinearModel, spark, path: str):
    """The model as a table (bucket, idf, weight); bucket -1 holds the intercept."""
    table = pd.DataFrame({"bucket": np.arange(len(model.weights)), "idf": model.idf, "weight": model.weights})
    table.loc[len(table)] = [-1, 0.0, model.intercept]
    spark.createDataFrame(table.astype({"bucket": "int64", "weight": "int64"})).coalesce(1).write.parquet(path)


def read_model(spark, path: str) -> LinearModel:
    table = spark.read.parquet(path).toPandas().sort_values("bucket")
    return LinearModel(
        table["idf"].to_numpy()[1:], table["weight"].to_numpy()[1:].astype(np.int64), int(table["weight"].iloc[0])
    )
