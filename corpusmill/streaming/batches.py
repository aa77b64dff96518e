"""Scoring of newly arrived files with metrics per batch."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.metrics import confusion, weighted_metrics
from corpusmill.session import scratch_path


def arriving(spark: SparkSession, path: str, schema, files_per_batch=None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def score_batches(stream: DataFrame, score, actual: str, predicted: str, out: str, state: str):
    """Score every arriving batch and write its confusion counts below `out`.

    `score` maps a DataFrame to one with the predicted column. A batch that is
    run again replaces its own folder, so restarts do not count rows twice.
    """

    def write(batch: DataFrame, batch_id: int):
        counts = confusion(score(batch), actual, predicted)
        counts.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def keep_scored(stream: DataFrame, score, out: str, state: str):
    """Score every arriving batch and keep its rows below `out`, one folder per batch.

    `score` maps a DataFrame to the rows to keep. A batch that is run again replaces its own folder, so rows are there once
    whatever fails. The kept rows are what people label later, see `keep_labelled`.
    """

    def write(batch: DataFrame, batch_id: int):
        score(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def kept(spark: SparkSession, out: str) -> DataFrame:
    """The rows kept below `out` so far, with `batch`, the number of the batch they came in."""
    return spark.read.parquet(out).withColumn("batch", F.col("batch").cast("long"))


def keep_labelled(labels: DataFrame, scored: str, key: str, out: str, state: str):
    """Join arriving labels with all rows scored so far and keep them below `out`, one folder per batch of labels.

    A stream-static join: the scored rows are listed anew for each batch of labels, so labels may come any time after their
    rows. Labels of rows that are not scored yet are dropped; a batch that is run again replaces its folder.
    """

    def write(batch: DataFrame, batch_id: int):
        rows = kept(batch.sparkSession, scored).withColumnRenamed("batch", "scored_batch")
        rows.join(batch, key).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        labels.writeStream.foreachBatch(write)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def run_to_end(spark: SparkSession, stream: DataFrame, score, actual: str, predicted: str) -> DataFrame:
    """Process all files that are there and return (batch, actual, predicted, n)."""
    out, state = scratch_path(spark, "scores"), scratch_path(spark, "stream")
    score_batches(stream, score, actual, predicted, out, state).awaitTermination()
    return spark.read.parquet(out).select(F.col("batch").cast("long"), "actual", "predicted", "n")


def batch_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy and weighted precision, recall and F1 of every batch, from its confusion counts."""
    return weighted_metrics(counts, "actual", "predicted", by=["batch"], count="n")
