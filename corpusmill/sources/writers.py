"""Sinks: CSV, line files, one-page HTML, vector table, dataset with splits."""

import json
import os
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Hidden from readers of the table's files.
LAYOUT = "_layout"
#: Of a table written as a file per row: files in a folder at most.
FOLDER_FILES = 1000


def write_csv(df: DataFrame, path: str, mode="errorifexists", by=None):
    """CSV with a header; nested columns are written as JSON. `by` names a column with a folder for each of its values."""
    columns = [
        F.to_json(f.name).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        else F.col(f.name)
        for f in df.schema
    ]
    writer = df.select(*columns).write.mode(mode)
    (
        (writer.partitionBy(by) if by else writer)
        .options(
            header=True,
            escape='"',
            quoteAll=True,
            nullValue="\\N",
            emptyValue="",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
            timestampFormat="yyyy-MM-dd HH:mm:ss",
            timestampNTZFormat="yyyy-MM-dd HH:mm:ss",
        )
        .csv(path)
    )


def write_lines(df: DataFrame, path: str, column="value", mode="errorifexists"):
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def _mounted(spark, path: str) -> bool:
    return path.startswith("file:") or (path.startswith("/") and spark.sparkContext.master.startswith("local"))


def write_files(df: DataFrame, path: str, column="value", by="id"):
    """A new folder with one text file per row, each line ended by a newline; a null is an empty line. Rows with the same `by`
    in one task share a file.

    Where the folder is a mounted one, tasks write the files as such: Spark's writer starts a process or two for every file
    there, which costs more than all else. Folders then hold FOLDER_FILES files, so readers list them in parallel and no row has
    one of its own. A folder counts when the attempt that made it has ended well: until then readers do not see it. In other
    stores Spark's writer makes a folder for each `by`.
    """
    spark, rows = df.sparkSession, df.select(by, F.col(column).cast("string").alias("value"))
    if not _mounted(spark, path):
        rows.write.partitionBy(by).option("lineSep", "\n").text(path)
        return
    root = "/" + path.removeprefix("file:").lstrip("/")
    os.makedirs(root)

    def run(batches):
        task, n, last, file = TaskContext.get(), 0, None, None
        try:
            for batch in batches:
                for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if file is None or key != last:
                        if n % FOLDER_FILES == 0:
                            folder = f"{task.partitionId()}-{n // FOLDER_FILES}"
                            hidden = f"_{folder}-{task.taskAttemptId()}"
                            os.makedirs(f"{root}/{hidden}")
                            yield pa.RecordBatch.from_pydict({"hidden": [hidden], "folder": [folder]})
                        if file is not None:
                            file.close()
                        file = open(f"{root}/{hidden}/part-{n}.txt", "wb")
                        n, last = n + 1, key
                    file.write(value.as_buffer() if value.is_valid else b"")
                    file.write(b"\n")
        finally:
            if file is not None:
                file.close()

    # One row per folder.
    made = rows.sortWithinPartitions(by).mapInArrow(run, "hidden string, folder string").collect()
    for hidden, folder in made:
        os.rename(f"{root}/{hidden}", f"{root}/{folder}")


def course_page_lines(df: DataFrame, key: str, title: str, description: str, heading: str) -> DataFrame:
    """(part, key, value): the lines of one HTML page that lists every row.

    The page is never one cell: sorted by (part, key) and written as text, its
    part files read in order are the page, however many rows it has.
    """
    body = df.select(
        F.lit(1).alias("part"),
        F.col(key).cast("long").alias("key"),
        F.concat(
            F.lit("<h2>"), F.col(title), F.lit("</h2><p>"), F.col(description), F.lit("</p>")
        ).alias("value"),
    )
    frame = df.sparkSession.createDataFrame(
        [
            (0, 0, f"<html><body><h1>{heading}</h1>"),
            (2, 0, "</body></html>"),
        ],
        "part int, key long, value string",
    )
    return body.unionByName(frame)


def write_page(page_lines: DataFrame, path: str, mode="errorifexists"):
    """Range-partitioned write: the concatenation of the part files is the page."""
    page_lines.orderBy("part", "key").select("value").write.mode(mode).text(path)


def write_vectors(df: DataFrame, path: str, key="id", buckets=None, mode="errorifexists"):
    """The vector table: chunk id, text, metadata and embedding, dealt to buckets by chunk id.

    Rows are moved once, here; later joins by chunk id leave them where they lie. `buckets` is the session's number of
    shuffle partitions by default. The layout is kept beside the files, so that `read_vectors` knows it in any session.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"vectors_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key)
    dealt.write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    layout = spark.createDataFrame([(key, buckets, df.schema.json())], "key string, buckets int, columns string")
    layout.coalesce(1).write.mode("overwrite").json(f"{path}/{LAYOUT}")


def read_vectors(spark, path: str) -> DataFrame:
    """The table at `path` with its layout: joins and aggregates by its key do not move its rows."""
    layout = spark.read.json(f"{path}/{LAYOUT}").first()
    name = f"vectors_{uuid.uuid4().hex}"
    columns = T.StructType.fromJson(json.loads(layout["columns"]))
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    spark.sql(
        f"CREATE TABLE {name} ({listed}) USING parquet OPTIONS (path '{path}') "
        f"CLUSTERED BY (`{layout['key']}`) SORTED BY (`{layout['key']}`) INTO {layout['buckets']} BUCKETS"
    )
    found = spark.table(name)
    found.schema  # resolved: the name is not needed any more
    spark.sql(f"DROP TABLE {name}")
    return found


def write_dataset(df: DataFrame, path: str, mode="errorifexists"):
    """A dataset whose splits are directories, so a reader of one split skips the others."""
    df.write.mode(mode).partitionBy("split").parquet(path)
