"""Blocks of documents that ask each other about hashes.

Documents are packed into rows of some megabytes of text, kept in a bucketed table, so that answers join them without
moving the text again. A block sends each of its distinct keys once, dealt by key range; whoever holds a range answers
with one bit per key. A key that a third of all documents hold is one entry per block, whatever its group.
"""

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import grams
from corpusmill.session import scratch_path

#: Bytes of text in a block, and in a bucket of the block table.
BLOCK, BUCKET = 2 << 20, 16 << 20
#: Keys that one range holds, about.
RANGE_KEYS = 500_000

_LAST = np.iinfo(np.int64).max


def _packed(batches):
    number, ids, texts, size = 0, [], [], 0
    part = TaskContext.get().partitionId() << 32

    def row():
        joined = pa.concat_arrays(texts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part + number], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(joined)], pa.int32()), pa.concat_arrays(ids)),
                pa.ListArray.from_arrays(pa.array([0, len(joined)], pa.int32()), joined),
            ],
            ["block", "ids", "texts"],
        )

    for batch in batches:
        _, offsets = grams.buffers(batch.column("text"))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + BLOCK - size)))
            ids.append(batch.column("id").slice(begin, end - begin))
            texts.append(batch.column("text").slice(begin, end - begin))
            size += int(offsets[min(end, batch.num_rows)] - offsets[begin])
            begin = end
            if size >= BLOCK:
                yield row()
                number, ids, texts, size = number + 1, [], [], 0
    if ids:
        yield row()


class Blocks:
    """The block table of some documents: block, ids (null: the last of all), texts (null: empty); `bytes` of text."""

    def __init__(self, docs: DataFrame, id: str, text: str):
        spark = docs.sparkSession
        rows = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(_LAST)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        self.bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        # Names, not paths, carry bucketing; the files lie in the shared folder.
        self.name = f"blocks_{uuid.uuid4().hex}"
        buckets = min(50_000, max(1, math.ceil(self.bytes / BUCKET)))
        packed = rows.mapInArrow(_packed, "block long, ids array<long>, texts array<string>")
        packed.write.bucketBy(buckets, "block").option("path", scratch_path(spark, "blocks")).saveAsTable(self.name)
        self.table = spark.table(self.name)

    def ranges(self, keys_per_byte: float) -> int:
        return max(1, math.ceil(self.bytes * keys_per_byte / RANGE_KEYS))

    def told(self, *answers: DataFrame) -> DataFrame:
        """The blocks with the answers they got; the k-th as columns part_k and bits_k (lists)."""
        out = self.table
        for k, answer in enumerate(answers):
            got = answer.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("part", "bits"))).alias("got"))
            got = got.select(F.col("block").alias(f"block_{k}"), F.col("got.bits").alias(f"bits_{k}"))
            out = out.join(got, F.col("block") == F.col(f"block_{k}"), "left").drop(f"block_{k}")
        return out


def contents(batch: pa.RecordBatch, row: int):
    """ids and the text bytes and offsets of one block."""
    ids = batch.column("ids")[row].values.to_numpy()
    data, offsets = grams.buffers(batch.column("texts")[row].values)
    return ids, data, offsets


def bits(batch: pa.RecordBatch, column: str, row: int, counts: np.ndarray) -> np.ndarray:
    """The answer about the sorted keys of a block; counts: how many keys were sent to each range."""
    lists = batch.column(column)[row].as_py() or []
    sent = counts[counts > 0]
    if not len(sent):
        return np.zeros(0, bool)
    assert len(sent) == len(lists), "a block's answers are not complete"
    return np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(lists, sent)]).astype(bool)


def dealt(keys: np.ndarray, ranges: int) -> np.ndarray:
    """How many of the sorted keys fall into each range."""
    part = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.bincount(part.astype(np.int64), minlength=ranges)


def request(block: int, keys: np.ndarray, ranges: int, owners: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows (part, block, keys, owners) for the sorted, distinct keys of a block."""
    counts = dealt(keys, ranges)
    part = np.flatnonzero(counts)
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts[part])]).astype(np.int32))
    owners = np.zeros(0, np.int64) if owners is None else owners
    ends = offsets if len(owners) else pa.array(np.zeros(len(part) + 1, np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(part.astype(np.int32)),
            pa.array(np.full(len(part), block, np.int64)),
            pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64))),
            pa.ListArray.from_arrays(ends, pa.array(owners)),
        ],
        ["part", "block", "keys", "owners"],
    )


REQUEST = "part int, block long, keys array<long>, owners array<long>"
ANSWER = "part int, block long, bits binary"


def _answer(asked: pa.Table, judge) -> pa.Table:
    lists = asked.column("keys").combine_chunks()
    counts = np.diff(lists.offsets.to_numpy())
    _, number = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    flags = judge(number, asked)
    ends = np.cumsum(counts)
    out = [np.packbits(flags[e - n : e]).tobytes() for e, n in zip(ends, counts)]
    return pa.table({"part": asked.column("part"), "block": asked.column("block"), "bits": pa.array(out, pa.binary())})


def _held_twice(number, asked):
    return np.bincount(number)[number] > 1


def _held_earlier(number, asked):
    owners = asked.column("owners").combine_chunks().flatten().to_numpy()
    least = np.full(int(number.max()) + 1, _LAST)
    np.minimum.at(least, number, owners)
    return least[number] < owners


def held_by_others(requests: DataFrame) -> DataFrame:
    """One bit per key: another block sent it, too."""
    return requests.groupBy("part").applyInArrow(lambda t: _answer(t, _held_twice), ANSWER)


def held_earlier(requests: DataFrame) -> DataFrame:
    """One bit per key: another block sent it with a smaller owner."""
    return requests.groupBy("part").applyInArrow(lambda t: _answer(t, _held_earlier), ANSWER)
