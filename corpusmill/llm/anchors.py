"""Repeated word windows by difference-cover anchors.

The positions 0, 1 and 3 modulo 7 form a difference cover: for any two positions there is a shift below 7 that brings
both onto the cover. Two equal windows of 13 words therefore share an anchor, a run of 7 words that starts on the cover in
both texts, at the same place of the window. Only anchors are hashed and exchanged at first; anchors that no other
document has end there. Around shared ones the matches are extended: windows of 13 words that hold a shared anchor are
compared as a whole, and the smallest document that has a window keeps its words.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import grams
from corpusmill.llm.blocks import REQUEST, Blocks, bits, contents, dealt, held_by_others, held_earlier, request
from corpusmill.session import written

PERIOD, COVER, WINDOW = 7, (0, 1, 3), 13
ANCHOR = WINDOW - PERIOD + 1


def _anchors(words: grams.Words):
    """Words at which anchors start, their distinct keys and the number of each one's key."""
    at, keys = words.windows(ANCHOR, seed=31)
    mine = np.isin((at - words.first[words.text[at]]) % PERIOD, COVER)
    distinct, number = np.unique(keys[mine], return_inverse=True)
    return at[mine], distinct, number


def _several(number: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Which of n keys belong to more than one owner."""
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(low, number, owner)
    np.maximum.at(high, number, owner)
    return low < high


def _ask_anchors(ranges):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, data, offsets = contents(batch, row)
                _, keys, _ = _anchors(grams.Words(data, offsets))
                yield request(batch.column("block")[row].as_py(), keys, ranges)

    return run


def _candidates(batch, row, words, ids, ranges):
    """Windows that hold a shared anchor: where they start, distinct keys, their least owner, the number of each one's key."""
    at, keys, number = _anchors(words)
    owner = ids[words.text]
    shared = bits(batch, "bits_0", row, dealt(keys, ranges))
    if len(keys):
        shared = shared | _several(number, owner[at], len(keys))
    marks = np.zeros(len(words.hash) + 1, np.int64)
    marks[at[shared[number]] + 1] = 1
    seen = np.cumsum(marks)
    start, keys = words.windows(WINDOW, seed=32)
    near = seen[start + PERIOD] > seen[start]
    start, keys = start[near], keys[near]
    distinct, number = np.unique(keys, return_inverse=True)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, number, owner[start])
    return start, distinct, least, number, owner


def _ask_windows(anchor_ranges, ranges):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, data, offsets = contents(batch, row)
                _, keys, least, _, _ = _candidates(batch, row, grams.Words(data, offsets), ids, anchor_ranges)
                yield request(batch.column("block")[row].as_py(), keys, ranges, least)

    return run


def _without(anchor_ranges, ranges):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, data, offsets = contents(batch, row)
                words = grams.Words(data, offsets)
                start, keys, least, number, owner = _candidates(batch, row, words, ids, anchor_ranges)
                earlier = bits(batch, "bits_1", row, dealt(keys, ranges))
                gone = (earlier[number] | (least[number] < owner[start])) if len(start) else np.zeros(0, bool)
                removed = grams.covered(start[gone], WINDOW, len(words.hash))
                n_removed = np.bincount(words.text, removed, len(ids)).astype(np.int64)
                kept = []
                for t in range(len(ids)):
                    own = slice(words.first[t], words.first[t + 1])
                    raw = data[offsets[t] : offsets[t + 1]].tobytes()
                    stay = np.flatnonzero(~removed[own])
                    a, b = words.start[own][stay] - offsets[t], words.end[own][stay] - offsets[t]
                    kept.append(b" ".join([raw[x:y] for x, y in zip(a.tolist(), b.tolist())]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(words.count.astype(np.int64)), pa.array(n_removed), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["id", "n_words", "n_removed", "kept"],
                )

    return run


def without_repeats(docs: DataFrame, id="doc_id", text="text") -> DataFrame:
    """One row per document: `id`, n_words, n_removed, kept (the words that stay, joined by blanks).

    A word goes if it lies in a window of 13 words whose sequence also starts in a document with a smaller id, as the
    input stands. Ids are whole numbers; a null id is larger than all others. Rows of one id do not remove each other's
    words. Null and empty texts have no words. An empty table gives an empty result. Other columns are not read. Windows
    count as equal when their 64-bit hashes are.
    """
    blocks = Blocks(docs, id, text)
    # Words are 6 bytes long, about: 3 anchors for 42 bytes, and fewer candidate windows.
    many, some = blocks.ranges(1 / 14), blocks.ranges(1 / 14)
    asked = blocks.table.mapInArrow(_ask_anchors(many), REQUEST)
    shared = written(held_by_others(asked), "anchors")
    asked = blocks.told(shared).mapInArrow(_ask_windows(many, some), REQUEST)
    earlier = written(held_earlier(asked), "windows")
    out = blocks.told(shared, earlier).mapInArrow(_without(many, some), "id long, n_words long, n_removed long, kept string")
    return out.select(F.nullif("id", F.lit(np.iinfo(np.int64).max)).alias(id), "n_words", "n_removed", "kept")
