"""Benchmark decontamination by spaced seeds.

Words are lower case and without punctuation. Over a span of 13 words, six masks each keep the words of two of the four
position classes (position modulo 4) and ignore the others, so any two substituted words leave one mask whole. The hashes
of kept words are joined between benchmark and documents; around a hit the whole span is compared word by word.

An item of SHORTEST to 12 words is one span of its own length, with no word substituted. A shorter item is found where it is
the whole document. A character of a script without blanks is a word; punctuation and blanks of all scripts part words.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import grams
from corpusmill.session import written

SPAN, SHORTEST = 13, 5
#: Words that may differ in a span.
SUBSTITUTED = 2
MASKS = [[p for p in range(SPAN) if p % 4 in pair] for pair in itertools.combinations(range(4), 2)]
#: Bits of the filter that spares documents without benchmark seeds the join; its size does not depend on any table.
FILTER_BITS = 1 << 26

# Letters, digits and all bytes of characters beyond ASCII are parts of words.
_BREAKS = np.ones(256, bool)
_BREAKS[128:] = False
_BREAKS[48:58] = False
_BREAKS[97:123] = False


#: Fixed values, as plain ranges, which a pattern tests fast. Scripts that put no blanks between words (Thai, Lao, Tibetan,
#: Burmese, Khmer, kana, Chinese characters), and punctuation and blanks beyond ASCII.
UNSPACED = r"\u0E01-\u0E4E\u0E81-\u0ECE\u0F40-\u0FBC\u1000-\u1049\u1050-\u109F\u1780-\u17D3\u3041-\u30FA\u30FC-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF"
BREAKS = r"\u00A0\u00A1\u00A7\u00AB\u00B6\u00B7\u00BB\u00BF\u1680\u2000-\u206F\u2E00-\u2E5D\u3000-\u3003\u3008-\u3020\u3030\u30FB\uFE10-\uFE19\uFE30-\uFE6B\uFF01-\uFF0F\uFF1A-\uFF20\uFF3B-\uFF40\uFF5B-\uFF65"


def lowered(column) -> Column:
    text = F.lower(F.coalesce(F.col(column), F.lit("")))
    parted = F.regexp_replace(F.regexp_replace(text, f"[{BREAKS}]", " "), f"([{UNSPACED}])", " $1 ")
    # Two ranges hold all of these; most texts have no character there, and are passed over fast.
    return F.when(text.rlike(r"[\u00A0-\u00BF\u0E00-\uFFFF]"), parted).otherwise(text)


def seeds(words: grams.Words):
    """Numbers of the words at which spans start, and for each a row of six seeds."""
    at = grams.starts(words.first, SPAN)
    out = np.zeros((len(at), len(MASKS)), np.uint64)
    for m, mask in enumerate(MASKS):
        value = np.full(len(at), m + 1, np.uint64)
        for p in mask:
            value = grams.mix(value * np.uint64(0x9E3779B97F4A7C15) + words.hash[at + p])
        out[:, m] = value
    return at, out


def _slices(batch, size=2 << 20):
    _, offsets = grams.buffers(batch.column("text"))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + size)))
        yield batch.slice(begin, end - begin)
        begin = end


def _spans(words: grams.Words, at: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.cumsum(size)
    flat = words.hash[np.repeat(at - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(flat.view(np.int64)))


def _whole(words: grams.Words, size: int):
    """Starts of all runs of `size` words (or only of texts of that many words) and a seed for each."""
    at = grams.starts(words.first, size)
    if size < SHORTEST:
        at = at[words.count[words.text[at]] == size]
    sums = grams.running(words.hash)
    return at, grams.mix(grams.window(sums, at, at + size) + np.uint64(size), 31)


def _found(words: grams.Words, sizes):
    """(start, size, seed) of all seeds of a batch: masks of spans, and runs of the given shorter sizes."""
    at, values = seeds(words)
    out = [(np.repeat(at, len(MASKS)), np.full(at.size * len(MASKS), SPAN), values.ravel())]
    for size in sizes:
        at, value = _whole(words, size)
        out.append((at, np.full(len(at), size), value))
    return [np.concatenate(p) for p in zip(*out)]


def _seeded(batches, shared=None):
    """Rows id, seed, span (hashes of its words). Items: all their seeds; documents: those that pass the filter, which also
    names the sizes of short items."""
    for batch in batches:
        for part in _slices(batch):
            data, offsets = grams.buffers(part.column("text"))
            words = grams.Words(data, offsets, _BREAKS)
            bits, sizes = (None, range(1, SPAN)) if shared is None else shared.value
            at, size, value = _found(words, sizes)
            if shared is None:
                # An item is short or has spans.
                keep = (size == SPAN) | (words.count[words.text[at]] == size)
                at, size, value = at[keep], size[keep], value[keep]
            for which in () if bits is None else (0, 1):
                places = _places(value)[which]
                keep = (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0
                at, size, value = at[keep], size[keep], value[keep]
            # Equal spans of a text say the same.
            content = grams.window(grams.running(words.hash), at, at + size) if len(at) else np.zeros(0, np.uint64)
            _, first = np.unique(np.stack([words.text[at].astype(np.uint64), value, content], axis=1), axis=0, return_index=True)
            at, size, value = at[first], size[first], value[first]
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(words.text[at])), pa.array(value.view(np.int64)), _spans(words, at, size)], ["id", "seed", "span"]
            )


def _places(values):
    return (values % np.uint64(FILTER_BITS)).astype(np.int64), ((values >> np.uint64(32)) % np.uint64(FILTER_BITS)).astype(np.int64)


def seed_filter(tests: DataFrame) -> np.ndarray:
    """A bit table of fixed size in which the places of all test seeds are set; tasks send sparse parts of it."""

    def marked(batches):
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            for places in _places(batch.column("seed").to_numpy().view(np.uint64)):
                np.bitwise_or.at(bits, places >> 3, (1 << (places & 7)).astype(np.uint8))
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits[at].astype(np.int16))], ["byte", "bits"])

    parts = tests.select("seed").mapInArrow(marked, "byte long, bits short").groupBy("byte").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    out[parts.column("byte").to_numpy()] = parts.column("bits").to_numpy().astype(np.uint8)
    return out


def overlaps(docs: DataFrame, benchmark: DataFrame, id="doc_id", text="text", item="item_id", item_text="text") -> DataFrame:
    """Pairs `id`, `item`, spans: how many spans of the document match a span of the item with two words substituted at most.

    Spans that are equal within a document count once. Shorter items match as a whole, see above; null and empty texts
    match nothing. Null ids are kept as ids of their own. Other columns are not read.
    """
    spark = docs.sparkSession
    item_type, id_type = benchmark.schema[item].dataType.simpleString(), docs.schema[id].dataType.simpleString()
    items = benchmark.select(F.col(item).alias("id"), lowered(item_text).alias("text"))
    tests = items.mapInArrow(_seeded, f"id {item_type}, seed long, span array<long>")
    tests = tests.select(F.col("id").alias("item"), "seed", F.col("span").alias("item_span")).distinct()
    tests = written(tests, "items")
    short = [r["n"] for r in tests.select(F.size("item_span").alias("n")).where(F.col("n") < SPAN).distinct().collect()]
    shared = spark.sparkContext.broadcast((seed_filter(tests), sorted(short)))  # FILTER_BITS / 8 bytes and 12 numbers
    rows = docs.select(F.col(id).alias("id"), lowered(text).alias("text"))
    found = rows.mapInArrow(lambda batches: _seeded(batches, shared), f"id {id_type}, seed long, span array<long>")
    same = F.aggregate(F.zip_with("span", "item_span", lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x)
    least = F.when(F.size("item_span") == SPAN, SPAN - SUBSTITUTED).otherwise(F.size("item_span"))
    hits = found.join(tests, "seed").where((F.size("span") == F.size("item_span")) & (same >= least))
    return hits.groupBy(F.col("id").alias(id), F.col("item").alias(item)).agg(F.countDistinct("span").alias("spans"))


def contamination(docs: DataFrame, benchmark: DataFrame, id="doc_id", text="text", item="item_id", **kw) -> DataFrame:
    """One row per document: `id`, leaked, n_items, items (sorted list of the items it overlaps with), spans.

    Rows with equal ids share a result, from the texts of all of them. An empty benchmark leaks nothing, an empty
    table gives an empty result.
    """
    pairs = overlaps(docs, benchmark, id=id, text=text, item=item, **kw)
    found = pairs.groupBy(F.col(id).alias("key")).agg(F.array_sort(F.collect_list(item)).alias("items"), F.sum("spans").alias("spans"))
    out = docs.select(F.col(id)).join(found, F.col(id).eqNullSafe(F.col("key")), "left")
    items = F.coalesce("items", F.array().cast(found.schema["items"].dataType))
    return out.select(id, F.size(items).alias("n_items"), (F.size(items) > 0).alias("leaked"), items.alias("items"), F.coalesce("spans", F.lit(0)).alias("spans"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id="doc_id", text="text", **kw) -> DataFrame:
    """The documents, with all their columns, that overlap with no item. Of rows with equal ids, each is judged by its text."""
    key = F.concat_ws(":", F.coalesce(F.col(id).cast("string"), F.lit("-")), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    keyed = docs.select(F.struct("*").alias("row"), key.alias("key"), F.col(text).alias("body"))
    bad = overlaps(keyed, benchmark, id="key", text="body", **kw).select(F.col("key").alias("leak")).distinct()
    return keyed.join(bad, F.col("key") == F.col("leak"), "left_anti").select("row.*")
