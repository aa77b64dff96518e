"""Term counts, TF-IDF weights, vocabularies, token ids and subword ids."""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.slices import slices
from corpusmill.functions.text import words
from corpusmill.operators.relational import heavy_join
from corpusmill.session import written

#: A vocabulary of at most this many bytes is sent to every task; a larger one is joined.
BROADCAST_BYTES = 32 << 20
#: Ids that are no terms: padding and words outside the vocabulary.
PADDING, UNKNOWN, FIRST_TERM = 0, 1, 2


def token_ids(text: Column, size: int) -> Column:
    """Word ids 1..size by MD5, the same in every system; no vocabulary is needed. 0 is padding."""
    return F.transform(
        words(text),
        lambda w: (F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("long") % size + 1).cast("int"),
    )


def term_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf). While every key has one row, which is looked up first, terms are counted where their text lies.

    Else the rows of a key are counted together, in a shuffle.
    """
    if _unique(df, key):
        return _counted(df.select(key, words(F.col(text)).alias("words")), key)
    terms = df.select(key, F.explode(words(F.col(text))).alias("term"))
    return terms.groupBy(key, "term").agg(F.count("*").alias("tf"))


def _unique(df: DataFrame, key: str) -> bool:
    return df.groupBy(key).count().where("count > 1").isEmpty()


def _counted(rows: DataFrame, key: str, without=None) -> DataFrame:
    """(key, term, tf); terms of the broadcast `without` have no row."""

    def run(batches):
        known = set(without.value[0]) if without else ()
        for batch in (part for whole in batches for part in slices(whole)):
            lists = batch.column("words")
            coded = lists.flatten().dictionary_encode()
            row, code = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy())), coded.indices.to_numpy().astype(np.int64)
            if known:
                rest = np.array([w not in known for w in coded.dictionary.to_pylist()], bool)[code]
                row, code = row[rest], code[rest]
            pairs, counts = np.unique(row * len(coded.dictionary) + code, return_counts=True)
            row, at = np.divmod(pairs, max(1, len(coded.dictionary)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(pa.array(row)), coded.dictionary.take(pa.array(at)), pa.array(counts, pa.int64())], [key, "term", "tf"]
            )

    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, term string, tf long")


def tfidf(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, weight): tf * (ln((1 + n) / (1 + df)) + 1), scaled to unit length per document; `key` is unique.

    Words are cut to count documents per term, which combines before its shuffle, and again for the weights. While the
    counted terms fit in a broadcast of known size, weights are computed where the texts lie. Else the most frequent that fit
    are sent; rows of the others, a small share, are joined and go back to their texts as lists.
    """
    distinct = df.select(F.explode(F.array_distinct(words(F.col(text)))).alias("term"))
    spread = written(distinct.groupBy("term").agg(F.count("*").alias("df")), "spread")
    n = df.count()
    size, total = spread.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    if total + 48 * size <= BROADCAST_BYTES:
        return _weighed(df.select(key, words(F.coalesce(text, F.lit(""))).alias("words")), key, spread, n)
    if _unique(df, key):
        return _weighed_with_rare(df, key, text, spread, n)
    raw = heavy_join(term_counts(df, key, text), spread, "term", "df").select(
        key, "term", (F.col("tf") * (F.log((1 + n) / (1 + F.col("df"))) + 1)).alias("raw")
    )
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("raw") / length).alias("weight"))


def _weighed(rows: DataFrame, key: str, spread: DataFrame, n: int) -> DataFrame:
    return _scaled(rows, key, _sent(spread, n))


def _sent(spread: DataFrame, n: int):
    local = spread.toPandas()  # at most BROADCAST_BYTES, as measured
    idf = np.log((1 + n) / (1 + local["df"].to_numpy())) + 1
    return spread.sparkSession.sparkContext.broadcast((local["term"].to_list(), idf))


def _scaled(rows: DataFrame, key: str, shared) -> DataFrame:
    """Weights of `words`: those among the terms sent, and those that a column `rare` lists as (term, raw)."""

    def run(batches):
        terms, idf = pa.array(shared.value[0], pa.string()), shared.value[1]
        places = {term: i for i, term in enumerate(shared.value[0])}
        for batch in (part for whole in batches for part in slices(whole)):
            lists = batch.column("words")
            # Each distinct word of a slice is looked up once.
            coded = lists.flatten().dictionary_encode()
            at = np.array([places.get(w, -1) for w in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            row, at = row[at >= 0], at[at >= 0]
            pairs, counts = np.unique(row * len(idf) + at, return_counts=True)
            row, at = np.divmod(pairs, max(1, len(idf)))
            raw, names = counts * idf[at], terms.take(pa.array(at))
            if "rare" in batch.schema.names:
                others = batch.column("rare")
                term, value = others.flatten().flatten()
                sizes = pc.fill_null(pc.list_value_length(others), 0).to_numpy()
                row, raw = np.r_[row, np.repeat(np.arange(batch.num_rows), sizes)], np.r_[raw, value.to_numpy()]
                names = pa.concat_arrays([names, term])
            length = np.sqrt(np.bincount(row, raw * raw, minlength=batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(row)), names, pa.array(raw / length[row])], [key, "term", "weight"])

    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, term string, weight double")


def _weighed_with_rare(df: DataFrame, key: str, text: str, spread: DataFrame, n: int) -> DataFrame:
    """As many of the most frequent terms as fit are sent. The others, in few texts each, are counted where the texts lie, and
    only their rows are moved: by term to their counts, then by key to their text, which is moved once.
    """
    # Terms by the power of two of their count, some 60 rows.
    power = F.length(F.bin("df"))
    steps = spread.groupBy(power.alias("power")).agg((F.sum(F.octet_length("term")) + 48 * F.count("*")).alias("bytes"))
    border, held = 64, 0
    for step in sorted(steps.collect(), reverse=True):
        held += step["bytes"]
        if held > BROADCAST_BYTES:
            break
        border = step["power"]
    shared = _sent(spread.where(power >= border), n)
    counts = _counted(df.select(key, words(F.col(text)).alias("words")), key, shared)
    raw = (F.col("tf") * (F.log((1 + n) / (1 + F.col("df"))) + 1)).alias("raw")
    rare = counts.join(spread.where(power < border), "term").select(F.col(key).alias("_key"), F.struct("term", raw).alias("pair"))
    lists = rare.groupBy("_key").agg(F.collect_list("pair").alias("rare"))
    # The lists are looked up in memory, so texts are not sorted.
    rows = df.select(key, text).join(lists.hint("shuffle_hash"), F.col(key).eqNullSafe(F.col("_key")), "left")
    return _scaled(rows.select(key, words(F.coalesce(text, F.lit(""))).alias("words"), "rare"), key, shared)


# --- learned vocabulary -----------------------------------------------------


class Vocabulary(NamedTuple):
    terms: DataFrame  # term, id, n: written
    size: int  # terms
    bytes: int  # of all terms


def numbered(rows: DataFrame, *order) -> DataFrame:
    """`rows` with `place`, 0.. without gaps in the given total order, and no task that holds all rows.

    Rows are range-sorted and written; a row's place is its place in its range and the rows in earlier ranges. Only one
    number a range is gathered.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    kept = written(ranged.select("*", F.spark_partition_id().alias("_range"), within.alias("_within")), "ranges")
    sizes = kept.groupBy("_range").agg(F.count("*").alias("_rows"))
    # One row a range: the window's single task holds as many rows as the sort had tasks.
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_range", before.alias("_start"))
    placed = kept.join(F.broadcast(starts), "_range").withColumn("place", F.col("_start") + F.col("_within"))
    return placed.drop("_range", "_within", "_start", "_rows")


def vocabulary(df: DataFrame, text: str, min_count=1, max_terms=None) -> Vocabulary:
    """Terms of all texts with ids from FIRST_TERM without gaps: most frequent first, then by term.

    Terms seen fewer than `min_count` times have no id, nor those after the first `max_terms`.
    """
    terms = df.select(F.explode(words(F.col(text))).alias("term"))
    counts = terms.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
    placed = numbered(counts, F.desc("n"), F.asc("term"))
    if max_terms is not None:
        placed = placed.where(F.col("place") < max_terms)
    kept = written(placed.select("term", (F.col("place") + FIRST_TERM).cast("int").alias("id"), "n"), "vocabulary")
    size, total = kept.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    return Vocabulary(kept, size, total)


def vocabulary_counts(df: DataFrame, key: str, text: str, terms: Vocabulary) -> DataFrame:
    """(key, id, tf): the sparse count vectors of texts over a vocabulary; other words have no row."""
    counts = term_counts(df, key, text)
    if _small(terms):
        return counts.join(F.broadcast(terms.terms.select("term", "id")), "term").select(key, "id", "tf")
    return heavy_join(counts, terms.terms, "term", "n").select(key, "id", "tf")


def _small(terms: Vocabulary) -> bool:
    # A broadcast term also has an id and an entry in a hash table.
    return terms.bytes + 48 * terms.size <= BROADCAST_BYTES


def vocabulary_ids(df: DataFrame, key: str, text: str, terms: Vocabulary, target="ids") -> DataFrame:
    """(key, target): the term ids of each text in text order, UNKNOWN for other words; `key` is unique.

    A small vocabulary is looked up where the texts lie. A large one is joined: hot words by broadcast, the rest by
    shuffle, and a text's ids are put back in order by their position.
    """
    if _small(terms):
        return _looked_up(df.select(key, words(F.coalesce(text, F.lit(""))).alias("words")), key, terms, target)
    texts = written(df.select(key, words(F.coalesce(text, F.lit(""))).alias("words")), "words")
    placed = texts.select(key, F.posexplode("words").alias("pos", "term"))
    known = heavy_join(placed, terms.terms, "term", "n").select(key, "pos", "id")
    lists = known.groupBy(key).agg(F.collect_list(F.struct("pos", "id")).alias("by"))
    return _put_back(texts.select(key, F.size("words").alias("n")).join(lists, key, "left"), key, target)


def _put_back(rows: DataFrame, key: str, target: str) -> DataFrame:
    """(key, target): n ids a row, those of `by` (pos, id) at their positions, UNKNOWN elsewhere."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            lists = batch.column("by")
            sizes = batch.column("n").to_numpy()
            offsets = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
            ids = np.full(offsets[-1], UNKNOWN, np.int32)
            pos, id = (x.to_numpy() for x in lists.flatten().flatten())
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = offsets[row] + pos
            if (pos >= sizes[row]).any() or np.bincount(at).max(initial=0) > 1:
                raise ValueError(f"{key} is not unique")
            ids[at] = id
            yield _with_lists(batch, key, pa.array(offsets, pa.int32()), ids, target)

    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, {target} array<int>")


def _looked_up(rows: DataFrame, key: str, terms: Vocabulary, target: str) -> DataFrame:
    # At most BROADCAST_BYTES, as measured.
    local = terms.terms.select("term", "id").toPandas()
    shared = rows.sparkSession.sparkContext.broadcast((local["term"].to_list(), local["id"].to_numpy(np.int32)))

    def run(batches):
        known, ids = pa.array(shared.value[0], pa.string()), np.r_[shared.value[1], UNKNOWN].astype(np.int32)
        for batch in (part for whole in batches for part in slices(whole)):
            lists = batch.column("words")
            at = pc.fill_null(pc.index_in(lists.flatten(), value_set=known), len(ids) - 1).to_numpy()
            yield _with_lists(batch, key, lists.offsets, ids[at], target)

    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, {target} array<int>")


def _with_lists(batch, key, offsets, values, target):
    starts = pc.subtract(offsets, offsets[0])
    lists = pa.ListArray.from_arrays(starts, pa.array(values, pa.int32()))
    return pa.RecordBatch.from_arrays([batch.column(key), lists], [key, target])


# --- subwords of a given vocabulary -------------------------------------------

#: The mark of a piece inside a word, and what is a piece of text of its own.
INSIDE = "##"
#: Words whose pieces a task keeps, some 300 bytes each.
MOST_KNOWN = 100_000
PRETOKEN = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"


class Subwords:
    """Longest-match-first cutting of words by a trie over a vocabulary's pieces."""

    def __init__(self, pieces: dict[str, int], unknown: int, longest_word: int):
        self.unknown, self.longest = unknown, longest_word
        self.first, self.inner = {}, {}
        for piece, id in pieces.items():
            inside = piece.startswith(INSIDE) and piece != INSIDE
            node = self.inner if inside else self.first
            for c in piece[len(INSIDE) :] if inside else piece:
                node = node.setdefault(c, {})
            node[""] = id  # no character is empty: the end of a piece

    def cut(self, word: str) -> list[int]:
        """Ids of the longest pieces from the left; one unknown id if some rest of the word is no piece."""
        if len(word) > self.longest:
            return [self.unknown]
        ids, at, node = [], 0, self.first
        while at < len(word):
            found, end = None, at
            for i in range(at, len(word)):
                node = node.get(word[i])
                if node is None:
                    break
                if "" in node:
                    found, end = node[""], i + 1
            if found is None:
                return [self.unknown]
            ids.append(found)
            at, node = end, self.inner
        return ids


def subword_ids(df: DataFrame, key: str, text: str, pieces: dict[str, int], unknown: int, begin=None, end=None, max_length=None, longest_word=100, target="ids") -> DataFrame:
    """(key, target): subword ids of lower-cased texts by a given vocabulary {piece: id}, `##` marking inner pieces.

    `begin` and `end` are put around a text, and `max_length` cuts its pieces so that both still fit. A word of more than
    `longest_word` characters is unknown. Each distinct word of a batch is cut once; the vocabulary is broadcast, so it
    must be one that fits (a tokeniser's: some 10,000 pieces).
    """
    shared = df.sparkSession.sparkContext.broadcast((pieces, unknown, longest_word))
    around = [*([] if begin is None else [begin])], [*([] if end is None else [end])]
    room = None if max_length is None else max_length - len(around[0]) - len(around[1])
    rows = df.select(key, F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(PRETOKEN), F.lit(0)).alias("words"))

    def run(batches):
        cutter, known = Subwords(*shared.value), {}
        for batch in (part for whole in batches for part in slices(whole)):
            lists = batch.column("words")
            coded = lists.flatten().dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            if len(known) > MOST_KNOWN:
                known.clear()
            cuts = [known[w] if w in known else known.setdefault(w, cutter.cut(w)) for w in distinct]
            sizes = np.array([len(c) for c in cuts], np.int64)
            flat = np.array([i for c in cuts for i in c], np.int32)
            starts = np.cumsum(sizes) - sizes
            code = coded.indices.to_numpy().astype(np.int64)
            # Pieces of all words in text order: a run of each word's pieces.
            many = sizes[code]
            ends = np.cumsum(many)
            values = flat[np.repeat(starts[code] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)]
            bounds = np.r_[0, ends][lists.offsets.to_numpy() - lists.offsets[0].as_py()]
            out = [np.r_[around[0], values[a : b if room is None else min(b, a + room)], around[1]] for a, b in zip(bounds, bounds[1:])]
            offsets = np.r_[0, np.cumsum([len(o) for o in out])]
            joined = np.concatenate(out) if out else np.zeros(0)
            yield _with_lists(batch, key, pa.array(offsets, pa.int32()), joined.astype(np.int32), target)

    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, {target} array<int>")
