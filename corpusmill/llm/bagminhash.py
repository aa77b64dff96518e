"""Near duplicates by weighted Jaccard similarity of word shingles: BagMinHash signatures, bands, exact check.

A text is a bag of shingles (five words), a shingle weighs as often as it occurs. The signature is the pattern of first
points of Poisson processes. Each shingle owns a process over weight and time; the weight axis is cut into dyadic
strips [0,1), [1,2), [2,4), ..., one process per strip. A point has a time, a register and a weight inside its strip, all
hashed from shingle, strip and number, and counts for a text if the shingle's weight there is larger. A register keeps
its first point, so two texts agree in a register with probability sum(min)/sum(max) of their weights, without bias.

It is quick because points come in the order of time: after time T all registers of a text are filled with high
probability, so only points up to T are made, and T is raised for the few texts with an empty register.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import grams
from corpusmill.llm.graph import components
from corpusmill.session import written

SHINGLE = 5
#: Bands of rows: a pair at 0.8 is missed in all bands with probability (1 - 0.8^5)^32, 3 in a million.
BANDS, ROWS = 32, 5

_STRIP, _NUMBER = 0xD1342543DE82EF95, 0x9E3779B97F4A7C15


def shingles(words: grams.Words, size: int = SHINGLE):
    """Text number and hash of every shingle; a text of fewer words is one shingle, without words it has none."""
    at, hashes = words.windows(size, seed=5)
    text = words.text[at]
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    if len(short):
        begin, end = words.first[short], words.first[short + 1]
        whole = grams.mix(grams.window(grams.running(grams.mix(words.hash, 5)), begin, end), 5)
        text, hashes = np.concatenate([text, short]), np.concatenate([hashes, whole])
    order = np.lexsort((hashes, text))
    return text[order], hashes[order]


def bags(text: np.ndarray, hashes: np.ndarray):
    """Distinct shingles per text with their weights, from sorted pairs."""
    if not len(text):
        return text, hashes, np.zeros(0, np.int64)
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(text)))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(text, hashes, weights, n_texts: int, registers: int = BANDS * ROWS) -> np.ndarray:
    """One row of registers per text: the name of the first point of each register; zeros for a text without shingles."""
    best = np.full(n_texts * registers, np.inf)
    name = np.zeros(n_texts * registers, np.uint64)
    # A process per shingle and strip that its weight reaches: strips 0 ... top.
    strips = np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64) + 1
    pick = np.repeat(np.arange(len(text)), strips)
    strip = np.arange(len(pick)) - np.repeat(np.cumsum(strips) - strips, strips)
    low = np.where(strip > 0, 2.0 ** (strip - 1), 0.0)
    width = np.where(strip > 0, low, 1.0)
    owner, weight = text[pick], weights[pick].astype(np.float64)
    seed = grams.mix(hashes[pick] + strip.astype(np.uint64) * np.uint64(_STRIP), 1)
    # Up to time T a text has T times its weight points; by then an empty register is left in 1 of 8000 texts.
    volume = np.bincount(text, weights, n_texts)
    horizon = registers * (np.log(registers) + 9) / np.maximum(volume, 1)
    time, number = np.zeros(len(pick)), 0
    live = np.arange(len(pick))  # the processes whose next points may still matter
    while len(live):
        many = max(1, min(256, (1 << 15) // len(live)))
        numbers = np.arange(number, number + many, dtype=np.uint64) * np.uint64(_NUMBER)
        state = grams.mix(seed[live][:, None] + numbers, 2)
        when = time[live][:, None] + np.cumsum(-np.log(_uniform(grams.mix(state, 3))), axis=1) / width[live][:, None]
        inside = low[live][:, None] + _uniform(grams.mix(state, 4)) * width[live][:, None] < weight[live][:, None]
        row, point, at_time = np.broadcast_to(owner[live][:, None], state.shape)[inside], state[inside], when[inside]
        at = row * registers + (grams.mix(point, 6) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(best, at, at_time)
        won = at_time == best[at]
        name[at[won]] = point[won]
        time[live] = when[:, -1]
        live = live[when[:, -1] <= horizon[owner[live]]]
        number += many
    best, name = best.reshape(n_texts, registers), name.reshape(n_texts, registers)
    for t in np.flatnonzero(np.isinf(best).any(axis=1) & (volume > 0)):
        name[t] = _filled(hashes[text == t], weights[text == t], registers)
    return name


def _filled(hashes, weights, registers):
    """The signature of one text, point by point until no register can change."""
    best, name = np.full(registers, np.inf), np.zeros(registers, np.uint64)
    for h, w in zip(hashes, weights.astype(float)):
        for strip in range(int(np.ceil(np.log2(max(w, 1)))) + 1):
            low = 2.0 ** (strip - 1) if strip else 0.0
            width = low if strip else 1.0
            seed = grams.mix(np.array([h]) + np.uint64(strip * _STRIP & (2**64 - 1)), 1)
            time, first = 0.0, 0
            while time <= best.max():
                numbers = np.arange(first, first + 256, dtype=np.uint64)
                state = grams.mix(seed + numbers * np.uint64(_NUMBER), 2)
                times = time + np.cumsum(-np.log(_uniform(grams.mix(state, 3))) / width)
                inside = low + _uniform(grams.mix(state, 4)) * width < w
                register = (grams.mix(state, 6) % np.uint64(registers)).astype(np.int64)
                for k in np.flatnonzero(inside):
                    if times[k] < best[register[k]]:
                        best[register[k]], name[register[k]] = times[k], state[k]
                time, first = times[-1], first + 256
    return name


def band_keys(names: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One value per band, from its registers and its number."""
    grouped = names.reshape(len(names), bands, -1)
    out = np.zeros(grouped.shape[:2], np.uint64)
    for k in range(grouped.shape[2]):
        out = grams.mix(out + grouped[:, :, k], k)
    return grams.mix(out + np.arange(bands, dtype=np.uint64), 9)


def _blocks(batch: pa.RecordBatch, column: str, size: int = 2 << 20):
    """Slices of a batch with about `size` bytes of text."""
    texts = batch.column(column)
    data, offsets = grams.buffers(texts)
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + size)))
        yield batch.slice(begin, end - begin)
        begin = end


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(values.view(np.int64)))


def _signed(batches):
    for batch in batches:
        for part in _blocks(batch, "text"):
            data, offsets = grams.buffers(part.column("text"))
            words = grams.Words(data, offsets)
            text, hashes = shingles(words)
            total = np.bincount(text, minlength=part.num_rows)
            keys = band_keys(signatures(*bags(text, hashes), part.num_rows))
            counts = np.where(total > 0, BANDS, 0)
            yield pa.RecordBatch.from_arrays(
                [part.column("digest"), part.column("id"), pa.array(total), _lists(keys[total > 0].ravel(), counts)],
                ["digest", "id", "n", "bands"],
            )


def _bagged(batches):
    """The bag of each text as a set: a shingle's second occurrence is another element, and so on."""
    for batch in batches:
        for part in _blocks(batch, "text"):
            data, offsets = grams.buffers(part.column("text"))
            text, hashes = shingles(grams.Words(data, offsets))
            if len(text):
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
                begin = np.flatnonzero(new)
                nth = np.arange(len(text)) - np.repeat(begin, np.diff(np.append(begin, len(text))))
                hashes = grams.mix(hashes + nth.astype(np.uint64) * np.uint64(0xA0761D6478BD642F), 7)
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), _lists(hashes, np.bincount(text, minlength=part.num_rows))], ["node", "bag"]
            )


def _node():
    """64 bits of the digest: documents of one text share a node."""
    return F.conv(F.substring("digest", 1, 16), 16, -10).cast("long").alias("node")


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with the sizes of their bags and of the overlap, counted exactly, and what a has besides or is missing of b.

    These lists are kept where they are the smaller part of a bag.
    """
    one = sets.select(F.col("node").alias("a"), F.col("bag").alias("bag_a"))
    two = sets.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    both = pairs.join(one, "a").join(two, "b").withColumn("shared", F.size(F.array_intersect("bag_a", "bag_b")))
    besides = F.when(2 * F.col("shared") >= F.size("bag_a"), F.array_except("bag_a", "bag_b")).alias("besides")
    missing = F.when(2 * F.col("shared") >= F.size("bag_b"), F.array_except("bag_b", "bag_a")).alias("missing")
    return both.select("a", "b", "shared", F.size("bag_a").alias("n_a"), F.size("bag_b").alias("n_b"), besides, missing)


def _alike(tenths: int):
    """Overlap over union is tenths/10 or more, in whole numbers."""
    return (10 + tenths) * F.col("shared") >= tenths * (F.col("n_a") + F.col("n_b"))


def _sizes_fit(tenths: int):
    """A smaller bag is at least tenths/10 of a similar one."""
    return 10 * F.least("n_a", "n_b") >= tenths * F.greatest("n_a", "n_b")


def _still_apart(rows: DataFrame, centres: DataFrame, tested: DataFrame, labels: DataFrame, sets: DataFrame, tenths: int) -> DataFrame:
    """Pairs (a, b) of one bucket in different components that can still be similar.

    What two texts share lies inside their bucket's centre or outside of it. Inside, it is at most the smaller of their
    overlaps with the centre, which are known. Outside, at most the smaller of the shingles they have besides, of which
    those that no other text in question has do not count. Texts close to the centre are known by the short lists of
    what they have besides and what they miss, and these give the overlap itself. So the join yields few rows even in a
    large group of edited copies, while no similar pair is lost.
    """
    named = rows.join(labels, "node", "left").select("band", "node", "n", F.coalesce("label", "node").alias("label"))
    named = written(named, "named")
    apart = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("band")
    left = written(named.join(apart, "band", "left_semi"), "apart")
    alone = (
        sets.join(left.select("node").distinct(), "node", "left_semi")
        .select("node", F.explode("bag").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count("*").alias("texts"), F.min("node").alias("node"))
        .where("texts = 1")
        .groupBy("node")
        .agg(F.count("*").alias("own"))
    )
    own = F.coalesce("own", F.lit(0))
    centre = F.col("node") == F.col("b")
    bounded = (
        left.join(alone, "node", "left")
        .join(centres.select("band", "b", F.col("n_b").alias("n_centre")), "band")
        .join(tested.select(F.col("a").alias("node"), "b", "shared", "besides", "missing"), ["node", "b"], "left")
        .select(
            "band",
            "node",
            "n",
            "label",
            F.when(centre, F.col("n")).otherwise(F.col("shared")).alias("inside"),
            F.when(centre, F.lit(0)).otherwise(F.greatest(F.col("n") - F.col("shared") - own, F.lit(0))).alias("outside"),
            F.when(centre, F.array().cast("array<long>")).otherwise(F.col("besides")).alias("besides"),
            F.when(centre, F.array().cast("array<long>")).otherwise(F.col("missing")).alias("missing"),
            "n_centre",
        )
    )
    bounded = written(bounded, "apart")
    one, two = (bounded.select("band", "n_centre", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "label", "inside", "outside", "besides", "missing")]) for x in "ab")
    inside, needed = F.least("inside_a", "inside_b"), tenths * (F.col("n_a") + F.col("n_b"))
    enough = (10 + tenths) * (inside + F.least("outside_a", "outside_b")) >= needed
    common = lambda c: F.size(F.array_intersect(f"{c}_a", f"{c}_b"))
    both_have = one["n_centre"] - F.size("missing_a") - F.size("missing_b") + common("missing") + common("besides")
    exactly = (10 + tenths) * F.coalesce(both_have, inside + F.least("outside_a", "outside_b")) >= needed
    other = (F.col("label_a") != F.col("label_b")) & (F.col("node_a") > F.col("node_b"))
    pairs = one.join(two, (one["band"] == two["band"]) & other & _sizes_fit(tenths) & enough & exactly)
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, tenths=8, id="doc_id", text="text") -> DataFrame:
    """One row per document: `id`, digest (of its text), n_copies (documents of the same text), component_id, kept.

    Documents are linked when the weighted Jaccard similarity of their bags of five-word shingles is tenths/10 or more;
    texts without words link only with equal texts. Components of links are the classes: component_id is the smallest
    id in it (null ids come last), kept marks that document. A null text is an empty one, an empty and a null text are
    equal. Where ids repeat, every row of the kept id and text is marked. An empty table gives an empty result. Other
    columns are not read.

    Equal texts are one node. A bucket (texts that agree in a band) links each member with one centre, not all
    pairs; the one whose other buckets are fullest stands in the middle of its group. After the exact check, members of a
    bucket in different components are compared as well unless their bags rule it out, so no link between texts of one
    bucket is lost, however large the bucket.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.md5(plain.cast("binary")).alias("digest"), F.col(id).alias("id"), plain.alias("text"))
    id_type = docs.schema[id].dataType.simpleString()
    signed = written(source.mapInArrow(_signed, f"digest string, id {id_type}, n long, bands array<long>"), "signed")
    # The smallest id, nulls last, then the bands of that text, which are those of any of its documents.
    order = F.struct(F.col("id").isNull().alias("none"), "id")
    classes = signed.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n_copies"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = written(classes.select(_node(), "digest", "first", "n_copies", "n", "bands"), "classes")

    rows = written(classes.select("node", "n", F.explode("bands").alias("band")), "bands")
    sizes = rows.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    # From here on only buckets with several texts.
    rows = written(rows.join(sizes, "band"), "buckets")
    score = rows.groupBy("node").agg(F.sum("size").alias("score"))
    ranked = rows.join(score, "node")
    centres = ranked.groupBy("band").agg(F.max(F.struct("score", "node", "n")).alias("c")).select("band", F.col("c.node").alias("b"), F.col("c.n").alias("n_b"))
    centres = written(centres, "centres")
    first_pairs = (
        rows.select("band", F.col("node").alias("a"))
        .join(centres, "band")
        .where("a <> b")
        .select("a", "b")
        .distinct()
    )
    first_pairs = written(first_pairs, "pairs")
    needed = classes.join(score.select("node"), "node", "left_semi").select("node", F.col("digest").alias("digest_"), F.col("first.id").alias("id_"))
    texts = source.join(needed, (F.col("digest") == F.col("digest_")) & F.col("id").eqNullSafe(F.col("id_")))
    sets = texts.select("node", "text").mapInArrow(_bagged, "node long, bag array<long>").dropDuplicates(["node"])
    sets = written(sets, "bags")
    tested = written(_overlaps(first_pairs, sets), "tested")
    links = tested.where(_alike(tenths)).select("a", "b")
    labels = components(links)

    done = tested.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rest = written(_still_apart(rows, centres, tested, labels, sets, tenths).join(done, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        more = written(_overlaps(rest, sets).where(_alike(tenths)).select("a", "b"), "links")
        if not more.isEmpty():
            labels = components(links.union(more))

    grouped = classes.join(labels, "node", "left").select("digest", "first", "n_copies", F.coalesce("label", "node").alias("label"))
    lowest = grouped.groupBy("label").agg(F.min(F.struct("first", "digest")).alias("low"))
    out = grouped.join(lowest, "label").select("digest", "n_copies", F.col("first").alias("own"), "low")
    rows_out = signed.select("digest", "id").withColumnRenamed("digest", "digest_")
    return rows_out.join(out, F.col("digest_") == F.col("digest")).select(
        F.col("id").alias(id),
        "digest",
        "n_copies",
        F.col("low.first.id").alias("component_id"),
        ((F.col("digest") == F.col("low.digest")) & F.col("id").eqNullSafe(F.col("low.first.id"))).alias("kept"),
    )


def without_duplicates(docs: DataFrame, id="doc_id", text="text", **kw) -> DataFrame:
    """The documents with all their columns, one of each class; of rows alike in id and text one."""
    keep = near_duplicates(docs, id=id, text=text, **kw).where("kept").select(F.col(id).alias("id_"), F.col("digest").alias("digest_")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(id).alias("id"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("digest"))
    kept = rows.join(keep, (F.col("digest") == F.col("digest_")) & F.col("id").eqNullSafe(F.col("id_")), "left_semi")
    return kept.dropDuplicates(["digest", "id"]).select("row.*")
