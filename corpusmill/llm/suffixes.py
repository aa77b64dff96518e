"""Repeated byte strings by a distributed, sparse suffix array.

Of every string of 100 bytes one suffix start inside it is chosen by content: of its 64 runs of 37 bytes (leads), the one
with the least hash. Equal strings choose the same lead, so only suffixes at chosen starts are sorted, one for 30 bytes
or so. Leads that occur once are dropped first. The others' suffixes are range-partitioned by their leading bytes with
sampled splitters (Spark's range partitioning); each bucket sorts its suffixes by multikey quicksort, compares neighbours
and judges the strings of suffixes that share a lead; groups that may reach over a bucket's boundary are compared across.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import grams
from corpusmill.llm.blocks import REQUEST, Blocks, bits, contents, dealt, held_by_others, request
from corpusmill.session import scratch_path, written

LENGTH, STARTS = 100, 64
LEAD = LENGTH - STARTS + 1
#: Chosen suffixes per bucket, if all of them were repeated.
BUCKET_ROWS = 100_000

_LAST = np.iinfo(np.int64).max


class Chosen:
    """The chosen suffixes of some texts. For each: `lead` (hash), `at` (its start), and the range `low`..`high` of string
    starts that chose it; `text`, and `place` of low in the text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        sums = grams.running(grams._TABLE[data])
        n = max(len(data) - LEAD + 1, 0)
        leads = grams.every_window(sums, LEAD)
        bits_ = np.uint64(max(22, len(data).bit_length()))
        least = leads >> bits_
        least <<= bits_
        least |= np.arange(n, dtype=np.uint64)
        step = 1
        while step < STARTS:  # the least of 2, 4, ... 64 places
            least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
            step *= 2
        least &= (np.uint64(1) << bits_) - np.uint64(1)
        # Strings start inside one text; its last LENGTH - 1 places start none, which parts the texts.
        valid = np.zeros(len(least) + 1, bool)
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            valid[a : max(b - LENGTH + 1, a)] = True
        valid = valid[: len(least)]
        change = np.ones(len(least) + 1, bool)
        if len(least):
            change[1:-1] = (least[1:] != least[:-1]) | ~valid[1:] | ~valid[:-1]
        self.low = np.flatnonzero(valid & change[:-1])
        self.high = np.flatnonzero(valid & change[1:])
        self.at = least[self.low].astype(np.int64)
        self.text = np.searchsorted(offsets, self.low, side="right") - 1
        self.place = self.low - offsets[self.text]
        self.lead = leads[self.at] if n else np.zeros(0, np.uint64)
        self.whole = grams.window(sums, self.low, self.high + LENGTH)

    def take(self, mask):
        out = object.__new__(Chosen)
        out.__dict__ = {k: v[mask] for k, v in self.__dict__.items()}
        return out


def _ask_leads(ranges):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                _, data, offsets = contents(batch, row)
                yield request(batch.column("block")[row].as_py(), np.unique(Chosen(data, offsets).lead), ranges)

    return run


def _repeated(batch, row, data, offsets, ids, ranges):
    """Chosen suffixes with a lead that occurs again; the first of each content among them, whose number all have, and
    which ones come after that first."""
    chosen = Chosen(data, offsets)
    keys, number, count = np.unique(chosen.lead, return_inverse=True, return_counts=True)
    shared = bits(batch, "bits_0", row, dealt(keys, ranges)) | (count > 1) if len(keys) else np.zeros(0, bool)
    chosen = chosen.take(shared[number])
    owner = ids[chosen.text]
    order = np.lexsort((chosen.place, owner, chosen.whole))
    whole = chosen.whole[order]
    new = np.ones(len(order), bool)
    new[1:] = whole[1:] != whole[:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    first = order[new]
    later = (owner > owner[first][number]) | ((owner == owner[first][number]) & (chosen.place > chosen.place[first][number]))
    return chosen, first, number, later


def _send(ranges):
    """Rows (suffix, before, block, number, id, place): each repeated suffix, with the bytes before it, of a block."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, data, offsets = contents(batch, row)
                chosen, first, _, _ = _repeated(batch, row, data, offsets, ids, ranges)
                own, raw = chosen.take(first), data.tobytes()
                for a in range(0, len(first), 20_000):
                    cut = slice(a, a + 20_000)
                    lows, ats, highs = own.low[cut].tolist(), own.at[cut].tolist(), own.high[cut].tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([raw[x : y + LENGTH] for x, y in zip(ats, highs)], pa.binary()),
                            pa.array([raw[x:y] for x, y in zip(lows, ats)], pa.binary()),
                            pa.array(np.full(len(lows), batch.column("block")[row].as_py(), np.int64)),
                            pa.array(np.arange(a, a + len(lows))),
                            pa.array(ids[own.text[cut]]),
                            pa.array(own.place[cut].astype(np.int64)),
                        ],
                        ["suffix", "before", "block", "number", "id", "place"],
                    )

    return run


def multikey_order(letters: np.ndarray) -> np.ndarray:
    """Order of equally long rows of 8-byte characters by multikey quicksort: rows that tie in one are sorted by the next."""
    order = np.arange(len(letters))
    run = np.zeros(len(letters), np.int64)  # by position: where its run of equal rows starts
    live = order.copy()  # positions of runs that are not settled
    for depth in range(letters.shape[1]):
        if not len(live):
            break
        letter = letters[order[live], depth]
        inside = np.lexsort((letter, run[live]))
        order[live], letter = order[live[inside]], letter[inside]
        new = np.ones(len(live), bool)
        new[1:] = (run[live][1:] != run[live][:-1]) | (letter[1:] != letter[:-1])
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(live)))
        run[live] = np.repeat(live[at], size)
        live = live[np.repeat(size > 1, size)]
    return order


def _sorted_buckets(batches):
    """Per suffix: strings that an earlier suffix of the bucket has (`gone`), and those to compare across boundaries."""
    batches = [b for b in batches if b.num_rows]  # one bucket: sampled splitters keep it near BUCKET_ROWS
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    width = -(-(LENGTH + STARTS) // 8) * 8
    own = table.column("suffix").to_pylist()
    padded = np.frombuffer(b"".join([s.ljust(width, b"\0") for s in own]), np.uint8).reshape(-1, width)
    order = multikey_order(padded.view(">u8").astype(np.uint64))
    padded = padded[order]
    table = table.take(pa.array(order))
    ids, place = table.column("id").to_numpy(), table.column("place").to_numpy()
    before, own = table.column("before").to_pylist(), [own[k] for k in order]
    # Neighbours that share a lead are of one group.
    new = np.ones(len(order), bool)
    new[1:] = (padded[1:, :LEAD] != padded[:-1, :LEAD]).any(axis=1)
    group = np.cumsum(new) - 1
    # What lies outside of the bucket shares no more with a suffix than the bucket's first or last one does.
    reach = np.zeros(len(order), np.int64)
    for end in (0, -1):
        differ = padded != padded[end]
        reach = np.maximum(reach, np.where(differ.any(axis=1), differ.argmax(axis=1), width))
    # Owners in order: by id, then place; equal owners share a rank.
    ranked = np.lexsort((place, ids))
    step = np.ones(len(ranked), bool)
    step[1:] = (ids[ranked][1:] != ids[ranked][:-1]) | (place[ranked][1:] != place[ranked][:-1])
    rank = np.empty(len(ranked), np.int64)
    rank[ranked] = np.cumsum(step)
    # Suffixes with equal bytes before and after hold equal strings: those of the earliest stand for all.
    whole = [b + s for b, s in zip(before, own)]
    ends = np.concatenate([[0], np.cumsum([len(w) for w in whole])])
    sums = grams.running(grams._TABLE[np.frombuffer(b"".join(whole), np.uint8)])
    same = grams.mix(grams.window(sums, ends[:-1], ends[1:])) + np.array([len(b) for b in before], np.uint64)
    _, content = np.unique(same, return_inverse=True)
    least = np.full(int(content.max()) + 1, _LAST)
    np.minimum.at(least, content, rank)
    copy = rank > least[content]
    alone = (np.bincount(group)[group] == 1) & (reach < LEAD)
    many = np.diff(ends) - LENGTH + 1
    judge = np.flatnonzero(~copy & ~alone)
    row = np.repeat(judge, many[judge])
    shift = np.arange(len(row)) - np.repeat(np.cumsum(many[judge]) - many[judge], many[judge])
    start = ends[row] + shift
    keys = grams.window(sums, start, start + LENGTH)
    owner = rank[row] * STARTS + shift
    _, number = np.unique(keys, return_inverse=True)
    least = np.full(int(number.max()) + 1 if len(number) else 0, _LAST)
    np.minimum.at(least, number, owner)
    gone = least[number] < owner
    ahead = np.array([len(b) for b in before], np.int64)[row] - shift  # bytes of the string before its lead
    open_ = ~gone & (reach[row] >= LENGTH - ahead)
    dead = np.repeat(np.flatnonzero(copy), many[copy])
    dead_shift = np.arange(len(dead)) - np.repeat(np.cumsum(many[copy]) - many[copy], many[copy])

    def lists(rows, values, kind):
        counts = np.bincount(rows, minlength=len(order))
        values = values[np.argsort(rows, kind="stable")]
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values.astype(kind)))

    out = pa.RecordBatch.from_arrays(
        [
            *[table.column(c).combine_chunks() for c in ("block", "number", "id", "place")],
            lists(np.concatenate([row[gone], dead]), np.concatenate([shift[gone], dead_shift]), np.int32),
            lists(row[open_], shift[open_], np.int32),
            lists(row[open_], keys[open_].view(np.int64), np.int64),
        ],
        ["block", "number", "id", "place", "gone", "open", "keys"],
    )
    some = np.zeros(len(order), bool)
    some[np.concatenate([row[gone | open_], dead])] = True
    yield out.filter(pa.array(some))


def _cut(ranges):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, data, offsets = contents(batch, row)
                chosen, first, number, later = _repeated(batch, row, data, offsets, ids, ranges)
                # Which strings of each content are gone: STARTS marks per content.
                marks = np.zeros((len(first), STARTS), bool)
                answers = batch.column("answers")[row]
                if answers.is_valid:
                    told = answers.values
                    counts = np.diff(told.field("gone").offsets.to_numpy())
                    marks[np.repeat(told.field("number").to_numpy(), counts), told.field("gone").flatten().to_numpy()] = True
                many = chosen.high - chosen.low + 1
                pick = np.repeat(np.arange(len(many)), many)
                shift = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                dead = later[pick] | marks[number[pick], shift]
                removed = grams.covered((chosen.low[pick] + shift)[dead], LENGTH, len(data))
                before = np.zeros(len(data), bool)
                before[1:] = removed[:-1]
                before[offsets[:-1][offsets[:-1] < len(data)]] = False
                sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[offsets]).astype(np.int64)
                n_removed = sums(removed)
                kept = data[~removed]
                ends = offsets - np.concatenate([[0], np.cumsum(n_removed)])
                kept = [kept[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(np.diff(offsets)), pa.array(n_removed), pa.array(sums(removed & ~before)), pa.array(kept, pa.binary())],
                    ["id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return run


def without_repeats(docs: DataFrame, id="doc_id", text="text") -> DataFrame:
    """One row per document: `id`, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes that stay).

    A byte goes if it lies in a string of 100 bytes that also starts earlier: in a document with a smaller id, or before
    in the same document, as the input stands. Ids are whole numbers; a null id is larger than all others; rows of one id
    count as one document. Null and empty texts have no bytes. An empty table gives an empty result. Other columns are
    not read. Strings count as equal when their 64-bit hashes are.
    """
    blocks = Blocks(docs, id, text)
    ranges = blocks.ranges(1 / 30)
    leads = written(held_by_others(blocks.table.mapInArrow(_ask_leads(ranges), REQUEST)), "leads")
    told = blocks.told(leads)
    sent = told.mapInArrow(_send(ranges), "suffix binary, before binary, block long, number long, id long, place long")
    # Written, as it is read twice: for the splitters, and to be dealt.
    path = scratch_path(docs.sparkSession, "sent")
    sent.write.option("compression", "zstd").parquet(path)
    sent = docs.sparkSession.read.parquet(path)
    buckets = max(1, -(-blocks.bytes // (30 * BUCKET_ROWS)))
    judged = sent.repartitionByRange(buckets, "suffix").mapInArrow(
        _sorted_buckets, "block long, number long, id long, place long, gone array<int>, open array<int>, keys array<long>"
    )
    judged = written(judged, "suffixes")
    # Across boundaries: of each string the earliest owner stays.
    opened = judged.select("block", "number", "id", "place", F.explode(F.arrays_zip("open", "keys")).alias("o")).select(
        "block", "number", F.col("o.open").alias("shift"), F.struct("id", (F.col("place") + F.col("o.open")).alias("start")).alias("owner"), F.col("o.keys").alias("key")
    )
    firsts = opened.groupBy(F.col("key").alias("key_")).agg(F.min("owner").alias("first"))
    across = opened.join(firsts, F.col("key") == F.col("key_")).where("owner > first")
    across = across.groupBy("block", "number").agg(F.collect_list("shift").alias("gone"))
    gone = judged.where(F.size("gone") > 0).select("block", "number", "gone").unionByName(across)
    answers = gone.groupBy(F.col("block").alias("block_a")).agg(F.collect_list(F.struct("number", "gone")).alias("answers"))
    last = told.join(answers, F.col("block") == F.col("block_a"), "left").drop("block_a")
    out = last.mapInArrow(_cut(ranges), "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(F.nullif("id", F.lit(_LAST)).alias(id), "n_bytes", "n_removed", "n_spans", "kept")
