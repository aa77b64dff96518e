"""Best-fit packing of tokenised documents by bin completion with branch and bound.

Documents are tokenised where they lie and cut into pieces of at most one sequence. For packing, pieces of equal length are
alike, so the problem is the table of lengths: at most as many rows as a sequence has tokens, at any size of the input. It
is solved on the driver as fillings (lists of lengths) with how often each is used. Best-fit decreasing gives the first
incumbent. The search fills the sequence of the largest piece left: it enumerates the undominated completions, least waste
first, uses one as often as the lengths allow, and goes on with what is left; branches whose waste cannot stay below the
incumbent's are cut. It ends when a lower bound is met or its steps are spent, so the result is whole in any case.

Pieces find their places without meeting: a piece's rank among those of its length is the number of equal ones in earlier
parts (sums per part and length) and earlier in its own part (counted while tokenising); runs of ranks belong to places of
fillings, which is a lookup in the small table of fillings.
"""

import json
import re
import zlib
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import written

#: Tokens of a sequence.
CAPACITY = 2048
#: Steps of the search over fillings, and completions looked at from one state.
STEPS, WIDTH = 6000, 24
#: Levels of the search between two incumbents by best fit.
LEVELS = 32
#: Words whose ids a worker remembers, about; texts cut at once.
REMEMBERED, TEXTS = 200_000, 256
#: Fixed value: how the tokenizer that is fed by word splits lower-cased texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for texts without characters from U+0250 on.
OTHER = re.compile("[^\x00-\u024f]")
LETTER, NUMBER, BLANK = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{BLANK}{LETTER}{NUMBER}]+")

#: A filling: lengths in falling order.
Filling = tuple[int, ...]


# --- lengths into fillings ---------------------------------------------------


def best_fit(counts: dict[int, int], capacity: int) -> Counter:
    """Best-fit decreasing: fillings and how often each is used. Equal pieces move together."""
    done: dict[int, Counter] = {}  # room left -> fillings
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in done if r >= length), default=None)
            fillings = Counter({(): -(-left // (capacity // length))}) if room is None else done.pop(room)
            room = capacity if room is None else room
            each = room // length
            for filling, n in fillings.items():
                full = min(n, left // each)
                rest = left - full * each if full < n else 0
                for k, m in ((each, full), (rest, 1 if rest else 0), (0, n - full - (1 if rest else 0))):
                    if m and (k or filling):
                        done.setdefault(room - k * length, Counter())[filling + (length,) * k] += m
                left -= full * each + rest
    return sum(done.values(), Counter())


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing uses fewer: pieces over half a sequence stand alone, and what cannot fill their room needs its own."""
    total = sum(length * n for length, n in counts.items())
    bound = -(-total // capacity)
    for small in sorted({0, *(v for length in counts for v in (length, capacity - length + 1) if v <= capacity // 2)}):
        # Pieces of more than capacity - small leave no room for one of at least `small`.
        alone = sum(n for v, n in counts.items() if v > capacity - small)
        middle = [(v, n) for v, n in counts.items() if capacity // 2 < v <= capacity - small]
        rest = sum(v * n for v, n in counts.items() if small <= v <= capacity // 2)
        pairs = sum(n for _, n in middle)
        room = pairs * capacity - sum(v * n for v, n in middle)
        bound = max(bound, alone + pairs + max(0, -(-(rest - room) // capacity)))
    return bound


def completions(counts: dict[int, int], room: int, waste: int, width: int) -> list[Filling]:
    """Undominated fillings of `room` from the lengths left that waste at most `waste`; least waste, then fewest and
    largest pieces, first; `width` at most.

    A filling is dominated if a piece that is left out could replace one or two of its pieces, or join it, in the room it
    wastes: the pieces set free fit wherever the larger piece would have gone.
    """
    lengths = sorted((v for v, n in counts.items() if n and v <= room), reverse=True)
    rising = lengths[::-1]
    found: list[Filling] = []
    looked = 0

    def undominated(filling, spare):
        used = Counter(filling)

        def left_out(least, most):
            """Whether a piece of such a length is not in the filling."""
            i = bisect_left(rising, least)
            while i < len(rising) and rising[i] <= most:
                if counts[rising[i]] > used[rising[i]]:
                    return True
                i += 1
            return False

        return not (
            left_out(1, spare)
            or any(left_out(a + 1, a + spare) for a in used)
            or any(left_out(a + b, a + b + spare) for i, a in enumerate(filling) for b in filling[i + 1 :])
        )

    def extend(filling, left, start):
        nonlocal looked
        looked += 1
        if looked > 40 * width or len(found) >= 4 * width:
            return
        if left <= waste and undominated(filling, left):
            found.append(filling)
            if not left:
                return
        for i in range(start, len(lengths)):
            v = lengths[i]
            if v <= left and filling.count(v) < counts[v]:
                extend((*filling, v), left - v, i)

    extend((), room, 0)
    return sorted(found, key=lambda f: (-sum(f), len(f), tuple(-v for v in f)))[:width]


def bin_completion(counts: dict[int, int], capacity=CAPACITY, steps=STEPS, width=WIDTH) -> Counter:
    """Fillings and how often each is used: all pieces, in as few sequences as the search finds."""
    counts = {v: n for v, n in counts.items() if n}
    whole = Counter({(capacity,): counts.pop(capacity)}) if capacity in counts else Counter()
    if not counts:
        return whole
    best, bound = best_fit(counts, capacity), lower_bound(counts, capacity)
    least, total = sum(best.values()), sum(v * n for v, n in counts.items())

    def spare():
        """Waste that a packing with one sequence less than the incumbent may have."""
        return (least - 1) * capacity - total

    def branches():
        """Ways to fill the sequences of the largest piece left, as often as the lengths allow."""
        largest = max(left)
        left[largest] -= 1
        fillings = completions(left, capacity - largest, min(capacity - largest, spare() - wasted), width)
        left[largest] += 1
        for filling in fillings:
            uses = Counter((largest, *filling))
            waste = capacity - largest - sum(filling)
            times = min(left[v] // n for v, n in uses.items())
            if waste:
                times = min(times, (spare() - wasted) // waste)
            if times > 0:
                yield (largest, *filling), times, waste

    left, wasted = dict(counts), 0
    taken: list[tuple[Filling, int, int]] = []
    levels = [branches()]
    for _ in range(steps):
        if least == bound or not levels:
            break
        step = next(levels[-1], None)
        if step is None:
            levels.pop()
            if taken:
                filling, times, waste = taken.pop()
                for v in filling:
                    left[v] = left.get(v, 0) + times
                wasted -= times * waste
            continue
        filling, times, waste = step
        for v in filling:
            left[v] -= times
            if not left[v]:
                del left[v]
        wasted += times * waste
        taken.append(step)
        if len(taken) % LEVELS == 0 or not left:
            # The rest by best fit: whole packings on the way down, incumbents where they are better.
            rest = best_fit(left, capacity)
            used = sum(n for _, n, _ in taken) + sum(rest.values())
            if used < least:
                best, least = rest, used
                for f, n, _ in taken:
                    best[f] += n
        levels.append(branches() if left else iter(()))
    return whole + best


# --- documents into pieces ----------------------------------------------------


def _byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it shows, else one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Ids:
    """Little-endian ids of texts by a tokenizer.

    A tokenizer that splits by PATTERN is fed word by word: a word is encoded once and remembered. Texts with characters
    from U+0250 on, where normal forms and cases differ between libraries, and texts of other tokenizers go to it whole.
    """

    def __init__(self, path):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        splits = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        forms = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        self.by_word = splits[0].get("pattern") == {"Regex": PATTERN} and splits[-1]["type"] == "ByteLevel" and forms == ["NFC", "Replace", "Lowercase"]
        self.model, self.letters, self.known = self.tokenizer.model, _byte_letters(), {}

    def words(self, text):
        """The words of a text, or None if it must be encoded whole."""
        low = text.lower()
        if self.by_word and OTHER.search(low) is None and "<|" not in text and OTHER.search(text) is None:
            return WORD.findall(low)

    def learn(self, words):
        for w in words:
            shown = w if w.isascii() and w.isprintable() else "".join([self.letters[b] for b in w.encode()])
            self.known[w] = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()

    def of(self, texts):
        """Ids of each text."""
        for a in range(0, len(texts), TEXTS):
            part = texts[a : a + TEXTS]
            lists = [self.words(t) for t in part]
            if len(self.known) > REMEMBERED:
                self.known.clear()
            self.learn(set().union(*filter(None, lists)).difference(self.known))
            known = self.known.__getitem__
            for text, words in zip(part, lists):
                if words is None:
                    yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                else:
                    yield b"".join(map(known, words))


#: One tokenizer and its words a worker process, for all its tasks.
_WORKER: dict[str, Ids] = {}


def _pieces(path, capacity, separator):
    """Pieces of every text, with the number of equally long ones before them in the part."""

    def run(batches):
        from corpusmill.llm.packing import _WORKER

        if path not in _WORKER:
            _WORKER[path] = Ids(path)
        ids, seen = _WORKER[path], Counter()
        part = TaskContext.get().partitionId()
        end = np.array([separator], "<u4").tobytes()
        for batch in batches:
            rows, piece, start, length, crc, rank = [], [], [], [], [], []
            for i, data in enumerate(ids.of([t or "" for t in batch.column("text").to_pylist()])):
                data += end
                for at in range(0, len(data), 4 * capacity):
                    held = data[at : at + 4 * capacity]
                    n = len(held) // 4
                    rows.append(i)
                    piece.append(at // (4 * capacity))
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(held))
                    rank.append(seen[n])
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(rows, pa.int32())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array([part] * len(rows), pa.int32()),
                    pa.array(rank, pa.int64()),
                ],
                ["id", "piece", "start", "length", "crc", "part", "rank"],
            )

    return run


def places(fillings: Counter) -> tuple[np.ndarray, ...]:
    """Sorted runs (length, first rank, sequence of it, offset, copies of the length in the filling)."""
    rows, used, sequence = [], Counter(), 0
    for filling in sorted(fillings, reverse=True):
        times = fillings[filling]
        for length, offset in zip(filling, accumulate(filling, initial=0)):
            if not rows or rows[-1][0] != length or rows[-1][2] != sequence:
                n = filling.count(length)
                rows.append((length, used[length], sequence, offset, n))
                used[length] += n * times
        sequence += times
    return tuple(np.array(c, np.int64) for c in zip(*sorted(rows)))


def _placed(shared):
    """Sequence and offset of pieces by length and rank."""

    def run(batches):
        lengths, firsts, sequences, offsets, copies = shared.value
        bounds = {int(v): (np.searchsorted(lengths, v), np.searchsorted(lengths, v, "right")) for v in np.unique(lengths)}
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.zeros(len(length), np.int64)
            for v in np.unique(length):
                a, b = bounds[int(v)]
                of = length == v
                at[of] = a + np.searchsorted(firsts[a:b], rank[of], "right") - 1
            over = rank - firsts[at]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "piece", "start", "length", "crc")),
                    pa.array(sequences[at] + over // copies[at]),
                    pa.array(offsets[at] + over % copies[at] * length),
                ],
                ["id", "piece", "start", "length", "crc", "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, tokenizer: str, id="doc_id", text="text", capacity=CAPACITY, separator=0, steps=STEPS) -> DataFrame:
    """One row per piece: `id`, piece, start, length, ids_crc32, sequence_id, offset.

    `tokenizer` is the path of a tokenizers file that drops white space, on every executor. A null or empty text is the
    separator alone. A text of any length is tokenised whole, by one task. Repeated rows and ids are documents of their
    own, null ids are kept. Ties: pieces of equal length take places in the order of parts and of rows in a part as
    written. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[id].dataType.simpleString()
    own = f"id {kind}, piece int, start long, length long, crc long"
    cut = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(
        _pieces(tokenizer, capacity, separator), f"{own}, part int, rank long"
    )
    cut = written(cut, "pieces")
    counts = written(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    fillings = bin_completion(totals, capacity, steps)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = cut.join(earlier, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("earlier")).drop("part", "earlier")
    shared = spark.sparkContext.broadcast(places(fillings) if fillings else (np.zeros(0, np.int64),) * 5)
    done = ranked.mapInArrow(_placed(shared), f"{own}, sequence_id long, offset long")
    return done.select(F.col("id").alias(id), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")
