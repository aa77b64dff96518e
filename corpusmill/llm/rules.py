"""Quality scores by a sparse ensemble of rules over text statistics.

Statistics of the whole text come from one pass over its bytes. Small trees are grown on labelled rows; every path from a
root is a rule, a conjunction of thresholds. A lasso logistic regression keeps few of them, and these are compiled into a
column expression, so scoring is built-in arithmetic over the statistics.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import grams

STATS = [
    "words", "word_bytes", "upper", "digit", "stops", "symbol", "accent", "distinct", "top_word", "lines", "distinct_lines", "line_words", "all_caps", "symbol_words",
]

#: Labelled rows that trees and weights are fitted on, at most; taken by a hash of the id.
SAMPLE = 12_000

_CLASS = np.zeros(256, np.uint8)
for _k, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"?-()", b"!#$%&*+/<=>@[\\]^_`{|}~"), 1):
    _CLASS[list(_bytes)] = _k
_CLASS[128:192] = 5  # continuation bytes: one per character beyond ASCII, mostly
_LINE = np.zeros(256, bool)
_LINE[10] = True


def _per_text(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values from first[t] to first[t + 1]."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return sums[first[1:]] - sums[first[:-1]]


def _repeats(text: np.ndarray, hashes: np.ndarray, n: int):
    """Per text: how many different hashes, and how often the commonest occurs."""
    order = np.lexsort((hashes, text))
    t, h = text[order], hashes[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    most = np.zeros(n)
    np.maximum.at(most, t[at], np.diff(np.append(at, len(t))))
    return np.bincount(t[at], minlength=n), most


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = grams.buffers(texts)
    n = len(offsets) - 1
    words, lines = grams.Words(data, offsets), grams.Words(data, offsets, _LINE)
    size = np.maximum(np.diff(offsets), 1)
    kind = _CLASS[data]
    share = [_per_text(offsets, kind == k) / size for k in range(1, 6)]
    count = np.maximum(words.count, 1)
    different, most = _repeats(words.text, words.hash, n)
    different_lines, _ = _repeats(lines.text, lines.hash, n)
    upper = np.concatenate([[0], np.cumsum(kind == 1)])
    marks = np.concatenate([[0], np.cumsum(kind == 4)])
    caps = (upper[words.end] - upper[words.start] >= 2) & (2 * (upper[words.end] - upper[words.start]) > words.end - words.start)
    return {
        "words": np.log1p(words.count),
        "word_bytes": _per_text(words.first, words.end - words.start) / count,
        **dict(zip(("upper", "digit", "stops", "symbol", "accent"), share)),
        "distinct": different / count,
        "top_word": most / count,
        "lines": np.log1p(lines.count),
        "distinct_lines": different_lines / np.maximum(lines.count, 1),
        "line_words": words.count / np.maximum(lines.count, 1),
        "all_caps": _per_text(words.first, caps) / count,
        "symbol_words": _per_text(words.first, marks[words.end] > marks[words.start]) / count,
    }


def _measured(batches):
    for batch in batches:
        begin = 0
        _, offsets = grams.buffers(batch.column("text"))
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + (4 << 20))))
            part = batch.slice(begin, end - begin)
            values = statistics(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("id"), *[pa.array(values[s].astype(np.float64)) for s in STATS]], ["id", *STATS])
            begin = end


def measured(docs: DataFrame, id: Column, text: Column) -> DataFrame:
    """id and the statistics of each text; a null text is an empty one, whose statistics are 0."""
    rows = docs.select(id.alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_measured, f"id {kind}, " + ", ".join(f"{s} double" for s in STATS))


def grow(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], rng, depth=3, least=20):
    """The paths of one tree on a random part of rows and columns: lists of (column, above, threshold)."""
    rows = rng.choice(len(y), max(1, len(y) // 2), replace=False)
    columns = rng.choice(x.shape[1], max(1, (2 * x.shape[1]) // 3), replace=False)
    paths, level = [], [((), rows)]
    for _ in range(depth):
        below = []
        for path, own in level:
            best, total, n = None, y[own].sum(), len(own)
            for c in columns:
                if not len(cuts[c]):
                    continue
                place = np.searchsorted(cuts[c], x[own, c], side="left")  # values up to cut k have place <= k
                left_n = np.cumsum(np.bincount(place, minlength=len(cuts[c]) + 1))[:-1]
                left_y = np.cumsum(np.bincount(place, y[own], minlength=len(cuts[c]) + 1))[:-1]
                right_n = n - left_n
                ok = (left_n >= least) & (right_n >= least)
                gain = np.where(ok, left_y**2 / np.maximum(left_n, 1) + (total - left_y) ** 2 / np.maximum(right_n, 1), -1)
                k = int(gain.argmax())
                if gain[k] > (best[0] if best else total**2 / n + 1e-9):
                    best = (gain[k], c, cuts[c][k])
            if best:
                _, c, cut = best
                up = x[own, c] > cut
                for above, part in ((False, own[~up]), (True, own[up])):
                    paths.append((*path, (int(c), above, float(cut))))
                    below.append((paths[-1], part))
        level = below
    return paths


def holds(rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c, above, cut in rule:
        out &= (x[:, c] > cut) == above
    return out


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds=400):
    """Weights and intercept of an L1 penalised logistic regression, by accelerated proximal steps."""
    n, k = z.shape
    w, b, step = np.zeros(k), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)), 4 * n / max((z**2).sum(), n)
    v, c, t = w.copy(), b, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(z @ v + c))) - y
        new = v - step * (z.T @ error) / n * 4
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty * 4, 0)
        new_b = c - error.mean()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / new_t * (new - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new, new_b, new_t
    return w, b


def fit(x: np.ndarray, y: np.ndarray, trees=40, penalty=2e-3, seed=3):
    """(rules, weights, intercept); without both labels no rules, and the share of label 1 as intercept."""
    if len(y) == 0 or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return [], np.zeros(0), float(np.log(p / (1 - p)))
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, c], np.linspace(0.02, 0.98, 49))) for c in range(x.shape[1])]
    rules = list(dict.fromkeys(r for _ in range(trees) for r in grow(x, y, cuts, rng)))
    z = np.stack([holds(r, x) for r in rules], axis=1).astype(np.float64) if rules else np.zeros((len(y), 0))
    w, b = lasso(z, y, penalty)
    used = np.flatnonzero(np.abs(w) > 1e-6)
    return [rules[k] for k in used], w[used], float(b)


def compiled(rules, weights, intercept) -> Column:
    """The score, a probability of label 1, as a column expression over the statistics."""
    total = F.lit(float(intercept))
    for rule, weight in zip(rules, weights):
        condition = F.lit(True)
        for c, above, cut in rule:
            condition = condition & ((F.col(STATS[c]) > cut) if above else (F.col(STATS[c]) <= cut))
        total = total + F.when(condition, F.lit(float(weight))).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def held_out(id, parts: int, part: int) -> Column:
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % parts == part


def training_rows(docs: DataFrame, labels: DataFrame, label: str, learn: Column, sample: int, id="doc_id", text="text", stratify=False) -> DataFrame:
    """At most `sample` labelled documents (id, text, y), those with the smallest hash of their id.

    Rows whose label is not 0 or 1, and repeated ids with unequal labels, teach nothing. With `stratify`, half of the
    sample is of each label.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull())
        .groupBy(F.col(id).alias("key"))
        .agg(F.min(label).alias("y"), F.max(label).alias("top"))
        .where("y = top")
        .where(learn)
        .select("key", "y", F.xxhash64("key").alias("order"))
    )
    if stratify:
        chosen = known.where("y = 1").orderBy("order").limit(sample // 2).union(known.where("y = 0").orderBy("order").limit(sample // 2))
    else:
        chosen = known.orderBy("order").limit(sample)
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # The sample has a bound of its own, so it may be broadcast. Where ids repeat, one text per id.
    return rows.join(F.broadcast(chosen), F.col("id") == F.col("key")).groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y"))


def quality(docs: DataFrame, labels: DataFrame, label="quality", parts=5, part=0, at=0.3, sample=SAMPLE, id="doc_id", text="text") -> DataFrame:
    """Per document: `id`, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 if score >= at, else 0).

    Labels are learned from ids whose crc32, modulo `parts`, is not `part`, from at most `sample` rows. Null and empty
    texts are scored by their statistics, all 0. A null id is held out by its crc32 as an empty text. Repeated rows get
    equal scores. Without labelled rows every score is 0.5; with one label only, its smoothed share. An empty table
    gives an empty result. Other columns of either table are not read.
    """
    chosen = training_rows(docs, labels, label, ~held_out("key", parts, part), sample, id, text)
    data = measured(chosen, F.struct("id", "y"), F.col("text")).select("id.*", *STATS)
    data = data.toPandas().sort_values("id")  # at most `sample` rows of numbers
    model = fit(data[STATS].to_numpy(np.float64).reshape(-1, len(STATS)), data["y"].to_numpy(np.float64))
    scored = measured(docs, F.col(id), F.col(text)).withColumn("score", compiled(*model))
    return scored.select(
        F.col("id").alias(id), held_out("id", parts, part).alias("held_out"), "score", (F.col("score") >= at).cast("int").alias("predicted")
    )
