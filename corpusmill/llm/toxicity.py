"""Toxicity by a bidirectional gated recurrent network with attention pooling, over words and their characters.

A text is scored in windows of WINDOW words that start at every word, so a run of up to WINDOW words is whole in one of
them; a training pass draws from the windows at every STRIDE-th word and the last, each pass from another first word. A
word enters as the embedding of its hash joined with the mean embedding of its hashed character triples, so unseen forms
of a known stem are recognised. All bytes of a text are read: a token of more than PIECE bytes (joined words, addresses,
scripts without blanks) is cut between letters and punctuation, and what is still longer into overlapping pieces; each is
a word of the windows. Two recurrent passes, attention over the window and a logistic output give a window's score; a text
has the score of its worst window. A recurrent unit has one gate, which weighs the last state against a candidate, and both
are bounded by x / (1 + |x|): on held-out texts this finds as much as three gates by tanh, at a fourth of the time. The
network is trained in numpy on a bounded sample; texts are scored inside tasks, with all windows of a batch side by side.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import grams
from corpusmill.llm.rules import held_out, training_rows

WINDOW, STRIDE = 24, 16
WORDS, TRIPLES, WIDTH, HIDDEN = 8192, 4096, 8, 8
#: Bytes of a word at most, but for the rest of a character; neighbours cut from one run share OVERLAP bytes.
PIECE, OVERLAP = 30, 15
#: Windows whose steps are taken side by side.
CHUNK = 2048
#: Labelled documents to train on, at most: half toxic, half clean.
SAMPLE = 2400

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# ASCII bytes that are neither letters nor digits.
_MARKS = np.zeros(256, bool)
_MARKS[:128] = True
_MARKS[48:58] = _MARKS[65:91] = _MARKS[97:123] = False


def read_words(data: np.ndarray, offsets: np.ndarray) -> grams.Words:
    """The words of a batch of texts, tokens over PIECE bytes in pieces that leave no byte out."""
    words = grams.Words(data, offsets)
    start, end = words.start, words.end
    if not len(start) or (end - start).max() <= PIECE:
        return words
    marks = _MARKS[data]
    blank = (data[:-1] == 0xC2) & (data[1:] == 0xA0)  # no-break space
    marks[:-1] |= blank
    marks[1:] |= blank
    # Long tokens are cut on both sides of punctuation, so that joined words are the words they are elsewhere.
    cut = np.flatnonzero(marks[:-1] != marks[1:]) + 1
    owner = np.searchsorted(start, cut, side="right") - 1
    own = (owner >= 0) & (cut > start[owner]) & (cut < end[owner]) & (end[owner] - start[owner] > PIECE)
    start = np.sort(np.concatenate([start, cut[own]]))
    end = np.sort(np.concatenate([end, cut[own]]))
    # What is still long: a piece every PIECE - OVERLAP bytes, the last one ends with the run; no character is halved.
    step = PIECE - OVERLAP
    many = np.maximum(-(-(end - start - PIECE) // step), 0) + 1
    run = np.repeat(np.arange(len(start)), many)
    k = np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
    first, last = start[run] + k * step, np.minimum(start[run] + k * step + PIECE, end[run])
    inner = np.append(data, 0) & 0xC0 == 0x80
    for _ in range(3):
        first -= inner[first] & (first > start[run])
        last += inner[last] & (last < end[run])
    words.start, words.end = first, last
    words.first = np.searchsorted(first, offsets)
    words.count = np.diff(words.first)
    words.text = np.repeat(np.arange(len(offsets) - 1), words.count)
    words.hash = None  # `inputs` hashes in lower case
    return words


def inputs(data: np.ndarray, words: grams.Words):
    """Distinct words of a batch: for each word its number, and per number the word bucket and its triples."""
    data = _LOWER[data]
    sums = grams.running(grams._TABLE[data]) if len(data) else np.zeros(1, np.uint64)
    hashes = grams.window(sums, words.start, words.end)
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    start, end = words.start[first], words.end[first]
    # Triples of bytes of the word between two marks; they start one byte before the word, so there is one per byte.
    count = end - start
    owner = np.repeat(np.arange(len(first)), count)
    at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    place = start[owner] + at

    def byte(k):
        where = place + k
        inside = (where >= start[owner]) & (where < end[owner])
        return np.where(inside, data[np.clip(where, 0, max(len(data) - 1, 0))] if len(data) else 0, 1).astype(np.uint64)

    triple = grams.mix(byte(-1) * np.uint64(65536) + byte(0) * np.uint64(256) + byte(1), 21) % np.uint64(TRIPLES)
    bucket = grams.mix(hashes[first], 22) % np.uint64(WORDS)
    return number, bucket.astype(np.int64), owner, triple.astype(np.int64)


def windows(words: grams.Words):
    """Start and length (in words) of all windows of each text, and their text; the last one ends with the text."""
    n = words.count
    many = np.where(n > 0, np.maximum(n - WINDOW, 0) + 1, 0)
    text = np.repeat(np.arange(len(n)), many)
    k = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    return text, words.first[:-1][text] + k, np.minimum(n[text], WINDOW)


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def bounded(x):
    """x / (1 + |x|), the network's activation: from -1 to 1 like tanh, in three plain operations."""
    return x / (1 + np.abs(x))


def slope(value):
    """The derivative of `bounded`, by its value."""
    return (1 - np.abs(value)) ** 2


def new_model(seed=7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
    model = {"word": 0.1 * rng.normal(size=(WORDS, WIDTH)).astype(np.float32), "triple": 0.3 * rng.normal(size=(TRIPLES, WIDTH)).astype(np.float32)}
    for d in "fb":
        model |= {f"w{d}": draw(2 * WIDTH, 2 * HIDDEN), f"u{d}": draw(HIDDEN, 2 * HIDDEN), f"c{d}": np.zeros(2 * HIDDEN, np.float32)}
    return model | {"att": draw(2 * HIDDEN, HIDDEN), "att_c": np.zeros(HIDDEN, np.float32), "query": draw(HIDDEN), "out": draw(2 * HIDDEN), "out_c": np.zeros(1, np.float32)}


def embedded(model, bucket, owner, triple):
    """Input vectors of the distinct words."""
    count = np.maximum(np.bincount(owner, minlength=len(bucket)), 1).astype(np.float32)
    chars = np.zeros((len(bucket), WIDTH), np.float32)
    if len(owner):
        begin = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1])
        chars[owner[begin]] = np.add.reduceat(model["triple"][triple], begin, axis=0)
    return np.concatenate([model["word"][bucket], chars / count[:, None]], axis=1), count


def projected(model, x):
    """The inputs of the gates of both directions, for each row of x."""
    return {d: x @ model[f"w{d}"] + model[f"c{d}"] for d in "fb"}


def forward(model, x, index, length, keep=False, tables=None):
    """Scores (logits) of windows; x: input vectors, index: rows of x per step (steps, windows); tables: `projected`, if at hand."""
    tables = tables or projected(model, x)
    steps, n = index.shape
    states, kept = {}, {}
    whole = not keep and length.min() >= steps
    for d in "fb":
        table = tables[d]
        u, h = model[f"u{d}"], np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((steps, n, HIDDEN), np.float32)
        trail = []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = bounded(table[index[t]] + h @ u)
            z, c = 0.5 + 0.5 * g[:, :HIDDEN], g[:, HIDDEN:]
            on = 1 if whole else (t < length).astype(np.float32)[:, None]
            new = c + z * (h - c) if whole else h + on * (1 - z) * (c - h)
            if keep:
                trail.append((t, h, z, c, on))
            h = out[t] = new
        states[d], kept[d] = out, trail
    both = np.concatenate([states["f"], states["b"]], axis=2)
    key = bounded(both @ model["att"] + model["att_c"])
    score = key @ model["query"]
    score[np.arange(steps)[:, None] >= length[None, :]] = -1e9
    weight = np.exp(score - score.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = (weight[:, :, None] * both).sum(axis=0)
    logit = pooled @ model["out"] + model["out_c"][0]
    return (logit, (both, key, weight, pooled, kept)) if keep else logit


def gradients(model, x, index, length, y):
    logit, (both, key, weight, pooled, kept) = forward(model, x, index, length, keep=True)
    n = len(y)
    d_logit = ((sigmoid(logit) - y) / n).astype(np.float32)
    g = {"out": pooled.T @ d_logit, "out_c": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * model["out"]
    d_both = weight[:, :, None] * d_pooled
    d_weight = (both * d_pooled).sum(axis=2)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["query"] = np.einsum("tnh,tn->h", key, d_score)
    d_key = d_score[:, :, None] * model["query"] * slope(key)
    g["att"] = np.einsum("tnd,tnh->dh", both, d_key)
    g["att_c"] = d_key.sum(axis=(0, 1))
    d_both = d_both + d_key @ model["att"].T
    d_x = np.zeros_like(x)
    for k, d in enumerate("fb"):
        own = d_both[:, :, k * HIDDEN : (k + 1) * HIDDEN]
        u, d_u, d_table = model[f"u{d}"], np.zeros_like(model[f"u{d}"]), np.zeros((len(x), 2 * HIDDEN), np.float32)
        d_h = np.zeros((n, HIDDEN), np.float32)
        for t, h, z, c, on in reversed(kept[d]):
            d_h = d_h + own[t]
            d_new = d_h * on
            d_c = d_new * (1 - z) * slope(c)
            d_z = d_new * (h - c) * 0.5 * slope(2 * z - 1)
            d_g = np.concatenate([d_z, d_c], axis=1)
            np.add.at(d_table, index[t], d_g)
            d_u += h.T @ d_g
            d_h = d_h * (1 - on) + d_new * z + d_g @ u.T
        g[f"u{d}"], g[f"w{d}"], g[f"c{d}"] = d_u, x.T @ d_table, d_table.sum(axis=0)
        d_x += d_table @ model[f"w{d}"].T
    return g, d_x


def _gathered(texts: list[str], chunk=200):
    """`inputs` and `windows` of many texts, a chunk at a time so that little memory is held."""
    parts, n_words, n_distinct = [], 0, 0
    for a in range(0, len(texts), chunk):
        data, offsets = grams.buffers(pa.array(texts[a : a + chunk], pa.string()))
        words = read_words(data, offsets)
        number, bucket, owner, triple = inputs(data, words)
        text, start, length = windows(words)
        part = (number + n_distinct, bucket, owner + n_distinct, triple, text + a, start + n_words, length)
        parts.append([values.astype(np.int32) for values in part])
        n_words, n_distinct = n_words + len(number), n_distinct + len(bucket)
    return [np.concatenate(p) for p in zip(*parts)]


def train(texts: list[str], y: np.ndarray, passes=4, steps=600, rate=0.01, seed=7):
    """A model for windows of these texts, from labels of whole texts.

    The first pass takes windows of all texts with their text's label. Later ones take, of a toxic text, the two windows
    that the model so far finds worst, and of a clean text its three worst and some others. Few texts are read in smaller
    batches and more passes, until `steps` steps are made.
    """
    model, rng = new_model(seed), np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    if len(y) == 0 or y.min() == y.max():
        return None
    number, bucket, owner, triple, *every = _gathered(texts)
    at = np.arange(len(every[0])) - np.searchsorted(every[0], every[0])
    last = np.append(every[0][1:] != every[0][:-1], True)[: len(at)]
    begin = np.searchsorted(owner, np.arange(len(bucket) + 1))
    step = 0
    for k in range(40):
        if k > passes and step >= steps:
            break
        pool = np.flatnonzero((at % STRIDE == 5 * k % STRIDE) | last)
        text, start, length = (r[pool] for r in every)
        label = y[text].astype(np.float32)
        if k == 0:
            rank = np.argsort(np.argsort(rng.random(len(text)) + 2 * text, kind="stable"))
            chosen = np.flatnonzero(rank - np.searchsorted(text, text) < 10)
        else:
            worst = _scores(model, number, bucket, owner, triple, start, length)
            order = np.lexsort((-worst, text))
            place = np.empty(len(text), np.int64)
            place[order] = np.arange(len(text)) - np.searchsorted(text, text[order])
            chosen = np.flatnonzero(np.where(label == 1, place < 2, (place < 3) | (rng.random(len(text)) < 0.15)))
        rng.shuffle(chosen)
        batch = max(32, min(192, len(chosen) // 40))
        for a in range(0, len(chosen), batch):
            own = chosen[a : a + batch]
            index = number[np.minimum(start[own] + np.arange(WINDOW)[:, None], start[own] + length[own] - 1)]
            used, local = np.unique(index, return_inverse=True)
            local = local.reshape(index.shape)
            pick = np.concatenate([np.arange(begin[u], begin[u + 1]) for u in used])
            sizes = begin[used + 1] - begin[used]
            own_owner = np.repeat(np.arange(len(used)), sizes)
            x, count = embedded(model, bucket[used], own_owner, triple[pick])
            g, d_x = gradients(model, x, local, length[own], label[own])
            step += 1
            for name in g:
                m, v = moments[name]
                m += 0.1 * (g[name] - m)
                v += 0.01 * (g[name] ** 2 - v)
                model[name] -= rate * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
            # Embeddings move where they were used (a sparse Adagrad step).
            for name, rows, grad in (
                ("word", bucket[used], d_x[:, :WIDTH]),
                ("triple", triple[pick], (d_x[:, WIDTH:] / count[:, None])[own_owner]),
            ):
                full = np.zeros_like(model[name])
                np.add.at(full, rows, grad)
                hit = np.unique(rows)
                moments[name][1][hit] += full[hit] ** 2
                model[name][hit] -= 0.1 * full[hit] / (np.sqrt(moments[name][1][hit]) + 1e-6)
    return model


def _scores(model, number, bucket, owner, triple, start, length, chunk=4096):
    """Logits of windows."""
    x, _ = embedded(model, bucket, owner, triple)
    tables = projected(model, x)
    out = np.zeros(len(start), np.float32)
    for a in range(0, len(start), chunk):
        s, n = start[a : a + chunk], length[a : a + chunk]
        index = number[np.minimum(s + np.arange(int(n.max()))[:, None], s + n - 1)]
        out[a : a + chunk] = forward(model, x, index, n, tables=tables)
    return out


def swept(model, tables, number, chunk=CHUNK):
    """Logits of the windows of WINDOW words that start at each word of a run but the last few; as `forward`.

    Step t of all windows reads the words from t on, so a step is a slice of the run, without gathers. Values lie gate by
    gate, so that a step works on long rows; a chunk of windows stays in the cache for all its steps.
    """
    n, size = len(number) - WINDOW + 1, HIDDEN
    out = np.empty(n, np.float32)
    weights = {d: np.ascontiguousarray(model[f"u{d}"].T) for d in "fb"}
    runs = {d: np.ascontiguousarray(tables[d][number].T) for d in "fb"}
    att, query, last = np.ascontiguousarray(model["att"].T), model["query"], model["out"]
    bias = model["att_c"][:, None]

    def bound(x, spare):
        np.abs(x, out=spare)
        spare += 1
        x /= spare

    for a in range(0, n, chunk):
        m = min(chunk, n - a)
        empty = lambda *shape: np.empty((*shape, m), np.float32)
        g, spare, gap, key = empty(2 * size), empty(2 * size), empty(size), empty(size)
        both, score, value = empty(WINDOW, 2 * size), empty(WINDOW), empty(WINDOW)
        z, c = g[:size], g[size:]
        for k, d in enumerate("fb"):
            h = np.zeros((size, m), np.float32)
            for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
                np.matmul(weights[d], h, out=g)
                g += runs[d][:, a + t : a + t + m]
                bound(g, spare)
                # h = c + (0.5 + 0.5 z) (h - c), z from -1 to 1
                np.subtract(h, c, out=gap)
                gap *= z
                h += c
                h += gap
                h *= 0.5
                both[t, k * size : (k + 1) * size] = h
        for t in range(WINDOW):
            np.matmul(att, both[t], out=key)
            key += bias
            bound(key, gap)
            np.matmul(query, key, out=score[t])
            np.matmul(last, both[t], out=value[t])
        score -= score.max(axis=0)
        np.exp(score, out=score)
        out[a : a + m] = (score * value).sum(axis=0) / score.sum(axis=0) + model["out_c"][0]
    return out


def text_scores(model, texts: pa.Array) -> np.ndarray:
    """The probability of each text's worst window; 0 for a text without words."""
    data, offsets = grams.buffers(texts)
    words = read_words(data, offsets)
    worst = np.full(len(offsets) - 1, -np.inf)
    if len(words.start):
        number, *parts = inputs(data, words)
        x, _ = embedded(model, *parts)
        tables = projected(model, x)
        # Texts of less than a window are one window each.
        few = np.flatnonzero((words.count > 0) & (words.count < WINDOW))
        start, length = words.first[few], words.count[few]
        for a in range(0, len(few), 4096):
            s, n = start[a : a + 4096], length[a : a + 4096]
            index = number[np.minimum(s + np.arange(int(n.max()))[:, None], s + n - 1)]
            worst[few[a : a + 4096]] = forward(model, x, index, n, tables=tables)
        many = np.flatnonzero(words.count >= WINDOW)
        if len(many):
            # Windows that would reach into the next text are left out.
            logit = np.append(swept(model, tables, number), -np.inf)
            bounds = np.stack([words.first[many], words.first[many] + words.count[many] - WINDOW + 1], axis=1)
            worst[many] = np.maximum.reduceat(logit, bounds.ravel())[::2]
    return np.where(np.isinf(worst), 0.0, sigmoid(np.where(np.isinf(worst), 0.0, worst)))


def _parts(batch: pa.RecordBatch, column: str, size=1 << 20):
    """Slices of a batch with about `size` bytes of text."""
    _, offsets = grams.buffers(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + size)))
        yield batch.slice(begin, end - begin)
        begin = end


def _scored(shared, column: str):
    """Slices of batches with their scores; shared: the broadcast model, of a fixed size (some 110,000 numbers)."""

    def run(batches):
        for batch in batches:
            for part in _parts(batch, column):
                model = shared.value
                yield part, np.zeros(part.num_rows) if model is None else text_scores(model, part.column(column))

    return run


def learned(docs: DataFrame, labels: DataFrame, label="toxic", parts=3, part=1, sample=SAMPLE, id="doc_id", text="text"):
    """The model for labels of ids whose crc32, modulo `parts`, is not `part`; None when one of the labels is missing."""
    rows = training_rows(docs, labels, label, ~held_out("key", parts, part), sample, id, text, stratify=True).toPandas()
    rows = rows.sort_values("id")  # at most `sample` texts
    return train(rows["text"].tolist(), rows["y"].to_numpy(np.float64))


def toxicity(docs: DataFrame, labels: DataFrame, parts=3, part=1, at=0.7, id="doc_id", text="text", **kw) -> DataFrame:
    """Per document: `id`, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 if score >= at, else 0).

    Null and empty texts, and all texts when the labels lack a kind, score 0. A null id is held out by its crc32 as an
    empty text. Repeated rows get equal scores. An empty table gives an empty result. Other columns are not read.
    """
    model = learned(docs, labels, parts=parts, part=part, id=id, text=text, **kw)
    run = _scored(docs.sparkSession.sparkContext.broadcast(model), "text")

    def score(batches):
        for part, scores in run(batches):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(scores)], ["id", "score"])

    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    scored = rows.mapInArrow(score, f"id {rows.schema['id'].dataType.simpleString()}, score double")
    predicted = (F.col("score") >= at).cast("int").alias("predicted")
    return scored.select(F.col("id").alias(id), held_out("id", parts, part).alias("held_out"), "score", predicted)


def without_toxic(docs: DataFrame, labels: DataFrame, at=0.7, text="text", **kw) -> DataFrame:
    """The documents, with all their columns, that score below `at`."""
    run = _scored(docs.sparkSession.sparkContext.broadcast(learned(docs, labels, text=text, **kw)), text)

    def keep(batches):
        for part, scores in run(batches):
            yield part.filter(pa.array(scores < at))

    return docs.mapInArrow(keep, docs.schema)
