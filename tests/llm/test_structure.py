"""Repair, whitening and packing against brute force, and on odd inputs."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from corpusmill.llm import dialogues, packing, whitening

# --- repair ------------------------------------------------------------------

TALK = "conv_id long, turn long, role string, text string, n string, code string, part string"
BLANKS = " \t\n\x0b\x0c\r"


def repaired(rows, damage=True):
    """Plain dynamic programming over (cost, audit), from the end."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        role, text = (" " if v is None else v for v in (role, text))
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20 if damage else -1
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        convs[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, faults = set(), []
        for _, role, text in held:
            bare = text.strip(BLANKS)
            if not bare:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        onward, kept = {"": "u", "s": "u", "u": "a", "a": "u"}, {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}
        best = {"": (0, "", ()), "a": (0, "", ()), "u": (2, "I", ("assistant:",)), "s": (4, "II", ("user:", "assistant:"))}
        names = {"u": "user", "a": "assistant"}
        for (_, role, text), fault in reversed(list(zip(held, faults))):
            new, cut = {}, fault == "truncated"
            for state in ("", "s", "u", "a"):
                c, a, r = best[state]
                ways = [(c + 3, "D" + a, r)]
                if fault not in ("blank", "duplicate"):
                    c, a, r = best[onward[state]]
                    ways.append((c + 2 + cut, "R" + a, (f"{names[onward[state]]}:{text}", *r)))
                    if (state, role[:1]) in kept:
                        c, a, r = best[role[:1]]
                        ways.append((c + cut, "K" + a, (f"{role}:{text}", *r)))
                new[state] = min(ways)
            for _ in range(3):
                for state in ("", "s", "u", "a"):
                    to = onward[state]
                    c, a, r = new[to]
                    new[state] = min(new[state], (c + 2, "I" + a, (names[to] + ":", *r)))
            best = new
        turns = [t for t, _, _ in held if t is not None]
        initials = [r[:1] or "?" for _, r, _ in held]
        count = Counter(faults)
        cost, audit, lines = best[""]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            count["blank"],
            count["duplicate"],
            count["truncated"],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def talk(seed=3, convs=60):
    rnd, rows = random.Random(seed), []
    for conv in [*range(convs), None]:
        n = rnd.choice([1, 2, 3, 5, 8, 13])
        for turn in rnd.sample(range(2 * n), n):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = rnd.choice(["Yes.", "No!", "and so", " ", "", None, f"Text {rnd.random()}. \n", "été", f"q {rnd.random()}?"])
            rows.append((conv, turn, role, text))
    rows += [(9000, t, ("user", "assistant")[t % 2] if t < 300 else "assistant", f"Line {t}.") for t in range(700)]
    rows += [(9001, t, "user", "the same.") for t in range(150)] + [(9001, 200, "assistant", "Fine")]
    rows += [(9002, t, "assistant", f"Only {t}") for t in range(401)] + [(9003, None, "user", "Hm."), (9004, 5, "system", "x" * 200_000 + ".")]
    dropped = next(c for c in range(10_000, 20_000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    return rows + [(dropped, 1, "user", "Gone.")]


@pytest.mark.parametrize("chunk,plain", [(10**6, 3), (40, 3), (9, 1), (25, 0)])
def test_repair_equals_plain_search(spark, chunk, plain):
    rows = talk()
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TALK).repartition(5)
    found = dialogues.repair(df, damage=True, chunk=chunk, plain_passes=plain).collect()
    want = repaired(rows)
    assert len(found) == len(want)
    for r in found:
        assert tuple(r)[1:] == want[r["conv_id"]], r["conv_id"]


def test_long_runs_of_one_role_need_the_unit_vectors(spark, monkeypatch):
    rows = [(1, t, "assistant", f"Only {t}.") for t in range(400)] + [(1, 400, "user", "End.")]
    asked = []
    rerun = dialogues._reruns
    monkeypatch.setattr(dialogues, "_reruns", lambda chunks, wanted: asked.append(wanted) or rerun(chunks, wanted))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = dialogues.repair(df, chunk=20).collect()
    assert tuple(found[0])[1:] == repaired(rows, damage=False)[1]
    assert len(asked) <= dialogues.PLAIN_PASSES + 1


def test_repair_of_copies_null_turns_and_nothing(spark):
    rows = [(1, None, "user", "Hi."), (1, None, "user", "Hi."), (1, 3, "user", "Hi."), (1, 3, "assistant", "Yo."), (1, 9, None, None)]
    schema = "conv_id long, turn long, role string, text string"
    row = dialogues.repair(spark.createDataFrame(rows, schema)).first()
    assert (row["gaps"], row["blank"], row["duplicate"], row["truncated"], row["audit"]) == (5, 1, 2, 0, "KDKDD")
    assert row["repaired_sha256"] == hashlib.sha256(b"user:Hi.\nassistant:Yo.").hexdigest()
    assert dialogues.repair(spark.createDataFrame([], schema)).collect() == []
    far = dialogues.repair(spark.createDataFrame([(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b.")], schema)).first()
    assert far["gaps"] is None or far["gaps"] > 0


def test_repair_by_text_keys(spark):
    rows = [("a", 1, "user", "Hi."), ("a", 2, "assistant", "Yo."), ("b", 1, "assistant", "Yo.")]
    found = dialogues.repair(spark.createDataFrame(rows, "name string, turn int, role string, text string"), conv="name").collect()
    assert {r["name"]: r["audit"] for r in found} == {"a": "KK", "b": "IK"}


def test_a_hot_conversation_is_spread_over_chunks(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"Line {t}.") for t in range(2000)] + [(2, 0, "user", "Hi.")]
    marked = dialogues.marked(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text", False)
    _, live, dead = dialogues.elements(marked)
    sizes = [r["count"] for r in dialogues.chunked(live, dead, 100).groupBy("part").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 400


# --- whitening -----------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, n string, component string, x string"


def plain_whitening(vectors):
    x = np.array([[int(np.floor(float(np.float32(c)) * 1024)) + 100_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s).astype(np.float64) / n
    e, w = np.linalg.eigh(y.T @ y / n)
    return n, ((n * x - s) ** 2).sum(axis=1), e[::-1], w[:, ::-1], y


def check_whitening(found, ids, vectors, components=8):
    n, deviation, e, w, y = plain_whitening(vectors)
    used = min(components, int((e > 1e-9 * e[0]).sum()))
    assert len(found) == len(ids) * used
    z = np.zeros((len(ids), used))
    at = {i: k for k, i in enumerate(ids)}
    for r in found:
        z[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and int(r["deviation"]) == deviation[at[r["vec_id"]]]
        assert abs(r["explained"] * e.sum() / e[r["component"] - 1] - 1) < 1e-6
        assert r["identity_error"] < 1e-8
    for k in range(used):
        want = y @ w[:, k] / np.sqrt(e[k])
        assert min(np.abs(z[:, k] - want).max(), np.abs(z[:, k] + want).max()) < 1e-6
    return z


def test_whitening_equals_the_eigenvectors(spark):
    rnd = np.random.default_rng(4)
    mix = rnd.normal(size=(12, 12)) * np.geomspace(1, 40, 12)
    vectors = (rnd.normal(size=(300, 12)) @ mix + 7).astype(np.float32).tolist()
    odd = [(900, None), (901, [None] + [1.0] * 11), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, []), (905, [1.0])]
    rows = [(i, v, "a", "b", "c") for i, v in [*enumerate(vectors), *odd]]
    found = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(4)).collect()
    check_whitening(found, range(300), vectors)


def test_whitening_of_dependent_and_badly_scaled_columns(spark):
    rnd = np.random.default_rng(5)
    x = np.round(rnd.normal(size=(200, 5)) * [4000, 900, 30, 2, 1])
    vectors = np.c_[x, x[:, 0] + x[:, 1], np.full(200, 3.0)].tolist()
    found = whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in found} == {1, 2, 3, 4, 5}
    z = np.zeros((200, 5))
    for r in found:
        z[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(z.T @ z / 200 - np.eye(5)).max() < 1e-6


def test_whitening_needs_several_passes(spark):
    """Columns so alike that one Cholesky factor of the squared matrix would not do."""
    rnd = np.random.default_rng(6)
    base = rnd.integers(-1_000_000, 1_000_000, 400)
    vectors = np.c_[base, base + rnd.integers(0, 2, 400) / 1024, rnd.integers(0, 9, 400)].astype(float).tolist()
    found = whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in found} == {1, 2, 3}
    z = np.zeros((400, 3))
    for r in found:
        z[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(z.T @ z / 400 - np.eye(3)).max() < 1e-4


def test_whitening_of_repeats_single_rows_and_nothing(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).collect() == []
    rows = [(None, [1.0, 0.0]), (1, [0.0, 3.0]), (1, [0.0, 3.0])]
    found = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert Counter((r["vec_id"], r["component"]) for r in found) == {(None, 1): 1, (1, 1): 2}
    big = [(i, [float(2**50) * (i % 3), 1.0 * i, 3e38 if i == 5 else 0.0]) for i in range(6)]
    found = whitening.whiten(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect()
    assert {r["n"] for r in found} == {5} and max(int(r["deviation"]) for r in found) > 2**63


# --- packing ---------------------------------------------------------------------

DOCS = "doc_id long, text string, piece string, rank string, part string"
TOKENS = public_tokenizers.path("word_bpe_49k.json")


def optimum(lengths, capacity):
    """Least number of sequences by plain search."""
    best = len(lengths)
    lengths = sorted(lengths, reverse=True)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for r in sorted({r for r in rooms if r >= lengths[i]}):
            rest = list(rooms)
            rest[rest.index(r)] -= lengths[i]
            put(i + 1, rest)
        put(i + 1, [*rooms, capacity - lengths[i]])

    put(0, [])
    return best


def test_bin_completion_equals_plain_search():
    rnd = random.Random(7)
    for _ in range(60):
        lengths = [rnd.randint(1, 30) for _ in range(rnd.randint(0, 11))]
        fillings = packing.bin_completion(Counter(lengths), 30)
        assert Counter(v for f, n in fillings.items() for v in f * n) == Counter(lengths)
        assert all(sum(f) <= 30 and n > 0 for f, n in fillings.items())
        assert sum(fillings.values()) == optimum(lengths, 30), lengths


def test_bin_completion_beats_best_fit():
    rnd = random.Random(1)
    counts = Counter(rnd.randint(400, 900) for _ in range(3000))
    found, plain = packing.bin_completion(counts), packing.best_fit(counts, 2048)
    assert packing.lower_bound(counts, 2048) <= sum(found.values()) < sum(plain.values())
    assert Counter({v: n for v, n in counts.items()}) == sum((Counter({v: n * f.count(v) for v in set(f)}) for f, n in found.items()), Counter())


def test_places_do_not_overlap():
    fillings = Counter({(10, 5, 5): 3, (10, 10): 2, (5,): 4, (20,): 1})
    lengths, firsts, sequences, offsets, copies = packing.places(fillings)
    used = defaultdict(list)
    for v, n in {10: 7, 5: 10, 20: 1}.items():
        for rank in range(n):
            at = max(i for i in range(len(lengths)) if lengths[i] == v and firsts[i] <= rank)
            over = rank - firsts[at]
            used[sequences[at] + over // copies[at]].append((offsets[at] + over % copies[at] * v, v))
    assert len(used) == 10
    for held in used.values():
        place = 0
        for offset, v in sorted(held):
            assert offset == place
            place += v


def check_packing(found, texts, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENS)
    want = Counter()
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            held = ids[start : start + capacity]
            want[doc, piece, start, len(held), zlib.crc32(np.array(held, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        place = 0
        for offset, length in sorted(held):
            assert offset == place
            place += length
        assert place <= capacity
    return len(sequences)


def test_packing_of_odd_texts(spark):
    rnd = random.Random(8)
    words = ["Don't", "naïve", "ΣΊΣΥΦΟΣ", "été", "漢字かな", "a_b", "x y", "q z", "\x1c", "it's", "1234", "<|endoftext|>", "!!!", "w" * 300, "́x", "😀👍🏽"]
    blanks = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", " \x85 "]
    texts = [(i, "".join(rnd.choice(words) + rnd.choice(blanks) for _ in range(rnd.randint(0, 200)))) for i in range(80)]
    texts += [(100, None), (101, ""), (102, "   "), (103, "long text " * 4000), (None, "null id"), (3, texts[3][1]), (3, texts[3][1])]
    df = spark.createDataFrame([(*t, "a", "b", "c") for t in texts], DOCS).repartition(6)
    found = packing.pack(df, TOKENS, capacity=64).collect()
    lengths = Counter(r["length"] for r in found)
    assert check_packing(found, texts, 64) <= packing.lower_bound(lengths, 64) * 1.02 + 1
    assert packing.pack(spark.createDataFrame([], DOCS), TOKENS).collect() == []


def test_words_have_the_ids_of_the_text(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "REMEMBERED", 50)
    ids, tokenizer = packing.Ids(TOKENS), Tokenizer.from_file(TOKENS)
    assert ids.by_word
    texts = [f"Ab{chr(c)}cd {chr(c)} 1{chr(c)}.{chr(c)}'S I'Ll" for c in [*range(0x500), 0x130, 0x1E9E, 0x2126, 0x212A, 0x3A3, 0x2028, 0xFEFF, 0x1F600]]
    for text, found in zip(texts, ids.of(texts)):
        assert found == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), ascii(text)
    other = packing.Ids(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_word and list(other.of(["Two  words"])) == [np.array(other.tokenizer.encode("Two  words", add_special_tokens=False).ids, "<u4").tobytes()]


def test_packing_of_equal_lengths(spark):
    """One length holds nearly all rows; ranks come from counts, not from a sort of the group."""
    texts = [(i, "one two three") for i in range(3000)] + [(5000, "a")]
    found = packing.pack(spark.createDataFrame([(*t, "a", "b", "c") for t in texts], DOCS).repartition(9), TOKENS, capacity=30).collect()
    assert check_packing(found, texts, 30) == 429
