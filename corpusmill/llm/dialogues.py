"""Repair of conversation structure by rank-convergence parallel Viterbi.

A repaired conversation has the roles `(s?(ua)+)?`. Keeping a row costs 0, giving it another role 2, deleting it 3,
inserting an empty row 2; a cut row that stays adds 1; blank and repeated rows must go. The cheapest edits are a shortest
path over four states: nothing yet, after system, after user, after assistant.

All rows are range-sorted by conversation and turn, and each part of the sort is a chunk, so a conversation of any length
is spread over tasks. Costs run backwards. A chunk whose conversation goes on behind it does not know the costs there: it
starts from a speculative vector. Where the vector that its successor arrives at differs from that by more than a constant,
a fix-up pass reruns the chunk from the successor's vector, until all agree. A chunk usually forgets its start within a few
rows. Long runs of one role never do; what is open after `PLAIN_PASSES` is rerun once from the four unit vectors, whose
least sums give the result for any start. The driver holds two rows a part at most. With the stitched costs the edits are
traced forwards, the least letter first, from each state that a chunk may be entered in; the entered ones are kept.

Deletions that must happen change no state and commute with everything, so they stay out of the vectors.
"""

import hashlib
import math
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import written

#: Rows of one chunk, about; a part of the sort.
CHUNK = 500_000
#: Fix-up passes from the successor's vector before unit vectors settle the rest.
PLAIN_PASSES = 3
#: Blanks, ends of a sentence, letters of roles, pairs of letters that may stand side by side.
BLANKS, ENDS, LETTERS, LEGAL = " \t\n\x0b\x0c\r", ".!?", "sua", ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
NAMES = {2: "user", 3: "assistant"}
#: States are 0 to 3. Where an inserted or reroled row leads to, where a kept one does, and costs behind the last row.
ONWARD = (2, 2, 3, 2)
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
AT_END = (0, 4, 2, 0)
INF = math.inf
UNIT = tuple(tuple(0 if i == j else INF for i in range(4)) for j in range(4))


def _letter(code):
    """Role letter of a live row's code, and whether the row is cut."""
    return (LETTERS + "x")[code // 2], code % 2


@lru_cache(maxsize=None)
def _ahead(behind, code):
    """(costs ahead of a row less their least, that least), given the costs behind it."""
    letter, cut = _letter(code)
    costs = []
    for state in range(4):
        ways = [3 + behind[state], 2 + cut + behind[ONWARD[state]]]
        if (state, letter) in KEPT:
            ways.append(cut + behind[KEPT[state, letter]])
        costs.append(min(ways))
    for _ in range(2):  # up to two insertions in a row
        costs = [min(c, 2 + costs[ONWARD[s]]) for s, c in enumerate(costs)]
    least = min(costs)
    return tuple(c - least for c in costs), least


@lru_cache(maxsize=None)
def _move(state, behind, code):
    """(letters of the edits at a row, their cost, state behind it): the least letters among the cheapest edits."""
    letter, cut = _letter(code)
    (ahead, least), edits, cost = _ahead(behind, code), "", 0
    while True:
        left = ahead[state] + least
        if 3 + behind[state] == left:
            return edits + DELETE, cost + 3, state
        if 2 + ahead[ONWARD[state]] + least == left:
            edits, cost, state = edits + INSERT, cost + 2, ONWARD[state]
            continue
        to = KEPT.get((state, letter))
        if to is not None and cut + behind[to] == left:
            return edits + KEEP, cost + cut, to
        return edits + REROLE, cost + 2 + cut, ONWARD[state]


def _level(costs):
    least = min(costs)
    return tuple(c - least for c in costs)


def _backwards(codes, vector):
    """The vector ahead of the first row and what was taken from it to keep it level."""
    taken = 0
    for code in reversed(codes):
        if code >= 0:
            vector, least = _ahead(vector, code)
            taken += least
    return vector, taken


def marked(rows: DataFrame, conv: str, turn: str, role: str, text: str, damage: bool) -> DataFrame:
    """conv, turn, role, text, n (0: dropped), blank, cut of every row, after damage if that is wanted."""
    space = F.lit(" ")
    base = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(role, space).alias("role"),
        F.coalesce(text, space).alias("text"),
    )
    if damage:
        name = F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
        base = base.withColumn("kind", F.crc32(name.cast("binary")) % 20)
        kind = F.col("kind")
        base = base.select(
            "conv",
            "turn",
            F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
            F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("n"),
        )
    else:
        base = base.withColumn("n", F.lit(1).cast("long"))
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    return base.withColumns({"blank": bare == "", "cut": ~F.substring(bare, -1, 1).isin(*ENDS)})


def _letter_of(role):
    first = F.substring(role, 1, 1)
    return F.when(first.isin(*LETTERS), first).otherwise("x")


def elements(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, live, dead) of marked rows, all written or cheap to repeat.

    counts: one row per (conv, turn, role) with n and blank. live: the first row of each (conv, role, text) that is not
    blank. dead: how many other rows a (conv, turn, role) has. Copies meet in partial aggregates, not in a group.
    """
    counts = written(
        rows.groupBy("conv", "turn", "role").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank")),
        "turns",
    )
    live = written(
        rows.where("n > 0 and not blank")
        .groupBy("conv", "role", "text", "cut")
        .agg(F.bool_or(F.col("turn").isNull()).alias("early"), F.min("turn").alias("turn"))
        .select(
            "conv",
            F.when(~F.col("early"), F.col("turn")).alias("turn"),
            "role",
            F.xxhash64("text").alias("h"),
            (F.position(_letter_of(F.col("role")), F.lit(LETTERS)) + 3).alias("c"),
            "cut",
            "text",
        )
        .select("conv", "turn", "role", "h", "text", ((F.col("c") % 4 * 2) + F.col("cut").cast("int")).alias("code")),
        "live",
    )
    dead = (
        counts.select("conv", "turn", "role", "n")
        .unionByName(live.select("conv", "turn", "role", F.lit(-1).cast("long").alias("n")))
        .groupBy("conv", "turn", "role")
        .agg(F.sum("n").alias("n"))
        .where("n > 0")
    )
    return counts, live, dead


ORDER = ["conv", "turn", "role", "dead", "h"]


def chunked(live: DataFrame, dead: DataFrame, chunk: int) -> DataFrame:
    """All rows in order, without their texts: part, at, code (-1: must go) and n; a part is a range of the order."""
    rows = live.select("conv", "turn", "role", F.lit(0).alias("dead"), "h", "code", F.lit(1).cast("long").alias("n")).unionByName(
        dead.select("conv", "turn", "role", F.lit(1).alias("dead"), F.lit(0).cast("long").alias("h"), F.lit(-1).alias("code"), "n")
    )
    rows = written(rows.withColumn("letter", _letter_of(F.col("role"))), "rows")
    parts = max(1, math.ceil(rows.count() / chunk))
    ranged = rows.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER)
    return written(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "chunks")


def _segments(table: pa.Table):
    """(sorted table, starts of the conversations in it and its end)."""
    table = table.sort_by("at")
    convs = table.column("conv").to_pylist()
    return table, [i for i in range(len(convs)) if not i or convs[i] != convs[i - 1]] + [len(convs)]


def _speculate(table):
    """Segments at both ends of a part, run from the costs at the end of a conversation."""
    table, starts = _segments(table)
    codes = table.column("code").to_pylist()
    segs = sorted({0, len(starts) - 2})
    firsts = pa.array([starts[s] for s in segs])
    exits = [list(_backwards(codes[starts[s] : starts[s + 1]], AT_END)[0]) for s in segs]
    return pa.table(
        {
            "part": table.column("part").take(firsts),
            "seg": pa.array(segs, pa.int32()),
            "conv": table.column("conv").take(firsts),
            "exit": pa.array(exits, pa.list_(pa.int64())),
        }
    )


def _rerun(shared, schema):
    """The wanted segments, run from given vectors: `exit` holds one vector of costs after the other."""

    def run(table):
        table, starts = _segments(table)
        codes, out = table.column("code").to_pylist(), []
        part = table.column("part")[0].as_py()
        for seg, vectors in shared.value.get(part, {}).items():
            exits = []
            for vector in vectors:
                vector, taken = _backwards(codes[starts[seg] : starts[seg + 1]], vector)
                exits += [float(c + taken) for c in vector]
            out.append({"part": part, "seg": seg, "exit": exits})
        return pa.Table.from_pylist(out, schema)

    return run


def _reruns(chunks: DataFrame, wanted: dict) -> dict:
    """{(part, seg): exits} of `wanted`, {part: {seg: vectors}}; at most two segments a part."""
    spark = chunks.sparkSession
    parts = F.broadcast(spark.createDataFrame([(p,) for p in wanted], "part int"))
    schema = pa.schema([("part", pa.int32()), ("seg", pa.int32()), ("exit", pa.list_(pa.float64()))])
    run = _rerun(spark.sparkContext.broadcast(wanted), schema)
    done = chunks.select("part", "at", "conv", "code").join(parts, "part", "left_semi")
    found = done.groupBy("part").applyInArrow(run, "part int, seg int, exit array<double>").collect()
    return {(r["part"], r["seg"]): [tuple(r["exit"][i : i + 4]) for i in range(0, len(r["exit"]), 4)] for r in found}


def stitched(chunks: DataFrame, plain_passes=PLAIN_PASSES) -> list[list[tuple[int, int, tuple]]]:
    """Conversations that span parts: their (part, seg, level costs behind it), first to last."""
    kind = chunks.schema["conv"].dataType.simpleString()
    narrow = chunks.select("part", "at", "conv", "code").groupBy("part")
    guesses = narrow.applyInArrow(_speculate, f"part int, seg int, conv {kind}, exit array<bigint>").collect()
    chains, ran = {}, {}
    for r in sorted(guesses, key=lambda r: (r["part"], r["seg"])):
        chains.setdefault(r["conv"], []).append((r["part"], r["seg"]))
        ran[r["part"], r["seg"]] = (AT_END, _level(tuple(r["exit"])))
    chains = [c for c in chains.values() if len(c) > 1]
    units = {}

    def walk(chain):
        """[(chunk, costs behind it, whether its exit is known for them)], last to first."""
        behind, out = AT_END, []
        for chunk in reversed(chain):
            start, exit = ran[chunk]
            fits = start == behind
            if chunk in units:
                exit, fits = _level(tuple(min(b + u[i] for b, u in zip(behind, units[chunk])) for i in range(4))), True
            out.append((chunk, behind, fits))
            behind = exit
        return out

    for turn in range(plain_passes + 1):
        walks = [walk(c) for c in chains]
        stale = [w for w in walks if not all(fits for _, _, fits in w)]
        if not stale:
            break
        wanted = {}
        for w in stale:
            for (part, seg), behind, fits in w:
                if turn == plain_passes and (part, seg) not in units:
                    wanted.setdefault(part, {})[seg] = UNIT
                elif turn < plain_passes and not fits:
                    wanted.setdefault(part, {})[seg] = (behind,)
        for chunk, exits in _reruns(chunks, wanted).items():
            if turn == plain_passes:
                units[chunk] = exits
            else:
                ran[chunk] = (wanted[chunk[0]][chunk[1]][0], _level(exits[0]))
    return [[(*chunk, behind) for chunk, behind, _ in reversed(walk(c))] for c in chains]


PIECE = {"seg": "int", "entry": "int", "left": "int", "cost": "long", "illegal": "long", "edge": "string", "audit": "string", "script": "string"}
ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


def _trace(shared):
    """Edits of every segment; one that continues a conversation is traced from each state."""

    def run(table):
        table, starts = _segments(table)
        codes, counts, letters = (table.column(c).to_pylist() for c in ("code", "n", "letter"))
        firsts, out = [], {name: [] for name in PIECE}
        known = shared.value.get(table.column("part")[0].as_py(), {})
        for seg in range(len(starts) - 1):
            a, b = starts[seg], starts[seg + 1]
            vector, begins, ends = known.get(seg, (AT_END, True, True))
            behind = [vector] * (b - a)
            for i in range(b - 1, a - 1, -1):
                behind[i - a] = vector
                if codes[i] >= 0:
                    vector, _ = _ahead(vector, codes[i])
            illegal = sum(n - 1 for n in counts[a:b]) + sum(letters[i - 1] + letters[i] not in LEGAL for i in range(a + 1, b))
            for entry in range(1 if begins else 4):
                state, cost, audit, script = entry, 0, [], []
                for i in range(a, b):
                    if codes[i] < 0:
                        audit.append(DELETE * counts[i])
                        cost += 3 * counts[i]
                    else:
                        edits, more, state = _move(state, behind[i - a], codes[i])
                        audit.append(edits)
                        script.append(edits)
                        cost += more
                tail = INSERT * (AT_END[state] // 2 if ends else 0)
                piece = (seg, entry, state, cost + 2 * len(tail), illegal, letters[a] + letters[b - 1], "".join(audit) + tail, "".join(script) + tail)
                firsts.append(a)
                for name, value in zip(PIECE, piece):
                    out[name].append(value)
        keys = table.select(["part", *ORDER]).take(pa.array(firsts))
        for name, kind in PIECE.items():
            keys = keys.append_column(name, pa.array(out[name], ARROW[kind]))
        return keys

    return run


def pieces(chunks: DataFrame, chains: list) -> DataFrame:
    """The edits of each segment, from the state that it is entered in, with the place of its first row."""
    spark = chunks.sparkSession
    known = {}
    for chain in chains:
        for place, (part, seg, behind) in enumerate(chain):
            known.setdefault(part, {})[seg] = (behind, place == 0, place == len(chain) - 1)
    run = _trace(spark.sparkContext.broadcast(known))
    schema = ", ".join([f"{c} {chunks.schema[c].dataType.simpleString()}" for c in ["part", *ORDER]] + [f"{n} {t}" for n, t in PIECE.items()])
    narrow = chunks.select("part", "at", *ORDER, "code", "n", "letter")
    traced = written(narrow.groupBy("part").applyInArrow(run, schema), "pieces")
    if not chains:
        return traced
    place, key = ["part", "seg", "entry"], "part int, seg int, entry int"
    chained = [(part, seg, e) for chain in chains for part, seg, _ in chain for e in range(4)]
    asked = F.broadcast(spark.createDataFrame(chained, key))
    leads = {(r["part"], r["seg"], r["entry"]): r["left"] for r in traced.select(*place, "left").join(asked, place, "left_semi").collect()}
    entered = set()
    for chain in chains:
        state = 0
        for part, seg, _ in chain:
            entered.add((part, seg, state))
            state = leads[part, seg, state]
    unused = F.broadcast(spark.createDataFrame([c for c in chained if c not in entered], key))
    return traced.join(unused, place, "left_anti")


RESULT = [("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("sha", pa.string())]


def _repaired(batches):
    """One row per conversation from its pieces and live rows in order, read as a stream; only a piece is held."""
    held, current, now, schema = [], object(), None, None

    def insert():
        while now["todo"] < len(now["script"]) and now["script"][now["todo"]] == INSERT:
            now["state"] = ONWARD[now["state"]]
            put(NAMES[now["state"]] + ":")
            now["todo"] += 1

    def put(line):
        now["sha"].update(("\n" if now["any"] else "").encode() + line.encode())
        now["any"] = True

    def done():
        insert()
        return {"conv": now["conv"], "illegal": now["illegal"], "cost": now["cost"], "audit": "".join(now["audit"]), "sha": now["sha"].hexdigest()}

    for batch in batches:
        schema = pa.schema([("conv", batch.schema.field("conv").type), *RESULT])
        for row in batch.to_pylist():
            if row["conv"] != current:
                if now:
                    held.append(done())
                current = row["conv"]
                now = {"conv": current, "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(), "any": False, "state": 0, "script": "", "todo": 0, "edge": ""}
            if row["kind"] == 0:
                insert()
                now["audit"].append(row["audit"])
                now["illegal"] += row["illegal"] + (now["edge"] != "" and now["edge"][1] + row["edge"][0] not in LEGAL)
                now["cost"] += row["cost"]
                now["edge"], now["script"], now["todo"] = row["edge"], row["script"], 0
                continue
            insert()
            edit = now["script"][now["todo"]]
            now["todo"] += 1
            if edit == KEEP:
                now["state"] = KEPT[now["state"], row["role"][0]]
                put(row["role"] + ":" + row["text"])
            elif edit == REROLE:
                now["state"] = ONWARD[now["state"]]
                put(NAMES[now["state"]] + ":" + row["text"])
        if len(held) >= 1000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if now:
        held.append(done())
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def repair(
    rows: DataFrame, conv="conv_id", turn="turn", role="role", text="text", damage=False, chunk=CHUNK, plain_passes=PLAIN_PASSES
) -> DataFrame:
    """One row per conversation: `conv`, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows stand by turn, nulls first. Rows of one turn: by role, then rows that may stay before those that must go, then
    by the text's hash; equal rows are repeats of one another. Null roles and texts are one space, which is blank as a
    text and no known letter as a role; an empty role has no known letter either. A null conversation is one of its own.
    A conversation whose rows are all dropped by the damage has zeros, an empty audit and the hash of nothing; an empty
    table gives no rows. Other columns are not read, so their names do not matter; a text of any length is one value of
    one row. `damage` plants the faults of the contract before anything is counted.

    The hash of a repaired conversation is taken in order in one task, as a stream that holds one piece of edits and one
    batch of rows; its audit is one value. All else is spread however long a conversation is.
    """
    all_rows = marked(rows, conv, turn, role, text, damage)
    counts, live, dead = elements(all_rows)
    chunks = chunked(live, dead, chunk)
    found = pieces(chunks, stitched(chunks, plain_passes))
    stream = found.select(*ORDER, F.lit(0).alias("kind"), "illegal", "cost", "edge", "audit", "script", F.lit("").alias("text")).unionByName(
        live.select(
            "conv", "turn", "role", F.lit(0).alias("dead"), "h", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("illegal"),
            F.lit(0).cast("long").alias("cost"), F.lit("").alias("edge"), F.lit("").alias("audit"), F.lit("").alias("script"), "text",
        )
    )
    kind = rows.schema[conv].dataType.simpleString()
    done = (
        stream.repartition("conv")
        .sortWithinPartitions(*ORDER, "kind", "text")
        .select("conv", "role", "kind", "illegal", "cost", "edge", "audit", "script", "text")
        .mapInArrow(_repaired, f"conv {kind}, illegal long, cost long, audit string, sha string")
    )
    present = F.when(F.col("n") > 0, F.col("turn")).cast("decimal(20,0)")
    stats = (
        counts.groupBy("conv", "turn")
        .agg(F.sum("n").alias("n"), F.sum("blank").alias("blank"))
        .groupBy("conv")
        .agg(
            F.sum("n").alias("n"),
            F.sum("blank").alias("blank"),
            F.coalesce(F.max(present) - F.min(present) + 1 - F.count(present), F.lit(0)).try_cast("long").alias("gaps"),
        )
    )
    alive = live.groupBy("conv").agg(F.count("*").alias("live"), F.sum(F.col("code") % 2).alias("truncated"))
    zero = F.lit(0).cast("long")
    return (
        stats.alias("s")
        .join(alive.alias("l"), F.col("s.conv").eqNullSafe(F.col("l.conv")), "left")
        .join(done.alias("d"), F.col("s.conv").eqNullSafe(F.col("d.conv")), "left")
        .select(
            F.col("s.conv").alias(conv),
            F.col("s.gaps").alias("gaps"),
            F.col("s.blank").alias("blank"),
            (F.col("s.n") - F.col("s.blank") - F.coalesce("l.live", zero)).alias("duplicate"),
            F.coalesce("l.truncated", zero).cast("long").alias("truncated"),
            F.coalesce("d.illegal", zero).alias("illegal"),
            F.coalesce("d.cost", zero).alias("cost"),
            F.coalesce("d.audit", F.lit("")).alias("audit"),
            F.coalesce("d.sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
        )
    )
