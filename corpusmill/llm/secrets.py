"""Secret scan with linking of credential parts, in built-in functions only.

Strong kinds are reported wherever they match. Weak parts (an identifier, a secret, an endpoint on its own look like any
other token) are reported only when the parts that complete them stand in the same scope, found by an interval join.

Positions come from the pieces between matches: the matches are set off by a mark, the text is split there, and running
lengths of the pieces give code point offsets.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The base kinds and their patterns, in the order of their listing.
BASE = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}

#: Weak parts: upper case identifiers with digits, long tokens of both cases and digits, addresses of services. None has an
#: upper length.
WEAK = {
    "identifier": r"(?<![A-Za-z0-9])(?!AKIA)(?=[A-Z]*[0-9])[A-Z0-9]{16,}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9a-z+/_-]*[A-Z])(?=[0-9A-Z+/_-]*[a-z])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/=_-])",
    "endpoint": r"""(?:https?|postgres|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D"'<>]+""",
}

#: What each kind is as a part of a credential, and what must stand near a weak one.
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "identifier": "id", "secret": "secret", "endpoint": "place"}
NEEDS = {"identifier": ("secret",), "secret": ("id",), "endpoint": ("id", "secret")}

#: Code points from the end of one part to the start of the next that belongs to it, at most.
SCOPE = 300

KINDS = [*BASE, *WEAK]
_MARK = "\u0001"


def _long_enough(kind: str, piece: Column) -> Column:
    if kind == "assign":
        return F.char_length(F.regexp_extract(piece, BASE["assign"], 2)) >= 12
    if kind == "access":
        return F.char_length(piece) >= 18
    return F.lit(True)


def _pieces(kind: str, text: Column) -> Column:
    """Lengths of what lies between and in the matches, by turns, and whether the match holds."""
    # Runs of one class: shorter ones fail, whichever way they are cut, so the length can be asked for in the pattern.
    pattern = {"hex": "[0-9a-f]{16,}"}.get(kind, {**BASE, **WEAK}[kind])
    parts = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}")), _MARK, -1)
    lengths = F.transform(
        parts,
        lambda p, i: F.struct(
            F.char_length(p).alias("n"), F.when(i % 2 == 1, _long_enough(kind, p)).otherwise(F.lit(False)).alias("hit")
        ),
    )
    return F.when(text.rlike(pattern), lengths).otherwise(F.array().cast("array<struct<n:int,hit:boolean>>"))


def spans(docs: DataFrame, id="doc_id", text="text") -> DataFrame:
    """All matches, strong and weak, one row each: key, kind, start, end (code points, end exclusive).

    `key` names the document: its id and a digest of its text. Equal rows share a key and are scanned once.
    """
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), _MARK, "\u0002")  # neither is in any pattern
    found = docs.select(row_key(id, text).alias("key"), plain.alias("text")).select(
        "key", *[_pieces(kind, F.col("text")).alias(kind) for kind in KINDS]
    )
    some = found.where(F.greatest(*[F.size(k) for k in KINDS]) > 0)
    once = some.groupBy("key").agg(F.first(F.struct(*KINDS)).alias("found")).select("key", "found.*")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("pieces")) for k in KINDS])
    pieces = once.select("key", F.explode(kinds).alias("k")).select("key", "k.kind", F.posexplode("k.pieces").alias("i", "p"))
    upto = Window.partitionBy("key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return (
        pieces.withColumn("end", F.sum("p.n").over(upto))
        .where("p.hit")
        .select("key", "kind", (F.col("end") - F.col("p.n")).alias("start"), "end")
    )


def row_key(id, text) -> Column:
    return F.concat_ws(":", F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")), F.coalesce(F.col(id).cast("string"), F.lit("-")))


def linked(parts: DataFrame, scope=SCOPE) -> DataFrame:
    """Strong spans, and the weak ones with complementary parts at most `scope` code points away, from end to start.

    The interval join is an equality join on scope-wide bins. A bin is summed up as the first and last start and the last end
    of each role, so a part meets three bins at its start and three at its end however many parts they hold. A weak part that
    overlaps a strong span is part of it and not reported again.
    """
    strong = F.col("kind").isin(*BASE)
    line = Window.partitionBy("key").orderBy("start", "end")
    covered = F.max(F.when(strong, F.col("end"))).over(line.rowsBetween(Window.unboundedPreceding, -1)) > F.col("start")
    ahead = F.min(F.when(strong, F.col("start"))).over(line.rowsBetween(1, Window.unboundedFollowing)) < F.col("end")
    clear = parts.withColumn("inside", ~strong & (F.coalesce(covered, F.lit(False)) | F.coalesce(ahead, F.lit(False))))
    role = F.lit(None)
    for kind, name in ROLE.items():
        role = F.when(F.col("kind") == kind, F.lit(name)).otherwise(role)
    bin_of = lambda c: F.floor(F.col(c) / scope)
    clear = clear.where("not inside").select(
        "key", "kind", "start", "end", role.alias("role"), bin_of("start").alias("first"), bin_of("end").alias("last")
    )
    roles = ("id", "secret")
    # Per bin and role: the first and last start in it, and the last end.
    points = clear.where(F.col("role").isin(*roles)).select(
        "key", "role", F.explode(F.array(
            F.struct(F.col("first").alias("bin"), F.col("start").alias("start"), F.lit(None).cast("long").alias("end")),
            F.struct(F.col("last").alias("bin"), F.lit(None).cast("long").alias("start"), F.col("end").cast("long").alias("end")),
        )).alias("p")
    )
    facts = {"low": ("start", F.min), "high": ("start", F.max), "end": ("end", F.max)}
    bins = points.groupBy("key", F.col("p.bin").alias("bin")).agg(
        *[f(F.when(F.col("role") == r, F.col(f"p.{c}"))).alias(f"{name}_{r}") for r in roles for name, (c, f) in facts.items()]
    )
    # Each bin speaks to itself and to its neighbours: 0 same, -1 it lies before the part's bin, 1 behind.
    sides = F.array(*[F.struct(F.lit(d).alias("side"), (F.col("bin") - d).alias("bin")) for d in (-1, 0, 1)])
    kept = [f"{name}_{r}" for r in roles for name in facts]
    near = bins.select("key", F.explode(sides).alias("b"), *kept).select("key", "b.side", "b.bin", *kept)
    at = lambda side, name, f=F.max: f(F.when(F.col("side") == side, F.col(name)))
    summary = near.groupBy("key", "bin").agg(
        *[at(-1, f"end_{r}").alias(f"end_before_{r}") for r in roles],
        *[at(0, f"end_{r}").alias(f"end_same_{r}") for r in roles],
        *[at(-1, f"high_{r}").alias(f"start_before_{r}") for r in roles],
        *[at(0, f"high_{r}").alias(f"start_same_{r}") for r in roles],
        *[at(1, f"low_{r}", F.min).alias(f"start_after_{r}") for r in roles],
    )
    head = summary.select("key", F.col("bin").alias("first"), *[f"end_{w}_{r}" for w in ("before", "same") for r in roles])
    tail = summary.select("key", F.col("bin").alias("last"), *[f"start_{w}_{r}" for w in ("before", "same", "after") for r in roles])
    # An end in the bin of the part's start, or a start in the bin of its end, is near enough or overlaps with the part.
    has = {
        r: F.col(f"end_same_{r}").isNotNull()
        | F.col(f"start_same_{r}").isNotNull()
        | F.coalesce(F.col("start") - F.col(f"end_before_{r}") <= scope, F.lit(False))
        | F.coalesce(F.col(f"start_after_{r}") - F.col("end") <= scope, F.lit(False))
        | F.coalesce(F.col(f"start_before_{r}") >= F.col("start"), F.lit(False))
        for r in roles
    }
    complete = F.lit(False)
    for kind, needs in NEEDS.items():
        both = F.lit(True)
        for r in needs:
            both = both & has[r]
        complete = F.when(F.col("kind") == kind, both).otherwise(complete)
    weak = clear.where(~strong).join(head, ["key", "first"], "left").join(tail, ["key", "last"], "left").where(complete)
    return clear.where(strong).select("key", "kind", "start", "end").unionByName(weak.select("key", "kind", "start", "end"))


def scan(docs: DataFrame, scope=SCOPE, id="doc_id", text="text") -> DataFrame:
    """One row per document: `id`, n_<kind> for every kind, base (list of strong spans), all (list of all spans).

    Spans are structs start, rank (of the kind), kind, end, in order. Null and empty texts have none. Equal rows get
    equal results. An empty table gives an empty result. Other columns are not read.
    """
    found = linked(spans(docs, id, text), scope)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "kind", "end")
    listed = found.groupBy("key").agg(F.array_sort(F.collect_list(span)).alias("all"))
    keyed = docs.select(F.col(id).alias("id"), row_key(id, text).alias("key"))
    none = F.array().cast("array<struct<start:bigint,rank:bigint,kind:string,end:bigint>>")
    return (
        keyed.join(listed, "key", "left")
        .withColumn("all", F.coalesce("all", none))
        .withColumn("base", F.filter("all", lambda s: s["rank"] <= len(BASE)))
        .select(
            F.col("id").alias(id),
            *[_count(k).alias(f"n_{k}") for k in KINDS],
            "base",
            "all",
        )
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long")


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
