"""Shards by fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into a fixed number of slots. Only bytes and counts per slot are gathered; a small map says which
shard holds a slot. The map is a table with a version: rebalancing writes the next version, with few slots moved.
"""

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import scratch_path, written

#: Virtual slots; the map, the totals and what is broadcast have this many rows at any size of the input.
SLOTS = 4096


def slot_of(slots: int, *columns):
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


def first_map(totals: dict[int, int], shards: int, slots: int) -> list[int]:
    """Shard of each slot: the heaviest slot goes to the shard with the fewest bytes so far."""
    heap = [(0, s) for s in range(shards)]
    owner = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-totals.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        owner[slot] = shard
        heapq.heappush(heap, (load + totals.get(slot, 0), shard))
    return owner


def rebalanced(owner: list[int], totals: dict[int, int], shards: int, tolerance=0.01) -> list[int]:
    """The map for `shards` shards with few slots moved: from the fullest to the emptiest while that evens them out."""
    owner = [s if s < shards else -1 for s in owner]
    held = {s: [] for s in range(shards)}
    load = dict.fromkeys(range(shards), 0)
    for slot, s in enumerate(owner):
        if s >= 0:
            held[s].append(slot)
            load[s] += totals.get(slot, 0)
    for slot in sorted((k for k, s in enumerate(owner) if s < 0), key=lambda k: (-totals.get(k, 0), k)):
        s = min(load, key=lambda x: (load[x], x))
        owner[slot] = s
        held[s].append(slot)
        load[s] += totals.get(slot, 0)
    mean = sum(load.values()) / shards
    for _ in range(len(owner)):
        high, low = max(load, key=lambda x: (load[x], -x)), min(load, key=lambda x: (load[x], x))
        gap = load[high] - load[low]
        fit = [k for k in held[high] if 0 < totals.get(k, 0) < gap]
        if gap <= tolerance * mean or not fit:
            break
        # The slot that comes closest to half the gap, but does not overfill the emptiest shard.
        k = min(fit, key=lambda k: (abs(gap / 2 - totals[k]), k))
        held[high].remove(k)
        held[low].append(k)
        owner[k] = low
        load[high] -= totals[k]
        load[low] += totals[k]
    return owner


def sized_records(docs: DataFrame, slots: int, id: str, text: str, keep=()) -> DataFrame:
    """Records with their slots. Rows alike in id and text share a slot, but where they hold more bytes than a slot has on
    average: those few (fewer than `slots`) are spread by the number of the copy. Written, so that a copy keeps its number.
    """
    records = docs.select(
        F.col(id).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(id), F.col(text)).alias("order"),
        F.monotonically_increasing_id().alias("copy"),
        (F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("int")).alias("row"),
    )
    records = written(records, "records")
    alike = records.groupBy(F.col("order").alias("same")).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    share = records.agg(F.sum("size")).scalar() / slots
    hot = alike.where((F.col("n") > 1) & (F.col("bytes") > share)).select("same")  # fewer than `slots` rows
    spread = records.join(F.broadcast(hot), F.col("order") == F.col("same"), "left")
    vslot = F.when(F.col("same").isNull(), F.pmod("order", F.lit(slots)).cast("int")).otherwise(slot_of(slots, F.col("order"), F.col("copy")))
    return spread.withColumn("vslot", vslot).drop("copy", "same")


def slot_totals(records: DataFrame) -> DataFrame:
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))


def write_map(spark, path: str, version: int, owner: list[int], totals: dict[int, tuple[int, int]]) -> DataFrame:
    """Add a version to the map at `path`: version, vslot, shard, bytes, start (rows of the shard in earlier slots)."""
    seen: dict[int, int] = {}
    rows = []
    for slot, shard in enumerate(owner):
        size, n = totals.get(slot, (0, 0))
        rows.append((version, slot, shard, size, seen.get(shard, 0)))
        seen[shard] = seen.get(shard, 0) + n
    schema = "version int, vslot int, shard int, bytes long, start long"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return read_map(spark, path, version)


def read_map(spark, path: str, version: int | None = None) -> DataFrame:
    """One version of the map, the newest by default."""
    table = spark.read.parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == version)


def shard(docs: DataFrame, shards=16, slots=SLOTS, id="doc_id", text="text", map_path=None, keep=()) -> DataFrame:
    """Every record with its shard and its place there, by the law `bytes`: shards hold nearly equal bytes.

    Columns: `id`, size (UTF-8 bytes of the text and 1; null text: 1), text_crc32, law, vslot, shard, slot (places in
    the shard from 0 without gaps, ordered by virtual slot), grown_shard (null under this law), row (a struct of the
    columns in `keep`). An existing map at `map_path` is rebalanced for the new totals and gets a new version.

    Slots are chosen by id and text, so null or repeated ids do not meet in one slot; rows alike in id and text do, up to a
    slot's average bytes, and get different places. Ties have no effect on which places exist. An empty table gives an empty result and a map.
    Other columns are not read unless kept.
    """
    spark = docs.sparkSession
    records = sized_records(docs, slots, id, text, keep)
    totals = {r["vslot"]: (r["bytes"], r["n"]) for r in slot_totals(records.drop("row")).collect()}  # at most `slots` rows
    sizes = {k: v[0] for k, v in totals.items()}
    if map_path is None:
        map_path = scratch_path(spark, "slot-map")
        table = write_map(spark, map_path, 0, first_map(sizes, shards, slots), totals)
    else:
        old = read_map(spark, map_path).orderBy("vslot").collect()
        table = write_map(spark, map_path, old[0]["version"] + 1, rebalanced([r["shard"] for r in old], sizes, shards), totals)
    inside = Window.partitionBy("vslot").orderBy("order", "id", "size")
    return (
        records.withColumn("place", F.row_number().over(inside) - 1)
        .join(F.broadcast(table.select("vslot", "shard", "start")), "vslot")
        .select(
            F.col("id").alias(id),
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "vslot",
            "shard",
            (F.col("start") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            *(["row"] if keep else []),
        )
    )
