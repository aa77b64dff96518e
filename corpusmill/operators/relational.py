"""Joins, unions, sorts, limits and exact splits of tables."""

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.session import written


# --- joins ----------------------------------------------------------------


def inner_join(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Comments with their post; rows without a partner on either side are dropped.

    A key that holds a large share of `many` makes one oversized shuffle
    partition, which adaptive execution splits (spark.sql.adaptive.skewJoin).
    """
    return many.join(one, key, "inner")


def heavy_join(many: DataFrame, one: DataFrame, key: str, weight: str, share=None) -> DataFrame:
    """Inner join of `many` with the unique-key table `one` that survives hot keys.

    `one` counts, in `weight`, the rows each key has in `many`. Keys that hold at
    least `share` of all rows (by default what one shuffle partition holds on average)
    number at most 1/share, so they are broadcast; all
    other keys are joined by shuffle, where none can dominate a partition.
    """
    share = share or 1 / int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = one.agg(F.sum(weight)).scalar()
    hot = one.filter(F.col(weight) >= F.lit(share) * total)
    cold = one.filter(F.col(weight) < F.lit(share) * total)
    by_broadcast = many.join(F.broadcast(hot), key, "inner")
    rest = many.join(F.broadcast(hot.select(key)), key, "left_anti")
    return by_broadcast.unionByName(rest.join(cold, key, "inner"))


def complement(df: DataFrame, part: DataFrame, key) -> DataFrame:
    """Rows of `df` whose key is not in `part`."""
    return df.join(part, key, "left_anti")


def lookup(df: DataFrame, names: dict, column: str, target: str) -> DataFrame:
    """Map a label to its id; a label without an id fails the job.

    The dictionary is a literal map in the plan, for label sets (a few entries).
    """
    pairs = [F.lit(x) for item in names.items() for x in item]
    found = F.create_map(*pairs)[F.col(column)]
    failure = F.raise_error(F.concat(F.lit("unknown label: "), F.col(column)))
    return df.withColumn(target, F.coalesce(found, failure.cast("int")))


def with_arms(df: DataFrame, arms: list[tuple]) -> DataFrame:
    """Every row once per system arm `(arm, model, retrieval)`."""
    entries = [
        F.struct(F.lit(a).alias("arm"), F.lit(m).alias("model"), F.lit(r).alias("retrieval"))
        for a, m, r in arms
    ]
    return df.withColumn("_arm", F.explode(F.array(*entries))).select("*", "_arm.*").drop("_arm")


def new_links(links: DataFrame, *seen: DataFrame) -> DataFrame:
    """Distinct links that are in none of the seen tables (one column each, same name)."""
    column = links.columns[0]
    fresh = links.distinct()
    for table in seen:
        fresh = fresh.join(table.select(column), column, "left_anti")
    return fresh


# --- unions and sorts -----------------------------------------------------


def union_all(*tables: DataFrame) -> DataFrame:
    """Append tables with duplicates kept; a column one of them lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def newest_first(df: DataFrame, time: str, key: str) -> DataFrame:
    return df.orderBy(F.desc(time), F.asc(key))


# --- exact positions without a global sort --------------------------------

BINS = 4096
SMALL = 10_000


def _as_long(df: DataFrame, name: str) -> Column:
    kind, c = dict(df.dtypes)[name], F.col(name)
    if kind == "timestamp_ntz":
        # From its fields, as a cast would pass through the session's zone.
        micros = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
        return F.unix_date(c.cast("date")).cast("long") * 86_400_000_000 + (F.hour(c) * 60 + F.minute(c)) * F.lit(60_000_000).cast("long") + micros
    if kind == "timestamp":
        return F.unix_micros(c)
    return c.cast("long")


def _order(df: DataFrame, keys: list[str], with_nulls: set) -> dict[str, Column]:
    """Keys that are longs as integers that are never null: one that holds nulls becomes (0 or 1, value), nulls first."""
    out = {}
    for k in keys:
        value = F.col(k)
        if k in with_nulls:
            out[f"{k}_known"] = value.isNotNull().cast("long")
            value = F.coalesce(value, F.lit(0).cast("long"))
        out[k] = value
    return out


def rank_cutoff(df: DataFrame, order: dict[str, Column], n: int):
    """The key tuple of row `n` (from 1) in ascending order of the named keys.

    Counts rows in at most BINS equal-width bins of the current key, narrows to
    the bin that holds row `n` and repeats, so no pass moves or sorts rows; only
    bin counts reach the driver. Once few rows are left they are sorted. Keys
    must be non-null integers and unique as a tuple.
    """
    keys = list(order)
    scope = df.select(*[c.alias(k) for k, c in order.items()])
    for key in keys:
        low, high, rows = scope.agg(F.min(key), F.max(key), F.count("*")).first()
        while rows > SMALL and low < high:
            width = (high - low) // BINS + 1
            bins = (
                scope.groupBy(F.expr(f"(`{key}` - {low}L) div {width}L").alias("bin"))
                .count()
                .orderBy("bin")
                .collect()
            )
            for row in bins:
                if n <= row["count"]:
                    break
                n -= row["count"]
            rows = row["count"]
            low = low + row["bin"] * width
            high = min(high, low + width - 1)
            scope = scope.filter(F.col(key).between(low, high))
        if rows <= SMALL:
            top = scope.orderBy(*keys).limit(n + 1).collect()  # at most SMALL + 1 keys
            if len(top) == n or top[n] != top[n - 1]:
                return tuple(top[n - 1])
            break
    raise ValueError(f"rows share all of {keys}; add a unique key")


def _edge(kind: str, micros_or_number: int) -> Column:
    """A key's integer as a literal of the key's own type, which a filter can push into the scan."""
    if kind == "timestamp_ntz":
        moment = datetime(1970, 1, 1) + timedelta(microseconds=micros_or_number)
        return F.expr(f"TIMESTAMP_NTZ'{moment.isoformat(sep=' ')}'")
    if kind == "timestamp":
        return F.timestamp_micros(F.lit(micros_or_number))
    return F.lit(micros_or_number)


def position_split(df: DataFrame, keys: list[str], n: int):
    """(first n rows, all others) in the total order of `keys`; a null comes before all values.

    Keys are integers or timestamps. Every row is in exactly one of the parts. Rows that
    share all keys are refused if the cut falls between them. The rows are computed once for their keys, which are
    written as longs and searched for the cut; the parts compare the keys as they are with literals of their types.
    """
    if n <= 0:
        return df.limit(0), df
    narrow = written(df.select(*[_as_long(df, k).alias(k) for k in keys]), "keys")
    known = narrow.agg(F.count("*").alias("_rows"), *[F.count(k).alias(k) for k in keys]).first()
    if n >= known["_rows"]:
        return df, df.limit(0)
    with_nulls = {k for k in keys if known[k] < known["_rows"]}
    order = _order(narrow, keys, with_nulls)
    at = dict(zip(order, rank_cutoff(narrow, order, n)))
    kinds, first = dict(df.dtypes), F.lit(True)
    for k in reversed(keys):
        column, null = F.col(k), not at.get(f"{k}_known", 1)
        edge = _edge(kinds[k], at[k])
        equal = column.isNull() if null else F.coalesce(column == edge, F.lit(False))
        less = F.lit(False) if null else (column.isNull() | (column < edge) if k in with_nulls else column < edge)
        first = less | (equal & first)
    # The leading key alone, as a plain comparison that reaches the scan.
    lead, edge = F.col(keys[0]), _edge(kinds[keys[0]], at[keys[0]])
    low, high = lead <= edge, lead >= edge
    if keys[0] in with_nulls:
        low, high = (low | lead.isNull(), high) if at[f"{keys[0]}_known"] else (lead.isNull(), F.lit(True))
    return df.filter(low & first), df.filter(high & ~first)


def newest(df: DataFrame, time: str, key: str, n: int) -> DataFrame:
    """The n most recent rows, for an n that one person can label."""
    return df.orderBy(F.desc(time), F.asc(key)).limit(n)


def _draw(seed, key: str, start: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), start, 15), 16, 10).cast("long")


def sample_split(df: DataFrame, key: str, fraction: float, seed=42):
    """(sample, rest): exactly round(fraction * rows) rows, drawn by a seeded hash of the key."""
    n = round(df.count() * fraction)
    drawn = df.withColumn("_draw1", _draw(seed, key, 1)).withColumn("_draw2", _draw(seed, key, 16))
    first, rest = position_split(drawn, ["_draw1", "_draw2"], n)
    return first.drop("_draw1", "_draw2"), rest.drop("_draw1", "_draw2")


def hash_split(key: Column, percent: int) -> Column:
    """`train` or `test` from the key alone; about `percent` go to train. For streams."""
    bucket = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % 100
    return F.when(bucket < percent, "train").otherwise("test")
