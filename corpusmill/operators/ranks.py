"""Average ranks and Spearman correlation without a global sort in one task."""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import written

# Distinct values of one range, about; a range is one task of a window.
RANGE_ROWS = 50_000


def average_ranks(df: DataFrame, value: str, by=()) -> DataFrame:
    """(by.., value, n, avg_rank): one row per distinct value, ties share their mean rank. Nulls have no rank.

    Ties collapse in the partial aggregate. The distinct values are range-sorted,
    numbered inside each range, and shifted by the number of rows in the ranges
    before it. Ranges grow in number with the distinct values, so none outgrows a
    task. `by` names groups that are ranked apart; a group of any size is spread like the rest.
    """
    rows = df.filter(F.col(value).isNotNull())
    return _ranked(rows.groupBy(*by, F.col(value).cast("double").alias(value)).agg(F.count("*").alias("n")), value, by)


def _ranked(counts: DataFrame, value: str, by=()) -> DataFrame:
    counts = written(counts, "counts")
    ranges = max(1, math.ceil(counts.count() / RANGE_ROWS))
    ranged = counts.repartitionByRange(ranges, *by, value).withColumn("_range", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    # One row per range and group in it.
    sizes = ranged.groupBy("_range", *by).agg(F.sum("n").alias("_rows"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift")
    shifts = sizes.select(F.col("_range").alias("_of"), *[F.col(b).alias(f"_of_{b}") for b in by], shift)
    inside = Window.partitionBy("_range", *by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    numbered = ranged.withColumn("_upto", F.sum("n").over(inside))
    same = F.col("_range") == F.col("_of")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_of_{b}"))
    rank = F.col("_shift") + F.col("_upto") - (F.col("n") - 1) / 2
    return numbered.join(shifts, same).select(*by, value, "n", rank.alias("avg_rank"))


def spearman(df: DataFrame, left: str, right: str, by=()) -> DataFrame:
    """(by.., n, rho): Spearman correlation of two columns and the number of pairs, one row per group (without `by`: one).

    Works on distinct pairs with counts. Ranks are centred on their known mean,
    so the sums stay small and the result does not lose digits on large inputs.
    """
    by = list(by)
    both = df.select(*by, F.col(left).cast("double").alias("x"), F.col(right).cast("double").alias("y"))
    both = both.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    # Everything below reads the distinct pairs, so they are computed once.
    pairs = written(both.groupBy(*by, "x", "y").agg(F.count("*").alias("w")), "pairs")

    def joined(rows, other, *keys):
        named = other.select(*[F.col(k).alias(f"_of_{k}") if k in (*by, *keys) else F.col(k) for k in other.columns])
        same = F.lit(True)
        for k in by:
            same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
        for k in keys:
            same = same & (F.col(k) == F.col(f"_of_{k}"))
        return rows.join(named, same).drop(*[f"_of_{k}" for k in (*by, *keys)])

    def ranks_of(c):
        counts = pairs.groupBy(*by, c).agg(F.sum("w").alias("n"))
        return _ranked(counts, c, by).select(*by, c, F.col("avg_rank").alias(f"r{c}"))

    ranked = joined(joined(pairs, ranks_of("x"), "x"), ranks_of("y"), "y")
    # One row per group.
    middles = pairs.groupBy(*by).agg(((F.sum("w") + 1) / 2).alias("middle"))
    placed = joined(ranked, middles) if by else ranked.withColumn("middle", middles.scalar())
    centred = placed.select(
        *by, "w", (F.col("rx") - F.col("middle")).alias("a"), (F.col("ry") - F.col("middle")).alias("b")
    )
    sums = centred.groupBy(*by).agg(
        F.coalesce(F.sum("w"), F.lit(0)).alias("n"),
        F.sum(F.col("w") * F.col("a") * F.col("b")).alias("ab"),
        F.sum(F.col("w") * F.col("a") * F.col("a")).alias("aa"),
        F.sum(F.col("w") * F.col("b") * F.col("b")).alias("bb"),
    )
    return sums.select(*by, "n", F.try_divide("ab", F.sqrt(F.col("aa") * F.col("bb"))).alias("rho"))


def agreement(df: DataFrame, criteria: dict[str, tuple[str, str]]) -> DataFrame:
    """(criterion, n, rho): Spearman correlation of several column pairs in one pass over the rows.

    `criteria` maps a name to two columns; rows that lack one of a pair are left out of that criterion only.
    """
    grades = [
        F.struct(F.lit(name).alias("criterion"), F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
        for name, (a, b) in criteria.items()
    ]
    return spearman(df.select(F.inline(F.array(*grades))), "a", "b", by=["criterion"])
