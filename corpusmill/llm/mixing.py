"""Curriculum mixing of sources by weights that change over training time.

Each source has a weight schedule: weights at times from 0 to 1, linear in between. Its integral is the source's share
of the words; the schedule scaled to the source's target is its demand for words over time. The documents of a source
stand in a fixed pseudo-random order, are read again from the start while the target asks for more, and each reading of
a document gets the time at which the demand reaches its first word: the cumulative demand, inverted. Sorting by that
time (a range sort) is the training order.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import written

#: Weights 5, 2 and 1 as areas below: one source class fades out, one stays, one fades in.
SCHEDULES = (((0.0, 6.0), (1.0, 4.0)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.0), (1.0, 2.0)))

#: Documents of one source that are put in order by one window group.
GROUP_ROWS = 2000

WORD = r"[^\x20\x09-\x0D]+"


def area(schedule) -> float:
    return sum((t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(schedule, schedule[1:]))


def time_of(schedule, share: Column) -> Column:
    """The time by which `share` (0 to 1) of the schedule's area is used."""
    total, done, branches = area(schedule), 0.0, []
    for (t0, a), (t1, b) in zip(schedule, schedule[1:]):
        part = (t1 - t0) * (a + b) / 2
        if part > 0:
            rest = F.greatest(share * total - done, F.lit(0.0))
            root = F.sqrt(F.greatest(F.lit(a * a) + rest * (2 * (b - a) / (t1 - t0)), F.lit(0.0)))
            at = F.lit(t0) + F.coalesce(2 * rest / F.nullif(root + a, F.lit(0.0)), F.lit(0.0))
            branches.append((done + part, F.least(at, F.lit(t1))))
            done += part
    out = branches[-1][1]
    for upto, at in reversed(branches[:-1]):
        out = F.when(share * total < upto, at).otherwise(out)
    return out


def source_targets(sized: DataFrame, schedules, most: float) -> DataFrame:
    """One row per source: n_rows, source_size, rank, target.

    Targets are shares of all words by weight, at most `most` times the source's size; what a full source cannot take is
    shared by the others. With sources ordered by their limit per weight, the level at which the limits of the full
    ones and the weights of the rest use up all words is a running sum. One row per source is ordered, not documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit_per_weight", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(area(s)) for s in schedules]), (F.col("rank") % len(schedules) + 1).cast("int"))
    totals = sized.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("size").alias("source_size"))
    ranked = (
        totals.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("limit", most * F.col("source_size"))
        .withColumn("limit_per_weight", F.col("limit") / F.col("weight"))
    )
    level = (
        ranked.withColumn("place", F.row_number().over(by_limit))
        .withColumn("taken_before", F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.sum("source_size").over(everything) - F.col("taken_before")) / F.col("weight_left"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("limit_per_weight"), F.struct("place", "level"))).over(everything)["level"])
    )
    return level.select("source", "n_rows", "source_size", "rank", F.least("limit", F.col("level") * F.col("weight")).alias("target"))


def curriculum(docs: DataFrame, schedules=SCHEDULES, most=3, id="doc_id", text="text", source="source", keep=()) -> DataFrame:
    """The training mix, one row per document in training order.

    Columns: `id`, size (words of the text; null text: 0), source_size, target (words for its source), taken (words of
    the document in the mix, repeats counted), copies (whole readings: one that is cut by the target counts if at least
    half of it is in), times (of each reading in the mix), position (the first of them; null and last when the mix takes
    nothing), row (a struct of the columns named in `keep`).

    A null source is a source, after the others. Documents without words take no words; they are read with their
    neighbours. The last reading of a source stops where the target is met, so taken sums to the rounded target.
    Repeated rows are documents of their own; rows alike in all respects share the same span of results. Order
    depends on id, text and size alone: reruns agree. An empty table gives an empty result. Other columns, whatever
    their names, are not read unless kept.

    Running sums are built in two steps, inside groups of about GROUP_ROWS documents and over the groups of a source,
    so that a source with most of the rows is spread like the others.
    """
    sized = docs.select(
        F.col(id).alias("id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col(id), F.lit(11), F.col(text)).alias("order"),
        (F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None)).alias("row"),
    )
    sources = written(source_targets(sized.select("source", "size"), schedules, most), "mix-sources")
    # order is a signed 64-bit number: its place between the ends of the range picks the group.
    place = F.col("order") / F.lit(2.0**64) + 0.5
    dealt = (
        sized.join(sources.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_")))
        .withColumn("group", F.floor(F.least(place, F.lit(1 - 2.0**-52)) * F.ceil(F.col("n_rows") / GROUP_ROWS)))
        .drop("source_")
    )
    narrow = dealt.groupBy("rank", "group").agg(F.sum("size").alias("group_size"))
    before = Window.partitionBy("rank").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(
        narrow.select(
            F.col("rank").alias("rank_"), F.col("group").alias("group_"), F.coalesce(F.sum("group_size").over(before), F.lit(0)).alias("group_start")
        ),
        "mix-groups",
    )
    inside = Window.partitionBy("rank", "group").orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        dealt.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, (F.col("rank") == F.col("rank_")) & (F.col("group") == F.col("group_")))
        .withColumn("start", F.col("start") + F.col("group_start"))
        .withColumn("words", F.round("target").cast("long"))
    )
    readings = F.transform(
        F.sequence(F.lit(0), F.lit(int(most) - 1)),
        lambda k: F.struct(
            (F.col("start") + k * F.col("source_size")).alias("at"),
            F.greatest(F.least(F.col("words") - (F.col("start") + k * F.col("source_size")), F.col("size")), F.lit(0)).alias("n"),
        ),
    )
    share = lambda at: at / F.col("target")

    def time(at):
        out = time_of(schedules[0], share(at))
        for k, schedule in enumerate(schedules[1:], 1):
            out = F.when(F.col("rank") % len(schedules) == k, time_of(schedule, share(at))).otherwise(out)
        return out

    read = F.filter("readings", lambda r: r["at"] < F.col("words"))
    return (
        placed.withColumn("readings", readings)
        .withColumn("taken", F.aggregate("readings", F.lit(0).cast("long"), lambda s, r: s + r["n"]))
        .withColumn("copies", F.size(F.filter(read, lambda r: 2 * r["n"] >= F.col("size"))))
        .withColumn("times", F.transform(read, lambda r: time(r["at"])))
        .select(F.col("id").alias(id), "size", "source_size", "target", "taken", "copies", "times", F.get("times", F.lit(0)).alias("position"), "order", "row")
        .orderBy(F.col("position").asc_nulls_last(), "order")
        .drop("order", *([] if keep else ["row"]))
    )


def mixed_documents(docs: DataFrame, **kw) -> DataFrame:
    """The documents of the mix with all their columns, in training order, once for each whole reading."""
    out = curriculum(docs, keep=docs.columns, **kw)
    reading = F.explode(F.slice("times", F.lit(1), F.col("copies")))
    return out.where("copies > 0").select("row", reading.alias("time")).orderBy("time").select("row.*")
