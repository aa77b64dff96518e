"""Agreement between an actual and a predicted column.

All metrics derive from confusion counts, so the rows are read once and only
(actual, predicted, count) leaves each task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, actual: str, predicted: str, by=(), count=None) -> DataFrame:
    """Rows per (actual, predicted); `count` names a column of rows counted before."""
    rows = F.count("*") if count is None else F.sum(count)
    return df.groupBy(
        *by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")
    ).agg(rows.alias("n"))


def binary_metrics(df: DataFrame, actual: str, predicted: str, positive=1, by=()) -> DataFrame:
    """Accuracy, and precision, recall and F1 of the positive class (0 when undefined)."""
    a, p = F.col(actual) == F.lit(positive), F.col(predicted) == F.lit(positive)
    counts = df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(F.col(actual) == F.col(predicted)).alias("hit"),
        F.count_if(a & p).alias("tp"),
        F.count_if(p).alias("positive_predicted"),
        F.count_if(a).alias("positive_actual"),
    )
    zero = F.lit(0.0)
    return counts.select(
        *by,
        F.try_divide("hit", "n").alias("accuracy"),
        F.coalesce(F.try_divide("tp", "positive_predicted"), zero).alias("precision"),
        F.coalesce(F.try_divide("tp", "positive_actual"), zero).alias("recall"),
        F.coalesce(
            F.try_divide(2 * F.col("tp"), F.col("positive_predicted") + F.col("positive_actual")),
            zero,
        ).alias("f1"),
    )


def per_class(df: DataFrame, actual: str, predicted: str, by=(), zero_division=0.0, count=None) -> DataFrame:
    """Precision, recall, F1 and support of every class seen on either side."""
    cells = confusion(df, actual, predicted, by, count)
    same = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(
            F.col("actual").alias("label"),
            F.col("n").alias("support"),
            F.lit(0).cast("long").alias("called"),
            same.cast("long").alias("tp"),
        ),
        F.struct(
            F.col("predicted").alias("label"),
            F.lit(0).cast("long").alias("support"),
            F.col("n").alias("called"),
            F.lit(0).cast("long").alias("tp"),
        ),
    )
    counts = (
        cells.select(*by, F.explode(sides).alias("c"))
        .groupBy(*by, F.col("c.label").alias("label"))
        .agg(
            F.sum("c.support").alias("support"),
            F.sum("c.called").alias("called"),
            F.sum("c.tp").alias("tp"),
        )
    )
    other = F.lit(float(zero_division))
    return counts.select(
        *by,
        "label",
        F.coalesce(F.try_divide("tp", "called"), other).alias("precision"),
        F.coalesce(F.try_divide("tp", "support"), other).alias("recall"),
        F.try_divide(2 * F.col("tp"), F.col("called") + F.col("support")).alias("f1"),
        "support",
        "tp",
    )


def weighted_metrics(df: DataFrame, actual: str, predicted: str, by=(), count=None) -> DataFrame:
    """Accuracy, and precision, recall and F1 averaged by the support of the actual class."""
    classes = per_class(df, actual, predicted, by, count=count)
    weight = lambda c: (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)
    return classes.groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        weight("precision"),
        weight("recall"),
        weight("f1"),
    )


def class_report(df: DataFrame, actual: str, predicted: str, by=(), zero_division=0.0, count=None) -> DataFrame:
    """Per-class rows, then `accuracy`, `macro avg` and `weighted avg`.

    The accuracy row carries its value in `f1`; its precision and recall are null.
    """
    classes = per_class(df, actual, predicted, by, zero_division, count)
    weight = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    nothing = F.lit(None).cast("double")
    row = lambda name, p, r, f: F.struct(
        F.lit(name).alias("label"),
        p.alias("precision"),
        r.alias("recall"),
        f.alias("f1"),
    )
    summary = (
        classes.groupBy(*by)
        .agg(
            F.sum("support").alias("support"),
            F.array(
                row("accuracy", nothing, nothing, F.sum("tp") / F.sum("support")),
                row("macro avg", F.avg("precision"), F.avg("recall"), F.avg("f1")),
                row("weighted avg", weight("precision"), weight("recall"), weight("f1")),
            ).alias("rows"),
        )
        .select(*by, "support", F.explode("rows").alias("r"))
        .select(*by, "r.*", "support")
    )
    shown = classes.withColumn("label", F.col("label").cast("string")).drop("tp")
    return shown.unionByName(summary)


def split_gap(df: DataFrame, split: str, actual: str, predicted: str, metric="f1", splits=("train", "validation", "test")) -> DataFrame:
    """One metric per split side by side, with the gaps to the training split."""
    scores = binary_metrics(df, actual, predicted, by=[split])
    wide = scores.agg(
        *[F.max(F.when(F.col(split) == s, F.col(metric))).alias(s) for s in splits]
    )
    gaps = [(F.col(splits[0]) - F.col(s)).alias(f"gap_{s}") for s in splits[1:]]
    return wide.select("*", *gaps)
