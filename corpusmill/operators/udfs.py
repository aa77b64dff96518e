"""The shapes in which callers bring their own functions."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.metrics import confusion


def on_column(fn, returns: str, column) -> Column:
    """`fn(Series) -> Series` over one column."""

    @F.pandas_udf(returns)
    def run(values: pd.Series) -> pd.Series:
        return fn(values)

    return run(column)


def on_rows(fn, returns: str, *columns) -> Column:
    """`fn(DataFrame) -> Series` over several columns of a batch."""

    @F.pandas_udf(returns)
    def run(rows: pd.DataFrame) -> pd.Series:
        return fn(rows)

    return run(F.struct(*columns))


def on_batches(df: DataFrame, fn, schema) -> DataFrame:
    """`fn(DataFrame) -> DataFrame` over Arrow batches; may add, drop or multiply rows."""

    def run(batches):
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def with_model(make_model, returns: str, column) -> Column:
    """`make_model()` once per task, then `model(Series) -> Series` per batch."""

    @F.pandas_udf(returns)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for values in batches:
            yield model(values)

    return run(column)


def to_rows(fn, returns: str):
    """A table function for LATERAL joins: `fn(*values)` yields the rows of one input row."""

    class Rows:
        def eval(self, *values):
            yield from fn(*values)

    return F.udtf(Rows, returnType=returns, useArrow=True)


def metric(df: DataFrame, actual: str, predicted: str, fn, schema, by=("run",)) -> DataFrame:
    """A caller's metric per group, `fn(DataFrame(by.., actual, predicted, n)) -> DataFrame`.

    The function gets confusion counts, never the predictions themselves, so a
    group's size is the number of label pairs in it. For labels that are classes.
    """
    return confusion(df, actual, predicted, by).groupBy(*by).applyInPandas(fn, schema)


def merged_metric(df: DataFrame, columns, partial, merge, finish, returns="double", by=("run",), target="value", fan_in=64) -> DataFrame:
    """A caller's metric per group over any columns, by states that merge: (by.., target).

    `partial(DataFrame of columns) -> array` gives the state of some rows of one group, `merge(state, state) -> state`
    joins two, `finish(state) -> value` ends it; states are arrays of numbers of one length, and merging must not depend on
    order. A task sends one state per group it saw; those of a group are merged `fan_in` at a time, level by level while a
    level is that wide, so a group that is in every task never has all its states in one task.
    """
    by, columns = list(by), list(columns)
    names = [f"_by{i}" for i in range(len(by))]
    keyed = df.select(*[F.col(b).alias(n) for b, n in zip(by, names)], *columns)
    keys = ", ".join(f"{n} {keyed.schema[n].dataType.simpleString()}" for n in names)

    def fold(states):
        total = None
        for state in states:
            total = np.asarray(state, float) if total is None else np.asarray(merge(total, np.asarray(state, float)), float)
        return total

    def start(batches):
        held = {}
        for pdf in batches:
            for key, part in pdf.groupby(names, dropna=False, sort=False):
                state = np.asarray(partial(part[columns].reset_index(drop=True)), float)
                key = tuple(None if pd.isna(k) else k for k in key)
                held[key] = state if key not in held else np.asarray(merge(held[key], state), float)
        yield pd.DataFrame([(*k, s) for k, s in held.items()], columns=[*names, "state"])

    def join(rows):
        first = rows.iloc[:1][names]
        return first.assign(state=[fold(rows["state"])])

    def end(rows):
        return rows.iloc[:1][names].assign(value=[finish(fold(rows["state"]))])

    states = keyed.mapInPandas(start, f"{keys}, state array<double>").withColumn("_task", F.spark_partition_id())
    wide = df.rdd.getNumPartitions()
    while wide > fan_in:
        wide = -(-wide // fan_in)
        joined = states.withColumn("_task", F.pmod("_task", F.lit(wide))).groupBy(*names, "_task")
        states = joined.applyInPandas(lambda rows: join(rows).assign(_task=rows["_task"].iloc[0]), f"{keys}, state array<double>, _task int")
    done = states.drop("_task").groupBy(*names).applyInPandas(end, f"{keys}, value {returns}")
    return done.select(*[F.col(n).alias(b) for b, n in zip(by, names)], F.col("value").alias(target))
