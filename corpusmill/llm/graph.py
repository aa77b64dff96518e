"""Connected components of a link table, by joins and sums alone."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import written


def components(edges: DataFrame, rounds=60) -> DataFrame:
    """node, label for every node of `edges` (a, b); label is the smallest node it is linked to over any path.

    Each round gives a node the smallest label among its neighbours and then the label of that label (so paths halve),
    until nothing changes. Every step is a join by node or a minimum per node, which combines before its shuffle; a hub
    is a skewed join, which Spark splits. Labels are written each round: a lost executor costs a read. Links in place
    of a chain of n nodes settle in about log n rounds; `rounds` is a guard that raises, not a cut.
    """
    both = edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near, F.col("node") == F.col("a")).select("node", F.least("label", "near").alias("low"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("next"))
        new = low.join(jump, "low").select("node", F.least("low", "next").alias("label"), "was")
        new = written(new, "labels")
        if new.where("label <> was").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
    raise RuntimeError("components did not settle")
