"""Counts, time ranges, majority labels and ordered concatenation."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def count_by_year(df: DataFrame, time: str) -> DataFrame:
    return df.groupBy(F.year(time).alias("year")).agg(F.count("*").alias("n"))


def time_range(*columns: tuple) -> DataFrame:
    """Earliest and latest time over several (table, column) pairs.

    Each table is reduced to one row before the union.
    """
    parts = [df.agg(F.min(c).alias("first"), F.max(c).alias("last")) for df, c in columns]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both.agg(F.min("first").alias("first"), F.max("last").alias("last"))


def majority(df: DataFrame, label: str) -> DataFrame:
    """One row: the most frequent label, the lowest one on a tie."""
    return count_by(df, label).orderBy(F.desc("n"), F.asc(label)).limit(1).select(label)


def with_majority(df: DataFrame, train: DataFrame, label: str, target="predicted") -> DataFrame:
    """The majority-class baseline: the majority label of `train` on every row."""
    return df.withColumn(target, majority(train, label).scalar())


def label_domain(df: DataFrame, label: str, names: dict) -> DataFrame:
    """The labels that occur, with their names."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return df.select(label).distinct().withColumn("name", F.create_map(*pairs)[F.col(label)])


def score_per_cost(df: DataFrame, score: str, cost: str, target="ratio") -> DataFrame:
    return df.withColumn(target, F.try_divide(score, cost))


def arm_means(df: DataFrame, source: str, scores: list[str]) -> DataFrame:
    """Mean of every judge score per arm, with the number of answers."""
    means = [F.avg(s).alias(f"mean_{s}") for s in scores]
    return df.groupBy(source).agg(F.count("*").alias("n"), *means)


def _concat_sorted(df: DataFrame, keys, order: str, text: str, separator: str, target: str) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text))))
    joined = F.array_join(F.transform(parts, lambda x: x[text]), separator)
    return df.groupBy(*keys).agg(joined.alias(target))


def joined_texts(df: DataFrame, key: str, rank: str, text: str, separator="\n\n", target="context") -> DataFrame:
    """One text per key, its few parts (retrieved texts, say) joined in order of rank."""
    return _concat_sorted(df, [key], rank, text, separator, target)


PART_BLOCK = 1000


def joined_long_texts(df: DataFrame, key: str, order: str, text: str, separator="", target="page_content") -> DataFrame:
    """Like `joined_texts` for keys with very many parts, numbered by an integer.

    Runs of part numbers are joined first, so the parts of one huge document are
    sorted and joined by many tasks; the last step only joins finished runs. The
    result is one cell per key, which Spark bounds at 2 GB.
    """
    runs = df.withColumn("_run", F.floor(F.col(order) / PART_BLOCK))
    blocks = _concat_sorted(runs, [key, "_run"], order, text, separator, "_text")
    return _concat_sorted(blocks, [key], "_run", "_text", separator, target)


def without_last_page(df: DataFrame, document: str, page: str) -> DataFrame:
    """Page rows without the last page of each document.

    Last pages come from a partial aggregate, one row per document, so the join
    never gathers a document's pages in one task.
    """
    last = df.groupBy(document).agg(F.max(page).alias(page))
    return df.join(last, [document, page], "left_anti")


def text_without_last_page(df: DataFrame, document: str, page: str, text: str) -> DataFrame:
    """Pages of a document joined in page order, the last page left out."""
    kept = without_last_page(df, document, page)
    texts = joined_long_texts(kept, document, page, text)
    # A document of one page keeps its row, with an empty text.
    whole = df.select(document).distinct().join(texts, document, "left")
    return whole.select(document, F.coalesce("page_content", F.lit("")).alias("page_content"))


def last_message(df: DataFrame, conversation: str, turn: str, text: str) -> DataFrame:
    """The text of the last turn of every conversation."""
    return df.groupBy(conversation).agg(F.max_by(text, turn).alias("last_text"))


TURN_BLOCK = 1000


def answer_pairs(df: DataFrame) -> DataFrame:
    """(conv_id, turn, question, answer): a user turn followed by an assistant turn.

    The next turn is looked up inside blocks of turn numbers, and for the last
    row of a block at the head of the next block, so that one very long
    conversation is spread over many tasks.
    """
    turns = df.select(
        "conv_id",
        F.floor(F.col("turn") / TURN_BLOCK).alias("block"),
        "turn",
        "role",
        F.struct("role", "text").alias("said"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn")
    blocks = Window.partitionBy("conv_id").orderBy("block")
    placed = turns.withColumn("next", F.lead("said").over(inside))
    heads = (
        turns.withColumn("place", F.row_number().over(inside))
        .filter("place = 1")
        .select("conv_id", "block", F.lead("said").over(blocks).alias("after"))
    )
    following = placed.join(heads, ["conv_id", "block"]).withColumn(
        "next", F.coalesce("next", "after")
    )
    return following.filter("role = 'user' AND next.role = 'assistant'").select(
        "conv_id", "turn", F.col("said.text").alias("question"), F.col("next.text").alias("answer")
    )
