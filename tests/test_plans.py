"""What the plans must look like at scale."""

import os
import re

from pyspark.sql import functions as F

from corpusmill.functions.html import nodes
from corpusmill.operators import chunks as ch
from corpusmill.operators.answers import lexicon_label
from corpusmill.operators.features import term_counts
from corpusmill.operators.vectors import hashed_embedding
from corpusmill.plans import QUERIES
from corpusmill.session import spread, table

PACKAGE = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "corpusmill")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(QUERIES["src1_parquet_scan"](spark, sf).filter(F.col("o_totalprice") > 100000))
    assert "GreaterThan(o_totalprice,100000.0)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text
    text = plan(QUERIES["flt1_time_lower_bound"](spark, sf))
    assert text.count("GreaterThanOrEqual(") >= 2


def test_deduplication_shuffles_once_and_hashes(spark, sf):
    pieces = ch.explode_chunks(table(spark, sf, "documents"), F.split("text", "\n"), "doc_id")
    text = plan(ch.first_occurrences(pieces))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in text and "Window" not in text


def test_top_k_is_limited_before_the_shuffle(spark, sf):
    text = plan(QUERIES["win1_topk_per_query"](spark, sf))
    assert re.search(r"WindowGroupLimit.*Partial", text) and "WindowGroupLimit" in text


def test_newest_rows_without_a_global_sort(spark, sf):
    text = plan(QUERIES["lim3_newest_for_labelling"](spark, sf))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_heavy_text_work_is_narrow(spark, sf):
    docs = table(spark, sf, "documents")
    for column in (
        lexicon_label(F.col("text"), ["the"], ["of"]),
        ch.sentence_chunks(F.col("text")),
        hashed_embedding(F.col("text"), 16),
        nodes("text"),
    ):
        assert "Exchange" not in plan(docs.select("doc_id", column.alias("x")))


def test_only_small_scans_are_spread(spark, sf):
    docs = table(spark, sf, "documents")
    assert "Exchange hashpartitioning(doc_id" in plan(spread(docs, "doc_id"))
    many = docs.repartition(1000)
    assert spread(many, "doc_id") is many


def test_word_counts_reuse_the_spreading(spark, sf):
    docs = spread(table(spark, sf, "documents"), "doc_id")
    assert plan(term_counts(docs, "doc_id", "text")).count("Exchange hashpartitioning") == 1


def test_no_local_checkpoints_or_machine_local_folders():
    for folder, _, files in os.walk(PACKAGE):
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    source = f.read()
                assert "localCheckpoint" not in source and "crossJoin" not in source
                assert "mkdtemp" not in source or name == "session.py"
