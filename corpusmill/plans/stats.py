"""Counts, metrics, ranks and class reports."""

from pyspark.sql import functions as F

from corpusmill.functions.arrays import argmax
from corpusmill.operators import aggregates as agg
from corpusmill.operators import metrics as met
from corpusmill.operators import ranks
from corpusmill.operators.relational import hash_split, union_all
from corpusmill.plans.registry import query
from corpusmill.plans.tables import SPLIT_SQL, shown
from corpusmill.session import spread, table

# A language rule on accented letters: wrong often enough to fill a confusion matrix.
LANG_RULE_SQL = (
    "CASE WHEN regexp_matches(text, '[ßäöü]') THEN 'de' WHEN regexp_matches(text, '[ñíó]') THEN 'es' "
    "WHEN regexp_matches(text, '[èêç]') THEN 'fr' ELSE 'en' END"
)


def lang_rule(text):
    return (
        F.when(text.rlike("[ßäöü]"), "de")
        .when(text.rlike("[ñíó]"), "es")
        .when(text.rlike("[èêç]"), "fr")
        .otherwise("en")
    )


def languages(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id").select(
        "doc_id", "lang", lang_rule(F.col("text")).alias("predicted")
    )


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- aggregations ---------------------------------------------------------


@query("agg1_label_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY 1")
def _(spark, sf):
    return agg.count_by(table(spark, sf, "events"), "event_type").orderBy("event_type")


@query(
    "agg2_rows_per_year",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1",
)
def _(spark, sf):
    return agg.count_by_year(table(spark, sf, "orders"), "o_orderdate").orderBy("year")


@query(
    "agg3_time_range",
    """SELECT strftime(least((SELECT min(o_orderdate) FROM orders), (SELECT min(ts) FROM events)), '%Y-%m-%d %H:%M:%S') AS first,
              strftime(greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(ts) FROM events)), '%Y-%m-%d %H:%M:%S') AS last""",
)
def _(spark, sf):
    both = agg.time_range(
        (table(spark, sf, "orders"), "o_orderdate"), (table(spark, sf, "events"), "ts")
    )
    return both.select(shown("first"), shown("last"))


@query(
    "agg4_majority_label",
    "SELECT quality FROM labels GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1",
)
def _(spark, sf):
    return agg.majority(table(spark, sf, "labels"), "quality")


# Class report in SQL over a relation p(<keys>, actual, predicted); {by} is `` or `key, `.
REPORT_SQL = """
    cells AS (SELECT {by}actual AS label, count(*) AS support, 0 AS called,
                     count(*) FILTER (actual = predicted) AS tp FROM p GROUP BY {by}actual
              UNION ALL
              SELECT {by}predicted, 0, count(*), 0 FROM p GROUP BY {by}predicted),
    classes AS (SELECT {by}CAST(label AS VARCHAR) AS label, CAST(sum(support) AS BIGINT) AS support,
                       sum(called) AS called, sum(tp) AS tp FROM cells GROUP BY {by}label),
    m AS (SELECT {by}label,
                 CASE WHEN called = 0 THEN {zero} ELSE tp / called END AS precision,
                 CASE WHEN support = 0 THEN {zero} ELSE tp / support END AS recall,
                 2 * tp / (called + support) AS f1, support, tp FROM classes),
    report AS (
        SELECT {by}label, precision, recall, f1, support FROM m
        UNION ALL SELECT {by}'accuracy', NULL, NULL, sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM m {group}
        UNION ALL SELECT {by}'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM m {group}
        UNION ALL SELECT {by}'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                         sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM m {group})
    SELECT {by}label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report
"""


def report_sql(by="", zero="0.0"):
    return REPORT_SQL.format(by=by, zero=zero, group=f"GROUP BY {by.rstrip(', ')}" if by else "")


QUALITY_SPLIT_SQL = (
    "CASE WHEN CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 70 THEN 'train' "
    "WHEN CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 85 THEN 'validation' ELSE 'test' END"
)


def three_way(key):
    bucket = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % 100
    return F.when(bucket < 70, "train").when(bucket < 85, "validation").otherwise("test")


@query(
    "agg5_majority_baseline",
    f"""WITH s AS (SELECT quality, {QUALITY_SPLIT_SQL} AS split FROM labels),
            top AS (SELECT quality FROM s WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
            p AS (SELECT split, quality AS actual, (SELECT quality FROM top) AS predicted
                  FROM s WHERE split <> 'train'),
            {report_sql("split, ", "1.0")}""",
)
def _(spark, sf):
    labels = table(spark, sf, "labels").withColumn("split", three_way(F.col("doc_id")))
    train = labels.filter("split = 'train'")
    rest = agg.with_majority(labels.filter("split <> 'train'"), train, "quality")
    report = met.class_report(rest, "quality", "predicted", by=["split"], zero_division=1)
    return rounded(report, "precision", "recall", "f1")


@query(
    "agg6_split_sizes",
    f"SELECT {SPLIT_SQL.format(k='doc_id')} AS split, count(*) AS n FROM documents GROUP BY 1",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select(hash_split(F.col("doc_id"), 80).alias("split"))
    return agg.count_by(docs, "split")


@query(
    "agg7_label_domain",
    """SELECT DISTINCT toxic, CASE toxic WHEN 0 THEN 'non-offensive' WHEN 1 THEN 'offensive' END AS name
       FROM labels""",
)
def _(spark, sf):
    return agg.label_domain(table(spark, sf, "labels"), "toxic", {0: "non-offensive", 1: "offensive"})


@query(
    "agg9_score_per_cost",
    f"""WITH p AS (SELECT lang, n_chars, {LANG_RULE_SQL} AS predicted FROM documents)
        SELECT lang, round(avg(CASE WHEN lang = predicted THEN 1.0 ELSE 0.0 END), 6) AS score,
               CAST(sum(n_chars) AS BIGINT) AS cost,
               round(avg(CASE WHEN lang = predicted THEN 1.0 ELSE 0.0 END) / sum(n_chars) * 1000000, 6) AS per_million
        FROM p GROUP BY lang""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select(
        "lang", "n_chars", lang_rule(F.col("text")).alias("predicted")
    )
    scores = docs.groupBy("lang").agg(
        F.avg((F.col("lang") == F.col("predicted")).cast("double")).alias("score"),
        F.sum("n_chars").alias("cost"),
    )
    ratio = agg.score_per_cost(scores, "score", "cost")
    return ratio.select(
        "lang",
        F.round("score", 6).alias("score"),
        "cost",
        F.round(F.col("ratio") * 1000000, 6).alias("per_million"),
    )


@query(
    "agg10_arm_means",
    """SELECT event_type AS source, count(*) AS n,
              round(avg(CAST(1 + user_id % 5 AS INTEGER)), 6) AS mean_accuracy,
              round(avg(CAST(1 + event_id % 5 AS INTEGER)), 6) AS mean_relevance
       FROM events GROUP BY event_type""",
)
def _(spark, sf):
    judged = table(spark, sf, "events").select(
        F.col("event_type").alias("source"),
        (F.col("user_id") % 5 + 1).alias("accuracy"),
        (F.col("event_id") % 5 + 1).alias("relevance"),
    )
    means = agg.arm_means(judged, "source", ["accuracy", "relevance"])
    return rounded(means, "mean_accuracy", "mean_relevance")


@query(
    "agg11_text_without_last_page",
    """WITH k AS (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations)
       SELECT conv_id, coalesce(string_agg(text, '' ORDER BY turn) FILTER (turn < last), '') AS page_content
       FROM k GROUP BY conv_id""",
)
def _(spark, sf):
    return agg.text_without_last_page(table(spark, sf, "conversations"), "conv_id", "turn", "text")


# --- metrics --------------------------------------------------------------

QUALITY_RULE_SQL = "CASE WHEN n_chars > 400 THEN 1 ELSE 0 END"


def quality_rule(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("n_chars") > 400, 1).otherwise(0).alias("predicted")
    )
    return table(spark, sf, "labels").join(docs, "doc_id")


BINARY_SQL = """round(avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
    round(coalesce(count(*) FILTER (actual = 1 AND predicted = 1) / nullif(count(*) FILTER (predicted = 1), 0), 0), 6) AS precision,
    round(coalesce(count(*) FILTER (actual = 1 AND predicted = 1) / nullif(count(*) FILTER (actual = 1), 0), 0), 6) AS recall,
    round(coalesce(2 * count(*) FILTER (actual = 1 AND predicted = 1)
        / nullif(count(*) FILTER (predicted = 1) + count(*) FILTER (actual = 1), 0), 0), 6) AS f1"""


@query(
    "met1_binary_metrics",
    f"""WITH p AS (SELECT quality AS actual, {QUALITY_RULE_SQL} AS predicted
                   FROM labels JOIN documents USING (doc_id))
        SELECT {BINARY_SQL} FROM p""",
)
def _(spark, sf):
    scores = met.binary_metrics(quality_rule(spark, sf), "quality", "predicted")
    return rounded(scores, "accuracy", "precision", "recall", "f1")


@query(
    "met2_weighted_metrics",
    f"""WITH p AS (SELECT lang AS actual, {LANG_RULE_SQL} AS predicted FROM documents),
        r AS (WITH {report_sql()})
        SELECT max(f1) FILTER (label = 'accuracy') AS accuracy, max(precision) FILTER (label = 'weighted avg') AS precision,
               max(recall) FILTER (label = 'weighted avg') AS recall, max(f1) FILTER (label = 'weighted avg') AS f1
        FROM r""",
)
def _(spark, sf):
    scores = met.weighted_metrics(languages(spark, sf), "lang", "predicted")
    return rounded(scores, "accuracy", "precision", "recall", "f1")


@query(
    "met3_class_report",
    f"""WITH p AS (SELECT lang AS actual, {LANG_RULE_SQL} AS predicted FROM documents), {report_sql()}""",
)
def _(spark, sf):
    report = met.class_report(languages(spark, sf), "lang", "predicted")
    return rounded(report, "precision", "recall", "f1")


@query(
    "met4_before_after_report",
    f"""WITH b AS (SELECT lang AS actual, {SPLIT_SQL.format(k="doc_id")} AS batch, {LANG_RULE_SQL} AS after FROM documents),
            p AS (SELECT batch || ' before' AS run, actual, 'en' AS predicted FROM b
                  UNION ALL SELECT batch || ' after', actual, after FROM b),
            {report_sql("run, ")}""",
)
def _(spark, sf):
    docs = languages(spark, sf).withColumn("batch", hash_split(F.col("doc_id"), 80))
    runs = F.array(
        F.struct(F.lit("before").alias("model"), F.lit("en").alias("predicted")),
        F.struct(F.lit("after").alias("model"), F.col("predicted")),
    )
    both = docs.select("batch", "lang", F.explode(runs).alias("r")).select(
        F.concat_ws(" ", "batch", "r.model").alias("run"), "lang", "r.predicted"
    )
    report = met.class_report(both, "lang", "predicted", by=["run"])
    return rounded(report, "precision", "recall", "f1")


@query(
    "met5_argmax",
    "SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS best FROM embeddings",
)
def _(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", argmax(F.col("embedding")).cast("int").alias("best")
    )


RANK_SQL = "rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2"


@query(
    "met6_spearman",
    f"""WITH r AS (SELECT {RANK_SQL.format(c="value")} AS a, {RANK_SQL.format(c="user_id")} AS b FROM events)
        SELECT count(*) AS n, round(corr(a, b), 6) AS rho FROM r""",
)
def _(spark, sf):
    return rounded(ranks.spearman(table(spark, sf, "events"), "value", "user_id"), "rho")


@query(
    "met7_split_gap",
    f"""WITH p AS (SELECT {QUALITY_SPLIT_SQL} AS split, quality AS actual, {QUALITY_RULE_SQL} AS predicted
                   FROM labels JOIN documents USING (doc_id)),
            s AS (SELECT split, {BINARY_SQL.replace("6)", "12)")} FROM p GROUP BY split),
            w AS (SELECT max(f1) FILTER (split = 'train') AS train, max(f1) FILTER (split = 'validation') AS validation,
                         max(f1) FILTER (split = 'test') AS test FROM s)
        SELECT round(train, 6) AS train, round(validation, 6) AS validation, round(test, 6) AS test,
               round(train - validation, 6) AS gap_validation, round(train - test, 6) AS gap_test FROM w""",
)
def _(spark, sf):
    rows = quality_rule(spark, sf).withColumn("split", three_way(F.col("doc_id")))
    gap = met.split_gap(rows, "split", "quality", "predicted")
    return rounded(gap, *gap.columns)


@query(
    "win2_average_rank",
    f"""SELECT DISTINCT value, count(*) OVER (PARTITION BY value) AS n,
               CAST({RANK_SQL.format(c="value")} AS DOUBLE) AS avg_rank FROM events""",
)
def _(spark, sf):
    return ranks.average_ranks(table(spark, sf, "events"), "value")


@query(
    "flagship_scored_report",
    f"""WITH p AS (SELECT lang || ' ' || quality AS actual, {LANG_RULE_SQL} || ' ' || {QUALITY_RULE_SQL} AS predicted
                   FROM documents JOIN labels USING (doc_id)), {report_sql()}""",
)
def _(spark, sf):
    # Score the text, join the labels, report agreement: one scan of each table,
    # and only confusion counts are shuffled after the join.
    scored = spread(table(spark, sf, "documents"), "doc_id").select(
        "doc_id",
        "lang",
        F.concat_ws(
            " ", lang_rule(F.col("text")), F.when(F.col("n_chars") > 400, 1).otherwise(0)
        ).alias("predicted"),
    )
    rows = scored.join(table(spark, sf, "labels"), "doc_id").withColumn(
        "actual", F.concat_ws(" ", "lang", "quality")
    )
    return rounded(met.class_report(rows, "actual", "predicted"), "precision", "recall", "f1")


@query(
    "agg1_label_counts_of_union",
    """SELECT label, count(*) AS n FROM (SELECT o_orderstatus AS label FROM orders
       UNION ALL SELECT event_type FROM events) GROUP BY label""",
)
def _(spark, sf):
    both = union_all(
        table(spark, sf, "orders").select(F.col("o_orderstatus").alias("label")),
        table(spark, sf, "events").select(F.col("event_type").alias("label")),
    )
    return agg.count_by(both, "label")
