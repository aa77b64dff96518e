"""Embeddings, nearest neighbours, prompts, answers, judging and streaming."""

import pandas as pd
from pyspark.sql import functions as F

from corpusmill.functions import prompts, text
from corpusmill.operators import aggregates as agg
from corpusmill.operators import answers as ans
from corpusmill.operators import ranks, udfs
from corpusmill.operators import vectors as vec
from corpusmill.operators.chunks import chunk_id
from corpusmill.operators.relational import hash_split, sample_split, with_arms
from corpusmill.plans.chunking import SENTENCES_SQL, WINDOWS_SQL, docs, windows
from corpusmill.plans.registry import query
from corpusmill.plans.stats import LANG_RULE_SQL, RANK_SQL, lang_rule, report_sql, rounded
from corpusmill.plans.tables import ARMS, ARMS_SQL, SPLIT_SQL
from corpusmill.plans.texts import GUIDE_SQL, JUDGE_SQL, READER_SQL, WORD_SQL, judge_text, score_sql
from corpusmill.session import scratch_path, table
from corpusmill.sources import readers, writers
from corpusmill.streaming import batches

C = F.col

# --- vectors --------------------------------------------------------------


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(C("vec_id").alias("id"), C("embedding").alias("vector"))


def vector_queries(spark, sf):
    return vectors(spark, sf).withColumnRenamed("id", "query_id")


PAIRS_SQL = """WITH e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    p AS (SELECT q.id AS query_id, c.id, round({score}, 6) AS score FROM e q, e c),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, id) AS rank FROM p)
    SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= {k}"""
COSINE_SQL = PAIRS_SQL.format(score="list_cosine_similarity(q.v, c.v)", order="DESC", k=5)
L2_SQL = PAIRS_SQL.format(score="pow(list_distance(q.v, c.v), 2)", order="ASC", k=3)


@query("vec2_cosine_topk", COSINE_SQL)
def _(spark, sf):
    return vec.nearest(vectors(spark, sf), vector_queries(spark, sf), k=5)


@query("vec2_l2_topk", L2_SQL)
def _(spark, sf):
    return vec.nearest(vectors(spark, sf), vector_queries(spark, sf), k=3, metric="l2")


@query("vec2_cosine_topk_tiled", COSINE_SQL)
def _(spark, sf):
    # The plan for query sets too large to broadcast.
    return vec.nearest(vectors(spark, sf), vector_queries(spark, sf), k=5, broadcast_bytes=1 << 17)


@query("vec3_cosine_topk_pruned", COSINE_SQL)
def _(spark, sf):
    # Vectors without clusters: the bounds save too little, and the search is a full one.
    index = vec.cell_index(vectors(spark, sf))
    return vec.nearest_pruned(index, vector_queries(spark, sf), k=5)


@query("vec3_l2_topk_pruned", L2_SQL)
def _(spark, sf):
    index = vec.cell_index(vectors(spark, sf), metric="l2")
    return vec.nearest_pruned(index, vector_queries(spark, sf), k=3, metric="l2")


# Orders as points: price, day and customer. The bounds leave a few cells per query.
POINTS_SQL = """WITH e AS (SELECT o_orderkey AS id, [o_totalprice / 5000, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) / 25, o_custkey / 1000] AS v FROM orders),
    p AS (SELECT q.id AS query_id, c.id, round(pow(list_distance(q.v, c.v), 2), 6) AS score FROM e q, e c WHERE q.id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, id) AS rank FROM p)
    SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5"""


def points(spark, sf):
    day = F.date_diff(C("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    place = F.array(C("o_totalprice") / 5000, day / F.lit(25.0), C("o_custkey") / F.lit(1000.0))
    return table(spark, sf, "orders").select(C("o_orderkey").alias("id"), place.alias("vector"))


def twentieth(rows):
    """Every row whose id is divisible by 20 asks; all rows answer."""
    return rows.filter(C("id") % 20 == 0).withColumnRenamed("id", "query_id")


@query("vec3_l2_topk_in_cells", POINTS_SQL)
def _(spark, sf):
    rows = points(spark, sf)
    return vec.nearest_pruned(vec.cell_index(rows, metric="l2"), twentieth(rows), k=5, metric="l2")


@query("vec3_l2_topk_dealt_to_cells", POINTS_SQL)
def _(spark, sf):
    # The plan for query sets too large to broadcast.
    rows = points(spark, sf)
    return vec.nearest_pruned(vec.cell_index(rows, metric="l2"), twentieth(rows), k=5, metric="l2", broadcast_bytes=0)


@query(
    "vec3_text_ids",
    COSINE_SQL.replace("SELECT query_id, id, score", "SELECT 'v' || query_id AS query_id, 'v' || id AS id, score").replace(
        "score DESC, id)", "score DESC, 'v' || id)"
    ),
)
def _(spark, sf):
    named = vectors(spark, sf).withColumn("id", F.concat(F.lit("v"), C("id").cast("string")))
    return vec.nearest_pruned(vec.cell_index(named), named.withColumnRenamed("id", "query_id"), k=5)


@query("win1_topk_per_query", PAIRS_SQL.format(score="list_cosine_similarity(q.v, c.v)", order="DESC", k=3))
def _(spark, sf):
    # Tasks keep the best of their pairs; the limit on the rank is a partial top-k again before the shuffle.
    return vec.nearest(vectors(spark, sf), vector_queries(spark, sf), k=3)


WIDTH = 64


def embed_sql(source, keep, c):
    """Rows of `source` with the columns `keep` and `v`, the word counts per bucket."""
    ids = (
        f"list_transform(regexp_extract_all(lower({c}), '{WORD_SQL}'), "
        "lambda w: CAST('0x' || substr(md5(w), 1, 7) AS BIGINT) % 64 + 1)"
    )
    return (
        f"SELECT {keep}, list_transform(range(1, 65), lambda b: CAST(coalesce(h[b], 0) AS DOUBLE)) AS v "
        f"FROM (SELECT {keep}, list_aggregate({ids}, 'histogram') AS h FROM {source})"
    )


@query(
    "vec1_hashed_embedding",
    f"""SELECT doc_id, array_to_string(list_transform(v, lambda x: CAST(CAST(x AS INTEGER) AS VARCHAR)), ',') AS embedding
        FROM ({embed_sql("documents", "doc_id", "text")})""",
)
def _(spark, sf):
    embedded = docs(spark, sf).select(
        "doc_id", vec.hashed_embedding(C("text"), WIDTH).alias("e")
    )
    shown = F.array_join(F.transform("e", lambda x: x.cast("int").cast("string")), ",")
    return embedded.select("doc_id", shown.alias("embedding"))


@query("vec1_model_embedding", "SELECT doc_id, CAST(length(text) AS DOUBLE) AS a, 2 * CAST(length(text) AS DOUBLE) AS b FROM documents")
def _(spark, sf):
    def load():
        return lambda texts: [(len(t), 2 * len(t)) for t in texts]

    embedded = vec.embed(table(spark, sf, "documents"), "text", load)
    part = lambda i, name: F.get("embedding", i).cast("double").alias(name)
    return embedded.select("doc_id", part(0, "a"), part(1, "b"))


# --- retrieval answers ----------------------------------------------------


def chunks(spark, sf):
    """The vector table of the documents: embedded once, then read by search and answers."""
    embedded = windows(spark, sf).select(
        chunk_id(C("doc_id"), C("chunk_index")).alias("id"),
        vec.hashed_embedding(C("chunk"), WIDTH).alias("vector"),
        C("chunk").alias("page_content"),
    )
    path = scratch_path(spark, "vectors")
    writers.write_vectors(embedded, path)
    return writers.read_vectors(spark, path)


def questions(spark, sf):
    asked = table(spark, sf, "conversations").filter("role = 'user'")
    return asked.select(
        chunk_id(C("conv_id"), C("turn")).alias("query_id"),
        C("text").alias("question"),
        vec.hashed_embedding(C("text"), WIDTH).alias("vector"),
    )


RETRIEVE_SQL = f"""w AS ({WINDOWS_SQL}),
    c AS MATERIALIZED (SELECT doc_id * 16777216 + chunk_index AS id, chunk, v FROM ({embed_sql("w", "doc_id, chunk_index, chunk", "chunk")})),
    q AS MATERIALIZED (SELECT CAST(conv_id AS BIGINT) * 16777216 + turn AS query_id, text AS question, v
          FROM ({embed_sql("conversations WHERE role = 'user'", "conv_id, turn, text", "text")})),
    p AS (SELECT query_id, id, coalesce(round(list_cosine_similarity(q.v, c.v), 6), 0) AS score FROM q, c),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN isnan(score) THEN 0 ELSE score END DESC, id) AS rank FROM p),
    top AS (SELECT query_id, string_agg(chunk, chr(10) || chr(10) ORDER BY rank) AS context
            FROM r JOIN c USING (id) WHERE rank <= 3 GROUP BY query_id),
    a AS (SELECT query_id, question, context FROM q LEFT JOIN top USING (query_id))"""
PLAIN_SQL = (
    "{context}'Question: ' || question || chr(10) || '" + GUIDE_SQL + "' || ' Answer:'"
)
CONTEXT_SQL = "'Context: ' || context || chr(10) || "


@query(
    "rag1_retrieve_and_prompt",
    f"""WITH {RETRIEVE_SQL} SELECT query_id, question, context, {PLAIN_SQL.format(context=CONTEXT_SQL)} AS prompt FROM a""",
)
def _(spark, sf):
    return ans.retrieval_prompts(questions(spark, sf), chunks(spark, sf), k=3).drop("contexts")


def best_sentence_sql(question, context):
    """The sentence that shares most words with the question, the first one on a tie."""
    words = "regexp_extract_all(lower({c}), '" + WORD_SQL + "')"
    hits = f"len(list_intersect({words.replace('{c}', question)}, {words.replace('{c}', 's')}))"
    parts = SENTENCES_SQL.replace("{c}", context)
    return f"list_sort(list_transform({parts}, lambda s, i: {{'h': -{hits}, 'i': i, 's': s}}))[1].s"


@query(
    "rag2_answer_questions",
    f"""WITH {RETRIEVE_SQL} SELECT query_id, question, context, {best_sentence_sql("question", "context")} AS answer FROM a""",
)
def _(spark, sf):
    asked = ans.retrieval_prompts(questions(spark, sf), chunks(spark, sf), k=3)
    answered = asked.withColumn("answer", ans.best_sentence(C("question"), C("context")))
    return answered.select("query_id", "question", "context", "answer")


@query(
    "rag3_arm_prompts",
    f"""WITH {RETRIEVE_SQL} SELECT query_id, arm, model,
          CASE WHEN retrieval THEN {PLAIN_SQL.format(context=CONTEXT_SQL)} ELSE {PLAIN_SQL.format(context="")} END AS prompt
        FROM a, {ARMS_SQL.replace(") a(", ") arms(")}""",
)
def _(spark, sf):
    asked = ans.retrieval_prompts(questions(spark, sf), chunks(spark, sf), k=3).drop("prompt")
    return ans.arm_prompts(asked, ARMS).select("query_id", "arm", "model", "prompt")


def echo(asked):
    """A model that repeats its prompt before it answers with the prompt's length."""
    return asked + " Answer: " + asked.str.len().astype(str) + " characters "


@query(
    "rag2_model_answers",
    f"""WITH {RETRIEVE_SQL} SELECT query_id, question, context, length({PLAIN_SQL.format(context=CONTEXT_SQL)}) || ' characters' AS answer FROM a""",
)
def _(spark, sf):
    asked = ans.retrieval_prompts(questions(spark, sf), chunks(spark, sf), k=3)
    answered = ans.generate(asked, "prompt", echo)
    return answered.select("query_id", "question", "context", text.after_last(C("answer"), "Answer:").alias("answer"))


@query(
    "rag3_answers_by_arm",
    f"""WITH {RETRIEVE_SQL.replace("ORDER BY rank) AS context", "ORDER BY rank) AS context, count(*) AS n")
            .replace("SELECT query_id, question, context FROM q", "SELECT query_id, question, context, n FROM q")}
        SELECT question AS query, CAST(CASE WHEN retrieval THEN n ELSE 0 END AS INTEGER) AS contexts, arm AS source,
          length(CASE WHEN retrieval THEN {PLAIN_SQL.format(context=CONTEXT_SQL)} ELSE {PLAIN_SQL.format(context="")} END) || ' characters' AS answer
        FROM a, {ARMS_SQL.replace(") a(", ") arms(")}""",
)
def _(spark, sf):
    asked = ans.retrieval_prompts(questions(spark, sf), chunks(spark, sf), k=3).drop("prompt")
    path = scratch_path(spark, "answers")
    ans.write_answers(ans.arm_prompts(asked, ARMS), echo, path)
    back = readers.read_results(spark, path, "query string, contexts string, answer string")
    count = F.size(F.from_json("contexts", "array<string>")).alias("contexts")
    return back.select("query", count, "answer", "source")


@query(
    "jn6_similar_vectors",
    """WITH e AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
       p AS (SELECT q.id AS query_id, q.label, c.id, c.label AS found, round(list_cosine_similarity(q.v, c.v), 6) AS score FROM e q, e c),
       r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM p)
       SELECT label, count(*) AS n, CAST(sum(CASE WHEN label = found THEN 1 ELSE 0 END) AS BIGINT) AS same_label
       FROM r WHERE rank <= 3 GROUP BY label""",
)
def _(spark, sf):
    found = vec.nearest(vectors(spark, sf), vector_queries(spark, sf), k=3)
    labels = table(spark, sf, "embeddings").select("vec_id", "label")
    named = found.join(labels.withColumnsRenamed({"vec_id": "query_id"}), "query_id").join(
        labels.withColumnsRenamed({"vec_id": "id", "label": "found"}), "id"
    )
    return named.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(C("label") == C("found")).alias("same_label")
    )


# --- lists of retrieved texts ---------------------------------------------

# The three nearest vectors of every vector, described in words; a list of them
# has at most three entries.
NEAR_SQL = f"""n AS ({COSINE_SQL.replace("rank <= 5", "rank <= 3")}),
    t AS (SELECT query_id, rank, 'vector ' || id || ' of class ' || label AS page_content
          FROM n JOIN embeddings ON vec_id = id)"""


def near_texts(spark, sf):
    found = vec.nearest(vectors(spark, sf), vector_queries(spark, sf), k=3)
    labels = table(spark, sf, "embeddings").select(C("vec_id").alias("id"), "label")
    described = F.concat(
        F.lit("vector "), C("id").cast("string"), F.lit(" of class "), C("label").cast("string")
    )
    return found.join(labels, "id").select("query_id", "rank", described.alias("page_content"))


@query(
    "agg8_joined_contexts",
    f"""WITH {NEAR_SQL} SELECT query_id, string_agg(page_content, chr(10) || chr(10) ORDER BY rank) AS context
        FROM t GROUP BY query_id""",
)
def _(spark, sf):
    return agg.joined_texts(near_texts(spark, sf), "query_id", "rank", "page_content")


def near_lists(spark, sf):
    ordered = F.array_sort(F.collect_list(F.struct("rank", "page_content")))
    listed = near_texts(spark, sf).groupBy("query_id").agg(ordered.alias("context"))
    return listed.withColumn("contexts", F.transform("context", lambda d: d["page_content"]))


@query(
    "arr2_context_list",
    f"""WITH {NEAR_SQL} SELECT query_id, CAST(to_json(list(page_content ORDER BY rank)) AS VARCHAR) AS contexts FROM t GROUP BY query_id""",
)
def _(spark, sf):
    return near_lists(spark, sf).select("query_id", F.to_json("contexts").alias("contexts"))


@query(
    "prj7_flatten_steps",
    f"""WITH {NEAR_SQL} SELECT 'find ' || query_id AS query, CAST(to_json(list(page_content ORDER BY rank)) AS VARCHAR) AS contexts,
            string_agg(page_content, '; ' ORDER BY rank) AS answer FROM t GROUP BY query_id""",
)
def _(spark, sf):
    # Nested step records: query{query, section}, context[{rank, page_content}], answer.
    steps = near_lists(spark, sf).select(
        F.struct(
            F.concat(F.lit("find "), C("query_id").cast("string")).alias("query"),
            F.lit("end").alias("section"),
        ).alias("query"),
        "context",
        F.array_join("contexts", "; ").alias("answer"),
    )
    contexts = F.transform("context", lambda d: d["page_content"])
    return steps.select("query.query", F.to_json(contexts).alias("contexts"), "answer")


@query(
    "snk1_csv_arrays_as_json",
    f"""WITH {NEAR_SQL} SELECT query_id, CAST(to_json(list(page_content ORDER BY rank)) AS VARCHAR) AS contexts FROM t GROUP BY query_id""",
)
def _(spark, sf):
    path = scratch_path(spark, "csv")
    writers.write_csv(near_lists(spark, sf).select("query_id", "contexts"), path)
    return readers.read_csv(spark, path, "query_id long, contexts string")


# --- scoring --------------------------------------------------------------

# Words of the invented prose, standing in for a sentiment lexicon.
POSITIVE = ["the", "and", "die", "und", "le", "et", "la", "los"]
NEGATIVE = ["of", "to", "der", "das", "de", "que", "en", "el"]


def in_sql(words):
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


LEXICON_SQL = f"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD_SQL}') AS v FROM documents),
    s AS (SELECT doc_id, len(list_filter(v, lambda x: x IN {in_sql(POSITIVE)})) AS up,
                 len(list_filter(v, lambda x: x IN {in_sql(NEGATIVE)})) AS down FROM w)
    SELECT doc_id, CASE WHEN up > down THEN 'POS' WHEN up < down THEN 'NEG' ELSE 'NEU' END AS Label,
           round(CASE WHEN up + down = 0 THEN 0 ELSE abs(up - down) / (up + down) END, 6) AS Score FROM s"""


@query("scr1_lexicon_scores", LEXICON_SQL)
def _(spark, sf):
    scored = docs(spark, sf).select(
        "doc_id", ans.lexicon_label(C("text"), POSITIVE, NEGATIVE).alias("s")
    )
    return scored.select("doc_id", C("s.label").alias("Label"), F.round("s.score", 6).alias("Score"))


@query(
    "scr1_model_scores",
    """SELECT doc_id, CASE WHEN length(text) > 1000 THEN 'POS' ELSE 'NEG' END AS Label,
              round(length(text) / (length(text) + 1000), 6) AS Score FROM documents""",
)
def _(spark, sf):
    def load():
        return lambda texts: [("POS" if len(t) > 1000 else "NEG", len(t) / (len(t) + 1000)) for t in texts]

    scored = ans.score_with(table(spark, sf, "documents").select("doc_id", "text"), "text", load)
    return rounded(scored.drop("text"), "Score")


# --- generation -----------------------------------------------------------


PAIRS_OF_TURNS_SQL = """SELECT conv_id, turn, text AS question, answer FROM (
    SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS answer
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    WHERE role = 'user' AND next_role = 'assistant'"""


@query(
    "gen1_extractive_answers",
    f"""SELECT conv_id, turn, question, {best_sentence_sql("question", "answer")} AS answer FROM ({PAIRS_OF_TURNS_SQL})""",
)
def _(spark, sf):
    pairs = agg.answer_pairs(table(spark, sf, "conversations"))
    return pairs.withColumn("answer", ans.best_sentence(C("question"), C("answer")))


def half_lists(asked):
    """A model that gives only half of the entries it is asked for."""
    need = asked.str.extract(r"List (\d+) ")[0].astype(int)
    about = asked.str.extract(r"about (.*?)\. Separate")[0]
    return pd.Series(
        [",,, ".join(f"{a} item {n}-{i}" for i in range((n + 1) // 2)) for a, n in zip(about, need)],
        index=asked.index,
    )


@query(
    "gen2_topic_questions",
    """WITH t AS (SELECT DISTINCT source AS topic FROM documents),
       x AS (SELECT topic, unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) AS n FROM t)
       SELECT topic, CAST(n AS INTEGER) AS pos, topic || ' item ' ||
              CASE WHEN n < 5 THEN '10-' || n WHEN n < 8 THEN '5-' || (n - 5) WHEN n < 9 THEN '2-' || (n - 8) ELSE '1-' || (n - 9) END AS question, CAST(NULL AS VARCHAR) AS error
       FROM x""",
)
def _(spark, sf):
    topics = table(spark, sf, "documents").select(C("source").alias("topic")).distinct()
    listed = ans.generate_lists(topics, "questions", "topic", 10, half_lists)
    return listed.select("topic", F.posexplode_outer("items").alias("pos", "question"), "error")


@query(
    "gen3_failures_kept",
    """SELECT conv_id, turn, CASE WHEN contains(text, chr(10)) THEN 'Error generating answer' ELSE text || '!' END AS answer,
              CASE WHEN contains(text, chr(10)) THEN 'ValueError: more than one line' END AS error
       FROM conversations""",
)
def _(spark, sf):
    def shout(asked):
        if asked.str.contains("\n").any():
            raise ValueError("more than one line")
        return asked + "!"

    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return ans.generate(turns, "text", shout).drop("text")


@query(
    "gen4_question_answer_pairs",
    f"""SELECT 'c' || conv_id AS topic, question, regexp_replace(answer, '[^\\x00-\\x7F]', ' ', 'g') AS answer
        FROM ({PAIRS_OF_TURNS_SQL})""",
)
def _(spark, sf):
    pairs = agg.answer_pairs(table(spark, sf, "conversations"))
    topic = F.concat(F.lit("c"), C("conv_id").cast("string"))
    return ans.clean_pairs(pairs.withColumn("topic", topic))


@query(
    "gen4_train_test_lines",
    f"""WITH p AS (SELECT CAST(conv_id AS BIGINT) * 16777216 + turn AS id, question, answer FROM ({PAIRS_OF_TURNS_SQL})),
       h AS (SELECT *, md5('42:' || id) AS m FROM p),
       r AS (SELECT *, row_number() OVER (ORDER BY substr(m, 1, 15), substr(m, 16, 15)) AS rn, round(0.8 * count(*) OVER ()) AS n FROM h)
       SELECT id, CASE WHEN rn <= n THEN 'train' ELSE 'test' END AS split,
              '<|system|>' || chr(10) || '{READER_SQL}' || chr(10) || '<|user|>' || chr(10) || question || chr(10)
              || '<|assistant|>' || chr(10) || answer AS text FROM r""",
)
def _(spark, sf):
    pairs = agg.answer_pairs(table(spark, sf, "conversations"))
    rows = pairs.select(chunk_id(C("conv_id"), C("turn")).alias("id"), "question", "answer")
    train, test = sample_split(rows, "id", 0.8, seed=42)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    path = scratch_path(spark, "qa")
    writers.write_dataset(
        both.select("id", "split", prompts.chat_line(C("question"), C("answer")).alias("text")), path
    )
    return spark.read.parquet(path)


# --- judging --------------------------------------------------------------


def length_judge(asked):
    """A judge that scores by the length of the answer and gives no relevance to short ones."""
    size = asked.str.extract(r"(?s)\nAnswer: (.*)$")[0].str.len()
    score = size.clip(0, 1999) // 400 + 1
    return pd.Series(
        [
            f"Accuracy: [{s}]\nGroundedness: {6 - s}\n" + (f"Relevance: [{s}]\n" if s > 1 else "") + "Evaluation: ok"
            for s in score
        ],
        index=asked.index,
    )


@query(
    "jdg1_judge_results",
    f"""WITH p AS (SELECT question, answer, arm, least(length(answer), 1999) // 400 + 1 AS s
                   FROM ({PAIRS_OF_TURNS_SQL}), {ARMS_SQL})
        SELECT question, answer AS response, arm AS source,
               'Accuracy: [' || s || ']' || chr(10) || 'Groundedness: ' || (6 - s) || chr(10)
               || CASE WHEN s > 1 THEN 'Relevance: [' || s || ']' || chr(10) ELSE '' END || 'Evaluation: ok' AS llm_judge
        FROM p""",
)
def _(spark, sf):
    pairs = agg.answer_pairs(table(spark, sf, "conversations")).select("question", "answer")
    results = with_arms(pairs, ARMS).select(C("question").alias("query"), "answer", "arm")
    folder = scratch_path(spark, "results")
    # One write for all arms, a folder each.
    writers.write_csv(results.withColumnRenamed("arm", "results"), folder, by="results")
    tagged = readers.read_results(spark, folder, "query string, answer string")
    named = tagged.withColumnsRenamed({"query": "question", "answer": "response"})
    return ans.judge(named, length_judge).select("question", "response", "llm_judge", "source")


# Three grades by a person beside the judge's three.
GRADES_SQL = f"""j AS (SELECT event_id, {JUDGE_SQL} AS t, CAST(1 + floor(value) % 5 AS INTEGER) AS accuracy_score,
        CAST(1 + (event_id + user_id % 2) % 5 AS INTEGER) AS relevance_score, CAST(5 - event_id % 4 AS INTEGER) AS groundedness_score FROM events),
    s AS (SELECT event_id, {score_sql("Accuracy")} AS accuracy_judge, {score_sql("Relevance")} AS relevance_judge,
        {score_sql("Groundedness")} AS groundedness_judge, accuracy_score, relevance_score, groundedness_score FROM j)"""


def graded(spark, sf):
    events = table(spark, sf, "events")
    judged = events.select(C("event_id").alias("question"), judge_text().alias("llm_judge"))
    human = events.select(
        C("event_id").alias("question"),
        (F.floor("value") % 5 + 1).cast("int").alias("accuracy_score"),
        ((C("event_id") + C("user_id") % 2) % 5 + 1).cast("int").alias("relevance_score"),
        (5 - C("event_id") % 4).cast("int").alias("groundedness_score"),
    )
    return ans.judge_scores(judged).drop("llm_judge").join(human, "question")


@query("jdg2_scores_by_human_grade", f"WITH {GRADES_SQL} SELECT event_id AS question, * EXCLUDE (event_id) FROM s")
def _(spark, sf):
    return graded(spark, sf)


def correlation_sql(criterion):
    a, b = f"{criterion}_judge", f"{criterion}_score"
    pairs = f"(SELECT {a}, {b} FROM s WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    return f"""SELECT '{criterion}' AS criterion, count(*) AS n, round(corr(x, y), 3) AS rho
        FROM (SELECT {RANK_SQL.format(c=a)} AS x, {RANK_SQL.format(c=b)} AS y FROM {pairs})"""


@query(
    "jdg2_judge_human_correlation",
    f"WITH {GRADES_SQL} " + " UNION ALL ".join(correlation_sql(c) for c in ("accuracy", "relevance", "groundedness")),
)
def _(spark, sf):
    named = {c.lower(): (f"{c.lower()}_judge", f"{c.lower()}_score") for c in text.CRITERIA}
    return ranks.agreement(graded(spark, sf), named).withColumn("rho", F.round("rho", 3))


# --- streaming ------------------------------------------------------------


@query(
    "stm1_scored_batches",
    f"""WITH p AS ({LEXICON_SQL})
        SELECT lang AS actual, Label AS predicted, count(*) AS n FROM p JOIN documents USING (doc_id) GROUP BY 1, 2""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents")
    arrived = scratch_path(spark, "arrived")
    docs.write.parquet(arrived)
    stream = batches.arriving(spark, arrived, docs.schema, files_per_batch=2)

    def score(batch):
        label = ans.lexicon_label(C("text"), POSITIVE, NEGATIVE)["label"]
        return batch.select("lang", label.alias("predicted"))

    counts = batches.run_to_end(spark, stream, score, "lang", "predicted")
    return counts.groupBy("actual", "predicted").agg(F.sum("n").alias("n"))


@query(
    "stm1_batch_metrics",
    f"""WITH p AS (SELECT CASE {SPLIT_SQL.format(k="doc_id")} WHEN 'train' THEN 0 ELSE 1 END AS batch,
                     lang AS actual, {LANG_RULE_SQL} AS predicted FROM documents),
            r AS (WITH {report_sql("batch, ")})
        SELECT CAST(batch AS BIGINT) AS batch, max(f1) FILTER (label = 'accuracy') AS accuracy,
               max(precision) FILTER (label = 'weighted avg') AS precision,
               max(recall) FILTER (label = 'weighted avg') AS recall, max(f1) FILTER (label = 'weighted avg') AS f1
        FROM r GROUP BY batch""",
)
def _(spark, sf):
    # Two deliveries, each followed by a run that goes on from the state of the last one.
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    arrived, out, state = (scratch_path(spark, name) for name in ("arrived", "scores", "stream"))
    score = lambda batch: batch.select("lang", lang_rule(C("text")).alias("predicted"))
    for delivery in ("train", "test"):
        part = docs.filter(hash_split(C("doc_id"), 80) == delivery)
        part.write.mode("append").parquet(arrived)
        stream = batches.arriving(spark, arrived, docs.schema)
        batches.score_batches(stream, score, "lang", "predicted", out, state).awaitTermination()
    counts = spark.read.parquet(out).withColumn("batch", C("batch").cast("long"))
    return rounded(batches.batch_metrics(counts), "accuracy", "precision", "recall", "f1")


DELIVERY_SQL = f"CASE {SPLIT_SQL.format(k='doc_id')} WHEN 'train' THEN 0 ELSE 1 END"


def deliver(spark, sf, score):
    """Two deliveries of documents, each scored by a run that goes on from the last one; then two of labels."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    labels = table(spark, sf, "labels").select("doc_id", C("quality").alias("label"))
    paths = {name: scratch_path(spark, name) for name in ("documents", "scored", "stream", "labels", "labelled", "label-stream")}
    for delivery in ("train", "test"):
        docs.filter(hash_split(C("doc_id"), 80) == delivery).write.mode("append").parquet(paths["documents"])
        arrived = batches.arriving(spark, paths["documents"], docs.schema)
        batches.keep_scored(arrived, score, paths["scored"], paths["stream"]).awaitTermination()
    for good in (1, 0):
        labels.filter(C("label") == good).write.mode("append").parquet(paths["labels"])
        arrived = batches.arriving(spark, paths["labels"], labels.schema)
        batches.keep_labelled(arrived, paths["scored"], "doc_id", paths["labelled"], paths["label-stream"]).awaitTermination()
    return paths


@query(
    "stm1_scored_rows",
    f"SELECT {DELIVERY_SQL}::BIGINT AS batch, doc_id, lang, {LANG_RULE_SQL} AS predicted FROM documents",
)
def _(spark, sf):
    paths = deliver(spark, sf, lambda batch: batch.select("doc_id", "lang", lang_rule(C("text")).alias("predicted")))
    return batches.kept(spark, paths["scored"]).select("batch", "doc_id", "lang", "predicted")


@query(
    "stm1_labelled_rows",
    f"""SELECT CAST(1 - quality AS BIGINT) AS batch, {DELIVERY_SQL}::BIGINT AS scored_batch, doc_id, text, CAST(quality AS INTEGER) AS label,
            CASE WHEN n_chars > 400 THEN 1 ELSE 0 END AS predicted FROM documents JOIN labels USING (doc_id)""",
)
def _(spark, sf):
    # What a later training takes: the text, what the model said and what a person said.
    predicted = F.when(F.length("text") > 400, 1).otherwise(0).alias("predicted")
    paths = deliver(spark, sf, lambda batch: batch.select("doc_id", "text", predicted))
    return batches.kept(spark, paths["labelled"]).select("batch", "scored_batch", "doc_id", "text", "label", "predicted")


# --- caller functions -----------------------------------------------------


@query("udf1_on_column", "SELECT doc_id, length(text) AS n FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", udfs.on_column(lambda s: s.str.len(), "long", "text").alias("n")
    )


@query("udf2_on_rows", "SELECT doc_id, lang || ':' || source AS tag FROM documents")
def _(spark, sf):
    tag = udfs.on_rows(lambda d: d["lang"] + ":" + d["source"], "string", "lang", "source")
    return table(spark, sf, "documents").select("doc_id", tag.alias("tag"))


@query("udf3_on_batches", "SELECT doc_id, length(text) - length(replace(text, ' ', '')) AS spaces FROM documents")
def _(spark, sf):
    def spaces(pdf):
        return pdf.assign(spaces=pdf["text"].str.count(" "))[["doc_id", "spaces"]]

    docs = table(spark, sf, "documents").select("doc_id", "text")
    return udfs.on_batches(docs, spaces, "doc_id long, spaces long")


@query("udf4_with_model", "SELECT conv_id, turn, length(text) * 2 AS score FROM conversations")
def _(spark, sf):
    def load():
        return lambda values: values.str.len() * 2

    scored = udfs.with_model(load, "long", "text")
    return table(spark, sf, "conversations").select("conv_id", "turn", scored.alias("score"))


@query(
    "udf5_to_rows",
    "SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations",
)
def _(spark, sf):
    def lines(value):
        for line in value.split("\n"):
            yield (line,)

    spark.udtf.register("text_lines", udfs.to_rows(lines, "line string"))
    turns = table(spark, sf, "conversations")
    return spark.sql(
        "SELECT conv_id, turn, line FROM {turns}, LATERAL text_lines(text)", turns=turns
    )


F1_SQL = f"""SELECT source AS run, round(coalesce(2 * count(*) FILTER (lang = 'en' AND p = 'en')
        / nullif(count(*) FILTER (lang = 'en') + count(*) FILTER (p = 'en'), 0), 0), 6) AS f1
    FROM (SELECT source, lang, {LANG_RULE_SQL} AS p FROM documents) GROUP BY source"""


def language_guesses(spark, sf):
    return table(spark, sf, "documents").select(C("source").alias("run"), "lang", lang_rule(C("text")).alias("predicted"))


@query("udf6_metric", F1_SQL)
def _(spark, sf):
    def f1(counts):
        actual, guess, n = counts["actual"] == "en", counts["predicted"] == "en", counts["n"]
        whole = n[actual].sum() + n[guess].sum()
        return pd.DataFrame({"run": [counts["run"].iloc[0]], "f1": [round(2 * n[actual & guess].sum() / whole, 6) if whole else 0.0]})

    return udfs.metric(language_guesses(spark, sf), "lang", "predicted", f1, "run string, f1 double")


@query("udf6_merged_metric", F1_SQL)
def _(spark, sf):
    def partial(rows):
        actual, guess = rows["lang"] == "en", rows["predicted"] == "en"
        return [(actual & guess).sum(), actual.sum(), guess.sum()]

    def f1(state):
        hits, actual, guessed = state
        return round(2 * hits / (actual + guessed), 6) if actual + guessed else 0.0

    rows = language_guesses(spark, sf)
    return udfs.merged_metric(rows, ["lang", "predicted"], partial, lambda a, b: a + b, f1, target="f1")


@query(
    "udf6_merged_error",
    """SELECT lang AS run, round(sqrt(avg((n_chars / 1000.0 - quality) * (n_chars / 1000.0 - quality))), 6) AS rmse
       FROM documents JOIN labels USING (doc_id) GROUP BY lang""",
)
def _(spark, sf):
    # A metric of numbers, which has no confusion counts.
    def partial(rows):
        off = rows["n_chars"] / 1000 - rows["quality"]
        return [(off * off).sum(), len(off)]

    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(C("lang").alias("run"), "n_chars", "quality")
    finish = lambda state: round((state[0] / state[1]) ** 0.5, 6)
    return udfs.merged_metric(rows, ["n_chars", "quality"], partial, lambda a, b: a + b, finish, target="rmse")


@query("udf7_text_to_text", "SELECT conv_id, turn, length(text) || ' characters' AS answer FROM conversations")
def _(spark, sf):
    def model(asked):
        return asked.str.len().astype(str) + " characters"

    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return ans.generate(turns, "text", model).select("conv_id", "turn", "answer")
