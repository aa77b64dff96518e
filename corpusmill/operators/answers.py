"""Scoring, generation, retrieval answers and judging with caller-supplied models."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import prompts, text
from corpusmill.functions.arrays import let
from corpusmill.operators.relational import with_arms
from corpusmill.operators.vectors import BROADCAST_BYTES, nearest
from corpusmill.session import written
from corpusmill.sources.writers import write_csv

# Fixed value: the answer of a row whose model call failed.
FAILED = "Error generating answer"
# One retrieved (query, chunk, score, rank) row in memory.
HIT_BYTES = 64


# --- scoring --------------------------------------------------------------


def lexicon_label(column: Column, positive, negative) -> Column:
    """struct(label, score) from word lists: POS, NEG or NEU, and the share of the balance."""

    def count(found):
        hits = lambda words: F.size(F.filter(found, lambda w: w.isin(*words)))
        return F.struct(hits(positive).alias("up"), hits(negative).alias("down"))

    def judge(n):
        up, down = n["up"], n["down"]
        label = F.when(up > down, "POS").when(up < down, "NEG").otherwise("NEU")
        score = F.coalesce(F.try_divide(F.abs(up - down), up + down), F.lit(0.0))
        return F.struct(label.alias("label"), score.alias("score"))

    return let(let(text.words(column), count), judge)


def score_with(df: DataFrame, column: str, make_model) -> DataFrame:
    """Add `Label` and `Score`. `make_model()` runs once per task and returns texts -> [(label, score)]."""

    @F.pandas_udf("label string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for texts in batches:
            yield pd.DataFrame(model(list(texts)), columns=["label", "score"])

    scored = df.withColumn("_s", run(column))
    return scored.withColumns({"Label": F.col("_s.label"), "Score": F.col("_s.score")}).drop("_s")


# --- generation -----------------------------------------------------------


def generate(df: DataFrame, prompt: str, model, target="answer", error="error") -> DataFrame:
    """Add the text `model(prompts: Series) -> Series` gives, and an error column.

    A batch that fails, or gets another number of answers, is retried row by row; a failing row stays, with a fixed
    answer and the message. Rows whose prompt is null are not sent.
    """

    def attempt(part):
        try:
            answers = list(model(part))
            if len(answers) != len(part):
                raise ValueError(f"{len(answers)} answers to {len(part)} prompts")
            return answers, [None] * len(part)
        except Exception as e:  # the message becomes data
            if len(part) == 1:
                return [FAILED], [f"{type(e).__name__}: {e}"]
            singles = [attempt(part.iloc[i : i + 1]) for i in range(len(part))]
            return [s[0][0] for s in singles], [s[1][0] for s in singles]

    @F.pandas_udf("answer string, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for asked in batches:
            out = pd.DataFrame({"answer": None, "error": None}, index=range(len(asked)), dtype=object)
            asked = asked.reset_index(drop=True)
            sent = asked.notna().to_numpy()
            if sent.any():
                answers, errors = attempt(asked[sent])
                out.loc[sent, "answer"] = answers
                out.loc[sent, "error"] = errors
            yield out

    # Only the prompt goes to the model's process. A model's answers are used, not asked for again, by later filters.
    said = df.drop(target, error).withColumn("_said", run.asNondeterministic()(F.col(prompt)))
    return said.withColumns({target: F.col("_said.answer"), error: F.col("_said.error")}).drop("_said")


def best_sentence(question: Column, context: Column) -> Column:
    """Extractive answer: the context sentence that shares most words with the question."""

    def best(asked):
        scored = F.transform(
            text.sentences(context),
            lambda s, i: F.struct(
                F.size(F.array_intersect(asked, text.words(s))).alias("hits"),
                (-i).alias("place"),
                s.alias("s"),
            ),
        )
        return F.array_max(scored)["s"]

    return let(F.array_distinct(text.words(question)), best)


def generate_lists(df: DataFrame, kind: str, about: str, n: int, model, idle=2, target="items", error="error") -> DataFrame:
    """Lists of n topics or questions about a column, topped up until all are full.

    Short lists are asked again; the model is given up after `idle` rounds in a row
    that added nothing anywhere. A list that is short by then stays as it is, with the last
    message, or how much is missing, in `error` (null: full). Each round is a written table.
    """
    nothing = F.array().cast("array<string>")
    lists = df.drop(target, error).withColumns({target: nothing, error: F.lit(None).cast("string")})
    have, still = 0, 0
    while still < idle:
        missing = F.lit(n) - F.size(target)
        ask = F.when(missing > 0, prompts.list_request(kind, F.col(about), missing))
        answered = generate(lists.withColumn("_ask", ask), "_ask", model, "_text", "_error")
        new = F.when(F.col("_error").isNull(), text.split_list(F.col("_text")))
        added = F.slice(F.concat(F.col(target), F.coalesce(new, nothing)), 1, n)
        short = F.concat_ws(" ", F.lit("only"), F.size(added).cast("string"), F.lit("of"), F.lit(n).cast("string"))
        why = F.when(F.size(added) < n, F.coalesce("_error", short))
        lists = written(answered.withColumns({error: why, target: added}).drop("_ask", "_text", "_error"), "lists")
        gained, open_ = lists.agg(F.sum(F.size(target)), F.count(error)).first()
        if not open_:
            break
        still = still + 1 if gained == have else 0
        have = gained
    return lists


def clean_pairs(df: DataFrame) -> DataFrame:
    """(topic, question, answer) without failed rows, answers in ASCII."""
    kept = df.filter("error IS NULL") if "error" in df.columns else df
    return kept.select("topic", "question", text.ascii_only(F.col("answer")).alias("answer"))


# --- retrieval ------------------------------------------------------------


def retrieve(questions: DataFrame, chunks: DataFrame, k=3, metric="cosine") -> DataFrame:
    """(query_id, context, contexts): texts of the k nearest chunks in rank order.

    `questions(query_id, vector)`, `chunks(id, vector, page_content)`.
    """
    top = nearest(chunks.select("id", "vector"), questions.select("query_id", "vector"), k, metric)
    # k rows per question: broadcast while that is small, so that the corpus of
    # texts is not shuffled for a handful of hits.
    if questions.count() * k * HIT_BYTES <= BROADCAST_BYTES:
        top = F.broadcast(top)
    named = chunks.select("id", "page_content").join(top, "id")
    # A list of k texts at most.
    ranked = F.array_sort(F.collect_list(F.struct("rank", "page_content")))
    lists = named.groupBy("query_id").agg(F.transform(ranked, lambda x: x["page_content"]).alias("contexts"))
    return lists.select("query_id", F.array_join("contexts", "\n\n").alias("context"), "contexts")


def retrieval_prompts(questions: DataFrame, chunks: DataFrame, k=3, metric="cosine") -> DataFrame:
    """Questions `(query_id, question, vector)` with context, contexts and prompt."""
    # Measured, searched with and joined: embedded once.
    questions = written(questions, "questions")
    found = retrieve(questions, chunks, k, metric)
    asked = questions.drop("vector").join(found, "query_id", "left")
    return asked.withColumn("prompt", prompts.plain(F.col("question"), F.col("context")))


def arm_prompts(asked: DataFrame, arms) -> DataFrame:
    """Every question once per system arm; only retrieval arms see the context."""
    grid = with_arms(asked, arms)
    seen = {c: F.when(F.col("retrieval"), F.col(c)) for c in ("context", "contexts") if c in asked.columns}
    grid = grid.withColumns(seen)
    return grid.withColumn("prompt", prompts.plain(F.col("question"), F.col("context")))


def write_answers(prompted: DataFrame, model, path: str, marker="Answer:", arm="arm"):
    """Let a caller's model answer the prompts and write the answer tables: query, contexts (JSON), answer; a folder per arm.

    `prompted(question, contexts, prompt, arm)`. A model may repeat its prompt: the answer is what follows the last
    `marker`. All arms are one job and one write; `readers.read_results` reads them back with their arm as the source.
    """
    answered = generate(prompted, "prompt", model)
    table = answered.select(
        F.col("question").alias("query"), F.coalesce("contexts", F.array().cast("array<string>")).alias("contexts"),
        text.after_last(F.col("answer"), marker).alias("answer"), F.col(arm).alias("results"),
    )
    write_csv(table, path, by="results")


# --- judging --------------------------------------------------------------


def judge(df: DataFrame, model, question="question", response="response") -> DataFrame:
    """Add `llm_judge`, the judge's text for every answer."""
    asked = df.withColumn("_p", prompts.judge_request(F.col(question), F.col(response)))
    return generate(asked, "_p", model, "llm_judge", "judge_error").drop("_p")


def judge_scores(df: DataFrame, judged="llm_judge", criteria=text.CRITERIA) -> DataFrame:
    """One integer column per criterion; null where the judge gave no score."""
    return df.withColumns({f"{c.lower()}_judge": text.bracket_score(F.col(judged), c) for c in criteria})
