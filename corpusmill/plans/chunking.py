"""Sentences, chunks, de-duplication, term weights and classification."""

from pyspark.sql import functions as F

from corpusmill.functions import arrays, text
from corpusmill.operators import chunks as ch
from corpusmill.operators import classify
from corpusmill.operators import metrics as met
from corpusmill.operators.features import subword_ids, term_counts, tfidf, token_ids, vocabulary, vocabulary_counts, vocabulary_ids
from corpusmill.operators.relational import position_split
from corpusmill.plans.registry import query
from corpusmill.plans.stats import BINARY_SQL, QUALITY_SPLIT_SQL, report_sql, rounded, three_way
from corpusmill.plans.texts import IDS_SQL, WORD_SQL
from corpusmill.session import scratch_path, spread, table

C = F.col


def docs(spark, sf):
    """Documents for work that is heavy per text."""
    return spread(table(spark, sf, "documents"), "doc_id")


# Sentences by a marker, as RE2 has no look-behind.
SENTENCES_SQL = (
    "list_filter(string_split(regexp_replace({c}, '([.!?])[ \\t\\n\\r\\f]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '')"
)


@query(
    "txt1_sentences",
    f"""WITH s AS (SELECT doc_id, {SENTENCES_SQL.format(c="text")} AS v FROM documents)
        SELECT doc_id, CAST(unnest(range(len(v))) AS INTEGER) AS pos, unnest(v) AS sentence FROM s""",
)
def _(spark, sf):
    return docs(spark, sf).select(
        "doc_id", F.posexplode(text.sentences(C("text"))).alias("pos", "sentence")
    )


# Sentence chunks as a recursion over sentence numbers. `k` is the number of
# sentences of the current chunk that end before sentence i, `t` how many of them
# an overlap of at least 50 characters takes.
SENTENCE_CHUNKS_SQL = f"""WITH RECURSIVE s AS (
      SELECT doc_id, v, list_transform(v, lambda x: length(x)) AS l
      FROM (SELECT doc_id, {SENTENCES_SQL.format(c="trim(text, ' ' || chr(10))")} AS v FROM documents)),
    f(doc_id, i, low, len, done) AS (
      SELECT doc_id, CAST(1 AS BIGINT), CAST(1 AS BIGINT), CAST(l[1] AS BIGINT), NULL::STRUCT(a BIGINT, b BIGINT) FROM s
      UNION ALL
      SELECT doc_id, i + 1,
             CASE WHEN NOT full_ THEN low WHEN tail + nxt <= 500 THEN i - t + 1 ELSE i + 1 END,
             CASE WHEN NOT full_ THEN len + 1 + nxt WHEN tail + nxt <= 500 THEN tail + nxt ELSE nxt END,
             CASE WHEN full_ THEN {{'a': low, 'b': i}} END
      FROM (SELECT *, list_sum(list_transform(l[i - t + 1 : i], lambda x: x + 1)) AS tail
            FROM (SELECT f.doc_id, i, low, len, l, l[i + 1] AS nxt, len + 1 + l[i + 1] > 500 AS full_,
                         coalesce(list_min(list_filter(range(1, i - low + 2),
                             lambda n: list_sum(list_transform(l[i - n + 1 : i], lambda x: x + 1)) >= 50)), i - low + 1) AS t
                  FROM f JOIN s ON f.doc_id = s.doc_id WHERE f.i < len(s.v)))),
    c AS (SELECT doc_id, done.a AS a, done.b AS b FROM f WHERE done IS NOT NULL
          UNION ALL SELECT f.doc_id, f.low, f.i FROM f JOIN s ON f.doc_id = s.doc_id WHERE f.i = len(s.v)),
    chunked AS (SELECT c.doc_id, CAST(row_number() OVER (PARTITION BY c.doc_id ORDER BY b, a) - 1 AS INTEGER) AS chunk_index,
                       array_to_string(v[a:b], ' ') AS chunk FROM c JOIN s ON c.doc_id = s.doc_id)
"""


@query("txt2_sentence_chunks", SENTENCE_CHUNKS_SQL + "SELECT doc_id, chunk_index, chunk FROM chunked")
def _(spark, sf):
    return ch.explode_chunks(docs(spark, sf), ch.sentence_chunks(C("text")), "doc_id")


def separator_chunks_sql(source, size, overlap, separators):
    """Recursive splits in two recursions: over separators, then over the pieces of a run."""
    names = ["'" + x.replace("\n", "' || chr(10) || '") + "'" for x in separators]
    last = len(names) - 1
    choose = " ".join(
        f"WHEN i <= {n} AND contains(txt, {x}) THEN {n}" for n, x in enumerate(names[:-1])
    )
    cut = f"""SELECT doc_id, path, k, c, CASE WHEN k > 1 THEN s || v[k] ELSE v[k] END AS piece FROM (
        SELECT doc_id, path, c, s, v, unnest(range(1, len(v) + 1)) AS k FROM (
          SELECT doc_id, path, c, s, string_split(txt, s) AS v FROM (
            SELECT *, [{", ".join(names)}][c + 1] AS s FROM (SELECT *, CASE {choose} ELSE {last} END AS c FROM {{level}}))))"""
    rest = "coalesce(list_sum(l[x : i]), 0)"
    return f"""WITH RECURSIVE lv(doc_id, path, txt, i) AS (
          SELECT doc_id, CAST([] AS BIGINT[]), text, 0 FROM {source}
          UNION ALL SELECT doc_id, list_append(path, k), piece, c + 1 FROM ({cut.format(level="lv")})
          WHERE length(piece) >= {size} AND c < {last}),
        pieces AS (SELECT *, length(piece) >= {size} AND c < {last} AS deeper FROM ({cut.format(level="lv")}) WHERE piece <> ''),
        marked AS (SELECT *, count(*) FILTER (deeper) OVER (PARTITION BY doc_id, path ORDER BY k ROWS UNBOUNDED PRECEDING) AS run FROM pieces),
        runs AS (SELECT row_number() OVER () AS id, * FROM (
          SELECT doc_id, list_append(path, min(k)) AS first, list(piece ORDER BY k) AS v, list(length(piece) ORDER BY k) AS l
          FROM marked WHERE NOT deeper GROUP BY doc_id, path, run)),
        f(id, i, low, len, a, b) AS (
          SELECT id, CAST(1 AS BIGINT), CAST(1 AS BIGINT), CAST(l[1] AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM runs
          UNION ALL
          SELECT id, i + 1, CASE WHEN full_ THEN cut ELSE low END,
                 CASE WHEN full_ THEN {rest.replace("x", "cut")} + nxt ELSE len + nxt END,
                 CASE WHEN full_ THEN low END, CASE WHEN full_ THEN i END
          FROM (SELECT f.id, i, low, len, l, l[i + 1] AS nxt, len + l[i + 1] > {size} AS full_,
                       CASE WHEN len + l[i + 1] > {size} THEN list_min(list_filter(range(low, i + 2),
                           lambda x: {rest} <= {overlap} AND {rest} + l[i + 1] <= {size})) END AS cut
                FROM f JOIN runs ON f.id = runs.id WHERE i < len(l))),
        c AS (SELECT id, a, b FROM f WHERE a IS NOT NULL
              UNION ALL SELECT f.id, low, i FROM f JOIN runs ON f.id = runs.id WHERE i = len(l)),
        t AS (SELECT doc_id, first, b, trim(array_to_string(v[a:b], ''), ' ' || chr(10)) AS chunk FROM c JOIN runs ON c.id = runs.id)
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first, b) - 1 AS INTEGER) AS chunk_index, chunk
        FROM t WHERE chunk <> ''"""


@query("txt3_separator_chunks", separator_chunks_sql("documents", 1000, 200, ch.DEFAULT_SEPARATORS))
def _(spark, sf):
    return ch.explode_chunks(docs(spark, sf), ch.separator_chunks(C("text")), "doc_id")


@query(
    "txt3_sentence_separator_chunks",
    separator_chunks_sql(
        """(SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)),
            lambda x: x <> ''), chr(10) || chr(10)) AS text FROM documents)""",
        500,
        50,
        ch.SENTENCE_SEPARATORS,
    ),
)
def _(spark, sf):
    clean = docs(spark, sf).withColumn("text", text.clean_paragraphs(C("text")))
    pieces = ch.separator_chunks(C("text"), 500, 50, ch.SENTENCE_SEPARATORS)
    return ch.explode_chunks(clean, pieces, "doc_id")


WINDOWS_SQL = """SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, substr(text, CAST(i * 800 + 1 AS BIGINT), 1000) AS chunk
    FROM (SELECT doc_id, text, unnest(range(CAST(greatest(1, ceil((length(text) - 200) / 800)) AS BIGINT))) AS i FROM documents)"""


def windows(spark, sf):
    return ch.explode_chunks(docs(spark, sf), arrays.fixed_windows(C("text"), 1000, 200), "doc_id")


@query("txt4_fixed_windows", WINDOWS_SQL)
def _(spark, sf):
    return windows(spark, sf)


@query(
    "win3_chunk_positions",
    f"""WITH w AS ({WINDOWS_SQL}) SELECT doc_id, chunk_index, length(chunk) AS n_chars,
            max(chunk_index) OVER (PARTITION BY doc_id) + 1 AS chunks FROM w""",
)
def _(spark, sf):
    pieces = arrays.fixed_windows(C("text"), 1000, 200)
    sized = docs(spark, sf).select("doc_id", pieces.alias("p")).withColumn("chunks", F.size("p"))
    rows = sized.select("doc_id", "chunks", F.posexplode("p").alias("chunk_index", "chunk"))
    return rows.select(
        "doc_id", "chunk_index", F.length("chunk").cast("long").alias("n_chars"), "chunks"
    )


@query(
    "win4_first_occurrences",
    f"""WITH w AS (SELECT doc_id, unnest(range(len(v))) AS i, unnest(v) AS chunk
                   FROM (SELECT doc_id, {SENTENCES_SQL.format(c="text")} AS v FROM documents)),
            r AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, i) AS n FROM w)
        SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, chunk FROM r WHERE n = 1""",
)
def _(spark, sf):
    pieces = ch.explode_chunks(docs(spark, sf), text.sentences(C("text")), "doc_id")
    return ch.first_occurrences(pieces)


@query(
    "txt5_chunk_corpus",
    SENTENCE_CHUNKS_SQL
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, chunk_index) AS n FROM chunked)
    SELECT r.doc_id, chunk AS page_content, d.source, CAST(chunk_index AS VARCHAR) AS chunk_index
    FROM r JOIN documents d ON d.doc_id = r.doc_id WHERE n = 1""",
)
def _(spark, sf):
    described = docs(spark, sf).withColumn("metadata", F.create_map(F.lit("source"), "source"))
    unique = ch.chunk_corpus(described)
    return unique.select("doc_id", "page_content", "metadata.source", "metadata.chunk_index")


TERMS_SQL = f"""t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD_SQL}')) AS term FROM documents),
    c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2)"""


@query("txt6_term_counts", f"WITH {TERMS_SQL} SELECT doc_id, term, tf FROM c")
def _(spark, sf):
    return term_counts(docs(spark, sf), "doc_id", "text")


@query(
    "txt7_tfidf",
    f"""WITH {TERMS_SQL}, d AS (SELECT term, count(*) AS df FROM c GROUP BY term),
        w AS (SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS raw FROM c JOIN d USING (term))
        SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""",
)
def _(spark, sf):
    return rounded(tfidf(docs(spark, sf), "doc_id", "text"), "weight")


@query(
    "txt8_token_ids",
    f"""WITH t AS (SELECT doc_id, {IDS_SQL} AS ids FROM documents)
        SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(512), lambda i: 0))[1:512], ',') AS input_ids,
               array_to_string(list_concat(list_transform(ids[1:512], lambda x: 1), list_transform(range(512), lambda i: 0))[1:512], ',') AS attention_mask
        FROM t""",
)
def _(spark, sf):
    tokens = docs(spark, sf).select("doc_id", token_ids(C("text"), 30000).alias("ids"))
    return tokens.select(
        "doc_id",
        F.array_join(arrays.pad_or_cut(C("ids"), 512), ",").alias("input_ids"),
        F.array_join(arrays.attention_mask(C("ids"), 512), ",").alias("attention_mask"),
    )


VOCABULARY_SQL = f"""t AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD_SQL}') AS v FROM documents),
    w AS (SELECT term, n, CAST(row_number() OVER (ORDER BY n DESC, term) + 1 AS INTEGER) AS id
          FROM (SELECT term, count(*) AS n FROM (SELECT unnest(v) AS term FROM t) GROUP BY term) WHERE n >= 2)"""


@query("txt6_vocabulary", f"WITH {VOCABULARY_SQL} SELECT term, id, n FROM w")
def _(spark, sf):
    return vocabulary(docs(spark, sf), "text", min_count=2).terms


@query(
    "txt6_vocabulary_counts",
    f"""WITH {VOCABULARY_SQL} SELECT doc_id, id, count(*) AS tf FROM (SELECT doc_id, unnest(v) AS term FROM t) JOIN w USING (term)
        GROUP BY 1, 2""",
)
def _(spark, sf):
    rows = docs(spark, sf)
    return vocabulary_counts(rows, "doc_id", "text", vocabulary(rows, "text", min_count=2))


@query(
    "txt8_vocabulary_ids",
    f"""WITH {VOCABULARY_SQL}, p AS (SELECT doc_id, unnest(v) AS term, unnest(range(len(v))) AS i FROM t),
        l AS (SELECT doc_id, list(coalesce(id, 1) ORDER BY i) AS ids FROM p LEFT JOIN w USING (term) GROUP BY doc_id)
        SELECT doc_id, array_to_string(list_concat(coalesce(ids, []), list_transform(range(512), lambda i: 0))[1:512], ',') AS input_ids,
               CAST(len(coalesce(ids, [])) AS INTEGER) AS n FROM t LEFT JOIN l USING (doc_id)""",
)
def _(spark, sf):
    rows = docs(spark, sf)
    found = vocabulary_ids(rows, "doc_id", "text", vocabulary(rows, "text", min_count=2))
    return found.select("doc_id", F.array_join(arrays.pad_or_cut(C("ids"), 512), ",").alias("input_ids"), F.size("ids").alias("n"))


# The given pieces: the words of the benchmark's items, and every character of the documents alone and inside a word.
# Words are cut one piece a step, the longest that fits.
PIECES_SQL = """chars AS (SELECT DISTINCT c FROM (SELECT unnest(string_split(lower(text), '')) AS c FROM documents)
          WHERE regexp_full_match(c, '[\\p{L}\\p{N}_]') AND c <> 'q'),
    named AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS c FROM benchmark),
    piece AS (SELECT c AS piece FROM chars UNION SELECT '##' || c FROM chars UNION SELECT c FROM named
              UNION SELECT '##' || substr(c, 2) FROM named WHERE length(c) > 2),
    vocab AS MATERIALIZED (SELECT piece, CAST(row_number() OVER (ORDER BY piece) + 3 AS INTEGER) AS id FROM piece)"""
SUBWORDS_SQL = f"""WITH RECURSIVE {PIECES_SQL},
    p AS (SELECT doc_id, unnest(v) AS word, unnest(range(len(v))) AS i FROM (
          SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+|[^\\s\\p{{L}}\\p{{N}}_]') AS v FROM documents)),
    cut(word, k, ids) AS (
      SELECT DISTINCT word, CAST(1 AS BIGINT), CAST([] AS INTEGER[]) FROM p
      UNION ALL
      SELECT word, k + n, list_append(ids, id) FROM (
        SELECT word, k, ids, id, n, row_number() OVER (PARTITION BY word ORDER BY n DESC) AS r FROM (
          SELECT word, k, ids, unnest(range(1, CAST(length(word) AS BIGINT) - k + 2)) AS n FROM cut WHERE k <= length(word) AND length(word) <= 100) c
        JOIN vocab ON vocab.piece = CASE WHEN k = 1 THEN '' ELSE '##' END || substr(word, k, n)) WHERE r = 1),
    done AS (SELECT word, ids FROM cut WHERE k > length(word)),
    l AS (SELECT doc_id, flatten(list(coalesce(ids, [1]) ORDER BY i)) AS ids FROM p LEFT JOIN done USING (word) GROUP BY doc_id),
    a AS (SELECT doc_id, list_concat(list_concat([2], coalesce(ids, [])[1:510]), [3]) AS ids FROM documents LEFT JOIN l USING (doc_id))"""


def given_pieces(spark, sf):
    """A vocabulary as a caller brings one: {piece: id}."""
    text = F.lower("text")
    found = table(spark, sf, "documents").select(F.explode(F.array_distinct(F.split(text, ""))).alias("c")).distinct()
    chars = [r["c"] for r in found.where(C("c").rlike(r"^[\p{L}\p{N}_]$") & (C("c") != "q")).collect()]
    listed = F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))
    named = [r["c"] for r in table(spark, sf, "benchmark").select(F.explode(listed).alias("c")).distinct().collect()]
    pieces = {*chars, *("##" + c for c in chars), *named, *("##" + c[1:] for c in named if len(c) > 2)}
    return {piece: i + 4 for i, piece in enumerate(sorted(pieces, key=str.encode))}


@query(
    "txt8_subword_ids",
    SUBWORDS_SQL
    + """SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(512), lambda i: 0))[1:512], ',') AS input_ids,
        CAST(len(ids) AS INTEGER) AS n FROM a""",
)
def _(spark, sf):
    found = subword_ids(docs(spark, sf), "doc_id", "text", given_pieces(spark, sf), unknown=1, begin=2, end=3, max_length=512)
    return found.select("doc_id", F.array_join(arrays.pad_or_cut(C("ids"), 512), ",").alias("input_ids"), F.size("ids").alias("n"))


# --- classification -------------------------------------------------------


def labelled(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", C("quality").alias("label"))
    rows = docs(spark, sf).select("doc_id", "text").join(labels, "doc_id")
    return rows.withColumn("split", three_way(C("doc_id")))


LABELLED_SQL = f"""lab AS MATERIALIZED (SELECT doc_id, text, quality AS label, {QUALITY_SPLIT_SQL} AS split FROM documents JOIN labels USING (doc_id)),
    tf AS MATERIALIZED (SELECT doc_id, b, count(*) AS tf FROM (
        SELECT doc_id, unnest({IDS_SQL.replace("30000", str(classify.BUCKETS))}) AS b FROM lab) GROUP BY ALL)"""


def model_sql(m, rows):
    """The training steps one by one: {m}_x holds the features of all rows, {m}_p their predictions."""
    scale = f"{classify.WEIGHT}::BIGINT * {classify.VALUE}"
    margin = f"""SELECT doc_id, coalesce(s, 0) + (SELECT c FROM {m}_c{{i}}) * {classify.VALUE} AS s
        FROM {{rows}} LEFT JOIN (SELECT doc_id, sum(w * x) AS s FROM {m}_x JOIN {m}_w{{i}} USING (b) GROUP BY doc_id) USING (doc_id)"""
    parts = [
        f"""{m}_t AS MATERIALIZED (SELECT doc_id, CASE WHEN label > 0 THEN 1 ELSE -1 END AS y FROM lab WHERE {rows}),
        {m}_n AS MATERIALIZED (SELECT count(*) AS n, 2 * count(*) FILTER (y = 1) AS p, 2 * count(*) FILTER (y = -1) AS q FROM {m}_t),
        {m}_d AS (SELECT b, count(*) AS df FROM tf JOIN {m}_t USING (doc_id) GROUP BY b),
        {m}_r AS (SELECT doc_id, b, tf * (ln((1 + n) / (1 + coalesce(df, 0))) + 1) AS r FROM tf LEFT JOIN {m}_d USING (b), {m}_n),
        {m}_x AS MATERIALIZED (SELECT doc_id, b, CAST(floor(r / sqrt(sum(r * r) OVER (PARTITION BY doc_id)) * {classify.VALUE} + 0.5) AS BIGINT) AS x FROM {m}_r),
        {m}_w0 AS MATERIALIZED (SELECT CAST(0 AS INTEGER) AS b, CAST(0 AS BIGINT) AS w WHERE false),
        {m}_c0 AS MATERIALIZED (SELECT CAST(0 AS BIGINT) AS c)"""
    ]
    for i, (length, intercept) in enumerate(classify.step_lengths()):
        parts.append(
            f"""{m}_v{i} AS MATERIALIZED (SELECT doc_id, y FROM ({margin.format(i=i, rows=f"{m}_t")}) JOIN {m}_t USING (doc_id) WHERE y * s < {scale}),
            {m}_g{i} AS MATERIALIZED (SELECT b, coalesce(sum(x) FILTER (y = 1), 0) AS p, coalesce(sum(x) FILTER (y = -1), 0) AS q
                FROM {m}_x JOIN {m}_v{i} USING (doc_id) GROUP BY b),
            {m}_w{i + 1} AS MATERIALIZED (SELECT b, CAST(coalesce(w, 0) + coalesce(g.p, 0) * {length} // n.p - coalesce(g.q, 0) * {length} // n.q AS BIGINT) AS w
                FROM {m}_w{i} FULL JOIN {m}_g{i} g USING (b), {m}_n n),
            {m}_c{i + 1} AS MATERIALIZED (SELECT CAST(c + (SELECT count(*) FROM {m}_v{i} WHERE y = 1) * {intercept}::BIGINT // p
                - (SELECT count(*) FROM {m}_v{i} WHERE y = -1) * {intercept}::BIGINT // q AS BIGINT) AS c FROM {m}_c{i}, {m}_n)"""
        )
    parts.append(
        f"{m}_p AS MATERIALIZED (SELECT doc_id, CAST(CASE WHEN s > 0 THEN 1 ELSE 0 END AS INTEGER) AS predicted FROM ({margin.format(i=classify.STEPS, rows='lab')}))"
    )
    return ", ".join(parts)


@query(
    "cls1_train_and_score",
    f"""WITH {LABELLED_SQL}, {model_sql("m", "split = 'train'")}
        SELECT split, {BINARY_SQL} FROM (SELECT split, label AS actual, predicted FROM lab JOIN m_p USING (doc_id)) GROUP BY split""",
)
def _(spark, sf):
    rows = labelled(spark, sf)
    model = classify.train(rows.filter("split = 'train'"))
    scored = classify.predict(model, rows)
    return rounded(
        met.binary_metrics(scored, "label", "predicted", by=["split"]),
        "accuracy",
        "precision",
        "recall",
        "f1",
    )


@query(
    "cls2_predict",
    f"""WITH {LABELLED_SQL}, {model_sql("m", "split = 'train'")}
        SELECT doc_id, split, label, predicted FROM lab JOIN m_p USING (doc_id) WHERE split <> 'train'""",
)
def _(spark, sf):
    rows = labelled(spark, sf)
    # A model that went through its table: what a later job reads.
    path = scratch_path(spark, "model")
    classify.write_model(classify.train(rows.filter("split = 'train'")), spark, path)
    rest = classify.predict(classify.read_model(spark, path), rows.filter("split <> 'train'"))
    return rest.select("doc_id", "split", "label", "predicted")


@query(
    "cls3_retrain_report",
    f"""WITH {LABELLED_SQL.replace("lab AS", "raw AS", 1).replace("FROM lab)", "FROM raw)")},
        lab AS MATERIALIZED (SELECT doc_id, label, CASE WHEN split = 'train' THEN 'old'
            WHEN row_number() OVER (PARTITION BY split = 'train' ORDER BY doc_id) <= (SELECT count(*) FROM raw WHERE split <> 'train') // 2
            THEN 'batch 1' ELSE 'batch 2' END AS part FROM raw),
        {model_sql("a", "part = 'old'")}, {model_sql("z", "part <> 'batch 2'")},
        p AS (SELECT part || ' before' AS run, label AS actual, predicted FROM lab JOIN a_p USING (doc_id) WHERE part <> 'old'
              UNION ALL SELECT part || ' after', label, predicted FROM lab JOIN z_p USING (doc_id) WHERE part <> 'old'),
        {report_sql("run, ")}""",
)
def _(spark, sf):
    rows = labelled(spark, sf)
    old = rows.filter("split = 'train'")
    new = rows.filter("split <> 'train'")
    batch, following = position_split(new, ["doc_id"], new.count() // 2)
    before, after = classify.retrain(old, batch)
    runs = None
    for name, model in (("before", before), ("after", after)):
        for part, data in (("batch 1", batch), ("batch 2", following)):
            scored = classify.predict(model, data).select(
                F.lit(f"{part} {name}").alias("run"), "label", "predicted"
            )
            runs = scored if runs is None else runs.unionByName(scored)
    report = met.class_report(runs, "label", "predicted", by=["run"])
    return rounded(report, "precision", "recall", "f1")
