"""Scans, sinks, projections, joins, unions, sorts and splits."""

from pyspark.sql import functions as F

from corpusmill.functions.text import strip
from corpusmill.functions.urls import slash_count
from corpusmill.operators import relational as rel
from corpusmill.plans.registry import query
from corpusmill.session import scratch_path, table
from corpusmill.sources import readers, writers

TIME = "yyyy-MM-dd HH:mm:ss"


def shown(column):
    return F.date_format(column, TIME).alias(column)


# The four system variants: a base and a tuned model, with and without retrieval.
ARMS = [
    ("base", "base", False),
    ("base_rag", "base", True),
    ("tuned", "tuned", False),
    ("tuned_rag", "tuned", True),
]
ARMS_SQL = (
    "(VALUES ('base','base',false),('base_rag','base',true),"
    "('tuned','tuned',false),('tuned_rag','tuned',true)) a(arm, model, retrieval)"
)

# --- sources --------------------------------------------------------------


@query(
    "src1_parquet_scan",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders""",
)
def _(spark, sf):
    return readers.read_parquet(
        spark, f"{sf}/orders.parquet", "o_orderkey", "o_orderstatus", "o_totalprice"
    )


SPLIT_SQL = (
    "CASE WHEN CAST('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 "
    "THEN 'train' ELSE 'test' END"
)


@query(
    "src2_split_scan",
    f"""SELECT d.doc_id, d.text, CAST(l.quality AS INTEGER) AS label
        FROM documents d JOIN labels l USING (doc_id)
        WHERE {SPLIT_SQL.format(k="d.doc_id")} = 'test'""",
)
def _(spark, sf):
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    labelled = labelled.withColumn("label", F.col("quality"))
    parts = labelled.withColumn("split", rel.hash_split(F.col("doc_id"), 80))
    return readers.read_split(parts, "test", "doc_id", "text", "label")


@query(
    "src3_csv_scan",
    """SELECT event_id, event_type, props, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events""",
)
def _(spark, sf):
    path = scratch_path(spark, "csv")
    events = table(spark, sf, "events").select("event_id", "event_type", "props", "ts")
    writers.write_csv(events, path)
    # No field holds a newline, so large files are read in splits.
    back = readers.read_csv(
        spark, path, "event_id long, event_type string, props string, ts timestamp_ntz", multi_line=False
    )
    return back.select("event_id", "event_type", "props", shown("ts"))


@query(
    "src4_encoding_fallback",
    """SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents""",
)
def _(spark, sf):
    # German lines are written as Latin-1, all others as UTF-8; the reader gets both back.
    docs = table(spark, sf, "documents").select(
        "lang", F.concat_ws("\t", "doc_id", F.translate("text", "\n", " ")).alias("value")
    )
    path = scratch_path(spark, "mixed")
    latin1 = docs.filter("lang = 'de'").select("value")
    latin1.write.mode("append").option("encoding", "ISO-8859-1").text(path)
    docs.filter("lang <> 'de'").select("value").write.mode("append").text(path)
    parts = F.split("value", "\t", 2)
    return readers.read_lines_decoded(spark, path, "*.txt").select(
        parts[0].cast("long").alias("doc_id"), parts[1].alias("text")
    )


@query(
    "src4_file_encoding",
    """SELECT doc_id, 'Ã¤' AS text FROM documents WHERE lang = 'de'
       UNION ALL SELECT doc_id, replace(text, chr(10), ' ') || CASE WHEN lang = 'de' THEN 'ß' ELSE '' END FROM documents""",
)
def _(spark, sf):
    # Each Latin-1 file also has lines whose bytes happen to be valid UTF-8; the file decides.
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.translate("text", "\n", " ").alias("text"))
    german = docs.filter("lang = 'de'").select("doc_id", F.explode(F.array(F.lit("Ã¤"), F.concat("text", F.lit("ß")))).alias("text"))
    path = scratch_path(spark, "mixed")
    line = F.concat_ws("\t", "doc_id", "text").alias("value")
    german.select(line).write.mode("append").option("encoding", "ISO-8859-1").text(path)
    docs.filter("lang <> 'de'").select(line).write.mode("append").text(path)
    parts = F.split("value", "\t", 2)
    return readers.read_files_by_encoding(spark, path, "*.txt").select(parts[0].cast("long").alias("doc_id"), parts[1].alias("text"))


LINES_SQL = "SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents"


@query(
    "src5_topic_rows",
    f"""WITH l AS ({LINES_SQL}),
        p AS (SELECT doc_id, trim(value[1:strpos(value, ',') - 1]) AS topic,
                     trim(value[strpos(value, ',') + 1:]) AS question
              FROM l WHERE strpos(value, ',') > 0 AND NOT regexp_matches(value, '^\\s*Topic\\s*,'))
        SELECT topic, question FROM p WHERE question <> ''""",
)
def _(spark, sf):
    path = scratch_path(spark, "topics")
    writers.write_lines(table(spark, sf, "documents"), path, "text")
    return readers.topic_rows(spark.read.text(path))


@query(
    "src6_line_list",
    """SELECT trim(url) AS value FROM pages WHERE trim(url) <> ''""",
)
def _(spark, sf):
    path = scratch_path(spark, "lines")
    padded = table(spark, sf, "pages").select(F.concat(F.lit("  "), "url", F.lit(" \n")).alias("url"))
    writers.write_lines(padded, path, "url")
    return readers.lines(spark.read.text(path))


@query(
    "src7_html_folder",
    """SELECT sha256(html) AS digest, length(html) AS n_chars FROM pages""",
)
def _(spark, sf):
    path = scratch_path(spark, "site")
    writers.write_files(table(spark, sf, "pages"), path, "html", by="page_id")
    pages = readers.read_pages(spark, path, pattern="*.txt")
    # The writer ends a file's last line.
    html = F.regexp_replace("html", "\n$", "")
    return pages.select(F.sha2(html, 256).alias("digest"), F.length(html).cast("long").alias("n_chars"))


@query(
    "src8_results_folder",
    f"""SELECT c.text AS query, 'Re: ' || c.text AS answer, a.arm AS source
        FROM conversations c, {ARMS_SQL} WHERE c.role = 'user'""",
)
def _(spark, sf):
    asked = table(spark, sf, "conversations").filter("role = 'user'")
    grid = rel.with_arms(asked.select(F.col("text").alias("query")), ARMS)
    path = scratch_path(spark, "results")
    results = grid.select("query", F.concat(F.lit("Re: "), "query").alias("answer"), "arm")
    # A folder per arm in one write; the reader takes the arm from the folder's name.
    named = results.withColumn("results", F.col("arm")).drop("arm")
    writers.write_csv(named, path, by="results")
    return readers.read_results(spark, path, "query string, answer string")


# --- sinks ----------------------------------------------------------------


@query(
    "snk1_csv_round_trip",
    """SELECT doc_id, text, lang FROM documents""",
)
def _(spark, sf):
    path = scratch_path(spark, "csv")
    writers.write_csv(table(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    return readers.read_csv(spark, path, "doc_id long, text string, lang string")


@query("snk2_line_file", """SELECT DISTINCT source AS value FROM documents""")
def _(spark, sf):
    path = scratch_path(spark, "topics")
    writers.write_lines(table(spark, sf, "documents").select("source").distinct(), path, "source")
    return spark.read.text(path)


COURSES_SQL = """SELECT page_id, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS title,
    regexp_extract(html, '<p>([^<]+)</p>', 1) AS description FROM pages"""


def courses(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("title"),
        F.regexp_extract("html", "<p>([^<]+)</p>", 1).alias("description"),
    )


@query(
    "snk3_course_page",
    f"""WITH c AS ({COURSES_SQL})
        SELECT '<h2>' || title || '</h2><p>' || description || '</p>' AS value FROM c
        UNION ALL SELECT '<html><body><h1>What is taught</h1>'
        UNION ALL SELECT '</body></html>'""",
)
def _(spark, sf):
    path = scratch_path(spark, "page")
    writers.write_page(
        writers.course_page_lines(courses(spark, sf), "page_id", "title", "description", "What is taught"), path
    )
    return spark.read.text(path)


@query(
    "snk4_vector_table",
    """SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS width,
              round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 6) AS norm2
       FROM embeddings""",
)
def _(spark, sf):
    path = scratch_path(spark, "vectors")
    writers.write_vectors(table(spark, sf, "embeddings"), path, key="vec_id")
    squares = F.aggregate(
        "embedding", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")
    )
    return writers.read_vectors(spark, path).select(
        "vec_id", "label", F.size("embedding").alias("width"), F.round(squares, 6).alias("norm2")
    )


@query(
    "snk4_join_in_place",
    """SELECT event_id, vec_id, label, len(embedding) AS width FROM events JOIN embeddings ON vec_id = user_id % 1000""",
)
def _(spark, sf):
    # Rows that name a vector go to its bucket; the vectors are not moved.
    path = scratch_path(spark, "vectors")
    writers.write_vectors(table(spark, sf, "embeddings"), path, key="vec_id")
    asked = table(spark, sf, "events").select("event_id", (F.col("user_id") % 1000).alias("vec_id"))
    found = asked.join(writers.read_vectors(spark, path).hint("shuffle_hash"), "vec_id")
    return found.select("event_id", "vec_id", "label", F.size("embedding").cast("long").alias("width"))


@query(
    "snk5_dataset_with_splits",
    f"""SELECT conv_id, turn, text, {SPLIT_SQL.format(k="conv_id")} AS split FROM conversations""",
)
def _(spark, sf):
    path = scratch_path(spark, "dataset")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    writers.write_dataset(turns.withColumn("split", rel.hash_split(F.col("conv_id"), 80)), path)
    return spark.read.parquet(path)


# --- projection and filter ------------------------------------------------


@query("prj1_select", "SELECT o_orderdate::DATE::VARCHAR AS day, o_orderkey, o_orderstatus FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderkey", "o_orderstatus"
    )


@query("prj2_rename", "SELECT o_orderkey AS Id, o_orderpriority AS Text FROM orders")
def _(spark, sf):
    renamed = table(spark, sf, "orders").withColumnsRenamed(
        {"o_orderkey": "Id", "o_orderpriority": "Text"}
    )
    return renamed.select("Id", "Text")


@query("prj3_drop", "SELECT doc_id, quality FROM labels")
def _(spark, sf):
    return table(spark, sf, "labels").drop("toxic")


@query(
    "prj4_overwrite_column",
    "SELECT doc_id, CASE WHEN n_chars > 1000 THEN 'LONG' ELSE 'SHORT' END AS Label FROM documents",
)
def _(spark, sf):
    scored = table(spark, sf, "documents").withColumn("Label", F.lit("NONE"))
    scored = scored.withColumn("Label", F.when(F.col("n_chars") > 1000, "LONG").otherwise("SHORT"))
    return scored.select("doc_id", "Label")


@query("prj5_key_column", "SELECT c_custkey AS Id, c_name, c_mktsegment FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("Id"), "c_name", "c_mktsegment")


@query("prj6_constant_column", "SELECT conv_id, turn, text, 'base_rag' AS source FROM conversations")
def _(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return turns.withColumn("source", F.lit("base_rag"))


@query(
    "flt1_time_lower_bound",
    """SELECT o_orderkey AS Id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS Created
       FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
       UNION ALL
       SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') FROM events
       WHERE ts >= TIMESTAMP '2024-01-15'""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").filter(
        F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    )
    events = table(spark, sf, "events").filter(
        F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    )
    both = rel.union_all(
        orders.select(F.col("o_orderkey").alias("Id"), F.col("o_orderdate").alias("Created")),
        events.select(F.col("event_id").alias("Id"), F.col("ts").alias("Created")),
    )
    return both.select("Id", shown("Created"))


@query(
    "flt2_drop_blank",
    f"""SELECT doc_id, trim(value) AS line FROM ({LINES_SQL}) WHERE trim(value) <> ''""",
)
def _(spark, sf):
    lines = table(spark, sf, "documents").select(
        "doc_id", F.explode(F.split("text", "\n")).alias("line")
    )
    return lines.select("doc_id", strip(F.col("line")).alias("line")).filter("line <> ''")


@query(
    "flt3_suffix_filter",
    "SELECT page_id, url FROM pages WHERE url LIKE '%.html' AND html LIKE '%<html%'",
)
def _(spark, sf):
    pages = table(spark, sf, "pages")
    kept = pages.filter(F.col("url").endswith(".html") & F.col("html").contains("<html"))
    return kept.select("page_id", "url")


# --- joins ----------------------------------------------------------------


@query(
    "jn1_inner_join",
    """SELECT l_orderkey AS Id, o_orderpriority AS Title, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS Created,
              l_linenumber AS CommentId, l_returnflag AS Comment
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, sf):
    posts = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Id"),
        F.col("o_orderpriority").alias("Title"),
        F.col("o_orderdate").alias("Created"),
    )
    comments = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("Id"),
        F.col("l_linenumber").alias("CommentId"),
        F.col("l_returnflag").alias("Comment"),
    )
    joined = rel.inner_join(comments, posts, "Id")
    return joined.select("Id", "Title", shown("Created"), "CommentId", "Comment")


@query(
    "jn1_heavy_join",
    """SELECT e.event_id, e.user_id, t.n AS user_events
       FROM events e JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) t USING (user_id)""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id")
    counts = events.groupBy("user_id").agg(F.count("*").alias("user_events"))
    return rel.heavy_join(events, counts, "user_id", "user_events").select(
        "event_id", "user_id", "user_events"
    )


@query(
    "jn2_complement",
    """SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return rel.complement(docs, table(spark, sf, "labels").select("doc_id"), "doc_id")


LANG_IDS = {"de": 0, "en": 1, "es": 2, "fr": 3}


@query(
    "jn3_label_lookup",
    """SELECT doc_id, CAST(CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2
              WHEN 'fr' THEN 3 END AS INTEGER) AS label FROM documents""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return rel.lookup(docs, LANG_IDS, "lang", "label").select("doc_id", "label")


@query(
    "jn4_questions_by_arms",
    f"""SELECT conv_id, turn, arm, model, retrieval FROM conversations, {ARMS_SQL} WHERE role = 'user'""",
)
def _(spark, sf):
    asked = table(spark, sf, "conversations").filter("role = 'user'").select("conv_id", "turn")
    return rel.with_arms(asked, ARMS)


@query(
    "jn5_new_links",
    """SELECT DISTINCT l_partkey AS node FROM lineitem
       WHERE l_partkey NOT IN (SELECT l_suppkey FROM lineitem)
         AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25)""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    visited = lines.select(F.col("l_suppkey").alias("node")).distinct()
    queued = table(spark, sf, "part").filter("p_size > 25").select(F.col("p_partkey").alias("node"))
    return rel.new_links(lines.select(F.col("l_partkey").alias("node")), visited, queued)


# --- sorts, limits and splits ---------------------------------------------


@query(
    "srt1_newest_first",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders
       ORDER BY orders.o_orderdate DESC, o_orderkey""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return rel.newest_first(orders, "o_orderdate", "o_orderkey").select(
        "o_orderkey", shown("o_orderdate")
    )


@query(
    "srt2_urls_by_depth",
    """SELECT url, length(url) - length(replace(url, '/', '')) AS slashes FROM pages
       ORDER BY 2, length(url), url""",
)
def _(spark, sf):
    urls = table(spark, sf, "pages").select(
        "url", slash_count(F.col("url")).cast("long").alias("slashes")
    )
    return urls.orderBy("slashes", F.length("url"), "url")


@query("lim1_first_rows", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 10")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang").orderBy("doc_id").limit(10)


@query(
    "lim2_cap_list",
    """SELECT doc_id, array_to_string(string_split(text, ' ')[1:3], '|') AS head FROM documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(F.slice(F.split("text", " "), 1, 3), "|").alias("head")
    )


@query(
    "lim3_newest_for_labelling",
    """SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id LIMIT 500""",
)
def _(spark, sf):
    return rel.newest(table(spark, sf, "events"), "ts", "event_id", 500).select(
        "event_id", "event_type"
    )


@query(
    "spl1_split_at_position",
    """SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= 250
                             THEN 'first' ELSE 'rest' END AS part FROM events""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    first, rest = rel.position_split(events, ["ts", "event_id"], 250)
    return rel.union_all(
        first.select("event_id", F.lit("first").alias("part")),
        rest.select("event_id", F.lit("rest").alias("part")),
    )


@query(
    "spl2_exact_sample",
    """WITH h AS (SELECT doc_id, md5('42:' || doc_id) AS m FROM documents),
            r AS (SELECT doc_id, row_number() OVER (ORDER BY substr(m, 1, 15), substr(m, 16, 15)) AS rn,
                         round(0.8 * count(*) OVER ()) AS n FROM h)
       SELECT doc_id, CASE WHEN rn <= n THEN 'train' ELSE 'test' END AS part FROM r""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    train, test = rel.sample_split(docs, "doc_id", 0.8, seed=42)
    return rel.union_all(
        train.select("doc_id", F.lit("train").alias("part")),
        test.select("doc_id", F.lit("test").alias("part")),
    )


@query(
    "spl2_hash_split",
    f"SELECT o_orderkey, {SPLIT_SQL.format(k='o_orderkey')} AS part FROM orders",
)
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", rel.hash_split(F.col("o_orderkey"), 80).alias("part")
    )


# --- set operations -------------------------------------------------------


@query(
    "set1_union_all",
    """SELECT o_orderkey AS Id, o_orderpriority AS Text, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS Created,
              o_orderstatus AS Label FROM orders
       UNION ALL
       SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S'), props FROM events""",
)
def _(spark, sf):
    posts = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Id"),
        F.col("o_orderpriority").alias("Text"),
        F.col("o_orderdate").alias("Created"),
        F.col("o_orderstatus").alias("Label"),
    )
    comments = table(spark, sf, "events").select(
        F.col("event_id").alias("Id"),
        F.col("event_type").alias("Text"),
        F.col("ts").alias("Created"),
        F.col("props").alias("Label"),
    )
    return rel.union_all(posts, comments).withColumn("Created", shown("Created"))


@query(
    "set2_append_documents",
    """SELECT html AS page_content, url AS source, NULL AS category FROM pages
       UNION ALL SELECT text, source, lang FROM documents""",
)
def _(spark, sf):
    web = table(spark, sf, "pages").select(
        F.col("html").alias("page_content"), F.col("url").alias("source")
    )
    files = table(spark, sf, "documents").select(
        F.col("text").alias("page_content"), "source", F.col("lang").alias("category")
    )
    return rel.union_all(web, files)


@query("set3_distinct", "SELECT DISTINCT p_type, p_brand FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_type", "p_brand").distinct()
