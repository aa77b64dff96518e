"""String, URL, date, array, map and JSON columns; prompts and parsing."""

from pyspark.sql import functions as F

from corpusmill.functions import arrays, prompts, text, urls
from corpusmill.operators import aggregates as agg
from corpusmill.operators.documents import out_links
from corpusmill.operators.features import token_ids
from corpusmill.operators.links import filter_sort_urls, with_plurals
from corpusmill.operators.relational import with_arms
from corpusmill.plans.registry import query
from corpusmill.plans.tables import ARMS, ARMS_SQL, LINES_SQL, TIME, courses, COURSES_SQL
from corpusmill.session import spread, table

C = F.col


def docs(spark, sf):
    return table(spark, sf, "documents")


def turns(spark, sf):
    return table(spark, sf, "conversations")


# --- strings --------------------------------------------------------------


@query(
    "str1_clean_paragraphs",
    """SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)),
              lambda x: x <> ''), chr(10) || chr(10)) AS clean FROM documents""",
)
def _(spark, sf):
    return docs(spark, sf).select("doc_id", text.clean_paragraphs(C("text")).alias("clean"))


@query(
    "str2_remove_breaks",
    """SELECT doc_id, trim(replace(replace(replace('a' || chr(160) || chr(9) || text, chr(160), ' '), chr(10), ''), chr(9), '')) AS clean
       FROM documents""",
)
def _(spark, sf):
    padded = F.concat(F.lit("a\xa0\t"), C("text"))
    return docs(spark, sf).select("doc_id", text.remove_breaks(padded).alias("clean"))


@query("str3_strip", "SELECT doc_id, trim(text, ' ' || chr(10) || chr(9) || chr(160)) AS clean FROM documents")
def _(spark, sf):
    padded = F.concat(F.lit("\xa0 \t"), C("text"), F.lit(" \n\xa0"))
    return docs(spark, sf).select("doc_id", text.strip(padded).alias("clean"))


@query(
    "str4_split_list",
    """SELECT doc_id, array_to_string(list_filter(list_transform(string_split(replace(text, '. ', ',,,'), ',,,'),
              lambda x: trim(x, ' ' || chr(10))), lambda x: x <> '')[1:20], '|') AS items FROM documents""",
)
def _(spark, sf):
    listed = F.replace("text", F.lit(". "), F.lit(",,,"))
    items = text.split_list(listed, limit=20)
    return docs(spark, sf).select("doc_id", F.array_join(items, "|").alias("items"))


@query("str5_ascii_only", "SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', ' ', 'g') AS ascii FROM documents")
def _(spark, sf):
    return docs(spark, sf).select("doc_id", text.ascii_only(C("text")).alias("ascii"))


GUIDE_SQL = prompts.GUIDE.replace("'", "''")
READER_SQL = prompts.READER.replace("'", "''")


@query(
    "str6_after_last_answer",
    """SELECT conv_id, turn, question, trim(answer, ' ' || chr(10)) AS answer FROM (
           SELECT conv_id, turn, role, text AS question, lead(role) OVER w AS next_role, lead(text) OVER w AS answer
           FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
       WHERE role = 'user' AND next_role = 'assistant'""",
)
def _(spark, sf):
    pairs = agg.answer_pairs(turns(spark, sf))
    said = F.concat(prompts.plain(C("question")), F.lit(" "), C("answer"))
    return pairs.select("conv_id", "turn", "question", text.after_last(said, "Answer:").alias("answer"))


@query(
    "str7_transcript_parts",
    """SELECT doc_id, trim(text, ' ' || chr(10)) AS context, source AS question, lang AS answer FROM documents""",
)
def _(spark, sf):
    transcript = F.concat(prompts.with_headers(C("source"), C("text")), C("lang"))
    parts = docs(spark, sf).select("doc_id", text.transcript_parts(transcript).alias("p"))
    return parts.select("doc_id", "p.*")


# Judge texts derived from events: brackets, no brackets, or a missing line.
JUDGE_SQL = """'Accuracy: [' || (1 + user_id % 5) || ']' || chr(10) ||
    CASE WHEN event_type = 'error' THEN '' ELSE 'Relevance: ' || (1 + event_id % 5) || chr(10) END ||
    'Groundedness: [' || (1 + event_id % 3) || ']' || chr(10) || 'Evaluation: fine'"""


def judge_text():
    return F.concat(
        F.lit("Accuracy: ["),
        (C("user_id") % 5 + 1).cast("string"),
        F.lit("]\n"),
        F.when(C("event_type") == "error", "").otherwise(
            F.concat(F.lit("Relevance: "), (C("event_id") % 5 + 1).cast("string"), F.lit("\n"))
        ),
        F.lit("Groundedness: ["),
        (C("event_id") % 3 + 1).cast("string"),
        F.lit("]\nEvaluation: fine"),
    )


def score_sql(keyword):
    return f"TRY_CAST(nullif(regexp_extract(t, '{keyword}: \\[?(\\d+)', 1), '') AS INTEGER)"


@query(
    "str8_bracket_scores",
    f"""WITH j AS (SELECT event_id, {JUDGE_SQL} AS t FROM events)
        SELECT event_id, {score_sql("Accuracy")} AS accuracy, {score_sql("Relevance")} AS relevance,
               {score_sql("Groundedness")} AS groundedness FROM j""",
)
def _(spark, sf):
    judged = table(spark, sf, "events").select("event_id", judge_text().alias("t"))
    return judged.select(
        "event_id", *[text.bracket_score(C("t"), k).alias(k.lower()) for k in text.CRITERIA]
    )


QUESTION_SQL = """CASE role WHEN 'user' THEN 'Query: ' || text || ' Section: Beginning'
    WHEN 'assistant' THEN 'from the MIDDLE: ' || text ELSE text END"""


def asked_text():
    return (
        F.when(C("role") == "user", F.concat(F.lit("Query: "), "text", F.lit(" Section: Beginning")))
        .when(C("role") == "assistant", F.concat(F.lit("from the MIDDLE: "), "text"))
        .otherwise(C("text"))
    )


@query(
    "str9_parse_question",
    f"""WITH q AS (SELECT conv_id, turn, {QUESTION_SQL} AS t FROM conversations)
        SELECT conv_id, turn,
               trim(string_split(string_split(t, 'Query:')[-1], 'Section:')[1], ' ' || chr(10)) AS query,
               CASE WHEN contains(lower(t), 'beginning') THEN 'beginning'
                    WHEN contains(lower(t), 'middle') THEN 'middle' ELSE 'end' END AS section FROM q""",
)
def _(spark, sf):
    parsed = turns(spark, sf).select("conv_id", "turn", text.parse_question(asked_text()).alias("q"))
    return parsed.select("conv_id", "turn", "q.query", "q.section")


@query(
    "str10_prompts",
    f"""SELECT doc_id,
          'Context: ' || text || chr(10) || 'Question: ' || source || chr(10) || '{GUIDE_SQL}' || ' Answer:' AS plain,
          'Question: ' || source || chr(10) || '{GUIDE_SQL}' || ' Answer:' AS bare,
          '<|begin_of_text|>{prompts.SYSTEM_HEADER}' || chr(10) || '{READER_SQL}' || chr(10) || '<|eot_id|>{text.USER_HEADER}'
             || chr(10) || chr(10) || 'Context:' || chr(10) || text || chr(10) || chr(10) || 'Question: ' || source
             || '<|eot_id|>{text.ASSISTANT_HEADER}' || chr(10) AS headers,
          '<|system|>' || chr(10) || '{READER_SQL}' || chr(10) || '<|user|>' || chr(10) || source || chr(10)
             || '<|assistant|>' || chr(10) || lang AS chat,
          'system|{READER_SQL}|user|' || source AS roles,
          'List 10 questions about ' || source || '. Separate the entries by three commas (,,,) and write nothing else.' AS listing
        FROM documents""",
)
def _(spark, sf):
    question, context = C("source"), C("text")
    roles = F.transform(
        prompts.role_list(question), lambda m: F.concat(m["role"], F.lit("|"), m["content"])
    )
    return docs(spark, sf).select(
        "doc_id",
        prompts.plain(question, context).alias("plain"),
        prompts.plain(question).alias("bare"),
        prompts.with_headers(question, context).alias("headers"),
        prompts.chat_line(question, C("lang")).alias("chat"),
        F.array_join(roles, "|").alias("roles"),
        prompts.list_request("questions", question, 10).alias("listing"),
    )


@query(
    "str11_optional_clause",
    """SELECT conv_id, turn, 'Answer the following question' || coalesce(' regarding ' || CASE WHEN role <> 'system' THEN role END, '')
          || ' in a complete but short way.' || chr(10) || chr(10) || 'Question: ' || text || chr(10) || chr(10) || 'Answer:' AS prompt
       FROM conversations""",
)
def _(spark, sf):
    topic = F.when(C("role") != "system", C("role"))
    return turns(spark, sf).select(
        "conv_id", "turn", prompts.answer_request(C("text"), topic).alias("prompt")
    )


IRREGULAR_SQL = " ".join(f"WHEN k = '{one}' THEN '{many}'" for one, many in text.IRREGULAR.items())


@query(
    "str12_keyword_plurals",
    f"""WITH w AS (SELECT DISTINCT unnest(string_split(lower(p_type || ' ' || p_name), ' ')) AS k FROM part),
       p AS (SELECT CASE {IRREGULAR_SQL} WHEN regexp_matches(k, 'sis$') THEN regexp_replace(k, 'is$', 'es') WHEN regexp_matches(k, '[^aeiou]y$') THEN regexp_replace(k, 'y$', 'ies')
                         WHEN regexp_matches(k, '(s|x|z|ch|sh)$') THEN k || 'es' ELSE k || 's' END AS keyword FROM w WHERE k <> '')
       SELECT k AS keyword FROM w WHERE k <> '' UNION SELECT keyword FROM p""",
)
def _(spark, sf):
    named = F.lower(F.concat_ws(" ", "p_type", "p_name"))
    words = table(spark, sf, "part").select(F.explode(F.split(named, " ")).alias("keyword"))
    return with_plurals(words.filter("keyword <> ''"))


KEYWORDS = ["en", "de", "7"]


@query(
    "str13_contains_any",
    "SELECT page_id, contains(url, 'en') OR contains(url, 'de') OR contains(url, '7') AS hit FROM pages",
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.contains_any(C("url"), KEYWORDS).alias("hit"))


@query("str14_labelled_text", f"WITH c AS ({COURSES_SQL}) SELECT page_id, title || ': ' || description AS page_content FROM c")
def _(spark, sf):
    return courses(spark, sf).select(
        "page_id", text.labelled(C("title"), C("description")).alias("page_content")
    )


@query(
    "str15_source_from_file",
    "SELECT doc_id, source || '_' || lang AS arm FROM documents",
)
def _(spark, sf):
    name = F.concat(F.lit("results_"), "source", F.lit("_"), "lang", F.lit(".csv"))
    return docs(spark, sf).select("doc_id", text.source_from_file(name).alias("arm"))


# --- URLs -----------------------------------------------------------------


@query(
    "url1_is_valid",
    "SELECT page_id, regexp_matches(url, '^https?:') AND contains(url, 'example.net') AS valid FROM pages",
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.is_valid(C("url"), "example.net").alias("valid"))


HREF_SQL = """SELECT page_id, url, unnest(regexp_extract_all(
    regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<script.*?</script>', '', 'g'),
    '(?is)<a\\s[^>]*?href="([^"]*)"', 1)) AS href FROM pages"""


@query(
    "url2_resolve",
    f"""WITH l AS ({HREF_SQL})
        SELECT page_id, href, regexp_extract(url, '^(https?://[^/]*)', 1) || href AS link FROM l""",
)
def _(spark, sf):
    links = out_links(table(spark, sf, "pages"), "page_id", "url")
    return links.select("page_id", "href", urls.resolve(C("url"), C("href")).alias("link"))


PATH_SQL = "trim(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/')"


@query(
    "url3_segments",
    f"""SELECT page_id, lower(string_split({PATH_SQL}, '/')[1]) AS first, lower(string_split({PATH_SQL}, '/')[-1]) AS last
        FROM pages""",
)
def _(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        urls.first_segment(C("url")).alias("first"),
        urls.last_segment(C("url")).alias("last"),
    )


@query(
    "url4_relevant",
    f"""WITH s AS (SELECT url, lower(string_split({PATH_SQL}, '/')[1]) AS a, lower(string_split({PATH_SQL}, '/')[-1]) AS b FROM pages)
        SELECT url FROM s WHERE (contains(a, 'en') OR contains(a, 'fr')) AND (contains(b, '7') OR contains(b, 'html'))""",
)
def _(spark, sf):
    pages = table(spark, sf, "pages").select("url")
    return pages.filter(urls.is_relevant(C("url"), ["en", "fr"], ["7", "html"]))


@query(
    "url5_filter_normalise_sort",
    """WITH k AS (SELECT url, string_split(rtrim(url, '/'), '/')[-1] AS last FROM pages),
       n AS (SELECT DISTINCT lower(regexp_extract(url, '^([a-zA-Z]+)://', 1)) || '://' || lower(regexp_extract(url, '://([^/?#]*)', 1))
                 || lower(rtrim(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/')) AS url
             FROM k WHERE NOT contains(last, '#') AND NOT contains(last, '-'))
       SELECT url FROM n ORDER BY length(url) - length(replace(url, '/', '')), length(url), url""",
)
def _(spark, sf):
    return filter_sort_urls(table(spark, sf, "pages"))


# --- dates and numbers ----------------------------------------------------


@query("dat1_year", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))


@query(
    "dat2_parse_and_compare",
    """SELECT event_id, ts >= TIMESTAMP '2024-01-15' AS recent FROM events""",
)
def _(spark, sf):
    written = table(spark, sf, "events").select("event_id", F.date_format("ts", TIME).alias("Created"))
    parsed = written.withColumn("Created", F.to_timestamp_ntz("Created", F.lit(TIME)))
    recent = C("Created") >= F.lit("2024-01-15").cast("timestamp_ntz")
    return parsed.select("event_id", recent.alias("recent"))


@query("dat3_constant_date", "SELECT doc_id, source, '2025-03-31' AS updated FROM documents")
def _(spark, sf):
    metadata = F.create_map(F.lit("source"), C("source"), F.lit("updated"), F.lit("2025-03-31"))
    tagged = docs(spark, sf).select("doc_id", metadata.alias("metadata"))
    return tagged.select("doc_id", "metadata.source", "metadata.updated")


@query(
    "mth1_ratio",
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice / nullif(l_discount, 0), 3) AS ratio FROM lineitem",
)
def _(spark, sf):
    ratio = F.round(F.try_divide("l_extendedprice", "l_discount"), 3)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", ratio.alias("ratio"))


# --- arrays, maps, JSON ---------------------------------------------------


@query(
    "arr1_explode_positions",
    """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS v FROM documents)
       SELECT doc_id, CAST(unnest(range(len(v))) AS INTEGER) AS pos, unnest(v) AS line FROM l""",
)
def _(spark, sf):
    return docs(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


WORD_SQL = "[\\p{L}\\p{N}_]{2,}"
IDS_SQL = (
    f"list_transform(regexp_extract_all(lower(text), '{WORD_SQL}'), "
    "lambda w: CAST(CAST('0x' || substr(md5(w), 1, 7) AS BIGINT) % 30000 AS INTEGER) + 1)"
)


@query(
    "arr3_pad_or_cut",
    f"""WITH t AS (SELECT doc_id, {IDS_SQL} AS ids FROM documents)
        SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(128), lambda i: 0))[1:128], ',') AS ids,
               CAST(least(len(ids), 128) AS BIGINT) AS used FROM t""",
)
def _(spark, sf):
    ids = token_ids(C("text"), 30000)
    tokens = spread(docs(spark, sf), "doc_id").select("doc_id", ids.alias("raw"))
    return tokens.select(
        "doc_id",
        F.array_join(arrays.pad_or_cut(C("raw"), 128), ",").alias("ids"),
        F.aggregate(
            arrays.attention_mask(C("raw"), 128), F.lit(0).cast("long"), lambda t, x: t + x
        ).alias("used"),
    )


@query(
    "arr4_last_message",
    "SELECT conv_id, arg_max(text, turn) AS last_text FROM conversations GROUP BY conv_id",
)
def _(spark, sf):
    return agg.last_message(turns(spark, sf), "conv_id", "turn", "text")


@query(
    "map1_metadata",
    f"""WITH l AS ({LINES_SQL.replace("doc_id,", "doc_id, source, lang, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i,")})
        SELECT doc_id, source, lang AS category, CAST(i AS VARCHAR) AS chunk_index FROM l""",
)
def _(spark, sf):
    metadata = F.create_map(F.lit("source"), C("source"), F.lit("category"), C("lang"))
    lines = docs(spark, sf).select(
        "doc_id", metadata.alias("m"), F.posexplode(F.split("text", "\n")).alias("i", "line")
    )
    tagged = lines.select("doc_id", arrays.with_key(C("m"), "chunk_index", C("i")).alias("m"))
    return tagged.select("doc_id", "m.source", "m.category", "m.chunk_index")


@query(
    "jsn1_json_list",
    """SELECT event_id, event_type || '|' || json_extract_string(props, '$.k') AS items FROM events""",
)
def _(spark, sf):
    answer = F.concat(
        F.lit("Here you go:\n["),
        F.to_json(F.struct(C("event_type").alias("e"))).substr(F.lit(6), F.length("event_type") + 2),
        F.lit(", "),
        F.get_json_object("props", "$.k"),
        F.lit("]\nAnything else?"),
    )
    return table(spark, sf, "events").select(
        "event_id", F.array_join(text.json_list(answer), "|").alias("items")
    )


@query(
    "jsn2_checked_search",
    """SELECT conv_id, turn, text AS query, CASE role WHEN 'user' THEN 'beginning' ELSE 'end' END AS section
       FROM conversations WHERE role <> 'system'""",
)
def _(spark, sf):
    section = F.when(C("role") == "user", "beginning").when(C("role") == "assistant", "end")
    raw = F.to_json(F.struct(C("text").alias("query"), F.coalesce(section, F.lit("nowhere")).alias("section")))
    parsed = turns(spark, sf).select("conv_id", "turn", text.checked_search(raw).alias("s"))
    return parsed.filter("s IS NOT NULL").select("conv_id", "turn", "s.query", "s.section")


@query(
    "win5_step_record",
    f"""SELECT conv_id, turn, trim(text, ' ' || chr(10)) AS analyze_query, arm AS retrieve, upper(arm) AS generate
        FROM conversations, {ARMS_SQL} WHERE role = 'user'""",
)
def _(spark, sf):
    asked = with_arms(turns(spark, sf).filter("role = 'user'"), ARMS)
    # The three steps of a question are columns of its row, in their fixed order.
    return asked.select(
        "conv_id",
        "turn",
        text.strip(C("text")).alias("analyze_query"),
        C("arm").alias("retrieve"),
        F.upper("arm").alias("generate"),
    )
