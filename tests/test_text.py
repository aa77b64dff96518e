from urllib.parse import urljoin, urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import arrays, prompts, text, urls
from corpusmill.sources import readers, writers


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t")).alias("r")).first().r


def test_strip_takes_all_unicode_space(spark):
    value = "\x1c  　\x85 a b \t\x1f "
    assert one(spark, text.strip, value) == value.strip() == "a b"


def test_remove_breaks(spark):
    assert one(spark, text.remove_breaks, " a\nb\tc\xa0d\xa0") == "abc d"


def test_ascii_only_one_space_per_character(spark):
    assert one(spark, text.ascii_only, "é😀x") == "  x"


def test_paragraphs(spark):
    assert one(spark, text.clean_paragraphs, " a \n\n\n b\n") == "a\n\nb"


def test_split_list(spark):
    assert one(spark, lambda c: text.split_list(c, 2), " a,,, ,,,b c,,,d") == ["a", "b c"]


@pytest.mark.parametrize(
    "value,want",
    [("Accuracy: [4]\nRelevance: 3", 4), ("Accuracy: 10", 10), ("Relevance: [1]", None), ("", None),
     ("Accuracy: [2] Accuracy: [5]", 2), ("Accuracy: [99999999999]", None)],
)
def test_bracket_score(spark, value, want):
    assert one(spark, lambda c: text.bracket_score(c, "Accuracy"), value) == want


def test_transcript(spark):
    df = spark.createDataFrame([(1, "some\n\ncontext", "what?")], "i int, c string, q string")
    prompt = F.concat(prompts.with_headers(F.col("q"), F.col("c")), F.lit(" yes\nno "))
    got = df.select(text.transcript_parts(prompt).alias("p")).first().p
    assert tuple(got) == ("some\n\ncontext", "what?", "yes\nno")
    assert tuple(one(spark, text.transcript_parts, "nothing here")) == ("", "", "")


def test_question(spark):
    got = one(spark, text.parse_question, "Query: a Query: fees Section: MIDDLE Section: x")
    assert tuple(got) == ("fees", "middle")
    assert tuple(one(spark, text.parse_question, "What?")) == ("What?", "end")


def test_plural(spark):
    words = {"city": "cities", "class": "classes", "fee": "fees", "day": "days", "branch": "branches", "criterion": "criteria", "thesis": "theses", "bus": "buses"}
    for word, want in words.items():
        assert one(spark, text.plural, word) == want


def test_json(spark):
    assert one(spark, text.json_list, 'Sure!\n["a",\n"b"] bye') == ["a", "b"]
    assert one(spark, text.json_list, "no list") is None
    assert one(spark, text.checked_search, '{"query": "x", "section": "nowhere"}') is None
    assert tuple(one(spark, text.checked_search, '{"query": "x", "section": "end"}')) == ("x", "end")


def test_topic_rows(spark):
    lines = spark.createDataFrame([(v,) for v in ["Topic,Question", "a, b, c ", "alone", "", "x,", "y , z"]], "value string")
    got = [(r.topic, r.question) for r in readers.topic_rows(lines).collect()]
    assert got == [("a", "b, c"), ("y", "z")]


URLS = [
    "https://a.org/x/y.html?q=1#f", "http://a.org", "https://A.org/B/C/", "ftp://a.org/x", "mailto:x@y.z",
    "https://a.org/p;v=1", "https://a.org/a-b/c", "https://a.org/x?u=a-b", "/only/path", "https://a.org/d/#top",
]


@pytest.mark.parametrize("url", URLS)
def test_url_parts(spark, url):
    parsed = urlparse(url)
    assert one(spark, urls.scheme, url) == parsed.scheme
    assert one(spark, urls.path, url) == parsed.path or parsed.scheme == "mailto"
    segments = parsed.path.strip("/").split("/")
    if parsed.scheme != "mailto":
        assert one(spark, urls.first_segment, url) == segments[0].lower()
        assert one(spark, urls.last_segment, url) == segments[-1].lower()
    if parsed.netloc:
        want = urlunparse((parsed.scheme, parsed.netloc.lower(), parsed.path.rstrip("/").lower(), "", "", ""))
        assert one(spark, urls.normal_form, url) == want


@pytest.mark.parametrize("base", ["https://a.org", "https://a.org/x/y/z.html?q=1#f", "http://a.org/dir/"])
@pytest.mark.parametrize(
    "href",
    ["", "b.html", "./b", "../b", "../../../b/", "/abs/./p/../q", "//h.org/x", "http://h.org/y", "#top", "?p=2",
     "c/d?x=1#y", "mailto:a@b.c", "..", "."],
)
def test_resolve(spark, base, href):
    df = spark.createDataFrame([(base, href)], "b string, h string")
    got = df.select(urls.resolve(F.col("b"), F.col("h")).alias("r")).first().r
    base = "https://a.org/" if base == "https://a.org" else base
    want = urljoin(base, href) if href else base.split("#")[0]
    assert got.rstrip("/") == want.rstrip("/")


def test_empty_path_is_not_relevant(spark):
    assert one(spark, lambda u: urls.is_relevant(u, ["a"], ["a"]), "https://a.org/") is False


@pytest.mark.parametrize("n", [0, 1, 40, 60, 61, 100, 101, 141])
def test_fixed_windows(spark, n):
    value = "".join(chr(97 + i % 26) for i in range(n))
    got = one(spark, lambda c: arrays.fixed_windows(c, 60, 20), value)
    assert all(len(w) == 60 for w in got[:-1])
    assert "".join([got[0], *(w[20:] for w in got[1:])] if got else []) == value


def test_pad_mask_argmax_map(spark):
    df = spark.createDataFrame([([3, 9, 9], {"a": "1", "chunk_index": "0"})], "v array<int>, m map<string,string>")
    got = df.select(
        arrays.pad_or_cut(F.col("v"), 5).alias("p"),
        arrays.pad_or_cut(F.col("v"), 2).alias("c"),
        arrays.attention_mask(F.col("v"), 5).alias("k"),
        arrays.argmax(F.col("v")).alias("x"),
        arrays.with_key(F.col("m"), "chunk_index", F.lit(7)).alias("m"),
    ).first()
    assert got.p == [3, 9, 9, 0, 0] and got.c == [3, 9] and got.k == [1, 1, 1, 0, 0] and got.x == 1
    assert got.m == {"a": "1", "chunk_index": "7"}


def test_decoding(spark, tmp_path):
    (tmp_path / "u.txt").write_bytes("né 😀\nb".encode("utf-8"))
    (tmp_path / "l.txt").write_bytes("né".encode("latin-1"))
    whole = {r.path.rsplit("/", 1)[1]: r.text for r in readers.read_files_decoded(spark, str(tmp_path)).collect()}
    assert whole == {"u.txt": "né 😀\nb", "l.txt": "né"}
    lines = sorted((r.file, r.value) for r in readers.read_lines_decoded(spark, str(tmp_path)).collect())
    assert lines == [("l.txt", "né"), ("u.txt", "b"), ("u.txt", "né 😀")]


def test_csv_keeps_awkward_text(spark, tmp_path):
    values = ['a "quoted", text', "two\nlines", "", None, "  padded ", "\\back", 'ends with "']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    writers.write_csv(df, str(tmp_path / "x"))
    back = readers.read_csv(spark, str(tmp_path / "x"), "i int, t string")
    assert [r.t for r in back.orderBy("i").collect()] == values


def test_results_folder_of_plain_files(spark, tmp_path):
    (tmp_path / "results_base.csv").write_text("query,answer\nq1,a1\n")
    (tmp_path / "results_tuned_rag.csv").write_text("query,answer\nq2,a2\n")
    (tmp_path / "notes.txt").write_text("skip me")
    got = readers.read_results(spark, str(tmp_path), "query string, answer string").collect()
    assert sorted((r.query, r.answer, r.source) for r in got) == [("q1", "a1", "base"), ("q2", "a2", "tuned_rag")]


def test_page_parts_in_order_are_the_page(spark, tmp_path):
    df = spark.createDataFrame([(i, f"T{i}", f"D{i}") for i in range(50)], "k long, t string, d string").repartition(7)
    writers.write_page(writers.course_page_lines(df, "k", "t", "d", "All"), str(tmp_path / "page"))
    parts = sorted((tmp_path / "page").glob("part-*"))
    page = "".join(p.read_text() for p in parts).replace("\n", "")
    assert page == "<html><body><h1>All</h1>" + "".join(f"<h2>T{i}</h2><p>D{i}</p>" for i in range(50)) + "</body></html>"


def test_the_encoding_of_a_file_is_that_of_all_its_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("Ã¤\nstraße\n".encode("latin-1"))
    (tmp_path / "b.txt").write_bytes("Ã¤\nstraße\n".encode())
    (tmp_path / "c.txt").write_bytes(b"plain\n\nlast")
    (tmp_path / "d.txt").write_bytes(b"")
    got = sorted(tuple(r) for r in readers.read_files_by_encoding(spark, str(tmp_path), "*.txt").collect())
    assert got == [("a.txt", "straße"), ("a.txt", "Ã¤"), ("b.txt", "straße"), ("b.txt", "Ã¤"), ("c.txt", ""), ("c.txt", "last"), ("c.txt", "plain")]
    # The lines of a large file are read in splits, none of which holds the file.
    (tmp_path / "big.log").write_bytes("é line\n".encode("latin-1") * 40_000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        big = readers.read_files_by_encoding(spark, str(tmp_path), "*.log")
        assert big.where("value = 'é line'").count() == 40_000
        assert spark.read.text(str(tmp_path / "big.log")).rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_results_of_one_write_keep_their_sources(spark, tmp_path):
    rows = [("q", "a", "base"), ("q", "line\nbreak", "tuned 50%/x+y")]
    writers.write_csv(spark.createDataFrame(rows, "query string, answer string, results string"), str(tmp_path / "r"), by="results")
    got = readers.read_results(spark, str(tmp_path / "r"), "query string, answer string")
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows)


def test_vectors_are_not_moved_by_a_join_on_their_key(spark, tmp_path):
    rows = spark.range(500).selectExpr("id", "array(cast(id as float), 1f) AS vector", "map('source', 's') AS metadata", "concat('t', id) AS text")
    path = str(tmp_path / "v")
    writers.write_vectors(rows, path)
    table, names = writers.read_vectors(spark, path), spark.catalog.listTables()
    assert not [t for t in names if t.name.startswith("vectors_")]
    assert table.columns == rows.columns and sorted(map(str, table.collect())) == sorted(map(str, rows.collect()))
    asked = spark.range(100).select((F.col("id") * 3).alias("id"))
    joined = table.join(asked.hint("shuffle_hash"), "id")
    assert joined.count() == 100
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert "Exchange" not in table.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    # Readers that know nothing of the layout see the rows alone.
    assert spark.read.parquet(path).count() == 500
