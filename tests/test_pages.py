import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from corpusmill.functions import html
from corpusmill.operators import links
from corpusmill.operators import documents as doc
from corpusmill.operators.links import reachable, relevant_urls
from corpusmill.session import shared_dir
from corpusmill.sources import readers, writers


def raw(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id int, html string")


def pages(spark, *html):
    return doc.with_nodes(raw(spark, *html))


def test_regions(spark):
    html = (
        "<html><head><title>t</title><style>p{}</style></head><body><main id='m' class='a b'>One <b>two</b>"
        "<main>in</main><script>var x='</p>';</script><!-- no --></main><p>out &amp; about</p><main>last</main></body></html>"
    )
    df = pages(spark, html, "<p>none</p>")
    text = lambda **s: [r.page_content for r in doc.regions(df, **s).orderBy("page_id").collect()]
    assert text(tag="main") == ["One twoinlast", ""]
    assert text(id="m") == ["One twoin", ""]
    assert text(class_="b") == ["One twoin", ""]
    assert text(class_="a b") == ["One twoin", ""]
    assert text(tag="p") == ["out & about", "none"]
    assert text(class_="missing") == ["", ""]


def test_unclosed_and_void_tags(spark):
    df = pages(spark, "<div><p>a<br>b<p>c</div><img src=x><p>d")
    assert doc.regions(df, tag="p").first().page_content == "abcd"
    assert doc.regions(df, tag="div").first().page_content == "abc"


def test_title_and_every_fallback(spark):
    wp = "wp-block-column"
    cases = [
        "<h1> T <i>x</i></h1><span id='rich-text-generator'><h2>H</h2><p>p1</p><ul><li>l1</li></ul><p> p2 </p></span>",
        "<span id='rich-text-generator'> </span><span class='richText richtext-paragraph-margin'><b>x</b><p>one</p></span>",
        f"<div class='{wp} is-vertically-aligned-center'><p>two</p></div>",
        f"<div class='first {wp}'><p>three</p></div>",
        "<ul><li>four</li><li>five</li></ul>",
        "<p>nothing fits</p>",
        None,
    ]
    got = doc.title_and_description(pages(spark, *cases)).orderBy("page_id").collect()
    assert [(r.title, r.description) for r in got] == [
        ("Tx", "l1\np1\np2\nH"),
        ("No Title Found", "one"),
        ("No Title Found", "two"),
        ("No Title Found", "three"),
        ("No Title Found", "four"),
        ("No Title Found", "No Description Found"),
        ("Error", "Failed to fetch"),
    ]


def test_headed_paragraphs(spark):
    df = raw(spark, "<h2>A</h2><div><p>one</p></div><h2>B</h2><h2>C</h2><p> two </p><h2>D</h2>")
    got = doc.headed_paragraphs(df, "info", "2025-03-31").collect()
    assert [r.page_content for r in got] == ["A: one", "B: two", "C: two", "D: "]
    assert got[0].metadata == {"source": "A", "category": "info", "updated": "2025-03-31"}


def test_section_tree(spark):
    html = (
        "<div><h2>S1</h2>text<p>a</p><ul><li><p>skip</p></li></ul><p>b</p><h3>G1</h3><p>c</p><h3>G2</h3>"
        "<h2>S2</h2><p>d</p></div><p>outside</p><h2>S3</h2>"
    )
    trees = doc.section_trees(raw(spark, html)).collect()
    shape = [(t.title, t.paragraphs, [(g.title, g.paragraphs) for g in t.h3_sections]) for t in trees]
    assert shape == [
        ("S1", ["a", "b"], [("G1", ["c"]), ("G2", [])]),
        ("S2", ["d"], []),
        ("S3", [], []),
    ]
    df = doc.section_trees(raw(spark, html))
    shown = df.select(doc.section_text(F.col("title"), F.col("paragraphs"), F.col("h3_sections")).alias("t"))
    assert shown.first().t == "S1\n\na\nb\n\nG1:\n- c\n\nG2:\n"


def test_headings_of_null_and_empty_pages(spark):
    assert doc.headed_paragraphs(raw(spark, None, "", "<p>no heading</p>"), "c", "u").count() == 0
    assert doc.section_trees(raw(spark, None, "", "<h3>no section</h3><p>x</p>")).count() == 0


def test_headings_take_one_pass():
    """Twice the headings take about twice the time; a filter per heading would take four times."""
    import time

    spent = []
    for n in (4000, 16000):
        page = html._Nodes().result("<div>" + "<h2>T</h2><p>a\nb</p><h3>g</h3><p>c</p>" * n + "</div>")
        start = time.process_time()
        assert len(html._entries(page)) == len(html._sections(page)) == n
        spent.append(time.process_time() - start)
    assert spent[1] < 9 * spent[0]


def test_rules_by_url(spark):
    rules = [("*", "p", None, None), ("*/a", None, "x", None), ("*/a/b", None, None, "k l"), ("h.org", None, None, "k"), ("h.org/z", "p", "x", None)]
    page = "<div id='x'>box</div><p class='k m'>par</p><b class='k l'>bold</b><p id='x'>both</p>"
    urls = ["https://o.org/a/b/c?q=1", "http://o.org/a/", "https://o.org", "https://H.org/a/b", "https://h.org/z/1#f", "https://o.org/ab"]
    df = spark.createDataFrame([(u, page) for u in urls] + [("https://o.org/a", None)], "url string, html string")
    got = [(r.rule, r.page_content) for r in doc.regions_by_rule(df, rules).collect()]
    assert got == [
        ("*/a/b", "bold"),
        ("*/a", "boxboth"),
        ("*", "parboth"),
        ("h.org", "parbold"),
        ("h.org/z", "both"),
        ("*", "parboth"),
        ("*/a", None),
    ]
    none = doc.regions_by_rule(df, rules[1:2]).where("rule is null").select("page_content").distinct().collect()
    assert [r.page_content for r in none] == [None]
    assert "Exchange" not in doc.regions_by_rule(df, rules)._jdf.queryExecution().executedPlan().toString()


def test_out_links(spark):
    html = (
        "<a href=\"/x?a=1&amp;b=2\">1</a><A class='k' HREF='y'>2</A><a href=z>3</a><a name=n>4</a>"
        "<!-- <a href='c'> --><script>'<a href=\"s\">'</script><abbr href='q'>"
    )
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert [r.href for r in doc.out_links(df, "page_id").collect()] == ["/x?a=1&b=2", "y", "z"]


def brute(edges, seeds, max_pages, max_depth):
    seen, level, depth = {}, sorted(set(seeds)), 0
    while level and len(seen) < max_pages and (max_depth is None or depth <= max_depth):
        for url in level[: max_pages - len(seen)]:
            seen[url] = depth
        level = sorted({d for s, d in edges if s in seen} - set(seen))
        depth += 1
    return seen


def test_reachable(spark):
    edges = [(f"p{i}", f"p{(i * 7 + j) % 60}") for i in range(60) for j in (1, 3)] + [("hub", f"h{i}") for i in range(90)]
    edges += [("p8", "hub")]
    df = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([("p0",), ("p0",)], "url string")
    for max_pages, max_depth in [(1000, None), (17, None), (1000, 2), (1, None), (None, None)]:
        got = {r.url: r.depth for r in reachable(df, seeds, max_pages, max_depth).collect()}
        assert got == brute(edges, ["p0"], max_pages or 10**9, max_depth)


def test_relevant_urls(spark):
    site = {
        "https://a.org/": '<a href="/courses/fees">x</a><a href="/news/fees">y</a><a href="https://b.org/courses/fees">z</a>',
        "https://a.org/courses/fees": '<a href="../courses/plan">p</a><a href="/courses/aid">q</a>',
    }
    df = spark.createDataFrame(list(site.items()), "url string, html string")
    seeds = spark.createDataFrame([("https://a.org/",), ("ftp://a.org/course/fees",)], "url string")
    got = relevant_urls(df, seeds, "https://a.org", ["course"], ["fee", "aid"])
    assert sorted(r.url for r in got.collect()) == ["https://a.org/courses/aid", "https://a.org/courses/fees"]


def plain_levels(edges, seeds):
    levels, level = {}, set(seeds)
    depth = 0
    while level:
        levels |= dict.fromkeys(level, depth)
        level = {b for a, b in edges if a in level and a is not None and b is not None} - levels.keys()
        depth += 1
    return levels


def test_a_step_of_a_crawl_moves_only_new_pages(spark, monkeypatch):
    rows = [(f"p{i}", f"p{j}") for i in range(200) for j in (i * 7 % 200, i + 1, i // 2)] + [("p3", f"q{i}") for i in range(900)] + [("q5", None), (None, "z")]
    edges = spark.createDataFrame(rows, "src string, dst string").repartition(4)
    seeds = spark.createDataFrame([("p1",), ("p1",), (None,)], "url string")
    plans, append = [], links.Frontier._append

    def spy(self, level):
        plans.append(level._jdf.queryExecution().executedPlan().toString())
        append(self, level)

    monkeypatch.setattr(links.Frontier, "_append", spy)
    found = links.reachable(edges, seeds)
    assert {r.url: r.depth for r in found.collect()} == plain_levels(rows, ["p1"])
    for plan in plans[1:]:
        # The frontier and the distinct targets are dealt; edges and visited pages stay in their buckets.
        assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Bucketed: true") == 3
        assert "Union" not in plan and "SortMergeJoin" in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("crawl_")]


def test_a_hub_page_is_spread_over_buckets(spark):
    rows = [("hub", f"q{i}") for i in range(4000)] + [(f"q{i}", "hub") for i in range(4000)] + [(f"q{i}", f"r{i}") for i in range(2000)]
    crawl = links.Frontier(spark.createDataFrame(rows, "src string, dst string"), spark.createDataFrame([("hub",)], "url string"))
    try:
        assert [tuple(r) for r in crawl.hot.collect()] == [("hub", 4)]
        salts = spark.table(f"{crawl.name}_edges").where("src = 'hub'").groupBy("salt").count().collect()
        assert len(salts) == 4 and max(r["count"] for r in salts) < 1500
        crawl.step()
        crawl.step()
        assert crawl.sizes == [1, 4000, 2000]
    finally:
        crawl.close()


def test_crawls_without_seeds_and_with_a_page_limit(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "d"), ("b", "e")], "src string, dst string")
    assert links.reachable(edges, spark.createDataFrame([], "url string")).collect() == []
    one = spark.createDataFrame([("a",)], "url string")
    assert sorted(tuple(r) for r in links.reachable(edges, one, max_pages=3).collect()) == [("a", 0), ("b", 1), ("c", 1)]
    assert links.reachable(edges, one, max_pages=1).count() == 1
    assert links.reachable(edges, one, max_depth=1).count() == 4
    assert links.reachable(edges.limit(0), one).count() == 1


@pytest.mark.parametrize("mounted", [True, False])
def test_a_file_per_row(spark, tmp_path, monkeypatch, mounted):
    monkeypatch.setattr(writers, "FOLDER_FILES", 20)
    if not mounted:
        monkeypatch.setattr(writers, "_mounted", lambda *_: False)
    # Equal texts are files of their own, and a null is an empty line; the keys 7 and null come twice, in one task each.
    texts = [f"<p>é {i % 90}\n</p>" for i in range(200)] + ["", "", None]
    keyed = [*enumerate(texts), (7, "again"), (None, "no key"), (None, "no key")]
    rows = spark.createDataFrame(keyed, "page_id long, html string").repartition(3, "page_id")
    site = f"file://{tmp_path}/site"
    writers.write_files(rows, site, "html", "page_id")
    (tmp_path / "site/_0-0-99").mkdir()
    (tmp_path / "site/_0-0-99/part-0.txt").write_text("of an attempt that failed")
    pages = readers.read_pages(spark, site, pattern="*.txt")
    found = [r.html for r in pages.collect()]
    pair = {"<p>é 7\n</p>\nagain\n", "again\n<p>é 7\n</p>\n"} & set(found)
    want = [(t or "") + "\n" for i, t in enumerate(texts) if i != 7] + ["no key\nno key\n"]
    assert sorted(found) == sorted([*want, *pair]) and len(pair) == 1
    folders = [f for f in (tmp_path / "site").iterdir() if f.is_dir() and not f.name.startswith("_")]
    assert not mounted or len(folders) <= 204 // 20 + 3


def test_pages_of_a_table_have_no_folder_each(spark, sf):
    queries()["src7_html_folder"](spark, sf)
    sites = Path(shared_dir(spark).removeprefix("file://")).glob("site-*")
    newest = max(sites, key=lambda f: f.stat().st_mtime)
    assert len([f for f in newest.iterdir() if f.is_dir()]) < 64


def test_small_files_are_read_many_a_task(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).select("id", F.col("id").cast("string").alias("html"))
    writers.write_files(rows, f"file://{tmp_path}/site", "html")
    few = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        pages = readers.read_pages(spark, f"file://{tmp_path}/site", pattern="*.txt")
        assert pages.rdd.getNumPartitions() <= max(1000 // 16, 4 * spark.sparkContext.defaultParallelism)
        assert pages.distinct().count() == 1000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", few)


def test_pages_are_read_as_bytes_and_stay_the_same_text(spark, tmp_path):
    texts = [b"", b"\n", b"<p>\xc3\xa9</p>", b"\xef\xbb\xbfmark", b"a\r\nb\r\n", b"zero \x00 byte", b"not \xff utf-8 \xe9", b"x" * 300_000]
    for i, data in enumerate(texts):
        (tmp_path / f"sub{i % 2}").mkdir(exist_ok=True)
        (tmp_path / f"sub{i % 2}/p{i} \u00e9%20.html").write_bytes(data)
    (tmp_path / "sub0/other.htm").write_bytes(b"no page")
    (tmp_path / "sub0/more.html.gz").write_bytes(gzip.compress(b"packed"))
    rows = lambda df: sorted(tuple(map(bytes, r)) for r in df.select(F.col("file").cast("binary"), F.col("html").cast("binary")).collect())
    pages = readers.read_pages(spark, f"file://{tmp_path}")
    text = spark.read.text(f"file://{tmp_path}", wholetext=True, pathGlobFilter="*.html", recursiveFileLookup=True)
    assert rows(pages) == rows(text.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("html")))
    # Spark has no row for a file without bytes.
    assert len(rows(pages)) == len(texts) - 1 and pages.schema["html"].dataType.simpleString() == "string"
    # The text reader's cost a file is what large folders take most of their time for.
    assert "binaryFile" in pages._jdf.queryExecution().toString()
    assert [r.html for r in readers.read_pages(spark, f"file://{tmp_path}", "*.gz").collect()] == ["packed"]
