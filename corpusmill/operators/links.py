"""Bounded breadth-first expansion over a link table."""

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusmill.functions import urls
from corpusmill.functions.text import plural
from corpusmill.operators.documents import out_links
from corpusmill.session import scratch_path, written


class Frontier:
    """Edges and visited pages as bucketed tables, so that a step of a crawl moves only its new pages.

    Edges are dealt by source page once, and are never moved again; those of a page that holds more than a bucket's share
    are dealt by salt as well. Visited pages are dealt by URL, one partition of the table per depth, and levels are
    appended. A step is one job: the newest level meets the edges, the distinct targets are dealt by URL, and those that
    the visited table has are dropped where they lie. The tables are names in the session's catalogue for files in the
    shared folder; `close` forgets the names.
    """

    def __init__(self, edges: DataFrame, seeds: DataFrame):
        self.spark = edges.sparkSession
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"crawl_{uuid.uuid4().hex}"
        self.path = scratch_path(self.spark, "visited")
        raw = written(edges.select("src", "dst").where("src is not null and dst is not null"), "edges")
        counts = raw.groupBy("src").agg(F.count("*").alias("n"))
        share = F.greatest(F.lit(1.0), F.lit(raw.count() / self.buckets))
        # A page can hold more than a bucket's share at most `buckets` times.
        hot = counts.where(F.col("n") > share).select("src", F.ceil(F.col("n") / share).cast("int").alias("salts"))
        self.hot = written(hot, "hot")
        salted = raw.join(F.broadcast(self.hot), "src", "left")
        salt = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int"), F.lit(0))
        dealt = salted.select("src", salt.alias("salt"), "dst").repartition(self.buckets, "src", "salt")
        self._save(dealt, "edges", scratch_path(self.spark, "edges"), "src", "salt")
        self.sizes = []
        self._append(seeds.select("url").where("url is not null").distinct())

    def _save(self, rows, kind, path, *columns, **options):
        rows.write.mode("append").format("parquet").options(path=path).bucketBy(self.buckets, *columns).saveAsTable(f"{self.name}_{kind}", **options)

    def _append(self, level):
        counted = Observation()
        rows = level.withColumn("depth", F.lit(len(self.sizes))).observe(counted, F.count(F.lit(1)).alias("n"))
        self._save(rows, "visited", self.path, "url", partitionBy="depth")
        self.sizes.append(counted.get["n"])

    def step(self):
        """Append the pages that the newest level links to and no level has."""
        visited = self.spark.table(f"{self.name}_visited")
        level = visited.where(F.col("depth") == len(self.sizes) - 1)
        salts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
        asked = level.join(F.broadcast(self.hot), F.col("url") == F.col("src"), "left").select(F.col("url").alias("src"), F.explode(salts).alias("salt"))
        out = self.spark.table(f"{self.name}_edges").join(asked.hint("shuffle_hash"), ["src", "salt"], "left_semi")
        targets = out.select(F.col("dst").alias("url")).distinct()
        self._append(targets.join(visited.select("url").hint("merge"), "url", "left_anti"))

    def pages(self, depth=None):
        """(url, depth) of the visited pages, or of one level."""
        kind = self.spark.table(f"{self.name}_visited").schema["url"].dataType.simpleString()
        if not any(self.sizes):
            return self.spark.createDataFrame([], f"url {kind}, depth int")
        rows = self.spark.read.parquet(self.path).select("url", F.col("depth").cast("int").alias("depth"))
        return rows if depth is None else rows.where(F.col("depth") == depth)

    def close(self):
        for kind in ("edges", "visited"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{kind}")


def reachable(edges: DataFrame, seeds: DataFrame, max_pages=None, max_depth=None) -> DataFrame:
    """(url, depth) of the pages reached from `seeds` over `edges(src, dst)`.

    One job per depth. Levels are complete, except that the last one is cut, in URL order, when it would exceed
    `max_pages` (None: no limit). Levels are written, so lost executors cost a read and plans stay short. Null links and
    seeds lead nowhere.
    """
    crawl = Frontier(edges, seeds)
    try:
        while crawl.sizes[-1] and (max_pages is None or sum(crawl.sizes) < max_pages) and (max_depth is None or len(crawl.sizes) <= max_depth):
            crawl.step()
        if max_pages is None or sum(crawl.sizes) <= max_pages:
            return crawl.pages()
        last = len(crawl.sizes) - 1
        left = max_pages - sum(crawl.sizes[:-1])
        return crawl.pages().where(F.col("depth") < last).unionByName(crawl.pages(last).orderBy("url").limit(left))
    finally:
        crawl.close()


def filter_sort_urls(df: DataFrame, column="url") -> DataFrame:
    """Distinct normal forms of URLs with a plain last part, shallow and short ones first."""
    kept = df.filter(urls.has_plain_last_part(F.col(column)))
    unique = kept.select(urls.normal_form(F.col(column)).alias(column)).distinct()
    return unique.orderBy(urls.slash_count(F.col(column)), F.length(column), column)


def with_plurals(keywords: DataFrame, column="keyword") -> DataFrame:
    """Distinct keywords and their plurals; the plural rule runs once per distinct word."""
    word = F.col(column)
    both = F.explode(F.array(word, plural(word))).alias(column)
    return keywords.select(column).distinct().select(both).distinct()


def link_edges(pages: DataFrame, base: str) -> DataFrame:
    """(src, dst) of all valid links of `pages(url, html)`."""
    links = out_links(pages, "url")
    edges = links.select(
        F.col("url").alias("src"), urls.resolve(F.col("url"), F.col("href")).alias("dst")
    )
    return edges.filter(urls.is_valid(F.col("dst"), base))


def relevant_urls(pages, seeds, base, first_keywords, last_keywords, max_pages=None) -> DataFrame:
    """Pages reached from the seeds whose first and last path segments match the keywords; invalid seeds are refused."""
    valid = seeds.filter(urls.is_valid(F.col("url"), base))
    found = reachable(link_edges(pages, base), valid, max_pages).select("url")
    return found.filter(urls.is_relevant(F.col("url"), first_keywords, last_keywords))
