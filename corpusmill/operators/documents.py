"""Web pages to documents: regions, title and description, section trees, links."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import html as h
from corpusmill.functions import urls
from corpusmill.functions.text import labelled

COMMENT_OR_SCRIPT = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
LINK = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""


def with_nodes(pages: DataFrame, html="html") -> DataFrame:
    return pages.withColumn("nodes", h.nodes(html)).drop(html)


def regions(pages: DataFrame, **selector) -> DataFrame:
    """Text of the outermost elements that match a tag, id or class, one document per page.

    Pages without a match give an empty document.
    """
    found = h.outermost(F.filter("nodes", lambda n: h.matches(n, **selector)))
    parts = F.transform(found, lambda n: h.raw_text(h.inside(F.col("nodes"), n)))
    return pages.withColumn("page_content", F.array_join(parts, "")).drop("nodes")


#: A rule table of at most this many rows is part of the plan.
MOST_RULES = 2000


def rule_of(url: Column, rules: list[tuple]) -> Column:
    """The rule (prefix, tag, id, class) of a URL: the longest prefix of its host and path that has one, first with the
    URL's own host, then with the host `*`; null when no rule fits."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules; split the pages by site")
    if len({r[0] for r in rules}) < len(rules):
        raise ValueError("two rules for one prefix")
    fields = ("prefix", "tag", "id", "class")
    entry = lambda rule: F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(fields, rule)])
    table = F.create_map(*[x for rule in rules for x in (F.lit(rule[0]), entry(rule))])
    parts = F.filter(F.split(urls.path(url), "/"), lambda p: p != "")
    lengths = F.sequence(F.size(parts), F.lit(0), F.lit(-1))
    under = lambda host: F.transform(lengths, lambda n: F.array_join(F.concat(F.array(host), F.slice(parts, 1, n)), "/"))
    names = F.concat(under(F.lower(urls.host(url))), under(F.lit("*")))
    known = F.array(*[F.lit(rule[0]) for rule in rules])
    return F.try_element_at(table, F.get(F.filter(names, lambda name: F.array_contains(known, name)), 0))


def regions_by_rule(pages: DataFrame, rules: list[tuple], url="url", html="html") -> DataFrame:
    """`pages` with `rule`, the prefix of its rule, and `page_content`, the text of the outermost elements that the rule
    selects. Each page is parsed once, whatever the number of rules; a page without a rule has neither. No row is moved.
    """
    ruled = pages.withColumn("_rule", rule_of(F.col(url), rules))
    parsed = ruled.withColumn("nodes", h.nodes(F.when(F.col("_rule").isNotNull(), F.col(html))))
    found = h.outermost(F.filter("nodes", lambda n: h.fits(n, F.col("_rule"))))
    parts = F.transform(found, lambda n: h.raw_text(h.inside(F.col("nodes"), n)))
    text = F.when(F.col("_rule").isNotNull(), F.array_join(parts, ""))
    return parsed.withColumns({"page_content": text, "rule": F.col("_rule.prefix")}).drop("nodes", "_rule", html)


def whole_text(pages: DataFrame) -> DataFrame:
    """All text of a page, one stripped piece per line; scripts, styles and comments left out."""
    return pages.withColumn("page_content", h.tight_text(F.col("nodes"), "\n")).drop("nodes")


# Where course pages keep their description.
RICH_TEXT_ID = "rich-text-generator"
FALLBACKS = (
    ("span", "richText richtext-paragraph-margin"),
    ("div", "wp-block-column is-vertically-aligned-center"),
    ("div", "wp-block-column"),
)
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
NO_TITLE = "No Title Found"
NO_DESCRIPTION = "No Description Found"


def title_and_description(pages: DataFrame, rich_text_id=RICH_TEXT_ID, fallbacks=FALLBACKS) -> DataFrame:
    """The h1 text, and the first non-empty of: rich-text block, fallback paragraphs, first list item.

    A page that is null (it could not be fetched) becomes an `Error` row.
    """
    page = F.col("nodes")

    def text_of(node: Column) -> Column:
        return h.tight_text(h.inside(page, node))

    def block_lines(*tags) -> Column:
        block = h.inside(page, F.col("block"))
        found = F.filter(block, lambda n: n["tag"].isin(*tags) & (n["pos"] > F.col("block.pos")))
        return F.transform(found, text_of)

    def paragraph_in(tag, class_) -> Column:
        box = h.first(page, tag=tag, class_=class_)
        p = F.get(F.filter(h.inside(page, box), lambda n: n["tag"] == "p"), 0)
        return F.when(p.isNotNull(), text_of(p))

    title = h.first(page, tag="h1")
    blank_to_null = lambda c: F.when(c != "", c)
    lines = F.concat(block_lines("li"), block_lines("p"), block_lines(*HEADINGS))
    rich = F.when(F.col("block").isNotNull(), F.array_join(lines, "\n"))
    # A fallback paragraph that exists ends the search, even when it is empty.
    item = h.first(page, tag="li")
    fallback = F.coalesce(
        *[paragraph_in(*f) for f in fallbacks], F.when(item.isNotNull(), text_of(item))
    )
    described = F.coalesce(blank_to_null(rich), blank_to_null(fallback), F.lit(NO_DESCRIPTION))
    titled = F.when(title.isNotNull(), text_of(title)).otherwise(NO_TITLE)
    failed = F.col("nodes").isNull()
    return (
        pages.withColumn("block", h.first(page, tag="span", id=rich_text_id))
        .withColumn("title", F.when(failed, "Error").otherwise(titled))
        .withColumn("description", F.when(failed, "Failed to fetch").otherwise(described))
        .drop("nodes", "block")
    )


def headed_paragraphs(pages: DataFrame, category: str, updated: str, html="html") -> DataFrame:
    """One document per h2 with the next p after its start tag: `title: description`. Pages are read in one pass."""
    found = pages.withColumn("entry", F.explode(h.entries(html)))
    return found.select(
        *[c for c in pages.columns if c != html],
        labelled(F.col("entry.title"), F.col("entry.description")).alias("page_content"),
        F.create_map(
            F.lit("source"),
            F.col("entry.title"),
            F.lit("category"),
            F.lit(category),
            F.lit("updated"),
            F.lit(updated),
        ).alias("metadata"),
    )


def section_trees(pages: DataFrame, html="html") -> DataFrame:
    """One row per h2: title, its own paragraphs and its h3 groups, from the h2's siblings. Pages are read in one pass."""
    found = pages.withColumn("tree", F.explode(h.sections(html)))
    return found.select(*[c for c in pages.columns if c != html], "tree.*")


def section_text(title: Column, paragraphs: Column, h3_sections: Column) -> Column:
    """A section tree as readable text."""
    lines = F.array_join(F.transform(paragraphs, lambda p: F.concat(p, F.lit("\n"))), "")
    groups = F.transform(
        h3_sections,
        lambda g: F.concat(
            F.lit("\n"),
            g["title"],
            F.lit(":\n"),
            F.array_join(
                F.transform(g["paragraphs"], lambda p: F.concat(F.lit("- "), p, F.lit("\n"))), ""
            ),
        ),
    )
    return F.concat(title, F.lit("\n\n"), lines, F.array_join(groups, ""))


def out_links(pages: DataFrame, *keep: str, html="html") -> DataFrame:
    """One row per `a href` of a page. Runs as a pattern in the JVM: crawls are large."""
    visible = F.regexp_replace(html, COMMENT_OR_SCRIPT, "")
    found = F.regexp_extract_all(visible, F.lit(LINK), F.lit(1))
    quoted = pages.select(*keep, F.explode(found).alias("href"))
    bare = F.regexp_replace("href", r"""^["']|["']$""", "")
    return quoted.withColumn("href", F.replace(bare, F.lit("&amp;"), F.lit("&")))
