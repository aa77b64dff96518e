"""URL columns: validity, resolution, path segments, normal form."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.text import contains_any


# Cut by pattern, as try_parse_url gives null for the whole URL when one
# character in it is not allowed.
def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path(url: Column) -> Column:
    """The path without query, fragment and `;` parameters of its last part."""
    raw = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(raw, r";[^/]*$", "")


def is_valid(url: Column, base: str) -> Column:
    return scheme(url).isin("http", "https") & F.contains(url, F.lit(base))


def _segments(url: Column) -> Column:
    return F.split(F.trim(path(url), F.lit("/")), "/")


def first_segment(url: Column) -> Column:
    return F.lower(F.element_at(_segments(url), 1))


def last_segment(url: Column) -> Column:
    return F.lower(F.element_at(_segments(url), -1))


def is_relevant(url: Column, first_keywords, last_keywords) -> Column:
    """First and last path segment each hold one of their keywords."""
    return contains_any(first_segment(url), first_keywords) & contains_any(
        last_segment(url), last_keywords
    )


def _without_dots(p: Column) -> Column:
    """Resolve `.` and `..` segments of an absolute path."""
    parts = F.split(p, "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)),
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == ".", done)
        .when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.array_append(done, s)),
    )
    ends_open = p.rlike(r"/\.{1,2}$")
    return F.concat(
        F.lit("/"), F.array_join(kept, "/"), F.when(ends_open & (F.size(kept) > 0), "/").otherwise("")
    )


def resolve(base: Column, href: Column) -> Column:
    """The absolute URL a link leads to from a page at `base`."""
    origin = F.concat(scheme(base), F.lit("://"), host(base))
    base_path = F.when(path(base) == "", "/").otherwise(path(base))
    folder = F.regexp_replace(base_path, r"[^/]*$", "")
    link_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    link_rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    base_query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    return (
        F.when(href == "", F.regexp_extract(base, r"^([^#]*)", 1))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme(base), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, _without_dots(link_path), link_rest))
        .when(href.startswith("#"), F.concat(origin, base_path, base_query, href))
        .when(href.startswith("?"), F.concat(origin, base_path, href))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, link_path)), link_rest))
    )


def has_plain_last_part(url: Column) -> Column:
    """No `#` or `-` in the raw last part, query string included."""
    last = F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)
    return ~(F.contains(last, F.lit("#")) | F.contains(last, F.lit("-")))


def normal_form(url: Column) -> Column:
    """Lower-case host and path, no trailing slash, no query, fragment or parameters."""
    return F.concat(
        scheme(url),
        F.lit("://"),
        F.lower(host(url)),
        F.lower(F.rtrim(path(url), F.lit("/"))),
    )


def slash_count(url: Column) -> Column:
    return F.length(url) - F.length(F.replace(url, F.lit("/"), F.lit("")))
