"""String columns: strip, clean, split, cut and parse."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that Unicode (and Python's str.strip) call white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A word is two or more letters, digits or underscores; a
# sentence ends at white space that follows one of . ! ?
WORD = r"[\p{L}\p{N}_]{2,}"
SENTENCE_BREAK = r"(?<=[.!?])\s+"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def not_blank(items: Column) -> Column:
    """Strip each string of an array and drop the empty ones."""
    return F.filter(F.transform(items, strip), lambda x: x != "")


def clean_paragraphs(c: Column) -> Column:
    """One stripped paragraph per line, blank lines dropped, joined by a blank line."""
    return F.array_join(not_blank(F.split(c, "\n")), "\n\n")


def remove_breaks(c: Column) -> Column:
    """Delete newlines and tabs, turn non-breaking spaces into spaces, strip."""
    # translate deletes every character that has no partner.
    return strip(F.translate(c, "\xa0\n\t", " "))


def ascii_only(c: Column) -> Column:
    """A space in place of every non-ASCII character."""
    return F.regexp_replace(c, r"[^\x00-\x7F]", " ")


def split_list(c: Column, limit=None, separator=",,,") -> Column:
    """Items of a separated list, stripped, blanks dropped, at most `limit`."""
    items = not_blank(F.split(c, re.escape(separator)))
    return F.slice(items, 1, limit) if limit else items


def after_last(c: Column, marker: str) -> Column:
    return strip(F.substring_index(c, marker, -1))


def before_first(c: Column, marker: str) -> Column:
    return F.substring_index(c, marker, 1)


def contains_any(c: Column, keywords) -> Column:
    """True when any keyword (an array column or a list) is a substring."""
    if not isinstance(keywords, Column):
        keywords = F.array(*[F.lit(k) for k in keywords])
    return F.exists(keywords, lambda k: F.contains(c, k))


def labelled(title: Column, description: Column) -> Column:
    return F.concat(title, F.lit(": "), description)


def sentences(c: Column) -> Column:
    return F.filter(F.split(c, SENTENCE_BREAK), lambda x: x != "")


def words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


# English plurals that follow no rule.
IRREGULAR = {
    "child": "children", "criterion": "criteria", "curriculum": "curricula", "datum": "data", "foot": "feet", "half": "halves",
    "index": "indices", "knife": "knives", "leaf": "leaves", "life": "lives", "man": "men", "medium": "media", "mouse": "mice",
    "person": "people", "phenomenon": "phenomena", "self": "selves", "shelf": "shelves", "tooth": "teeth", "wife": "wives", "woman": "women",
}


def plural(c: Column) -> Column:
    """English plural: city -> cities, class -> classes, fee -> fees, thesis -> theses, criterion -> criteria."""
    irregular = F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair])
    known = F.try_element_at(irregular, c)
    return (
        F.when(known.isNotNull(), known)
        .when(c.rlike("sis$"), F.regexp_replace(c, "is$", "es"))
        .when(c.rlike("[^aeiou]y$"), F.regexp_replace(c, "y$", "ies"))
        .when(c.rlike("(s|x|z|ch|sh)$"), F.concat(c, F.lit("es")))
        .otherwise(F.concat(c, F.lit("s")))
    )


def source_from_file(c: Column, prefix="results_", suffix=".csv") -> Column:
    """`results_<source>.csv` to `<source>`."""
    return F.regexp_extract(c, f"^{re.escape(prefix)}(.*){re.escape(suffix)}$", 1)


# --- judge text -----------------------------------------------------------

CRITERIA = ("Accuracy", "Relevance", "Groundedness")


def bracket_scores(c: Column, keyword: str) -> Column:
    """Every score given for a keyword, `Accuracy: [4]` or `Accuracy: 4`."""
    found = F.regexp_extract_all(c, F.lit(rf"{keyword}: \[?(\d+)\]?"), F.lit(1))
    return F.transform(found, lambda x: x.try_cast("int"))


def bracket_score(c: Column, keyword: str) -> Column:
    """The first score given for a keyword; null when there is none."""
    return F.get(bracket_scores(c, keyword), 0)


# --- questions and transcripts --------------------------------------------

SECTIONS = ("beginning", "middle", "end")


def parse_question(c: Column) -> Column:
    """The search text and the part of the document the question points at."""
    search = strip(before_first(F.substring_index(c, "Query:", -1), "Section:"))
    low = F.lower(c)
    section = (
        F.when(F.contains(low, F.lit("beginning")), "beginning")
        .when(F.contains(low, F.lit("middle")), "middle")
        .otherwise("end")
    )
    return F.struct(search.alias("query"), section.alias("section"))


# The header marks of the chat transcript format, and the labels inside a user's turn.
USER_HEADER = "<|start_header_id|>user<|end_header_id|>"
ASSISTANT_HEADER = "<|start_header_id|>assistant<|end_header_id|>"
TURN_END = "<|eot_id|>"
CONTEXT_LABEL, QUESTION_LABEL = "Context:\n", "\n\nQuestion:"


def after_first(c: Column, mark: str) -> Column:
    """What follows the first mark; empty when there is none."""
    start = F.instr(c, mark)
    return F.when(start > 0, F.substring(c, start + len(mark), F.length(c))).otherwise("")


def between(c: Column, start: str, end: str) -> Column:
    """What stands between the first start and the next end; empty unless both are there."""
    rest = after_first(c, start)
    return F.when(F.contains(rest, F.lit(end)), before_first(rest, end)).otherwise("")


def transcript_parts(c: Column) -> Column:
    """Context, question and answer of a transcript; empty strings when absent."""
    asked = between(c, USER_HEADER, TURN_END)
    return F.struct(
        strip(between(asked, CONTEXT_LABEL, QUESTION_LABEL)).alias("context"),
        strip(after_first(after_first(asked, CONTEXT_LABEL), QUESTION_LABEL)).alias("question"),
        strip(after_first(c, ASSISTANT_HEADER)).alias("answer"),
    )


# --- JSON in generated text -----------------------------------------------


def json_list(c: Column) -> Column:
    """The JSON array inside a text, as strings; null when there is none."""
    return F.from_json(F.regexp_extract(c, r"(?s)\[.*\]", 0), "array<string>")


def checked_search(c: Column) -> Column:
    """A JSON record {query, section}; null unless it is complete and the section is known."""
    record = F.from_json(c, "struct<query:string,section:string>")
    valid = record["query"].isNotNull() & record["section"].isin(*SECTIONS)
    return F.when(valid, record)
