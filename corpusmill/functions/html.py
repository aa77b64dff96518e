"""HTML pages as arrays of nodes; all selection happens in column expressions.

`nodes` is the only Python step: it lists the elements and text pieces of a page
in document order. A node's `last` is the position of its last descendant, so an
element's content is the slice pos..last of the array.
"""

from bisect import bisect_left, bisect_right
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.slices import each
from corpusmill.functions.text import WHITESPACE, strip

NODES = (
    "array<struct<pos:int,last:int,parent:int,tag:string,id:string,class:string,href:string,text:string>>"
)
TEXTS = pa.list_(pa.string())
ARROW_NODES = pa.list_(
    pa.struct([*((n, pa.int32()) for n in ("pos", "last", "parent")), *((n, pa.string()) for n in ("tag", "id", "class", "href", "text"))])
)

# Fixed values of HTML: elements without content, and elements whose content is no text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
NO_TEXT = frozenset("script style template".split())


class _Nodes(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.open = [], []

    def _add(self, tag=None, attrs=(), text=None):
        pos, a = len(self.out) + 1, dict(attrs)
        parent = self.open[-1][0] if self.open else 0
        self.out.append([pos, pos, parent, tag, a.get("id"), a.get("class"), a.get("href"), text])
        return pos

    def handle_starttag(self, tag, attrs):
        pos = self._add(tag, attrs)
        if tag not in VOID:
            self.open.append((pos, tag))

    def handle_startendtag(self, tag, attrs):
        self._add(tag, attrs)

    def handle_data(self, data):
        if not any(tag in NO_TEXT for _, tag in self.open[-1:]):
            self._add(text=data)

    def handle_endtag(self, tag):
        if any(tag == name for _, name in self.open):
            while self._pop() != tag:
                pass

    def _pop(self):
        pos, tag = self.open.pop()
        self.out[pos - 1][1] = len(self.out)
        return tag

    def result(self, page):
        self.feed(page)
        self.close()
        while self.open:
            self._pop()
        return [tuple(n) for n in self.out]


def nodes(html) -> Column:
    """The nodes of a page; null for a null page."""

    return each(NODES, ARROW_NODES, lambda page: _Nodes().result(page))(html)


# --- headings in one pass over the nodes of a page ---------------------------

ENTRIES = "array<struct<title:string,description:string>>"
SECTIONS = "array<struct<title:string,paragraphs:array<string>,h3_sections:array<struct<title:string,paragraphs:array<string>>>>>"
ARROW_ENTRIES = pa.list_(pa.struct([("title", pa.string()), ("description", pa.string())]))
ARROW_SECTIONS = pa.list_(
    pa.struct(
        [("title", pa.string()), ("paragraphs", TEXTS), ("h3_sections", pa.list_(pa.struct([("title", pa.string()), ("paragraphs", TEXTS)])))]
    )
)


class _Texts:
    """Text below a node: its pieces are a run of the page's pieces."""

    def __init__(self, page):
        pieces = [(pos, text.strip(WHITESPACE)) for pos, *_, text in page if text is not None]
        self.at = [pos for pos, piece in pieces if piece]
        self.pieces = [piece for _, piece in pieces if piece]

    def of(self, node):
        return "".join(self.pieces[bisect_left(self.at, node[0]) : bisect_right(self.at, node[1])])


def _entries(page):
    """(h2 text, text of the next p), from the last node to the first."""
    texts, out, following = _Texts(page), [], ""
    for node in reversed(page):
        if node[3] == "p":
            following = texts.of(node)
        elif node[3] == "h2":
            out.append((texts.of(node), following))
    return out[::-1]


def _sections(page):
    """Every h2 opens a section among its siblings, an h3 a group in it; a p belongs to what is open beside it."""
    texts, out, beside = _Texts(page), [], {}
    for node in page:
        parent, tag = node[2], node[3]
        if tag == "h2":
            beside[parent] = (texts.of(node), [], [])
            out.append(beside[parent])
        elif tag in ("h3", "p") and parent in beside:
            _, paragraphs, groups = beside[parent]
            if tag == "h3":
                groups.append((texts.of(node), []))
            else:
                (groups[-1][1] if groups else paragraphs).append(texts.of(node))
    return out


def entries(html) -> Column:
    """A page's h2 headings, each with the next p after its start tag; null for a null page."""
    return each(ENTRIES, ARROW_ENTRIES, lambda page: _entries(_Nodes().result(page)))(html)


def sections(html) -> Column:
    """A page's h2 sections: own paragraphs and h3 groups, from the h2's siblings; null for a null page."""
    return each(SECTIONS, ARROW_SECTIONS, lambda page: _sections(_Nodes().result(page)))(html)


# --- selection over a `nodes` column ---------------------------------------


def inside(page: Column, node: Column) -> Column:
    """The node and everything below it."""
    return F.slice(page, node["pos"], node["last"] - node["pos"] + 1)


def raw_text(part: Column) -> Column:
    """The text pieces of a node slice, joined as they are."""
    return F.array_join(F.transform(part, lambda n: n["text"]), "")


def tight_text(part: Column, separator="") -> Column:
    """The text pieces of a node slice, each stripped, blanks dropped."""
    pieces = F.transform(F.filter(part, lambda n: n["text"].isNotNull()), lambda n: strip(n["text"]))
    return F.array_join(F.filter(pieces, lambda x: x != ""), separator)


def matches(node: Column, tag=None, id=None, class_=None) -> Column:
    """A class with a space must be the whole attribute, else it is one of the names in it."""
    test = node["tag"].isNotNull()
    if tag is not None:
        test = test & (node["tag"] == tag)
    if id is not None:
        test = test & F.coalesce(node["id"] == id, F.lit(False))
    if class_ is not None:
        found = (
            node["class"] == class_
            if " " in class_
            else F.array_contains(F.split(node["class"], r"\s+"), class_)
        )
        test = test & F.coalesce(found, F.lit(False))
    return test


def fits(node: Column, rule: Column) -> Column:
    """Like `matches`, by the fields tag, id and class of a rule column; a null field asks for nothing."""
    names = F.split(node["class"], r"\s+")
    class_ = F.when(F.contains(rule["class"], F.lit(" ")), node["class"] == rule["class"]).otherwise(F.array_contains(names, rule["class"]))
    return (
        node["tag"].isNotNull()
        & (rule["tag"].isNull() | (node["tag"] == rule["tag"]))
        & (rule["id"].isNull() | F.coalesce(node["id"] == rule["id"], F.lit(False)))
        & (rule["class"].isNull() | F.coalesce(class_, F.lit(False)))
    )


def outermost(found: Column) -> Column:
    """Drop nodes that lie inside an earlier node of the same (ordered) array."""
    kept = F.aggregate(
        found,
        F.struct(
            F.array().cast(NODES).alias("nodes"), F.lit(0).alias("upto")
        ),
        lambda acc, n: F.when(n["pos"] <= acc["upto"], acc).otherwise(
            F.struct(F.array_append(acc["nodes"], n).alias("nodes"), n["last"].alias("upto"))
        ),
    )
    return kept["nodes"]


def first(page: Column, **selector) -> Column:
    return F.get(F.filter(page, lambda n: matches(n, **selector)), 0)
