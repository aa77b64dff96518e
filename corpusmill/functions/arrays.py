"""Array and map columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once per row.

    An expression used inside a lambda is otherwise computed again for every
    element the lambda runs over.
    """
    return F.get(F.transform(F.array(value), body), 0)


def argmax(values: Column) -> Column:
    """Zero-based position of the largest value; the first one on a tie."""
    return F.array_position(values, F.array_max(values)) - 1


def pad_or_cut(ids: Column, size: int, pad=0) -> Column:
    """Token ids at a fixed length."""
    return F.slice(F.concat(ids, F.array_repeat(F.lit(pad).cast("int"), size)), 1, size)


def attention_mask(ids: Column, size: int) -> Column:
    """1 for a token, 0 for padding."""
    ones = F.transform(F.slice(ids, 1, size), lambda _: F.lit(1))
    return pad_or_cut(ones, size)


def with_key(metadata: Column, key: str, value: Column) -> Column:
    """A copy of a string map with one entry set."""
    others = F.map_filter(metadata, lambda k, _: k != key)
    return F.map_concat(others, F.create_map(F.lit(key), value.cast("string")))


def fixed_windows(text: Column, size: int, overlap: int) -> Column:
    """Character windows of `size` that share `overlap` characters; the last one may be short."""
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")
    # Cutting a UTF-8 string at character i walks the string from its start, so
    # the text is first cut into step-wide pieces in one pass and windows are
    # joined from neighbouring pieces.
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    span = -(-size // step)
    count = F.greatest(
        F.ceil((F.length(text) - F.lit(overlap)) / F.lit(step)).cast("int"), F.lit(1)
    )
    starts = F.sequence(F.lit(1), count)
    cut = lambda p: F.transform(
        starts, lambda i: F.substring(F.array_join(F.slice(p, i, span), ""), 1, size)
    )
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(let(pieces, cut))


def dot(a: Column, b: Column) -> Column:
    """Dot product of two array columns, summed in order."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda total, x: total + x,
    )
