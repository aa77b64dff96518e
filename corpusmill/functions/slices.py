"""Python column functions whose objects in memory follow a few rows, not an Arrow batch."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

#: A function sees rows of about this many bytes at a time, one row at least; their Python objects take some ten times that.
SLICE_BYTES = 1 << 20


def slices(batch):
    """An Arrow array or record batch in parts of SLICE_BYTES by its mean row, in order; an empty one as it is."""
    rows = len(batch)
    step = max(1, rows * SLICE_BYTES // max(1, batch.nbytes))
    return (batch.slice(a, step) for a in range(0, max(1, rows), step))


def sliced(kind: str, part):
    """A column function of Spark type `kind` from `part(array) -> array`, which gets slices."""

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for rows in slices(batch):
                yield part(rows)

    return run


def each(kind: str, arrow: pa.DataType, one):
    """`sliced` by `one(value)`, row by row; a null stays."""
    return sliced(kind, lambda rows: pa.array([None if v is None else one(v) for v in rows.to_pylist()], arrow))
