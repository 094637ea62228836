"""What several of these operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words and white space as every contract here defines them: ASCII white space only.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def body(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(body(text), F.lit(WORD)).cast("long")


def whole_rows(docs: DataFrame, *derived: Column) -> DataFrame:
    """Derived columns next to the untouched input row, which is packed into the struct ``row``:
    whatever columns the input has, none can clash with the names used inside an operator."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *derived)


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the Arrow batches of about ``most`` bytes of text (one row at least), so that a
    worker's memory follows the longest text and not the batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column)))
        start, held = 0, 0
        for i, size in enumerate(sizes.to_pylist()):
            if held and held + (size or 0) > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 0
        yield batch.slice(start)
