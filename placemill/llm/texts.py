"""Running numpy code over the texts of a table, a bounded block at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill.llm.shipping import ship_package
from placemill.llm.words import blocks

#: What a task makes once: from a block's bytes and offsets to one array for each output column.
Scorer = Callable[[np.ndarray, np.ndarray], Sequence[pa.Array]]


def add_text_columns(
    df: DataFrame,
    outputs: T.StructType,
    make: Callable[[], Scorer],
    *,
    text: str | Column = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``df`` (all, if None) and the ``outputs`` that a scorer works out from each whole text.

    Texts reach the scorer as UTF-8 in blocks of about ``words.BLOCK_BYTES``; null is empty. An input column with the
    name of an output is dropped. Nothing is shuffled: a lost task is run again by itself.
    """
    ship_package(df.sparkSession)
    made = {field.name.lower() for field in outputs}
    kept = [name for name in (df.columns if keep is None else keep) if name.lower() not in made]
    row = T.StructType([T.StructField("__row", T.StructType([df.schema[name] for name in kept])), *outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = None
        for batch in batches:
            texts = batch.column(1)
            for first, data, offsets in blocks(texts):
                score = score or make()
                columns = score(data, offsets)
                rows = batch.column(0).slice(first, len(offsets) - 1)
                names = ["__row", *(field.name for field in outputs)]
                yield pa.RecordBatch.from_arrays([rows, *columns], names=names)

    source = F.col(text) if isinstance(text, str) else text
    # A table without columns to keep still needs a row for each text.
    carried = F.struct(*[F.col(f"`{name}`") for name in kept]) if kept else F.struct(F.lit(1).alias("__one"))
    if not kept:
        row = T.StructType([T.StructField("__row", T.StructType([T.StructField("__one", T.IntegerType())])), *outputs])
    mapped = df.select(carried.alias("__row"), source.cast("string").alias("__text")).mapInArrow(run, row)
    return mapped.select(*[F.col(f"__row.`{name}`") for name in kept], *[field.name for field in outputs])


def segments(offsets: np.ndarray, size: int, *, at_least: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut into pieces of ``size`` bytes, the last of each shorter: where they begin, their lengths, their texts'
    numbers. A text has ``at_least`` so many pieces."""
    sizes = np.diff(offsets)
    pieces = np.maximum(-(-sizes // size), at_least)
    text = np.repeat(np.arange(len(sizes)), pieces)
    place = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = offsets[:-1][text] + place * size
    return starts, np.minimum(size, offsets[1:][text] - starts), text
