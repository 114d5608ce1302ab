"""Token records in training order: a keyed permutation gives every record its place, range partitions write them there.

Records are numbered 0 .. n-1 as they lie in a written table. A Feistel network permutes the next even power of two;
cycle-walking, applying it again until the value is below n, makes that a permutation of the numbers. A shard holds a
fixed number of records of a fixed number of bytes, so place, shard and byte offset follow from one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill.llm.shipping import ship_package
from placemill.llm.texts import segments
from placemill.llm.words import blocks, mix
from placemill.staging import pin, scratch_path

#: Bytes of a record. For a text, token ids are its UTF-8 bytes; END follows the last, PAD fills the last record. UTF-8
#: uses neither value. For arrays of ids, END and PAD are likewise the two largest numbers of the token width.
STRIDE = 2048
END, PAD = 0xFE, 0xFF
#: Ids that are worked on at once.
BLOCK_IDS = 1 << 18
#: Records of a shard.
PER_SHARD = 8192
ROUNDS = 6


def permute(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """The keyed permutation of 0 .. size-1 at ``numbers``."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + mix(np.array([key % 2**64], np.uint64)))
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> np.uint64(half), out[walking] & low
        for round_key in keys:
            left, right = right, left ^ (mix(right + round_key) & low)
        out[walking] = (left << np.uint64(half)) | right
        walking = walking[out[walking] >= size]
    return out.astype(np.int64)


def restore(places: np.ndarray, size: int, key: int) -> np.ndarray:
    """The inverse of ``permute``."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + mix(np.array([key % 2**64], np.uint64)))
    out = places.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> np.uint64(half), out[walking] & low
        for round_key in keys[::-1]:
            left, right = right ^ (mix(left + round_key) & low), left
        out[walking] = (left << np.uint64(half)) | right
        walking = walking[out[walking] >= size]
    return out.astype(np.int64)


def id_blocks(lists: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """What ``words.blocks`` gives for texts, for lists of token ids: number of the first list, ids, offsets."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = lists.flatten()
    if ids.null_count:
        owners = pc.list_parent_indices(lists).filter(pc.is_null(ids)).to_numpy()
        sizes -= np.bincount(owners, minlength=len(sizes))
        ids = ids.drop_null()
    ids, offsets = ids.to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])
    if len(ids) and (ids.min() < 0 or ids.max() >= 256**width - 2):
        raise ValueError(f"token ids from {ids.min()} to {ids.max()} do not fit into {width} bytes beside END and PAD")
    first = 0
    while first < len(sizes):
        stop = int(np.searchsorted(offsets, offsets[first] + BLOCK_IDS, "right")) - 1
        stop = min(max(stop, first + 1), len(sizes))
        yield first, ids[offsets[first] : offsets[stop]], offsets[first : stop + 1] - offsets[first]
        first = stop


def records(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", stride: int = STRIDE, width: int | None = None
) -> DataFrame:
    """Rows (doc_id, part, n_tokens, tokens): each text and END, cut into records of ``stride`` bytes, the last padded.

    ``text`` is a text, whose tokens are its UTF-8 bytes, or an array of token ids such as ``bpe.encode`` gives, written
    as little-endian numbers of ``width`` bytes (2 or 4, the default), of which ``stride`` is a multiple. Ids that are
    negative or reach END fail the job; null ids in an array are left out.

    ``n_tokens`` counts END but no padding. A null or empty text or array is END alone. Nothing is shuffled.
    """
    listed = isinstance(docs.schema[text].dataType, T.ArrayType)
    width = width or (4 if listed else 1)
    if width not in ((2, 4) if listed else (1,)) or stride < width or stride % width:
        raise ValueError("a token has 1 byte in a text, 2 or 4 in an array of ids, and a record whole tokens")
    number, length = np.dtype(f"<u{width}"), stride // width
    pad = np.iinfo(number).max
    ship_package(docs.sparkSession)
    kind = docs.schema[doc_id].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("part", T.IntegerType()),
            T.StructField("n_tokens", T.IntegerType()),
            T.StructField("tokens", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(1)
            for first, data, offsets in id_blocks(cells, width) if listed else blocks(cells):
                count = len(offsets) - 1
                ends = offsets[1:] + np.arange(1, count + 1)
                whole = np.full(len(data) + count, pad - 1, number)
                inside = np.ones(len(whole), bool)
                inside[ends - 1] = False
                whole[inside] = data
                starts, lengths, owner = segments(np.concatenate([[0], ends]), length)
                column = np.arange(length)
                table = np.full((len(starts), length), pad, number)
                filled = column < lengths[:, None]
                table[filled] = whole[(starts[:, None] + column)[filled]]
                bounds = np.searchsorted(owner, np.arange(count))
                parts = np.arange(len(owner)) - bounds[owner]
                ids = batch.column(0).slice(first, count).take(pa.array(owner))
                fixed = pa.Array.from_buffers(pa.binary(stride), len(table), [None, pa.py_buffer(table.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(parts, pa.int32()), pa.array(lengths, pa.int32()), fixed.cast(pa.binary())],
                    names=schema.fieldNames(),
                )

    cells = F.col(f"`{text}`").cast("array<bigint>" if listed else "string")
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), cells.alias("text")).mapInArrow(run, schema)


def numbered(written: DataFrame) -> tuple[DataFrame, int]:
    """Rows of a table just written, with ``number`` from 0 without gaps in the order of files and rows; and their count.

    File and row are properties of what is stored, so a task that is run again gives the same numbers. Only the files'
    sizes are summed up, one row for each file.
    """
    located = written.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    sizes = located.groupBy("__file").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = pin(sizes.withColumn("__start", F.coalesce(F.sum("__rows").over(before), F.lit(0))), "starts")
    total = starts.agg(F.sum("__rows")).first()[0] or 0
    joined = located.join(starts.select("__file", "__start"), "__file")
    return joined.withColumn("number", F.col("__start") + F.col("__row")).drop("__file", "__row", "__start"), total


def materialise(
    docs: DataFrame,
    *,
    key: int,
    root: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    stride: int = STRIDE,
    per_shard: int = PER_SHARD,
    width: int | None = None,
) -> DataFrame:
    """Write the records of all texts, or arrays of token ids, in the order that ``key`` gives them; returns the written
    table. For ``stride`` and ``width`` see :func:`records`.

    Columns ``place`` (from 0 without gaps), ``shard`` (place // per_shard), ``offset`` (in the shard, in bytes),
    ``doc_id``, ``part``, ``n_tokens``, ``tokens``. Below ``root`` (by default a new folder in the shared one) there is a
    folder for each shard, in it the records in order of their places. Rows of equal ids each have records of their own;
    an empty table writes none; other columns are not read. The text is shuffled once, by number of shard, and shards are
    equally full whatever the data.
    """
    spark = docs.sparkSession
    cut = scratch_path(spark, "records")
    written = records(docs, doc_id=doc_id, text=text, stride=stride, width=width)
    written.write.option("compression", "zstd").parquet(cut)
    counted, size = numbered(spark.read.schema(written.schema).parquet(cut))

    @F.pandas_udf("bigint")
    def place_of(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), size, key))

    placed = counted.withColumn("place", place_of("number"))
    placed = placed.withColumns(
        {
            "shard": F.floor(F.col("place") / per_shard).cast("int"),
            "offset": (F.col("place") % per_shard) * stride,
        }
    )
    columns = ["place", "shard", "offset", "doc_id", "part", "n_tokens", "tokens"]
    root = root or scratch_path(spark, "shards")
    shards = max(1, -(-size // per_shard))
    # A task writes whole shards, one after another. Their numbers are known, so nothing is sampled.
    dealt = placed.select(*columns).repartitionById(min(shards, 100_000), "shard").sortWithinPartitions("shard", "place")
    dealt.write.partitionBy("shard").mode("overwrite").option("compression", "zstd").parquet(root)
    return read_places(spark, root, schema=placed.select(*columns).schema)


def read_places(
    spark: SparkSession,
    root: str,
    start: int = 0,
    stop: int | None = None,
    *,
    per_shard: int = PER_SHARD,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Records from place ``start`` up to ``stop``, of which only the shards they lie in are read; order by ``place`` to
    resume a run where it ended."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    stored = reader.parquet(root)
    if start:
        stored = stored.filter((F.col("shard") >= start // per_shard) & (F.col("place") >= start))
    if stop is not None:
        stored = stored.filter((F.col("shard") <= max(stop - 1, 0) // per_shard) & (F.col("place") < stop))
    return stored
